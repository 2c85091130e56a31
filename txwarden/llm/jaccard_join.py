"""Near-duplicate documents by a grouped prefix join on word shingles.

Two documents link when the Jaccard similarity of their shingle sets is at least ``percent``.
Sets are ordered by how many documents have a shingle, rarest first; sets that link share a
shingle among the first ``n - ceil(percent n) + 1``, their prefixes. The steps:

1. Documents are dealt into batches, shingles into buckets by hash. Every batch sends each of
   its shingles once, with its count; the buckets add up and send back one byte for each, a
   class of its document frequency. A document of which more than the allowed part of shingles
   occurs nowhere else cannot link and is done.
2. Documents with equal sets become one node. Nodes with equal prefix and size are one group,
   which is posted once under each shingle of its prefix. Shingles with the same groups are
   one list.
3. Groups that pass the size and position filters in a list are expanded to their nodes and
   verified on whole sets. A list does not emit all its pairs: its node with the fewest shingles
   of its own, as a rule the original of a family of copies, is compared with all others, and
   what those links connect needs no further comparison. Lists whose nodes are then still in
   several components make up families, in which the nodes outside the largest component are
   compared with the rest, block by block.

Links are exact up to collisions of 64-bit shingle hashes within one pair. Nothing is dropped
however frequent a shingle or large a family is: a frequent shingle is one entry for each batch,
a list is only joined and aggregated, never gathered. What a family costs is its unlinked
members times its size, in tasks of bounded size.

Defined cases: null, empty and blank texts have no shingles, link with nothing and are their own
component; a text of fewer words than a shingle is one shingle; repeated rows share a
component; rows with the same id but different texts are different documents; a null id can
connect others but is never the smallest, and a component without any id has a null one; an
empty table gives an empty table. Ids are integers. Columns not named in the call are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.functions.shipping import ship_package
from txwarden.functions.staging import quoted
from txwarden.llm.bytes_np import Words, byte_classes, grams, offsets_of, tiles, utf8
from txwarden.llm.components import connected_labels
from txwarden.llm.suffix_dedup import group_starts, pack, spread, unpack
from txwarden.llm.tables import settled

#: Bytes of text in a batch and shingles in a bucket, small and large tables.
BATCH_BYTES, MOST_BATCH_BYTES = 4 << 20, 64 << 20
BUCKET_SHINGLES, MOST_BUCKET_SHINGLES = 1 << 20, 1 << 24
#: Batches or buckets beyond which they grow before they become more.
MANY = 512
#: Shingles of the nodes that one task compares with those of as many others.
BLOCK_SHINGLES = 1 << 21

CLASSES = byte_classes(bytes([0x20, *range(0x09, 0x0E)]))


class Sets:
    """Shingle sets of a batch's documents: sorted ``tokens`` with the document of each, and
    where each document's begin."""

    def __init__(self, table: pa.Table, words: int, bits: int):
        text = table.column("text")
        data, offsets = utf8(pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], text.type))
        tokens, sizes = [], []
        for i, j in tiles(offsets):
            t, n = self._tile(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
            tokens.append(t)
            sizes.append(n)
        self.tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.first = offsets_of(self.sizes)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.keys, self.at, self.counts = np.unique(
            self.tokens >> np.uint64(32 - bits), return_inverse=True, return_counts=True
        )
        self.edges = np.searchsorted(self.keys >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64))

    @staticmethod
    def _tile(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        w = Words(data, offsets, CLASSES)
        n = np.diff(w.first)
        whole = grams(w.hashes, size)
        inside = np.zeros(len(w.hashes) + 1, np.int64)
        counts = np.maximum(n - size + 1, 0)
        full = counts > 0
        inside[w.first[:-1][full]] += 1
        np.add.at(inside, (w.first[:-1] + counts)[full], -1)
        tokens = whole[np.cumsum(inside[: len(whole)]) > 0]
        doc = np.repeat(np.arange(len(n)), counts)
        for k in range(1, size):  # short texts are one shingle
            few = np.flatnonzero(n == k)
            if len(few):
                tokens = np.concatenate([tokens, grams(w.hashes, k)[w.first[few]]])
                doc = np.concatenate([doc, few])
        order = np.lexsort((tokens, doc))
        tokens, doc = tokens[order], doc[order]
        if len(doc):
            at = group_starts(doc, tokens)
            tokens, doc = tokens[at], doc[at]
        return tokens, np.bincount(doc, minlength=len(n)).astype(np.int64)


def frequency_class(n: np.ndarray) -> np.ndarray:
    """Eighths of a doubling above one document, as a byte."""
    return np.minimum(np.floor(8 * np.log2(n)), 255).astype(np.uint8)


def shingle_sets(docs: DataFrame, *, words: int, percent: int, carry: list[str]) -> DataFrame:
    """For a table of ``id``, ``text`` and others: id, the columns to ``carry``, ``n``, and for documents that may link ``node`` (the
    name of their set), ``own`` (shingles found nowhere else) and ``tokens``, rarest first."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-total // MOST_BATCH_BYTES), min(MANY, -(-total // BATCH_BYTES)))
    shingles = total // 6
    buckets = max(1, shingles // MOST_BUCKET_SHINGLES, min(MANY, shingles // BUCKET_SHINGLES))
    bits = (int(buckets) - 1).bit_length()
    dealt = docs.withColumn("batch", F.pmod(F.xxhash64("id", "text"), F.lit(batches)).cast("int"))
    addressed = [("bucket", pa.int32()), ("batch", pa.int32())]
    sent = pa.schema([*addressed, ("keys", pa.binary()), ("counts", pa.binary())])
    back = pa.schema([*addressed, ("classes", pa.binary())])

    def send(table: pa.Table) -> pa.Table:
        s = Sets(table, words, bits)
        low, n = s.keys.astype(np.uint32), np.minimum(s.counts, 65535).astype(np.uint16)
        number = table.column("batch")[0].as_py()
        rows = [
            {"bucket": i, "batch": number, "keys": pack(low[a:b], True), "counts": pack(n[a:b])}
            for i, (a, b) in enumerate(zip(s.edges[:-1], s.edges[1:], strict=True))
            if b > a
        ]
        return pa.Table.from_pylist(rows, sent)

    def add_up(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [unpack(r.pop("keys"), np.uint32, True) for r in rows]
        counts = np.concatenate([unpack(r.pop("counts"), np.uint16) for r in rows])
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        classes = frequency_class(np.bincount(at, counts))[at]
        ends = np.cumsum([len(k) for k in keys])
        for r, k, end in zip(rows, keys, ends, strict=True):
            r["classes"] = classes[end - len(k) : end].tobytes()
        return pa.Table.from_pylist(rows, back)

    made = "n long, node binary, own long, tokens array<long>"
    out_type = T.StructType(
        [docs.schema["id"], *[docs.schema[c] for c in carry], *T.StructType.fromDDL(made).fields]
    )

    def decide(table: pa.Table, answers: pa.Table) -> pa.Table:
        s = Sets(table, words, bits)
        rows = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
        classes = np.frombuffer(b"".join(r["classes"] for r in rows), np.uint8)[s.at]
        shared = np.bincount(s.doc, classes > 0, len(s.sizes)).astype(np.int64)
        live = (s.sizes > 0) & (100 * shared >= percent * s.sizes)
        nodes = [
            hashlib.blake2b(s.tokens[s.first[i] : s.first[i + 1]].tobytes(), digest_size=16).digest() if ok else None
            for i, ok in enumerate(live.tolist())
        ]
        some = live[s.doc]
        order = np.lexsort((s.tokens[some], classes[some], s.doc[some]))
        ends = offsets_of(np.where(live, s.sizes, 0)).astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(s.tokens[some][order].view(np.int64)))
        return pa.Table.from_arrays(
            [table.column("id"), *map(table.column, carry), pa.array(s.sizes), pa.array(nodes, pa.binary()), pa.array(s.sizes - shared), tokens],
            out_type.names,
        )

    by_batch = lambda t: t.groupBy("batch")
    runs = by_batch(dealt).applyInArrow(send, "bucket int, batch int, keys binary, counts binary")
    classes = runs.groupBy("bucket").applyInArrow(add_up, "bucket int, batch int, classes binary")
    return by_batch(dealt).cogroup(by_batch(classes)).applyInArrow(decide, out_type)


def prefix_lists(nodes: DataFrame, percent: int) -> DataFrame:
    """Lists of nodes (list, node, n, at, own) such that any two that may link share a list; ``at``
    is the place of the list's shingle in the node's set."""
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    p = nodes.select("node", "n", "own", F.slice("tokens", 1, length.cast("int")).alias("prefix"))
    p = p.withColumn("g", F.struct(F.xxhash64("prefix", "n").alias("x"), F.hash("prefix").alias("y"), "n"))
    groups = settled(
        p.groupBy("g").agg(F.min("node").alias("gid"), F.count(F.lit(1)).alias("members"), F.first("prefix").alias("prefix")),
        "groups",
    )
    members = settled(p.join(groups.select("g", "gid", "members"), "g").select("gid", "members", "node", "n", "own"), "members")
    posted = groups.select("gid", F.col("g.n").alias("n"), F.posexplode("prefix").alias("at", "token"))
    # Shingles posted by the same groups give the same list; the first of them serves, since it
    # has the earliest places and hence the weakest position filter.
    mark = F.xxhash64("gid")
    shared = posted.groupBy("token").agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum(mark.cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(mark).alias("xor"),
        F.sum("at").alias("places"),
    )
    chosen = shared.filter("groups > 1").groupBy("groups", "sum", "xor").agg(F.min_by("token", F.struct("places", "token")).alias("token"))
    lists = posted.join(chosen.select("token"), "token")
    many = lists.join(members.drop("n"), "gid").select(F.concat(F.lit("t"), F.col("token").cast("string")).alias("list"), "node", "n", "at", "own")
    inner = members.filter("members > 1").select(F.concat(F.lit("g"), F.hex("gid")).alias("list"), "node", "n", F.lit(0).alias("at"), "own")
    return many.unionByName(inner)


def open_lists(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of lists that still join several components, without nodes that the size and position
    filters keep from every other node of the list."""
    facts = rows.groupBy("list").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.min("n").alias("smallest")
    ).filter("least != most")
    r = rows.join(facts.select("list", "smallest"), "list")
    # The overlap is at most n - at, and links need percent / (100 + percent) of both sizes.
    fits = (100 + percent) * (F.col("n") - F.col("at")) >= percent * (F.col("n") + F.col("smallest"))
    r = r.filter(fits).drop("smallest")
    longer = r.groupBy("list").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return r.join(longer.select("list"), "list")


def pairs_to_verify(one: DataFrame, two: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of one list, of different components, that pass the filters."""
    x = one.select("list", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "at", "label")])
    y = two.select("list", *[F.col(c).alias(f"y_{c}") for c in ("node", "n", "at", "label")])
    both = y.join(x, "list").filter("x_label != y_label and x_node != y_node")
    least, most = F.least("x_n", "y_n"), F.greatest("x_n", "y_n")
    room = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    both = both.filter((100 * least >= percent * most) & ((100 + percent) * room >= percent * (least + most)))
    return both.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    sets = nodes.select("node", "tokens")
    p = pairs.join(sets.withColumnsRenamed({"node": "a", "tokens": "ta"}), "a")
    p = p.join(sets.withColumnsRenamed({"node": "b", "tokens": "tb"}), "b")
    p = p.withColumn("both", F.size(F.array_intersect("ta", "tb")))
    similar = 100 * F.col("both") >= percent * (F.size("ta") + F.size("tb") - F.col("both"))
    return p.filter(similar).select("a", "b")


def family_links(rows: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links that join components which still share a list. Lists that have a component in common are
    one family; a node goes to its family once, not once for each list. In a family the nodes
    outside its largest component are compared with all nodes of other components, in blocks
    of bounded size, by counting along an index of shingles. A task returns links that join
    components, at most as many as it has nodes, not the pairs it looks at."""
    least = rows.groupBy("list").agg(F.min("node").alias("a"))
    same = rows.join(least, "list").select("a", F.col("node").alias("b")).filter("a != b").distinct()
    family = connected_labels(labels, same).withColumnRenamed("label", "family")
    live = rows.select("node").distinct().join(labels, "node").join(family, "node")
    live = settled(live.join(nodes.select("node", "n"), "node"), "families")
    parts = live.groupBy("family", "label").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    facts = parts.groupBy("family").agg(
        F.max(F.struct("k", "label"))["label"].alias("main"),
        F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("right_blocks"),
        F.sum("n").alias("all_n"),
        F.max(F.struct("k", "n"))["n"].alias("main_n"),
    )
    facts = facts.withColumn("left_blocks", F.greatest(F.ceil((F.col("all_n") - F.col("main_n")) / BLOCK_SHINGLES), F.lit(1)))
    live = live.join(facts.select("family", "main", "left_blocks", "right_blocks"), "family")
    block = lambda k: F.pmod(F.xxhash64("node"), F.col(k))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.col(k) - 1))
    left = live.filter("label != main").select("family", "node", "label", F.lit(0).alias("side"), block("left_blocks").alias("x"), every("right_blocks").alias("y"))
    right = live.select("family", "node", "label", F.lit(1).alias("side"), every("left_blocks").alias("x"), block("right_blocks").alias("y"))
    sent = left.unionByName(right).join(nodes.select("node", "tokens"), "node")

    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        table = table.take(pa.array(order))
        lists = table.column("tokens").combine_chunks()
        tokens, ends = lists.flatten().to_numpy(), offsets_of(lists.value_lengths().to_numpy())
        node, label = table.column("node").to_pylist(), table.column("label").to_pylist()
        size, border = np.diff(ends), int((side == 0).sum())
        # An index of the right side: by shingle, the nodes that have it.
        low = ends[border]
        owner = np.repeat(np.arange(len(node) - border), size[border:])
        by = np.argsort(tokens[low:], kind="stable")
        known, owner = tokens[low:][by], owner[by]
        parent = {x: x for x in label}

        def root(x: bytes) -> bytes:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links = []
        for i in range(border):
            mine = tokens[ends[i] : ends[i + 1]]
            a, b = np.searchsorted(known, mine, "left"), np.searchsorted(known, mine, "right")
            hit = b > a
            at, _ = spread(a[hit], b[hit] - 1)
            both = np.bincount(owner[at], minlength=len(node) - border)
            near = 100 * both >= percent * (size[i] + size[border:] - both)
            for j in np.flatnonzero(near) + border:
                x, y = root(label[i]), root(label[j])
                if x != y:
                    parent[x] = y
                    links.append({"a": node[i], "b": node[j]})
        return pa.Table.from_pylist(links, pa.schema([("a", pa.binary()), ("b", pa.binary())]))

    return settled(sent.groupBy("family", "x", "y").applyInArrow(compare, "a binary, b binary"), "links")


def near_duplicate_components(
    docs: DataFrame,
    *,
    words: int = 5,
    percent: int = 75,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    one_each: bool = False,
) -> DataFrame:
    """Per document: id, the columns of ``keep``, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    With ``one_each`` only one row of each component, that with the smallest id (null comes last), among equal ids
    the one with the smallest hash of text and ``keep``; rows without shingles stay as they are."""
    ship_package(docs.sparkSession)
    name = {k: "text" if k == text_col else f"keep_{i}" for i, k in enumerate(keep)}
    texts = docs.select(
        F.col(quoted(id_col)).cast("long").alias("id"),
        F.col(quoted(text_col)).cast("string").alias("text"),
        *[F.col(quoted(k)).alias(n) for k, n in name.items() if n != "text"],
    )
    kept = list(name.values())
    carry = kept
    if one_each:
        texts = texts.withColumn("hash", F.xxhash64("text", *[n for n in kept if n != "text"]))
        carry = [*kept, "hash"]
    sets = shingle_sets(texts, words=words, percent=percent, carry=carry)
    if one_each:  # tells equal rows apart; fixed by storing it
        sets = sets.withColumn("row", F.monotonically_increasing_id())
    sets = settled(sets, "sets")
    live = sets.filter("node is not null")
    # What a component keeps is found node by node: no list of its rows is made.
    best = [F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "hash", "row")).alias("best")] if one_each else []
    nodes = settled(
        live.groupBy("node").agg(
            F.min("id").alias("id"), F.first("n").alias("n"), F.first("own").alias("own"), F.first("tokens").alias("tokens"),
            *best,
        ),
        "nodes",
    )
    labels = nodes.select("node", F.col("node").alias("label"))
    rows = settled(prefix_lists(nodes, percent), "lists")
    rows = settled(open_lists(rows.join(labels, "node"), percent), "open")
    if not rows.isEmpty():
        # The node with the fewest shingles of its own stands for its list at first.
        own = F.min(F.struct("own", "node", "n", "at", "label"))
        first = settled(rows.groupBy("list").agg(own.alias("p")).select("list", "p.*"), "pivots")
        links = verified(pairs_to_verify(first, rows, percent), nodes, percent)
        labels = connected_labels(labels, links)
        rows = settled(open_lists(rows.drop("label").join(labels, "node"), percent), "open")
        if not rows.isEmpty():
            labels = connected_labels(labels, family_links(rows, labels, nodes, percent))
    if one_each:
        first = labels.join(nodes.select("node", "best"), "node").groupBy("label").agg(F.min("best").alias("best"))
        first = first.select(F.col("best.row").alias("row"), F.col("best.id").alias("component_id"))
        linked = live.select("id", "n", "row", *kept).join(first, "row")
    else:
        found = labels.join(nodes.select("node", "id"), "node")
        smallest = found.groupBy("label").agg(F.min("id").alias("component_id"))
        of_node = found.join(smallest, "label").select("node", "component_id")
        linked = live.select("id", "n", "node", *kept).join(of_node, "node")
    alone = sets.filter("node is null").select("id", "n", F.col("id").alias("component_id"), *kept)
    out = linked.select("id", "n", "component_id", *kept).unionByName(alone)
    named = [F.col(n).alias(k) for k, n in name.items()]
    return out.select(F.col("id").alias(id_col), *named, F.col("n").alias("n_shingles"), "component_id")
