"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' normalised words make one automaton. A document's words stream through it; the state
tells the longest run of words, ending here, that occurs in some item. A run of ``window``
words, or of a whole shorter item, is a match: its words are hit, and its items are known from
the state. Most of a document cannot match and is passed over at array speed: a match needs
all its short word runs to occur in the items, so only stretches of known runs that are long
enough are streamed, from the automaton's start.

Items are sent to the workers in shards of bounded size; more items mean more shards, each of
which scans the documents, and the hits of shards are joined per document.

Defined cases: null, empty and wordless texts have no words and no hits; items without words
never match; items that share an id count once; an item with a null id hits words but is not
listed; repeated documents are judged one by one; no items or no documents give no hits or an
empty table. Columns not named in the call are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.functions.shipping import ship_package
from txwarden.functions.staging import quoted, stage
from txwarden.llm.bytes_np import Words, byte_classes, grams, slices, within

#: Bytes of items in a shard: what a worker builds one automaton from.
SHARD_BYTES = 1 << 20

# All ASCII bytes but digits and letters separate words.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
CLASSES = byte_classes(SEPARATORS)


#: A stretch of hit words, in bytes and in words.
SPAN_FIELDS = ("start", "end", "first_word", "last_word")
SPAN = T.StructType([T.StructField(x, T.LongType()) for x in SPAN_FIELDS])
ARROW_SPANS = pa.list_(pa.struct([(x, pa.int64()) for x in SPAN_FIELDS]))


class SuffixAutomaton:
    """Automaton of all word runs of several sequences, with the items of their windows."""

    def __init__(self, items: list[tuple[int, list[int]]], window: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.window = [-1], [0], window
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        #: the ancestor that holds the last ``window`` words of a state's longer runs
        self.cut = [0] * len(self.next)
        for s in order:
            up = self.link[s]
            self.cut[s] = self.cut[up] if self.length[up] >= window else s
        self.owners: dict[int, set[int]] = defaultdict(set)
        self.short: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item, words in items:
            s = 0
            for i, w in enumerate(words):
                s = self.next[s][w]
                if i + 1 >= window:
                    self.owners[self.cut[s]].add(item)
            if 0 < len(words) < window:
                self.short[s].append((len(words), item))
        #: nearest ancestor, or the state itself, at which a short item ends
        self.ends = [0] * len(self.next)
        for s in order:
            self.ends[s] = s if s in self.short else self.ends[self.link[s]]

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        old = nxt[last].get(w)
        if old is not None:
            return old if length[old] == length[last] + 1 else self._split(last, old, w)
        made = self._state(length[last] + 1, {}, 0)
        while last >= 0 and w not in nxt[last]:
            nxt[last][w] = made
            last = link[last]
        if last >= 0:
            to = nxt[last][w]
            link[made] = to if length[to] == length[last] + 1 else self._split(last, to, w)
        return made

    def _split(self, at: int, to: int, w: int) -> int:
        """A copy of state ``to`` for its runs no longer than those that reach it from ``at``."""
        copy = self._state(self.length[at] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = copy
        while at >= 0 and self.next[at].get(w) == to:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def stream(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Stretches of hit words, and the items whose windows occur."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = have = 0
        hits: list[tuple[int, int]] = []
        found: set[int] = set()
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                have = length[state]
            to = nxt[state].get(w)
            if to is None:
                state = have = 0
                continue
            state, have = to, have + 1
            longest = 0
            if have >= window:
                longest = window
                found |= self.owners.get(self.cut[state], set())
            at = self.ends[state]
            while at:
                for size, item in self.short[at]:
                    if have >= size:
                        longest = max(longest, size)
                        found.add(item)
                at = self.ends[link[at]]
            if longest:
                low = i + 1 - longest
                if hits and hits[-1][1] >= low:
                    while hits and hits[-1][0] >= low:
                        hits.pop()
                    if hits and hits[-1][1] >= low:
                        low = hits.pop()[0]
                hits.append((low, i + 1))
        return hits, found


class Matcher:
    """Items as an automaton, and the word runs that let a document skip it."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.ids = [i for i, _ in items]
        texts = [(t or "").encode() for _, t in items]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        words = Words(data, offsets, CLASSES)
        self.vocabulary = np.unique(words.hashes)
        numbers = np.searchsorted(self.vocabulary, words.hashes).tolist()
        first = words.first.tolist()
        listed = [(i, numbers[first[i] : first[i + 1]]) for i in range(len(texts))]
        self.automaton = SuffixAutomaton([x for x in listed if x[1]], window)
        sizes = [min(len(w), window) for _, w in listed if w]
        self.least = min(sizes, default=0)
        self.gram = min(3, self.least)
        if self.least:
            runs = grams(words.hashes, self.gram)
            self.runs = np.unique(runs[within(words.first, self.gram, len(numbers))])
            self.sieve = np.zeros(1 << 20, bool)
            self.sieve[self.runs & np.uint64((1 << 20) - 1)] = True

    def stretches(self, words: Words) -> Iterator[tuple[int, int]]:
        """Word ranges within which a match may lie."""
        n = len(words.hashes)
        runs = grams(words.hashes, self.gram)
        known = self.sieve[runs & np.uint64((1 << 20) - 1)]
        at = np.flatnonzero(known)
        place = np.minimum(np.searchsorted(self.runs, runs[at]), len(self.runs) - 1)
        known[at[self.runs[place] != runs[at]]] = False
        known &= within(words.first, self.gram, n)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], known.view(np.int8), [0]])))
        low, high = edge[::2], edge[1::2]
        # Neighbouring texts may touch where runs of one word are concerned.
        need = self.least - self.gram + 1
        cuts = words.first[1:-1]
        for a, b in zip(low.tolist(), high.tolist(), strict=True):
            inner = cuts[(cuts > a) & (cuts < b)].tolist() if self.gram == 1 else []
            for x, y in zip([a, *inner], [*inner, b], strict=True):
                if y - x >= need:
                    yield x, y + self.gram - 1

    def match(self, words: Words) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """Hit word ranges, as numbers within the tile, and item ids by document."""
        out: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        if not self.least or not len(words.hashes):
            return out
        for a, b in self.stretches(words):
            numbers = np.searchsorted(self.vocabulary, words.hashes[a:b]).tolist()
            hits, found = self.automaton.stream(numbers)
            if hits:
                doc = int(np.searchsorted(words.first, a, "right")) - 1
                spans, ids = out.setdefault(doc, ([], set()))
                spans += [(a + x, a + y) for x, y in hits]
                ids |= {self.ids[i] for i in found if self.ids[i] is not None}
        return out


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = 13,
    part: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: tuple[str, ...] = (),
    with_text: bool = False,
    cut_words: int | None = None,
) -> DataFrame:
    """Per document: id, the columns of ``keep``, ``n_words``, ``n_hit``, ``n_items``,
    ``items_sha256``, ``contaminated`` (at least one word in ``part`` is hit) and ``spans``,
    the stretches of hit words: byte and word numbers, start and end; with ``with_text`` also
    ``kept_text``, the text without spans of ``cut_words`` words (a window, if not given) or more,
    whatever part of the document they are."""
    spark = docs.sparkSession
    ship_package(spark)
    bench = items.select(
        F.col(quoted(item_col)).cast("string").alias("id"),
        F.col(quoted(item_text_col)).cast("string").alias("text"),
    ).filter(F.col("text").isNotNull())
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-2 * size // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("id", "text"), F.lit(shards))
    name = {k: "_text" if k == text_col else f"keep_{i}" for i, k in enumerate(keep)}
    texts = docs.select(
        F.col(quoted(id_col)).alias("id"),
        F.col(quoted(text_col)).cast("string").alias("_text"),
        *[F.col(quoted(k)).alias(n) for k, n in name.items() if n != "_text"],
    )
    carried = list(name.values())
    if with_text and "_text" not in carried:
        carried = [*carried, "_text"]
    if shards > 1:
        texts, carried = texts.withColumn("_key", F.xxhash64("_text")), [*carried, "_key"]
    found_type = T.StructType(
        [
            texts.schema["id"],
            *[texts.schema[k] for k in carried],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("spans", T.ArrayType(SPAN)),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    def scan(part: list[tuple[str | None, str]], texts: DataFrame) -> DataFrame:
        held = spark.sparkContext.broadcast(part)  # at most about SHARD_BYTES, see above

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(held.value, window)
            for batch in batches:
                for i, j, data, offsets in slices(batch, 1):
                    words = Words(data, offsets, CLASSES)
                    found = matcher.match(words)
                    n = j - i
                    hit, spans, ids = np.zeros(n, np.int64), [[] for _ in range(n)], [[] for _ in range(n)]
                    for doc, (ranges, names) in found.items():
                        hit[doc] = sum(y - x for x, y in ranges)
                        base, word = int(offsets[doc]), int(words.first[doc])
                        spans[doc] = [
                            (int(words.starts[x]) - base, int(words.ends[y - 1]) - base, x - word, y - word)
                            for x, y in ranges
                        ]
                        ids[doc] = sorted(names)
                    part = batch.slice(i, n)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            *[part.column(part.schema.get_field_index(k)) for k in carried],
                            pa.array(np.diff(words.first), pa.int64()),
                            pa.array(hit),
                            pa.array(spans, ARROW_SPANS),
                            pa.array(ids, pa.list_(pa.string())),
                        ],
                        names=found_type.names,
                    )

        return texts.mapInArrow(run, found_type)

    def part_of(k: int) -> list[tuple[str | None, str]]:
        rows = bench.filter(shard == k).collect()
        return [(r["id"], r["text"]) for r in rows]

    if shards == 1:
        found = scan(part_of(0), texts)
    else:
        found = joined([scan(part_of(k), texts) for k in range(shards)])
    ids = F.array_sort(F.array_distinct("items"))
    return found.select(
        F.col("id").alias(id_col),
        *[F.col(n).alias(k) for k, n in name.items()],
        "n_words",
        "n_hit",
        F.size(F.array_distinct("items")).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (part * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "spans",
        *([without_spans(F.col("_text"), cut_words or window).alias("kept_text")] if with_text else []),
    )


def without_spans(text: Column, least: int) -> Column:
    """The text without the bytes of spans of ``least`` words or more. Spans begin and end with
    words, hence with characters."""
    spans = F.filter(merged(F.col("spans")), lambda x: x["last_word"] - x["first_word"] >= least)
    body = text.cast("binary")

    def pieces(cut: Column) -> Column:
        def piece(i: Column) -> Column:
            low = F.coalesce(F.get(cut, i - 1)["end"], F.lit(0)).cast("int")
            high = F.coalesce(F.get(cut, i)["start"], F.octet_length(text)).cast("int")
            return F.substring(body, low + 1, F.greatest(high - low, F.lit(0))).cast("string")

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(cut)), piece), "")

    return F.when(F.size(spans) == 0, text).otherwise(F.transform(F.array(spans), pieces)[0])


def joined(found: list[DataFrame]) -> DataFrame:
    """The results of several shards as one. Only documents with hits are merged, by id and hash
    of the text; equal documents have equal hits, so merging them together changes nothing."""
    first, *others = [stage(f, "hits") for f in found]
    hit = reduce(DataFrame.unionByName, [f.filter("n_hit > 0") for f in others])
    more = hit.groupBy(F.col("id").alias("of"), F.col("_key").alias("of_key")).agg(
        F.flatten(F.collect_list("spans")).alias("more_spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("more_items"),
    )
    both = first.join(more, F.col("id").eqNullSafe(F.col("of")) & F.col("_key").eqNullSafe(F.col("of_key")), "left")
    with_more = lambda c: F.concat(c, F.coalesce(f"more_{c}", F.array().cast(first.schema[c].dataType)))
    both = both.withColumn("items", with_more("items"))
    both = both.withColumn("spans", merged(with_more("spans")))
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["last_word"] - x["first_word"])
    return both.withColumn("n_hit", words).drop("of", "of_key", "more_spans", "more_items", "_key")


def merged(spans: Column) -> Column:
    """Spans in order; one that touches the last of those so far is joined to it."""

    def add(done, x):
        last = F.get(done, F.size(done) - 1)
        wider = F.struct(
            last["start"].alias("start"),
            F.greatest(last["end"], x["end"]).alias("end"),
            last["first_word"].alias("first_word"),
            F.greatest(last["last_word"], x["last_word"]).alias("last_word"),
        )
        apart = (F.size(done) == 0) | (last["last_word"] < x["first_word"])
        return F.when(apart, F.concat(done, F.array(x))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))
        )

    return F.aggregate(F.array_sort(spans), F.array().cast(T.ArrayType(SPAN)), add)
