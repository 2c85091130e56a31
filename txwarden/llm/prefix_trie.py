"""Prefix trie of conversations, collapsed to whole sequences first.

Identical conversations become one weighted sequence with a list of the conversations that end
there. Sequences that are a proper prefix of another are found by an anti-join; what is left are
the leaves. Only then are prefixes made, one row for each prefix of each distinct sequence, and
every figure of a node is a sum over the weighted rows that share its key:

* members: sum of the weights; smallest member: smallest representative;
* leaves below: number of leaf sequences;
* a node is *owned* by the sequence with its smallest member. What a sequence owns reaches from
  some depth down to its end, so children and subtree sums need no walk over the tree: a child is
  counted at its owner's row one level above, and the texts below a node are the parts that the
  sequences through it own.

A prefix is known by its depth and two 64-bit sums (exclusive or) of its turns' hashes, each of
which also takes the turn's place. Such sums can be put together from parts, so a conversation
of any length is cut over tasks: rows are dealt by ranges of (conversation, turn), numbered and
summed within a range, and the few ranges of a conversation are put in order afterwards.

Defined cases: rows without a conversation id belong to no conversation; null roles and texts
count as empty; turns are ordered by number, null first, equal numbers by a hash of role and text;
repeated rows are turns of their own; further columns are not looked at; an empty table gives no
nodes, not even a root. Conversation ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.functions.shipping import ship_package
from txwarden.functions.staging import quoted
from txwarden.llm.tables import settled

#: A row of an end list holds the ids that agree but for so many bits.
END_BITS = 16

KEY = ("depth", "key_a", "key_b")


@dataclass(frozen=True)
class Trie:
    """``nodes``: one row each, with its key (depth, key_a, key_b). ``ends``: the conversations
    that end at a node, ascending, in rows of (key, chunk, conv_ids)."""

    nodes: DataFrame
    ends: DataFrame


def _upto(by: str, *order: str) -> Window:
    return Window.partitionBy("_part", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def _before(by: str) -> Window:
    return Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def ordered_turns(
    df: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, pos from 1, digest of role and text, chars of the text, _part). ``_part`` is the
    range a row was dealt to; ranges follow the order, so a long conversation has several."""
    role, text = (F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = df.where(F.col(quoted(conv_col)).isNotNull()).select(
        F.col(quoted(conv_col)).cast("long").alias("conv_id"),
        F.col(quoted(turn_col)).alias("turn"),
        F.unhex(F.md5(whole)).alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ("turn", "digest", "_row")
    dealt = turns.repartitionByRange("conv_id", *order).withColumn("_part", F.spark_partition_id())
    dealt = settled(dealt, "dealt")
    inside = dealt.withColumn("_i", F.row_number().over(Window.partitionBy("_part", "conv_id").orderBy(*order)))
    sizes = dealt.groupBy("_part", "conv_id").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.coalesce(F.sum("_n").over(_before("conv_id")), F.lit(0))
    starts = sizes.select("_part", "conv_id", earlier.alias("_start"))
    pos = (F.col("_i") + F.col("_start")).alias("pos")
    return inside.join(starts, ["_part", "conv_id"]).select("conv_id", pos, "digest", "chars", "_part")


def with_shared_heads(
    turns: DataFrame,
    head_of: Callable[[Column], Column],
    length: Callable[[Column], Column],
    most: int,
) -> DataFrame:
    """Conversations rebuilt from :func:`ordered_turns`: the first ``length(c)`` (at most ``most``)
    turns of conversation ``head_of(c)``, all if it has fewer, then c's own turns after as many.
    Columns as before; conversations that are left without turns have one row with null ``pos``."""
    first = F.struct("pos", "digest", "chars")
    heads = (
        turns.where((F.col("pos") <= most) & (head_of(F.col("conv_id")) == F.col("conv_id")))
        .groupBy(F.col("conv_id").alias("_from"))
        .agg(F.sort_array(F.collect_list(first)).alias("_heads"))
    )
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("_own"))
    cut = length(F.col("conv_id")).cast("int")
    convs = convs.select("conv_id", "_own", cut.alias("_cut"), head_of(F.col("conv_id")).alias("_from"))
    convs = convs.join(heads, "_from", "left")
    shared = F.slice(F.coalesce("_heads", F.array().cast(heads.schema["_heads"].dataType)), F.lit(1), F.col("_cut"))
    convs = convs.select("conv_id", "_own", "_cut", shared.alias("_heads"))
    convs = settled(convs.withColumn("_kept", F.size("_heads")), "heads")
    tails = turns.join(convs.select("conv_id", "_cut", "_kept"), "conv_id").where(F.col("pos") > F.col("_cut"))
    moved = (F.col("pos") - F.col("_cut") + F.col("_kept")).alias("pos")
    tails = tails.select("conv_id", moved, "digest", "chars", "_part")
    front = convs.select("conv_id", F.explode("_heads").alias("_h")).select(
        "conv_id", F.col("_h.pos").alias("pos"), "_h.digest", "_h.chars", F.lit(-1).alias("_part")
    )
    bare = convs.where((F.col("_kept") == 0) & (F.col("_own") <= F.col("_cut"))).select(
        "conv_id",
        F.lit(None).cast("long").alias("pos"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("chars"),
        F.lit(-1).alias("_part"),
    )
    return tails.unionByName(front).unionByName(bare)


def prefix_rows(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prefixes, conversations): the key of every prefix of at least one turn with the characters
    up to its end, and of every whole conversation."""
    turns = settled(turns, "rebuilt")
    real = turns.where(F.col("pos").isNotNull())
    tagged = real.withColumns(
        {"_a": F.xxhash64("pos", "digest"), "_b": F.xxhash64("digest", "pos", F.lit(1))}
    )
    inside = _upto("conv_id", "pos")
    running = tagged.select(
        "conv_id", "_part", "pos", "digest", "chars", "_a", "_b",
        F.bit_xor("_a").over(inside).alias("_ia"),
        F.bit_xor("_b").over(inside).alias("_ib"),
        F.sum("chars").over(inside).alias("_ic"),
    )
    sums = tagged.groupBy("_part", "conv_id").agg(
        F.bit_xor("_a").alias("_sa"),
        F.bit_xor("_b").alias("_sb"),
        F.sum("chars").alias("_sc"),
        F.count(F.lit(1)).alias("_sn"),
    )
    sums = settled(sums, "sums")
    zero = F.lit(0).cast("long")
    starts = sums.select(
        "_part", "conv_id",
        *[F.coalesce(f(s).over(_before("conv_id")), zero).alias(f"_p{s[2]}")
          for f, s in ((F.bit_xor, "_sa"), (F.bit_xor, "_sb"), (F.sum, "_sc"))],
    )
    key_a, key_b = (F.col(f"_p{x}").bitwiseXOR(F.col(f"_i{x}")) for x in "ab")
    prefixes = running.join(starts, ["_part", "conv_id"]).select(
        "conv_id",
        F.col("pos").cast("long").alias("depth"),
        key_a.alias("key_a"),
        key_b.alias("key_b"),
        key_a.bitwiseXOR(F.col("_a")).alias("up_a"),
        key_b.bitwiseXOR(F.col("_b")).alias("up_b"),
        "digest",
        "chars",
        (F.col("_pc") + F.col("_ic")).alias("upto"),
    )
    whole = sums.groupBy("conv_id").agg(
        F.sum("_sn").alias("depth"),
        F.bit_xor("_sa").alias("key_a"),
        F.bit_xor("_sb").alias("key_b"),
        F.sum("_sc").alias("total"),
    )
    bare = turns.where(F.col("pos").isNull()).select(
        "conv_id", zero.alias("depth"), zero.alias("key_a"), zero.alias("key_b"), zero.alias("total")
    )
    return prefixes, settled(whole.unionByName(bare), "conversations")


def prefix_trie(turns: DataFrame) -> Trie:
    """The trie of conversations given as :func:`ordered_turns` or :func:`with_shared_heads`.

    Nodes: key, ``digest`` of the last turn, ``conv_id`` (smallest member), ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the subtree) and ``saved_tokens``
    (over the subtree, what storing each text once saves, in characters)."""
    prefixes, whole = prefix_rows(turns)
    sequences = settled(
        whole.groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("first"), F.max("total").alias("total")
        ),
        "sequences",
    )
    own = sequences.select(F.col("first").alias("conv_id"), "weight", F.col("depth").alias("n"), "total")
    zero = F.lit(0).cast("long")
    roots = own.select(
        "conv_id", "weight", "n", zero.alias("depth"), zero.alias("key_a"), zero.alias("key_b"),
        zero.alias("up_a"), zero.alias("up_b"), F.lit(None).cast("binary").alias("digest"), F.col("total").alias("rest"),
    )
    rest = F.col("total") - F.col("upto") + F.col("chars")  # characters from this depth on
    rows = prefixes.join(own, "conv_id").select(
        "conv_id", "weight", "n", *KEY, "up_a", "up_b", "digest", rest.alias("rest")
    )
    rows = settled(rows.unionByName(roots), "prefixes")

    inner = rows.where(F.col("depth") < F.col("n")).select(*KEY).distinct()
    leaves = sequences.join(inner, list(KEY), "left_anti").select(
        F.col("first").alias("conv_id"), F.lit(1).alias("leaf")
    )
    owner = rows.groupBy(*KEY).agg(F.min(F.struct("conv_id", "rest")).alias("o"))
    owned = owner.groupBy(F.col("o.conv_id").alias("conv_id")).agg(
        F.min(F.struct("depth", F.col("o.rest").alias("rest"))).alias("_top")
    )
    top, deep = F.col("_top.depth"), F.col("depth")
    mine = F.when(top.isNull(), 0).when(deep >= top, F.col("rest")).otherwise(F.col("_top.rest"))
    child = (deep < F.col("n")) & F.coalesce(deep + 1 >= top, F.lit(False))
    marked = rows.join(owned, "conv_id", "left").join(leaves, "conv_id", "left")
    nodes = marked.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("digest").alias("digest"),
        F.min("up_a").alias("up_a"),
        F.min("up_b").alias("up_b"),
        F.sum("weight").alias("n_convs"),
        F.sum(child.cast("long")).alias("n_children"),
        F.sum(F.coalesce("leaf", F.lit(0)).cast("long")).alias("n_leaves"),
        F.sum(F.col("weight") * F.col("rest") - mine).alias("saved_tokens"),
    )
    nodes = settled(nodes, "nodes")
    parents = nodes.select(
        (deep + 1).alias("depth"),
        F.col("key_a").alias("up_a"),
        F.col("key_b").alias("up_b"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    nodes = nodes.join(parents, ["depth", "up_a", "up_b"], "left").drop("up_a", "up_b")

    chunk = F.shiftright("conv_id", END_BITS).alias("chunk")
    ends = whole.groupBy(*KEY, chunk).agg(F.sort_array(F.collect_list("conv_id")).alias("conv_ids"))
    return Trie(nodes, ends)


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the ids of an end list, comma-joined. A list is read chunk by
    chunk, so that no task holds a whole one."""
    ship_package(ends.sparkSession)
    rows = ends.select(*KEY, "chunk", F.array_join(F.col("conv_ids").cast("array<string>"), ",").alias("ids"))
    rows = rows.repartition(*KEY).sortWithinPartitions(*KEY, "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            done: list[tuple] = []
            for key, ids in zip(keys, batch.column(4).to_pylist(), strict=True):
                if key == last:
                    state.update(b",")
                else:
                    if last is not None:
                        done.append((*last, state.hexdigest()))
                    last, state = key, hashlib.sha256()
                state.update(ids.encode())
            yield _digests(done)
        if last is not None:
            yield _digests([(*last, state.hexdigest())])

    return rows.mapInArrow(run, "depth long, key_a long, key_b long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*KEY, "ends_sha256"]
    )


def turn_texts(
    nodes: DataFrame, conversations: DataFrame, *, role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``nodes`` with the ``role`` and ``text`` of their last turn; null at the root."""
    role, text = (F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    said = conversations.select(F.unhex(F.md5(whole)).alias("digest"), role.alias("role"), text.alias("text"))
    said = said.groupBy("digest").agg(F.min(F.struct("role", "text")).alias("_t"))
    return nodes.join(said, "digest", "left").select(*nodes.columns, "_t.role", "_t.text")
