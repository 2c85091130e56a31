"""Perspective rotation: render a dialogue once for each of its participants.

For a participant, its own turns are the assistant's, those of all others come from users who
carry their names, system turns stay system turns, and the mask covers what the assistant
says, so that every speaker of a multi-party dialogue can be learned from.

A result row is a segment of a dialogue: the turns ranked 0 to 1 023, 1 024 to 2 047 and so on by
their order (``SEGMENT_ROWS``), however they are numbered, so that any ordinary dialogue is one
row a participant and no gathered group exceeds a bound, whatever a key holds. Dialogues of one
segment are gathered and rotated where they meet; only longer ones are ranked, over ranges of
(dialogue, order). DataFrame functions only.

Defined cases: order is by turn, null turns last, then by the MD5 of role and text; a null
role speaks as ``unknown``; a null text is empty; system turns (any case) are never a
participant, and a dialogue of system turns only gives no rows; a null conversation id is an
id like any other; repeated rows are repeated turns; an empty table gives an empty table. Columns not named
in the call are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.functions.ranges import with_running_total
from txwarden.functions.staging import Staging, quoted

#: Turns in a segment.
SEGMENT_ROWS = 1024
UNKNOWN = "unknown"

# Marks of the rendered text.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def participants(said: Column) -> Column:
    """Roles that speak in ``said``, system aside."""
    return F.array_distinct(F.transform(F.filter(said, lambda x: F.lower(x["role"]) != "system"), lambda x: x["role"]))


def gathered(turns: DataFrame, *keys: str) -> DataFrame:
    return turns.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("late", "turn", "place", "role", "text"))).alias("said"))


def long_segments(turns: DataFrame, staging: Staging) -> DataFrame:
    """(conv, speaker, segment, offset, said) of dialogues that have several segments.

    A segment's length differs between speakers only by the heads of the speaker's own turns, so
    offsets come from sums over turns, and rendered texts are never sorted."""
    key = F.coalesce(F.concat(F.lit("v"), F.col("conv").cast("string")), F.lit("n"))
    order = F.struct("late", "turn", "place")
    t = turns.withColumns({"key": key, "order": order, "one": F.lit(1)})
    t = with_running_total(t, ["key"], "order", "one", "rank", staging)
    t = staging.write(t.withColumn("segment", F.floor((F.col("rank") - 1) / SEGMENT_ROWS)), "ranked")
    system = F.lower("role") == "system"
    as_user = F.when(system, len("system")).otherwise(len("user name=") + F.char_length("role"))
    size = len(OPEN) + as_user + 1 + F.char_length("text") + len(CLOSE)
    own = t.filter(~system).groupBy("key", "role", "segment").agg(F.count(F.lit(1)).alias("own"))
    speakers = staging.write(own.select("key", F.col("role").alias("speaker")).distinct(), "speakers")
    sizes = t.groupBy("key", "segment").agg(F.sum(size).alias("size"))
    upto = Window.partitionBy("key").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("key", "segment", F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("before"))
    rows = sizes.join(speakers, "key").join(own.withColumnRenamed("role", "speaker"), ["key", "speaker", "segment"], "left")
    mine = Window.partitionBy("key", "speaker").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    shorter = len("user name=") + F.char_length("speaker") - len("assistant")
    offset = F.col("before") - F.coalesce(F.sum("own").over(mine), F.lit(0)) * shorter
    rows = rows.select("key", "segment", "speaker", offset.cast("long").alias("offset"))
    said = gathered(t, "key", "conv", "segment")
    return said.join(rows, ["key", "segment"]).select("conv", "speaker", "segment", "offset", "said")


def segments(turns: DataFrame) -> DataFrame:
    """(conv, speaker, segment, offset, said) of all dialogues, ``said`` of bounded length."""
    place = F.md5(F.concat("role", F.lit("\x01"), "text"))
    t = turns.withColumns({"late": F.col("turn").isNull(), "place": place})
    staging = Staging(turns.sparkSession)
    many = t.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SEGMENT_ROWS)
    many = staging.write(many.select(F.col("conv").alias("m_conv")), "long")
    same = F.col("conv").eqNullSafe(F.col("m_conv"))
    zero = F.lit(0).cast("long")
    rows = gathered(t.join(many, same, "left_anti"), "conv")
    rows = rows.select("conv", F.explode(participants(F.col("said"))).alias("speaker"), zero.alias("segment"), zero.alias("offset"), "said")
    if many.isEmpty():
        return rows
    return rows.unionByName(long_segments(t.join(many, same, "left_semi"), staging))


def rendered(said: Column, speaker: Column) -> Column:
    """Messages of a segment as seen by ``speaker``: role, name, head of the text and content."""

    def message(x: Column) -> Column:
        system = F.lower(x["role"]) == "system"
        role = F.when(system, "system").when(x["role"] == speaker, "assistant").otherwise("user")
        name = F.when(role == "user", x["role"])
        head = F.concat(F.lit(OPEN), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
        return F.struct(role.alias("role"), name.alias("name"), head.alias("head"), x["text"].alias("content"))

    return F.transform(said, message)


def rotate_perspectives(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per conversation, participant and segment: ``perspective``, ``segment`` (from 0), ``offset`` of the
    segment in the whole rendering, ``messages`` (role, name, content), ``text``, and ``mask``,
    the ranges of characters of the segment's text that the assistant says, end mark included."""
    t = turns.select(
        F.col(quoted(conv_col)).alias("conv"),
        F.col(quoted(turn_col)).cast("long").alias("turn"),
        F.coalesce(F.col(quoted(role_col)).cast("string"), F.lit(UNKNOWN)).alias("role"),
        F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text"),
    )
    rows = segments(t).withColumn("m", rendered(F.col("said"), F.col("speaker")))
    size = lambda x: F.char_length(x["head"]) + F.char_length(x["content"]) + len(CLOSE)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("mask"))

    def step(done: Column, x: Column) -> Column:
        end = done["at"] + size(x)
        span = F.struct((done["at"] + F.char_length(x["head"])).alias("start"), end.alias("end"))
        mask = F.when(x["role"] == "assistant", F.concat(done["mask"], F.array(span))).otherwise(done["mask"])
        return F.struct(end.alias("at"), mask.alias("mask"))

    rows = rows.withColumn("walk", F.aggregate("m", start, step))
    text = F.array_join(F.transform("m", lambda x: F.concat(x["head"], x["content"], F.lit(CLOSE))), "")
    return rows.select(
        F.col("conv").alias(conv_col),
        F.col("speaker").alias("perspective"),
        "segment",
        "offset",
        F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["name"].alias("name"), x["content"].alias("content"))).alias("messages"),
        text.alias("text"),
        F.col("walk.mask").alias("mask"),
    )
