"""Mix sources to target weights by Pareto order sampling.

Every source gets a target in words: the total is shared by weight, no source above
``max_copies`` times its own size, the excess going to the others by weight (one water level).
A document of a source that needs ``r`` times its size is taken ``floor(r)`` times for certain;
the rest, a fraction ``p``, is a fixed-size sample in which documents are ranked by their
random odds over their inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, smallest first.
``u`` comes from a hash of the id, so reruns and other partitionings agree.

No source is sorted in one task: ranks are counted in buckets, the bucket in which the target
is reached is found from the counts, and only its documents, a bounded number, are ordered.

Defined cases: null or blank text has size 0 and takes 0 words; a null source is a source of
its own, last in order; documents with the same id share ``u`` and are ordered by size, then by a hash
of the text, so that only equal rows change places; with null ids ``u`` comes from the text; an
empty table gives an empty table. Columns not named in the call are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.functions.staging import quoted, stage

#: Buckets of ranks at least, and documents of a bucket near the target on average at most.
BUCKETS, IN_BUCKET = 1024, 20_000
#: A word: anything but blanks, tabs and line ends.
WORD = r"[^\x20\x09-\x0D]++"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: Column) -> Column:
    """A number strictly between 0 and 1 from 52 bits of a hash."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sources: DataFrame, weights: Sequence[int], max_copies: int) -> DataFrame:
    """Adds ``target`` to a table of ``source`` and ``source_size``, a row for each source. The
    windows run over that table only, after aggregation."""
    everywhere = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    s = sources.withColumn(
        "weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)).cast("long")
    ).withColumn("cap", F.col("source_size") * max_copies)
    fullest = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    s = (
        s.withColumn("total", F.sum("source_size").over(everywhere))
        .withColumn("capped", F.sum("cap").over(fullest) - F.col("cap"))
        .withColumn("open", F.sum("weight").over(everywhere) - F.sum("weight").over(fullest) + F.col("weight"))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
        .withColumn("place", F.row_number().over(fullest))
    )
    # Sources before the first one whose cap holds its level are full; that level is the rest's.
    holds = F.col("cap") >= F.col("weight") * F.col("level")
    s = s.withColumn("water", F.min(F.when(holds, F.struct("place", "level"))).over(everywhere)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("water"))
    return s.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def pareto_mix(
    docs: DataFrame,
    *,
    weights: Sequence[int] = (1, 2, 3),
    max_copies: int = 3,
    seed: int = 0,
    importance: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per document: id, the columns of ``keep``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` words.

    ``importance`` makes probabilities unequal within a source too: expected copies are
    multiplied by it (mean 1 by words is expected) and cut at ``max_copies``."""
    text = F.col(quoted(text_col)).cast("string")
    name = F.col(quoted(id_col))
    base = docs.select(
        name.alias("id"),
        F.col(quoted(source_col)).cast("string").alias("source"),
        word_count(text).alias("size"),
        uniform(F.lit(str(seed)), F.coalesce(name.cast("string"), F.md5(text))).alias("u"),
        F.xxhash64(text).alias("tie"),
        (F.lit(1.0) if importance is None else importance.cast("double")).alias("importance"),
        *[F.col(quoted(k)).alias(f"keep_{i}") for i, k in enumerate(keep)],
    )
    base = stage(base, "sizes")  # a few numbers a document; texts are read once
    rows = base.count()
    buckets = max(BUCKETS, rows // IN_BUCKET)

    sources = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sources, weights, max_copies), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    d = base.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    d = d.withColumn("copies_expected", F.least(ratio * F.col("importance"), F.lit(float(max_copies))))
    d = d.withColumn("whole", F.floor("copies_expected").cast("long")).withColumn(
        "p", F.col("copies_expected") - F.col("whole")
    )
    odds = F.col("p") / (1 - F.col("p"))
    d = d.withColumn("rank", F.when(F.col("p") > 0, F.col("u") / (1 - F.col("u")) / odds))
    place = F.floor(F.col("rank") / (1 + F.col("rank")) * buckets).cast("long")
    d = d.withColumn("bucket", F.least(place, F.lit(buckets - 1))).select(
        "id", "source", "size", "tie", "source_size", "target", "whole", "p", "rank", "bucket", *[f"keep_{i}" for i in range(len(keep))]
    )

    counts = (
        d.filter(F.col("p") > 0)
        .groupBy("source", "bucket")
        .agg(F.sum("size").alias("words"), F.sum(F.col("p") * F.col("size")).alias("wanted"))
    )
    along = Window.partitionBy("source").orderBy("bucket")
    cut = (
        counts.withColumn("upto", F.sum("words").over(along))
        .withColumn("quota", F.sum("wanted").over(Window.partitionBy("source")))
        .filter(F.col("upto") >= F.col("quota"))
        .groupBy("source")
        .agg(
            F.min("bucket").alias("edge"),
            F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before")))["before"].alias("before"),
            F.first("quota").alias("quota"),
        )
        .withColumnRenamed("source", "cut_of")
    )
    d = d.join(stage(cut, "edges"), F.col("source").eqNullSafe(F.col("cut_of")), "left").drop("cut_of")

    sure = d.filter(~F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False)))
    sure = sure.withColumn("extra", F.coalesce(F.col("bucket") < F.col("edge"), F.lit(False)))
    edge = d.filter(F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False)))
    order = Window.partitionBy("source").orderBy("rank", F.col("id").asc_nulls_last(), "size", "tie")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    # A document goes in if at least half of it lies below the quota.
    middle = F.col("before") + upto - F.col("size") / 2
    edge = edge.withColumn("extra", middle < F.col("quota"))
    out = sure.unionByName(edge)
    copies = F.col("whole") + F.col("extra").cast("long")
    return out.select(
        F.col("id").alias(id_col),
        *[F.col(f"keep_{i}").alias(k) for i, k in enumerate(keep)],
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
