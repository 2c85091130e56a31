"""Quality rules and robust multivariate outliers, in DataFrame operations only.

Every text gives counts (words, characters in words, symbols, repeated lines, words in repeated
three-word windows). Fixed base rules come first. The counts, as transformed rates, form a
vector, and for each language and source a minimum-covariance-determinant estimate (the mean
and covariance of the three quarters of documents that lie closest together) gives squared
Mahalanobis distances; documents far out are rejected.

The estimate is found by concentration steps from two starts, medians with median absolute
deviations and the classical moments, until the determinant falls no more; the start that ends
with the least determinant counts. A step is one aggregation by language and source whose sums
are combined before the shuffle, so a source with a third of all rows costs its task no more than
any other, and the quantile of a step comes from counts of rounded distances, not from a sort.
A group of n documents weighs n against ``prior_rows`` of its language's estimate, and that
against the whole table's: one rule for groups of any size.

Defined cases: null and blank texts have no words and fail the base rules; a null language or
source is a value like any other; a statistic that never varies within a group counts with a
floor of variance, so equal rows are kept; repeated rows and ids are judged one by one; an
empty table gives an empty table. Columns not named in the call are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.functions.staging import quoted, stage

#: What a word, a blank and a symbol are.
WORD = r"[^\x20\x09-\x0D]++"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: A document is an outlier beyond the chi-square quantile of this normal value: generous,
#: because clean documents are to be kept and rates are no normal variables.
CUTOFF_Z = 6.0

#: Concentration stops where no logarithm of a determinant falls by more than this.
LEAST_FALL = 1e-3

#: Statistics of the vector, each with the smallest standard deviation it counts with: most
#: documents have no symbols or repeats at all, and one repeated line is no outlier. Each can
#: reject on its own: where nobody repeats, a ``repeat_rate`` above 0.435 lies beyond the cutoff.
VECTOR = {"mean_word": 0.25, "symbol_rate": 0.1, "line_rate": 0.25, "repeat_rate": 0.06}


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the array.

    Windows become 64-bit hashes. If any repeats, each hash keeps its high bits and takes the
    window's place as its low bits; sorted, equal windows are neighbours."""

    def count(w: Column) -> Column:
        last = F.size(w) - 3
        hashes = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )
        return F.when(last < 0, F.lit(0)).otherwise(let(hashes, from_hashes))

    def from_hashes(h: Column) -> Column:
        n = F.size(h)
        room = F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double") + 1))).cast("long")
        some = let(room, lambda m: let(F.sort_array(F.transform(h, lambda x, i: x - F.pmod(x, m) + i)), lambda s: covered(s, h, m)))
        return F.when(F.size(F.array_distinct(h)) == n, F.lit(0)).otherwise(some)

    def covered(s: Column, h: Column, m: Column) -> Column:
        at = lambda k: F.get(h, F.pmod(F.get(s, k), m).cast("int"))
        same = lambda x, j: F.coalesce(F.get(h, F.pmod(x, m).cast("int")) == at(j), F.lit(False))
        places = F.transform(s, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), F.pmod(x, m).cast("int")))
        return let(F.sort_array(F.filter(places, lambda p: p.isNotNull())), total)

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return let(words, count)


def with_counts(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    has_word = lambda x: F.translate(x, BLANKS, "") != ""
    lines = F.filter(F.split(body, "\n", -1), has_word)
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    both = lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("again"))
    df = df.withColumn("_w", let(words, both))
    return df.select(
        "*",
        F.col("_w.n").cast("long").alias("n_words"),
        F.char_length(F.translate(body, BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length(body) - F.char_length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.col("_w.again").cast("long").alias("n_repeat_words"),
    ).drop("_w")


def base_failed(least_words: int = 50, repeat_percent: int = 50) -> Column:
    few = F.col("n_words") < least_words
    return few | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def vector() -> dict[str, Column]:
    """Transformed statistics, none of which grows with the length of a text as such."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "mean_word": F.log(1 + F.col("word_chars") / n) * 4,
        "symbol_rate": F.log(1 + 10 * F.col("n_symbols") / n),
        "line_rate": F.log(1 + 100 * F.col("n_dup_lines") / n),
        "repeat_rate": F.col("n_repeat_words") / n,
    }


def by_histogram(df: DataFrame, keys: Sequence[str], bucket: Column, share: float) -> DataFrame:
    """Per key, the smallest bucket up to which ``share`` of the rows lie: exact for the rounded
    values, from one count per key and bucket."""
    counts = df.groupBy(*keys, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(*keys).orderBy("_bucket")
    upto = counts.select(
        *keys,
        "_bucket",
        F.sum("_n").over(along).alias("_upto"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_all"),
    )
    return upto.filter(F.col("_upto") >= share * F.col("_all")).groupBy(*keys).agg(F.min("_bucket").alias("_bucket"))


def with_factor(groups: DataFrame, names: list[str], extra: Sequence[str] = ("start",)) -> DataFrame:
    """Adds the Cholesky factor ``l_i_j`` of the covariance ``c_i_j``, column by column."""
    d = len(names)
    for j in range(d):
        square = sum((F.col(f"l_{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))
        floor = VECTOR[names[j]] ** 2
        groups = groups.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(F.col(f"c_{j}_{j}") - square, F.lit(floor))))
        for i in range(j + 1, d):
            inner = sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
            groups = groups.withColumn(f"l_{i}_{j}", (F.col(f"c_{i}_{j}") - inner) / F.col(f"l_{j}_{j}"))
    kept = [f"m_{i}" for i in range(d)] + [f"l_{i}_{j}" for j in range(d) for i in range(j, d)]
    return groups.select("level", "lang", "source", "n", *extra, *kept)


def with_distance(rows: DataFrame, groups: DataFrame, names: list[str], extra: Sequence[str] = ("g_n",), how: str = "inner") -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance, by forward substitution."""
    g = groups.withColumnsRenamed({"level": "g_level", "lang": "g_lang", "source": "g_source", "n": "g_n"})
    on = [F.col(k).eqNullSafe(F.col(f"g_{k}")) for k in ("level", "lang", "source")]
    out = rows.join(g, on, how)
    y: list[Column] = []
    for i, name in enumerate(names):
        rest = sum((F.col(f"l_{i}_{k}") * F.col(f"y_{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"y_{i}", (F.col(name) - F.col(f"m_{i}") - rest) / F.col(f"l_{i}_{i}"))
        y.append(F.col(f"y_{i}"))
    return out.withColumn("d2", sum((x * x for x in y), F.lit(0.0))).select(*rows.columns, *extra, "d2")


def moments(rows: DataFrame, names: list[str]) -> DataFrame:
    """Mean and covariance by level, language, source and start."""
    d = len(names)
    sums = [F.sum(x).alias(f"s_{i}") for i, x in enumerate(names)]
    sums += [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s_{i}_{j}") for j in range(d) for i in range(j, d)]
    g = rows.groupBy("level", "lang", "source", "start").agg(F.count(F.lit(1)).alias("h"), F.max("n_all").alias("n"), *sums)
    for i in range(d):
        g = g.withColumn(f"m_{i}", F.col(f"s_{i}") / F.col("h"))
    for j in range(d):
        for i in range(j, d):
            g = g.withColumn(f"c_{i}_{j}", F.col(f"s_{i}_{j}") / F.col("h") - F.col(f"m_{i}") * F.col(f"m_{j}"))
    return g


def chi2_quantile(d: int, z: float) -> float:
    """Wilson and Hilferty's approximation, for the quantile that a normal value ``z`` has."""
    return d * (1 - 2 / (9 * d) + z * math.sqrt(2 / (9 * d))) ** 3


def log_determinant(d: int) -> Column:
    return sum((F.log(F.col(f"l_{j}_{j}")) for j in range(d)), F.lit(0.0)) * 2


def mixed(own: str, parent: str, weight: float, d: int) -> Column:
    """Center ``m_i``, covariance ``c_i_j`` and ``scale`` of the mixture of a group's estimate, which
    weighs its rows, and its parent's, which weighs ``weight``."""
    a = F.col(f"{own}.n") / (F.col(f"{own}.n") + weight)
    mean = lambda name: a * F.col(f"{own}.{name}") + (1 - a) * F.col(f"{parent}.{name}")
    apart = [F.col(f"{own}.m_{i}") - F.col(f"{parent}.m_{i}") for i in range(d)]
    fields = [F.col(f"{own}.n").alias("n"), mean("scale").alias("scale")]
    fields += [mean(f"m_{i}").alias(f"m_{i}") for i in range(d)]
    for j in range(d):
        for i in range(j, d):
            fields.append((mean(f"c_{i}_{j}") + a * (1 - a) * apart[i] * apart[j]).alias(f"c_{i}_{j}"))
    return F.struct(*fields)


def robust_estimates(rows: DataFrame, *, steps: int, share: float, prior_rows: float) -> DataFrame:
    """Per language and source of ``rows`` (lang, source and the vector): center, Cholesky factor
    and ``scale``, which makes the median distance that of a chi-square variable."""
    names, d = list(VECTOR), len(VECTOR)
    groups = ["level", "lang", "source"]
    keys = [*groups, "start"]
    none = F.lit(None).cast("string")
    levels = F.array(
        F.struct(F.lit(0).alias("level"), F.col("lang"), F.col("source")),
        F.struct(F.lit(1).alias("level"), F.col("lang"), none.alias("source")),
        F.struct(F.lit(2).alias("level"), none.alias("lang"), none.alias("source")),
    )
    spread = rows.select(*names, F.explode(levels).alias("_k")).select(*names, "_k.*")
    other = lambda t, by: t.withColumnsRenamed({k: f"g_{k}" for k in by})
    on = lambda by: [F.col(k).eqNullSafe(F.col(f"g_{k}")) for k in by]
    less = lambda t, by: t.drop(*[f"g_{k}" for k in by])

    # One start: medians, and the median absolute deviations as scales of uncorrelated axes.
    axes = [*groups, "axis"]
    long = spread.select(*groups, F.posexplode(F.array(*names)).alias("axis", "x"))
    long = long.withColumn("cell", F.round(F.col("x") * 1000).cast("long"))
    mid = stage(by_histogram(long, axes, F.col("cell"), 0.5), "medians")
    mid = other(mid.withColumnRenamed("_bucket", "median"), axes)
    off = long.join(mid, on(axes)).withColumn("off", F.abs(F.col("cell") - F.col("median")))
    mad = by_histogram(off, [*axes, "median"], F.col("off"), 0.5)
    at = lambda i, c: F.max(F.when(F.col("axis") == i, F.col(c)))
    robust = mad.groupBy(*groups).agg(
        F.lit(0).alias("start"),
        *[(at(i, "median") / 1000).alias(f"m_{i}") for i in range(d)],
        *[F.pow(1.4826 * at(i, "_bucket") / 1000, F.lit(2.0)).alias(f"c_{i}_{i}") for i in range(d)],
        *[F.lit(0.0).alias(f"c_{i}_{j}") for j in range(d) for i in range(j + 1, d)],
    )
    # The other: the moments of all rows of the group.
    sized = spread.withColumns({"start": F.lit(1), "n_all": F.lit(0)})
    plain = stage(moments(sized, names).withColumn("n", F.col("h")), "classical")
    robust = less(robust.join(other(plain.select(*groups, "n"), groups), on(groups)), groups)
    model = stage(with_factor(robust.unionByName(plain.select(*robust.columns)), names), "start")

    fine = F.floor(F.log(F.col("d2") + 1e-6) * 100).cast("long")
    carried = ("g_n", "start")
    for step in range(steps):
        seen = with_distance(spread, model, names, carried).withColumn("cell", fine)
        cut = other(by_histogram(seen, keys, F.col("cell"), share).withColumnRenamed("_bucket", "edge"), keys)
        near = less(seen.join(cut, on(keys)), keys)
        near = near.filter(F.col("cell") <= F.col("edge")).withColumn("n_all", F.col("g_n"))
        closer = stage(with_factor(moments(near, names), names), f"step{step}")
        before = other(model.select(*keys, log_determinant(d).alias("det")), keys)
        fall = closer.join(before, on(keys)).agg(F.max(F.col("det") - log_determinant(d))).first()[0]
        model = closer
        if fall is None or fall < LEAST_FALL:
            break
    least = F.min_by(F.struct(*model.columns), F.struct(F.round(log_determinant(d), 9), "start"))
    model = stage(model.groupBy(*groups).agg(least.alias("p")).select("p.*"), "least")

    seen = with_distance(spread, model, names).withColumn("cell", fine)
    half = other(by_histogram(seen, groups, F.col("cell"), 0.5).withColumnRenamed("_bucket", "half"), groups)
    # A group whose middle lies at its floors has no spread to scale by.
    scale = F.greatest(F.exp((F.col("half") + 1) / 100) / chi2_quantile(d, 0.0), F.lit(1.0))
    covariance = [
        sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j + 1)), F.lit(0.0)).alias(f"c_{i}_{j}")
        for j in range(d)
        for i in range(j, d)
    ]
    final = model.join(half, on(groups))
    final = stage(final.select(*groups, "n", scale.alias("scale"), *[f"m_{i}" for i in range(d)], *covariance), "final")

    # Each group is mixed with its language, which is mixed with the whole table.
    own, by_lang, whole = (final.filter(F.col("level") == k) for k in (0, 1, 2))
    params = [c for c in final.columns if c not in groups]
    lang_table = by_lang.select(F.col("lang").alias("p1_lang"), F.struct(*params).alias("p1"), F.lit(1).alias("one"))
    lang_table = lang_table.join(whole.select(F.struct(*params).alias("p2"), F.lit(1).alias("one")), "one")
    lang_table = lang_table.select("p1_lang", mixed("p1", "p2", prior_rows, d).alias("p1"))
    wide = own.select("lang", "source", F.struct(*params).alias("p0"))
    wide = wide.join(lang_table, F.col("lang").eqNullSafe(F.col("p1_lang")))
    chosen = wide.select(F.lit(0).alias("level"), "lang", "source", mixed("p0", "p1", prior_rows, d).alias("p"))
    return stage(with_factor(chosen.select("level", "lang", "source", "p.*"), names, ("scale",)), "chosen")


def quality_verdicts(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_words: int = 50,
    repeat_percent: int = 50,
    steps: int = 5,
    share: float = 0.75,
    prior_rows: float = 200.0,
    cutoff_z: float = CUTOFF_Z,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per document: id, the columns of ``keep``, the five counts, ``base_failed``, ``d2`` and
    ``kept``. Estimates are made from documents that pass the base rules. With ``keep`` the counts
    are taken twice, for the estimates and with the other columns, rather than stored with them."""
    kept = [f"keep_{i}" for i in range(len(keep))]
    d = docs.select(
        F.col(quoted(id_col)).alias("id"),
        F.col(quoted(lang_col)).cast("string").alias("lang"),
        F.col(quoted(source_col)).cast("string").alias("source"),
        F.col(quoted(text_col)).alias("text"),
        *[F.col(quoted(k)).alias(c) for k, c in zip(keep, kept, strict=True)],
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    d = with_counts(d, F.col("text")).drop("text")
    d = d.withColumn("base_failed", base_failed(least_words, repeat_percent))
    slim = stage(d.drop(*kept), "counts")  # a few numbers a document; texts are not copied
    if not keep:
        d = slim
    names = list(VECTOR)
    with_vector = lambda t: t.select("*", *[c.alias(name) for name, c in vector().items()])
    sample = with_vector(slim.filter(~F.col("base_failed"))).select("lang", "source", *names)
    model = robust_estimates(sample, steps=steps, share=share, prior_rows=prior_rows)
    # Left: a language and source of which every document fails has no estimate.
    scored = with_distance(with_vector(d).withColumn("level", F.lit(0)), model, names, ["scale"], "left")
    distance = F.when(~F.col("base_failed"), F.col("d2") / F.col("scale"))
    limit = chi2_quantile(len(VECTOR), cutoff_z)
    return scored.select(
        F.col("id").alias(id_col),
        *[F.col(c).alias(k) for k, c in zip(keep, kept, strict=True)],
        *counts,
        "base_failed",
        distance.alias("d2"),
        F.coalesce(distance <= limit, F.lit(False)).alias("kept"),
    )
