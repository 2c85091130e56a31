"""Spelling variants of a vocabulary: words one edit apart, grouped under their commonest form.

A word is the vector of its letter counts. One replaced letter moves it by a squared distance of
two, one inserted or deleted letter by one, so NumPy products of count blocks (Gram matrices) over
equal and adjacent lengths leave few pairs, whose edits are then verified letter by letter.

Blocks are narrower than lengths: letters fall into four classes, an edit changes at most two of
them, so two near words agree in the counts of some two classes. A word enters six blocks, one for
each two classes, and meets there the words with equal counts of both; a pair is reported only in
the block of the first two classes in which it agrees. Nothing but verified pairs leaves a task.
Blocks of over ``split_rows`` words are cut into tiles, each two of which are compared in a task
of their own.

Defined cases: null and empty texts have no words, and runs of a row with a null id lose no letter;
repeated rows count each time; words of any length are compared whole; among near words of equal
count the smallest in code-point order is the form; further columns are not looked at; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.functions.shipping import ship_package
from txwarden.functions.staging import quoted
from txwarden.llm.tables import settled

CLASSES = 4
KEYS = list(combinations(range(CLASSES), 2))

#: Words of a block that one task compares at once, and rows and columns of one Gram matrix.
SPLIT_ROWS = 20_000
TILE = 1024

#: Letters held at once while edits are verified.
VERIFIED = 4_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def corpus_words(
    df: DataFrame,
    *,
    runs: str = "[A-Za-zÀ-ÿ]+",
    least_chars: int = 5,
    least_count: int = 3,
    drop_every: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n): maximal ``runs`` of all texts, A-Z lower-cased, with at least ``least_chars`` code
    points and ``least_count`` occurrences. With ``drop_every`` k, a run whose CRC-32 with its row's
    id (``id:run``) is a multiple of k loses the letter at that number modulo its length."""
    text = F.translate(F.col(quoted(text_col)).cast("string"), UPPER, LOWER)
    found = df.select(
        F.col(quoted(id_col)).cast("string").alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(f"({runs})"), F.lit(0))).alias("run"),
    )
    word = F.col("run")
    if drop_every:
        mark = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = (mark % F.char_length("run")).cast("int")
        without = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        word = F.when(mark % drop_every == 0, without).otherwise(word)
    words = found.select(word.alias("word")).where(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def near_in_block(words: list[str], side: np.ndarray, two: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all near pairs of a block that agree in the classes ``two`` first. Where
    words have different ``side``, only pairs across are compared."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    words, lengths, side = [words[i] for i in order], lengths[order], side[order]
    across = bool(side.min() != side.max())
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    starts = np.cumsum(lengths) - lengths
    letters, place = np.unique(codes, return_inverse=True)
    k = len(letters)
    cells = np.repeat(np.arange(len(words)) * k, lengths) + place.ravel()
    kind = np.float32 if lengths[-1] < 2000 else np.float64  # whole numbers stay exact
    counts = np.bincount(cells, minlength=len(words) * k).reshape(-1, k).astype(kind)
    norm, one = (counts * counts).sum(1, keepdims=True), np.ones((len(words), 1), kind)
    left, right = np.hstack([-2 * counts, norm, one]), np.hstack([counts, one, norm])
    pairs = []
    for a in range(0, len(words), TILE):
        ends = np.searchsorted(lengths, lengths[min(a + TILE, len(words)) - 1] + 1, "right")
        for b in range(a, ends, TILE):
            apart = left[a : a + TILE] @ right[b : min(b + TILE, ends)].T  # squared distances
            i, j = np.nonzero((apart > 0) & (apart <= 2))
            i, j = i + a, j + b
            fits = (i < j) & (lengths[j] - lengths[i] <= 1)
            if across:
                fits &= side[i] != side[j]
            pairs.append((i[fits], j[fits]))
    i, j = (np.concatenate([p[x] for p in pairs]) for x in (0, 1))
    near = one_edit(codes, starts, lengths, i, j)
    i, j = i[near], j[near]
    moved = counts[i] != counts[j]
    agree = np.stack([~moved[:, letters % CLASSES == c].any(1) for c in range(CLASSES)], 1)
    first = agree & (agree.cumsum(1) <= 2)
    mine = first[:, two[0]] & first[:, two[1]]
    return order[i[mine]], order[j[mine]]


def one_edit(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether word j is word i with exactly one letter replaced, or inserted where j is longer."""
    near = np.zeros(len(i), bool)
    kinds = lengths[i] * 2 + (lengths[j] > lengths[i])
    for kind in np.unique(kinds):
        width, longer = divmod(int(kind), 2)
        rows = np.flatnonzero(kinds == kind)
        for at in range(0, len(rows), step := max(1, VERIFIED // (width + 1))):
            own = rows[at : at + step]
            a = codes[starts[i[own]][:, None] + np.arange(width)]
            b = codes[starts[j[own]][:, None] + np.arange(width + longer)]
            same = a == b[:, :width]
            if not longer:
                near[own] = same.sum(1) == width - 1
                continue
            behind = a == b[:, 1:]  # after the inserted letter
            before = np.logical_and.accumulate(same, 1)
            near[own] = (before | behind).all(1)
    return near


def near_pairs(words: DataFrame, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """(a, b, a_n, b_n), each pair of words of ``words`` (word, n) that are one edit apart, once."""
    ship_package(words.sparkSession)
    letters = F.split("word", "")

    def letters_of(kind: int):
        return F.array_join(F.array_sort(F.filter(letters, lambda x: F.ascii(x) % CLASSES == kind)), "")

    parts = words.select("word", "n", *[letters_of(c).alias(f"_c{c}") for c in range(CLASSES)])
    keys = [
        F.struct(F.lit(k).alias("two"), F.xxhash64(F.lit(k), f"_c{a}", f"_c{b}").alias("key"))
        for k, (a, b) in enumerate(KEYS)
    ]
    keyed = parts.select("word", "n", F.explode(F.array(*keys)).alias("_k")).select("_k.key", "_k.two", "word", "n")
    keyed = settled(keyed, "blocks")
    heavy = keyed.groupBy("key", "two").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > split_rows)
    tiles = F.ceil(F.col("_rows") * 2 / split_rows).cast("int")
    dealt = keyed.join(heavy.select("key", "two", tiles.alias("_tiles")), ["key", "two"], "left")
    own = F.pmod(F.xxhash64("word"), F.col("_tiles")).cast("int")
    others = F.sequence(F.lit(0), F.col("_tiles") - 1)
    whole = dealt.where(F.col("_tiles").isNull()).select(
        "key", "two", F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("side"), "word", "n"
    )
    cut = dealt.where(F.col("_tiles").isNotNull()).withColumn("side", own).withColumn("_o", F.explode(others))
    cut = cut.select("key", "two", F.least("side", "_o").alias("low"), F.greatest("side", "_o").alias("high"), "side", "word", "n")
    group = ["key", "two", "low", "high"]
    rows = whole.unionByName(cut).repartition(*group).sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # the last block may go on in the next batch
            keys = np.stack([batch.column(x).to_numpy() for x in range(4)], 1)
            if not len(keys):
                continue
            changes = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            if held and any(held[-1].column(x)[-1] != batch.column(x)[0] for x in range(4)):
                yield from _compared(held)
                held = []
            if not len(changes):
                held.append(batch)
                continue
            last = int(changes[-1])
            yield from _compared([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        yield from _compared(held)

    return rows.mapInArrow(run, "a string, b string, a_n long, b_n long")


def _compared(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of the blocks in ``batches``, which lie one after another."""
    if not batches:
        return
    table = pa.Table.from_batches(batches).combine_chunks()
    keys = np.stack([table.column(x).to_numpy() for x in range(4)], 1)
    bounds = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, len(keys)]
    side, word = table.column("side").to_numpy(), table.column("word")
    first: list[np.ndarray] = []
    second: list[np.ndarray] = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a < 2 or (keys[a, 2] != keys[a, 3] and side[a:b].min() == side[a:b].max()):
            continue
        i, j = near_in_block(word.slice(a, b - a).to_pylist(), side[a:b], KEYS[keys[a, 1]])
        if len(i):
            first.append(i + a)
            second.append(j + a)
    if first:
        one, two = (table.select(["word", "n"]).take(pa.array(np.concatenate(x))) for x in (first, second))
        columns = [one["word"], two["word"], one["n"], two["n"]]
        yield from pa.table(columns, names=["a", "b", "a_n", "b_n"]).to_batches(max_chunksize=50_000)


def variant_forms(words: DataFrame, times: int = 2, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """``words`` (word, n) with ``n_near`` (number of near words), ``form`` (the commonest near word,
    if it occurs at least ``times`` times as often, else null), ``form_n`` and ``root`` (the last of
    the forms that follow from a word, itself without any)."""
    words = settled(words, "words")
    pairs = settled(near_pairs(words, split_rows), "pairs")
    ways = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n"))
    ways = ways.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other"))
    near = ways.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    over = -F.col("best.minus") >= times * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(over, F.col("best.other")).alias("form"),
        F.when(over, -F.col("best.minus")).alias("form_n"),
    )
    found = settled(found, "forms")
    roots = last_forms(found.where(F.col("form").isNotNull()).select("word", "form"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms of forms until the last. Every round doubles the steps;
    counts grow along a chain by a factor, so rounds are few."""
    ahead = settled(forms.select("word", F.col("form").alias("root")), "ahead")
    while True:
        onward = ahead.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        moved = ahead.join(onward, F.col("root") == F.col("_w"), "left")
        moved = moved.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved"))
        moved = settled(moved, "ahead")
        ahead = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return ahead
