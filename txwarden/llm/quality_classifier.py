"""Quality classifier on subword embeddings.

Words and character n-grams of a text are hashed to rows of one embedding table, as is a mark
for each word that repeats the one before it; a document is the mean of its rows, and a
softmax layer over that mean gives the probability of each label.
Table and layer are trained together by stochastic gradient descent in NumPy.

Since mean and layer are linear, a row's part in the log-odds of label 1 is one number, worked
out once after training: scoring adds up numbers, not vectors, and the broadcast model is one
float for each row of the table.

Training reads at most about ``sample_rows`` labelled documents, whole, picked by a hash of the
id; that bound is what limits the one task that trains. Scoring covers every whole text.

Defined cases: a null or empty text has no features and scores the model's bias; rows without
label, id or text teach nothing, nor do labels other than 0 and 1; without any labelled row
every score is 0.5; a document with several labels teaches each; repeated rows are scored one
by one; an empty table gives an empty table. Columns not named in the call are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.functions.shipping import ship_package
from txwarden.functions.staging import quoted
from txwarden.llm.bytes_np import BYTE_CODES, TILE, Rolling, Words, byte_classes, offsets_of, slices, utf8

#: Rows of the table (a power of two), numbers in a row, and sizes of character n-grams.
BITS, WIDTH, NGRAMS = 17, 16, (3, 5)
BLANK = bytes([0x20, *range(0x09, 0x0E)])
CLASSES = byte_classes(BLANK)
#: The same, with every blank as one and the same character.
SPACED = np.where(CLASSES == 0, 0x20, CLASSES).astype(np.uint8)


def rows_of(hashes: np.ndarray, kind: int) -> np.ndarray:
    """Table rows of hashed features; kinds of features fall to different rows."""
    salt = np.uint64(0x9E3779B97F4A7C15 * (2 * kind + 1) & (1 << 64) - 1)
    return ((hashes * salt) >> np.uint64(64 - BITS)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: its table rows in order of texts, and each text's first."""
    words = Words(data, offsets, CLASSES)
    yield rows_of(words.hashes, 0), words.first
    again = np.zeros(len(words.hashes), bool)
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    again[words.first[:-1][np.diff(words.first) > 0]] = False
    marks = np.concatenate([[0], np.cumsum(again)])
    yield np.full(marks[-1], rows_of(np.ones(1, np.uint64), 1)[0]), marks[words.first]
    rolling = Rolling(BYTE_CODES[SPACED[data]])
    for n in NGRAMS:
        rows = rows_of(rolling.windows(n), n)
        counts = np.maximum(np.diff(offsets) - n + 1, 0)
        inside = np.zeros(len(data) + 1, np.int64)  # places where a gram stays in its text
        full = counts > 0
        inside[offsets[:-1][full]] += 1
        np.add.at(inside, (offsets[:-1] + counts)[full], -1)
        yield rows[np.cumsum(inside[: len(rows)]) > 0], offsets_of(counts)


def cut_long(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A text longer than a tile in pieces, each ending at a blank if one is near."""
    if len(offsets) != 2 or len(data) <= TILE:
        yield data, offsets
        return
    low = 0
    while low < len(data):
        high = min(low + TILE, len(data))
        blanks = np.flatnonzero(CLASSES[data[max(low, high - 4096) : high]] == 0)
        if high < len(data) and len(blanks):
            high = max(low, high - 4096) + int(blanks[-1]) + 1
        yield data[low:high], np.array([0, high - low])
        low = high


def mean_parts(data: np.ndarray, offsets: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The mean over a text's features of ``part[row]``; 0 without features."""
    total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
    for piece, at in cut_long(data, offsets):
        for rows, first in features(piece, at):
            sums = np.concatenate([[0.0], np.cumsum(part[rows], dtype=np.float64)])
            total += sums[first[1:]] - sums[first[:-1]]
            count += np.diff(first)
    return total / np.maximum(count, 1)


def fit(texts: pa.Array, labels: np.ndarray, *, epochs: int, rate: float, batch: int, seed: int = 1) -> tuple[np.ndarray, float]:
    """Each table row's part in the log-odds, and the bias."""
    data, offsets = utf8(texts)
    rows, counts, first = [], [], [0]
    for i in range(len(labels)):
        found = [
            r for piece, at in cut_long(data[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
            for r, _ in features(piece, at)
        ]
        r, n = np.unique(np.concatenate(found), return_counts=True)
        rows.append(r.astype(np.int32))
        counts.append((n / max(n.sum(), 1)).astype(np.float32))
        first.append(first[-1] + len(r))
    rows, counts, first = np.concatenate(rows), np.concatenate(counts), np.array(first)
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, 2), np.float32)
    bias = np.zeros(2, np.float32)
    steps, step = epochs * -(-len(labels) // batch), 0
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for at in range(0, len(order), batch):
            docs = order[at : at + batch]
            eta = rate * (1 - step / steps)
            step += 1
            size = first[docs + 1] - first[docs]
            place = np.repeat(first[docs] - offsets_of(size)[:-1], size) + np.arange(size.sum())
            r, x = rows[place], counts[place][:, None]
            owner = np.repeat(np.arange(len(docs)), size)
            mean = np.zeros((len(docs), WIDTH), np.float32)
            full = size > 0
            if full.any():
                mean[full] = np.add.reduceat(table[r] * x, offsets_of(size)[:-1][full])
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(docs)), labels[docs]] -= 1  # gradient of the loss
            back = (p @ layer.T)[owner]
            layer -= eta * (mean.T @ p) / len(docs)
            bias -= eta * p.mean(0)
            # The mean's gradient reaches a row through its share; a document's rows together
            # move the mean by about the rate, whatever the document's length.
            spread = x / np.maximum(np.bincount(owner, counts[place] ** 2, len(docs)), 1e-9)[owner][:, None]
            np.add.at(table, r, (-eta / len(docs)) * back * spread.astype(np.float32))
    return (table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, sample_rows: int, id_col: str, text_col: str, label_id: str, label_col: str, epochs: int, rate: float, batch: int) -> tuple[np.ndarray, float] | None:
    """Train in one task on the sample; None without labelled rows. Labels other than 0 and 1 teach
    nothing, equal labels of one id count once. The sample is drawn by id; should ids repeat in the
    documents, the ``2 * sample_rows`` rows of least hash stay, so that no id makes the task grow."""
    known = labels.select(
        F.col(quoted(label_id)).alias("label_id"), F.col(quoted(label_col)).try_cast("double").alias("label")
    ).filter("label in (0, 1) and label_id is not null")
    known = known.filter(learn).withColumn("label", F.col("label").cast("int")).distinct()
    n = known.count()
    u = F.pmod(F.xxhash64(F.col("label_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    picked = known.filter(u * n < sample_rows)
    texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))
    if picked.count() <= 10 * sample_rows:  # else one id has most labels
        picked = F.broadcast(picked)
    sample = texts.join(picked, F.col("id") == F.col("label_id")).filter("text is not null")
    sample = sample.orderBy(F.xxhash64("id", "text", "label"), "id", "label").limit(2 * sample_rows)

    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("label").to_numpy(), table.column("id").cast(pa.string()).to_numpy(False).astype(str)))
        table = table.take(pa.array(order))
        text = table.column("text")
        part, bias = fit(
            pa.concat_arrays(text.chunks), table.column("label").to_numpy(), epochs=epochs, rate=rate, batch=batch
        )
        return pa.table({"part": pa.array([part.tobytes()]), "bias": [bias]})

    model = sample.groupBy(F.lit(0).alias("all")).applyInArrow(run, "part binary, bias double").collect()
    return (np.frombuffer(model[0]["part"], np.float32), model[0]["bias"]) if model else None


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    *,
    sample_rows: int = 4000,
    epochs: int = 8,
    rate: float = 0.5,
    batch: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """Per document: id and ``score``, the probability of label 1. ``learn`` is a condition on
    ``label_id``, the id of a labelled row, that says which rows may teach."""
    ship_package(docs.sparkSession)
    model = train(
        docs, labels, learn, sample_rows=sample_rows, id_col=id_col, text_col=text_col,
        label_id=label_id, label_col=label_col, epochs=epochs, rate=rate, batch=batch,
    )
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in slices(batch, 1):
                score = np.full(j - i, 0.5)
                if held.value is not None:
                    part, bias = held.value
                    score = 1 / (1 + np.exp(-(mean_parts(data, offsets, part) + bias)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(score)], schema.names)

    texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))
    return texts.mapInArrow(run, schema).withColumnRenamed("id", id_col)
