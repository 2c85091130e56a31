"""Language identification by partial matching.

For every language, the training texts give a tree of byte contexts of up to ``order`` bytes with
the counts of the bytes that follow. A byte costs the bits of its probability in the longest
context that has been followed by it; each longer known context on the way adds the bits of an
escape, whose probability is ``q / (n + q)`` where ``q`` different bytes followed ``n`` times.
Below order 0 all 256 bytes are alike. The counts stay as trained, so a text's code length is a
sum over its bytes, and the language with the shortest code is predicted.

Costs of all grams seen in any language are worked out once, as a table with a column for
each language; a position of a text is one search in it.

Training takes whole texts, at most about ``sample_rows`` rows for each language and
``MOST_ROWS`` in all, picked by a hash of the id; these bounds are what limits the model that is
broadcast. Prediction covers every whole text.

Defined cases: a null text, or one without any letter, is ``und`` with score 0, as is every
text if no language could be learned; rows with null language or null id teach nothing; the language that sorts first wins ties; repeated rows are judged one by
one; an empty table gives an empty table. Columns not named in the call are ignored.
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
from txwarden.llm.bytes_np import TILE, slices

#: Rows of all languages together that training reads at most, on average.
MOST_ROWS = 200_000
#: Numbers in the largest array of bits by byte and language.
CELLS = 1 << 22
#: What stands before the first byte of a text.
START = 0x0A
UNDETERMINED = "und"

ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def gram_codes(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """For each byte, the ``order`` bytes before it and itself as one number; bytes before the
    start of a text are START."""
    codes = data.astype(np.uint64)
    starts = offsets[:-1][np.diff(offsets) > 0]
    for back in range(1, order + 1):
        before = np.empty(len(data), np.uint64)
        before[back:] = data[:-back] if len(data) > back else data[:0]
        before[:back] = START
        for k in range(back):  # first bytes; beyond a shorter text lie those of the next
            at = starts + k
            before[at[at < len(data)]] = START
        codes |= before << np.uint64(8 * back)
    return codes


class ContextTrees:
    """Costs in bits under every language, from counts of grams by language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int):
        self.langs, self.order = sorted(counts), order
        #: bytes handled at once, so that their bits under all languages fit in memory
        self.tile = min(TILE, max(1 << 12, CELLS // len(counts)))
        levels: list[list[tuple[np.ndarray, np.ndarray]]] = []
        for lang in self.langs:
            grams, n = counts[lang]
            own = []
            for k in range(order, -1, -1):
                mask = np.uint64((1 << 8 * (k + 1)) - 1)
                grams, inverse = np.unique(grams & mask, return_inverse=True)
                n = np.bincount(inverse, n, len(grams))
                own.append((grams, n))
            levels.append(own[::-1])
        width = len(self.langs)
        #: by order: the known grams and their bits, the known contexts and the bits of an escape
        self.grams: list[np.ndarray] = []
        self.bits: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        for k in range(order + 1):
            union = np.unique(np.concatenate([own[k][0] for own in levels]))
            known = np.unique(union >> np.uint64(8))
            escapes = np.zeros((len(known), width))
            seen = np.full((len(union), width), np.nan)
            for i, own in enumerate(levels):
                grams, n = own[k]
                above, first, inverse = np.unique(grams >> np.uint64(8), return_index=True, return_inverse=True)
                total = np.bincount(inverse, n, len(above))
                different = np.bincount(inverse, minlength=len(above))
                seen[np.searchsorted(union, grams), i] = np.log2((total + different)[inverse] / n)
                escapes[np.searchsorted(known, above), i] = np.log2((total + different) / different)
            lower = self._lower(k, union, width)
            back = escapes[np.searchsorted(known, union >> np.uint64(8))] + lower
            self.grams.append(union)
            self.bits.append(np.where(np.isnan(seen), back, seen))
            self.contexts.append(known)
            self.escapes.append(escapes)

    def _lower(self, k: int, union: np.ndarray, width: int) -> np.ndarray:
        """Bits of grams one order below ``k``; each is known there to some language."""
        if k == 0:
            return np.full((len(union), width), 8.0)
        at = np.searchsorted(self.grams[k - 1], union & np.uint64((1 << 8 * k) - 1))
        return self.bits[k - 1][at]

    def add_bits(self, codes: np.ndarray, out: np.ndarray) -> None:
        """Add the bits of each gram to the rows of ``out``."""
        rest = np.arange(len(codes))
        for k in range(self.order, -1, -1):
            part = codes[rest] & np.uint64((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(self.grams[k], part), len(self.grams[k]) - 1)
            known = self.grams[k][at] == part
            out[rest[known]] += self.bits[k][at[known]]
            rest, part = rest[~known], part[~known] >> np.uint64(8)
            if not len(rest):
                return
            at = np.minimum(np.searchsorted(self.contexts[k], part), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == part
            out[rest[known]] += self.escapes[k][at[known]]
        out[rest] += 8.0

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language."""
        total = np.zeros((len(offsets) - 1, len(self.langs)))
        if len(offsets) == 2:  # one text, maybe a very long one: in pieces
            for low in range(0, len(data), self.tile):
                begin = max(0, low - self.order)
                piece = data[begin : low + self.tile]
                codes = gram_codes(piece, np.array([0, len(piece)]), self.order)[low - begin :]
                total[0] += self._sum(codes, np.array([0, len(codes)]))[0]
            return total
        return self._sum(gram_codes(data, offsets, self.order), offsets)

    def _sum(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        bits = np.zeros((len(codes), len(self.langs)))
        self.add_bits(codes, bits)
        full = np.flatnonzero(np.diff(offsets) > 0)
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        if len(full):
            out[full] = np.add.reduceat(bits, offsets[full])
        return out


def posterior(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best column of each row, and its share if all columns were equally likely before."""
    best = bits.argmin(1)
    more = bits - bits[np.arange(len(bits)), best][:, None]
    return best, 1 / np.exp2(-np.minimum(more, 1000)).sum(1)


def count_grams(df: DataFrame, order: int) -> DataFrame:
    """Counts of grams by language, for a table of ``lang`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            code = np.asarray(langs.indices)
            for i, j, data, offsets in slices(batch, 1):
                grams = gram_codes(data, offsets, order)
                lang = np.repeat(code[i:j], np.diff(offsets))
                for k in np.unique(lang):
                    found, n = np.unique(grams[lang == k], return_counts=True)
                    name = langs.dictionary[int(k)].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found)), pa.array(found.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                    )

    pieces = df.mapInArrow(run, "lang string, gram long, n long")
    return pieces.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, learn: Column, *, order: int, sample_rows: int, id_col: str, text_col: str, lang_col: str) -> ContextTrees | None:
    """Trees from the rows for which ``learn`` holds."""
    rows = docs.filter(learn).select(
        F.col(quoted(lang_col)).cast("string").alias("lang"),
        F.col(quoted(text_col)).cast("string").alias("text"),
        F.col(quoted(id_col)).cast("string").alias("id"),
    )
    rows = rows.filter("lang is not null and text is not null and text != '' and id is not null")
    sizes = rows.groupBy("lang").count()
    langs = sizes.count()
    wanted = min(sample_rows, MOST_ROWS // max(langs, 1))
    u = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    if langs <= MOST_ROWS:  # a name and a number each; joined by shuffle, a language is one task
        sizes = F.broadcast(sizes)
    picked = rows.join(sizes, "lang").filter(u * F.col("count") < wanted)
    counts = count_grams(picked.select("lang", "text"), order).toArrow()  # bounded by the sample
    if not counts.num_rows:
        return None
    lang = counts.column("lang").combine_chunks().dictionary_encode()
    code = np.asarray(lang.indices)
    gram, n = counts.column("gram").to_numpy().view(np.uint64), counts.column("n").to_numpy()
    names = lang.dictionary.to_pylist()
    return ContextTrees({name: (gram[code == k], n[code == k]) for k, name in enumerate(names)}, order)


def identify(
    docs: DataFrame,
    learn: Column,
    *,
    order: int = 3,
    sample_rows: int = 2000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Per document: id, ``lang_pred``, ``score`` and ``bits_per_byte`` under that language."""
    ship_package(docs.sparkSession)
    model = train(docs, learn, order=order, sample_rows=sample_rows, id_col=id_col, text_col=text_col, lang_col=lang_col)
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("bits_per_byte", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = held.value
        for batch in batches:
            for i, j, data, offsets in slices(batch, 1, trees.tile if trees else TILE):
                ids = batch.column(0).slice(i, j - i)
                sizes = np.diff(offsets)
                lettered = np.zeros(j - i, bool)
                full = np.flatnonzero(sizes > 0)
                if len(full):
                    lettered[full] = np.logical_or.reduceat(ASCII_LETTER[data], offsets[full])
                for k in full[~lettered[full]]:  # letters of other scripts
                    text = data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace")
                    lettered[k] = any(map(str.isalpha, text))
                if trees is None:
                    pred, score, rate = [UNDETERMINED] * (j - i), np.zeros(j - i), np.zeros(j - i)
                else:
                    bits = trees.code_lengths(data, offsets)
                    best, share = posterior(bits)
                    pred = [trees.langs[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)]
                    score = np.where(lettered, share, 0.0)
                    rate = bits.min(1) / np.maximum(sizes, 1)
                yield pa.RecordBatch.from_arrays([ids, pa.array(pred, pa.string()), pa.array(score), pa.array(rate)], schema.names)

    texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))
    return texts.mapInArrow(run, schema).withColumnRenamed("id", id_col)
