"""Removal of text that repeats an earlier document, with a logarithmic family of suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts in a document with a smaller
id is removed. Suffixes are sampled where any two equal strings of that length must both be
sampled: at the smallest hash of ``SEED`` bytes within each window. The windows that share a
sample form a stretch, a little longer than ``length``.

Documents are dealt into batches. Each batch sorts its sampled suffixes into arrays, one for each
bucket of the samples' hashes, and a bucket's task keeps the arrays of all batches as a
logarithmic family: a new array is put in as the smallest level, and levels of equal size are
merged, so that a suffix moves a logarithmic number of times and a scan meets a logarithmic
number of arrays. Every batch is then scanned against the family, and what returns to it is a
bit for each of its suffixes: found in an earlier document or not. Three rounds refine the
answer, each for what the one before left open:

1. samples: which occur in another document at all,
2. whole stretches of those: the same stretch in an earlier document is removed at once,
3. single windows of stretches whose sample, but not the stretch, occurs elsewhere: the ends
   of repeated passages.

Suffixes are ordered by hashes of their next bytes, not by the bytes: equal ones become
neighbours either way, and hashes spread evenly over the buckets, where the bytes of common
phrases would not. A batch sends each different suffix once, with the smallest id that has it,
so a passage that a third of all documents share is one entry for each batch. The documents
are shuffled once, by batch, and all rounds read that shuffle.

Defined cases: a null text is an empty one; a document shorter than ``length`` keeps all; rows
with the same id do not count as earlier than one another; rows with a null id come after all
others; an empty table gives an empty table. Ids are integers. Columns not named in the call
are ignored.
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
from txwarden.llm.bytes_np import BYTE_CODES, Rolling, mix, offsets_of, powers, tiles, utf8

#: Bytes that are hashed for a sample; shorter seeds sample less densely, but recur by chance.
SEED = 26
#: Bytes of text in a batch and suffixes in a bucket, small and large tables.
BATCH_BYTES, MOST_BATCH_BYTES = 4 << 20, 64 << 20
BUCKET_SUFFIXES, MOST_BUCKET_SUFFIXES = 1 << 20, 1 << 24
#: Batches or buckets beyond which they grow before they become more.
MANY = 512
#: Bytes handled at once, and bits for a place among them.
PIECE, PLACE_BITS = 1 << 18, 21
NO_ID = np.iinfo(np.int64).max


#: A range of bytes.
SPAN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "end")])
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class LogFamily:
    """Sorted arrays of different keys, each with the smallest id that has it; no two arrays
    are of about the same size. Keys of more than 64 bits have a second part, ``rest``."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, ...]] = []

    def add(self, keys: np.ndarray, first: np.ndarray, *rest: np.ndarray) -> None:
        level = (keys, first, *rest)
        while self.levels and len(self.levels[-1][0]) < 2 * len(level[0]):
            level = self._merged(self.levels.pop(), level)
        self.levels.append(level)

    @staticmethod
    def _merged(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        keys, first, *rest = map(np.concatenate, zip(a, b, strict=True))
        order = key_order(keys, *rest)
        return smallest(keys[order], first[order], *[r[order] for r in rest])

    def first(self, keys: np.ndarray, *rest: np.ndarray) -> np.ndarray:
        """The smallest id of each key over all levels."""
        out = np.full(len(keys), NO_ID)
        for have, first, *more in self.levels:
            at = np.searchsorted(have, keys)
            for r, m in zip(rest, more, strict=True):
                go_on = np.arange(len(keys))
                while len(go_on):  # along keys that differ in their second part only
                    go_on = go_on[at[go_on] < len(have)]
                    i = at[go_on]
                    go_on = go_on[(have[i] == keys[go_on]) & (m[i] < r[go_on])]
                    at[go_on] += 1
            at = np.minimum(at, len(have) - 1)
            same = have[at] == keys
            for r, m in zip(rest, more, strict=True):
                same &= m[at] == r
            out = np.where(same, np.minimum(out, first[at]), out)
        return out


def key_order(keys: np.ndarray, *rest: np.ndarray) -> np.ndarray:
    """The order of keys, then of their second parts."""
    order = np.argsort(keys, kind="stable")  # of two runs: a merge
    k = keys[order]
    for r in (r[order] for r in rest):
        if ((k[1:] == k[:-1]) & (r[1:] < r[:-1])).any():
            return np.lexsort((*rest, keys))
    return order


def group_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where each group of equal keys begins."""
    n = len(sorted_keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def smallest(keys: np.ndarray, first: np.ndarray, *rest: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys of a sorted array with the smallest value of each."""
    if not len(keys):
        return keys, first, *rest
    at = group_starts(keys, *rest)
    return keys[at], np.minimum.reduceat(first, at), *[r[at] for r in rest]


def pack(x: np.ndarray, ascending: bool = False) -> bytes:
    """Bytes of an integer array, all lowest bytes first and so on, which compresses well."""
    if ascending and len(x):
        x = np.concatenate([x[:1], np.diff(x)])
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unpack(b: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    size = np.dtype(kind).itemsize
    x = np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if ascending else x


def pack_bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def unpack_bits(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)


def pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Ranges of bytes to sample together: where each starts, and the offsets of its texts. Parts
    of a longer text overlap so that every window lies in one of them."""
    for i, j in tiles(offsets, PIECE):
        low, high = int(offsets[i]), int(offsets[j])
        if high - low <= PIECE:
            yield low, offsets[i : j + 1] - low
        else:
            for at in range(low, high, PIECE):
                yield at, np.array([0, min(PIECE + length - 1, high - at)])


class Stretches:
    """The sampled suffixes of a batch: for each, its window range ``low`` to ``high`` in the
    bytes of the batch, the hash ``sample`` of its seed and ``whole`` of its stretch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        found = [self._sampled(data, at, texts, length) for at, texts in pieces(offsets, length)]
        kinds = (np.int64, np.int64, np.uint64, np.uint64)
        none = [np.zeros(0, k) for k in kinds]
        self.low, self.high, self.sample, self.whole = (
            np.concatenate(x) if found else none[i] for i, x in enumerate(zip(*found, strict=True))
        ) if found else none

    @staticmethod
    def _sampled(data: np.ndarray, base: int, texts: np.ndarray, length: int):
        data = data[base : base + int(texts[-1])]
        n, span = len(data), length - SEED + 1
        windows = n - length + 1
        if windows <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        rolling = Rolling(BYTE_CODES[data])
        seeds = rolling.windows(SEED)
        mask = np.uint64((1 << PLACE_BITS) - 1)
        best = (seeds & ~mask) | np.arange(len(seeds), dtype=np.uint64)
        width = 1
        while width < span:  # minimum over ever wider ranges, the last step overlapping
            step = min(width, span - width)
            best = np.minimum(best[:-step], best[step:])
            width += step
        place = (best & mask).astype(np.int64)
        # Windows that would run over the end of their text do not count.
        over = np.zeros(n + 1, np.int32)
        ends, begins = texts[1:], texts[:-1]
        np.add.at(over, np.maximum(begins, ends - length + 1), 1)
        np.add.at(over, ends, -1)
        ok = np.cumsum(over[:windows]) == 0
        same = (place[1:] == place[:-1]) & ok[1:] & ok[:-1]
        first = ok.copy()
        first[1:] &= ~same
        last = ok.copy()
        last[:-1] &= ~same
        low, high = np.flatnonzero(first), np.flatnonzero(last)
        # Sampled hashes are small ones; mixed again they spread evenly over the buckets.
        return low + base, high + base, mix(seeds[place[low]]), rolling.spans(low, high + length)


def window_hashes(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows that start at given places."""
    out = np.empty(len(at), np.uint64)
    weights, steps = powers(length), np.arange(length)
    for i in range(0, len(at), 1 << 14):
        rows = BYTE_CODES[data[at[i : i + (1 << 14), None] + steps]]
        out[i : i + (1 << 14)] = mix((rows * weights).sum(1, dtype=np.uint64))
    return out


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of inclusive ranges, and the range that each belongs to."""
    n = high - low + 1
    of = np.repeat(np.arange(len(n)), n)
    return low[of] + np.arange(len(of)) - offsets_of(n)[of], of


def different(doc: np.ndarray, *keys: np.ndarray):
    """For each row the number of its keys (bucket, key and so on) in sorted order; the different
    ones; and the smallest document of each."""
    if not len(doc):
        return np.zeros(0, np.int64), keys, doc
    order = np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    at = group_starts(*keys)
    number = np.empty(len(order), np.int64)
    number[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
    return number, tuple(k[at] for k in keys), np.minimum.reduceat(doc[order], at)


class Batch:
    """The documents of a batch and what each round makes of them, in a fixed order, so that
    answers need not name what they answer."""

    def __init__(self, table: pa.Table, length: int, bits: int):
        text = table.column("text")
        self.table, self.length, self.bits = table, length, bits
        self.data, self.offsets = utf8(pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], text.type))
        self.ids = table.column("id").fill_null(NO_ID).to_numpy()
        s = self.all = Stretches(self.data, self.offsets, length)
        self.doc = self.ids[np.searchsorted(self.offsets, s.low, "right") - 1]
        self.key = s.sample >> np.uint64(32 - bits)
        #: round 1: different samples, and which lie in several documents of the batch
        order = np.argsort(self.key, kind="stable")
        k, d = self.key[order], self.doc[order]
        at = group_starts(k)
        self.samples = k[at]
        self.several = (
            np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at) if len(k) else np.zeros(0, bool)
        )
        self.group = np.empty(len(k), np.int64)
        self.group[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(k))))

    def bucket_edges(self, buckets: np.ndarray) -> np.ndarray:
        """Where each bucket begins in a sorted array of bucket numbers."""
        return np.searchsorted(buckets, np.arange((1 << self.bits) + 1, dtype=np.uint64))

    def round2(self, repeated: np.ndarray) -> None:
        """Stretches whose sample occurs in several documents: different ones with their first
        document, in order of sample and stretch. Nothing checks them again, so all 64 bits of
        a stretch's hash count: the lower half is the entry's ``entry_rest``."""
        self.repeated = repeated
        self.open = np.flatnonzero(repeated[self.group])
        bucket = self.key[self.open] >> np.uint64(32)
        whole = self.all.whole[self.open]
        suffix = (self.key[self.open] << np.uint64(32)) | (whole >> np.uint64(32))
        self.entry, (self.entry_bucket, self.entries, self.entry_rest), self.entry_first = different(
            self.doc[self.open], bucket, suffix, whole.astype(np.uint32)
        )

    def round3(self, found: np.ndarray, mixed: np.ndarray) -> None:
        """Windows of stretches that no earlier document has whole, but whose sample it has."""
        self.found, self.mixed = found, mixed
        covered = found[self.entry] | (self.doc[self.open] > self.entry_first[self.entry])
        self.covered = self.open[covered]
        rest = self.open[~covered & mixed[self.entry]]
        self.place, of = spread(self.all.low[rest], self.all.high[rest])
        self.window = window_hashes(self.data, self.place, self.length)
        self.window_doc = self.doc[rest][of]
        bucket = self.key[rest][of] >> np.uint64(32)
        self.window_group, (self.windows_bucket, self.windows), self.windows_first = different(
            self.window_doc, bucket, self.window
        )

    def removed(self, found: np.ndarray) -> np.ndarray:
        """For each byte whether it goes."""
        gone = found[self.window_group] | (self.window_doc > self.windows_first[self.window_group])
        cover = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(cover, self.all.low[self.covered], 1)
        np.add.at(cover, self.all.high[self.covered] + self.length, -1)
        np.add.at(cover, self.place[gone], 1)
        np.add.at(cover, self.place[gone] + self.length, -1)
        return np.cumsum(cover[:-1]) > 0


def answers(table: pa.Table) -> tuple[dict[str, np.ndarray], list[dict]]:
    """Bits that came back to a batch, joined in order of buckets, and the rows."""
    rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
    out = {}
    for name, size in (("seen", "n1"), ("found", "n2"), ("mixed", "n2"), ("gone", "n3")):
        if name in table.column_names:
            parts = [unpack_bits(r[name], r[size]) for r in rows]
            out[name] = np.concatenate(parts) if parts else np.zeros(0, bool)
    return out, rows


def replayed(docs: pa.Table, table: pa.Table, length: int, bits: int) -> tuple[Batch, dict, list[dict]]:
    """A batch brought to where the last round left it."""
    batch = Batch(docs, length, bits)
    bit, rows = answers(table)
    seen = bit.get("seen", np.zeros(0, bool))
    batch.round2(batch.several | seen if len(seen) else batch.several)
    if "found" in bit:
        batch.round3(bit["found"], bit["mixed"])
    return batch, bit, rows


def with_smallest(
    rows: list[dict], keys: list[np.ndarray], first: list[np.ndarray], *rest: list[np.ndarray]
) -> list[np.ndarray]:
    """For each batch's array, which keys an earlier document of any batch has."""
    family = LogFamily()
    for k, f, *r in zip(keys, first, *rest, strict=True):
        if len(k):
            family.add(k, f, *r)
    return [family.first(k, *r) < f for k, f, *r in zip(keys, first, *rest, strict=True)]


def remove_repeats(
    docs: DataFrame,
    *,
    length: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    with_text: bool = False,
) -> DataFrame:
    """Per document: id, the columns of ``keep``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` of the bytes left, and ``spans``, the byte ranges removed; with ``with_text``
    also ``kept_text``, the text without the characters that lie wholly in such a range."""
    if length < SEED:
        raise ValueError(f"length has to be {SEED} or more")
    ship_package(docs.sparkSession)
    text = F.col(quoted(text_col)).cast("string")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    batches = max(1, -(-total // MOST_BATCH_BYTES), min(MANY, -(-total // BATCH_BYTES)))
    suffixes = 2 * total // (length - SEED + 2)
    buckets = max(1, suffixes // MOST_BUCKET_SUFFIXES, min(MANY, suffixes // BUCKET_SUFFIXES))
    bits = (int(buckets) - 1).bit_length()

    name = F.col(quoted(id_col)).cast("long")
    dealt = docs.select(
        name.alias("id"),
        text.alias("text"),
        *[F.col(quoted(k)).alias(f"keep_{i}") for i, k in enumerate(keep)],
        F.pmod(F.xxhash64(name, text), F.lit(batches)).cast("int").alias("batch"),
    )
    by_batch = lambda t: t.groupBy("batch")
    addressed = [("bucket", pa.int32()), ("batch", pa.int32())]
    bits1 = [("n1", pa.int32()), ("seen", pa.binary())]
    bits2 = [("n2", pa.int32()), ("found", pa.binary()), ("mixed", pa.binary())]
    bits3 = [("n3", pa.int32()), ("gone", pa.binary())]
    sent1 = pa.schema([*addressed, ("n1", pa.int32()), ("keys", pa.binary())])
    sent2 = pa.schema(
        [*addressed, *bits1, ("n2", pa.int32()), ("keys", pa.binary()), ("rest", pa.binary()), ("first", pa.binary())]
    )
    sent3 = pa.schema([*addressed, *bits1, *bits2, ("n3", pa.int32()), ("keys", pa.binary()), ("first", pa.binary())])
    back1, back2 = pa.schema([*addressed, *bits1]), pa.schema([*addressed, *bits1, *bits2])
    back3 = pa.schema([*addressed, *bits1, *bits2, *bits3])
    ddl = lambda s: ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'int'}" for f in s)

    def number(table: pa.Table) -> int:
        return table.column("batch")[0].as_py()

    def send1(docs: pa.Table) -> pa.Table:
        batch = Batch(docs, length, bits)
        edges = batch.bucket_edges(batch.samples >> np.uint64(32))
        low = batch.samples.astype(np.uint32)
        rows = [
            {"bucket": i, "batch": number(docs), "n1": int(b - a), "keys": pack(low[a:b], True)}
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))
            if b > a
        ]
        return pa.Table.from_pylist(rows, sent1)

    def scan1(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["batch"])
        keys = [unpack(r.pop("keys"), np.uint32, True) for r in rows]
        here = [np.full(len(k), r["batch"], np.int64) for r, k in zip(rows, keys, strict=True)]
        before = with_smallest(rows, keys, here)
        after = with_smallest(rows, keys, [-h for h in here])
        for r, b, a in zip(rows, before, after, strict=True):
            r["seen"] = pack_bits(b | a)
        return pa.Table.from_pylist(rows, back1)

    def send2(docs: pa.Table, table: pa.Table) -> pa.Table:
        batch, _, rows = replayed(docs, table, length, bits)
        edges = batch.bucket_edges(batch.entry_bucket)
        for r in rows:
            a, b = edges[r["bucket"]], edges[r["bucket"] + 1]
            r |= {"n2": int(b - a), "keys": pack(batch.entries[a:b], True)}
            r |= {"rest": pack(batch.entry_rest[a:b]), "first": pack(batch.entry_first[a:b])}
        return pa.Table.from_pylist(rows, sent2)

    def scan2(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["batch"])
        keys = [unpack(r.pop("keys"), np.uint64, True) for r in rows]
        rest = [unpack(r.pop("rest"), np.uint32) for r in rows]
        found = with_smallest(rows, keys, [unpack(r.pop("first"), np.int64) for r in rows], rest)
        whole, low = np.concatenate(keys), np.concatenate(rest)
        order = key_order(whole, low)
        whole, low = whole[order], low[order]
        samples, n = np.unique(whole[group_starts(whole, low)] >> np.uint64(32), return_counts=True)
        several = samples[n > 1]
        for r, k, f in zip(rows, keys, found, strict=True):
            r |= {"found": pack_bits(f), "mixed": pack_bits(np.isin(k >> np.uint64(32), several))}
        return pa.Table.from_pylist(rows, back2)

    def send3(docs: pa.Table, table: pa.Table) -> pa.Table:
        batch, _, rows = replayed(docs, table, length, bits)
        edges = batch.bucket_edges(batch.windows_bucket)
        for r in rows:
            a, b = edges[r["bucket"]], edges[r["bucket"] + 1]
            r |= {"n3": int(b - a), "keys": pack(batch.windows[a:b], True), "first": pack(batch.windows_first[a:b])}
        return pa.Table.from_pylist(rows, sent3)

    def scan3(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["batch"])
        keys = [unpack(r.pop("keys"), np.uint64, True) for r in rows]
        gone = with_smallest(rows, keys, [unpack(r.pop("first"), np.int64) for r in rows])
        for r, g in zip(rows, gone, strict=True):
            r["gone"] = pack_bits(g)
        return pa.Table.from_pylist(rows, back3)

    out_type = T.StructType(
        [
            T.StructField("id", T.LongType()),
            *[T.StructField(f"keep_{i}", docs.schema[k].dataType) for i, k in enumerate(keep)],
            *[T.StructField(x, T.LongType()) for x in ("n_bytes", "n_removed", "n_spans")],
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("spans", T.ArrayType(SPAN)),
            *([T.StructField("kept_text", T.StringType())] if with_text else []),
        ]
    )

    def finish(docs: pa.Table, table: pa.Table) -> pa.Table:
        batch, bit, _ = replayed(docs, table, length, bits)
        gone = batch.removed(bit.get("gone", np.zeros(0, bool)))
        n = len(batch.offsets) - 1
        removed, spans, sha, texts = np.zeros(n, np.int64), [], [], []
        for i in range(n):
            low, high = batch.offsets[i], batch.offsets[i + 1]
            out, body = gone[low:high], batch.data[low:high]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]]))).tolist()
            removed[i] = np.count_nonzero(out)
            spans.append(list(zip(edges[::2], edges[1::2], strict=True)))
            sha.append(hashlib.sha256((body[~out] if edges else body).tobytes()).hexdigest())
            if with_text:
                texts.append((body[~whole_characters(body, out)] if edges else body).tobytes().decode("utf-8", "replace"))
        columns = [docs.column("id"), *[docs.column(f"keep_{i}") for i in range(len(keep))]]
        columns += [pa.array(np.diff(batch.offsets)), pa.array(removed), pa.array(list(map(len, spans)), pa.int64())]
        columns += [pa.array(sha, pa.string()), pa.array(spans, ARROW_SPANS)]
        columns += [pa.array(texts, pa.string())] if with_text else []
        return pa.Table.from_arrays(columns, out_type.names)

    seen = by_batch(dealt).applyInArrow(send1, ddl(sent1)).groupBy("bucket").applyInArrow(scan1, ddl(back1))
    back = by_batch(dealt).cogroup(by_batch(seen)).applyInArrow(send2, ddl(sent2))
    found = back.groupBy("bucket").applyInArrow(scan2, ddl(back2))
    back = by_batch(dealt).cogroup(by_batch(found)).applyInArrow(send3, ddl(sent3))
    gone = back.groupBy("bucket").applyInArrow(scan3, ddl(back3))
    out = by_batch(dealt).cogroup(by_batch(gone)).applyInArrow(finish, out_type)
    names = {"id": id_col} | {f"keep_{i}": k for i, k in enumerate(keep)}
    return out.select(*[F.col(c).alias(names.get(c, c)) for c in out.columns])


def whole_characters(body: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Removed bytes without those of characters of which some byte stays."""
    lead = (body & 0xC0) != 0x80
    lead[:1] = True
    at = np.flatnonzero(lead)
    whole = np.logical_and.reduceat(out, at)
    return np.repeat(whole, np.diff(np.append(at, len(body))))
