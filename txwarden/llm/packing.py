"""Token sequences of fixed capacity, packed by bin completion.

Texts become token ids and pieces of at most ``capacity`` tokens. Pieces of one length are alike, so
what is searched is a histogram of lengths: at most ``capacity`` counts, however many documents
there are. Branch and bound then completes bins: the largest length left opens a bin, the
undominated fillings of what remains in it are tried, fullest first, and one filling is repeated
while its lengths last. A branch ends where the waste so far and the bound on the rest leave no
better packing; best fit finishes every branch and so gives the incumbents. The search ends at a
lower bound, or after ``max_nodes`` nodes with the best packing seen (the first is plain best fit
decreasing); every piece is packed either way.

The packing comes back as rows (length, ranks from low to high, sequences, place), of which there
are at most a few for each two lengths. A piece's rank among those of its length is its number within
its task plus the counts of the tasks before: no sort, and no piece passes through the driver.

Defined cases: a null text is empty, and an empty text is its end token alone; repeated rows and
null ids are packed like any other row; further columns are not looked at; an empty table gives
an empty table. Special tokens of the vocabulary file are found in texts, as its library does.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.functions.shipping import ship_package
from txwarden.functions.staging import quoted
from txwarden.llm.tables import settled
from txwarden.llm.token_counts import byte_symbols

#: Nodes that the search visits at most, and fillings that it tries at each.
MAX_NODES, MAX_FILLINGS = 200, 12

#: Rows encoded before they are handed on; bounds the memory of a task.
ROWS = 200


@lru_cache(maxsize=2)
def encoder(tokenizer: str):
    """Encoder for a file of the byte-level pair-encoding kind whose ids are ranks of merges."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(tokenizer), encoding="utf-8") as handle:
        spec = json.load(handle)
    model, special = spec["model"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    byte, vocab = byte_symbols(), model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocab[a + b] for a, b in pairs]
    plain = spec["normalizer"] is None and (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel"
    plain = plain and not spec["pre_tokenizer"]["add_prefix_space"] and not model["end_of_word_suffix"]
    if not plain or any(a >= b for a, b in zip(made, made[1:], strict=False)):
        raise ValueError(f"{tokenizer} is no byte-level vocabulary with ids in the order of merges")
    ranks = {bytes(byte[c] for c in token): n for token, n in vocab.items() if token not in special}
    return tiktoken.Encoding(tokenizer, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cut_pieces(
    df: DataFrame,
    tokenizer: str,
    capacity: int,
    end_id: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row a piece: ``id_col``, ``piece`` from 0, ``start`` (tokens before it), ``length``,
    ``ids`` (unsigned 32-bit, little-endian) and ``task``, ``nth``, which tell apart the pieces of a
    length. A text's tokens and ``end_id`` are one piece if they fit; otherwise all pieces but
    the first are full. Store the result before reading it twice: tasks number their rows."""
    ship_package(df.sparkSession)
    fields = [
        T.StructField(id_col, df.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("task", T.IntegerType()),
        T.StructField("nth", T.LongType()),
    ]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, task = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                rows, piece, start, ids = [], [], [], []
                for row, text in enumerate(part.column(1).to_pylist()):
                    tokens = tool.encode_to_numpy(text or "", allowed_special="all").astype("<u4").tobytes() + end
                    n = len(tokens) // 4
                    cuts = [0, *range((n - 1) % capacity + 1, n, capacity), n]
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        rows.append(row)
                        piece.append(k)
                        start.append(a)
                        ids.append(tokens[4 * a : 4 * b])
                length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length),
                        pa.array(ids, pa.binary()),
                        pa.array(np.full(len(ids), task, np.int32)),
                        pa.array(numbered(length, seen)),
                    ],
                    [f.name for f in fields],
                )

    return df.select(F.col(quoted(id_col)), F.col(quoted(text_col)).cast("string").alias("text")).mapInArrow(
        run, T.StructType(fields)
    )


def numbered(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Number of each piece among those of its length; ``seen`` counts on from call to call."""
    order = np.argsort(length, kind="stable")
    ordered = length[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, len(ordered)])
    nth = np.empty(len(length), np.int64)
    nth[order] = np.arange(len(ordered)) - np.repeat(first, sizes) + seen[ordered]
    seen[ordered[first]] += sizes
    return nth


def pack(pieces: DataFrame, capacity: int, max_nodes: int = MAX_NODES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, in place of ``task`` and ``nth``. Needs
    ``length`` (1 to ``capacity``), ``task`` and ``nth`` as :func:`cut_pieces` gives them."""
    spark = pieces.sparkSession
    held = settled(pieces, "pieces")
    counts = settled(held.groupBy("length", "task").agg(F.count(F.lit(1)).alias("_n")), "counts")
    totals = {r["length"]: r["_n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("_n")).collect()}
    slots = spark.createDataFrame(
        slot_rows(pack_counts(totals, capacity, max_nodes)),
        "_length long, _low long, _high long, _uses long, _first long, _at long",
    )
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    ranked = held.join(before, ["length", "task"]).withColumn("_rank", F.col("nth") + F.col("_before"))
    fits = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    turn = F.col("_rank") - F.col("_low")
    return ranked.join(F.broadcast(slots), fits).select(  # rows are bounded by the capacity alone
        *[quoted(c) for c in held.columns if c not in ("task", "nth")],
        (F.col("_first") + F.floor(turn / F.col("_uses"))).alias("sequence_id"),
        (F.col("_at") + turn % F.col("_uses") * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, starts): the packed sequences, with the places where pieces begin."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    gathered = packed.groupBy("sequence_id").agg(parts.alias("_p"))
    return gathered.select(
        "sequence_id",
        F.aggregate("_p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("length"),
        F.aggregate("_p", F.lit(b""), lambda all_, x: F.concat(all_, x["ids"])).alias("ids"),
        F.transform("_p", lambda x: x["offset"]).alias("starts"),
    )


#: A filling and how many bins have it: ((length, uses), ...), times.
Filling = tuple[tuple[tuple[int, int], ...], int]


def slot_rows(packing: list[Filling]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, low, high, uses, first, at): pieces of a length with ranks from low to high lie, in
    turns of ``uses``, in sequences from ``first`` on, at ``at`` and behind one another."""
    rows, taken, first = [], {}, 0
    for filling, times in packing:
        at = 0
        for length, uses in filling:
            low = taken.get(length, 0)
            taken[length] = high = low + uses * times
            rows.append((length, low, high, uses, first, at))
            at += uses * length
        first += times
    return rows


def best_fit(counts: np.ndarray, capacity: int) -> list[Filling]:
    """Best fit decreasing on a histogram (index = length); bins that look alike go together."""
    by_room: dict[int, list[Filling]] = {}
    rooms = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            room = length + int(np.argmax(rooms[length:]))  # the least that fits
            if rooms[room]:
                filling, times = by_room[room].pop()
                rooms[room] = bool(by_room[room])
            else:
                room, filling, times = capacity, (), left
            uses = min(room // length, left)
            whole = min(times, left // uses)
            parts = [(uses, whole)]
            left -= uses * whole
            if filling and whole < times:  # the others stay as they are
                by_room.setdefault(room, []).append((filling, times - whole))
                rooms[room] = True
            for used, bins in parts:
                rest = room - used * length
                by_room.setdefault(rest, []).append(((*filling, (length, used)), bins))
                rooms[rest] = True
    return [group for groups in by_room.values() for group in groups]


def least_bins(counts: np.ndarray, capacity: int) -> int:
    """Lower bound: pieces over half the capacity need bins of their own, and what the smaller ones
    of at least some length cannot put beside them needs more (the largest such bound)."""
    lengths = np.arange(capacity + 1)
    number, size = np.cumsum(counts), np.cumsum(counts * lengths)
    half = capacity // 2
    least = np.arange(0, half + 1)
    upto = lambda sums, k: np.where(k > 0, sums[np.maximum(k - 1, 0)], 0)  # noqa: E731  below k
    alone = number[-1] - number[capacity - least]
    medium = number[capacity - least] - number[half]
    room = medium * capacity - (size[capacity - least] - size[half])
    small = size[half] - upto(size, least)
    return int((alone + medium + np.maximum(0, -(-(small - room) // capacity))).max())


def fillings(counts: np.ndarray, room: int, most_waste: float, most: int) -> list[tuple[tuple[int, int], ...]]:
    """Undominated fillings of ``room`` from the lengths at hand that waste at most ``most_waste``,
    fullest first, among equals those with larger lengths. One that fills the room alone dominates
    all others, and one is dominated where a length left out still fits, or could replace a smaller
    one of it, or two of them, within the room."""
    if counts[room]:
        return [((room, 1),)]
    lengths = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    found: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    least = lengths[-1] if lengths else 0
    exact, steps = 0, 0

    def dominated(filling: tuple[tuple[int, int], ...], slack: int) -> bool:
        used = dict(filling)
        singles = list(used)
        sums = [0, *singles] + [a + b for i, a in enumerate(singles) for b in singles[i:] if a != b or used[a] > 1]
        for total in sums:
            inside = counts[total + 1 : total + slack + 1]
            for more in (total + 1 + np.flatnonzero(inside)).tolist():
                if counts[more] > used.get(more, 0):
                    return True
            if total not in used and counts[total]:  # two replaced by one of their size
                return True
        return False

    def extend(at: int, left: int, filling: tuple[tuple[int, int], ...]) -> None:
        nonlocal exact, steps
        steps += 1
        if exact >= most or steps > 200 * most:
            return
        if left < least or at == len(lengths):
            if left <= most_waste and not dominated(filling, left):
                found.append((left, filling))
                exact += left == 0
            return
        while at < len(lengths) and lengths[at] > left:
            at += 1
        if at == len(lengths):
            return extend(at, left, filling)
        length = lengths[at]
        for uses in range(min(left // length, int(counts[length])), -1, -1):
            more = (*filling, (length, uses)) if uses else filling
            extend(at + 1, left - uses * length, more)

    if lengths:
        extend(0, room, ())
    found.sort(key=lambda x: (x[0], tuple((-a, -b) for a, b in x[1])))
    return [filling for _, filling in found[:most]] or [()]


def pack_counts(totals: dict[int, int], capacity: int, max_nodes: int = MAX_NODES) -> list[Filling]:
    """Fillings for ``totals`` (pieces by length) in as few bins as the search finds."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in totals.items():
        counts[length] = n
    bins = lambda packing: sum(times for _, times in packing)
    best = best_fit(counts, capacity)
    goal = least_bins(counts, capacity)
    # (what is left, bins made, their number); the last one is looked at next
    open_: list[tuple[np.ndarray, list[Filling], int]] = [(counts, [], 0)]
    nodes = 0
    while open_ and bins(best) > goal and nodes < max_nodes:
        left, made, used = open_.pop()
        if used + least_bins(left, capacity) >= bins(best):
            continue
        nodes += 1
        finished = made + best_fit(left, capacity)
        if bins(finished) < bins(best):
            best = finished
        if not left.any():
            continue
        largest = int(np.flatnonzero(left)[-1])
        rest = left.copy()
        rest[largest] -= 1
        spare = (bins(best) - 1 - used) * capacity - int((left * np.arange(capacity + 1)).sum())
        for filling in reversed(fillings(rest, capacity - largest, spare, MAX_FILLINGS)):
            uses = dict(filling)
            uses[largest] = uses.get(largest, 0) + 1
            times = min(int(left[length]) // n for length, n in uses.items())
            after = left.copy()
            for length, n in uses.items():
                after[length] -= n * times
            whole = tuple(sorted(uses.items(), reverse=True))
            open_.append((after, [*made, (whole, times)], used + times))
    return best
