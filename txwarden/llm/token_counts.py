"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

A byte-pair encoding of a word is built prefix by prefix: the encoding of the first ``j``
bytes is the encoding of some shorter prefix plus one token, and exactly one token that ends
at ``j`` fits, the one whose pair with the previous token could not have been merged
differently. One pass over a word therefore gives the count of every prefix of it. White
space separates words, so a text's count is a running sum over its pieces, and truncation
and budget questions are answered from those sums without encoding anything again.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); other columns of the input are
not looked at, so extra columns may have any name; repeated rows and null ids are counted
like any other row; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.functions.shipping import ship_package
from txwarden.functions.staging import quoted

#: Words kept in memory by each Python worker, for each of two dictionaries, and their length at most.
REMEMBERED, REMEMBERED_CHARS = 500_000, 256

#: More than any token's number.
WIDE = 1 << 24

# White space as Unicode's White_Space property lists it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Python's str.split() also splits at these, which are no white space to the tokenizer.
NO_SPACE = re.compile("[\x1c-\x1f]")
PIECES = re.compile(f"[^{SPACE}]+")
#: Text for which lower-casing and normal form need no library.
PLAIN = re.compile("[\x00-\xff]*").fullmatch


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others follow from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bounded(dict):
    """Results of ``make`` by key; emptied when ``size`` keys are held. Long words are not held."""

    def __init__(self, make, size: int = REMEMBERED):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key):
        if not isinstance(key, int) and len(key) > REMEMBERED_CHARS:
            return self.make(key)
        if len(self) >= self.size:
            self.clear()
        value = self[key] = self.make(key)
        return value


class PrefixCounter:
    """Counts of the tokens of texts and of their prefixes, for a tokenizer file of the
    byte-level pair-encoding kind with an end-of-word mark."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        model, byte = spec["model"], byte_symbols()
        self.end = model["end_of_word_suffix"] or ""
        raw = lambda s: bytes(byte[c] for c in s)
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        vocab = model["vocab"]
        for token, number in vocab.items():
            last = bool(self.end) and token.endswith(self.end)
            body = token[: -len(self.end)] if last else token
            (self.final if last else self.inner)[raw(body)] = number
        #: rank of the merge that joins two tokens, and how each token was joined
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            one, two, both = vocab[a], vocab[b], vocab[a + b]
            self.rank[one, two] = rank
            self.parts.setdefault(both, (one, two, rank))
        # A token whose own bytes are encoded otherwise never ends a prefix.
        valid = set(vocab.values()) - set(self.parts)
        for token, (one, two, rank) in sorted(self.parts.items(), key=lambda x: x[1][2]):
            if one in valid and two in valid and self.side_by_side(one, two, rank):
                valid.add(token)
        self.inner = {b: t for b, t in self.inner.items() if t in valid}
        self.final = {b: t for b, t in self.final.items() if t in valid} if self.end else self.inner
        self.longest = max(map(len, self.inner | self.final))
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")")
        library = Tokenizer.from_file(path)
        self.normal, self.pre = library.normalizer, library.pre_tokenizer
        self.byte = byte
        self.fits = Bounded(self._fits)  # two tokens, packed in one number
        self.words = Bounded(lambda word: self.prefixes(word)[-1])
        self.pieces = Bounded(self._piece)

    def _fits(self, pair: int) -> bool:
        return self.side_by_side(*divmod(pair, WIDE), len(self.rank))

    def side_by_side(self, left: int, right: int, before: int) -> bool:
        """Whether two tokens stay apart until merge number ``before``: undoing their merges,
        latest first, no pair across the border may have been mergeable before those."""
        while True:
            if self.rank.get((left, right), before) < before:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            # The later merge is undone; at equal rank the left one was applied first.
            if b is None or a is not None and a[2] > b[2]:
                before, left = a[2], a[1]
            else:
                before, right = b[2] + 1, b[0]

    def prefixes(self, word: bytes) -> list[int]:
        """Tokens of ``word[:j]`` for every j from 0, each prefix being a word of its own."""
        inner, final, fits = self.inner, self.final, self.fits
        last, count, out = [-1], [0], [0]
        for j in range(1, len(word) + 1):
            low = max(0, j - self.longest)
            for vocab, found in ((inner, None), (final, out)):
                for i in range(low, j):
                    token = vocab.get(word[i:j])
                    if token is not None and (not i or fits[last[i] * WIDE + token]):
                        if found is None:
                            last.append(token)
                            count.append(count[i] + 1)
                        else:
                            out.append(count[i] + 1)
                        break
        return out

    def total(self, word: bytes) -> int:
        """Tokens of a whole word: as ``prefixes(word)[-1]``, without the other answers."""
        inner, final, fits = self.inner, self.final, self.fits
        n, longest = len(word), self.longest
        last, count = [-1], [0]
        for j in range(1, n):
            for i in range(j - 1, max(0, j - longest) - 1, -1):
                token = inner.get(word[i:j])
                if token is not None and (not i or fits[last[i] * WIDE + token]):
                    last.append(token)
                    count.append(count[i] + 1)
                    break
        for i in range(n - 1, max(0, n - longest) - 1, -1):
            token = final.get(word[i:n])
            if token is not None and (not i or fits[last[i] * WIDE + token]):
                return count[i] + 1
        raise ValueError(f"no encoding for {word!r}")

    def _words(self, text: str) -> list[bytes]:
        """The words that the tokenizer encodes one by one, for text without special tokens."""
        if PLAIN(text):
            return [w.encode() for w in self.split.findall(text.lower())]
        parts = self.pre.pre_tokenize_str(self.normal.normalize_str(text))
        return [bytes(self.byte[c] for c in part) for part, _ in parts]

    def _piece(self, piece: str) -> int:
        parts = self.special.split(piece)  # special tokens stand at odd places
        return len(parts) // 2 + sum(
            self.words[word] for part in parts[::2] if part for word in self._words(part)
        )

    def split_pieces(self, text: str) -> list[str]:
        return PIECES.findall(text) if NO_SPACE.search(text) else text.split()

    def count(self, text: str) -> int:
        return sum(map(self.pieces.__getitem__, self.split_pieces(text)))

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """Where each piece ends, and the count of the text up to there."""
        found = list(PIECES.finditer(text))
        return [m.end() for m in found], list(accumulate(self.pieces[m.group()] for m in found))

    def at(self, text: str, end: int) -> int:
        """Tokens of ``text[:end]``: the sum up to the last whole piece, and the rest's."""
        total = 0
        for m in PIECES.finditer(text):
            if m.start() >= end:
                break
            total += self.pieces[m.group() if m.end() <= end else text[m.start() : end]]
        return total

    def prefix_counts(self, piece: str) -> list[int] | None:
        """Tokens of ``piece[:end]`` for every end, from the prefixes of its words; None where
        characters of the piece do not stand for themselves (special tokens, joined accents)."""
        if self.special.search(piece):
            return None
        if PLAIN(piece):
            text = piece.lower()
            words = [m.span() for m in self.split.finditer(text)]
        else:
            text = self.normal.normalize_str(piece)
            words = [span for _, span in self.pre.pre_tokenize_str(text)]
        if len(text) != len(piece):
            return None
        counts, total = [0] * (len(text) + 1), 0
        for a, b in words:
            found, at = self.prefixes(text[a:b].encode()), 0
            for end in range(a + 1, b + 1):
                at += len(text[end - 1].encode())
                counts[end] = total + found[at]
            total = counts[b]
        return counts

    def _fitting(self, piece: str, budget: int) -> int:
        """Length of the longest prefix of a piece of at most ``budget`` tokens: the last end whose
        count, taken from the prefixes of one pass, fits. Where there is no such table, ends are
        halved between one that fits and one that does not."""
        counts = self.prefix_counts(piece)
        if counts is None:
            low, high = 0, len(piece)
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if self._piece(piece[:middle]) <= budget else (low, middle)
            return low
        end = max(i for i, n in enumerate(counts) if n <= budget)
        while end and self._piece(piece[:end]) > budget:  # a cut contraction is two words
            end -= 1
        return end

    def fitting(self, text: str, budget: int) -> int:
        """Length of the longest prefix of at most ``budget`` tokens."""
        total = 0
        for m in PIECES.finditer(text):
            more = self.pieces[m.group()]
            if total + more > budget:
                return m.start() + self._fitting(m.group(), budget - total)
            total += more
        return len(text)


@lru_cache(maxsize=4)
def counter(tokenizer: str) -> PrefixCounter:
    """One counter for each worker; a bare file name is looked up among the public ones."""
    if not os.path.isabs(tokenizer):
        import public_tokenizers

        tokenizer = str(public_tokenizers.path(tokenizer))
    made = PrefixCounter(tokenizer)
    made.words.make = made.total
    return made


def prefix_token_counts(
    df: DataFrame,
    tokenizer: str,
    budget: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_table: bool = False,
) -> DataFrame:
    """Per row: ``id_col``, ``n_bytes``, ``n_tokens`` and ``fit_chars``, the length of the longest
    prefix within ``budget`` tokens; with ``prefix_table`` also ``ends`` and ``counts``, the
    count of the text up to the end of each piece. A map without a shuffle."""
    ship_package(df.sparkSession)
    fields = [
        T.StructField(id_col, df.schema[id_col].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("fit_chars", T.LongType()),
    ]
    if prefix_table:
        fields += [T.StructField(x, T.ArrayType(T.LongType())) for x in ("ends", "counts")]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # bounds the Python strings held at once
                part = batch.slice(at, 500)
                texts = [x or "" for x in part.column(1).to_pylist()]
                counts = [tool.count(x) for x in texts]
                fit = [
                    len(x) if n <= budget else tool.fitting(x, budget)
                    for x, n in zip(texts, counts, strict=True)
                ]
                out = [part.column(0), part.column(2), pa.array(counts, pa.int64())]
                out.append(pa.array(fit, pa.int64()))
                if prefix_table:
                    tables = [tool.table(x) for x in texts]
                    out += [pa.array([t[k] for t in tables], pa.list_(pa.int64())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(out, names)

    text = F.col(quoted(text_col)).cast("string")
    return df.select(
        F.col(quoted(id_col)),
        text.alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"),
    ).mapInArrow(run, T.StructType(fields))
