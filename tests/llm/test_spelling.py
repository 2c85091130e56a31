"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from txwarden.llm import spelling
from txwarden.llm.spelling import corpus_words, last_forms, near_pairs, variant_forms

WORDS = "word string, n long"
LOW = str.maketrans(spelling.UPPER, spelling.LOWER)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, times=2):
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, words[w], len(near[w]), form[w], words.get(form[w]), root))
    return out


def found(df):
    rows = [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def vocabulary(seed, letters="abcé", count=250):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 7))): rnd.choice([3, 3, 4, 6, 12, 24, 60]) for _ in range(count)}
    long = "ab" * 1500
    words |= {long: 9, long + "a": 4, long[:-1] + "é": 20, "z" * 2500: 5, "z" * 2501: 5, "q": 3, "abcde": 8, "badce": 8}
    return words


@pytest.mark.parametrize("split_rows", [10, 60, 20_000])
def test_forms_equal_brute_force(spark, split_rows):
    """Also where blocks are cut into many tiles."""
    words = vocabulary(split_rows)
    df = spark.createDataFrame(list(words.items()), WORDS).repartition(4)
    assert found(variant_forms(df, 2, split_rows)) == brute(words)


def test_small_gram_tiles_find_the_same_pairs(spark, monkeypatch):
    words = sorted(vocabulary(1))
    want = {tuple(sorted((a, b))) for a in words for b in words if one_edit(a, b)}
    for tile in (1024, 7):
        monkeypatch.setattr(spelling, "TILE", tile)
        got = []
        for two in spelling.KEYS:  # one block holds all words
            i, j = spelling.near_in_block(words, np.zeros(len(words), int), two)
            got += [tuple(sorted((words[a], words[b]))) for a, b in zip(i, j)]
        assert len(got) == len(set(got)) and set(got) == want


def test_pairs_come_once(spark):
    words = vocabulary(2, "ab", 120)
    df = spark.createDataFrame(list(words.items()), WORDS)
    pairs = [tuple(sorted((r.a, r.b))) for r in near_pairs(df).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_chains_of_forms(spark):
    n = 20
    chain = [(f"w{i}", f"w{i + 1}") for i in range(n)]
    df = spark.createDataFrame(chain + [("x", "y")], "word string, form string")
    got = {r.word: r.root for r in last_forms(df).collect()}
    assert got == {f"w{i}": f"w{n}" for i in range(n)} | {"x": "y"}


def test_words_of_awkward_texts(spark):
    rnd = random.Random(9)
    texts = [None, "", " \n1 2", "Straße ÀÉ×÷ naïve café", "x" * 3000 + " " + "x" * 3000, "aaa-bbb_ccc"]
    texts += [" ".join("".join(rnd.choice("abAÉé") for _ in range(rnd.randint(1, 7))) for _ in range(200)) for _ in range(40)]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, texts[8], None, None)] + [(7, texts[7], "r", 2)] * 3
    want = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(LOW)):
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(3)
    got = {r.word: r.n for r in corpus_words(df, drop_every=97).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}


def test_empty(spark):
    assert found(variant_forms(spark.createDataFrame([], WORDS))) == set()
    assert found(variant_forms(spark.createDataFrame([("alone", 3)], WORDS))) == {("alone", 3, 0, None, None, "alone")}
