"""Every operator over awkward rows, against plain Python."""

import base64
import hashlib
import random
import re
from collections import defaultdict
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from txwarden.llm import decontaminate as decon
from txwarden.llm import perspectives, suffix_dedup
from txwarden.llm.decontaminate import decontaminate
from txwarden.llm.language_id import identify
from txwarden.llm.mixing import pareto_mix
from txwarden.llm.perspectives import rotate_perspectives
from txwarden.llm.quality_classifier import quality_scores
from txwarden.llm.quality_rules import VECTOR, chi2_quantile, quality_verdicts, with_counts
from txwarden.llm.suffix_dedup import LogFamily, remove_repeats
from txwarden.llm.token_counts import counter, prefix_token_counts
from txwarden.llm.warc import assemble, parse, read_warc, resolve_revisits, write_warc

TOKENIZER = "word_bpe_49k.json"
PROSE = "the ship of the line was to be seen on an early day with rain and wind over hills "
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, batch int, id string, size int"


def awkward_rows():
    """Nulls in every column, empty, blank and long texts, copies, repeated rows, clashing names."""
    rnd = random.Random(5)
    words = [w * k for w in ("ab", "cé", "x1", "Dog", "né", "|", "**") for k in (1, 2, 3)]
    long = " ".join(rnd.choice(words) for _ in range(60_000))
    passage = "this passage of well over fifty bytes stands in several of the documents é here"
    texts = [
        None, "", " \t\n", PROSE * 3, PROSE * 3, PROSE * 3 + "end", long, "a", "ÀÉ ß 中文 ١٢", passage,
        "before " + passage + " after", passage[:49], passage[1:51], "x" * 200, "x" * 120, "\n".join(["same line"] * 30),
    ]
    texts += [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 80))) for _ in range(30)]
    rows = [(i, t, "en" if i % 3 else "fr", f"s{i % 4}", 1, 2, "x", 3) for i, t in enumerate(texts)]
    rows += [(3, PROSE * 3, "fr", "s3", 1, 2, "x", 3)] * 2  # repeated rows
    rows += [(None, passage, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_repeats(rows, length=50):
    big = 1 << 63
    first = {}
    key = lambda d: big if d is None else d
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, big), key(d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < key(d):
                gone[i : i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batch, bucket", [(4 << 20, 1 << 20), (2000, 500)])
def test_repeats_equal_brute_force(awkward, monkeypatch, batch, bucket):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    monkeypatch.setattr(suffix_dedup, "BUCKET_SUFFIXES", bucket)
    got = remove_repeats(awkward, with_text=True, keep=("batch", "id")).collect()
    plain = sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got], key=repr)
    assert plain == brute_repeats([(r[0], r[1]) for r in awkward_rows()])
    for r in got:
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"])
        r["kept_text"].encode()


def test_repeats_of_random_small_alphabet(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_SUFFIXES", 100)
    monkeypatch.setattr(suffix_dedup, "PIECE", 256)
    rnd = random.Random(2)
    base = "".join(rnd.choice("ab") for _ in range(900))
    rows = []
    for i in range(60):
        a = rnd.randrange(800)
        t = base[a : a + rnd.randrange(20, 400)]
        t = t if rnd.random() < 0.5 else t[: len(t) // 2] + rnd.choice("cd") + t[len(t) // 2 :]
        rows.append((i, t))
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).drop("spans").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_repeats(rows)


@pytest.mark.parametrize("batch", [4 << 20, 100])
def test_stretches_with_equal_upper_hash_halves_are_different(spark, monkeypatch, batch):
    """Pairs with one sample, of whose 74-byte stretches the upper 32 bits of the hash are equal."""
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    sample = "hpdbucyktifjzzevqcqprfvbep"
    around = [
        ("udurbbpkpnyrglsjmtyjkwsknbrwyrufvlrnwpobbexzt", "gtedhzpizkshcmfpstjeowapgjmmnxzyoezhzbjswvtbr"),
        ("zuqffdaticcxgeppfxrjsqftxrtlvnireagucmhqeumny", "fdfezmbtpcgsxflregkvdrzyojzrdepjvzgfslxcojnaj"),
        ("dssfdrayryolwdeilohoztsukbjododbauoxfutzagsfq", "jwpljvxfjvgtwiwaunflmgnxpzuwpttcbbklrogkfesla"),
        ("iblsrdyzjyqwggvwjhtroyvbpfljprgbrpnrdtadxjazu", "ihbiblakzhkjlejiaesxcdczzvvxcwdnyjvepyurrkksv"),
    ]
    rows = [(i, a + sample + b) for i, (a, b) in enumerate(around)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).drop("spans").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_repeats(rows)
    assert not any(r["n_removed"] for r in got)


def test_log_family_compares_second_parts():
    rnd = np.random.default_rng(1)
    family, want = LogFamily(), {}
    for _ in range(40):
        pairs = sorted({(int(a), int(b)) for a, b in rnd.integers(0, 12, (30, 2))})
        keys, rest = np.array(pairs, np.uint64).T
        first = rnd.integers(0, 1000, len(pairs))
        family.add(keys, first, rest.astype(np.uint32))
        for pair, f in zip(pairs, first.tolist(), strict=True):
            want[pair] = min(want.get(pair, f), f)
    probe = [(a, b) for a in range(14) for b in range(14)]
    keys, rest = np.array(probe, np.uint64).T
    none = np.iinfo(np.int64).max
    assert family.first(keys, rest.astype(np.uint32)).tolist() == [want.get(p, none) for p in probe]


def test_log_family_holds_smallest_and_merges():
    rnd = np.random.default_rng(0)
    family, want = LogFamily(), defaultdict(lambda: np.iinfo(np.int64).max)
    for _ in range(60):
        keys = np.unique(rnd.integers(0, 500, 40).astype(np.uint64))
        first = rnd.integers(0, 1000, len(keys))
        family.add(keys, first)
        for k, f in zip(keys.tolist(), first.tolist(), strict=True):
            want[k] = min(want[k], f)
    sizes = [len(k) for k, _ in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
    probe = np.arange(600, dtype=np.uint64)
    assert family.first(probe).tolist() == [want[k] if k in want else np.iinfo(np.int64).max for k in probe.tolist()]


def test_token_counts_equal_the_library(awkward):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(str(public_tokenizers.path(TOKENIZER)))
    want = sorted(
        (len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in awkward_rows()
    )
    got = prefix_token_counts(awkward, TOKENIZER, 20, prefix_table=True).collect()
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == want
    texts = {r[1] for r in awkward_rows() if r[1]}
    tool = counter(TOKENIZER)
    for text in sorted(texts, key=len)[:25]:
        counts = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert [tool.at(text, i) for i in range(len(text) + 1)] == counts
        assert tool.fitting(text, 5) == max(i for i, n in enumerate(counts) if n <= 5)
    for r in got:
        assert not r["counts"] or r["counts"][-1] == r["n_tokens"]


def test_prefixes_of_words_equal_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    library, tool, rnd = Tokenizer.from_file(str(public_tokenizers.path(TOKENIZER))), counter(TOKENIZER), random.Random(3)
    for _ in range(200):
        word = "".join(rnd.choice("aeinrstoßé") for _ in range(rnd.randint(1, 20)))
        whole = tool.prefixes(word.encode())
        ends = [len(word[:i].encode()) for i in range(1, len(word) + 1)]
        want = [len(library.encode(word[:i], add_special_tokens=False).ids) for i in range(1, len(word) + 1)]
        assert whole[0] == 0 and [whole[e] for e in ends] == want


def words_of(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, text or "")


def test_counts_of_quality_rules(awkward):
    got = with_counts(awkward.select("doc_id", "text"), F.col("text")).drop("doc_id").collect()
    for r in got:
        w = words_of(r["text"])
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        again = {i + k for i, g in enumerate(grams) if grams_count(grams)[g] > 1 for k in range(3)}
        lines = [x for x in (r["text"] or "").split("\n") if words_of(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r["text"] or ""), len(lines) - len(set(lines)), len(again))
        assert tuple(r)[1:] == want


_counted: dict = {}


def grams_count(grams):
    key = id(grams)
    if key not in _counted:
        n = defaultdict(int)
        for g in grams:
            n[g] += 1
        _counted.clear()
        _counted[key] = n
    return _counted[key]


def test_outliers_go_and_plain_documents_stay(spark):
    rnd = random.Random(1)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    prose = lambda: [rnd.choice(vocabulary) for _ in range(rnd.randint(60, 400))]
    rows = [(i, " ".join(prose()), "en", "a" if i % 3 else None) for i in range(900)]
    rows += [(1000 + i, " ".join(w + "***" for w in prose()), "en", "a") for i in range(40)]
    rows += [(2000 + i, " ".join(w * 9 for w in prose()), "en", "a") for i in range(40)]
    rows += [(3000, "too short", "en", "a"), (3001, " ".join(["one two three"] * 60), "en", "a"), (3002, None, None, None)]
    rows += [(4000 + i, " ".join(prose()), f"rare{i}", f"only{i}") for i in range(5)]
    got = {r["doc_id"]: r for r in quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert len(got) == len(rows)
    plain = [got[i]["kept"] for i in range(900)] + [got[4000 + i]["kept"] for i in range(5)]
    assert sum(plain) >= 903
    assert not any(got[i]["kept"] for i in [*range(1000, 1040), *range(2000, 2040)])
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in (3000, 3001, 3002))


def test_each_statistic_rejects_on_its_own(spark):
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    prose = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    rows = [(i, " ".join(prose(rnd.randint(60, 400)))) for i in range(600)]
    again = prose(47)
    lines = "\n".join(f"{a} {b}\nend" for a, b in zip(prose(60), prose(60), strict=True))
    rows += [
        (1000, " ".join(w * 5 for w in prose(200))),  # mean_word
        (1001, " ".join(w + "*" for w in prose(200))),  # symbol_rate
        (1002, lines),  # line_rate: no window of three words twice
        (1003, " ".join([*again, *prose(106), *again])),  # repeat_rate: 94 of 200 words
    ]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_verdicts(docs).collect()}
    assert sum(got[i]["kept"] for i in range(600)) >= 598
    for i, name in zip(range(1000, 1004), VECTOR, strict=True):
        assert not got[i]["base_failed"] and not got[i]["kept"], name
    assert got[1003]["n_dup_lines"] == 0 and got[1003]["n_repeat_words"] == 94
    assert got[1002]["n_repeat_words"] == 0


def numpy_distances(vectors, steps=5, share=0.75, prior=200.0):
    """{row: scaled squared distance} for {row: (lang, source, vector)}, written with NumPy."""
    names = list(VECTOR)
    floors, d = np.array([VECTOR[n] for n in names]), len(names)

    def at_share(cells, part):
        values, counts = np.unique(cells, return_counts=True)
        return values[np.argmax(np.cumsum(counts) >= part * len(cells))]

    def factor(c):
        low = np.zeros((d, d))
        for j in range(d):
            low[j, j] = np.sqrt(max(c[j, j] - low[j, :j] @ low[j, :j], floors[j] ** 2))
            for i in range(j + 1, d):
                low[i, j] = (c[i, j] - low[i, :j] @ low[j, :j]) / low[j, j]
        return low

    def distance(x, m, low):
        return (np.linalg.solve(low, (x - m).T) ** 2).sum(0)

    def cells(d2):
        return np.floor(np.log(d2 + 1e-6) * 100).astype(int)

    groups = defaultdict(list)
    for row, (lang, source, _) in vectors.items():
        for key in ((0, lang, source), (1, lang, None), (2, None, None)):
            groups[key].append(row)
    data = {k: np.array([vectors[r][2] for r in rows]) for k, rows in groups.items()}
    models = {}
    for k, x in data.items():
        rounded = np.floor(x * 1000 + 0.5).astype(int)
        mid = np.array([at_share(rounded[:, i], 0.5) for i in range(d)])
        mad = np.array([at_share(np.abs(rounded[:, i] - mid[i]), 0.5) for i in range(d)])
        moments = lambda y: (y.mean(0), (y.T @ y) / len(y) - np.outer(y.mean(0), y.mean(0)))
        models[k] = [(mid / 1000, factor(np.diag((1.4826 * mad / 1000) ** 2))), (moments(x)[0], factor(moments(x)[1]))]
    log_det = lambda low: 2 * np.log(np.diag(low)).sum()
    for _ in range(steps):
        fall = -np.inf
        for k, x in data.items():
            closer = []
            for m, low in models[k]:
                c = cells(distance(x, m, low))
                m2, c2 = moments(x[c <= at_share(c, share)])
                closer.append((m2, factor(c2)))
                fall = max(fall, log_det(low) - log_det(closer[-1][1]))
            models[k] = closer
        if fall < 1e-3:
            break
    final = {}
    for k, x in data.items():
        m, low = min(models[k], key=lambda p: round(log_det(p[1]), 9))
        half = at_share(cells(distance(x, m, low)), 0.5)
        final[k] = (len(x), m, low @ low.T, max(np.exp((half + 1) / 100) / chi2_quantile(d, 0.0), 1.0))

    def mix(own, parent):
        n, m, c, s = own
        a = n / (n + prior)
        gap = m - parent[1]
        return n, a * m + (1 - a) * parent[1], a * c + (1 - a) * parent[2] + a * (1 - a) * np.outer(gap, gap), a * s + (1 - a) * parent[3]

    out = {}
    for (level, lang, source), rows in groups.items():
        if level == 0:
            _, m, c, s = mix(final[0, lang, source], mix(final[1, lang, None], final[2, None, None]))
            d2 = distance(data[0, lang, source], m, factor(c)) / s
            out.update(zip(rows, d2, strict=True))
    return out


@pytest.mark.parametrize("sizes", [(199, 30), (200, 30), (260, 1)])
def test_distances_equal_numpy_at_every_group_size(spark, sizes):
    rnd = random.Random(sum(sizes))
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(2000)]
    rows = []
    for lang, source, n in (("en", "a", sizes[0]), ("en", None, sizes[1]), ("fr", "a", 60)):
        for _ in range(n):
            words = [rnd.choice(vocabulary) + "*" * (rnd.random() < 0.05) for _ in range(rnd.randint(50, 300))]
            words += words[: rnd.choice([0, 0, 0, 10, 20])]
            rows.append((len(rows), "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9)), lang, source))
    rows += [(len(rows) + i, " ".join(w * 6 for w in rows[i][1].split()), "en", "a") for i in range(12)]
    got = quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    got = {r["doc_id"]: r for r in got.collect()}
    vectors = {}
    for i, _, lang, source in rows:
        r = got[i]
        if not r["base_failed"]:
            n = r["n_words"]
            rates = (10 * r["n_symbols"] / n, 100 * r["n_dup_lines"] / n)
            vectors[i] = (lang, source, [np.log(1 + r["word_chars"] / n) * 4, *np.log(1 + np.array(rates)), r["n_repeat_words"] / n])
    expected = numpy_distances(vectors)
    assert len(expected) > len(rows) - 5
    limit = chi2_quantile(len(VECTOR), 6.0)
    for i, d2 in expected.items():
        assert got[i]["d2"] == pytest.approx(d2, rel=1e-6), i
        assert got[i]["kept"] == (d2 <= limit)
    assert not all(r["kept"] for r in got.values())


def test_quality_rules_on_awkward_rows(awkward, empty):
    rows = quality_verdicts(awkward).collect()
    assert len(rows) == len(awkward_rows()) and not any(r["kept"] and r["base_failed"] for r in rows)
    assert quality_verdicts(empty).collect() == []


def test_chi_square_quantiles():
    assert abs(chi2_quantile(4, 0.0) - 3.357) < 0.05 and abs(chi2_quantile(4, 2.326) - 13.28) < 0.15
    assert len(VECTOR) == 4


DECON = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_hits(rows, items, window=13):
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    windows = defaultdict(set)
    for i, t in items:
        w = words_of(lower(t), DECON)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[k : k + size])].add(i)
    out = []
    for d, t in rows:
        w = words_of(lower(t), DECON)
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                ids = windows.get(tuple(w[k : k + size]))
                if ids:
                    hit |= set(range(k, k + size))
                    found |= {str(i) for i in ids if i is not None}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [1 << 20, 400])
def test_decontamination_equals_brute_force(spark, awkward, monkeypatch, shard):
    monkeypatch.setattr(decon, "SHARD_BYTES", shard)
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 5, 13, 14, 30])))) for i in range(3, 20)]
    items = [x for x in items if len(x[1]) > 5]
    items += [(50, None), (51, ""), (52, PROSE), (None, "Alpha beta Gamma"), (52, "alpha-beta"), (10, "WITH rain and wind")]
    rows = [(r[0], r[1]) for r in awkward_rows()]
    rows += [(100 + i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(5, 60)))) for i in range(40)]
    for i in range(20):
        item = rnd.choice(items)[1] or "x"
        rows.append((200 + i, "Say " * rnd.randrange(40) + item.upper() + "; and alpha BETA gamma " + "so " * rnd.randrange(200)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(docs, bench).drop("spans").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_hits(rows, items)


@pytest.mark.parametrize("shard", [1 << 20, 400])
def test_long_spans_are_cut_at_any_coverage(spark, monkeypatch, tmp_path, shard):
    monkeypatch.setattr(decon, "SHARD_BYTES", shard)
    items = [(i, " ".join(f"é{i}w{j}" for j in range(20))) for i in range(8)] + [(8, "short item")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = lambda k, n: " ".join(f"ß{k}plain{j}" for j in range(n))
    part = " ".join(items[3][1].split()[:12])  # less than a window
    texts = {
        1: (f"{items[0][1]}, {plain(1, 2000)} ({items[1][1].replace('w', 'W')}) {plain(2, 900)} short item: {part}; {items[2][1]}",
            f", {plain(1, 2000)} () {plain(2, 900)} short item: {part}; "),
        2: (plain(3, 100), plain(3, 100)),
        3: (f"{plain(4, 100)} {items[4][1]}", None),  # contaminated
        4: (f"{plain(5, 900)}\n{items[5][1]} {items[6][1]}\n中文 {plain(6, 900)}", f"{plain(5, 900)}\n\n中文 {plain(6, 900)}"),
        5: ("", ""),
    }
    rows = [(i, t[0], "en", "s", len(t[0])) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert {i: r["text"] for i, r in got.items()} == {i: texts[i][1] for i in got}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_an_item_with_texts_in_several_shards_counts_once(spark, monkeypatch):
    texts = [" ".join(f"t{i}w{j}" for j in range(20)) for i in range(12)]
    bench = spark.createDataFrame([(7, t) for t in texts], "item_id long, text string")
    rows = [(1, " and ".join(texts)), (2, texts[0]), (3, "nothing of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(decon, "SHARD_BYTES", 400)
    got = {r["doc_id"]: r for r in decontaminate(docs, bench).collect()}
    assert [got[i]["n_items"] for i in (1, 2, 3)] == [1, 1, 0] and got[1]["n_hit"] == 240


def test_decontamination_without_items(spark, awkward, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate(awkward, none, keep=("id", "size")).collect()
    assert len(rows) == len(awkward_rows()) and not any(r["n_hit"] for r in rows)
    assert decontaminate(empty, none).collect() == []


def test_languages_are_told_apart(spark, awkward, empty):
    rnd = random.Random(6)
    parts = {"aa": ["the", "ing", "er", "on"], "bb": ["der", "sch", "ung", "ei"], "cc": ["que", "ción", "os", "la"]}
    rows = []
    for i in range(600):
        lang = rnd.choice(list(parts))
        text = " ".join("".join(rnd.choice(parts[lang]) for _ in range(3)) for _ in range(rnd.randint(1, 40)))
        rows.append((i, text, lang))
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !", "bb"), (1003, "中", None), (None, "ungung schei", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = F.col("doc_id") % 4 != 2
    got = {r["doc_id"]: r for r in identify(docs, learn).collect()}
    held = [i for i in range(600) if i % 4 == 2]
    assert sum(got[i]["lang_pred"] == rows[i][2] for i in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1003]["lang_pred"] != "und"
    assert got[None]["lang_pred"] == "bb"
    unlearned = identify(docs, F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlearned} == {("und", 0.0)}
    assert len(identify(awkward, F.col("doc_id") > 5).collect()) == len(awkward_rows())
    assert identify(empty, F.lit(True)).collect() == []


def test_code_lengths_equal_plain_sums():
    from collections import Counter
    from math import log2

    from txwarden.llm.language_id import START, ContextTrees, gram_codes

    texts = {"aa": b"abracadabra abra", "bb": b"banana bandana an"}
    counts, plain = {}, {}
    for lang, t in texts.items():
        codes = gram_codes(np.frombuffer(t, np.uint8), np.array([0, len(t)]), 3)
        grams, n = np.unique(codes, return_counts=True)
        counts[lang] = (grams, n)
        padded = bytes([START] * 3) + t
        plain[lang] = [Counter(padded[i - k : i + 1] for i in range(3, len(padded))) for k in range(4)]
    trees = ContextTrees(counts, 3)
    for probe in (b"abra", b"banx", b"", b"zz top", b"an"):
        got = trees.code_lengths(np.frombuffer(probe, np.uint8), np.array([0, len(probe)]))[0]
        for i, lang in enumerate(trees.langs):
            padded, bits = bytes([START] * 3) + probe, 0.0
            for at in range(3, len(padded)):
                for k in range(3, -1, -1):
                    context = padded[at - k : at]
                    below = {g: c for g, c in plain[lang][k].items() if g[:-1] == context}
                    n, q = sum(below.values()), len(below)
                    if padded[at - k : at + 1] in below:
                        bits -= log2(below[padded[at - k : at + 1]] / (n + q))
                        break
                    bits -= log2(q / (n + q)) if q else 0.0
                else:
                    bits += 8
            assert abs(got[i] - bits) < 1e-6


def test_grams_of_short_texts():
    from txwarden.llm.language_id import START, gram_codes

    data, offsets = np.frombuffer(b"abcdef", np.uint8), np.array([0, 1, 1, 3, 6])
    got = gram_codes(data, offsets, 3).tolist()
    want = []
    for t in (b"a", b"", b"bc", b"def"):
        p = bytes([START] * 3) + t
        want += [int.from_bytes(p[i : i + 4], "big") for i in range(len(t))]
    assert got == want


def test_classifier_learns_words_and_grams(spark, awkward, empty):
    rnd = random.Random(7)
    rows, labels = [], []
    for i in range(500):
        good = i % 5 != 0
        pool = ["harbour", "letters", "morning", "quiet", "river"] if good else ["hrbr***", "l$$t", "zzz|zz", "click", "river"]
        rows.append((i, " ".join(rnd.choice(pool) for _ in range(rnd.randint(5, 60)))))
        labels.append((i, int(good), "x"))
    labels += [(None, 1, "x"), (3, None, "x"), (4, 7, "x"), (9999, 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    learn = F.col("label_id") % 4 != 2
    got = {r["doc_id"]: r["score"] for r in quality_scores(docs, known, learn).collect()}
    held = [i for i in range(500) if i % 4 == 2]
    assert all((got[i] >= 0.7) == (i % 5 != 0) for i in held)
    assert got == {r["doc_id"]: r["score"] for r in quality_scores(docs.repartition(5), known.repartition(2), learn).collect()}
    scores = quality_scores(awkward, known, learn).collect()
    assert len(scores) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in scores)
    assert {r["score"] for r in quality_scores(docs, known.limit(0), learn).collect()} == {0.5}
    assert quality_scores(empty, known, learn).collect() == []


def test_mix_of_awkward_rows(awkward, empty):
    rows = pareto_mix(awkward).collect()
    assert len(rows) == len(awkward_rows())
    sources = defaultdict(lambda: [0, 0.0, 0])
    by_id = {(r[0], len(words_of(r[1]))): r[3] for r in awkward_rows()}
    for r in rows:
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        s = sources[by_id[r["doc_id"], r["size"]]]
        s[0] += r["size"]
        s[1] = r["target"]
        s[2] += r["taken"]
        assert r["target"] <= 3 * r["source_size"] + 1e-6
    assert all(s[0] == r["source_size"] for r in rows for s in [sources[by_id[r["doc_id"], r["size"]]]])
    assert abs(sum(s[1] for s in sources.values()) - sum(s[0] for s in sources.values())) < 1e-6
    again = pareto_mix(awkward.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert pareto_mix(empty).collect() == []


def test_mix_comes_near_its_targets(spark):
    rnd = random.Random(8)
    rows = [(i, "w " * rnd.randint(0, 60), rnd.choice(["a"] * 8 + ["b", "c", None])) for i in range(4000)]
    got = pareto_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        s = rows[r["doc_id"]][2]
        taken[s] += r["taken"]
        target[s] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)


def test_unequal_importance_changes_probabilities(spark):
    rows = [(i, "w w w w", "a" if i % 2 else "b", 1.5 if i % 4 < 2 else 0.5) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double")
    got = pareto_mix(docs, weights=(1, 1), importance=F.col("weight")).collect()
    high = sum(r["copies"] for r in got if r["doc_id"] % 4 < 2)
    low = sum(r["copies"] for r in got if r["doc_id"] % 4 >= 2)
    assert abs(high / 2000 - 1.5) < 0.06 and abs(low / 2000 - 0.5) < 0.06


PAGES = [
    (1, "http://a/x y", "<p>é same</p>"), (2, None, "<p>é same</p>"), (3, "http://b", None), (4, "u", ""),
    (5, "u", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n"), (6, "u", "\r\n\r\n"), (7, "u", "x" * 200_000),
    (8, "u", "tie"), (8, "u", "tie"), (9, "u", "tie"), (None, "u", "tie"), (None, "u", "null id only"),
]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, i) for i, p in enumerate(PAGES)], "page_id long, url string, html string, id int")
    write_warc(pages, f"{tmp_path}/w")
    records = read_warc(spark, f"{tmp_path}/w")
    assert records.count() == 3 * len(PAGES)
    got = resolve_revisits(assemble(records)).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    want = []
    for i, _, t in PAGES:
        ids = [j for j, _, u in PAGES if (u or "") == (t or "") and j is not None]
        first = min(ids, default=None)
        again = first is not None and (i is None or i > first)
        want.append((i, len((t or "").encode()), digest(t), "revisit" if again else "response", first if again else None))
    plain = []
    for r in got:
        again = r["type"] == "revisit"
        size = r["origin_bytes"] if again else r["response"]["payload_bytes"]
        sha = r["origin_digest"] if again else r["response"]["payload_digest"]
        assert r["response"]["stated_digest"] == sha and len(r["requests"]) >= 1
        page = None if r["page"] is None else int(r["page"])
        plain.append((page, size, sha, r["type"], int(r["origin_page"]) if again else None))
    assert sorted(plain, key=repr) == sorted(want, key=repr)


def test_warc_members_and_reverse_links(spark, tmp_path):
    import gzip

    def rec(kind, number, body, *more):
        head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{number}>", *more, f"Content-Length: {len(body)}"]
        return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + body + b"\r\n\r\n"

    parts = [rec("warcinfo", "i", b"x: y\r\n"), rec("request", "q", b"GET /"), rec("response", "r", b"HTTP/1.1 200\r\n\r\nbody", "WARC-Concurrent-To: <q>")]
    (tmp_path / "part-0.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    (tmp_path / "part-1").write_bytes(b"".join(parts).replace(b"<r>", b"<r2>").replace(b"<q>", b"<q2>"))
    rows = {r["record_id"]: r for r in assemble(read_warc(spark, str(tmp_path))).collect()}
    assert set(rows) == {"<r>", "<r2>"} and bytes(rows["<r>"]["response"]["payload"]) == b"body"
    assert [x["record_id"] for x in rows["<r2>"]["requests"]] == ["<q2>"]
    with pytest.raises(ValueError):
        list(parse(memoryview(parts[0][:-8]), True))


def test_warc_of_nothing(spark, tmp_path):
    write_warc(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/w")
    assert resolve_revisits(assemble(read_warc(spark, f"{tmp_path}/w"))).count() == 0


def brute_rotation(turns):
    talks = defaultdict(list)
    for c, t, r, x in turns:
        talks[c].append((t is None, t or 0, r or "unknown", x or ""))
    out = {}
    for c, rows in talks.items():
        rows.sort(key=lambda r: r[:2])
        for who in {r for _, _, r, _ in rows if r.lower() != "system"}:
            text, mask = "", []
            for _, _, r, x in rows:
                role = "system" if r.lower() == "system" else "assistant" if r == who else "user"
                text += f"<|im_start|>{role}" + (f" name={r}" if role == "user" else "") + "\n"
                start = len(text)
                text += x + "<|im_end|>\n"
                mask += [(start, len(text))] if role == "assistant" else []
            out[c, who] = (text, mask)
    return out


def test_rotation_equals_brute_force(spark):
    turns = [(1, 0, "System", "be kind"), (1, 1, "ann", "hé"), (1, 2, "bob", None), (1, 3, "cy", "x\n"), (1, None, "ann", "late")]
    turns += [(2, 0, "system", "alone"), (None, 5, None, "who"), (None, 6, "bob", ""), (3, 10_000, "a", "far"), (3, 2, "b", "near")]
    turns += [(4, i, "ab"[i % 2], f"t{i}") for i in range(1500)]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, conv int")
    found = defaultdict(list)
    for r in rotate_perspectives(df).orderBy("segment").collect():
        found[r["conv_id"], r["perspective"]].append(r)
    got = {}
    for k, parts in found.items():
        assert [p["segment"] for p in parts] == list(range(len(parts)))
        text = ""
        for p in parts:
            assert p["offset"] == len(text)
            text += p["text"]
        got[k] = (text, [(p["offset"] + m["start"], p["offset"] + m["end"]) for p in parts for m in p["mask"]])
    assert got == brute_rotation(turns)
    assert len(found[4, "a"]) == 2
    assert rotate_perspectives(df.limit(0)).collect() == []


def test_rotation_cuts_long_dialogues_by_rank(spark, monkeypatch):
    """Equal turn numbers, null conversations; segments are the same however rows are dealt."""
    monkeypatch.setattr(perspectives, "SEGMENT_ROWS", 10)
    rows = [(1, 3, "a", f"x{i}") for i in range(200)] + [(1, 4, "b", "y"), (1, 2, "a", "z"), (2, 0, "c", "short")]
    rows += [(None, i, "System" if i % 5 == 0 else "xyz"[i % 3], f"n{i}") for i in range(33)]
    found = []
    for n in (1, 7):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(n)
        found.append(sorted(rotate_perspectives(df).collect(), key=str))
    assert found[0] == found[1]
    parts = sorted((r for r in found[0] if r["perspective"] == "a"), key=lambda r: r["segment"])
    assert [len(r["messages"]) for r in parts] == [10] * 20 + [2]
    assert parts[0]["messages"][0]["content"] == "z" and parts[-1]["messages"][-1]["content"] == "y"
    for conv, who in {(r["conv_id"], r["perspective"]) for r in found[0]}:
        own = sorted((r for r in found[0] if (r["conv_id"], r["perspective"]) == (conv, who)), key=lambda r: r["segment"])
        at = 0
        for r in own:
            assert r["offset"] == at
            at += len(r["text"])


def test_rotation_of_turns_numbered_by_time(spark):
    rows = [(1, 1_700_000_000 + 1000 * i, "ab"[i % 2], f"t{i}") for i in range(40)]
    got = rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(r["segment"], len(r["messages"])) for r in got] == [(0, 40)] * 2


def test_the_subpackage_is_optional():
    root = Path(__file__).resolve().parents[2]
    for file in (root / "txwarden").rglob("*.py"):
        if "llm" not in file.relative_to(root).parts:
            assert "txwarden.llm" not in file.read_text()


def test_mix_of_repeated_ids_does_not_depend_on_order(spark):
    """Ids that many different texts of one size share, and null ids."""
    rows = [(i % 5 if i % 7 else None, f"w{i} " + "x " * (i % 3), f"s{i % 2}") for i in range(400)]
    found = []
    for turn, n in ((1, 1), (-1, 4), (3, 9)):
        df = spark.createDataFrame(rows[::turn] if turn != 3 else sorted(rows, key=str), "doc_id long, text string, source string")
        mixed = pareto_mix(df.repartition(n), keep=("text",))
        found.append(sorted((r["doc_id"] or -1, r["text"], r["taken"]) for r in mixed.collect()))
    assert found[0] == found[1] == found[2]


def test_repeated_pages_have_one_request_each(spark, tmp_path):
    rows = [(7, "http://a", "same")] * 300 + [(None, None, None)] * 30 + [(8, "http://b", "same"), (9, "http://c", "own")]
    write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), f"{tmp_path}/w")
    found = assemble(read_warc(spark, f"{tmp_path}/w")).collect()
    assert len(found) == 332
    assert {(len(r["requests"]), len(r["metadata"])) for r in found} == {(1, 1)}


def test_budget_of_long_unbroken_texts():
    """Base64, letters, CJK and mixed texts without blanks, against the library; long ones in time."""
    import time

    import public_tokenizers
    from tokenizers import Tokenizer

    tool, library = counter(TOKENIZER), Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    rnd = random.Random(8)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    kinds = {
        "base64": base64.b64encode(rnd.randbytes(37_500)).decode(),
        "letters": "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(50_000)),
        "cjk": "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(17_000)),
        "accents": "naïveé" * 5000,
        "quotes": "it'll'sx.'re12" * 3000,
        "joined": "e\u0301a" * 2000,
    }
    for name, text in kinds.items():
        budget = count(text) // 2
        began = time.time()
        end = tool.fitting(text, budget)
        assert time.time() - began < 10, name
        assert 0 < end < len(text) and count(text[:end]) <= budget, name
        assert all(count(text[: end + k]) > budget for k in range(1, 4)) or name == "joined", name
    for text in ("it'll go'll", "abcdefgh'sabc'll", "ab<|endoftext|>cd"):
        for budget in range(count(text)):
            want = max(i for i in range(len(text) + 1) if count(text[:i]) <= budget)
            if "<|" not in text:
                assert tool.fitting(text, budget) == want
            assert count(text[: tool.fitting(text, budget)]) <= budget
    began = time.time()
    assert 0 < tool.fitting("qzxj" * 250_000, 1000) < 10_000
    assert time.time() - began < 30


def test_classifier_sample_is_bounded_whatever_the_ids(spark, monkeypatch):
    """One id with many labels, one with many documents, labels that are text, fractions or null."""
    from txwarden.llm import quality_classifier as classifier

    docs = [(i, ("good plain prose " if i % 2 else "#### spam !!!! ") * 9, 1) for i in range(200)]
    docs += [(7, f"good plain prose number {i}", 1) for i in range(500)]
    labels = [(i, str(i % 2)) for i in range(200)] + [(7, "1")] * 500 + [(1, "0.9"), (3, "good"), (5, None), (None, "1")]
    seen = []
    frame = type(spark.range(1))
    fetch = frame.groupBy

    def spy(self, *keys):
        if "label_id" in self.columns and "text" in self.columns:
            seen.append(self.count())
        return fetch(self, *keys)

    monkeypatch.setattr(frame, "groupBy", spy)
    d = spark.createDataFrame(docs, "doc_id long, text string, quality int").repartition(3)
    scores = classifier.quality_scores(d, spark.createDataFrame(labels, "doc_id long, quality string"), F.lit(True), sample_rows=150)
    got = [(r["doc_id"], r["score"]) for r in scores.collect()]
    assert seen and 0 < seen[0] <= 300
    assert len(got) == len(docs)
    assert all((score > 0.5) == bool(i % 2) for i, score in got if i != 7)
