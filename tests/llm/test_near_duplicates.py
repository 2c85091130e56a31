"""The grouped prefix join, components and the pipeline against plain Python."""

import random
import re
from collections import defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_text_operators import awkward_rows, brute_hits, brute_repeats, words_of

from txwarden.llm import jaccard_join
from txwarden.llm.components import connected_labels
from txwarden.llm.jaccard_join import near_duplicate_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, batch int, id string, size int"


def shingles(text, size=5):
    w = words_of(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def brute_components(rows):
    """(id, set size, smallest id reachable) for every row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    out = [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]
    return sorted(out, key=repr)


def families(seed, originals, copies, edits):
    """Originals, and copies of them with some words changed; a passage that many share."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(3))
    passage = " ".join(word() for _ in range(40))
    rows = []
    for _ in range(originals):
        base = [word() for _ in range(rnd.randint(6, 120))] + (passage.split() if rnd.random() < 0.5 else [])
        rows.append(" ".join(base))
        for _ in range(rnd.randint(0, copies)):
            copy = list(base)
            for _ in range(rnd.randint(0, edits)):
                copy[rnd.randrange(len(copy))] = word()
            rows.append(" ".join(copy).upper() if rnd.random() < 0.2 else " ".join(copy))
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block, batch, bucket", [(1 << 21, 4 << 20, 1 << 20), (300, 5000, 1000)])
def test_components_equal_brute_force(spark, monkeypatch, block, batch, bucket):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard_join, "BATCH_BYTES", batch)
    monkeypatch.setattr(jaccard_join, "BUCKET_SHINGLES", bucket)
    rows = families(1, 25, 12, 4) + [(1000 + i, t) for i, t in families(2, 2, 60, 2)]
    got = near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_components(rows)


def test_components_of_awkward_rows(spark):
    rows = awkward_rows()
    awkward = spark.createDataFrame(rows, SCHEMA)
    got = near_duplicate_components(awkward, keep=("id", "batch", "text")).collect()
    plain = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got]
    assert sorted(plain, key=repr) == brute_components([(r[0], r[1]) for r in rows])
    assert sorted(repr(r["text"]) for r in got) == sorted(repr(r[1]) for r in rows)
    assert near_duplicate_components(awkward.limit(0)).collect() == []


def test_one_row_of_each_group_passes_the_join(spark):
    """Repeated rows, groups without ids, equal ids of different texts, and rows without shingles."""
    prose = [" ".join(f"{c}{i}" for i in range(120)) for c in "abcdef"]
    near = lambda t: t.replace("50 ", "x ")
    texts = [(1, prose[0]), (1, prose[0]), (1, prose[0]), (9, near(prose[0]))]  # repeated rows
    texts += [(None, prose[1])] * 3 + [(None, near(prose[1]))]  # no ids at all
    texts += [(2, prose[2]), (2, near(prose[2])), (None, prose[2])]  # an id of two texts
    texts += [(None, prose[3]), (7, near(prose[3])), (7, near(prose[3]))]
    texts += [(3, prose[4]), (None, prose[5])]  # alone
    texts += [(4, ""), (4, ""), (5, None), (None, None), (None, None)]  # no shingles
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    kept = []
    for parts, order in ((1, rows), (5, rows[::-1])):
        docs = spark.createDataFrame(order, schema).repartition(parts)
        got = corpus_pipeline.jaccard_join(spark, docs, "").collect()
        kept.append(sorted([(r["doc_id"], r["text"]) for r in got], key=repr))
        assert got[0].asDict().keys() == set(corpus_pipeline.COLUMNS)
    assert kept[0] == kept[1]
    families = [(i, t.split()[0][0]) for i, t in kept[0] if t]
    assert sorted(families, key=repr) == sorted([(1, "a"), (None, "b"), (2, "c"), (7, "d"), (3, "e"), (None, "f")], key=repr)
    assert sorted([x for x in kept[0] if not x[1]], key=repr) == sorted([(4, ""), (4, ""), (5, None), (None, None), (None, None)], key=repr)


def test_labels_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 200 + i) for i in range(50)] + [(7, 100)]
    nodes = sorted({x for pair in links for x in pair} | {500})
    labels = spark.createDataFrame([(n, n) for n in nodes], "node long, label long")
    got = dict(connected_labels(labels, spark.createDataFrame(links, "a long, b long")).collect())
    want = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want


FOLDER = "/root/testdata/sf0.001"


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        pairs = [(d, r["text"]) for d, r in before.items()]
        if name != "mixing":
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "quality_rules":
            for d, r in before.items():
                w = words_of(r["text"])
                grams = defaultdict(int)
                for i in range(len(w) - 2):
                    grams[tuple(w[i : i + 3])] += 1
                again = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
                assert d not in after or len(w) >= 50 and 100 * len(again) <= 50 * len(w)
            assert len(after) > 0.6 * len(before)
        elif name == "jaccard_join":
            assert set(after) == {d for d, _, c in brute_components(pairs) if d == c}
        elif name == "suffix_dedup":
            removed = {d: n for d, _, n, _, _ in brute_repeats(pairs)}
            for d, r in before.items():
                left = len(after[d]["text"].encode())
                cut = len((r["text"] or "").encode()) - left
                assert removed[d] - 6 * 10 <= cut <= removed[d] and after[d]["n_chars"] == len(after[d]["text"])
        elif name == "decontamination":
            assert set(after) == {h[0] for h in brute_hits(pairs, items) if not h[-1]}
        else:
            by_source = defaultdict(lambda: [0, 0.0])
            for r in rows:
                assert r["copies"] in (1, 2, 3) and r["size"] == len(words_of(r["text"]))
                by_source[r["source"]][0] += r["taken"]
                by_source[r["source"]][1] = r["target"]
            longest = max(len(words_of(r["text"])) for r in before.values())
            assert all(abs(taken - target) <= longest for taken, target in by_source.values())
        if name not in ("suffix_dedup", "mixing"):
            assert all(after[d]["text"] == before[d]["text"] for d in after)
        before = after


def test_pipeline_of_awkward_and_empty_documents(spark, tmp_path):
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [r[:5] for r in awkward_rows()]
    for part in (rows, []):
        docs = spark.createDataFrame(part, "doc_id long, text string, lang string, source string, n_chars long")
        docs = docs.withColumn("size", F.lit("clash"))
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).toArrow())
        assert docs.count() <= len(part)
