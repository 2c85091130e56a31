"""The conversation trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from txwarden.llm.prefix_trie import end_digests, ordered_turns, prefix_trie, turn_texts, with_shared_heads

SCHEMA = "conv_id long, turn long, role string, text string, depth int, key_a string, weight int"
KEY = ["depth", "key_a", "key_b"]


def sequences(rows):
    """Rebuilt conversations, as the contract of the query has it."""
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute_nodes(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = set()
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p))))
        out.add((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(), p[-1][0] if p else None, p[-1][1] if p else None,
        ))
    return out


def found_nodes(df):
    turns = ordered_turns(df)
    crc = lambda c: F.crc32(c.cast("string").cast("binary")) % 6
    trie = prefix_trie(with_shared_heads(turns, lambda c: c - c % 100, crc, 5))
    nodes = turn_texts(trie.nodes, df).join(end_digests(trie.ends), KEY, "left")
    empty = hashlib.sha256(b"").hexdigest()
    return [
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
         r.ends_sha256 or empty, r.role, r.text)
        for r in nodes.collect()
    ]


def awkward():
    rnd = random.Random(3)
    rows = []
    for c in [*range(0, 330, 3), *range(100, 140), -5, -100, 10**12 + 1, 10**12]:
        for t in range(rnd.randint(1, 8)):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bé", "", None, "x" * 50])))
    rows += [(500, t, "user", f"turn {t}") for t in range(150)]  # one long conversation
    rows += [(501, t, "user", f"turn {t}") for t in range(140)]
    rows += [(c, t, "user", "same") for c in range(600, 800) for t in range(7)]  # copies
    rows += [(7000, None, "user", "no turn"), (7000, None, None, None), (7000, 2, "u", "tie"), (7000, 2, "u", "other")]
    rows += [(7001, 1, "u", "twice")] * 9  # repeated rows
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    return [(*r, 1, "clash", 2) for r in rows]


def test_nodes_equal_brute_force(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = found_nodes(df)
    assert len(got) == len(set(got))
    assert set(got) == brute_nodes(sequences(rows))


def test_order_and_partitions_do_not_matter(spark):
    rows = awkward()[:700]
    one = found_nodes(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    two = found_nodes(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7))
    assert sorted(one, key=str) == sorted(two, key=str)


def test_plain_trie_without_rebuilding(spark):
    rows = [(c, t, "user", str(min(t, c % 3))) for c in range(40) for t in range(c % 5 + 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    nodes = prefix_trie(ordered_turns(df)).nodes.collect()
    root = next(n for n in nodes if n.depth == 0)
    assert (root.n_convs, root.conv_id, root.parent_conv_id) == (40, 0, None)
    assert root.n_leaves == sum(n.n_children == 0 for n in nodes)
    assert root.n_children == sum(n.depth == 1 for n in nodes)


def test_end_lists_are_cut_in_chunks(spark):
    ids = [5, 70_000, 65_536, 65_535, -1, 10**12, 200_000]
    df = spark.createDataFrame([(i, 0, "u", "x") for i in ids], "conv_id long, turn int, role string, text string")
    trie = prefix_trie(ordered_turns(df))
    assert trie.ends.count() == 5
    want = hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    assert [r.ends_sha256 for r in end_digests(trie.ends).collect()] == [want]


def test_empty_table(spark):
    assert found_nodes(spark.createDataFrame([], SCHEMA)) == []
    assert found_nodes(spark.createDataFrame([(None, 1, "u", "x", 1, "", 1)], SCHEMA)) == []
