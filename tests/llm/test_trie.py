"""The conversation trie against a brute-force version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from wireloom.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth int, place int, weight string"


def brute(rows):
    """Every node as the contract says: rows are (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(found)] for c, found in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own_members in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(own_members) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children.get(n, 0), leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, m in members.items()
    )


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0], r[1]))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, None, "w") for r in rows], SCHEMA).repartition(5)


def conversations(rng, many, texts):
    return [(c, turn, rng.choice(["user", "assistant", None]), rng.choice(texts)) for c in many for turn in range(rng.randint(1, 7))]


@pytest.mark.parametrize("small", [1, 7, 2000])
def test_equals_brute_force(spark, small):
    rng = random.Random(small)
    rows = conversations(rng, [*range(0, 12), *range(98, 130), 250, -7, -250, 10**12], ["", None, "a", "ab", "ü" * 40])
    rows += [(None, 1, "user", "nobody's"), (3, None, "user", "first"), (3, None, None, None), (4, 2, "user", "a"), (4, 2, "user", "a")]
    got = pt.prefix_trie(frame(spark, rows), small)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert ordered(got.collect()) == ordered(brute(rows))


@pytest.mark.parametrize("small", [3, 2000])
def test_a_long_conversation_and_many_copies(spark, small):
    rows = [(200, turn, "user", f"t{turn}") for turn in range(150)] + [(c, turn, "user", f"t{turn}") for c in range(201, 260) for turn in range(8)]
    assert ordered(pt.prefix_trie(frame(spark, rows), small).collect()) == ordered(brute(rows))


def test_empty_table(spark):
    assert pt.prefix_trie(frame(spark, [(1, 1, "a", "b")]).limit(0)).collect() == []
    assert ordered(pt.prefix_trie(frame(spark, [(7, 0, None, None)])).collect()) == ordered(brute([(7, 0, None, None)]))


def test_rollup_of_random_trees():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 60)
        parent = sorted(rng.randint(max(0, i - rng.randint(1, 60)), i - 1) for i in range(1, n))
        parent = [-1, *parent]
        values = [[rng.randint(0, 9), rng.randint(0, 9)] for _ in range(n)]
        want = [list(v) for v in values]
        for v in range(n - 1, 0, -1):
            want[parent[v]] = [a + b for a, b in zip(want[parent[v]], want[v], strict=True)]
        assert pt.rollup(parent, values) == want


def test_long_end_lists_travel_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 20)
    rows = [(c, turn, "user", "same") for c in range(500) for turn in range(7)]
    assert ordered(pt.prefix_trie(frame(spark, rows)).collect()) == ordered(brute(rows))
