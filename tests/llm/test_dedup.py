"""Min-max near-duplicates and connected components against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wireloom.llm import minmax_dedup as m
from wireloom.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, id long, band long, component long"


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(80)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(7, 7), (3, 3)],
        "none": [],
    }[kind]
    frame = spark.createDataFrame([*edges, (None, 4), (4, None)], "u long, v long").repartition(3)
    got = {r["node"]: r["component"] for r in connected_components(frame, "u", "v").collect()}
    proper = [e for e in edges if e[0] != e[1]]
    assert got == union_find({n for e in proper for n in e}, proper)


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in words.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and 100 * len(x & y) >= 85 * len(x | y)]
    return union_find({i for i, _ in sets}, links)


def corpus():
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, n = [], 0

    def add(words):
        nonlocal n
        rows.append((n * 3, " ".join(words)))
        n += 1

    for _ in range(60):
        words = rng.choices(vocabulary, k=rng.choice([1, 3, 5, 6, 40, 120]))
        add(words)
        for _ in range(rng.choice([0, 0, 1, 4])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            add(copy)
    base = rng.choices(vocabulary, k=200)
    for k in range(40):  # each is like its neighbours, and less like those far off
        add(base[k:] + base[:k])
        if k % 2:
            base[(k * 37) % 200] = rng.choice(vocabulary)
    return [*rows, (9001, None), (9002, ""), (9003, " \n"), (0, rows[0][1]), (9004, rows[4][1].upper() + "\t"), (9005, "é É")]


def test_whole_job(spark):
    rows = corpus()
    frame = spark.createDataFrame([(*r, "en", 1, 2, 3) for r in [*rows, (None, rows[4][1]), (None, "alone here")]], DOCS).repartition(5)
    got = m.near_duplicates(frame).collect()
    want = brute(rows)
    assert len(got) == len(rows) + 2
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    assert {(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None} == {(want[rows[4][0]], False), (None, True)}
    sizes = {r["doc_id"]: r["n_shingles"] for r in got}
    assert all(sizes[i] == len(shingles(t)) for i, t in rows)


def test_prefixes_find_what_middles_miss(spark):
    """All documents in one bucket, of two versions, edits and cuts of a base; links must still be whole."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(160)]
    second = [w if i % 40 else f"v{i}" for i, w in enumerate(base)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        copy = list(second if i % 3 == 0 else base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 8])):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(6)}"
        if i % 4 == 1:
            copy = copy[: rng.choice([100, 110, 120, 130, 140, 150])]
        rows.append((i, " ".join(copy)))
    signed = m.signatures(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    one_bucket = signed.selectExpr("doc_id", "n_shingles", "digest", "array(1L) bands")
    found = m.components(m.stored(one_bucket, "signed"), spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["component_id"] for r in signed.join(found, signed["digest"] == found["own"]).collect()}
    assert got == brute(rows)
    assert 5 < len(set(got.values())) < 140


def test_no_rows(spark):
    assert m.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.integers(20, 400), st.floats(0.2, 0.95))
def test_estimate_is_close(n, share):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    y = np.concatenate([x[: int(n * share)], rng.integers(0, 1 << 63, n - int(n * share), dtype=np.uint64)])
    both = int(n * share)
    real = both / (2 * n - both)
    assert abs((m.min_max(x) == m.min_max(y)).mean() - real) < 0.2


def test_one_of_each_by_row(spark):
    rng = random.Random(5)
    a, b, c = (" ".join(rng.choices([f"w{i}" for i in range(500)], k=80)) for _ in range(3))
    rows = [(1, a), (1, a), (None, a), (None, a), (7, a), (7, b), (7, c), (None, c), (None, c + " more"), (8, c), (9, None), (9, ""), (None, " ")]
    frame = spark.createDataFrame([(i, t, j, "x") for j, (i, t) in enumerate(rows)], "doc_id long, text string, row long, kept string").repartition(3)
    got = m.one_of_each(frame)
    assert got.columns == frame.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted([(1, a), (7, b), (7, c), (9, None), (9, ""), (None, " ")], key=repr)
    assert m.one_of_each(frame.limit(0)).collect() == []
    texts = {}
    for n in range(60):
        words = a.split()
        words[n % 80] = "changed"
        texts[n] = " ".join(words) if n % 3 else " ".join(rng.choices(words, k=80))
    rows = [(n if n % 7 else None, t) for n, t in texts.items()]
    got = m.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    named = {n if n % 7 else 1000 + n: t for n, t in texts.items()}  # null ids come last
    root = brute(sorted(named.items()))
    assert sorted(r["text"] for r in got) == sorted(t for n, t in named.items() if root[n] == n)
