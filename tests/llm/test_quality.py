"""Quality rules against brute force and planted outliers."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from wireloom.llm import quality_mcd as q

DOCS = "doc_id long, text string, lang string, source string, n_words long, kept string"


def brute(text):
    text = text or ""
    white = " \t\n\x0b\x0c\r"
    words = "".join(" " if c in white else c for c in text).split(" ")
    words = [w for w in words if w]
    lines, dup = Counter(), 0
    for line in text.split("\n"):
        if line.strip(white):
            dup += lines[line] > 0
            lines[line] += 1
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


@given(st.text(alphabet="ab é\n\t#|\x1c\x85", max_size=80))
def test_statistics(text):
    assert q.text_statistics(text.encode()) == brute(text)


@pytest.mark.parametrize("size", [1, 2, 3, 8])
def test_repeats(size):
    rng = random.Random(size)
    for _ in range(60):
        words = [bytes([97 + rng.randrange(2)]) for _ in range(rng.randrange(60))]
        seen = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
        want = {j for i in range(len(words) - size + 1) if seen[tuple(words[i : i + size])] > 1 for j in range(i, i + size)}
        assert q.repeated_words(words, size) == (len(want) if len(words) > size else 0)


def prose(rng, n):
    words = ["the", "of", "river", "stone", "and", "walking", "under", "light"]
    return " ".join(rng.choice(words) + str(i % 97 if rng.random() < 0.3 else "") for i in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.choice([25, 60, 200, 900])), "en", "hot" if i % 3 else f"s{i % 4}") for i in range(900)]
    rows += [(2000 + i, "".join(w + "###" + " " for w in prose(rng, 120).split()), "en", "hot") for i in range(25)]
    rows += [(3000 + i, prose(rng, 100), None, None) for i in range(4)]
    rows += [(4000, None, "en", "hot"), (4001, "", "de", "rare"), (None, prose(rng, 50), "fr", None), (5, rows[5][1], "en", rows[5][3])]
    return rows


def test_outliers(spark, corpus):
    docs = spark.createDataFrame([(*row, 7, "x") for row in corpus], DOCS).repartition(4)
    got = {(r["doc_id"], r["n_words"]): r for r in q.quality_rules(docs).collect()}
    assert q.quality_rules(docs).count() == len(corpus)
    for doc_id, text, _, _ in corpus:
        n, chars, symbols, dup, repeated = brute(text)
        r = got[doc_id, n]
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (chars, symbols, dup, repeated)
        assert r["base_failed"] == (n < 20 or 100 * repeated > 30 * n)
        assert r["kept"] == (not r["base_failed"] and not (doc_id and 2000 <= doc_id < 3000)), doc_id


@pytest.mark.parametrize("part", [0.3, 0.45])
def test_cells_with_much_junk(spark, part):
    """Junk of one kind is rejected as long as it is less than half of a cell."""
    rng = random.Random(9)
    bad = int(1000 * part)
    rows = [(i, prose(rng, rng.choice([60, 120, 200, 400])), "en", "s", 7, "x") for i in range(1000 - bad)]
    rows += [(5000 + i, "".join(w + "###" + " " for w in prose(rng, rng.choice([60, 120, 200, 400])).split()), "en", "s", 7, "x") for i in range(bad)]
    got = q.quality_rules(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    assert all(r["kept"] == (r["doc_id"] < 5000) for r in got if not r["base_failed"])


def test_no_rows(spark):
    assert q.quality_rules(spark.createDataFrame([], DOCS)).collect() == []


def test_estimate_equals_brute_force(spark):
    """The same steps in numpy, on one cell."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(0, [30, 60, 90, 30, 400], (700, 5))).astype(int)
    x[:150, 1] += 900
    frame = spark.createDataFrame([("c", *map(int, row)) for row in x], "cell string, x0 long, x1 long, x2 long, x3 long, x4 long")
    got = q.fit(frame.repartition(5)).first()
    floor = np.diag((np.array(q.FLOORS) * q.UNIT) ** 2)

    def quantile(v, p):
        return sorted(v)[int(np.ceil(len(v) * p)) - 1]

    mean = np.array([quantile(c, 0.5) for c in x.T], float)
    cov = np.diag([((quantile(c, 0.75) - quantile(c, 0.25)) / 1.349) ** 2 for c in x.T])
    for _ in range(4):
        d = x - mean
        bins = np.floor(np.log1p(np.maximum(np.einsum("ni,ij,nj->n", d, np.linalg.inv(cov + floor), d), 0)) * q.FINE)
        near = x[bins <= quantile(bins, 0.75)]
        mean, cov = near.mean(axis=0), np.cov(near.T, bias=True)
    assert np.allclose(got["mean"], mean) and abs(mean[1]) < 60
    assert np.allclose(got["inverse"], q._inverse(cov))
    assert got["scale"] >= 1
