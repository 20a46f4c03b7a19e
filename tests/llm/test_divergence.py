"""Source divergence against a brute-force version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from wireloom.llm import source_skyband as sky

SCHEMA = "doc_id long, text string, lang string, source string, n long, part string, term int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=10, top=10):
    """Rows are (text, lang, source)."""
    counts, holds = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = TERM.findall(lower(text or ""))
        counts[lang or "", source or ""].update(words)
        holds[lang or ""].update(set(words))
    kept = {lang: sorted(t for t, n in held.items() if n >= least) for lang, held in holds.items()}
    out = []

    def shares(own, terms):
        whole = sum(own[t] for t in terms) + 2 * len(terms)
        return {t: 1 + 10**9 * (own[t] + 2) // whole for t in terms}

    def value(p, q):
        return (p - q) ** 2 // (p + q)

    def rank(lang, source, part, found):
        for i, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), 1):
            if part == "pair" or i <= top:
                out.append((lang, source, part, item, v, i))

    for lang, source in counts:
        terms, own = kept[lang], counts[lang, source]
        p = shares(own, terms)
        others = [s for k, s in counts if k == lang and s != source]
        pair = []
        for other in others:
            q = shares(counts[lang, other], terms)
            pair.append((sum(value(p[t], q[t]) for t in terms), other))
        rank(lang, source, "pair", pair)
        whole = sum((c for (k, _), c in counts.items() if k == lang), Counter())
        q = shares(whole, terms)
        rank(lang, source, "term", [(value(p[t], q[t]), t) for t in terms if own[t] > 0 and p[t] > q[t]])
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, *row, 7, "part", 3) for i, row in enumerate(rows)], SCHEMA).repartition(7)


def made(rng, many):
    words = ["the", "The", "ÄB", "äb", "x1y", "straße", "a_b", "no", "Ω", "it's"] + [f"w{'abcdefghij'[i % 10]}{'klmnop'[i % 6]}" for i in range(40)]
    rows = []
    for _ in range(many):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "s1", "s1", None])
        rows.append((" ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(0, 30))), lang, source))
    return rows


def test_equals_brute_force(spark):
    rows = made(random.Random(1), 300)
    rows += [(None, "en", "s1"), ("", "fr", "only"), ("12 34", "fr", "other"), (None, "it", "alone"), *[("copy of copy", "en", "s9")] * 30, ("\x00 \x7f a\x00b", "en", "s1")]
    got = sky.divergence(frame(spark, rows))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_small_steps_change_nothing(spark, monkeypatch):
    for name, value in (("HELD_TERMS", 5), ("BLOCK_ROWS", 20), ("CELLS", 30), ("POINTS", 3)):
        monkeypatch.setattr(sky, name, value)
    rows = made(random.Random(2), 200)
    assert sorted(tuple(r) for r in sky.divergence(frame(spark, rows), least_documents=2, top=3).collect()) == brute(rows, 2, 3)


def test_empty_table(spark):
    assert sky.divergence(frame(spark, [("a", "b", "c")]).limit(0)).collect() == []


def test_long_text(spark):
    rows = [("word " * 400_000 + "end" * 10, "en", "s1")] + [("word end", "en", f"s{i % 3}") for i in range(30)]
    assert sorted(tuple(r) for r in sky.divergence(frame(spark, rows)).collect()) == brute(rows)


def test_skyband():
    rng = random.Random(3)
    for k in (1, 2, 5):
        for _ in range(40):
            many = rng.randint(0, 400)
            n, total = (np.array([rng.randint(1, 12) for _ in range(many)], np.int64) for _ in range(2))
            terms = np.array([f"t{i:03}" for i in rng.sample(range(999), many)], object)
            want = [
                i for i in range(many)
                if sum(n[j] >= n[i] and total[j] <= total[i] and terms[j] < terms[i] for j in range(many)) < k
            ]
            assert sorted(sky.skyband(n, total, terms, k)) == want
