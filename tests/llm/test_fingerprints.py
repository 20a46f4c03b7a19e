"""Order MinHash against a plain version, and the documents that follow."""

import hashlib
import random

import pytest
from helpers import plan

from wireloom.llm import order_minhash as o

DOCS = "doc_id long, text string, part int, idx int, next string, copy boolean"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x", True) for i, t in rows], DOCS).repartition(4)


def edited(text, follow):
    half = len(text) // 2
    return text[: len(text) - half] + follow[:half]


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 40, 300]))) for _ in range(120)]
    texts[7] = "a b a b a b a b a b a b " * 30
    texts[8] = "\t é 😀 x\n"
    texts[9] = "".join(rng.choices("天地玄黃宇宙洪荒😀", k=90)) + " and words " + "x" * 20 + " " + "y" * 21
    return [(i * 5 - 40, t) for i, t in enumerate(texts)]


def test_next_and_edited(spark):
    rows = corpus()
    got = {r["doc_id"]: r for r in o.order_minhash(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for (doc_id, text), (_, follow) in zip(rows, [*rows[1:], rows[0]], strict=True):
        r = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited(text, follow).encode()).hexdigest()
        assert len(r["fingerprint"]) == (16 * o.SKETCHES if text.split() else 0)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def numbered(text):
    """Names and places of k-mers, occurrence-numbered, by plain loops."""
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    words = [t for w in words for t in (w if len(w) > 20 else [w])]
    runs = [tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    seen, out = {}, []
    for i, run in enumerate(runs):
        out.append((i, run, seen.setdefault(run, 0)))
        seen[run] += 1
    return out


def test_kmers(spark):
    rows = corpus()
    names = {}
    for r in o.with_kmers(frame(spark, rows), "text", "kmers").collect():
        want = numbered(r["text"])
        have = sorted((k["slot"], k["name"]) for k in r["kmers"])
        assert [slot for slot, _ in have] == [i for i, _, _ in want]
        for (_, run, number), (_, name) in zip(want, have, strict=True):
            assert names.setdefault((run, number), name) == name
    assert len(set(names.values())) == len(names)


def test_order_and_equality_count(spark):
    base = [f"w{i}" for i in range(200)]
    texts = {0: base, 1: base, 2: base[100:] + base[:100], 3: [w + "x" for w in base], 4: base[:190] + ["z"] * 10}
    rows = [(i, " ".join(w)) for i, w in texts.items()]
    kmers = o.with_kmers(frame(spark, rows), "text", "kmers")
    fps = {r["doc_id"]: r["fingerprint"] for r in kmers.select("doc_id", o.fingerprint(o.F.col("kmers")).alias("fingerprint")).collect()}
    near = lambda a, b: sum(x == y for x, y in zip(fps[a], fps[b], strict=True)) / o.SKETCHES
    assert near(0, 1) == 1 and near(0, 3) == 0
    assert 0.2 < near(0, 2) < 0.8  # the same words in another order
    assert near(0, 4) > 0.6


def test_sketches_are_the_least_of_one_order(spark):
    """Equal sketches of one order, and only these, have the same least k-mers in the same order of the text."""
    rows = corpus()[:40]
    kmers = o.with_kmers(frame(spark, rows + [(999, rows[5][1] + " and more")]), "text", "kmers").cache()
    orders = kmers.select("doc_id", o.F.explode("kmers").alias("k")).select("doc_id", "k.slot", *(o.F.xxhash64("k.name", o.F.lit(j)) for j in range(o.SKETCHES)))
    values = {}
    for doc_id, slot, *hashes in orders.collect():
        for j, h in enumerate(hashes):
            values.setdefault((doc_id, j), []).append((h, slot))
    seen, back = {}, {}
    for doc_id, sketches in kmers.select("doc_id", o.fingerprint(o.F.col("kmers"))).collect():
        assert len(sketches) == (o.SKETCHES if (doc_id, 0) in values else 0)
        for j, sketch in enumerate(sketches):
            chosen = sorted(values[doc_id, j])[: o.CHOSEN]
            told = tuple(h for h, _ in sorted(chosen, key=lambda x: x[1]))
            assert seen.setdefault(told, sketch) == sketch and back.setdefault(sketch, told) == told
    kmers.unpersist()
    assert len(seen) > 300


def test_texts_without_spaces(spark):
    rng = random.Random(4)
    signs = [chr(0x4E00 + i) for i in range(2000)]
    one, two = ("".join(rng.choices(signs, k=400)) for _ in range(2))
    got = {r["doc_id"]: r for r in o.order_minhash(frame(spark, [(1, one), (2, two), (3, one[:200] + "新" + one[200:])])).collect()}
    assert 0.05 < got[1]["near_edited"] < 0.6 and got[1]["near_next"] == 0
    kmers = o.with_kmers(frame(spark, [(1, one), (3, one[:200] + "新" + one[200:])]), "text", "kmers")
    a, b = (r[0] for r in kmers.select(o.fingerprint(o.F.col("kmers"))).collect())
    assert sum(x == y for x, y in zip(a, b, strict=True)) > 0.8 * o.SKETCHES  # one sign more


def test_odd_rows(spark):
    rows = [(5, "same text here"), (5, "same text here"), (5, None), (None, "no id at all"), (None, None), (9, "the end of it"), (2**62, "x")]
    got = o.order_minhash(frame(spark, rows)).collect()
    order = ["", "same text here", "same text here", "the end of it", "x", "", "no id at all"]
    want = sorted((len(t), hashlib.sha256(edited(t, f).encode()).hexdigest()) for t, f in zip(order, [*order[1:], order[0]], strict=True))
    assert sorted((r["n_chars"], r["edited_sha256"]) for r in got) == want
    empty = [r for r in got if not r["n_chars"]]
    assert all(r["fingerprint"] == "" and r["near_edited"] == 1.0 and r["near_next"] == 0.0 for r in empty)


@pytest.mark.parametrize("rows", [[], [(None, "a b c")], [(1, "one only here")]])
def test_few_rows(spark, rows):
    got = o.order_minhash(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r["near_next"] == 1.0 and r["fingerprint"] for r in got)


def test_ranges_by_binary_search(spark):
    firsts = [-5, 0, 3, 10, 11]
    rows = [(v,) for v in [-9, -5, -1, 0, 2, 3, 10, 11, 99, None]]
    got = [r[0] for r in spark.createDataFrame(rows, "v long").coalesce(1).select(o.range_of(o.F.col("v"), firsts)).collect()]
    assert got == [0, 1, 1, 2, 2, 3, 4, 5, 5, 5]


def test_plan(spark):
    text = plan(o.order_minhash(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    assert "Python" not in text and "Arrow" not in text
    assert text.count("Exchange (") + text.count("Exchange\n") <= 6


def test_common_beginnings_are_hashed_once(spark):
    """Fingerprints of two texts made together are those of each alone, whatever they have in common."""
    texts = [t for _, t in corpus()]
    pairs = [(i, a, b) for i, (a, b) in enumerate(zip(texts, [*texts[1:], texts[0]], strict=True))]
    pairs += [(1000 + i, a, edited(a, b)) for i, a, b in pairs] + [(2000, texts[5], texts[5]), (2001, "", ""), (2002, "a", "a b c d"), (2003, "x " * 70, "x " * 33)]
    rows = spark.createDataFrame(pairs, "doc_id long, one string, other string").repartition(4)
    both = o.with_kmers(o.with_kmers(rows, "one", "a"), "other", "b")
    got = o.with_fingerprints(both, "a", "b", "fa", "fb").select("doc_id", "fa", "fb", o.fingerprint(o.F.col("a")).alias("wa"), o.fingerprint(o.F.col("b")).alias("wb")).collect()
    assert len(got) == len(pairs)
    assert all(r["fa"] == r["wa"] and r["fb"] == r["wb"] for r in got)


def test_pieces_suit_texts_of_usual_length():
    """Comparisons beside one for each k-mer: the least of each piece, and the k-mers of the pieces that hold the least."""
    cost = lambda piece: 200 / piece + o.CHOSEN * piece  # noqa: E731  half a text of 400 words
    assert cost(o.PIECE) < 1.1 * min(map(cost, range(1, 100)))


def test_texts_of_any_number_of_pieces(spark):
    """The least k-mers are found wherever pieces begin and end."""
    sizes = [1, 2, 3, 4, *(n * o.PIECE + 2 + d for n in (1, 2, 5) for d in (-1, 0, 1))]
    rows = [(i, " ".join(f"a{x}" for x in range(n))) for i, n in enumerate(sizes)]
    kmers = o.with_kmers(frame(spark, rows), "text", "kmers")
    plain = o.F.transform(o.F.sequence(o.F.lit(0), o.F.lit(o.SKETCHES - 1)), lambda j: o.F.transform("kmers", lambda k: o.F.xxhash64(k["name"], j)))
    told = kmers.select("doc_id", plain.alias("values"), *(o._chosen(o._pieces(o.F.col("kmers")["name"]), o.F.lit(j)).alias(f"c{j}") for j in (0, 7)))
    for doc_id, values, *chosen in told.collect():
        for j, found in zip((0, 7), chosen, strict=True):
            least = sorted(values[j])[: o.CHOSEN]
            assert found == [v for v in values[j] if v in least], sizes[doc_id]
