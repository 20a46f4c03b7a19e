"""Token ids, token files and packing against the library and brute force."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wireloom.llm import packing, token_files, tokens

VOCABULARY = tokens.default_vocabulary()
LIBRARY = Tokenizer.from_file(VOCABULARY)
DOCS = "doc_id long, text string, lang string, part int, id int, base long"
HARD = [
    "It's THE end... don't! (really) x=1,2;3 ²½ İstanbul ΣΑΣ é É ≠ ẞ 한국 日本語",
    "a b c d\x1ce\x85f \U0001f600\U0001f468‍\U0001f469 K ﬁ क़ <|endoftext|>x <|STARTOFTEXT|> a<|startoftext|>",
    "",
    " \n\t ",
    "'s 'S it'S... '' ' a' a'. b'.'",
]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def ids(text, cache=None):
    return np.frombuffer((cache or tokens.word_ids(VOCABULARY)).text_ids(text.encode()), "<u4").tolist()


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    assert ids(text) == library(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aBc'.,<|> \n\t\x1cİΣ́ ²e"), st.characters(exclude_categories=["Cs", "Cn"])), max_size=40))
def test_any_text(text):
    assert ids(text) == library(text)


def test_small_cache_and_parts(monkeypatch):
    text = " ".join(f"Word{i % 50}, {i}" for i in range(2000))
    monkeypatch.setattr(tokens, "PART_BYTES", 100)
    assert ids(text, tokens.WordIds(VOCABULARY, most=7)) == library(text)
    assert b" ".join(tokens.parts(b"ab cd  ef", 3)).split() == [b"ab", b"cd", b"ef"]
    assert list(tokens.parts(b"x" * 50, 3)) == [b"x" * 50]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 7, 8, 9) for i, t in rows], DOCS).repartition(3)


ROWS = [(5, "the end"), (3, None), (9, ""), (5, "the end"), (5, "another"), (None, "no id"), (1, "word " * 5000), (2**40, "x" * 3000)]


def test_token_files_round_trip(spark):
    got = token_files.token_file_digests(frame(spark, ROWS)).collect()
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for doc_id, text in ordered:
        own = np.array([*library(text or ""), 1], "<u4")
        want.append((doc_id, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_files_of_no_rows(spark):
    assert token_files.token_file_digests(frame(spark, [])).collect() == []


def test_wide_ids_and_damage(spark, tmp_path):
    folder = str(tmp_path / "files")
    manifest = token_files.write_token_files(frame(spark, ROWS), folder, end_id=70_000)
    rows = [row for shard in manifest.collect() for row in token_files.shard_documents(folder, shard["name"])]
    assert len(rows) == len(ROWS) and all(tokens_[-1] == 70_000 for _, _, tokens_ in rows)
    shard = manifest.first()["name"]
    (tmp_path / "files" / f"{shard}.bin").write_bytes(b"")
    with pytest.raises(ValueError, match="its index says"):
        list(token_files.shard_documents(folder, shard))


def check_packing(rows, capacity, texts):
    """Every token once, pieces cut as told, no gaps, no constraint broken."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc_id, text in texts.items():
        own = np.array([*library(text or ""), 0], "<u4")
        pieces = sorted(by_doc.pop(doc_id), key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(-(-len(own) // capacity.tokens)))
        for r in pieces:
            assert r["start"] == r["piece"] * capacity.tokens
            assert r["length"] == min(capacity.tokens, len(own) - r["start"])
            assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
    assert not by_doc
    limit = capacity.vector()
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= limit[0] and len(own) <= limit[1] and sum(r["length"] ** 2 for r in own) <= limit[2]
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [packing.Capacity(), packing.Capacity(64, 3, 2000), packing.Capacity(16)])
def test_packing(spark, capacity):
    rng = random.Random(4)
    texts = {i: " ".join(rng.choices(["the", "of", "and"], k=rng.choice([0, 1, 2, 5, 9, 30, 300, 2500]))) for i in range(120)}
    texts[500] = None
    if capacity.attention:
        texts = {i: t for i, t in texts.items() if len((t or "").split()) < 40}
    rows = packing.pack_documents(frame(spark, list(texts.items())), capacity).collect()
    used = check_packing(rows, capacity, texts)
    if capacity.attention is None:
        least = -(-sum(r["length"] for r in rows) // capacity.tokens)  # no packing can use fewer
        assert least <= used <= 1.002 * least


def test_packing_of_odd_rows(spark):
    rows = packing.pack_documents(frame(spark, ROWS)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"]) for r in rows if r["doc_id"] != 1)[:3] == [(False, 3, 0), (False, 5, 0), (False, 5, 0)]
    assert packing.pack_documents(frame(spark, [])).collect() == []


def plain_best_fit(lengths, capacity, rule, weights):
    """One piece at a time."""
    limit = capacity.vector()
    bins = []
    for n in sorted(lengths, reverse=True):
        item = np.array([n, 1, n * n])
        fits = [b for b in range(len(bins)) if (item <= bins[b]).all()]
        if rule == "norm":
            key = lambda b: (weights * ((bins[b] - item) / limit) ** 2).sum()
        else:
            key = lambda b: -(weights * item / limit * (bins[b] / limit)).sum()
        if fits:
            bins[min(fits, key=key)] -= item
        else:
            bins.append(limit - item)
    return len(bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.sampled_from([None, 2, 5]), st.sampled_from([None, 1600, 2000]), st.sampled_from(["norm", "dot"]))
def test_plan_holds_every_constraint(lengths, documents, attention, rule):
    capacity = packing.Capacity(40, documents, attention)
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.best_fit(counts, capacity, rule)
    held = {}
    for n, many in counts.items():
        for sequence, offset in zip(*plan.place(n, np.arange(many)), strict=True):
            held.setdefault(int(sequence), []).append((int(offset), n))
    assert sorted(held) == list(range(plan.sequences))
    limit = capacity.vector()
    for own in held.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= limit[0] and len(own) <= limit[1] and sum(n * n for _, n in own) <= limit[2]
    plain = plain_best_fit(lengths, capacity, rule, np.array((1.0, 0.25, 0.25)))
    assert plan.sequences <= plain + max(1, plain // 5)


def test_a_piece_too_large_and_a_bad_rule():
    with pytest.raises(ValueError, match="exceeds"):
        packing.best_fit({30: 1}, packing.Capacity(40, attention=100))
    with pytest.raises(ValueError, match="rule"):
        packing.best_fit({}, packing.Capacity(), "other")
