"""Personal data: fixed forms against plain expressions, and what the field adds on held-out texts."""

import hashlib
import random
import re

import numpy as np
import pytest

from wireloom.llm import skip_chain_crf as crf

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def check_sum(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    """The fixed forms as their expressions say."""
    text, digits = text or "", lambda m: re.sub("[^0-9]", "", m.group())
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and check_sum(digits(m))]
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return found


def written(spans):
    return ",".join(f"{crf.KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def spans(text):
    return next(crf.scan(iter([text.encode()]), crf.trained()))


def found(text):
    return [(crf.KINDS[kind], text[start:end], own) for kind, start, end, own in spans(text)]


def test_fixed_forms_equal_their_expressions():
    rng, alphabet = random.Random(3), "0123456789.+-@ ()abcZ_%é\n"
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        assert crf.fixed_forms(text) == base(text), text
    for _ in range(300):
        text, _ = crf.labelled_text(rng)
        assert crf.fixed_forms(text) == base(text), text


@pytest.mark.parametrize("text", ["a" * 300_000 + "@b.c", "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "x@" * 100_000, "a1" * 200_000, "1 2" * 100_000])
def test_long_texts_take_linear_time(text):
    assert all(span[3] or span[2] <= len(text) for span in spans(text))


def test_distant_repeats_share_a_label():
    filler = "plain words between " * 2000
    clear, partial = "+1 (743) 555-3824", "555-3824"
    assert found(f"{clear} {filler} {partial} {filler} 7435553824.") == [("phone", clear, True), ("phone", partial, False), ("phone", "7435553824", False)]
    assert found(f"{partial} {filler} {partial}") == []
    assert found(f"hein.19@mail5.example.com {filler} Hein.19!") == [("email", "hein.19@mail5.example.com", True), ("email", "Hein.19", False)]
    assert found("hein.19") == []


def test_other_forms():
    assert ("card", "4785.3805.9239.1139", False) in found("paid 4785.3805.9239.1139 then")
    assert found("paid 4785.3805.9239.1138 then") == []
    assert found("at 2001:db8::1 now") == [("ip", "2001:db8::1", False)]
    assert found("write joe (at) mail.com soon") == [("email", "joe (at) mail.com", False)]


CLEAN = [
    "on 2023-11-14 at 12:30, 14.11.2023 or 12:30:45", "1999, 2000 and 2001-2005", "versions v1.2.3, 1.2.3 and 1.2", "123e4567-e89b-12d3-a456-426614174000",
    "978-3-16-148410-0", "order 0000123456789012", "1,234,567 of 12.5 %", "1 2 3 4 5 6 7 8 9 10", "12.5 13.7 14.9 1,000 2,000", "org.apache.log4j-1.2.17.jar", "mp3 covid19 b2b", "a@b @name user@host",
    "1eb9c654e721b4f812088970e66a6345", "pages 12-15, 1990-1995", "256.1.1.1",
]


@pytest.mark.parametrize("text", CLEAN)
def test_ordinary_tokens_are_left_alone(text):
    assert found(f"Words before {text} and after.") == []


def test_held_out_accuracy():
    rng, right, wrong, missed = random.Random(5), 0, 0, 0
    for _ in range(500):
        text, truth = crf.labelled_text(rng)
        got = {(kind, c) for kind, start, end, _ in spans(text) for c in range(start, end)}
        want = {(kind, c) for kind, start, end in truth for c in range(start, end)}
        right, wrong, missed = right + len(got & want), wrong + len(got - want), missed + len(want - got)
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


def test_messages_equal_brute_force_on_trees():
    """Without loops, marginals are exact: compare with the sum over all labellings."""
    rng = np.random.default_rng(1)
    model = crf.Model({"any": 0, "x": 1}, rng.normal(size=(2, crf.LABELS)), rng.normal(size=(crf.LABELS, crf.LABELS)), rng.normal(size=crf.LABELS))
    batch = crf.Batch()
    tokens = [crf.Token(i, i + 1, "1") for i in range(5)]
    own = crf.Graph(tokens, [["any"], ["any", "x"], ["any"], ["x"], ["any"]], [True, True, False, False, False], ["k", None, None, "k", "k"])
    batch.add(own, [-1, -1, 2, -1, -1], model.features)
    got = crf.marginals(batch, model)
    certain = (batch.unary(model.unary) + 0)[:, 1:]
    total = np.zeros((5, crf.LABELS))
    first, last = [True, False, False, True, True], [False, False, True, True, True]
    unary = batch.unary(model.unary) + np.where(np.array(first)[:, None], model.chain[0], 0) + np.where(np.array(last)[:, None], model.chain[:, 0], 0)
    certain = unary[:, 1:].max(1) - unary[:, 0]
    links = crf.stars(own.keys, certain)
    assert len(links) == 2
    for labels in np.ndindex(*[crf.LABELS] * 5):
        if labels[2] != 2:
            continue
        score = sum(unary[i][y] for i, y in enumerate(labels) if i != 2) + model.chain[labels[0], labels[1]] + model.chain[labels[1], labels[2]]
        score += sum(model.skip[labels[a]] for a, b in links if labels[a] == labels[b])
        for i, y in enumerate(labels):
            total[i, y] += np.exp(score)
    assert np.allclose(got, total / total.sum(1, keepdims=True), atol=1e-3)


def test_table_with_nulls_repeats_and_clashing_names(spark):
    texts = [None, "", "no data", "x@y.zz", "x@y.zz", "é +1 (743) 555-3824"]
    rows = spark.createDataFrame([(i if i else None, t, "k", 1, True) for i, t in enumerate(texts)], "doc_id long, text string, spans string, start int, base boolean")
    got = sorted((tuple(r) for r in crf.personal_data_scan(rows).collect()), key=repr)
    want = []
    for i, t in enumerate(texts):
        own = base(t)
        counts = [sum(s[0] == kind for s in own) for kind in range(4)]
        want.append((i if i else None, *counts, hashlib.sha256(written(own).encode()).hexdigest(), written(own)))
    assert got == sorted(want, key=repr)
    assert crf.personal_data_scan(rows.limit(0)).count() == 0
