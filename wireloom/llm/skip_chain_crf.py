"""Personal data in texts: four fixed forms, and what a skip-chain conditional random field adds to them.

The fixed forms (mail addresses, IP addresses, payment cards, international telephone numbers) are certain.  The field
labels candidate tokens, which are runs without white space that hold a digit or an at sign.  A token's label depends on its
own form and that of the digit groups around it, on a cue word before or after it, and on the labels of its neighbours (the
chain).  Tokens of a document that repeat each other or are alike (the same last seven digits, or the same local part of an
address) also share a potential with the most certain of them, however far away it is (the skips): ``555-3824`` alone is no
telephone number, but it is one in a text that holds ``+1 (743) 555-3824``.  Tokens of fixed forms are observed.  Marginals
come from loopy message passing over chains and skips of many documents at once, until no message changes.

Skips form a star around one token of each group, so their number is that of the tokens, and one message reaches all.

The weights are fitted once on the driver, by the pseudo-likelihood of labelled texts; these are made from a seed
(``TRAINING_TEXTS`` of them), so every run has the same model, whatever the tables hold.

Nulls: a null text is an empty one.  Empty texts and texts without candidates have no spans.  Repeated rows are scanned alike.
Whole texts are read, in linear time.  An empty table gives an empty result; other columns are kept if asked for.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ["email", "ip", "card", "phone"]
#: Label 0 is none, the others are kinds.
LABELS = 1 + len(KINDS)

# Fixed forms.  A digit run can only begin a match where it begins itself, so later beginnings are not tried.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)

#: Candidate tokens, from where white space ends.
CANDIDATE = re.compile(r"(?<!\S)\S*?(?:[0-9@]|\(at\)|\[at\])\S*")
WORD = re.compile(r"\S+")
AT_MARKS = ("@", "(at)", "[at]")
NUMERIC = re.compile(r"[+(]*[0-9][0-9().,/:-]*\Z")
DOMAIN_LIKE = re.compile(r"[\w-]+(?:\.[\w-]+)+\Z")
ADDRESS_LIKE = re.compile(r"[^@\s]+(?:@|\(at\)|\[at\])[\w-]+(?:\.[\w-]+)+\Z")
V6_LIKE = re.compile(r"(?:[0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4}\Z")
OPENERS, CLOSERS = "\"'<([{#*$%&|>", "\"'<>)]}.,;:!?#*$%&|"
#: Bytes that are no digits, for a look at whether a text can hold anything at all.
NO_DIGITS = bytes(b for b in range(256) if not 48 <= b <= 57)
LEAST_DIGITS = 4
#: Last digits by which numbers are alike; fewer make no skip.
ALIKE_DIGITS = 7

#: Words that announce a kind (fixed values, four languages).
CUES = {
    "phone": "tel phone telephone call fax mobile telefon handy telefax anruf téléphone appelez portable teléfono móvil llame",
    "email": "mail email e-mail courriel correo contact kontakt",
    "card": "card visa mastercard credit karte kreditkarte carte tarjeta",
    "ip": "ip host server address adresse serveur servidor",
}
CUE_KIND = {word: kind for kind, words in CUES.items() for word in words.split()}

#: Labelled texts that the weights are fitted on, and steps of the fit.
TRAINING_TEXTS, STEPS, RATE, DECAY = 1_500, 250, 0.1, 1e-4
#: Marginal from which a token is labelled; messages stop at this change, or after so many rounds.
SURE, STILL, ROUNDS = 0.8, 1e-4, 200
#: Tokens whose messages are passed at once, about.
TOGETHER = 20_000

SPANS = "array<struct<kind:int,start:int,end:int,base:boolean>>"


class Token(NamedTuple):
    start: int
    end: int
    text: str


class Model(NamedTuple):
    features: dict[str, int]
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # label x next label
    skip: np.ndarray  # by label, for tokens that agree on it


def luhn(digits: str) -> bool:
    """Whether the digits pass the check sum of payment cards."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def fixed_forms(text: str) -> list[tuple[int, int, int]]:
    """Spans (kind, start, end) of the fixed forms, by kind and start."""
    found, end = [], 0
    if "@" in text:
        at = text.find("@")
        while at >= 0:
            domain = DOMAIN.match(text, at)
            if domain:
                start = at
                while start > end and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] in "._%+-"):
                    start -= 1
                if start < at:
                    end = domain.end()
                    found.append((0, start, end))
            at = text.find("@", at + 1)
    if text.count(".") >= 3:
        found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if PHONE_DIGITS[0] <= len(digits_of(m.group())) <= PHONE_DIGITS[1]]
    return found


def trimmed(text: str, start: int, end: int) -> Token | None:
    """A token without punctuation at its edges; brackets around digits stay as a pair."""
    while start < end and text[start] in OPENERS and not (text[start] == "(" and ")" in text[start:end]):
        start += 1
    while start < end and text[end - 1] in CLOSERS and not (text[end - 1] in ")]" and ("(" if text[end - 1] == ")" else "[") in text[start:end]):
        end -= 1
    return Token(start, end, text[start:end]) if start < end else None


def candidates(text: str, locals_of: set[str]) -> list[Token]:
    """Candidate tokens in order: those with digits or at signs, neighbours of at signs that stand alone, and repeated local parts."""
    spelled = any(not any(c.isdigit() for c in name) for name in locals_of)
    alone = any(f" {mark} " in text for mark in AT_MARKS)
    if not (spelled or alone):
        return [token for m in CANDIDATE.finditer(text) if (token := trimmed(text, *m.span()))]
    words = [m.span() for m in WORD.finditer(text)]
    held = [text[start:end] for start, end in words]
    chosen = {i for i, word in enumerate(held) if CANDIDATE.match(word)}
    chosen |= {i + step for i, word in enumerate(held) if word in AT_MARKS for step in (-1, 1) if 0 <= i + step < len(held)}
    chosen |= {i for i, word in enumerate(held) if word.strip(OPENERS + CLOSERS).lower() in locals_of}
    return [token for i in sorted(chosen) if (token := Token(*words[i], held[i]) if held[i] in AT_MARKS else trimmed(text, *words[i]))]


def _bucket(n: int) -> str:
    return str(n) if n < 13 else "13-19" if n < 20 else "20+"


def _word(text: str) -> str:
    return text.strip(OPENERS + CLOSERS + "([").lower()


def _chained(text: str, a: Token, b: Token) -> bool:
    """Whether two tokens may belong to one mention: digit groups, or a name and an at sign, with nothing but a gap between."""
    between = text[a.end : b.start]
    if len(between) > 2 or between.strip(" \t\u00a0"):
        return False
    return bool(NUMERIC.match(a.text) and NUMERIC.match(b.text)) or a.text in AT_MARKS or b.text in AT_MARKS


class Graph(NamedTuple):
    """Tokens of one document, with what the field needs to know of them."""

    tokens: list[Token]
    features: list[list[str]]
    chained: list[bool]  # to the next token
    keys: list[str | None]


def graph(text: str, base: Sequence[tuple[int, int, int]]) -> Graph:
    """The candidate tokens of a text, their features, neighbours, and the keys by which they are alike."""
    locals_of = {text[start : text.index("@", start)].lower() for kind, start, _ in base if kind == 0}
    locals_of = {name for name in locals_of if len(name) >= 4 and not name.isalpha()}
    tokens = candidates(text, locals_of)
    chained = [_chained(text, a, b) for a, b in zip(tokens, tokens[1:], strict=False)] + [False] * bool(tokens)
    numeric, seen = [bool(NUMERIC.match(token.text)) for token in tokens], observed(tokens, base)
    features: list[list[str]] = []
    keys: list[str | None] = []
    start = 0
    while start < len(tokens):
        end = start + 1
        # A run of digit groups ends where another one would begin by itself.
        while end < len(tokens) and chained[end - 1] and numeric[end - 1] and numeric[end] and seen[end] == seen[start] and not tokens[end].text.startswith("+"):
            end += 1
        run = text[tokens[start].start : tokens[end - 1].end] if end > start + 1 else tokens[start].text
        own = _run_features(run, numeric[start])
        before = text[max(0, tokens[start].start - 40) : tokens[start].start].split()[-1:]
        after = text[tokens[end - 1].end : tokens[end - 1].end + 40].split()[:1]
        for name, words in (("before", before), ("after", after)):
            if words and _word(words[0]) in CUE_KIND:
                own.append(f"cue {name} {CUE_KIND[_word(words[0])]}")
            if words and words[0] in AT_MARKS:
                own.append(f"at {name}")
        digits = digits_of(run) if numeric[start] else ""
        for i in range(start, end):
            features.append(own)
            local = tokens[i].text.split("@")[0].lower()
            alike = digits[-ALIKE_DIGITS:] if len(digits) >= ALIKE_DIGITS else None
            # Of a run, the last token stands for all; the others hear of it along the chain.
            keys.append((alike if i == end - 1 else None) if numeric[i] else local if local in locals_of else None)
        start = end
    return Graph(tokens, features, chained, keys)


def _run_features(run: str, numeric: bool) -> list[str]:
    """Names of the features of a run of digit groups, or of one other token."""
    out = ["any"]
    if numeric:
        groups, apart = re.findall("[0-9]+", run), sorted({c for c in run if not c.isdigit()})
        digits = "".join(groups)
        out += [f"digits {_bucket(len(digits))}", f"groups {'-'.join(str(len(g)) for g in groups) if len(groups) < 6 else 'many'}", f"apart {''.join(apart)}"]
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            out.append("luhn")
            if set(map(len, groups)) <= {4, 5, 6} and len(groups) > 1:
                out.append("luhn in groups")
        if run.startswith("+"):
            out.append("plus")
        if ":" in apart:
            out.append("colon")
        if len(groups) == 3 and re.match(r"(?:19|20)\d\d\D[01]?\d\D[0-3]?\d\Z|[0-3]?\d\D[0-3]?\d\D(?:19|20)\d\d\Z", run):
            out.append("date")
        return out
    if V6_LIKE.match(run) and ("::" in run or run.count(":") == 7):
        out.append("v6")
    if ADDRESS_LIKE.match(run):
        out.append("address")
    elif "@" in run or "(at)" in run or "[at]" in run:
        out.append("at mark alone" if run in AT_MARKS else "at")
    elif DOMAIN_LIKE.match(run):
        out.append("domain")
    out.append("letters" if run.isalpha() else "mixed")
    if any(c.isdigit() for c in run) and run.isalnum():
        out.append("letters and digits")
    return out


def stars(keys: Sequence[str | None], certain: Sequence[float]) -> list[tuple[int, int]]:
    """Links (centre, other) between tokens of one key; the centre is the most certain one, the first of several."""
    centre: dict[str, int] = {}
    for i, key in enumerate(keys):
        if key is not None and (key not in centre or certain[i] > certain[centre[key]]):
            centre[key] = i
    return [(centre[key], i) for i, key in enumerate(keys) if key is not None and centre[key] != i]


def observed(tokens: Sequence[Token], base: Sequence[tuple[int, int, int]]) -> list[int]:
    """The label of each token that overlaps a fixed form, else -1."""
    out, spans = [-1] * len(tokens), sorted((start, end, kind) for kind, start, end in base)
    at = 0
    for i, token in enumerate(tokens):
        while at < len(spans) and spans[at][1] <= token.start:
            at += 1
        for start, end, kind in spans[at : at + len(KINDS)]:
            if start < token.end and end > token.start:
                out[i] = kind + 1
                break
    return out


class Batch:
    """Graphs of several documents as arrays."""

    def __init__(self) -> None:
        self.features: list[list[int]] = []
        self.label: list[int] = []
        self.edges: list[tuple[int, int]] = []  # along the chains
        self.keys: list[tuple[int, str] | None] = []
        self.documents = 0

    def add(self, own: Graph, label: Sequence[int], names: dict[str, int], grow: bool = False) -> int:
        """Add a document's tokens; returns the number of its first one."""
        first = len(self.label)
        for features in own.features:
            if grow:
                for name in features:
                    names.setdefault(name, len(names))
            self.features.append([names[name] for name in features if name in names])
        self.label += label
        self.edges += [(first + i, first + i + 1) for i, linked in enumerate(own.chained) if linked]
        self.keys += [None if key is None else (self.documents, key) for key in own.keys]
        self.documents += 1
        return first

    def unary(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each token's features."""
        counts = np.array([len(f) for f in self.features])
        rows = np.repeat(np.arange(len(counts)), counts)
        out = np.zeros((len(counts), LABELS))
        np.add.at(out, rows, weights[np.fromiter((i for f in self.features for i in f), np.int64, rows.size)])
        return out


def _pairs(links: Sequence[tuple[int, int]]) -> np.ndarray:
    return np.array(links, np.int64).reshape(-1, 2)


def _open_ends(n: int, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a token has no candidate right before it, and none right after it."""
    first, last = np.ones(n, bool), np.ones(n, bool)
    first[edges[:, 1]], last[edges[:, 0]] = False, False
    return first, last


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis, keepdims=True))).squeeze(axis)


def marginals(batch: Batch, model: Model) -> np.ndarray:
    """Probabilities of the labels of each token, by messages along chains and skips."""
    label = np.array(batch.label, np.int64)
    chain = _pairs(batch.edges)
    first, last = _open_ends(len(label), chain)
    # Words beyond a chain's ends carry no label.
    unary = batch.unary(model.unary) + np.where(first[:, None], model.chain[0], 0) + np.where(last[:, None], model.chain[:, 0], 0)
    seen = label >= 0
    unary[seen] = np.where(np.arange(LABELS) == label[seen][:, None], 0.0, -50.0)
    certain = np.where(seen, np.inf, unary[:, 1:].max(1) - unary[:, 0])
    skip = _pairs(stars(batch.keys, certain))
    ways = [(chain, model.chain), (chain[:, ::-1], model.chain.T), (skip, np.diag(model.skip)), (skip[:, ::-1], np.diag(model.skip))]
    messages = [np.zeros((len(links), LABELS)) for links, _ in ways]
    for _ in range(ROUNDS):
        belief, moved = unary.copy(), 0.0
        for (links, _), message in zip(ways, messages, strict=True):
            np.add.at(belief, links[:, 1], message)
        for i, (links, potential) in enumerate(ways):
            if len(links):
                # What the receiver told the sender does not go back to it.
                new = _log_sum((belief[links[:, 0]] - messages[i ^ 1])[:, :, None] + potential, 1)
                new -= new.max(1, keepdims=True)
                moved = max(moved, np.abs(np.exp(new) - np.exp(messages[i])).max())
                messages[i] = new
        if moved < STILL:
            break
    belief = unary.copy()
    for (links, _), message in zip(ways, messages, strict=True):
        np.add.at(belief, links[:, 1], message)
    return np.exp(belief - _log_sum(belief, 1)[:, None])


def fit(batch: Batch, features: dict[str, int], steps: int = STEPS) -> Model:
    """Weights by the pseudo-likelihood of labelled tokens: each label given those of its neighbours and of its like."""
    n, label = len(batch.label), np.array(batch.label, np.int64)
    chain = _pairs(batch.edges)
    first, last = _open_ends(n, chain)
    skip = _pairs(stars(batch.keys, (label > 0).astype(float)))
    before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
    before[chain[:, 1]], after[chain[:, 0]] = label[chain[:, 0]], label[chain[:, 1]]
    alike = np.zeros((n, LABELS))  # a token of a star meets its centre; the centre meets all others
    np.add.at(alike, skip[:, 1], np.eye(LABELS)[label[skip[:, 0]]])
    counts = [len(f) for f in batch.features]
    rows, columns = np.repeat(np.arange(n), counts), np.fromiter((i for f in batch.features for i in f), np.int64, sum(counts))
    weights = [np.zeros((len(features), LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    truth = np.eye(LABELS)[label]
    for step in range(1, steps + 1):
        score = weights[1][before] + weights[1].T[after] + alike * weights[2]
        np.add.at(score, rows, weights[0][columns])
        wrong = np.exp(score - _log_sum(score, 1)[:, None]) - truth
        gradient = [np.zeros_like(w) for w in weights]
        np.add.at(gradient[0], columns, wrong[rows])
        np.add.at(gradient[1], before, wrong)
        np.add.at(gradient[1].T, after, wrong)
        gradient[2] = (alike * wrong).sum(0)
        for i, (w, g) in enumerate(zip(weights, gradient, strict=True)):
            g = g / n + DECAY * w
            mean[i], square[i] = 0.9 * mean[i] + 0.1 * g, 0.999 * square[i] + 0.001 * g * g
            w -= RATE * mean[i] / (1 - 0.9**step) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return Model(features, *weights)


# --- labelled texts ---


def _card(rng: random.Random, good: bool = True) -> str:
    body = str(rng.choice([4, 5, 37])) + "".join(rng.choices("0123456789", k=15))
    body = body[:15]
    check = next(d for d in "0123456789" if luhn(body + d))
    return body + (check if good else str((int(check) + rng.randint(1, 9)) % 10))


def _fours(digits: str, mark: str) -> str:
    return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def _letters(rng: random.Random, least: int = 2, most: int = 9) -> str:
    return "".join(rng.choices("abcdefghijklmnoprstuvwzäéö", weights=[4] * 23 + [1] * 3, k=rng.randint(least, most)))


def _mentions(rng: random.Random) -> list[tuple[str, int]]:
    """A subject of a text, as pieces (text, label) that will be strewn over it."""
    digit = lambda n: "".join(rng.choices("0123456789", k=n))
    hexed = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    kind = rng.randrange(13)
    area, exchange, line = str(rng.randint(200, 989)), digit(3), digit(4)
    clear_phone = f"+{rng.randint(1, 99)} ({area}) {exchange}-{line}"
    partial = rng.choice([f"{exchange}-{line}", f"{exchange}{line}", f"{area}{exchange}{line}", f"{exchange} {line}"])
    user = rng.choice([f"{_letters(rng)}.{digit(2)}", f"{_letters(rng)}_{_letters(rng)}", f"{_letters(rng)}{digit(3)}", _letters(rng, 4)])
    domain = f"{_letters(rng, 3)}{rng.choice(['', digit(1)])}.{rng.choice(['com', 'org', 'de', 'example.com', 'fr'])}"
    if kind == 0:
        return [(clear_phone, 4)] + [(partial, 4)] * rng.randint(0, 2)
    if kind == 1:
        return [(partial, 0)] * rng.randint(1, 2)
    if kind == 2:
        return [(rng.choice([f"({area}) {exchange}-{line}", f"{area}-{exchange}-{line}", f"{area}.{exchange}.{line}"]), 4)]
    if kind == 3:
        cue = rng.choice(CUES["phone"].split()[:6])
        return [(f"{cue}{rng.choice([':', ''])} |{rng.choice([partial, f'0{area} {exchange}{line}', f'{exchange} {line[:2]} {line[2:]}'])}", 4)]
    if kind == 4:
        again = [(user, 1 if not user.isalpha() else 0)] * rng.randint(0, 1)
        return [(f"{user}@{domain}", 1), *again]
    if kind == 5:
        return [(rng.choice([f"{user}(at){domain}", f"{user}[at]{domain}", f"{user} (at) {domain}", f"{user} @ {domain}", f"jü{user}@{domain}", f"{user}@ü{domain}"]), 1)]
    if kind == 6:
        return [(user, 0), (rng.choice(["@" + user, f"{user}@host", domain, f"{user}@"]), 0)]
    if kind == 7:
        number = _card(rng)
        return [(rng.choice([number, _fours(number, " "), _fours(number, "-")]), 3)] + [(_fours(number, "."), 3)] * rng.randint(0, 1)
    if kind == 8:
        return [(_fours(_card(rng), rng.choice([".", "  ", "/"])), 3), (rng.choice([_card(rng, False), _fours(_card(rng, False), rng.choice([" ", "-", ".", "/"]))]), 0)]
    if kind == 9:
        v4 = ".".join(str(rng.randint(0, 255)) for _ in range(4))
        v6 = rng.choice([f"2001:db8::{digit(1)}", ":".join(f"{rng.randint(0, 65535):x}" for _ in range(8)), f"fe80::{digit(2)}:{digit(3)}"])
        return [rng.choice([(v4, 2), (v6, 2), (v4.replace(".", "-"), 0), (f"{rng.randint(256, 999)}.{v4.split('.', 1)[1]}", 0)])]
    if kind == 10:  # rows of numbers, or of names with digits
        one = rng.choice([lambda: digit(rng.randint(1, 5)), lambda: f"{digit(2)}.{digit(1)}", lambda: f"{digit(1)},{digit(3)}", lambda: f"{_letters(rng)}{digit(1)}", lambda: f"{_letters(rng)}.{_letters(rng)}-{digit(1)}.{digit(2)}"])
        return [(" ".join(one() for _ in range(rng.randint(2, 12))), 0)]
    year, month, day = rng.randint(1950, 2030), rng.randint(1, 12), rng.randint(1, 28)
    plain = [
        f"{year}-{month:02}-{day:02}", f"{day}.{month}.{year}", f"{month}/{day}/{year}", f"{rng.randint(0, 23)}:{digit(2)}", f"{rng.randint(0, 23):02}:{digit(2)}:{digit(2)}",
        f"{year}", f"{year}-{year + 5}", f"{digit(3)},{digit(3)}", f"{digit(2)}.{digit(2)}", f"v{digit(1)}.{digit(1)}.{digit(2)}", f"{digit(1)}.{digit(1)}.{digit(2)}",
        f"{digit(rng.randint(1, 12))}", f"{digit(rng.randint(20, 30))}", f"978-{digit(1)}-{digit(2)}-{digit(6)}-{digit(1)}", f"{_letters(rng)}{digit(2)}", f"{digit(2)}%",
        hexed(32), f"{hexed(8)}-{hexed(4)}-{hexed(4)}-{hexed(4)}-{hexed(12)}", f"{digit(5)} {_letters(rng)}", f"{year}-{month:02}-{day:02} {rng.randint(0, 23):02}:{digit(2)}",
        f"{_letters(rng)}-{digit(1)}.{digit(1)}.{digit(1)}", f"{_letters(rng)}.{_letters(rng, 2, 4)}{digit(1)}", f"{_letters(rng)}_{digit(4)}_{_letters(rng)}", f"{digit(4)} {digit(4)} {digit(4)}",
        f"{digit(3)} {digit(4)}", f"{digit(rng.randint(1, 5))} {digit(rng.randint(3, 5))}", f"{digit(1)},{digit(3)} {digit(1)},{digit(3)} {digit(1)},{digit(3)}", f"{digit(3)} {digit(3)} {digit(3)}", f"{digit(6)}-{digit(2)}",
    ]
    return [(piece, 0) for piece in rng.sample(plain, rng.randint(1, 4))]


def labelled_text(rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A made text and its spans (kind, start, end)."""
    pieces = [piece for _ in range(rng.randint(1, 5)) for piece in _mentions(rng)]
    rng.shuffle(pieces)
    text, spans = "", []
    for piece, label in pieces:
        cue, _, body = piece.rpartition("|")
        text += " ".join(_letters(rng) for _ in range(rng.randint(1, 8))) + " " + cue
        if label:
            spans.append((label - 1, len(text), len(text) + len(body)))
        text += body + rng.choice([" ", ", ", ". ", "\n", "! "])
    return text + _letters(rng), spans


@lru_cache(maxsize=1)
def trained(texts: int = TRAINING_TEXTS, seed: int = 11) -> Model:
    """The model of made texts; the same in every run."""
    rng, batch, names = random.Random(seed), Batch(), {}
    for _ in range(texts):
        text, spans = labelled_text(rng)
        own = graph(text, fixed_forms(text))
        batch.add(own, [max(0, label) for label in observed(own.tokens, spans)], names, grow=True)
    return fit(batch, names)


# --- texts of a table ---


def _may_hold(data: bytes) -> bool:
    return b"@" in data or b"(at)" in data or b"[at]" in data or len(data.translate(None, NO_DIGITS)) >= LEAST_DIGITS


def added(tokens: Sequence[Token], chained: Sequence[bool], seen: Sequence[int], sure: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans (kind, start, end) of labelled tokens that no fixed form covers; neighbours of one label are one span."""
    out, open_span = [], None
    label = np.where(sure.max(1) >= SURE, sure.argmax(1), 0)
    for i, token in enumerate(tokens):
        own = int(label[i]) if seen[i] < 0 else 0
        if own and open_span is not None and open_span[0] == own - 1 and chained[i - 1]:
            open_span[2] = token.end
            continue
        if open_span is not None:
            out.append(tuple(open_span))
        open_span = [own - 1, token.start, token.end] if own else None
    if open_span is not None:
        out.append(tuple(open_span))
    return out


def scan(texts: Iterator[bytes | None], model: Model) -> Iterator[list[tuple[int, int, int, bool]]]:
    """Spans (kind, start, end, base) of each text, by kind and start."""
    waiting: list[tuple] = []
    batch = Batch()

    def done():
        sure = marginals(batch, model) if batch.label else None
        for base, own, first, seen in waiting:
            more = added(own.tokens, own.chained, seen, sure[first : first + len(own.tokens)]) if own and own.tokens else []
            yield sorted([(*span, True) for span in base] + [(*span, False) for span in more])

    for data in texts:
        if not data or not _may_hold(data):
            waiting.append(([], None, 0, []))
        else:
            text = data.decode()
            base = fixed_forms(text)
            own = graph(text, base)
            seen = observed(own.tokens, base)
            waiting.append((base, own, batch.add(own, seen, model.features), seen))
        if len(batch.label) >= TOGETHER:
            yield from done()
            waiting, batch = [], Batch()
    yield from done()


def personal_data(docs: DataFrame, columns: Sequence[str] = ("doc_id",), text_col: str = "text", model: Model | None = None, out: str = "spans") -> DataFrame:
    """Some columns of a table, with an array of spans (kind, start, end, base) of each text in code points."""
    model = model or trained()
    told = docs.select(*columns, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    schema = T.StructType([*told.drop("_text").schema, T.StructField(out, T._parse_datatype_string(SPANS))])

    def find(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        names = ["kind", "start", "end", "base"]
        for batch in batches:
            found = scan((text.as_py() for text in batch.column("_text")), model)
            spans = pa.array([[dict(zip(names, span, strict=True)) for span in own] for own in found], kind)
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in columns), spans], [*columns, out])

    return told.mapInArrow(find, schema)


def written(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def personal_data_scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, number of spans of each fixed form, SHA-256 of these, and all spans."""
    found = personal_data(docs.select("doc_id", "text"), model=model)
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select("doc_id", *map(number, range(len(KINDS))), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
