"""BPE encoding and decoding by a segment tree over adjacent pair ranks.

The leaves of a word's tree hold the rank of the pair that starts at each symbol; the root is the least of them, and of
equal ranks the leftmost, so it names the next merge.  A merge changes at most three leaves, each a path of updates to
the root, until no pair can merge: O(log n) a merge for words of any length.

Many words are merged side by side, as rows of one array of trees of equal size.  Words too long for that take the same
steps one by one.  Each Python worker keeps the codes of words it has met, in two generations of bounded size.

Text is prepared as the vocabulary file demands: special tokens cut out first, then NFC, lower case by code point, a
split into contractions, letters, single digits and symbols, and bytes as symbols of which the last of a word is marked.
Decoding joins the tokens of ids by one space, as a file without a decoder asks for.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireloom.llm.tokens import BYTE_SYMBOLS, SPECIAL_MARK, default_vocabulary, parts

DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Words of a generation of the cache; a worker holds two, for words and for the pieces they are cut into.
CACHED_WORDS = 200_000
#: Bytes of text whose new words are merged side by side.
TOGETHER = 2 << 20
#: The largest tree that is merged side by side with others.
WIDE = 64
NONE = np.iinfo(np.int64).max


class Merges:
    """Ranks of pairs of symbol ids."""

    def __init__(self, vocab: dict[str, int], merges: list[list[str]]):
        self.size = max(vocab.values()) + 1
        pairs = {}
        for rank, (left, right) in enumerate(merges):
            pairs.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        self.of = pairs
        rows = np.array(sorted((a * self.size + b, rank, made) for (a, b), (rank, made) in pairs.items()), np.int64).reshape(-1, 3)
        self.keys, self.ranks = np.append(rows[:, 0], NONE), np.append(rows[:, 1], 0)
        self.made = np.zeros(len(merges), np.int64)
        self.made[rows[:, 1]] = rows[:, 2]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; -1 where they don't merge or a side is missing (-1)."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], -1)


def merge_rows(symbols: np.ndarray, merges: Merges) -> np.ndarray:
    """Merge words side by side.  A row of symbol ids is filled with -1; so are the places of symbols that merged away."""
    rows, width = symbols.shape
    symbols = symbols.copy()
    after = np.tile(np.arange(1, width + 1), (rows, 1))
    before = np.tile(np.arange(-1, width - 1), (rows, 1))
    tree = np.full((rows, 2 * width), NONE, np.int64)
    ranks = merges.rank(symbols[:, :-1], symbols[:, 1:])
    tree[:, width : 2 * width - 1] = np.where(ranks >= 0, ranks * width + np.arange(width - 1), NONE)
    level = width
    while level > 1:  # build each level from the one below
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    active = np.flatnonzero(tree[:, 1] < NONE)
    while len(active):
        rank, at = np.divmod(tree[active, 1], width)
        gone = after[active, at]
        symbols[active, at] = merges.made[rank]
        symbols[active, gone] = -1
        follow, lead = after[active, gone], before[active, at]
        after[active, at] = follow
        has_follow, has_lead = follow < width, lead >= 0
        before[active[has_follow], follow[has_follow]] = at[has_follow]
        own = symbols[active, at]
        right = np.where(has_follow, symbols[active, np.minimum(follow, width - 1)], -1)
        left = np.where(has_lead, symbols[active, np.maximum(lead, 0)], -1)
        new = merges.rank(np.concatenate([own, left]), np.concatenate([right, own]))
        new = np.where(new >= 0, new * width + np.concatenate([at, lead]), NONE)
        nodes = np.concatenate([at, gone, np.where(has_lead, lead, at)]) + width
        trees = np.tile(active, 3)
        n = len(active)
        tree[active, nodes[:n]] = new[:n]
        tree[active, nodes[n : 2 * n]] = NONE
        tree[active[has_lead], nodes[2 * n :][has_lead]] = new[n:][has_lead]
        for _ in range(width.bit_length() - 1):  # the changed paths, level by level
            nodes >>= 1
            tree[trees, nodes] = np.minimum(tree[trees, 2 * nodes], tree[trees, 2 * nodes + 1])
        active = active[tree[active, 1] < NONE]
    return symbols


def merge_one(symbols: list[int], merges: Merges) -> list[int]:
    """The same for one word of any length."""
    n = len(symbols)
    width = 1 << (n - 1).bit_length()
    symbols, after, before = [*symbols], list(range(1, n + 1)), list(range(-1, n - 1))
    none = (len(merges.made), 0)
    tree = [none] * (2 * width)

    def leaf(at: int) -> tuple[int, int]:
        pair = merges.of.get((symbols[at], symbols[after[at]])) if after[at] < n else None
        return (pair[0], at) if pair else none

    for at in range(n):
        tree[width + at] = leaf(at)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    while tree[1] is not none and tree[1] != none:
        rank, at = tree[1]
        gone = after[at]
        symbols[at], symbols[gone], after[at] = int(merges.made[rank]), -1, after[gone]
        if after[at] < n:
            before[after[at]] = at
        for place, value in ((gone, none), (at, leaf(at)), *([(before[at], leaf(before[at]))] if before[at] >= 0 else [])):
            node = width + place
            tree[node] = value
            while node > 1:
                node //= 2
                tree[node] = min(tree[2 * node], tree[2 * node + 1])
    return [s for s in symbols if s >= 0]


class Codec:
    """Encodes and decodes texts by one vocabulary file."""

    def __init__(self, vocabulary: str, most: int = CACHED_WORDS):
        with open(vocabulary, encoding="utf-8") as file:
            told = json.load(file)
        vocab, end = told["model"]["vocab"], told["model"]["end_of_word_suffix"]
        self.special = {token["content"]: token["id"] for token in told["added_tokens"]}
        self.tokens = {i: token for token, i in (vocab | self.special).items()}
        self.inner = np.array([vocab[c] for c in BYTE_SYMBOLS], np.int64)
        self.last = np.array([vocab[c + end] for c in BYTE_SYMBOLS], np.int64)
        self.merges = Merges(vocab, told["model"]["merges"])
        self.split = regex.compile(told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.most = most
        self.words: dict[bytes, tuple[int, str, str]] = {}  # count of ids, ids, tokens
        self.old_words: dict[bytes, tuple[int, str, str]] = {}
        self.pieces: dict[bytes, list[int]] = {}

    def prepared(self, word: bytes) -> list[int | bytes]:
        """A word's special ids and pieces."""
        if word.isalpha() and word.islower():
            return [word]
        out: list[int | bytes] = []
        for i, text in enumerate(self.cut.split(word.decode())):
            if i % 2:
                out.append(self.special[text])
            else:
                lower = "".join(map(str.lower, unicodedata.normalize("NFC", text)))
                out += [piece.encode() for piece in self.split.findall(lower)]
        return out

    def merge(self, pieces: list[bytes]) -> None:
        """Add the ids of new pieces."""
        by_width: dict[int, list[bytes]] = {}
        for piece in pieces:
            by_width.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(piece)
        for width, own in by_width.items():
            if width > WIDE:
                for piece in own:
                    data = np.frombuffer(piece, "u1")
                    self.pieces[piece] = merge_one([*self.inner[data[:-1]].tolist(), int(self.last[data[-1]])], self.merges)
                continue
            length = np.array([len(piece) for piece in own])
            data = np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in own), "u1").reshape(-1, width)
            column = np.arange(width)
            symbols = np.where(column == length[:, None] - 1, self.last[data], np.where(column < length[:, None], self.inner[data], -1))
            merged = merge_rows(symbols, self.merges)
            there = merged >= 0
            flat, ends = merged[there].tolist(), np.cumsum(there.sum(axis=1)).tolist()
            start = 0
            for piece, stop in zip(own, ends, strict=True):
                self.pieces[piece] = flat[start:stop]
                start = stop

    def learn(self, words: Iterable[bytes]) -> None:
        """Make sure that all these words have codes."""
        new = {}
        for word in set(words).difference(self.words):
            known = self.old_words.get(word)
            if known is None:
                new[word] = self.prepared(word)
            else:
                self.words[word] = known
        self.merge(list({p for found in new.values() for p in found if isinstance(p, bytes)}.difference(self.pieces)))
        for word, found in new.items():
            ids = [i for p in found for i in ([p] if isinstance(p, int) else self.pieces[p])]
            self.words[word] = (len(ids), " ".join(map(str, ids)), " ".join(self.tokens[i] for i in ids))

    def forget(self) -> None:
        """Keep the caches within bounds; call between texts."""
        if len(self.words) >= self.most:
            self.old_words, self.words = self.words, {}
        if len(self.pieces) >= self.most:
            self.pieces = {}

    def encode(self, text: str) -> list[int]:
        words = text.encode().split()
        self.learn(words)
        return [int(i) for w in words for i in self.words[w][1].split()]

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by one space; ids without a token are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    """The worker's own codec for a vocabulary file."""
    return Codec(vocabulary)


class TextDigest:
    """Counts and hashes of a text's ids and decoded text, part by part."""

    def __init__(self):
        self.n, self.ids, self.decoded = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, codes: list[tuple[int, str, str]]) -> None:
        counts, ids, decoded = zip(*(c for c in codes if c[0]), strict=True) if any(c[0] for c in codes) else ((), (), ())
        if counts:
            gap = " " if self.n else ""
            self.n += sum(counts)
            self.ids.update((gap + " ".join(ids)).encode())
            self.decoded.update((gap + " ".join(decoded)).encode())

    def row(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


def text_digests(texts: Iterable[bytes], own: Codec, together: int = TOGETHER) -> Iterator[tuple[int, str, str]]:
    """(number of ids, SHA-256 of ids, SHA-256 of the decoded text) of each text, in order."""
    digests: list[TextDigest] = []
    queue: list[tuple[TextDigest, list[bytes]]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        own.learn(chain.from_iterable(words for _, words in queue))
        for digest, words in queue:
            digest.add(list(map(own.words.__getitem__, words)))
        own.forget()
        queue.clear()
        size = 0

    for text in texts:
        digests.append(TextDigest())
        text = text if SPECIAL_MARK in text else text.lower()
        for part in parts(text):
            queue.append((digests[-1], part.split()))
            size += len(part)
            if size > together:
                flush()
    flush()
    for digest in digests:
        yield digest.row()


def bpe_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Encode and decode every text: n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256.

    A null text is an empty one, a null id stays null, repeated rows stay.  Further columns are ignored.
    """
    vocabulary = vocabulary or default_vocabulary()

    def run(batches):
        import pyarrow as pa

        own = codec(vocabulary)
        for batch in batches:
            texts = (text.as_py() or b"" for text in batch.column("text"))
            columns = list(zip(*text_digests(texts, own), strict=True)) or [(), (), ()]
            arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, DIGEST)
