"""Token ids of whole texts by the tokenizers library, one library call per distinct word.

The vocabulary file drops white space and never merges across it, so the ids of a text are those of its words (runs
without ASCII white space) one after another.  Each Python worker keeps the ids of words that it has met in two
generations of bounded size, so the memory of a worker does not grow with the corpus.
"""

from __future__ import annotations

import re
import string
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

#: Bytes a generation of the cache holds, about (a quarter of a million words); a worker holds two generations.
CACHED_BYTES = 48 << 20
#: Bytes that an entry of the cache takes besides the word and its ids.
ENTRY_BYTES = 170
#: Longer texts are encoded in parts of about so many bytes that end at white space.
PART_BYTES = 1 << 20

SPECIAL_MARK = b"<|"
WHITE = re.compile(rb"[\x20\x09-\x0D]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


BYTE_SYMBOLS = byte_symbols()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def parts(text: bytes, size: int = PART_BYTES) -> Iterator[bytes]:
    """A text in parts that end at ASCII white space, so that no word is cut."""
    start = 0
    while len(text) - start > size:
        found = WHITE.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.end()
    yield text[start:] if start else text


class WordIds(dict):
    """Word (bytes) to its ids as little-endian unsigned 32-bit numbers; fills itself.

    A full generation becomes the older one; words that are met again move from there to the new one.
    """

    def __init__(self, vocabulary: str, most: int = CACHED_BYTES):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.most, self.held, self.older = Tokenizer.from_file(vocabulary), most, 0, {}
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.fresh(word)
        if self.held >= self.most:
            self.older, self.held = dict(self), 0
            self.clear()
        self.held += len(word) + len(ids) + ENTRY_BYTES
        self[word] = ids
        return ids

    def fresh(self, word: bytes) -> bytes:
        text = word.decode()
        if word.isalpha() and word.islower():  # ASCII: normalising and byte mapping change nothing
            return packed([token.id for token in self.model.tokenize(text)])
        lower = "".join(map(str.lower, text))
        if lower.isalpha() and unicodedata.is_normalized("NFC", lower):
            return packed([token.id for token in self.model.tokenize("".join(map(BYTE_SYMBOLS.__getitem__, lower.encode())))])
        body = text.rstrip(string.punctuation)
        if body != text and body.isalnum():  # a run of symbols after letters and digits is encoded by itself
            return self[body.encode()] + self[text[len(body) :].encode()]
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def text_ids(self, text: bytes) -> bytes:
        """The ids of a whole text."""
        if SPECIAL_MARK not in text:  # the normaliser lower-cases; doing it first makes fewer distinct words
            text = text.lower()
        if len(text) <= PART_BYTES:
            return b"".join(map(self.__getitem__, text.split()))
        return b"".join(b"".join(map(self.__getitem__, part.split())) for part in parts(text))


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def word_ids(vocabulary: str, most: int = CACHED_BYTES) -> WordIds:
    """The worker's own cache for a vocabulary file."""
    return WordIds(vocabulary, most)
