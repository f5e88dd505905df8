"""Words of a text, their hashes and shingles, for code that runs inside tasks.

A word is a run of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after lower-casing A-Z: ASCII letters and digits and everything
beyond ASCII. In UTF-8 this class is a set of bytes, so one byte table splits any text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np

_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEPT else 0x20 for c in range(256))

#: Characters handled together; keeps the arrays of one step in some megabytes however long a batch is.
STEP_CHARS = 250_000
#: Remembered word hashes per worker; the table is emptied when full, which changes no result.
CACHED_WORDS = 100_000


def split_words(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8; none for null."""
    return text.encode("utf-8", "replace").translate(_TABLE).split() if text else []


class WordHashes(dict):
    """Word to a 64-bit hash that is the same in every process."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ids_of(words: Sequence[bytes], vocabulary: dict[bytes, int]) -> np.ndarray:
    """Numbers of the words in a vocabulary that starts at 1; 0 for words outside it."""
    return np.fromiter(map(vocabulary.get, words, repeat(0)), np.int64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply): every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


def combine(parts: Sequence[np.ndarray]) -> np.ndarray:
    """An order-sensitive hash of several aligned hash arrays."""
    out = np.zeros_like(parts[0])
    for part in parts:
        out = out * np.uint64(0x9E3779B97F4A7C15) + part
    return mix(out)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; a shorter, non-empty text is one shingle of all its words."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    return combine([hashes[k : n - size + 1 + k] for k in range(size)])


def steps(texts: Sequence[str | None], chars: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `chars` characters; a longer text is a step of its own."""
    first, held = 0, 0
    for at, text in enumerate(texts):
        size = len(text) if text else 0
        if held and held + size > chars:
            yield first, at
            first, held = at, 0
        held += size + 1
    if first < len(texts):
        yield first, len(texts)
