"""Word hashing for the tasks of several operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import xxhash

#: Words a task remembers and their bytes; the memory is dropped when full, which changes
#: no result.
MEMORY, MEMORY_BYTES = 200_000, 16 << 20


class WordMemory(dict):
    """bytes -> value of `make`, computed once per word while the memory lasts."""

    def __init__(self, make: Callable[[bytes], object], size: int = MEMORY):
        super().__init__()
        self.make, self.size, self.held = make, size, 0

    def __missing__(self, word: bytes):
        value = self.make(word)
        self.held += len(word) + (len(value) if isinstance(value, bytes) else 0)
        if len(self) >= self.size or self.held > MEMORY_BYTES:
            self.clear()
            self.held = 0
        self[word] = value
        return value


def word_hashes() -> WordMemory:
    return WordMemory(xxhash.xxh64_intdigest, MEMORY)


def hash_words(words: list[bytes], memory: WordMemory) -> np.ndarray:
    return np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))


#: Bytes of text whose words are listed at a time.
LISTED = 1 << 20
_SPACE = re.compile(rb"[ \t-\r]")


def word_lists(text: str | None, lower: bool = True) -> Iterator[list[bytes]]:
    """Words between ASCII white space, in lists of a bounded number of bytes; A-Z lower-cased
    unless they are to stay, other letters as they are."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    raw = raw.lower() if lower else raw
    start = 0
    while start < len(raw):
        space = _SPACE.search(raw, start + LISTED) if start + LISTED < len(raw) else None
        end = space.start() if space else len(raw)
        yield raw[start:end].split()
        start = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
