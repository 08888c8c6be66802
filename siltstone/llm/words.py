"""Words as the operators of this package read them."""

from __future__ import annotations

import re

import numpy as np
import xxhash

# Runs of digits, letters and everything beyond ASCII.  In UTF-8 every byte of a character
# beyond ASCII is 0x80 or more, so the byte pattern finds the same runs as the characters would.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
CACHE_ENTRIES = 500_000


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased; none for a null text."""
    return WORD.findall(text.lower()) if text else []


class WordHashes(dict):
    """64-bit hashes of words, remembered in a table that is emptied when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def __call__(self, found: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_ENTRIES:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
