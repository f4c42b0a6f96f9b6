"""Words of a text as numbers, and hashes of word runs."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd factors, one for each place of a run; fixed so that every task computes the same hashes.
FACTORS = np.array([xxhash.xxh64_intdigest(str(i).encode()) | 1 for i in range(64)], dtype=np.uint64)


class WordIds(dict):
    """64-bit ids of words, remembered up to a bound."""

    def __init__(self, remember: int = 500_000):
        super().__init__()
        self.remember = remember

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.remember:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: str) -> np.ndarray:
        """Ids of the words of a text: A-Z lower-cased, split at ASCII white space."""
        return self.of_bytes(text.encode("utf-8", "surrogatepass"))

    def of_bytes(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def runs(ids: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, in order; fewer words are one run, no words none."""
    if not len(ids):
        return ids
    length = min(length, len(ids))
    n = len(ids) - length + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        total += ids[k : k + n] * FACTORS[k]
    return mix(total)


TRIM = b".,!?;:|#$%&*()\"'"


def tidy_ids(text: str, words: WordIds) -> np.ndarray:
    """Ids of the words of a text in lower case, without punctuation around them; punctuation alone is no word."""
    found = [own for word in text.lower().encode("utf-8", "surrogatepass").split() if (own := word.strip(TRIM))]
    return np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
