"""Word and shingle hashing inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Distinct words whose hashes a worker remembers; further ones are hashed again.
REMEMBERED_WORDS = 300_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hash of each word, computed on first sight."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED_WORDS:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _FINAL
    return values ^ (values >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for every ``width`` consecutive word hashes, in order; none if there
    are fewer words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.full(count, width, np.uint64)
    for i in range(width):
        out = mixed(out * _MULTIPLIER + hashes[i:i + count])
    return out


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles. A shorter sequence is one
    shingle as a whole, and no words give the empty set."""
    return np.unique(gram_hashes(hashes, min(width, len(hashes)))) if len(hashes) else hashes


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column; null stays null."""
    return column.cast(pa.binary()).to_pylist()
