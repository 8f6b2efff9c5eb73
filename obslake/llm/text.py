"""Words, shingles and their hashes, inside tasks, over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_MIX_1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)
_CHAIN = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(33)

#: Entries a worker's table of word hashes may hold before it starts anew. Speed only; some 15 MB.
WORDS_REMEMBERED = 100_000


def to_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 of every text; a null is an empty one."""
    return [text or b"" for text in texts.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and return."""
    return text.split()


def lower_words(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case; other letters keep their case."""
    return text.lower().split()


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    values = (values ^ (values >> _SHIFT)) * _MIX_1
    values = (values ^ (values >> _SHIFT)) * _MIX_2
    return values ^ (values >> _SHIFT)


class WordHashes(dict):
    """64-bit hashes by word, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, sequence: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, sequence), np.uint64, len(sequence))


def hash_words(sequence: list[bytes]) -> np.ndarray:
    """The same hashes, none remembered: faster where most words are rarer than the table has room for."""
    return np.fromiter(map(xxhash.xxh64_intdigest, sequence), np.uint64, len(sequence))


_WORD_HASHES = WordHashes()


def word_hashes() -> WordHashes:
    """The one table of a Python worker, whatever functions it runs."""
    return _WORD_HASHES


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words, in order, repeats included.

    A shorter sequence is one shingle as a whole; an empty one has none.
    """
    width = min(width, len(hashes))
    if width == 0:
        return hashes
    count = len(hashes) - width + 1
    chain = np.full(count, width, np.uint64)
    for k in range(width):
        chain = mix(chain * _CHAIN + hashes[k : k + count])
    return chain


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingles, sorted."""
    return np.unique(shingles(hashes, width))


def in_portions(sets: list[np.ndarray], most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Ranges of ``sets`` with about ``most`` numbers each, to bound a task's memory."""
    start, held = 0, 0
    for k, one in enumerate(sets):
        held += len(one)
        if held >= most:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(sets):
        yield start, len(sets)


def long_lists(matrix: np.ndarray) -> pa.Array:
    """Rows of 64-bit numbers as lists of signed longs."""
    rows, columns = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * columns
    return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(matrix).view(np.int64).ravel())
