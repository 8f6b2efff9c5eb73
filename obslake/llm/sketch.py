"""Fast similarity sketches (Dahlgaard, Knudsen, Thorup, FOCS 2017).

In round i each element of a set is hashed to a bin and a value i + v, v in [0, 1), and a bin
keeps its least value. Rounds 0 to t-1 choose the bin by hash; round t+k puts all elements
into bin k. So after 2t rounds every one of the t coordinates is filled whatever the set's
size, a set of n elements needs about t ln t / n rounds, and the share of equal coordinates
of two sets is concentrated about their Jaccard similarity as with t independent draws.
"""

from __future__ import annotations

import numpy as np

from obslake.llm.text import in_portions, mix

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bits of a coordinate below the round's number: room for 512 rounds.
_VALUE_BITS = 55


def _round(elements: np.ndarray, number: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and value of each element in a round."""
    bits = np.uint64(size.bit_length() - 1)
    hashed = mix(elements ^ mix(np.full(1, number + 1, np.uint64)))
    if number < size:
        bins = (hashed >> (np.uint64(64) - bits)).astype(np.int64)
    else:
        bins = np.full(len(elements), number - size, np.int64)
    values = (np.uint64(number) << np.uint64(_VALUE_BITS)) | ((hashed << bits) >> np.uint64(64 - _VALUE_BITS))
    return bins, values


def _sketch_portion(sets: list[np.ndarray], size: int) -> np.ndarray:
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    table = np.full((len(sets), size), _EMPTY, np.uint64)
    flat = table.ravel()
    elements = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    owners = np.repeat(np.arange(len(sets)), lengths)
    for number in range(2 * size):
        if not len(elements):
            break
        bins, values = _round(elements, number, size)
        np.minimum.at(flat, owners * size + bins, values)
        open_sets = np.unique(owners)
        unfilled = np.zeros(len(sets), bool)
        unfilled[open_sets] = (table[open_sets] == _EMPTY).any(axis=1)
        still = unfilled[owners]
        elements, owners = elements[still], owners[still]
    return table


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` (a power of two up to 256) coordinates for each set.

    An empty set's coordinates all hold the largest number.
    """
    if size & (size - 1) or not 2 <= size <= 256:
        raise ValueError("the sketch size must be a power of two from 2 to 256")
    parts = [_sketch_portion(sets[a:b], size) for a, b in in_portions(sets)]
    return np.concatenate(parts) if parts else np.empty((0, size), np.uint64)


def bands(table: np.ndarray, rows: int) -> np.ndarray:
    """Bucket keys: each run of ``rows`` coordinates hashed together with its place."""
    count = table.shape[1] // rows
    split = table[:, : count * rows].reshape(len(table), count, rows)
    keys = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), (len(table), count))
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + split[:, :, k])
    return keys
