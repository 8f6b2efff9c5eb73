"""Rare-first prefixes of sets: similar sets share one of their rarest elements.

Order the elements of all sets alike. Two sets that share ``need`` elements share one among the
first ``size - need + 1`` of each, namely their least common one (Chaudhuri and others, ICDE
2006). Any order serves; with the rarest first, sets made from one template have prefixes of what
is their own, and meet nobody. An element that no other set has is left out at once.

How many elements a pair shares depends on both sizes, so a set gives a prefix for each class of
sizes that a smaller partner may have, in steps of a fiftieth: the nearer the sizes, the shorter.
It is at home in the class of its own size and a visitor in the others; of two that are to meet one is at home.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.text import in_portions, mix

#: Elements are counted by their highest bits, in 2**21 places: 8 MB, whatever their number.
#: Elements that share a place pass for more frequent than they are, which only makes prefixes meet more.
PLACE_BITS = 21
#: A class's sizes differ by less than one in so many.
STEP = 50


def _places(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


def frequencies(sets: DataFrame) -> np.ndarray:
    """How many elements of the sets (shingles binary) fall to each place; 1 stands for one or none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << PLACE_BITS, np.int64)
        for batch in batches:
            for one in batch.column("shingles").cast(pa.binary()).to_pylist():
                np.add.at(counts, _places(np.frombuffer(one, np.uint64)), 1)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(counts[filled])], ["place", "n"])

    counted = sets.select("shingles").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    several = counted.where("n > 1").select("place", F.least("n", F.lit(2**31 - 1)).cast("int").alias("n")).toArrow()
    table = np.ones(1 << PLACE_BITS, np.int32)
    table[several.column("place").to_numpy()] = several.column("n").to_numpy()
    return table


def class_starts(largest: int) -> np.ndarray:
    """The least size of each class, up to one that holds ``largest``."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(max(starts[-1] + 1, starts[-1] + starts[-1] // STEP))
    return np.array(starts, np.int64)


def prefix_lengths(size: int, percent: int, starts: np.ndarray) -> list[tuple[int, int]]:
    """(class, length) for every class of sizes up to ``size`` with partners that can be similar.

    Sets of x and y elements whose intersection is at least ``percent`` % of their union share
    at least percent * (x + y) / (100 + percent) of them.
    """
    least = -(-percent * size // 100)
    own, lowest = (int(np.searchsorted(starts, n, "right")) - 1 for n in (size, max(least, 1)))
    out = []
    for c in range(lowest, own + 1):
        other = max(int(starts[c]), least)
        out.append((c, size + (-percent * (other + size) // (100 + percent)) + 1))
    return out


def prefix_keys(sets: list[np.ndarray], counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the number of the set each is of, and whether it is at home there.

    Similar sets have a key in common where one is at home.
    """
    starts = class_starts(max(map(len, sets), default=0))
    keys, owners, home = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
    for k, one in enumerate(sets):
        if not len(one):
            continue
        often = counts[_places(one)]
        order = one[np.lexsort((one, often))]
        alone = int((often <= 1).sum())
        lengths = prefix_lengths(len(one), percent, starts)
        for c, length in lengths:
            if length > alone:
                keys.append(mix(order[alone:length] ^ mix(np.full(1, c + 1, np.uint64))))
                owners.append(np.full(length - alone, k, np.int64))
                home.append(np.full(length - alone, c == lengths[-1][0]))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(home)


def prefix_buckets(sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, home, node, component, n_shingles) of sets (node, component, n_shingles, shingles binary).

    Two sets whose intersection is at least ``percent`` % of their union have a bucket in common, one of them at home.
    """
    sent = sets.sparkSession.sparkContext.broadcast(frequencies(sets))
    names = ["node", "component", "n_shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(one, np.uint64) for one in batch.column("shingles").cast(pa.binary()).to_pylist()]
            for start, end in in_portions(held):
                keys, owners, home = prefix_keys(held[start:end], sent.value, percent)
                of = pa.array(owners + start)
                columns = [pa.array(keys.view(np.int64)), pa.array(home), *(batch.column(name).take(of) for name in names)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "home", *names])

    return sets.select(*names, "shingles").mapInArrow(run, "bucket long, home boolean, node binary, component binary, n_shingles long")
