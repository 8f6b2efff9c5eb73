"""Benchmark decontamination by size-partitioned MinHash containment search.

A short test item inside a long document has a tiny Jaccard similarity to it, so no sketch of
whole documents can find it. Items are therefore partitioned by the size of their shingle
set, and for the items of one partition, of at most q shingles, every document is cut into
windows of 4q shingles that overlap by q: an item's copy lies in one window, and their
similarity is bounded below. Each window and item is sketched by one-permutation MinHash with as
many bins as that partition needs for a miss below ``MISS`` at the containment asked for; in the
partition of at most eight shingles, and for items shorter than a shingle, that is every shingle.

Items, their coordinates and the documents' coordinates are tables. Every document is read
once, in a task that knows two Bloom filters of the items, of a fixed greatest size: one of their
coordinates and one of their shingles. A document without a coordinate that passes gives no row;
of the others only the coordinates and shingles that pass go on. Equal coordinates make
candidates by a join, and each candidate is verified by the exact share of the item's shingles in
the whole document's set. Equal items count as one, and so do equal documents, until the end.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from obslake.llm.scratch import forget, stored
from obslake.llm.text import in_portions, lower_words, mix, shingles, to_bytes, word_hashes

WIDTH = 5
PERCENT = 80
MISS = 1e-9
#: Upper sizes of the partitions: 8, 32, 128, ... shingles.
FIRST_SIZE, SIZE_FACTOR = 8, 4
#: A filter has so many bits for each key, in all from 2**20 to 2**26 (8 MB). With more keys it passes more.
FILTER_BITS_A_KEY, LEAST_FILTER_BITS, MOST_FILTER_BITS = 32, 20, 26
#: A key's places in the filter are its bits from here on.
FILTER_SHIFTS = (0, 9, 18, 27)

LINKS = "array<struct<item_id:bigint,n_shared:int,n_shingles:int>>"
_ITEMS = "item_id long, item binary, width int, upper int, shingles array<long>, coordinates array<long>"


def partition_of(size: int) -> int:
    """The upper size of the partition an item belongs to."""
    upper = FIRST_SIZE
    while upper < size:
        upper *= SIZE_FACTOR
    return upper


def bins_for(upper: int, percent: int = PERCENT) -> int | None:
    """Bins of a window's sketch, a power of two; None: every shingle is a coordinate.

    In a window of w shingles over t bins a shingle is its bin's least one with probability
    s = (1 - exp(-w / t)) t / w. The least item of the partition shares ``percent`` of its
    shingles with its window, and all of those are hidden with probability (1 - s) ** shared.
    """
    lower = upper // SIZE_FACTOR + 1 if upper > FIRST_SIZE else 1
    shared, window = math.ceil(percent * lower / 100), SIZE_FACTOR * upper
    bins = 2
    while bins <= 8 * window:
        seen = -math.expm1(-window / bins) * bins / window
        if (1 - seen) ** shared <= MISS:
            return bins
        bins *= 2
    return None


class KeyFilter:
    """A Bloom filter whose places are bits of the key itself; all keys it was made of pass, and few others."""

    def __init__(self, packed: np.ndarray):
        self.packed, self.mask = packed, np.uint64(8 * len(packed) - 1)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        left = np.arange(len(keys))
        for shift in FILTER_SHIFTS:
            place = (keys[left] >> np.uint64(shift)) & self.mask
            bits = self.packed[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)
            left = left[bits & np.uint8(1) != 0]
        out = np.zeros(len(keys), bool)
        out[left] = True
        return out


def key_filter(keys: DataFrame) -> KeyFilter:
    """The filter of a table of one long column, its bits set by an aggregate."""
    bits = (FILTER_BITS_A_KEY * keys.count()).bit_length()
    bits = min(max(bits, LEAST_FILTER_BITS), MOST_FILTER_BITS)
    key, mask = F.col(keys.columns[0]), F.lit((1 << bits) - 1)
    places = F.array(*(F.shiftrightunsigned(key, shift).bitwiseAND(mask) for shift in FILTER_SHIFTS))
    place = F.col("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.select(F.explode(places).alias("place")).groupBy(F.shiftright(place, 6).alias("word"))
    found = words.agg(F.bit_or(bit).alias("bits")).toArrow()
    packed = np.zeros(1 << (bits - 6), np.int64)
    packed[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return KeyFilter(packed.view(np.uint8))


@dataclass(frozen=True)
class SizePartition:
    """Items of shingles of ``width`` words, at most ``upper`` of them."""

    width: int
    upper: int
    bins: int | None

    def _hashed(self, elements: np.ndarray) -> np.ndarray:
        return mix(elements ^ np.uint64(self.upper))

    def _least(self, hashed: np.ndarray, windows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The least hash of each filled bin of each window, and its window."""
        bits = self.bins.bit_length() - 1
        empty = np.uint64(0xFFFFFFFFFFFFFFFF)
        table = np.full(count * self.bins, empty, np.uint64)
        np.minimum.at(table, windows * self.bins + (hashed >> np.uint64(64 - bits)).astype(np.int64), hashed)
        filled = np.flatnonzero(table != empty)
        return table[filled], filled // self.bins

    def of_item(self, elements: np.ndarray) -> np.ndarray:
        """The coordinates of one item."""
        hashed = self._hashed(elements)
        return hashed if self.bins is None else self._least(hashed, np.zeros(len(hashed), np.int64), 1)[0]

    def of_documents(self, runs: list[np.ndarray], wanted: KeyFilter) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates of all windows that pass ``wanted``, and the document of each.

        ``runs`` has the shingles of each document in order. Only shingles that pass could be an
        item's coordinate, but all of such a document take part in its windows' minima.
        """
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        hashed = self._hashed(np.concatenate(runs))
        owners = np.repeat(np.arange(len(runs)), lengths)
        passed = wanted.passes(hashed)
        if self.bins is None:
            return hashed[passed], owners[passed]
        near = np.zeros(len(runs), bool)
        near[owners[passed]] = True
        kept = near[owners]
        hashed, owners = hashed[kept], owners[kept]
        window, step = SIZE_FACTOR * self.upper, (SIZE_FACTOR - 1) * self.upper
        starts = np.concatenate([[0], np.cumsum(np.where(near, lengths, 0))[:-1]])
        places = np.arange(len(hashed)) - starts[owners]
        per_run = np.where(near, lengths // step + 1, 0)
        first = np.concatenate([[0], np.cumsum(per_run)[:-1]])
        own = first[owners] + places // step
        # The window before also reaches over the first ``upper`` places of this step.
        also = (places >= step) & (places % step < window - step)
        windows = np.concatenate([own, own[also] - 1])
        keys, windows = self._least(np.concatenate([hashed, hashed[also]]), windows, int(per_run.sum()))
        hit = wanted.passes(keys)
        return keys[hit], np.repeat(np.arange(len(runs)), per_run)[windows[hit]]


def size_partition(width: int, upper: int, percent: int) -> SizePartition:
    return SizePartition(width, upper, bins_for(upper, percent) if upper >= FIRST_SIZE else None)


def _lists(owners: np.ndarray, values: np.ndarray, count: int) -> pa.Array:
    """Sorted distinct numbers of each owner as lists of signed longs."""
    order = np.lexsort((values, owners))
    owners, values = owners[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (values[1:] != values[:-1])
    owners, values = owners[new], values[new]
    offsets = np.searchsorted(owners, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, values.view(np.int64))


def item_sets(items: DataFrame, item_id: str, text: str, width: int, percent: int) -> DataFrame:
    """Identity, size partition, shingles and coordinates of each item that has a word.

    An item of fewer than ``width`` words is one shingle of all its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            rows = []
            for name, text in zip(batch.column("item_id").to_pylist(), to_bytes(batch.column("text")), strict=True):
                tokens = lower_words(text)
                if not tokens:
                    continue
                one = np.unique(shingles(hashes.of(tokens), width))
                part = size_partition(min(width, len(tokens)), partition_of(len(one)) if len(tokens) >= width else 1, percent)
                row = (name, hashlib.md5(one.tobytes()).digest(), part.width, part.upper)
                rows.append((*row, one.view(np.int64), np.unique(part.of_item(one)).view(np.int64)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = ["item_id", "item", "width", "upper", "shingles", "coordinates"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    named = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return named.mapInArrow(run, _ITEMS)


def _near_items(docs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """(doc_id, digest, coordinates, held) of the documents with a coordinate that passes the filter.

    digest is the MD5 of the text, and held has its shingles that may be an item's.
    """
    kinds = items.select("width", "upper").distinct().collect()  # a few: sizes grow by a factor
    partitions = [size_partition(k.width, k.upper, percent) for k in sorted(kinds)]
    filters = [key_filter(items.select(F.explode(c))) for c in ("coordinates", "shingles")]
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (coordinates, elements) = word_hashes(), sent.value
        for batch in batches:
            texts = to_bytes(batch.column("text"))
            words = [hashes.of(lower_words(t)) for t in texts]
            for a, b in in_portions(words):
                runs = {width: [shingles(one, width) for one in words[a:b]] for width in {p.width for p in partitions}}
                found = [p.of_documents(runs[p.width], coordinates) for p in partitions]
                keys, owners = (np.concatenate([one[k] for one in found]) for k in (0, 1))
                hit, owners = np.unique(owners, return_inverse=True)
                if not len(hit):
                    continue
                held = [np.concatenate([one[k] for one in runs.values()]) for k in hit]
                held = [one[elements.passes(one)] for one in held]
                sizes = np.repeat(np.arange(len(hit)), list(map(len, held)))
                columns = [
                    batch.column("doc_id").take(pa.array(a + hit)),
                    pa.array([hashlib.md5(texts[a + k]).digest() for k in hit], pa.binary()),
                    _lists(owners, keys, len(hit)),
                    _lists(sizes, np.concatenate(held), len(hit)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "coordinates", "held"])

    numbers = ArrayType(LongType())
    schema = StructType([docs.schema["doc_id"]]).add("digest", BinaryType()).add("coordinates", numbers).add("held", numbers)
    return docs.mapInArrow(run, schema) if partitions else docs.sparkSession.createDataFrame([], schema)


def _verified(texts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(digest, item, n_shared, n_shingles) of the items that a text holds; one row per text and item."""
    keys = texts.select("digest", F.explode("coordinates").alias("key"))
    pairs = keys.join(classes.select("item", F.explode("coordinates").alias("key")), "key").select("digest", "item").distinct()
    wanted = pairs.join(classes.select("item", F.size("shingles").alias("n_shingles"), F.explode("shingles").alias("shingle")), "item")
    held = texts.select("digest", F.explode("held").alias("shingle"))
    shared = wanted.join(held, ["digest", "shingle"]).groupBy("digest", "item")
    counts = shared.agg(F.count("*").cast("int").alias("n_shared"), F.first("n_shingles").alias("n_shingles"))
    return counts.where(100 * F.col("n_shared") >= percent * F.col("n_shingles"))


def _search(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """Stored (doc_id, digest) of documents that may hold an item, and (digest, item_id, n_shared, n_shingles).

    ``docs`` has doc_id and text.
    """
    sets = stored(item_sets(items, item_id, item_text, width, percent), "items")
    near = stored(_near_items(docs, sets, percent), "near-items")
    found = _verified(near.dropDuplicates(["digest"]), sets.dropDuplicates(["item"]), percent)
    named = stored(found.join(sets.select("item", "item_id"), "item").drop("item"), "found-items")
    rows = stored(near.select("doc_id", "digest"), "near-documents")
    forget(sets, near)
    return rows, named


def _unnamed(docs: DataFrame) -> DataFrame:
    return docs.select(F.lit(None).cast("long").alias("doc_id"), "text")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def with_matches(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    column: str = "benchmark_matches",
    percent: int = PERCENT,
    width: int = WIDTH,
) -> DataFrame:
    """``docs`` with the list of items contained in each document, one entry per item row, sorted.

    Words are runs of anything but ASCII white space, A-Z in lower case; a shingle is ``width``
    words. An item of fewer words is one shingle of all its words, contained in each document
    that has these words in a row. A null or empty text has no shingles: such an item is in no
    document, and such a document holds no item. Repeated items are found once each, a null
    item_id is handed through, and repeated documents have the same list each. Without items every
    list is empty. All columns of ``docs`` stay, except one already named ``column``.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != column]
    carried = docs.select(F.struct(*kept).alias("row"), F.col(text).alias("text"))
    named = _search(_unnamed(carried), items, item_id, item_text, percent, width)[1]
    entry = F.struct("item_id", "n_shared", "n_shingles")
    lists = named.groupBy("digest").agg(F.sort_array(F.collect_list(entry)).cast(LINKS).alias("found"))
    joined = carried.withColumn("digest", _digest(F.col("text"))).join(lists, "digest", "left")
    return joined.select("row.*", F.coalesce("found", F.array().cast(LINKS)).alias(column))


def links(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    percent: int = PERCENT,
    width: int = WIDTH,
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles) for each item contained in a document, as ``with_matches``.

    One row per row of both; every document is read once.
    """
    lean = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, named = _search(lean, items, item_id, item_text, percent, width)
    return rows.join(named, "digest").select("doc_id", "item_id", "n_shared", "n_shingles")


def without_matches(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    percent: int = PERCENT,
    width: int = WIDTH,
) -> DataFrame:
    """The documents that contain no item, with all their own columns as they were.

    Texts that hold an item are a table of their digests, 16 bytes each. Spark sends it to the
    tasks while it is below ``spark.sql.autoBroadcastJoinThreshold``, and joins it by key beyond.
    """
    carried = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text).alias("text"))
    named = _search(_unnamed(carried), items, item_id, item_text, percent, width)[1]
    hit = stored(named.select("digest").distinct(), "texts-hit")
    return carried.withColumn("digest", _digest(F.col("text"))).join(hit, "digest", "left_anti").select("row.*")
