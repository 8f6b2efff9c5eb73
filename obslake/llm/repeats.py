"""Passages that repeat across documents, by a sparse suffix array.

Only suffixes at content-selected positions are kept: of every ``WINDOW`` successive runs of ``K`` words
the one of least hash, so any passage of ``LEAST_WORDS`` words has a kept position, the same in each
of its copies. Positions whose K words no other document has are dropped by a count. The rest
are sorted by the text that follows, and neighbours are compared and the match extended to the
right and to the left, as far as the windows reach that chose the position; matches of
successive positions join up to passages of any length.

A neighbour agrees longest to the right. Where three or more share their K words, another could
agree longer on the left. So a group of positions with the same K words is sorted whole in one task, where
the lengths in which neighbours agree part it into the sets of positions that share any number of words to the right;
those of a set that share the words on the left too, of a window in all, have that window in common.

A group of more than ``LARGE`` positions is spread over many tasks. There neighbours are matched, and windows that their
matches leave uncovered are settled exactly, by hash. Equal windows have their kept position at the same offset, so
of a group's other windows only those at the offset of an uncovered one take part.

Copies of a whole text are one document here; each of them is reported in full.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obslake.llm.scratch import stored
from obslake.llm.text import hash_words, lower_words, mix, shingles, to_bytes
from obslake.session import shared_folder

LEAST_WORDS = 50
K = 8
WINDOW = LEAST_WORDS - K + 1
#: Positions with the same K words that one task compares; more are spread over tasks.
LARGE = 50_000
#: Stands after each word in a context; no word holds it.
_BREAK = b"\n"
#: Words, and positions, that a task looks at together. Speed and memory only.
_WORDS_AT_ONCE = 100_000
_PLACES_AT_ONCE = 20_000
#: Odd multipliers of the two window hashes, and their inverses modulo 2**64.
_BASES = [(b, pow(b, -1, 1 << 64)) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of each run of ``width`` values, in linear time."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.concatenate([values, np.full(blocks * width - n, values[-1], values.dtype)]).reshape(blocks, width)
    ahead = best.accumulate(padded, axis=1).ravel()
    back = best.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[: n - width + 1], ahead[width - 1 : n])


def window_minima(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of K words, and the least of each window; empty if a text is too short."""
    if len(hashes) < LEAST_WORDS:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    runs = shingles(hashes, K)
    return runs, _sliding(runs, WINDOW, np.minimum)


def anchors(runs: np.ndarray, minima: np.ndarray) -> np.ndarray:
    """Places that are the least of some window; all of them where several are equal."""
    if not len(runs):
        return np.empty(0, np.int64)
    edge = np.zeros(WINDOW - 1, np.uint64)
    reach = _sliding(np.concatenate([edge, minima, edge]), WINDOW, np.maximum)
    return np.flatnonzero(runs == reach)


def windows_of(place: np.ndarray | int, runs: np.ndarray, minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window whose least run is at ``place``; of one place or of many."""
    place = np.asarray(place)
    windows = place[..., None] + np.arange(1 - WINDOW, 1)
    inside = (windows >= 0) & (windows < len(minima))
    own = inside & (minima[np.clip(windows, 0, len(minima) - 1)] == runs[place][..., None])
    return place - WINDOW + 1 + own.argmax(axis=-1), place - own[..., ::-1].argmax(axis=-1)


def _kept(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts of ``counts`` words, one after another: where each text's positions begin, their keys, places, and the words their windows reach."""
    text = np.repeat(np.arange(len(counts)), counts)
    begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
    runs, minima = window_minima(hashes)
    if not len(runs):
        none = np.empty(0, np.int64)
        return np.zeros(len(counts) + 1, np.int64), none, none, none, none
    minima[text[: len(minima)] != text[LEAST_WORDS - 1 :]] = 0  # windows over two texts
    at = anchors(runs, minima)
    first, last = windows_of(at, runs, minima)
    base = begin[text[at]]
    return np.searchsorted(at, begin), runs[at].view(np.int64), at - base, first - base, last + LEAST_WORDS - base


_MARKED = "doc_id long, node binary, n_words long, keys array<long>, places array<int>, lows array<int>, highs array<int>"


def _texts_at_once(texts: list[bytes]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of successive texts, some ``_WORDS_AT_ONCE`` together, and the place of the first text."""
    start, held, count = 0, [], 0
    for text in texts:
        held.append(lower_words(text))
        count += len(held[-1])
        if count >= _WORDS_AT_ONCE:
            yield start, held
            start, held, count = start + len(held), [], 0
    if held:
        yield start, held


def _marked(docs: DataFrame) -> DataFrame:
    """Identity of the text's words, their number, and the kept positions of each document, with the words their windows reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _texts_at_once(to_bytes(batch.column("text"))):
                counts = np.array([len(tokens) for tokens in texts], np.int64)
                offsets, keys, *spots = _kept(hash_words(list(chain.from_iterable(texts))), counts)
                offsets = pa.array(offsets.astype(np.int32))
                nodes = [hashlib.md5(_BREAK.join(tokens)).digest() for tokens in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(texts)),
                        pa.array(nodes, pa.binary()),
                        pa.array(counts),
                        pa.ListArray.from_arrays(offsets, pa.array(keys)),
                        *(pa.ListArray.from_arrays(offsets, pa.array(spot.astype(np.int32))) for spot in spots),
                    ],
                    ["doc_id", "node", "n_words", "keys", "places", "lows", "highs"],
                )

    return docs.mapInArrow(run, _MARKED)


#: A position and the words from ``low`` to ``high`` that its windows reach.
_PLACED = ("node", "key", "size", "place", "low", "high")
_CONTEXT = "node binary, key long, size long, place int, low int, high int, suffix binary, prefix binary"


def _contexts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    wanted, counts = batch.column("wanted").flatten(), batch.column("wanted").value_lengths().to_numpy()
    owner = np.repeat(np.arange(len(counts)), counts)
    spots = [wanted.field(name).to_numpy() for name in ("place", "low", "high")]
    rows, suffixes, prefixes = [], [], []

    def out() -> pa.RecordBatch:
        columns = [batch.column("node").take(pa.array(owner[rows])), *(wanted.field(name).take(pa.array(rows)) for name in _PLACED[1:])]
        return pa.RecordBatch.from_arrays([*columns, pa.array(suffixes, pa.binary()), pa.array(prefixes, pa.binary())], [*_PLACED, "suffix", "prefix"])

    end = 0
    for text, node, count in zip(to_bytes(batch.column("text")), batch.column("node").to_pylist(), counts.tolist(), strict=True):
        begin, end = end, end + count
        tokens = lower_words(text)
        if hashlib.md5(_BREAK.join(tokens)).digest() != node:
            continue  # another text under the same doc_id
        for row, place, low, high in zip(range(begin, end), *(spot[begin:end].tolist() for spot in spots), strict=True):
            rows.append(row)
            suffixes.append(_BREAK.join(tokens[place:high]) + _BREAK)
            prefixes.append(_BREAK.join(tokens[low:place][::-1]) + _BREAK if low < place else b"")
            if len(rows) == 5000:
                yield out()
                rows, suffixes, prefixes = [], [], []
    if rows:
        yield out()


def _contexts(docs: DataFrame) -> DataFrame:
    """Suffix and reversed prefix of the kept positions in ``wanted`` (key, place, size, low, high), as far as their windows reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _contexts_of(batch)

    return docs.mapInArrow(run, _CONTEXT)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by key, in portions that end where a key does."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count < _PLACES_AT_ONCE:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        held, count = table.to_batches(), table.num_rows
    if count:
        yield pa.Table.from_batches(held).combine_chunks()


def _word_columns(contexts: pa.Array | pa.ChunkedArray, counts: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the contexts' words, a row for each place in a context; 0 past its ``counts``."""
    columns = np.zeros((width, len(counts)), np.uint64)
    for at in range(0, len(counts), 2000):
        some = counts[at : at + 2000]
        flat = hash_words(b"".join(contexts[at : at + 2000].to_pylist()).split(_BREAK)[:-1])
        place = np.arange(len(flat)) - np.repeat(np.cumsum(some) - some, some)
        columns[place, np.repeat(np.arange(at, at + len(some)), some)] = flat
    return columns


def _shared_by_two(codes: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Places of the rows whose code a row of another node has too."""
    order = np.argsort(codes)
    codes, nodes = codes[order], nodes[order]
    begin = np.flatnonzero(np.concatenate([np.ones(1, bool), codes[1:] != codes[:-1]]))
    several = np.minimum.reduceat(nodes, begin) != np.maximum.reduceat(nodes, begin)
    return order[np.repeat(several, np.diff(begin, append=len(codes)))]


def _matches(table: pa.Table) -> pa.RecordBatch:
    """(node, start, end): from the first to the last word of a position's windows that another document has, for whole groups in order of their suffixes."""
    key, place, low, high = (table.column(name).to_numpy() for name in ("key", "place", "low", "high"))
    left, right = (place - low).astype(np.int64), (high - place).astype(np.int64)
    nodes = np.frombuffer(b"".join(table.column("node").to_pylist()), np.uint64)[::2]  # half of an MD5
    after = _word_columns(table.column("suffix"), right, LEAST_WORDS)
    before = _word_columns(table.column("prefix"), left, WINDOW - 1)

    # How many words a suffix shares with the one above it, and with the nearer of both.
    above = np.logical_and.accumulate(after[:, 1:] == after[:, :-1], axis=0).sum(axis=0)
    above = np.where(key[1:] == key[:-1], np.minimum(above, np.minimum(right[1:], right[:-1])), 0)
    above = np.concatenate([np.zeros(1, np.int64), above])
    near = np.maximum(above, np.concatenate([above[1:], np.zeros(1, np.int64)]))

    most, least = np.full(len(key), -1), np.full(len(key), WINDOW)
    shared_left = np.zeros(len(key), np.uint64)  # stands for the words on the left so far
    for offset in range(WINDOW):  # windows that start this many words before the position
        if offset:
            shared_left = mix(shared_left * _BASES[0][0] + before[offset - 1])
        rows = np.flatnonzero((left >= offset) & (near >= LEAST_WORDS - offset))
        if not len(rows):
            continue
        shared_right = np.cumsum(above < LEAST_WORDS - offset).astype(np.uint64)
        hit = rows[_shared_by_two((shared_left + shared_right * _BASES[1][0])[rows], nodes[rows])]
        most[hit] = offset
        least[hit] = np.minimum(least[hit], offset)

    # All windows hold the position's K words, so what they cover has no gap.
    hit = np.flatnonzero(most >= 0)
    start, end = (place[hit] - most[hit]).astype(np.int32), (place[hit] - least[hit] + LEAST_WORDS).astype(np.int32)
    node = table.column("node").take(pa.array(hit)).combine_chunks()
    return pa.RecordBatch.from_arrays([node, pa.array(start), pa.array(end)], ["node", "start", "end"])


def _within_groups(contexts: DataFrame) -> DataFrame:
    """(node, start, end): what other documents have of the words around each position, group by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(_matches, _whole_groups(batches))

    ordered = contexts.repartition("key").sortWithinPartitions("key", "suffix")
    return ordered.mapInArrow(run, "node binary, start int, end int")


def _common(one: bytes, other: bytes) -> int:
    """Number of equal words at the start."""
    if one == other:
        return one.count(_BREAK)
    count = 0
    for a, b in zip(one.split(_BREAK), other.split(_BREAK), strict=False):
        if a != b:
            break
        count += 1
    return count


class _Neighbour:
    """A suffix in sorted order and the widest match found for it so far."""

    __slots__ = ("row", "start", "end")

    def __init__(self, row: dict):
        self.row, self.start, self.end = row, None, None

    def compare(self, other: _Neighbour) -> None:
        """Extend the match of two suffixes both ways; a long enough one counts for both."""
        right = _common(self.row["suffix"], other.row["suffix"])
        if right < K:
            return
        left = _common(self.row["prefix"], other.row["prefix"])
        if left + right < LEAST_WORDS:
            return
        for one in (self, other):
            start, end = one.row["place"] - left, one.row["place"] + right
            one.start = start if one.start is None else min(one.start, start)
            one.end = end if one.end is None else max(one.end, end)

    def outcome(self) -> dict:
        return {name: self.row[name] for name in _PLACED} | {"start": self.start, "end": self.end}


_OUTCOME = "node binary, key long, size long, place int, low int, high int, start int, end int, part int, side int, suffix binary, prefix binary"
_OUTCOME_KIND = pa.schema([("node", pa.binary()), ("key", pa.int64()), ("size", pa.int64()), ("place", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("part", pa.int32()), ("side", pa.int32()), ("suffix", pa.binary()), ("prefix", pa.binary())])


def _compare_sorted(rows: Iterator[dict]) -> Iterator[_Neighbour]:
    """Compare each suffix with the nearest ones of other documents before and after it."""
    last = before = None
    for row in rows:
        now = _Neighbour(row)
        if last is not None:
            if row["node"] != last.row["node"]:
                before = last
            if before is not None:
                now.compare(before)
            yield last
        last = now
    if last is not None:
        yield last


def _neighbours(sorted_rows: DataFrame) -> DataFrame:
    """Outcome of each suffix within its partition, and each partition's two ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out, first, last = [], None, None
        for done in _compare_sorted(row for batch in batches for row in batch.to_pylist()):
            first = first or done
            # A run of one document's suffixes may still gain from what follows: see _settle.
            out.append(done.outcome())
            last = done
            if len(out) == 5000:
                yield pa.RecordBatch.from_pylist(out, _OUTCOME_KIND)
                out = []
        if first is not None:
            out += [one.row | {"part": part, "side": side} for side, one in ((0, first), (1, last))]
        yield pa.RecordBatch.from_pylist(out, _OUTCOME_KIND)

    return sorted_rows.mapInArrow(run, _OUTCOME)


def _across(ends: DataFrame) -> DataFrame:
    """Outcomes of the suffixes at both sides of each border between partitions."""
    before = Window.orderBy("part", "side")  # two rows per partition of the sort
    fields = (*_PLACED, "suffix", "prefix")
    pairs = ends.select(F.struct(*fields).alias("b"), "side", F.lag(F.struct(*fields)).over(before).alias("a"))
    pairs = pairs.where("side = 0 AND a IS NOT NULL AND a.node <> b.node").select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pair in batch.to_pylist():
                a, b = _Neighbour(pair["a"]), _Neighbour(pair["b"])
                a.compare(b)
                out += [a.outcome(), b.outcome()]
            yield pa.RecordBatch.from_pylist(out, _OUTCOME_KIND)

    return pairs.mapInArrow(run, _OUTCOME)


def _powers(base: int, count: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(count - 1, base, np.uint64)]))


def window_sums(columns: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of every LEAST_WORDS successive words down each column: sums of word hashes times powers."""
    out = []
    for base, inverse in _BASES:
        sums = np.cumsum(columns * _powers(base, len(columns))[:, None], axis=0)
        sums = np.concatenate([np.zeros_like(sums[:1]), sums])
        windows = sums[LEAST_WORDS:] - sums[:-LEAST_WORDS]
        out.append(windows * _powers(inverse, len(windows))[:, None])
    return out


def _windows_in(batch: pa.RecordBatch) -> pa.RecordBatch:
    """As ``_window_hashes``, of one batch."""
    place, low, high, offsets = (batch.column(name).to_numpy() for name in ("place", "low", "high", "offsets"))
    left, right = (place - low).astype(np.int64), (high - place).astype(np.int64)
    after = _word_columns(batch.column("suffix"), right, LEAST_WORDS)
    before = _word_columns(batch.column("prefix"), left, WINDOW - 1)
    sums = window_sums(np.concatenate([before[::-1], after]))
    offset = np.arange(WINDOW)[::-1, None]  # of the windows in this order
    wanted = (offsets >> offset & 1).astype(bool) & (offset <= left) & (LEAST_WORDS - offset <= right)
    rows, windows = np.nonzero(wanted.T)
    starts = (place[rows] - offset[windows, 0]).astype(np.int32)
    long = [pa.array(one[windows, rows].view(np.int64)) for one in sums]
    return pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(rows)), pa.array(starts), *long], ["node", "start", "w1", "w2"])


def _window_hashes(contexts: DataFrame) -> DataFrame:
    """(node, start, w1, w2): a hash of those windows of the given positions whose offset is in ``offsets``.

    Bit k of ``offsets`` stands for the window that starts k words before the position.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield _windows_in(batch.slice(at, 1000))

    return contexts.select("node", "place", "low", "high", "offsets", "suffix", "prefix").mapInArrow(run, "node binary, start int, w1 long, w2 long")


def _two_documents() -> list[Column]:
    """a and b differ where a group has rows of more than one document; as numbers, these add up in a hash table."""
    return [F.min(F.xxhash64("node")).alias("a"), F.max(F.xxhash64("node")).alias("b")]


def _offsets(first: Column, last: Column) -> Column:
    """Bits of the windows that start from word ``first`` to ``last``; none where there are none."""
    high, low = (F.col("place") - first + 1).cast("int"), (F.col("place") - last).cast("int")
    bits = F.call_function("shiftleft", F.lit(1).cast("long"), high) - F.call_function("shiftleft", F.lit(1).cast("long"), low)
    return F.when(first <= last, bits).otherwise(F.lit(0).cast("long"))


def _uncovered(outcomes: DataFrame) -> DataFrame:
    """(key, offsets): where windows reach beyond what the neighbours match, over all positions of a group of three or more.

    All matches of a position hold its K words, so together they cover the words from the first start to the last end.
    """
    best = outcomes.where("size > 2").groupBy(*_PLACED).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    first, last = F.col("low"), F.col("high") - LEAST_WORDS
    left = _offsets(first, F.least(last, F.col("start") - 1))
    right = _offsets(F.greatest(first, F.col("end") - LEAST_WORDS + 1), last)
    offsets = F.when(F.col("end").isNull(), _offsets(first, last)).otherwise(left.bitwiseOR(right))
    return best.select("key", offsets.alias("offsets")).where("offsets <> 0").groupBy("key").agg(F.bit_or("offsets").alias("offsets"))


def _settle(contexts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Windows that repeat across documents, at the offsets where comparing neighbours may fall short."""
    # Stored, or the join would share the aggregate's shuffle and could not split a group of very many positions.
    windows = stored(_window_hashes(contexts.join(stored(_uncovered(outcomes), "uncovered"), "key")), "windows")
    repeated = windows.groupBy("w1", "w2").agg(*_two_documents()).where("a <> b").select("w1", "w2")
    # Stored, or the join would share the aggregate's shuffle and could not split a window of very many documents.
    found = windows.join(stored(repeated, "repeated-windows"), ["w1", "w2"], "left_semi")
    return found.select("node", "start", (F.col("start") + LEAST_WORDS).alias("end"))


def _across_tasks(contexts: DataFrame) -> DataFrame:
    """The same as ``_within_groups`` for groups of any size: matches of neighbours, and what they leave open by windows."""
    order = ("suffix", "prefix", "node", "place")
    outcomes = stored(_neighbours(contexts.repartitionByRange(*order).sortWithinPartitions(*order)), "outcomes")
    inner = outcomes.where("part IS NULL")
    outcome = (*_PLACED, "start", "end")
    every = stored(inner.select(*outcome).union(_across(outcomes.where("part IS NOT NULL")).select(*outcome)), "compared")
    return every.where("end IS NOT NULL").select("node", "start", "end").union(_settle(contexts, every))


def _joined(spans: DataFrame) -> DataFrame:
    """Spans of a document that overlap or touch, as one."""
    order = Window.partitionBy("node").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = spans.withColumn("new", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    numbered = numbered.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("node", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def _stored_small(df: DataFrame, purpose: str) -> DataFrame:
    """As ``stored``, in fewer bytes: contexts of copies repeat each other."""
    spark: SparkSession = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start_word, end_word, n_words, n_copies): passages that another document has too.

    Words are runs of anything but ASCII white space, A-Z in lower case; places count words from 0,
    ends exclusive. Every word in a row of ``LEAST_WORDS`` that another document has is in a span;
    no span has a word outside of such a row. Documents of equal words are copies: with ``LEAST_WORDS`` words or more each is one span
    whole, and n_copies says how many they are; else n_copies is 1.

    A null or short text has no spans, and repeats within one document do not count. Rows with a
    null or repeated doc_id are documents of their own. An empty table gives an empty result.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = stored(_marked(docs), "marked")
    classes = rows.where(F.col("n_words") >= LEAST_WORDS).groupBy("node")
    classes = stored(classes.agg(F.min("doc_id").alias("reader"), F.count("*").alias("n_copies")), "copies")

    read = rows.join(classes.withColumnRenamed("node", "c"), (F.col("node") == F.col("c")) & F.col("doc_id").eqNullSafe(F.col("reader")))
    placed = read.select("doc_id", "node", F.inline(F.arrays_zip("keys", "places", "lows", "highs")).alias("key", "place", "low", "high"))
    shared = placed.groupBy("key").agg(*_two_documents(), F.count("*").alias("size")).where("a <> b")
    # Stored for the same reason as in ``_settle``.
    shared = stored(shared.select("key", "size"), "shared-runs")
    wanted = placed.join(shared, "key").groupBy("doc_id", "node").agg(F.collect_set(F.struct("key", "place", "size", "low", "high")).alias("wanted"))
    wanted = wanted.select(F.col("doc_id").alias("reader"), "node", "wanted")
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("reader"))).select("node", "text", "wanted")
    contexts = _stored_small(_contexts(texts), "contexts")

    spans = _within_groups(contexts.where(F.col("size") <= LARGE)).union(_across_tasks(contexts.where(F.col("size") > LARGE)))
    passages = stored(_joined(spans.distinct()), "passages")

    alone = rows.where(F.col("n_words") >= LEAST_WORDS).select("doc_id", "node", "n_words").join(classes.select("node", "n_copies"), "node")
    whole = alone.where("n_copies > 1").select("doc_id", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"), "n_copies")
    parts = alone.where("n_copies = 1").join(passages, "node").select("doc_id", "start", "end", "n_copies")
    return whole.union(parts).select(
        "doc_id",
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        (F.col("end") - F.col("start")).alias("n_words"),
        "n_copies",
    )
