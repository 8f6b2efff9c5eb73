"""Periodic runs of words, by the branching-tandem test on enhanced suffix arrays.

A run is a stretch of words with a period, as long as it can be. Its last square, the rightmost
rotation, branches: the word after it is not the one a period earlier. Such a square of period q at
word i shows in the suffix array as an interval of LCP q that holds the suffixes i and i + q in two
different children. So the suffixes of all children but the largest of each interval look whether the
suffix q words on, or q words back, lies in the interval too (Stoye and Gusfield 2002; Abouelhoda,
Kurtz and Ohlebusch 2004). That is at most n log n looks. Intervals come from one sweep over the LCP
array; no tree is built. Each square found is rotated to the left as far as its period holds, which
gives the run, and squares that give the same stretch are merged under its least period.

Suffixes are sorted by prefix doubling, many texts at a time, each text a block of its own. The ranks
of all rounds are kept: the longest common prefix and the rotation are read off them by halving steps.
A run of at least ``least`` words and three periods repeats some stretch of two thirds of ``least`` words,
so texts whose suffixes all differ within that are done after the first rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words sorted together. A longer text is sorted by itself.
WORDS_AT_ONCE = 400_000

Run = tuple[int, int, int]  # start, length, period

#: What ``find_runs`` adds.
RESULT = "struct<runs:array<struct<start:long,length:long,period:long>>,best:int,collapsed:string>"


class Numbered(dict):
    """Numbers words in the order they come, equal words alike."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Ranks:
    """Ranks of suffixes by their first 1, 2, 4 ... words, texts as blocks one after another.

    ``levels[k][i]`` is equal for two places of a text just when the 2**k words from each are
    inside the text and the same. The last level orders all suffixes: it is the inverse suffix array.
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        """``bounds``: where the texts start, and the end of the last one."""
        self.bounds = bounds
        sizes = np.diff(bounds)
        self.end = np.repeat(bounds[1:], sizes)
        self.start = np.repeat(bounds[:-1], sizes)
        order = np.lexsort((words, self.start))
        first = np.ones(len(words), bool)
        first[1:] = (words[order[1:]] != words[order[:-1]]) | (self.start[order[1:]] != self.start[order[:-1]])
        self.levels = [np.empty(len(words), np.int32)]
        self.levels[0][order] = _starts(first)
        self.open = order[_shared(first)]

    def double(self) -> None:
        """The next level: only suffixes that share a rank are looked at."""
        width, rank, at = 1 << (len(self.levels) - 1), self.levels[-1], self.open
        beyond = at + width
        inside = beyond < self.end[at]
        follow = np.where(inside, rank[np.minimum(beyond, len(rank) - 1)].astype(np.int64) + 1, 0)
        key = rank[at].astype(np.int64) * (len(rank) + 1) + follow
        order = np.argsort(key, kind="stable")
        at, key, old = at[order], key[order], rank[at[order]]
        new_first, old_first = np.ones(len(at), bool), np.ones(len(at), bool)
        new_first[1:] = key[1:] != key[:-1]
        old_first[1:] = old[1:] != old[:-1]
        finer = rank.copy()
        finer[at] = old + _starts(new_first) - _starts(old_first)
        self.levels.append(finer)
        self.open = at[_shared(new_first)]

    def only(self, texts: np.ndarray) -> Ranks:
        """The same for some of the texts; ranks keep their order but not their values."""
        sizes = np.diff(self.bounds)
        keep = np.repeat(texts, sizes)
        moved = np.cumsum(keep) - 1
        chosen = object.__new__(Ranks)
        chosen.bounds = np.concatenate(([0], np.cumsum(sizes[texts])))
        sizes = sizes[texts]
        chosen.end, chosen.start = np.repeat(chosen.bounds[1:], sizes), np.repeat(chosen.bounds[:-1], sizes)
        # A text's ranks are the places of its own block, so they move with the block.
        shift = (np.flatnonzero(keep) - moved[keep]).astype(np.int32)
        chosen.levels = [level[keep] - shift for level in self.levels]
        chosen.open = moved[self.open[keep[self.open]]]
        return chosen

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b``, pairs of one text, share from the left."""
        end, last, length = self.end[a], len(self.end) - 1, np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.levels))):
            level, far = self.levels[k], np.maximum(a, b) + length
            inside = far < end
            same = inside & (level[np.minimum(a + length, last)] == level[np.minimum(b + length, last)])
            length += same.astype(np.int64) << k
        return length

    def common_suffix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that are the same before ``a`` and before ``b``, ``a`` the smaller of the pair."""
        low, length = self.start[a], np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.levels))):
            step = length + (1 << k)
            inside = a - step >= low
            level = self.levels[k]
            same = inside & (level[np.where(inside, a - step, 0)] == level[np.where(inside, b - step, 0)])
            length = np.where(same, step, length)
        return length


def _starts(first: np.ndarray) -> np.ndarray:
    """For each element the place where its group starts."""
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def _shared(first: np.ndarray) -> np.ndarray:
    """Which elements are in groups of two or more."""
    alone = first & np.append(first[1:], True)
    return ~alone


def _children(lcp: list[int]) -> np.ndarray:
    """(left, right, depth, child's left, child's right) for all children of LCP intervals of depth > 0.

    ``lcp[r]`` is that of the r-th suffix and the one before; the first is 0. One sweep with a stack
    of open intervals (left end, depth, left ends of the children).
    """
    rows: list[tuple[int, int, int, int, int]] = []
    stack: list[tuple[int, int, list[int]]] = []
    for r in range(1, len(lcp) + 1):
        depth = lcp[r] if r < len(lcp) else 0
        left = r - 1
        while stack and stack[-1][1] > depth:
            left, deep, begun = stack.pop()
            for child, following in zip(begun, [*begun[1:], r], strict=True):
                rows.append((left, r, deep, child, following))
        if depth:
            if stack and stack[-1][1] == depth:
                stack[-1][2].append(r)
            else:
                stack.append((left, depth, [left, r]))
    return np.array(rows, np.int64).reshape(-1, 5)


def _squares(ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the branching squares, in no order."""
    isa = ranks.levels[-1].astype(np.int64)
    sa = np.empty(len(isa), np.int64)
    sa[isa] = np.arange(len(isa))
    lcp = np.zeros(len(isa), np.int64)
    near = np.flatnonzero(ranks.start[sa[1:]] == ranks.start[sa[:-1]]) + 1
    lcp[near] = ranks.common_prefix(sa[near - 1], sa[near])
    nodes = _children(lcp.tolist())
    if not len(nodes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # All but the largest child: intervals are told apart by their ends and depth.
    size = nodes[:, 4] - nodes[:, 3]
    order = np.lexsort((size, nodes[:, 2], nodes[:, 1], nodes[:, 0]))
    nodes, size = nodes[order], size[order]
    largest = np.append((nodes[1:, :3] != nodes[:-1, :3]).any(axis=1), True)
    nodes, size = nodes[~largest], size[~largest]

    found = []
    for a, b in _portions(size):
        part, count = nodes[a:b], size[a:b]
        owner = np.repeat(np.arange(len(part)), count)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        place = sa[part[owner, 3] + offset]
        depth = part[owner, 2]
        for step in (depth, -depth):
            other = place + step
            inside = (other >= ranks.start[place]) & (other < ranks.end[place])
            row = isa[np.where(inside, other, 0)]
            left, right, _, low, high = part[owner].T
            hit = inside & (row >= left) & (row < right) & ~((row >= low) & (row < high))
            found.append(np.stack([np.minimum(place, other)[hit], depth[hit]]))
    place, period = np.concatenate(found, axis=1)
    return place, period


def _portions(sizes: np.ndarray, most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` elements in sum."""
    total = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
        yield start, end
        start = end


def runs_of(texts: list[list[bytes]], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[list[Run]]:
    """The runs of each text, by start and then period."""
    found: list[list[Run]] = [[] for _ in texts]
    long = [k for k, words in enumerate(texts) if len(words) >= max(least, periods)]
    if not long:
        return found
    number = Numbered()
    ids = np.fromiter((number[w] for k in long for w in texts[k]), np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(texts[k]) for k in long])))
    ranks = Ranks(ids, bounds)
    # A run of length L and period q repeats a stretch of L - q >= (1 - 1/periods) * L words.
    repeated = least - least // periods
    while len(ranks.open) and (2 << (len(ranks.levels) - 1)) <= repeated:
        ranks.double()
    if not len(ranks.open):
        return found
    holds = np.zeros(len(long), bool)
    holds[np.searchsorted(bounds, ranks.open, side="right") - 1] = True
    ranks = ranks.only(holds)
    while len(ranks.open):
        ranks.double()

    place, period = _squares(ranks)
    start = place - ranks.common_suffix(place, place + period)
    end = place + 2 * period
    # The same stretch under several periods: the least one is first.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    keep &= end - start >= np.maximum(least, periods * period)
    owners = np.flatnonzero(holds)
    for s, e, q in zip(start[keep].tolist(), end[keep].tolist(), period[keep].tolist(), strict=True):
        block = int(np.searchsorted(ranks.bounds, s, side="right")) - 1
        found[long[owners[block]]].append((s - int(ranks.bounds[block]), e - s, q))
    return [sorted(one, key=lambda run: (run[0], run[2], run[1])) for one in found]


def best_of(runs: list[Run]) -> int | None:
    """Index of the run with the largest exact length / period; of equal ones the first, then the least period."""
    best = None
    for k, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = k
    return best


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without all that runs hold after their first period, with one space between."""
    if not runs:
        return b" ".join(words)
    parts, at = [], 0
    for start, end in sorted((s + q, s + length) for s, length, q in runs):
        if end > at:
            parts += words[at : max(at, start)]
            at = end
    return b" ".join(parts + words[at:])


def find_runs(text: Column, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> Column:
    """A struct of runs, best and collapsed, as ``RESULT`` says.

    Words are runs of anything but ASCII white space, numbered from 0. ``runs`` lists every stretch of
    words with least period q, words q apart being identical, that no neighbouring word extends and that has
    at least ``least`` words and ``periods`` periods; by start, then period. ``best`` is the index there
    of the run of most periods, counted exactly; of equal ones the first, then that of least period;
    null where there is none. ``collapsed`` has the words that no run holds after its first period, with
    one space between. A null, empty or blank text has no run and collapses to an empty one.
    """
    if periods < 2 or least < 1:
        raise ValueError("a run has at least two periods and one word")

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        offsets, flat, best, collapsed = [0], [], [], []
        for words in _batches(texts):
            for one, runs in zip(words, runs_of(words, least, periods), strict=True):
                flat += runs
                offsets.append(len(flat))
                best.append(best_of(runs))
                collapsed.append(collapse(one, runs))
        columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
        rows = pa.StructArray.from_arrays(columns, ["start", "length", "period"])
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows),
                pa.array(best, pa.int32()),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ],
            ["runs", "best", "collapsed"],
        )

    return run(text)


def _batches(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of the texts, in order, in lists of about ``WORDS_AT_ONCE`` words."""
    held, count = [], 0
    for text in texts.cast(pa.binary()):
        words = (text.as_py() or b"").split()
        if held and count + len(words) > WORDS_AT_ONCE:
            yield held
            held, count = [], 0
        held.append(words)
        count += len(words)
    if held:
        yield held


def with_runs(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the fields of ``find_runs``; columns of the same names are replaced, the rest stay."""
    names = ["runs", "best", "collapsed"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    made = docs.select(F.struct(*kept).alias("row"), find_runs(F.col(text), **options).alias("made"))
    return made.select("row.*", *(F.col(f"made.{name}").alias(name) for name in names))


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text, and in one of ten documents a tail that repeats, as a checksum of the id decides.

    With h the unsigned CRC-32 of the decimal id and g = h // 10: where h ends in 0 and there are n > 0 words,
    each word i from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8), and
    single spaces stand between the words. Other texts stay; a null text, and one without id, stays null or as it is.
    """

    @F.arrow_udf("string")
    def run(checks: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for h, content in zip(checks.to_pylist(), texts.cast(pa.binary()).to_pylist(), strict=True):
            if content and h is not None and h % 10 == 0 and (words := content.split()):
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                content = b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)])
            out.append(content)
        return pa.array(out, pa.binary()).cast(pa.string())

    return run(F.crc32(doc_id.cast("string")), text)
