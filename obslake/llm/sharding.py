"""Histogram sort into shards of equal bytes.

Rows are ordered by a hash of their identity. Splitters between the shards are found without
sorting: each round counts the exact bytes in 4096 equal key intervals of every interval that
still holds a splitter, and goes on inside the interval where the wanted share of all bytes is
crossed, until it is met within the tolerance or one row is left. Three or four rounds of small
aggregates do for any size. Then the rows move once, in runs of a few thousand, and take their
place in the shard from the run's offset.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.scratch import stored

KEY_BITS = 60
#: Each round looks at 2**12 intervals of an interval: 4096 small rows per splitter.
ROUND_BITS = 12
#: Rows of a run on average; a run with eight times as many is looked into for repeated keys.
RUN_ROWS = 8192
_TIE_BITS = 60


def hash_key(*columns: Column) -> Column:
    """60 bits of an MD5 over the columns: an even order, the same on every run."""
    text = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


class _Search:
    """The interval that holds one splitter: places share ``prefix`` above ``shift`` bits."""

    def __init__(self, wanted: float):
        self.wanted, self.before = wanted, 0
        self.key, self.key_shift, self.tie, self.tie_shift = 0, KEY_BITS, 0, _TIE_BITS
        self.last: tuple[int, int] | None = None  # the last place left of the splitter

    @property
    def within(self) -> tuple[int, int, int, int]:
        return self.key, self.key_shift, self.tie, self.tie_shift

    def narrow(self, bins: list[tuple[int, int, int]], tolerance: float) -> None:
        """``bins``: (prefix, bytes, rows) of the interval's parts in order."""
        in_key = self.key_shift > 0
        shift = max(0, (self.key_shift if in_key else self.tie_shift) - ROUND_BITS)
        for prefix, size, rows in bins:
            if self.before + size < self.wanted:
                self.before += size
                continue
            end, start = ((prefix + 1) << shift) - 1, (prefix << shift) - 1
            if self.before + size - self.wanted <= tolerance or (rows == 1 and shift == 0):
                self.last = (end, (1 << 62)) if in_key else (self.key, end)
            elif self.wanted - self.before <= tolerance:
                self.last = (start, (1 << 62)) if in_key else (self.key, start)
            elif in_key:
                self.key, self.key_shift = prefix, shift
            else:
                self.tie, self.tie_shift = prefix, shift
            return


def _interval(search: _Search) -> Column:
    key, key_shift, tie, tie_shift = search.within
    inside = F.shiftright("__key", key_shift) == key
    return inside & (F.shiftright("__tie", tie_shift) == tie) if key_shift == 0 else inside


def find_splitters(rows: DataFrame, wanted: list[float], tolerance: float) -> list[tuple[int, int]]:
    """The last (key, tie) left of each splitter, for the bytes wanted before it.

    ``rows`` has __key, __tie and __size. The driver holds 4096 sums per splitter and round.
    """
    searches = [_Search(w) for w in wanted]
    while open_searches := [s for s in searches if s.last is None]:
        # Splitters in the same interval share its counts.
        intervals = {s.within: s for s in open_searches}
        which, part = F.lit(None).cast("int"), F.lit(None).cast("long")
        for number, search in enumerate(intervals.values()):
            column, shift = ("__key", search.key_shift) if search.key_shift else ("__tie", search.tie_shift)
            finer = F.shiftright(column, max(0, shift - ROUND_BITS))
            which = F.when(_interval(search), number).otherwise(which)
            part = F.when(_interval(search), finer).otherwise(part)
        counts = (
            rows.select(which.alias("i"), part.alias("part"), "__size")
            .where("i IS NOT NULL")
            .groupBy("i", "part")
            .agg(F.sum("__size").alias("bytes"), F.count("*").alias("n"))
            .collect()
        )
        bins: dict[int, list] = {}
        for i, prefix, size, n in sorted(counts):
            bins.setdefault(i, []).append((prefix, size, n))
        places = {within: bins[i] for i, within in enumerate(intervals)}
        for search in open_searches:
            search.narrow(places[search.within], tolerance)
    return [s.last for s in searches]


def _runs(rows: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the parts of their run's name, and the number of rows of each run.

    A run is an interval of keys within a shard. Where one key has very many rows (repeated
    rows) it makes runs of its own, cut by the task that first wrote them.
    """
    bits = max(0, (count // RUN_ROWS).bit_length())
    rows = rows.withColumn("__run", F.shiftright("__key", KEY_BITS - bits))
    name = ["shard", "__run", "__part", "__block"]
    plain = rows.withColumn("__part", F.lit(0)).withColumn("__block", F.lit(0).cast("long"))
    counts = stored(plain.groupBy(name).count(), "runs")
    crowded = counts.where(F.col("count") > 8 * RUN_ROWS).select("__run").distinct()
    if crowded.isEmpty():
        return plain, counts
    many = rows.join(crowded, "__run", "left_semi").groupBy("__run", "__key").count().where(F.col("count") > RUN_ROWS)
    # At most one key for each RUN_ROWS rows of the run.
    keys = stored(many.groupBy("__run").agg(F.array_sort(F.collect_list("__key")).alias("__many")), "repeated")
    marked = rows.join(keys, "__run", "left").withColumn("__many", F.coalesce("__many", F.array().cast("array<long>")))
    own = F.array_contains("__many", F.col("__key"))
    below = F.size(F.filter("__many", lambda k: k < F.col("__key")))
    cut = marked.withColumn("__part", 2 * below + own.cast("int"))
    cut = cut.withColumn("__block", F.when(own, F.shiftright("__tie", 13)).otherwise(F.lit(0)).cast("long")).drop("__many")
    return cut, stored(cut.groupBy(name).count(), "runs")


def histogram_sort(
    df: DataFrame, identity: list[str], size: Column, shards: int = 16, tolerance: float = 0.0
) -> DataFrame:
    """``df`` with shard (int, 0 to ``shards`` - 1) and slot (long, gapless from 0 in each shard).

    Shards are successive ranges of a hash of ``identity`` whose bytes differ from an equal share
    by at most one row, or by ``tolerance`` bytes at either end if that is more. Slots follow
    the order of the hash. Nulls count as empty in the hash. Rows equal in ``identity`` may stand on both sides
    of a splitter; among them the order is that in which a task first wrote them. An empty
    table gives an empty result; columns of ``df`` named shard or slot are replaced, all others come
    first and as they were.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot")]
    # The input's columns stay inside a struct, so that none can clash with those added here.
    keyed = df.select(
        F.struct(*kept).alias("row"),
        hash_key(*(F.col(f"`{c}`") for c in identity)).alias("__key"),
        F.monotonically_increasing_id().alias("__tie"),
        size.cast("long").alias("__size"),
    )
    rows = stored(keyed, "keyed")
    total, count = rows.agg(F.coalesce(F.sum("__size"), F.lit(0)), F.count("*")).first()
    wanted = [total * i / shards for i in range(1, shards)] if total else []
    shard = F.lit(0)
    for key, tie in find_splitters(rows, wanted, tolerance):
        after = (F.col("__key") > key) | ((F.col("__key") == key) & (F.col("__tie") > tie))
        shard = shard + after.cast("int")
    placed, counts = _runs(rows.withColumn("shard", shard), count)
    name = ["shard", "__run", "__part", "__block"]
    before = Window.partitionBy("shard").orderBy(*name[1:]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.withColumn("__offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"), "offsets")
    place = F.row_number().over(Window.partitionBy(*name).orderBy("__key", "__tie"))
    placed = placed.withColumn("__place", place).join(offsets, name)
    return placed.select("row.*", "shard", (F.col("__offset") + F.col("__place") - 1).alias("slot"))
