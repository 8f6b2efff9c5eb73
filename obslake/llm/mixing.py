"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies each of its documents should have. The
whole part is taken as it is; the fractions are settled by pairs: words move between two
documents, up or down at random so that each one's expectation stays, until one of them is
all in or all out, and the other meets the next document. So a source's words are met to
within its last document. Documents are paired in leaves of about ``LEAF_ROWS`` first; what each leaf
leaves open, one document, goes up a tree ``FAN_IN`` leaves at a time.

Each leaf draws from a generator seeded by its name and goes through its documents from the
largest to the least, so that what it leaves open tends to be small; ids settle ties. A run
gives the same mix however the work is dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.scratch import stored
from obslake.llm.text import to_bytes, words
from obslake.operators.ranking import with_position

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
LEAF_ROWS = 2000
FAN_IN = 64
SEED = 20240517


def word_count(text: Column) -> Column:
    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([len(words(t)) for t in to_bytes(texts)], pa.int64())

    return run(text)


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target), one row per source.

    Sources in the order of their names' code points, null last, take ``weights`` in turn and
    share the sum of all sizes. No target is above ``most`` times its source's size; the level
    that the others' targets reach per unit of weight rises until the sum is met. Sources are
    numbered by ranges of their names, so any number of them will do.
    """
    sizes = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    named = sizes.where("source IS NOT NULL")
    last = sizes.where("source IS NULL").withColumn("place", F.lit(named.count() + 1))
    placed = with_position(named, "source", "place").unionByName(last)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    sources = stored(placed.select("source", "source_size", weight.alias("weight")), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, known = 0.0, -1
    while total:
        capped = F.col("source_size") * most < F.col("weight") * level
        full, weight, count = sources.agg(
            F.coalesce(F.sum(F.when(capped, F.col("source_size") * most)), F.lit(0)),
            F.sum(F.when(~capped, F.col("weight"))),
            F.count(F.when(capped, 1)),
        ).first()
        if count == known or not weight:
            break
        level, known = (total - full) / weight, count
    target = F.least(F.col("source_size") * float(most), F.col("weight") * F.lit(level))
    return stored(sources.select("source", "source_size", target.alias("target")), "targets")


class _Leaf:
    """Pairs the open documents of one leaf as they come."""

    def __init__(self, level: int, name: tuple):
        seed = np.frombuffer(repr((SEED, level, *name)).encode(), np.uint8)
        self.random, self.open = np.random.default_rng(seed), None

    def add(self, row: dict) -> Iterator[dict]:
        """Rows that are settled by this one: ``in_words`` is then 0 or the document's size."""
        if self.open is None:
            self.open = row
            return
        a, b = self.open, row
        up = min(a["size"] - a["in_words"], b["in_words"])
        down = min(a["in_words"], b["size"] - b["in_words"])
        rises = self.random.random() * (up + down) < down
        moved = up if rises else -down
        self.open = None
        for one, change in ((a, moved), (b, -moved)):
            one["in_words"] = self._snapped(one["in_words"] + change, one["size"])
        for one in (a, b):
            if 0 < one["in_words"] < one["size"]:
                self.open = one
            else:
                yield one

    @staticmethod
    def _snapped(value: float, size: int) -> float:
        if value < 1e-9 * size:
            return 0.0
        return float(size) if value > size * (1 - 1e-9) else value


_STATE = "doc_id long, source string, size long, leaf long, in_words double, settled boolean"


def _one_level(rows: DataFrame, level: int) -> DataFrame:
    """Settle documents leaf by leaf; each leaf leaves one row open at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, current = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                name = (row["source"], row["leaf"])
                if leaf is None or name != current:
                    if leaf is not None and leaf.open is not None:
                        out.append(leaf.open)
                    leaf, current = _Leaf(level, name), name
                out.extend(one | {"settled": True} for one in leaf.add(row))
            yield pa.RecordBatch.from_pylist(out, batch.schema)
        if leaf is not None and leaf.open is not None:
            yield pa.RecordBatch.from_pylist([leaf.open], batch.schema)

    dealt = rows.repartition("source", "leaf").sortWithinPartitions("source", "leaf", F.desc("size"), "doc_id")
    return stored(dealt.mapInArrow(run, _STATE), "mixing")


def _settle(rows: DataFrame, leaves: int) -> DataFrame:
    """Rows of doc_id, source, size and in_words: which of them come in whole."""
    leaf = F.pmod(F.xxhash64("doc_id", "size"), F.lit(leaves))
    rows = rows.select("doc_id", "source", "size", leaf.alias("leaf"), "in_words", F.lit(False).alias("settled"))
    settled, level = [], 0
    while True:
        done = _one_level(rows, level)
        settled.append(done.where("settled"))
        rows = done.where("NOT settled")
        if leaves == 1:
            break
        leaves, level = -(-leaves // FAN_IN), level + 1
        rows = rows.withColumn("leaf", F.expr(f"leaf div {FAN_IN}"))
    # One document of each source may be left, and goes to the nearer side.
    last = rows.withColumn("in_words", F.when(2 * F.col("in_words") >= F.col("size"), F.col("size").cast("double")).otherwise(0.0))
    for table in settled:
        last = last.union(table)
    return last.select("doc_id", "source", "size", (F.col("in_words") > 0).cast("int").alias("extra"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per row of ``docs``.

    Size is the number of words, runs of anything but ASCII white space; a null or blank text
    has none, is in no copy and takes no part. A null source is a source of its own, last in
    order. Null and repeated ids are rows like others. Without any words all targets are 0.
    """
    lean = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size")
    )
    sized = stored(lean, "sized")
    targets = source_targets(sized, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = targets.select(
        F.col("source").alias("__source"), "source_size", "target", F.floor(rate).cast("int").alias("whole"), (rate - F.floor(rate)).alias("part")
    )
    shares = stored(shares, "shares")

    def with_share(df: DataFrame) -> DataFrame:
        return df.join(shares, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")

    rated = with_share(sized)
    open_rows = rated.where("size > 0 AND part > 0").withColumn("in_words", F.col("part") * F.col("size"))
    leaves = max(1, sized.count() // LEAF_ROWS)
    extra = _settle(open_rows, leaves)
    closed = rated.where("NOT (size > 0 AND part > 0)").select("doc_id", "source", "size", F.lit(0).alias("extra"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0)
    return with_share(extra.union(closed)).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")
    )


def draw(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it, none to ``MOST_COPIES`` times.

    Where a doc_id is repeated its rows are told apart by their source and number of words. All
    columns are as they were.
    """
    columns = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    docs = docs.select(columns, F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"))
    doc_id, text, source = "doc_id", "text", "source"
    taken = stored(mix(docs, doc_id, text, source).select("doc_id", "source", "size", "copies"), "taken")
    taken = taken.select(*(F.col(c).alias(f"__{c}") for c in taken.columns))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("__doc_id"))
    rows = docs
    ids = docs.groupBy(doc_id).count().where("count > 1")
    if not ids.isEmpty():
        # Number the rows of equal id, source and size on both sides: any of them stands for any other.
        rows = docs.withColumn("__n_words", word_count(F.col(text)))
        mine = Window.partitionBy(doc_id, source, "__n_words").orderBy(F.xxhash64(text))
        theirs = Window.partitionBy("__doc_id", "__source", "__size").orderBy("__copies")
        rows = rows.withColumn("__row", F.row_number().over(mine))
        taken = taken.withColumn("__other", F.row_number().over(theirs))
        same = same & F.col(source).eqNullSafe(F.col("__source")) & (F.col("__n_words") == F.col("__size")) & (F.col("__row") == F.col("__other"))
    return rows.join(taken.where("__copies > 0"), same).withColumn("__copy", F.explode(F.expr("sequence(1, __copies)"))).select("row.*")
