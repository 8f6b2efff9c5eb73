"""Near-duplicate documents: fast similarity sketches, banding and exact verification.

Texts with equal shingle sets are one class, so copies cost one row each and no pairs.
Each class is sketched (``sketch.py``) with ``SIZE`` coordinates in bands of ``ROWS``: two classes of
similarity 0.8 share no band with probability (1 - 0.8**4)**32 = 5e-8. In every bucket all
classes are compared with one of them first, the one that shares its other buckets with most
classes: among edited copies that is the text they were made from. What these links do not
join to one component is then compared by the sketches, and pairs that agree as often as
similar sets do (all but ``MISS`` of them) are verified: as rows in buckets of up to ``BLOCK_ROWS``
classes. The classes of larger buckets are bucketed anew by their rarest shingles (``prefixes.py``), of
which similar sets share one, so pages made from one template that are not similar do not
meet at all. Classes in a large bucket of this kind too are verified inside tasks, block against block
with the sets at hand. So a large group of near copies never becomes a row for every pair.
Every link is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.components import components
from obslake.llm.prefixes import prefix_buckets
from obslake.llm.scratch import forget, stored
from obslake.llm.sketch import bands, sketches
from obslake.llm.text import long_lists, lower_words, shingle_set, to_bytes, word_hashes

SIZE, ROWS = 128, 4
PERCENT = 80
#: Probability that the sketches of a pair of the least similarity are taken for dissimilar.
MISS = 1e-7
#: Larger buckets are compared in blocks of about so many classes.
BLOCK_ROWS = 64
#: Rows of two blocks each that a task holds at once.
BLOCKS_AT_ONCE = "8"

_SKETCHED = "doc_id long, digest binary, n_shingles long, buckets array<long>, sketch binary"


def _sketched(docs: DataFrame, width: int) -> DataFrame:
    """Identity of the shingle set, its size, bucket keys and sketch, for each document.

    Of the sketch's coordinates the lowest byte is kept: different ones agree by chance in one
    case of 256, so equal bytes are never fewer than equal coordinates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            sets = [shingle_set(hashes.of(lower_words(t)), width) for t in to_bytes(batch.column("text"))]
            table = sketches(sets, SIZE)
            low = table.astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([hashlib.md5(one.tobytes()).digest() for one in sets], pa.binary()),
                    pa.array([len(one) for one in sets], pa.int64()),
                    long_lists(bands(table, ROWS)),
                    pa.array([row.tobytes() for row in low], pa.binary()),
                ],
                ["doc_id", "digest", "n_shingles", "buckets", "sketch"],
            )

    return docs.mapInArrow(run, _SKETCHED)


def _full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, shingles): the sorted 64-bit hashes of the full set, under its identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            sets = [shingle_set(hashes.of(lower_words(t)), width).tobytes() for t in to_bytes(batch.column("text"))]
            nodes = [hashlib.md5(one).digest() for one in sets]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], ["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node binary, shingles binary")


def _reaches(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets' intersection is at least ``percent`` % of their union."""
    if len(one) > len(other):
        one, other = other, one
    at = np.minimum(np.searchsorted(other, one), len(other) - 1)
    shared = int((other[at] == one).sum())
    return 100 * shared >= percent * (len(one) + len(other) - shared)


def _similar(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            sets = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("set_a", "set_b"))
            for one, other in zip(*sets, strict=True):
                linked.append(_reaches(np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64), percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return pairs.mapInArrow(run, "a binary, b binary")


def _sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, repeated: bool, nameless: bool, width: int) -> DataFrame:
    """(node, shingles) of these classes, stored; only their texts, and those without id, are read again."""
    wanted = classes.join(nodes, "node", "left_semi").select("node", "doc_id")
    sets = _full_sets(docs.join(wanted.select("doc_id"), "doc_id", "left_semi"), width)
    if nameless:
        unnamed = _full_sets(docs.where("doc_id IS NULL"), width)
        sets = sets.union(unnamed.join(wanted.where("doc_id IS NULL").select("node"), "node", "left_semi"))
    if repeated or nameless:  # several rows have a doc_id or none, so a class may come more than once
        sets = sets.dropDuplicates(["node"])
    return stored(sets, "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among candidate ``pairs`` of classes."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return stored(_similar(pairs.join(one, "a").join(other, "b"), percent), "links")


def _close_in_size(percent: int):
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return small * 100 >= large * percent


def least_agreement(percent: int) -> int:
    """Equal coordinates that a pair of the least similarity has, but with probability ``MISS``."""
    share, tail = percent / 100, 0.0
    for k in range(SIZE + 1):
        tail += math.comb(SIZE, k) * share**k * (1 - share) ** (SIZE - k)
        if tail > MISS:
            return k
    return SIZE


def _sketches(members: list[dict]) -> np.ndarray:
    return np.frombuffer(b"".join(one["sketch"] for one in members), np.uint8).reshape(-1, SIZE)


def _alike(still: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components in a small bucket whose sketches agree often enough.

    ``still`` has bucket, node, component, n_shingles and sketch, ``BLOCK_ROWS`` rows a bucket at most.
    """
    buckets = still.groupBy("bucket").agg(F.collect_list(F.struct("node", "component", "n_shingles", "sketch")).alias("m"))
    least = least_agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for members in batch.column("m").to_pylist():
                sizes = np.array([one["n_shingles"] for one in members])
                table = _sketches(members)
                for k, one in enumerate(members[:-1]):
                    others, size = sizes[k + 1 :], sizes[k]
                    close = 100 * np.minimum(others, size) >= percent * np.maximum(others, size)
                    for j in np.flatnonzero(close & ((table[k + 1 :] == table[k]).sum(axis=1) >= least)):
                        other = members[k + 1 + int(j)]
                        if one["component"] != other["component"]:
                            found.add((min(one["node"], other["node"]), max(one["node"], other["node"])))
            columns = [pa.array([pair[k] for pair in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return buckets.select("m").mapInArrow(run, "a binary, b binary").distinct()


def _linked_in_blocks(still: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components in a large bucket, verified where the blocks meet.

    ``still`` has bucket, node, component, sketch, buckets and shingles. The largest component of a
    bucket needs no comparison within itself, so blocks of the other classes meet blocks
    of all. A pair is compared in the first bucket it shares only.
    """
    parts = still.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("m"))
    main = main.select("bucket", "n", F.col("m.component").alias("main"), F.col("m.n").alias("n_main"))
    dealt = still.join(main, "bucket")
    fields = F.struct("node", "component", (F.col("component") == F.col("main")).alias("main"), "sketch", "buckets", "shingles")

    def blocks(rows: DataFrame, count, name: str) -> DataFrame:
        number = F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.ceil(count / BLOCK_ROWS)))
        return rows.groupBy("bucket", number.alias("block")).agg(F.collect_list(fields).alias(name)).drop("block")

    aside = blocks(dealt.where("component <> main"), F.col("n") - F.col("n_main"), "one")
    met = aside.join(blocks(dealt, F.col("n"), "all"), "bucket")
    least = least_agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in range(batch.num_rows):
                bucket = batch.column("bucket")[row].as_py()
                ones, others = batch.column("one")[row].as_py(), batch.column("all")[row].as_py()
                keys = np.array([other["buckets"] for other in others])
                table, sets = _sketches(others), [np.frombuffer(other["shingles"], np.uint64) for other in others]
                sizes = np.array([len(one) for one in sets])
                for one in ones:
                    mine = np.frombuffer(one["shingles"], np.uint64)
                    own = np.array(one["buckets"])
                    first = (keys == own).argmax(axis=1) == int(np.flatnonzero(own == bucket)[0])
                    close = 100 * np.minimum(sizes, len(mine)) >= percent * np.maximum(sizes, len(mine))
                    agree = (table == np.frombuffer(one["sketch"], np.uint8)).sum(axis=1) >= least
                    for j in np.flatnonzero(first & close & agree):
                        other = others[j]
                        if other["component"] == one["component"] or (not other["main"] and other["node"] < one["node"]):
                            continue  # within a component, or met from the other side
                        if _reaches(mine, sets[j], percent):
                            found.append((one["node"], other["node"]))
            columns = [pa.array([pair[k] for pair in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return met.mapInArrow(run, "a binary, b binary")


def _small_batches(df: DataFrame) -> DataFrame:
    """The table stored, computed with few rows of blocks in a task's memory at a time."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, BLOCKS_AT_ONCE)
    try:
        return stored(df, "links")
    finally:
        conf.set(name, before)


def with_components(docs: DataFrame, width: int = 2, percent: int = PERCENT, by_rarest: bool = True) -> DataFrame:
    """(doc_id, digest, n_shingles, component, component_id), one row per row of ``docs`` (doc_id, text).

    digest stands for the shingle set and component for all sets that links reach; a text without
    shingles has no component. Without ``by_rarest`` all classes of large buckets are compared in blocks,
    which gives the same links. component_id is null where no row of a component has a doc_id.
    The table is stored; all that led to it is deleted again, as soon as it has served.
    """
    rows = stored(_sketched(docs, width), "sketched")
    repeated = not rows.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()
    nameless = not rows.where("doc_id IS NULL").isEmpty()
    classes = stored(
        rows.where("n_shingles > 0")
        .groupBy(F.col("digest").alias("node"))
        .agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("n_shingles", "buckets", "sketch")).alias("r"))
        .select("node", "doc_id", "r.*"),
        "classes",
    )
    lean = stored(rows.select("doc_id", "digest", "n_shingles"), "digests")
    forget(rows)
    banded = classes.select("node", "n_shingles", F.explode("buckets").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(banded.join(shared, "bucket"), "members")

    reach = members.groupBy("node").agg(F.sum("n").alias("reach"))
    pivots = members.join(reach, "node").groupBy("bucket").agg(F.max(F.struct("reach", "node", "n_shingles")).alias("p"))
    first = stored(
        members.join(pivots.select("bucket", F.col("p.node").alias("pivot"), F.col("p.n_shingles").alias("n_b")), "bucket")
        .withColumnRenamed("n_shingles", "n_a")
        .where((F.col("node") != F.col("pivot")) & _close_in_size(percent))
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct(),
        "pairs",
    )
    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()

    sets = _sets_of(ends(first), classes, docs, repeated, nameless, width)
    links = _verified(first, sets, percent)
    forget(sets)
    joined = components(links, "a", "b")

    placed = stored(
        members.select("bucket", "node", "n_shingles", "n")
        .join(joined, "node", "left")
        .withColumn("component", F.coalesce("component", "node")),
        "placed",
    )
    forget(members)
    open_buckets = placed.groupBy("bucket").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d")
    still = stored(placed.join(open_buckets.select("bucket"), "bucket", "left_semi"), "still")
    forget(placed)
    small, large = still.where(F.col("n") <= BLOCK_ROWS), still.where(F.col("n") > BLOCK_ROWS)
    rest = stored(_alike(small.join(classes.select("node", "sketch"), "node"), percent).join(first, ["a", "b"], "left_anti"), "pairs")
    crowd = stored(large.select("node", "component", "n_shingles").distinct(), "crowd")
    sets = _sets_of(ends(rest).union(crowd.select("node")).distinct(), classes, docs, repeated, nameless, width)

    spent, crowded = [sets, still, rest, first, crowd], large.drop("n")
    if by_rarest:
        rarest = stored(prefix_buckets(crowd.join(sets, "node"), percent), "rarest")
        met_by = (F.count("*").alias("n"), F.min("component").alias("c"), F.max("component").alias("d"), F.bool_or("home").alias("lived_in"))
        groups = rarest.groupBy("bucket").agg(*met_by).where("c < d AND lived_in")
        met = stored(rarest.drop("home").join(groups.select("bucket", "n"), "bucket"), "met")
        forget(rarest)
        few = met.where(F.col("n") <= BLOCK_ROWS).join(classes.select("node", "sketch"), "node")
        further = stored(_alike(few, percent).join(first, ["a", "b"], "left_anti").join(rest, ["a", "b"], "left_anti"), "pairs")
        many = stored(met.where(F.col("n") > BLOCK_ROWS).select("node").distinct(), "many")
        rest, crowded = rest.union(further), crowded.join(many, "node")
        spent += [further, met, many]
    held = crowded.join(classes.select("node", "sketch", "buckets"), "node").join(sets, "node")
    more = _verified(rest, sets, percent).union(_small_batches(_linked_in_blocks(held, percent)))
    more = stored(more, "links")
    forget(*spent)
    joined = components(links.union(more), "a", "b")

    labelled = classes.select("node", "doc_id").join(joined, "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = labelled.join(least, "component").select(F.col("node").alias("digest"), "component", "component_id")
    found = stored(lean.join(named, "digest", "left"), "components")
    forget(lean, classes, links, more)
    return found


def digest_of(text: Column, width: int) -> Column:
    """The digest that ``with_components`` gives a text; null for one without shingles."""

    @F.arrow_udf("binary")
    def digest(texts: pa.Array) -> pa.Array:
        hashes = word_hashes()
        sets = [shingle_set(hashes.of(lower_words(t)), width) for t in to_bytes(texts)]
        return pa.array([hashlib.md5(one.tobytes()).digest() if len(one) else None for one in sets], pa.binary())

    return digest(text)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 2, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z in lower case; a document's set has
    its distinct runs of ``width`` words, or all words as one where there are fewer. Sets whose
    intersection is at least ``percent`` % of their union are linked; component_id is the least
    doc_id that links reach, and kept says that it is the document's own.

    A null, empty or blank text has no shingles and is linked with nothing. A null doc_id is
    nobody's component: such a row takes its component from the others, null if there are none,
    and is never kept. Rows that repeat a doc_id are judged by their own texts, each.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = with_components(docs, width, percent)
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def single_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of similar documents, that of least doc_id.

    A row without doc_id is kept only where none of its group has one. Rows that share a doc_id
    are judged by their own texts, each, and of those with equal shingles too one stays. A row in no
    group stays, as does every row without shingles. All columns are as they were.
    """
    carried = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    found = with_components(carried.select("doc_id", "text"), width, percent, by_rarest=False)
    shared = stored(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "shared-ids")
    dropped = stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "dropped-ids")
    single = carried.where("doc_id IS NOT NULL").join(shared, "doc_id", "left_anti").join(dropped, "doc_id", "left_anti")

    # Rows that their doc_id does not tell apart: by the digest too, and one of those equal in both.
    columns = ("row", "doc_id", "text")
    others = carried.where("doc_id IS NULL").unionByName(carried.join(shared, "doc_id", "left_semi").select(*columns))
    others = others.withColumn("digest", digest_of(F.col("text"), width))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("k")
    keepers = found.where("component IS NOT NULL").groupBy("component").agg(first)
    keepers = keepers.select(F.col("k.doc_id").alias("kept_id"), F.col("k.digest").alias("kept_digest"))
    same = (F.col("digest") == F.col("kept_digest")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    told = others.join(keepers, same, "left_semi").dropDuplicates(["doc_id", "digest"])
    loose = others.where("digest IS NULL")
    return single.select("row.*").union(told.select("row.*")).union(loose.select("row.*"))
