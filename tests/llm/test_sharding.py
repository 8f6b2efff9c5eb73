from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from obslake.llm import sharding
from obslake.llm.queries import op2_histogram_sort
from tests.conftest import SMALL
from tests.llm.conftest import DOCUMENTS


def size():
    return F.octet_length(F.coalesce("text", F.lit(""))) + 1


def check_law(rows, shards, largest):
    sizes, slots = defaultdict(int), defaultdict(list)
    for row in rows:
        sizes[row.shard] += row.size
        slots[row.shard].append(row.slot)
    total = sum(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for k in range(shards):
        assert abs(sizes[k] - total / shards) <= largest


def test_query_cuts_equal_bytes(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op2_histogram_sort(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        text = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "bytes", None)
    check_law(rows, 16, max(r.size for r in rows))


def test_shards_follow_exclusive_sums_of_the_hash_order(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") * 37 % 101 + 1).alias("size"))
    placed = sharding.histogram_sort(df, ["doc_id"], F.col("size"), shards=7)
    rows = placed.withColumn("k", sharding.hash_key(F.col("doc_id"))).orderBy("k").collect()
    total, before = sum(r.size for r in rows), 0
    for r in rows:
        assert r.shard == sum(before >= total * i / 7 for i in range(1, 7))
        before += r.size
    assert [r.slot for r in rows if r.shard == 3] == list(range(sum(r.shard == 3 for r in rows)))


@pytest.mark.parametrize("tolerance", [0.0, 50.0, 1e9])
def test_equal_rows_stand_on_both_sides_of_splitters(spark, tolerance):
    df = spark.range(3000).select(F.lit(5).alias("doc_id"), F.lit("same").alias("text"), F.lit(10).alias("size"))
    rows = sharding.histogram_sort(df, ["doc_id", "text"], F.col("size"), tolerance=tolerance).collect()
    if tolerance < 1e9:
        check_law(rows, 16, 10 + 2 * tolerance)
    assert len(rows) == 3000


def test_a_key_with_very_many_rows_is_cut_into_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN_ROWS", 50)
    many = spark.range(2000).select(F.lit(5).alias("doc_id"), F.lit(10).alias("size"))
    df = many.union(spark.range(100, 400).select("id", F.lit(3)))
    rows = sharding.histogram_sort(df, ["doc_id"], F.col("size")).collect()
    check_law(rows, 16, 10)


def test_awkward_rows(awkward, clashing, nothing):
    rows = sharding.histogram_sort(awkward, ["doc_id", "text"], size()).collect()
    assert len(rows) == awkward.count() and list(rows[0].asDict()) == [*awkward.columns, "shard", "slot"]
    names = ("__size", "__run", "__part", "__block", "__place", "__offset", "row", "count")
    more = clashing.withColumns({name: F.lit(f"my {name}") for name in names})
    placed = sharding.histogram_sort(more, ["doc_id", "text"], size())
    others = [c for c in more.columns if c not in ("shard", "slot")]
    assert placed.columns == [*others, "shard", "slot"] and dict(placed.dtypes)["shard"] == "int"
    assert sorted(map(repr, placed.select(*others).collect())) == sorted(map(repr, more.select(*others).collect()))
    assert sharding.histogram_sort(nothing, ["doc_id", "text"], size()).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCUMENTS)
    plan = sharding.histogram_sort(df, ["doc_id", "text"], size())._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
