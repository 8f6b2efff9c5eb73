"""One key holds most rows: results stay whole, and rows are combined before they are shuffled."""

from pyspark.sql import functions as F

from obslake.operators import inventory, profiles
from obslake.streaming import latest

ROWS = 20_000


def test_hot_platform_in_the_index(spark):
    hot = F.when(F.col("id") % 10 < 9, F.lit(7)).otherwise(F.col("id") % 500)
    entries = spark.range(ROWS).select(
        F.format_string("aoml/%s/profiles/R%s_%s.nc", hot, hot, F.col("id")).alias("file"),
        F.lit("20100101000000").alias("date"),
        F.lit("1").alias("latitude"),
        F.lit("1").alias("longitude"),
        F.lit("PRES").alias("parameters"),
        F.format_string("2010010100%04d", F.col("id") % 60).alias("date_update"),
    )
    index = inventory.enrich_index(inventory.parse_index(entries))
    plan = inventory.fetch_plan(index).collect()
    assert len(plan) == index.select("wmoid").distinct().count()
    # Second 59 belongs to rows whose number ends in 9, which are not the hot platform's.
    assert next(r for r in plan if r.wmoid == 7).latest_update.second == 58


def test_hot_file_among_the_profiles(spark):
    table = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("f"), F.col("id") % 100)).alias("input_file"),
        F.when(F.col("id").isin(0, 1), F.lit("bad")).alias("reject_reason"),
        "id",
    )
    for threshold in ("32m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        sound, unsound = profiles.split_rejects(table, "input_file")
        n_bad = table.where("input_file in ('hot', 'f1')").count()
        assert (sound.count(), unsound.count()) == (ROWS - n_bad, n_bad)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")


def test_hot_file_among_the_index_entries(spark):
    entries = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("file"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("date_update"),
        F.col("id").alias("version"),
    )
    newest = latest.newest_entries(entries)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan[plan.rindex("Exchange hashpartitioning(file") :]
    got = {r.file: r.version for r in newest.where("file = 'hot' or file = '1'").collect()}
    assert got == {"hot": ROWS - 2, "1": 1}
    assert newest.count() == entries.select("file").distinct().count()
