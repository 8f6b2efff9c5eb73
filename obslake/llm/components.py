"""Connected components of a table of links, by alternating star contractions.

Each round hangs the larger neighbours of every node on the least one (large star), then the
smaller ones (small star), until the links are stars round each component's least node
(Kiveris and others, SoCC 2014). A node's neighbours are never gathered: the least one is an
aggregate that combines before the shuffle, and the join back can be split where a node has
very many. A path of n nodes takes about log n rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.scratch import forget, stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` has u > v. The smaller neighbours of u and u itself go to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has a link; the component is its least node."""
    ordered = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current = stored(ordered, "links")
    mark = _mark(current)
    while mark[0]:
        last, current = current, stored(_small_star(_large_star(current)), "links")
        forget(last)
        before, mark = mark, _mark(current)
        if mark == before:
            break
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)
