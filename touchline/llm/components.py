"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import scratch_path


def _with_least(edges: DataFrame) -> DataFrame:
    """Every edge u, v with m, the least neighbour of u; joined by a struct so that a large u may be split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.struct("u").alias("key"), "m")
    return edges.withColumn("key", F.struct("u")).join(least, "key").select("u", "v", "m")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (the least node reachable) of every node that has a link.

    Links may repeat and have any direction; a node linked to itself only, or to null, has no row.
    In each round every node hands its larger neighbours to its least neighbour, then its smaller
    ones; paths shrink to stars in a number of rounds that grows with the logarithm of the nodes. A round's edges are
    written to the shared folder, which cuts the lineage; only their number and a checksum come to the driver.
    """
    spark = links.sparkSession
    one, two = F.col(a), F.col(b)
    edges = links.filter(one != two).select(F.greatest(one, two).alias("u"), F.least(one, two).alias("v")).distinct()
    before = None
    while True:
        path = scratch_path(spark, "edges")
        edges.write.parquet(path)
        edges = spark.read.schema(edges.schema).parquet(path)
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("sum")).first()
        if state == before or not state.n:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = _with_least(large)
        edges = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = edges.select("e.*").filter("u > v").distinct()
