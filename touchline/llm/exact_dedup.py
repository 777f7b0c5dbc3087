"""Exact duplicates by distributed radix partitioning, most significant digit first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIRST_DIGIT = 64


def normalised(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def duplicate_groups(
    docs: DataFrame, carry: Sequence[Column], id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``carry`` of every row with keep_id, group_size and kept: of equal texts the largest id stays.

    The first digit is the byte length with the first 64 bytes; every later one is the next bytes,
    four times as many as before. A round counts the rows of each digit below its group, with the
    rows of a task combined before the shuffle. Groups of one row are done, and so are groups whose
    texts have ended: equal digits all along are equal texts, without a digest. Only the rest goes
    to the next round, through a table in the shared folder. So the first round moves each text once,
    the others only what repeats. Groups are joined back to their rows by a join that Spark may
    split where one group is large. The number of rounds follows the logarithm of the longest
    repeated text.

    Null and empty texts are equal. A null id is below all others. Rows that repeat an id count each,
    and one of them is kept where it is their group's largest. An empty table gives no rows; other
    columns, whatever their names, play no part.
    """
    spark = docs.sparkSession
    whole = normalised(F.col(f"`{text_column}`")).cast("binary")
    state = docs.select(
        F.struct(*carry).alias("carry"), F.col(f"`{id_column}`").alias("id"), F.monotonically_increasing_id().alias("tie"),
        F.lit(0).cast("long").alias("above"), whole.alias("rest"),
    ).withColumn("size", F.octet_length("rest"))
    keys, done, past, width = ["above", "size", "digit"], [], 0, FIRST_DIGIT
    while True:
        # ``rest`` begins behind the digits that have been compared
        state = state.withColumn("digit", F.substring("rest", 1, width))
        groups = state.groupBy(*keys).agg(
            F.max(F.struct("id", "tie")).alias("best"), F.count(F.lit(1)).alias("group_size")
        ).filter("group_size > 1").select(F.struct(*keys).alias("key"), "best", "group_size")
        # joined by the whole key and not by its fields, so both sides are shuffled for the join, which
        # then may be split where a group is large; on the fields it would run inside the aggregate's tasks
        past += width
        open_ = F.col("best").isNotNull() & (F.col("size") > past)
        joined = state.withColumn("key", F.struct(*keys)).join(groups, "key", "left").select(
            "carry", "id", "tie", "size", F.coalesce("best.tie", "tie").alias("above"),
            F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).alias("group_size"), open_.alias("open"),
            F.when(open_, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        )
        path = scratch_path(spark, "radix")
        joined.write.partitionBy("open").parquet(path)
        back = spark.read.schema(joined.schema).parquet(path)
        done.append(back.filter("not open"))
        state = back.filter("open").select("carry", "id", "tie", "above", "rest", "size")
        if not state.take(1):
            break
        width *= 4
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("carry.*", "keep_id", "group_size", (F.col("tie") == F.col("above")).alias("kept"))


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, as they are: of equal texts the one with the largest id."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return duplicate_groups(docs, [row], id_column, text_column).filter("kept").select("row.*")
