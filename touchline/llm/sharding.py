"""Shards as runs of a Hilbert curve through quantised metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import scratch_path

BITS = 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of points given by one row of ``bits``-bit cells per dimension.

    The curve enters a cube's halves one dimension at a time: going down bit by bit, a set bit in a
    dimension turns the order of the first dimension around, a clear one swaps the two. What is
    left is a Gray code, whose rank is the index.
    """
    x = cells.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for d in range(dims):
            turned = (x[d] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[d]) & below)
            x[0] = np.where(turned, x[0] ^ below, x[0] ^ swap)
            x[d] = x[d] ^ swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[-1] & (1 << level)) != 0, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((x[d] >> level) & 1)
    return index


def sortable(column: Column, kind: str) -> Column:
    """A number that orders like the column: text by its first six bytes, anything else as a double."""
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return column.cast("double")


def with_curve(docs: DataFrame, dims: Sequence[str], bits: int = BITS, name: str = "curve") -> DataFrame:
    """``docs`` with the position of each row on the Hilbert curve through the columns ``dims``.

    A dimension is cut at its approximate quantiles over all rows into at most 2^bits cells, so every
    cell of it holds about as many rows, whatever the distribution. Nulls lie in the first cell. A
    column called ``name`` is replaced. An empty table gives no rows.
    """
    if len(dims) * bits > 62:
        raise ValueError("the index must fit 62 bits")
    kinds = dict(docs.dtypes)
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    values = [sortable(F.col(f"`{d}`"), kinds[d]) for d in dims]
    row = docs.select(*(F.percentile_approx(v, shares, 10_000).alias(f"q{i}") for i, v in enumerate(values))).first()
    edges = [sorted(set(q or [])) for q in row]

    @F.pandas_udf(T.LongType())
    def index(frame: pd.DataFrame) -> pd.Series:
        cells = []
        for i, cut in enumerate(edges):
            v = frame.iloc[:, i].to_numpy(np.float64, na_value=np.nan)
            cells.append(np.where(np.isnan(v), 0, np.searchsorted(np.array(cut, np.float64), v, side="left")))
        return pd.Series(hilbert_index(np.array(cells), bits))

    return docs.withColumn(name, index(F.struct(*(v.alias(f"v{i}") for i, v in enumerate(values)))))


def assign_shards(
    docs: DataFrame, dims: Sequence[str], shards: int = 8, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and curve of every row; counts differ by one at most.

    Rows are ordered by curve index, then id, then checksum, and the order is cut into ``shards`` runs of equal
    counts (law ``rows``), so a shard covers a compact part of every dimension. size is the text's
    UTF-8 bytes plus one; null text has none. The order is a range-partitioned sort of these narrow
    columns, without the texts; a place is the row's number in its part plus the parts before. The sorted
    rows are written to the shared folder once, and only the counts of the parts, one for each task, come
    to the driver. Rows equal in all columns take neighbouring slots in any order. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit("")).cast("binary")
    kinds = dict(docs.dtypes)
    narrow = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *((F.octet_length(text) + 1).cast("long").alias(f"dim{i}") if d == text_column else
          F.col(f"`{d}`").cast(kinds[d]).alias(f"dim{i}") for i, d in enumerate(dims)),
    )
    curved = with_curve(narrow, [f"dim{i}" for i in range(len(dims))]).select("doc_id", "size", "text_crc32", "curve")
    schema = T.StructType([*curved.schema.fields, T.StructField("part", T.LongType()), T.StructField("place", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            columns = [*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(np.arange(before, before + n, dtype=np.int64))]
            before += n
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    order = ["curve", "doc_id", "text_crc32"]
    path = scratch_path(spark, "curve")
    curved.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema).write.parquet(path)
    placed = spark.read.schema(schema).parquet(path)
    total, base = 0, []
    for part, n in sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()):
        base.append((part, total))
        total += n
    bases = spark.createDataFrame(base, "part long, base long")
    rank = F.col("base") + F.col("place")
    ranked = placed.join(F.broadcast(bases), "part").withColumn("rank", rank)
    ranked = ranked.withColumn("shard", F.expr(f"cast((rank * {shards}) div {max(total, 1)} as int)"))
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def write_by_curve(docs: DataFrame, path: str, dims: Sequence[str], files: int, id_column: str = "doc_id") -> None:
    """Write whole rows as ``files`` Parquet files in curve order, for readers that skip files by min and max."""
    name = "curve__"
    ordered = with_curve(docs, dims, name=name).repartitionByRange(files, name, id_column)
    ordered.sortWithinPartitions(name, id_column).drop(name).write.parquet(path)
