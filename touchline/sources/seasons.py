"""Archived seasons as CSV."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.scalar import utc_timestamp
from touchline.operators.relational import union_by_name

INDEX_COLUMNS = ("Unnamed: 0", "_c0")


def season_path(root: str, table: str, season: int) -> str:
    return f"{root.rstrip('/')}/{table}/season={season}"


def _typed(name: str, kind: T.DataType) -> Column:
    text = F.col(f"`{name}`")
    if isinstance(kind, T.IntegralType):
        # Whole numbers may be written as 3.0 where the column has gaps.
        return text.cast("decimal(38,6)").cast(kind)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return utc_timestamp(text).cast(kind)
    return text.cast(kind)


def _files_by_header(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """The files of a folder by their header line, and its names; one row per file comes to the driver."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header")).collect()
    groups: dict[str, list[str]] = {}
    for row in sorted(first, key=lambda r: r.file):
        groups.setdefault(row.header, []).append(row.file)
    return [(next(csv.reader([header.lstrip("\ufeff")])), files) for header, files in groups.items()]


def read_season_csv(
    spark: SparkSession, root: str, table: str, season: int, schema: T.StructType
) -> DataFrame:
    """One archived season, UTF-8 with header; columns are matched by name in every file.

    Columns of ``schema`` get its type, further ones stay text, the row-index column is dropped. Files with the
    same header are read together; a column that some files lack is null there.
    """
    types = {f.name: f.dataType for f in schema}
    parts = []
    for names, files in _files_by_header(spark, season_path(root, table, season)):
        names = [name or f"_c{i}" for i, name in enumerate(names)]
        text = T.StructType([T.StructField(name, T.StringType()) for name in names])
        raw = spark.read.schema(text).option("header", True).option("encoding", "UTF-8").csv(files)
        parts.append(raw.select([
            (_typed(c, types[c]) if c in types else F.col(f"`{c}`")).alias(c) for c in names if c not in INDEX_COLUMNS
        ]))
    if not parts:
        return spark.createDataFrame([], schema)
    return union_by_name(*parts)


def load_seasons(
    current: DataFrame, season: int, reader: Callable[[int], DataFrame], previous: Sequence[int]
) -> DataFrame:
    """The current season and the archived ones, each tagged with ``season_start_year``.

    A season without files is skipped; any other problem is an error.
    """
    frames = [current.withColumn("season_start_year", F.lit(int(season)))]
    for year in previous:
        try:
            archived = reader(year)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        frames.append(archived.drop(*INDEX_COLUMNS).withColumn("season_start_year", F.lit(int(year))))
    return union_by_name(*frames)
