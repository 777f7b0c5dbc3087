"""Projections, filters, joins and grouped aggregates with column names as parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.ordered import first_per

#: Longer lists are joined instead of written into the filter; a filter of a few is pushed to the scan.
MAX_LITERAL_LIST = 1_000


def add_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def filter_in(df: DataFrame, column: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose value is in a list, or in the first column of a table; long lists and tables become a semi join."""
    if isinstance(values, DataFrame):
        kind = df.schema[column].dataType
        return df.join(values.select(F.col(f"`{values.columns[0]}`").cast(kind).alias(column)), column, "left_semi")
    if len(values) <= MAX_LITERAL_LIST:
        return df.filter(F.col(column).isin(list(values)))
    schema = T.StructType([T.StructField(column, df.schema[column].dataType)])
    wanted = df.sparkSession.createDataFrame([(v,) for v in values], schema)
    return df.join(wanted, column, "left_semi")


def cols_like(
    df: DataFrame,
    any_of: Sequence[str] = (),
    none_of: Sequence[str] = (),
    dtype: type[T.DataType] | None = None,
) -> list[str]:
    """Names that contain one of the terms, none of the others, and have the given type."""
    return [
        f.name
        for f in df.schema
        if (not any_of or any(t in f.name for t in any_of))
        and not any(t in f.name for t in none_of)
        and (dtype is None or isinstance(f.dataType, dtype))
    ]


def block_diff(df: DataFrame, left: Sequence[str], right: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Append ``left[i] - right[i]`` as ``names[i]``."""
    return df.select(
        "*", *[(F.col(a) - F.col(b)).alias(n) for a, b, n in zip(left, right, names, strict=True)]
    )


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the dimension's value for ``key``, null when the key is unknown.

    Spark broadcasts the dimension when its size allows and shuffles otherwise.
    """
    d = dim.select(F.col(dim_key).alias("__key"), F.col(value).alias("__value"))
    return df.join(d, df[key] == d["__key"], "left").select(
        *[df[c] for c in df.columns if c != out], d["__value"].alias(out)
    )


def join_on(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "inner"
) -> DataFrame:
    """Equi join on differently named keys; the right keys are dropped."""
    marked = right.select(
        *[F.col(r).alias(f"__{r}") for _, r in pairs],
        *[F.col(c) for c in right.columns if c not in {r for _, r in pairs}],
    )
    condition = reduce(lambda a, b: a & b, (left[a] == marked[f"__{r}"] for a, r in pairs))
    return left.join(marked, condition, how).drop(*[f"__{r}" for _, r in pairs])


def join_where_dealt(
    left: DataFrame, right: DataFrame, dealt: tuple[str, str], pairs: Sequence[tuple[str, str]], how: str = "inner"
) -> DataFrame:
    """:func:`join_on` for rows that lie by the key pair ``dealt`` already, as after an earlier join on it.

    Spark leaves rows where they are only if they were dealt by all keys of a join. So ``dealt`` is its one key,
    and the other pairs are compared as a range of one value. For keys under which few rows meet.
    """
    marked = right.select(
        *[F.col(r).alias(f"__{r}") for _, r in (dealt, *pairs)],
        *[F.col(c) for c in right.columns if c not in {r for _, r in (dealt, *pairs)}],
    )
    same = [(left[a] <= marked[f"__{r}"]) & (left[a] >= marked[f"__{r}"]) for a, r in pairs]
    condition = reduce(lambda a, b: a & b, same, left[dealt[0]] == marked[f"__{dealt[1]}"])
    return left.join(marked, condition, how).drop(*[f"__{r}" for _, r in (dealt, *pairs)])


def semi_join(df: DataFrame, ids: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(ids, on, "left_semi")


def with_group_agg(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], together: bool = False) -> DataFrame:
    """Put group aggregates on every row; null keys form a group.

    The aggregate is combined before its shuffle and joined back by the keys as one struct: both sides
    are then shuffled for the join, and the adaptive skew join can divide a large group among tasks.
    ``together`` is for small groups whose rows were dealt by some of the keys: a window adds the values where the rows are.
    """
    if together:
        group = Window.partitionBy(*keys)
        return df.select("*", *[a.over(group).alias(out) for out, a in aggregates.items()])
    groups = df.groupBy(*keys).agg(*[a.alias(out) for out, a in aggregates.items()])
    if not keys:
        return df.crossJoin(F.broadcast(groups))  # a single row
    groups = groups.select(F.struct(*keys).alias("__key"), *aggregates)
    joined = df.withColumn("__key", F.struct(*keys))
    return joined.join(groups, joined["__key"].eqNullSafe(groups["__key"]), "left").drop("__key")


def without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))


def group_max(df: DataFrame, keys: Sequence[str], columns: Sequence[str], prefix: str) -> DataFrame:
    """Maximum of each column per group; rows with a null key are left out."""
    return without_null_keys(df, keys).groupBy(*keys).agg(*[F.max(c).alias(prefix + c) for c in columns])


def group_max_if(
    df: DataFrame,
    keys: Sequence[str],
    blocks: Sequence[tuple[str, Column | None, Sequence[str]]],
) -> DataFrame:
    """Several conditional maxima in one aggregation: ``(prefix, condition, columns)`` per block."""
    aggregates = [
        F.max(F.col(c) if condition is None else F.when(condition, F.col(c))).alias(prefix + c)
        for prefix, condition, columns in blocks
        for c in columns
    ]
    return without_null_keys(df, keys).groupBy(*keys).agg(*aggregates)


def group_max_by(
    df: DataFrame, keys: Sequence[str], category: str, blocks: Sequence[tuple[str, str | None, Sequence[str]]]
) -> DataFrame:
    """Many maxima per category value: ``(prefix, value, columns)`` per block, None for all rows.

    For wide results. Each column is maximised once per (keys, value), a narrow aggregate that stays
    compiled; a second one puts the few rows of a key side by side. One aggregate with a conditional
    maximum per result column grows beyond what the JVM compiles and ran six times longer.
    """
    columns = list(dict.fromkeys(c for _, _, block in blocks for c in block))
    values = list(dict.fromkeys(v for _, v, _ in blocks if v is not None))
    label = F.when(F.col(category).isin(values), F.col(category)).alias("__label")
    by_value = without_null_keys(df, keys).groupBy(*keys, label).agg(*[F.max(c).alias(c) for c in columns])

    row = F.struct(*columns)
    sides = {v: f"__{i}" for i, v in enumerate(values)}
    wide = by_value.groupBy(*keys).agg(
        *[F.max_by(row, F.when(F.col("__label") == v, 1)).alias(side) for v, side in sides.items()],
        F.max_by(row, F.when(F.col("__label").isNull(), 1)).alias("__rest"),
    )
    everyone = [*sides.values(), "__rest"]
    return wide.select(*keys, *[
        (F.greatest(*[F.col(f"{s}.{c}") for s in everyone]) if value is None else F.col(f"{sides[value]}.{c}"))
        .alias(prefix + c)
        for prefix, value, block in blocks
        for c in block
    ])


def attach_rank_values(
    df: DataFrame, by: Sequence[str], rank: str, value: str, ranks: Mapping[str, int]
) -> DataFrame:
    """Put the value held by given ranks of the group on every row, ``out -> rank``.

    Groups that lack one of the ranks are dropped. The rank holders are aggregated first and joined.
    """
    holders = (
        df.filter(F.col(rank).isin(sorted(set(ranks.values()))))
        .groupBy(*by)
        .agg(*[F.max(F.when(F.col(rank) == r, F.col(value))).alias(out) for out, r in ranks.items()])
        .dropna(subset=list(ranks))
    )
    return df.join(holders, list(by))


def dedup_last(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Keep the last row per key in version order; null keys equal each other."""
    flipped = [v[1:] if v.startswith("-") else f"-{v}" for v in version]
    return first_per(df, keys, flipped)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing in one input is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def long_form(df: DataFrame, columns: Sequence[str], kind: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """Every column value as a row: ``(keep..., feature_no, x)``; ``feature_no`` counts from 0.

    For aggregates over hundreds of columns. One array per row is exploded, which stays compact where
    an unpivot would plan one projection per column; grouping by number keeps the keys small.
    """
    values = F.array(*[F.col(c).cast(kind) for c in columns])
    return df.select(*keep, F.posexplode(values).alias("feature_no", "x"))


def with_names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace ``feature_no`` by the column name as ``feature``."""
    name = F.get(F.array(*[F.lit(c) for c in columns]), F.col("feature_no"))
    return df.select(name.alias("feature"), *[F.col(c) for c in df.columns if c != "feature_no"])


def n_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values per column, null counted as a value: ``(feature, n_values)``."""
    values = long_form(df, columns, "string").distinct()
    return with_names(values.groupBy("feature_no").agg(F.count(F.lit(1)).alias("n_values")), columns)


def top_k(df: DataFrame, by: str, k: int, tiebreak: str) -> DataFrame:
    """The k rows with the largest value; ties go by name."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tiebreak).asc_nulls_last()).limit(k)
