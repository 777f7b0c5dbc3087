"""Windows over ordered groups that stay parallel when one group is huge.

A plain window puts a whole group into one task. Here a :class:`GroupLayout` first measures the
groups. When none exceeds ``rows_per_block`` the plain window is used: one shuffle, nothing else.
Otherwise the large groups are cut along their sort order into blocks of about that size, the
window runs per (group, block), and what a block needs from its neighbours is added exactly:

* bounded frames (rolling, lead, lag) borrow the few rows next to the block's edges;
* running totals add the sum of the earlier blocks.

The block of a row depends only on its group and sort key, so one layout serves every table that
has the same groups and order, also subsets of the measured rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BLOCK_CONF = "spark.touchline.rowsPerBlock"
DEFAULT_ROWS_PER_BLOCK = 4_000_000
SAMPLES_PER_BLOCK = 64
#: Rows of a block table that may be broadcast; beyond, it is joined by shuffle. The rows are counted first.
MAX_BROADCAST_BLOCKS = 500_000
EXACT_DIGITS = 12

BLOCK, BORROWED, EDGE = "__block", "__borrowed", "__edge"


def sort_columns(order: Sequence[str], reverse: bool = False) -> list[Column]:
    """Sort expressions for names; a leading ``-`` means descending. Nulls come last."""
    columns = []
    for item in order:
        descending = item.startswith("-")
        column = F.col(item.lstrip("-"))
        if not reverse:
            columns.append(column.desc_nulls_last() if descending else column.asc_nulls_last())
        else:
            columns.append(column.asc_nulls_first() if descending else column.desc_nulls_first())
    return columns


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of key pairs."""
    return reduce(lambda a, b: a & b, (left[a].eqNullSafe(right[b]) for a, b in pairs), F.lit(True))


def _comes_before(left: Mapping[str, Column], right: Mapping[str, Column], order: Sequence[str]) -> Column:
    """Whether one row's order values come before another's, by the rules of :func:`sort_columns`.

    Field by field with the columns' own comparison, so text, NaN and times without zone compare as they sort.
    """
    before = F.lit(False)
    for item in reversed(order):
        name = item.lstrip("-")
        a, b = left[name], right[name]
        own = a > b if item.startswith("-") else a < b
        before = (
            F.when(a.isNull() & b.isNull(), before).when(a.isNull(), False).when(b.isNull(), True)
            .when(a == b, before).otherwise(own)
        )
    return before


def _names(order: Sequence[str]) -> list[str]:
    return [item.lstrip("-") for item in order]


def _blocks_before(cuts: Column, order: Sequence[str], longest: int) -> Column:
    """How many sorted cuts the row has reached, by halving steps; a cut is the first key of a block."""
    steps = [1 << i for i in reversed(range(longest.bit_length()))]
    row = {n: F.col(n) for n in _names(order)}

    def advance(found: Column, step: Column) -> Column:
        ahead = found + step
        cut = F.get(cuts, ahead - 1)
        reached = ~_comes_before(row, {n: cut[f"v{i}"] for i, n in enumerate(_names(order))}, order)
        return F.when((ahead <= F.size(cuts)) & reached, ahead).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


@dataclass(frozen=True)
class GroupLayout:
    """Groups, their total order, and where large groups are cut (``bounds``; None = nowhere)."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    bounds: DataFrame | None = None
    longest: int = 0
    blocks: int = 0

    def window(self, extra: Sequence[str] = ()) -> WindowSpec:
        split = [] if self.bounds is None else [BLOCK]
        return Window.partitionBy(*self.keys, *split, *extra).orderBy(*sort_columns(self.order))

    def place(self, df: DataFrame) -> DataFrame:
        """Add the block number; null for groups that are not cut."""
        bounds = self.bounds.select(
            *[F.col(k).alias(f"__{k}") for k in self.keys], F.col("cuts").alias("__cuts")
        )
        placed = df.join(
            self._small(bounds), same_keys(df, bounds, [(k, f"__{k}") for k in self.keys]), "left"
        )
        block = F.when(F.col("__cuts").isNotNull(), _blocks_before(F.col("__cuts"), self.order, self.longest))
        return placed.select(*[df[c] for c in df.columns], block.alias(BLOCK))

    def _small(self, df: DataFrame) -> DataFrame:
        """Broadcast per-block tables while the counted number of blocks allows it."""
        return F.broadcast(df) if self.blocks <= MAX_BROADCAST_BLOCKS else df


def rows_per_block_setting(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_PER_BLOCK_CONF, str(DEFAULT_ROWS_PER_BLOCK)))


def measure_layout(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_block: int | None = None
) -> GroupLayout:
    """Count the groups and choose cuts for those above ``rows_per_block`` rows.

    Runs one aggregation over the key columns. At most ``rows / rows_per_block`` groups come back
    to the driver, and as many cuts. For the cuts, the distinct order keys of the large groups are
    counted; a key enters a sample with a chance in proportion to its rows, and surely if it has as many
    as one entry stands for. So a frequent key is neither missed nor taken with all its rows, and the sample
    has about SAMPLES_PER_BLOCK entries for each block. It decides only how even the blocks are,
    never which rows are used. Rows with equal order keys share a block: a unique order bounds it.
    """
    keys, order = tuple(keys), tuple(order)
    limit = rows_per_block or rows_per_block_setting(df)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > limit)
    large = sizes.collect()
    if not large:
        return GroupLayout(keys, order)

    spark = df.sparkSession
    hot = spark.createDataFrame(large, sizes.schema).select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.ceil(F.col("rows") / limit).cast("int").alias("__parts"),
        F.greatest(F.lit(1), F.floor(F.col("rows") / (F.ceil(F.col("rows") / limit) * SAMPLES_PER_BLOCK)))
        .cast("bigint").alias("__every"),
    )
    hot = F.broadcast(hot) if len(large) <= MAX_BROADCAST_BLOCKS else hot
    names = _names(order)
    values = [F.col(n).alias(f"v{i}") for i, n in enumerate(names)]
    owners = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    counted = (
        df.join(hot, same_keys(df, hot, [(k, f"__{k}") for k in keys]))
        .groupBy(*owners, "__parts", "__every", *values)
        .agg(F.count(F.lit(1)).alias("__rows"))
    )
    own, vs = [f"k{i}" for i in range(len(keys))], [f"v{i}" for i in range(len(names))]
    chance = F.pmod(F.xxhash64(*vs), F.col("__every"))
    sample = counted.filter(chance < F.col("__rows")).select(
        *own, *vs, "__parts", F.greatest("__rows", "__every").alias("__weight"))
    group = Window.partitionBy(*own)
    along = group.orderBy(*sort_columns([("-" if o.startswith("-") else "") + v for o, v in zip(order, vs, strict=True)]))
    before = F.sum("__weight").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__weight")
    part = F.floor(before * F.col("__parts") / F.sum("__weight").over(group))
    numbered = sample.select(*own, *vs, part.cast("int").alias("__part"))
    cut = numbered.withColumn("__last", F.lag("__part", 1, 0).over(along)).filter(F.col("__part") > F.col("__last"))
    cuts: dict[tuple, list] = {}
    for row in cut.orderBy(*own, "__part").collect():
        cuts.setdefault(tuple(row[k] for k in own), []).append(tuple(row[v] for v in vs))
    if not cuts:
        return GroupLayout(keys, order)
    schema = T.StructType([
        *[T.StructField(k, df.schema[k].dataType) for k in keys],
        T.StructField("cuts", T.ArrayType(T.StructType([T.StructField(v, df.schema[n].dataType) for v, n in zip(vs, names, strict=True)]))),
    ])
    return GroupLayout(
        keys,
        order,
        spark.createDataFrame([(*k, c) for k, c in cuts.items()], schema),
        max(map(len, cuts.values())),
        sum(len(c) + 1 for c in cuts.values()),
    )


def measure_within(
    df: DataFrame, outer: GroupLayout, keys: Sequence[str], order: Sequence[str], rows_per_block: int | None = None
) -> GroupLayout:
    """Layout of groups that lie inside the groups of ``outer``; measured only where those were cut."""
    if outer.bounds is None:
        return GroupLayout(tuple(keys), tuple(order))
    return measure_layout(df, keys, order, rows_per_block)


def _borrow(placed: DataFrame, layout: GroupLayout, count: int, later: bool) -> DataFrame:
    """For every block, the ``count`` rows of its group just before (or after) the block.

    Each block offers at most ``count`` edge rows, numbered from the edge inwards. Every block that
    exists has a row, so the ``count`` nearest blocks always hold enough of them.
    """
    names = [c for c in placed.columns if c != BLOCK]
    inward = Window.partitionBy(*layout.keys, BLOCK).orderBy(*sort_columns(layout.order, reverse=not later))
    offered = (
        placed.filter(F.col(BLOCK).isNotNull())
        .select("*", F.row_number().over(inward).alias(EDGE))
        .filter(F.col(EDGE) <= count)
        .groupBy(*layout.keys, BLOCK)
        .agg(F.collect_list(F.struct(EDGE, F.struct(*names).alias("row"))).alias("rows"))
        .select(
            *layout.keys, BLOCK,
            F.array_sort("rows", lambda a, b: a[EDGE] - b[EDGE]).alias("rows"),
        )
    )
    by_block = Window.partitionBy(*layout.keys).orderBy(BLOCK)
    if later:
        near = F.collect_list("rows").over(by_block.rowsBetween(1, count))
    else:
        near = F.reverse(F.collect_list("rows").over(by_block.rowsBetween(-count, -1)))
    return (
        offered.select(BLOCK, F.slice(F.flatten(near), 1, count).alias("near"))
        .select(BLOCK, F.explode("near").alias("edge"))
        .select("edge.row.*", BLOCK)
    )


def windowed(
    df: DataFrame,
    layout: GroupLayout,
    columns: Callable[[WindowSpec], Sequence[Column]],
    before: int = 0,
    after: int = 0,
    within: Sequence[str] = (),
) -> DataFrame:
    """Add window columns whose frames reach at most ``before``/``after`` rows from the row.

    ``columns`` gets the window to build on. ``within`` narrows the groups by further columns that
    lead the order; it is for a second set of functions on the same shuffle and sort.
    """
    return windowed_many(df, layout, [(within, columns)], before, after)


def windowed_many(
    df: DataFrame,
    layout: GroupLayout,
    sets: Sequence[tuple[Sequence[str], Callable[[WindowSpec], Sequence[Column]]]],
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """:func:`windowed` for several (``within``, ``columns``) sets on one placement."""
    if layout.bounds is None:
        rows = df
    else:
        placed = layout.place(df)
        rows = placed.withColumn(BORROWED, F.lit(False))
        for count, later in ((before, False), (after, True)):
            if count:
                borrowed = _borrow(placed, layout, count, later)
                rows = rows.unionByName(borrowed.withColumn(BORROWED, F.lit(True)))
    for within, columns in sets:
        rows = rows.select("*", *columns(layout.window(within)))
    if layout.bounds is not None:
        rows = rows.filter(~F.col(BORROWED)).drop(BORROWED, BLOCK)
    return rows


def lead_by(df: DataFrame, layout: GroupLayout, column: str, out: str) -> DataFrame:
    """Value of ``column`` in the next row of the group."""
    return windowed(df, layout, lambda w: [F.lead(column).over(w).alias(out)], after=1)


def rolling(
    df: DataFrame,
    layout: GroupLayout,
    rows: int,
    means: Mapping[str, str] | None = None,
    maxima: Mapping[str, str] | None = None,
) -> DataFrame:
    """Mean and maximum over the last ``rows`` rows, the current one included; nulls are skipped.

    ``means`` and ``maxima`` map output names to columns. All share one shuffle and one sort.
    """
    means, maxima = means or {}, maxima or {}

    def columns(w: WindowSpec) -> list[Column]:
        frame = w.rowsBetween(1 - rows, 0)
        return [F.avg(c).over(frame).alias(out) for out, c in means.items()] + [
            F.max(c).over(frame).alias(out) for out, c in maxima.items()
        ]

    return windowed(df, layout, columns, before=rows - 1)


def rolling_mean(df: DataFrame, layout: GroupLayout, columns: Sequence[str], rows: int, prefix: str) -> DataFrame:
    return rolling(df, layout, rows, means={prefix + c: c for c in columns})


def rolling_max(df: DataFrame, layout: GroupLayout, columns: Sequence[str], rows: int, prefix: str) -> DataFrame:
    return rolling(df, layout, rows, maxima={prefix + c: c for c in columns})


def diff_neighbour(df: DataFrame, layout: GroupLayout, columns: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Difference to a neighbour row: ``out -> (column, offset)``; -1 previous, 1 next; 0 at the edge."""
    reach = [offset for _, offset in columns.values()]

    def differences(w: WindowSpec) -> list[Column]:
        return [
            F.coalesce(F.col(c) - F.lead(c, offset).over(w), F.lit(0)).alias(out)
            for out, (c, offset) in columns.items()
        ]

    return windowed(df, layout, differences, before=max(0, -min(reach)), after=max(0, max(reach)))


def cumulative(df: DataFrame, layout: GroupLayout, sums: Mapping[str, str | Column]) -> DataFrame:
    """Running totals in group order, ``out -> column``.

    Sums of floating-point numbers depend on the order of adding, which cuts change. They are added
    as decimals with EXACT_DIGITS digits behind the point, below 10^26, so any order gives the same.
    """
    values = {out: F.col(c) if isinstance(c, str) else c for out, c in sums.items()}
    kinds = dict(df.select(*[v.alias(out) for out, v in values.items()]).dtypes)
    floating = [out for out, kind in kinds.items() if kind in ("double", "float")]
    if floating:
        exact = {out: v.cast(f"decimal(38,{EXACT_DIGITS})") if out in floating else v for out, v in values.items()}
        summed = cumulative(df, layout, exact)
        return summed.select(*[F.col(c).cast("double").alias(c) if c in floating else F.col(c) for c in summed.columns])
    running = layout.window().rowsBetween(Window.unboundedPreceding, 0)
    totals = {out: F.sum(v).over(running) for out, v in values.items()}
    if layout.bounds is None:
        return df.select("*", *[t.alias(out) for out, t in totals.items()])

    placed = layout.place(df)
    earlier = Window.partitionBy(*layout.keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.filter(F.col(BLOCK).isNotNull())
        .groupBy(*layout.keys, BLOCK)
        .agg(*[F.sum(v).alias(out) for out, v in values.items()])
        .select(
            *[F.col(k).alias(f"__{k}") for k in layout.keys],
            F.col(BLOCK).alias("__at"),
            *[F.sum(out).over(earlier).alias(f"__{out}") for out in values],
        )
    )
    pairs = [(k, f"__{k}") for k in layout.keys] + [(BLOCK, "__at")]
    inside = placed.select("*", *[t.alias(out) for out, t in totals.items()])
    joined = inside.join(layout._small(offsets), same_keys(inside, offsets, pairs), "left")
    return joined.select(
        *df.columns,
        # Either part is null while it has seen only nulls.
        *[F.coalesce(F.col(out) + F.col(f"__{out}"), out, f"__{out}").alias(out) for out in values],
    )


def row_numbers(df: DataFrame, layout: GroupLayout, out: str) -> DataFrame:
    """Running row number, starting at 1 (also: rank where ties go by the later order columns)."""
    return cumulative(df, layout, {out: F.lit(1).cast("bigint")}).withColumn(out, F.col(out).cast("int"))


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group in the given order.

    Spark limits each group to one row before the shuffle, so a huge group costs no more than others.
    """
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.select("*", F.row_number().over(w).alias(EDGE)).filter(F.col(EDGE) == 1).drop(EDGE)
