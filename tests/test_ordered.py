"""Cut groups must give what plain windows give."""

import random

import pytest
from pyspark.sql import functions as F

from checks.compare import difference
from touchline.operators.ordered import (
    GroupLayout, cumulative, diff_neighbour, first_per, lead_by, measure_layout, rolling, row_numbers, windowed,
)

SCHEMA = "team int, day int, id bigint, x int, v double"


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows in one team, small and tiny teams, ties, nulls and null keys."""
    r = random.Random(7)
    data = []
    for i in range(3000):
        team = 1 if i % 3 == 0 else None if i % 50 == 1 else r.randint(2, 60)
        day = None if i % 97 == 0 else r.randint(1, 40)
        data.append((team, day, i, None if i % 11 == 0 else r.randint(0, 9), r.random()))
    return spark.createDataFrame(data, SCHEMA).cache()


def both(rows, keys, order, operation, limit=25):
    cut = measure_layout(rows, keys, order, limit)
    assert cut.bounds is not None
    plain = GroupLayout(tuple(keys), tuple(order))
    found = difference(operation(rows, cut).toPandas(), operation(rows, plain).toPandas())
    assert found is None, found


@pytest.mark.parametrize("limit", [1, 3, 25, 400])
def test_rolling(rows, limit):
    both(rows, ["team"], ["day", "id"],
         lambda df, lay: rolling(df, lay, 5, means={"m": "x"}, maxima={"top": "x"}), limit)


@pytest.mark.parametrize("limit", [1, 25])
def test_lead(rows, limit):
    both(rows, ["team"], ["day", "id"], lambda df, lay: lead_by(df, lay, "id", "next_id"), limit)


def test_descending_order(rows):
    both(rows, ["team"], ["-day", "-id"], lambda df, lay: lead_by(df, lay, "id", "next_id"))
    both(rows, ["team"], ["-x", "id"], lambda df, lay: row_numbers(df, lay, "rank"))
    both(rows, ["team"], ["-v", "id"], lambda df, lay: row_numbers(df, lay, "rank"))


def test_running_total_and_number(rows):
    both(rows, ["team"], ["day", "id"], lambda df, lay: cumulative(df, lay, {"total": "x", "twice": F.col("x") * 2}))
    both(rows, ["team"], ["day", "id"], lambda df, lay: row_numbers(df, lay, "n"))


def test_neighbour_difference(rows):
    both(rows, ["team"], ["day", "id"],
         lambda df, lay: diff_neighbour(df, lay, {"prev": ("x", -1), "next": ("x", 1), "far": ("x", 3)}))


def test_one_global_group(rows):
    both(rows, [], ["day", "id"], lambda df, lay: row_numbers(df, lay, "n"), limit=200)


def test_text_order(rows):
    named = rows.withColumn("name", F.concat(F.lit("n"), F.col("id")))
    both(named, ["team"], ["name"], lambda df, lay: lead_by(df, lay, "id", "next_id"))
    both(named, ["team"], ["-name"], lambda df, lay: row_numbers(df, lay, "n"))


def test_layout_serves_a_subset(rows):
    cut = measure_layout(rows, ["team"], ["day", "id"], 25)
    some = rows.filter(F.col("x") > 4)
    plain = GroupLayout(("team",), ("day", "id"))
    found = difference(lead_by(some, cut, "id", "n").toPandas(), lead_by(some, plain, "id", "n").toPandas())
    assert found is None


def test_within_narrows_the_group(rows):
    def mean(w):
        return [F.avg("x").over(w.rowsBetween(-2, 0)).alias("m")]

    both(rows, ["team"], ["day", "id"], lambda df, lay: windowed(df, lay, mean, before=2, within=["day"]))


def test_blocks_are_even(rows):
    cut = measure_layout(rows, ["team"], ["day", "id"], 100)
    sizes = cut.place(rows).filter("team = 1").groupBy("__block").count().toPandas()["count"]
    assert len(sizes) >= 9 and sizes.max() <= 250


def test_small_groups_need_no_cut(rows):
    assert measure_layout(rows, ["team"], ["day", "id"], 10_000).bounds is None


def test_first_per_group_is_limited_before_the_shuffle(rows, capsys):
    first = first_per(rows, ["team"], ["-day", "id"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert first.count() == rows.select("team").distinct().count()


@pytest.mark.parametrize("limit", [1, 7, 10_000])
def test_the_limit_changes_no_bit(spark, rows, limit):
    """NaN, repeated keys, nulls, text and times without zone, in both directions, and sums of doubles."""
    wide = rows.withColumn("v", F.when(F.col("id") % 13 == 0, F.lit(float("nan"))).when(F.col("id") % 17 == 0, None).otherwise(F.col("v")))
    wide = wide.withColumns({
        "t": F.expr("timestamp_ntz'2023-11-05 00:30:00' + make_dt_interval(0, cast(id % 50 as int))"), "d": F.col("id") * 0.1,
        "s": F.concat(F.lit("k"), F.col("id") % 40),
    })
    for order in (["v", "id"], ["-v", "id"], ["-s", "-id"], ["t", "-id"], ["-t", "s", "id"], ["x", "id"]):
        lay, plain = measure_layout(wide, ["team"], order, limit), GroupLayout(("team",), tuple(order))
        assert (lay.bounds is None) == (limit == 10_000)
        got, want = (row_numbers(cumulative(wide, one, {"sum": "d"}), one, "n").select("id", "sum", "n") for one in (lay, plain))
        assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_a_frequent_key_is_cut_around(spark):
    """Three key values hold most rows; the cuts fall between them and no list of equal keys is collected."""
    rows = spark.range(6000).select(F.lit(1).alias("team"), (F.col("id") % 3).alias("k"), "id")
    cut = measure_layout(rows, ["team"], ["k"], 1000)
    assert cut.bounds is not None and cut.blocks == 3
    assert {r["count"] for r in cut.place(rows).groupBy("__block").count().collect()} == {2000}


def test_block_tables_may_be_joined_by_shuffle(rows, monkeypatch):
    from touchline.operators import ordered

    monkeypatch.setattr(ordered, "MAX_BROADCAST_BLOCKS", 0)
    both(rows, ["team"], ["day", "id"], lambda df, lay: cumulative(df, lay, {"total": "x"}))
