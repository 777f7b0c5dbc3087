"""Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: An offset behind a time of day: sign, hours, minutes.
OFFSET = r"\d:\d\d(?::\d\d(?:\.\d+)?)?\s*([+-])(\d\d):?(\d\d)?$"


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.when(condition, 1).otherwise(0)


def utc_timestamp(text: Column) -> Column:
    """ISO text to the UTC wall-clock time, whatever the session time zone.

    The time is read as it is written and moved by the written offset; Z or no offset is UTC.
    """
    part = [F.regexp_extract(text, OFFSET, k) for k in (1, 2, 3)]
    minutes = F.when(part[1] == "", 0).otherwise(part[1].cast("int") * 60 + F.when(part[2] == "", 0).otherwise(part[2].cast("int")))
    ahead = F.make_dt_interval(mins=F.when(part[0] == "-", -minutes).otherwise(minutes))
    return text.cast("timestamp_ntz") - ahead


def two_digit_year(moment: Column) -> Column:
    return F.date_format(moment, "yy").cast("int")


def safe_rate(value: Column, minutes: Column, per: float = 60.0) -> Column:
    """``value`` per ``per`` minutes; 0 without playing time."""
    return F.when(minutes > 0, value / minutes * per).otherwise(0.0)


def share(part: Column, whole: Column) -> Column:
    """``part / whole``; null (never NaN) when the whole is 0."""
    return F.try_divide(part, whole)


def half_even(value: Column, digits: int = 2) -> Column:
    """Round half to even on the scaled binary value."""
    return F.rint(value * 10.0**digits) / 10.0**digits


def bin_index(value: Column, edges: Column) -> Column:
    """Index of the right-closed bin between sorted edges; the lowest edge belongs to bin 1."""
    below = F.size(F.filter(edges, lambda e: e < value))
    return F.when(value.isNotNull(), F.greatest(F.lit(1), below))


def case_map(column: Column, mapping: Mapping, default) -> Column:
    """Value per key, ``default`` for every other key and for null."""
    result = F
    for key, value in mapping.items():
        result = result.when(column == key, value)
    return result.otherwise(default)


def interactions(df: DataFrame, columns: list[str], with_column: str, prefix: str, season_games: int = 38) -> DataFrame:
    """``(w * c) * (w / season_games)`` for every column ``c``."""
    w = F.col(with_column)
    return df.select("*", *[((w * F.col(c)) * (w / season_games)).alias(prefix + c) for c in columns])
