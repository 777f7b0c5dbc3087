"""Drivers: refresh every keyed table from landed files, and build the feature table from the snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.plans.features import feature_table
from touchline.plans.refresh import KEYS, PREVIOUS_SEASONS, refresh, season_range
from touchline.sources.seasons import load_seasons
from touchline.sources.snapshots import read_snapshot, write_snapshot

#: Tables whose rows belong to a season and have an archive; the others hold what is current.
SEASONAL = ("games", "player_details", "player_info", "rounds")


def seasons_of(games: DataFrame, previous: int = PREVIOUS_SEASONS) -> tuple[int, list[int]]:
    """The current season and those before it, from the current fixtures."""
    row = season_range(games, previous).first()
    if row.current_season is None:
        raise ValueError("no fixture has a kickoff")
    return row.current_season, list(row.previous_seasons)


def refresh_table(
    spark: SparkSession,
    root: str,
    table: str,
    current: DataFrame,
    season: int | None = None,
    previous_seasons: Sequence[int] = (),
    archive: Callable[[int], DataFrame] | None = None,
    order: Sequence[str] = (),
) -> int:
    """Write a table's next snapshot: the rows of the last one, below the archived and current ones of the same key.

    With a ``season`` the current rows are tagged with it and the archived seasons are added; one without files is
    skipped. Of the games of the last snapshot only finished ones survive by themselves.
    """
    if season is not None:
        current = load_seasons(current, season, archive, previous_seasons if archive else ())
    keep = F.col("finished") if table == "games" else None
    merged = refresh(read_snapshot(spark, root, table), current, KEYS[table], keep, order)
    return write_snapshot(merged, root, table)


def land_all(
    spark: SparkSession,
    root: str,
    current: dict[str, DataFrame],
    archives: dict[str, Callable[[int], DataFrame]] | None = None,
    previous: int = PREVIOUS_SEASONS,
) -> dict[str, int]:
    """Refresh all tables that are given; the fixtures tell the season. Returns the new version of each."""
    archives = archives or {}
    season, earlier = seasons_of(current["games"], previous)
    return {
        table: refresh_table(spark, root, table, rows, season, earlier, archives.get(table)) if table in SEASONAL
        else refresh_table(spark, root, table, rows)
        for table, rows in current.items()
    }


def build_data(spark: SparkSession, root: str, n: int = 5) -> int:
    """Build the feature table from the newest snapshots and write it as the next version of ``data``."""
    parts = {t: read_snapshot(spark, root, t) for t in ("games", "player_details", "player_info")}
    missing = [t for t, rows in parts.items() if rows is None]
    if missing:
        raise ValueError(f"no snapshot of {', '.join(missing)}")
    return write_snapshot(feature_table(parts["games"], parts["player_details"], parts["player_info"], n), root, "data")
