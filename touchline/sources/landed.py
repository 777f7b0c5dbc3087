"""Readers for landed JSON documents.

A path may be one document, or a folder of them. ``multi_line=True`` reads documents as an API
delivers them (one per file); ``False`` reads JSON Lines, one document per line, which Spark can
split among tasks and is the form to land large data in.

Schemas are explicit. Pass a wider ``items`` schema to keep more of what a document holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.scalar import utc_timestamp
from touchline.operators.relational import filter_in, lookup
from touchline.sources.seasons import read_season_csv


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(), "BOOLEAN": T.BooleanType(),
}

#: Players that may be broadcast to their documents; beyond, documents are shuffled. They are counted first.
MAX_BROADCAST_PLAYERS = 500_000


def _ddl(text: str) -> T.StructType:
    """``name TYPE, ...`` as a schema, without needing a session."""
    return T.StructType([
        T.StructField(name, _TYPES[kind]) for name, kind in (part.split() for part in text.split(","))
    ])


TEAMS = _ddl("id BIGINT, short_name STRING, name STRING")
ELEMENTS = _ddl("id BIGINT, first_name STRING, second_name STRING, element_type INT")
EVENTS = _ddl("id INT, finished BOOLEAN, deadline_time STRING")
FIXTURES = _ddl(
    "event INT, id BIGINT, team_h BIGINT, team_a BIGINT, finished BOOLEAN, kickoff_time STRING,"
    "team_h_score INT, team_a_score INT"
)
HISTORY = _ddl(
    "element BIGINT, fixture BIGINT, kickoff_time STRING, was_home BOOLEAN, opponent_team BIGINT, minutes DOUBLE,"
    "goals_scored DOUBLE, assists DOUBLE, clean_sheets DOUBLE, goals_conceded DOUBLE, own_goals DOUBLE,"
    "penalties_saved DOUBLE, penalties_missed DOUBLE, saves DOUBLE, bonus DOUBLE, bps DOUBLE, influence DOUBLE,"
    "creativity DOUBLE, threat DOUBLE, ict_index DOUBLE, value DOUBLE, transfers_balance DOUBLE, selected DOUBLE"
)
HISTORY_PAST = _ddl("season_name STRING, element_code BIGINT")


def _read_items(
    spark: SparkSession, path: str, field: str, items: T.StructType, multi_line: bool
) -> DataFrame:
    schema = T.StructType([T.StructField(field, T.ArrayType(items))])
    return spark.read.schema(schema).option("multiLine", multi_line).json(path).select(F.inline(field))


def read_teams(spark: SparkSession, path: str, items: T.StructType = TEAMS, multi_line: bool = True) -> DataFrame:
    return _read_items(spark, path, "teams", items, multi_line)


# The columns of the games table.
GAMES = T.StructType([
    *_ddl("GW INT, id BIGINT, home STRING, team_h BIGINT, away STRING, team_a BIGINT, finished BOOLEAN"),
    T.StructField("kickoff", T.TimestampNTZType()), *_ddl("team_h_score INT, team_a_score INT"),
])


def read_fixtures(
    spark: SparkSession, path: str, teams: DataFrame | None = None, season: int | None = None, multi_line: bool = True
) -> DataFrame:
    """Fixtures with team names, or the games of an archived season below ``path``.

    A team id that is not in ``teams`` gets a null name; an archive holds the names itself.
    """
    if season is not None:
        return read_season_csv(spark, path, "games", season, GAMES)
    rows = spark.read.schema(FIXTURES).option("multiLine", multi_line).json(path)
    games = rows.select(
        F.col("event").alias("GW"), "id",
        F.col("team_h").alias("home"), "team_h", F.col("team_a").alias("away"), "team_a",
        "finished", utc_timestamp(F.col("kickoff_time")).alias("kickoff"), "team_h_score", "team_a_score",
    )
    columns = games.columns
    for name, team in (("home", "team_h"), ("away", "team_a")):
        games = lookup(games, teams, team, "id", "short_name", name)
    return games.select(columns)


def _named(elements: DataFrame) -> DataFrame:
    return elements.withColumn("playername", F.concat("first_name", F.lit(" "), "second_name"))


def read_player_ids(
    spark: SparkSession, path: str, names: Sequence[str] | DataFrame | None = None, multi_line: bool = True
) -> DataFrame:
    players = _named(_read_items(spark, path, "elements", ELEMENTS, multi_line)).select("playername", "id")
    return players if names is None else filter_in(players, "playername", names)


def read_player_names(
    spark: SparkSession, path: str, ids: Sequence[int] | DataFrame | None = None, multi_line: bool = True
) -> DataFrame:
    players = read_player_ids(spark, path, multi_line=multi_line)
    return players if ids is None else filter_in(players, "id", ids)


def read_player_info(
    spark: SparkSession,
    path: str,
    names: Sequence[str] | DataFrame | None = None,
    season: int | None = None,
    items: T.StructType = ELEMENTS,
    multi_line: bool = True,
) -> DataFrame:
    """All element columns from the current document, or from the archive below ``path``."""
    if season is None:
        players = _named(_read_items(spark, path, "elements", items, multi_line))
    else:
        archived = T.StructType([*items.fields, T.StructField("playername", T.StringType())])
        players = read_season_csv(spark, path, "player_info", season, archived)
    return players if names is None else filter_in(players, "playername", names)


def _player_documents(
    spark: SparkSession, path: str, field: str, items: T.StructType, multi_line: bool
) -> DataFrame:
    """``(__player, items...)`` of per-player documents, read in one scan.

    The player is the document's ``id``, or the number in the file name where a document has none.
    """
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField(field, T.ArrayType(items))])
    in_name = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json", 1)
    player = F.coalesce(F.col("id"), F.when(in_name != "", in_name).cast("bigint"))
    documents = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return documents.select(player.alias("__player"), field)


def _with_names(
    documents: DataFrame, field: str, players: DataFrame, ids: Sequence[int] | DataFrame | None, names: Sequence[str] | DataFrame | None
) -> DataFrame:
    """Select players while rows are still whole documents, then flatten. Players are broadcast while they are few."""
    if ids is not None:
        documents = filter_in(documents, "__player", ids)
    if names is not None:
        players = filter_in(players, "playername", names)
    players = players.withColumnRenamed("id", "__player")
    few = players.count() <= MAX_BROADCAST_PLAYERS
    named = documents.join(F.broadcast(players) if few else players, "__player")
    return named.select(F.inline(field), "playername")


def read_player_hist(
    spark: SparkSession,
    path: str,
    players: DataFrame,
    ids: Sequence[int] | DataFrame | None = None,
    items: T.StructType = HISTORY_PAST,
    multi_line: bool = True,
) -> DataFrame:
    """Past seasons of every player, tagged with ``playername`` from ``players`` (playername, id)."""
    documents = _player_documents(spark, path, "history_past", items, multi_line)
    return _with_names(documents, "history_past", players, ids, None)


def read_player_details(
    spark: SparkSession,
    path: str,
    players: DataFrame | None = None,
    ids: Sequence[int] | DataFrame | None = None,
    names: Sequence[str] | DataFrame | None = None,
    season: int | None = None,
    items: T.StructType = HISTORY,
    multi_line: bool = True,
) -> DataFrame:
    """Games of every player of the current season, or the archived season below ``path``."""
    if ids is not None and names is not None:
        raise ValueError("give ids or names, not both")
    if season is None:
        documents = _player_documents(spark, path, "history", items, multi_line)
        return _with_names(documents, "history", players, ids, names)
    archived = T.StructType([
        *items.fields, T.StructField("playername", T.StringType()), T.StructField("playerid", T.LongType())
    ])
    rows = read_season_csv(spark, path, "player_details", season, archived)
    if ids is not None:
        return filter_in(rows, "playerid", ids)
    return rows if names is None else filter_in(rows, "playername", names)


def read_rounds(
    spark: SparkSession,
    path: str,
    rounds: Sequence[int] | None = None,
    season: int | None = None,
    items: T.StructType = EVENTS,
    multi_line: bool = True,
) -> DataFrame:
    if season is None:
        events = _read_items(spark, path, "events", items, multi_line)
    else:
        events = read_season_csv(spark, path, "rounds", season, items)
    return events if rounds is None else filter_in(events, "id", rounds)
