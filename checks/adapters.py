"""The test tables in the shape of match data: orders as games, suppliers as players.

The SQL text of an adapter runs unchanged on both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["orders", "customer", "nation", "lineitem", "supplier", "documents", "labels", "embeddings", "part"]

GAMES = """
SELECT g.*, h.n_name AS home, a.n_name AS away
FROM (
  SELECT o.o_orderkey AS id, CAST(EXTRACT(YEAR FROM o.o_orderdate) AS INT) AS season_start_year,
         o.o_orderdate AS kickoff, CAST(c.c_nationkey AS BIGINT) AS team_h,
         CAST((c.c_nationkey + 1 + o.o_orderkey % 24) % 25 AS BIGINT) AS team_a,
         CAST(EXTRACT(MONTH FROM o.o_orderdate) AS INT) * 3 AS GW, (o.o_orderstatus <> 'O') AS finished,
         CASE WHEN o.o_orderstatus <> 'O' THEN CAST((o.o_orderkey * 7) % 5 AS INT) END AS team_h_score,
         CASE WHEN o.o_orderstatus <> 'O' THEN CAST((o.o_orderkey * 11 + c.c_nationkey) % 4 AS INT) END AS team_a_score
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
) g
LEFT JOIN {nation} h ON g.team_h = h.n_nationkey
LEFT JOIN {nation} a ON g.team_a = a.n_nationkey
"""

PLAYERS = """
SELECT l.l_orderkey AS fixture, l.l_suppkey AS element, CAST(1 + l.l_suppkey % 5 AS INT) AS element_type,
       (MIN(l.l_linestatus) = 'F') AS was_home,
       CAST(SUM(CASE WHEN l.l_returnflag = 'N' THEN 0 ELSE l.l_quantity END) AS DOUBLE) AS minutes,
       CAST(SUM(l.l_linenumber) AS DOUBLE) AS goals_scored, CAST(SUM(l.l_linenumber % 3) AS DOUBLE) AS assists,
       CAST(COUNT(*) AS DOUBLE) AS clean_sheets, CAST(MAX(l.l_linenumber) AS DOUBLE) AS goals_conceded,
       CAST(MIN(l.l_linenumber) AS DOUBLE) AS saves, CAST(SUM(l.l_quantity) AS DOUBLE) AS influence,
       CAST(MAX(l.l_quantity) AS DOUBLE) AS creativity, CAST(MIN(l.l_quantity) AS DOUBLE) AS threat,
       CAST(MIN(l.l_partkey) AS DOUBLE) AS value, CAST(MAX(l.l_partkey) - MIN(l.l_partkey) AS DOUBLE) AS transfers_balance,
       CAST(MAX(l.l_partkey) AS DOUBLE) AS selected
FROM {lineitem} l GROUP BY l.l_orderkey, l.l_suppkey
"""

DETAILS = """
SELECT p.*, g.season_start_year, g.kickoff AS kickoff_time
FROM {players} p JOIN {games} g ON p.fixture = g.id
"""

INFO = """
SELECT DISTINCT season_start_year, element AS id, element_type FROM {details}
"""

SCORED = """
SELECT d.doc_id, CASE WHEN d.lang = 'en' THEN 'train' ELSE 'validation' END AS split, l.quality AS y, CAST((d.n_chars * 31 + d.doc_id * 17) % 101 AS DOUBLE) / 101 AS p
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
"""

# A factor table: text, few-valued and continuous columns against a 0/1 target.
FACTORS = """
SELECT l_returnflag AS flag, CAST(l_linenumber % 4 AS INT) AS few, l_extendedprice AS price, l_quantity AS quantity,
       CASE WHEN l_discount > 0.05 THEN NULL ELSE l_discount END AS discount, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS y
FROM {lineitem}
"""

# SQL-only views built on the adapters, used by the SQL side.
TEAM_ROWS = """
SELECT id, season_start_year, kickoff, GW, finished, team_h AS team_id_season, home AS team, 1 AS home,
       CASE WHEN team_h_score > team_a_score THEN 1 ELSE 0 END AS win,
       CASE WHEN team_h_score = team_a_score THEN 1 ELSE 0 END AS draw,
       CASE WHEN team_h_score < team_a_score THEN 1 ELSE 0 END AS loss,
       team_h_score AS goals_scored, team_a_score AS goals_conceded
FROM games
UNION ALL
SELECT id, season_start_year, kickoff, GW, finished, team_a, away, 0,
       CASE WHEN team_a_score > team_h_score THEN 1 ELSE 0 END,
       CASE WHEN team_h_score = team_a_score THEN 1 ELSE 0 END,
       CASE WHEN team_a_score < team_h_score THEN 1 ELSE 0 END,
       team_a_score, team_h_score
FROM games
"""

TEAM_GAMES = """
SELECT *, LEAD(id) OVER (PARTITION BY season_start_year, team_id_season ORDER BY kickoff, id) AS next_id FROM team_rows
"""

_BASE = {t: t for t in [*TABLES, "players", "games", "details"]}
CTES = {
    "games": GAMES.format(**_BASE),
    "players": PLAYERS.format(**_BASE),
    "details": DETAILS.format(**_BASE),
    "info": INFO.format(**_BASE),
    "scored": SCORED.format(**_BASE),
    "factors": FACTORS.format(**_BASE),
    "team_rows": TEAM_ROWS,
    "team_games": TEAM_GAMES,
}
_NEEDS = {
    "details": ["games", "players"], "info": ["details"], "team_rows": ["games"], "team_games": ["team_rows"],
}


def with_ctes(*names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause that defines the named adapters, what they need, and further views."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTES[n]})" for n in ordered] + [f"{n} AS ({s})" for n, s in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _run(spark: SparkSession, sf: str, text: str, **frames: DataFrame) -> DataFrame:
    used = {t: table(spark, sf, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used, **frames)


def games(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf, GAMES)


def players(spark: SparkSession, sf: str) -> DataFrame:
    """Lines are dealt by order before they are grouped: a line is narrower than its partial sums, and a game's rows stay together."""
    return spark.sql(PLAYERS, lineitem=table(spark, sf, "lineitem").repartition("l_orderkey"))


def details(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf, DETAILS, players=players(spark, sf), games=games(spark, sf))


def info(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf, INFO, details=details(spark, sf))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf, SCORED)


def numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as one column per dimension, with a 0/1 label."""
    vectors = table(spark, sf, "embeddings")
    entries = [F.get("embedding", i).cast("double").alias(f"e_{i:02d}") for i in range(64)]
    return vectors.select("vec_id", (F.col("label") % 2).alias("y"), *entries)


def factors(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf, FACTORS)
