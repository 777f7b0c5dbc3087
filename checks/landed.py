"""Sources and sinks: test tables are landed as JSON or CSV, read back, and must equal themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import adapters as a
from checks.registry import query, r6, rounded
from touchline.operators.relational import union_by_name
from touchline.plans import landing
from touchline.plans.refresh import refresh
from touchline.session import scratch_path
from touchline.sources import landed, seasons, snapshots

Spark = SparkSession
ROWS_PER_DOCUMENT = 500


def land(df: DataFrame, name: str, chunk: list[Column], items: list[str], field: str | None, key: str | None = None) -> str:
    """Write rows as JSON documents of bounded size, one per line, compressed; returns the folder.

    ``field`` names the array inside a document (None: the document is the array), ``key`` a column
    that becomes the document's ``id``.
    """
    path = scratch_path(df.sparkSession, name)
    chunks = [c.alias(f"chunk_{i}") for i, c in enumerate(chunk)]
    grouped = df.groupBy(*chunks, *([F.col(key).alias("id")] if key else []))
    documents = grouped.agg(F.collect_list(F.struct(*items)).alias("items"))
    if field is None:
        line = F.to_json("items")
    else:
        line = F.to_json(F.struct(*(["id"] if key else []), F.col("items").alias(field)))
    documents.select(line.alias("value")).write.option("compression", "gzip").text(path)
    return path


def chunk_of(key: str) -> list[Column]:
    return [F.floor(F.col(key) / ROWS_PER_DOCUMENT)]


def land_teams(spark: Spark, sf: str) -> str:
    nations = a.table(spark, sf, "nation")
    teams = nations.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("short_name"),
                           F.lower("n_name").alias("name"))
    return land(teams, "teams", chunk_of("id"), ["id", "short_name", "name"], "teams")


@query("s1_teams", "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS short_name, LOWER(n_name) AS name FROM nation")
def s1(spark: Spark, sf: str) -> DataFrame:
    return landed.read_teams(spark, land_teams(spark, sf), multi_line=False)


@query(
    "s2_fixtures",
    a.with_ctes("games") + """SELECT GW, id, home, team_h, away, team_a, finished, CAST(kickoff AS DATE) AS kickoff_date, team_h_score, team_a_score FROM games""",
)
def s2(spark: Spark, sf: str) -> DataFrame:
    fixtures = a.games(spark, sf).withColumns({
        "event": F.col("GW"), "kickoff_time": F.date_format("kickoff", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    })
    path = land(fixtures, "fixtures", chunk_of("id"), landed.FIXTURES.fieldNames(), None)
    teams = landed.read_teams(spark, land_teams(spark, sf), multi_line=False)
    games = landed.read_fixtures(spark, path, teams, multi_line=False)
    return games.withColumn("kickoff_date", F.to_date("kickoff")).drop("kickoff")


def land_elements(spark: Spark, sf: str) -> str:
    elements = a.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("first_name"),
        F.when(F.col("s_nationkey") != 3, F.col("s_nationkey").cast("string")).alias("second_name"),
        (F.lit(1) + F.col("s_suppkey") % 5).cast("int").alias("element_type"), F.col("s_acctbal").alias("now_cost"),
    )
    return land(elements, "elements", chunk_of("id"), elements.columns, "elements")


NAMES_SQL = "SELECT s_name || ' ' || CASE WHEN s_nationkey <> 3 THEN CAST(s_nationkey AS VARCHAR) END AS playername, s_suppkey AS id FROM supplier"


@query("s3_player_ids", NAMES_SQL)
def s3(spark: Spark, sf: str) -> DataFrame:
    return landed.read_player_ids(spark, land_elements(spark, sf), multi_line=False)


@query("s3_player_ids_by_name", f"SELECT * FROM ({NAMES_SQL}) WHERE id % 3 = 1 AND playername IS NOT NULL")
def s3_by_name(spark: Spark, sf: str) -> DataFrame:
    """The names asked for are a table."""
    names = a.table(spark, sf, "supplier").filter("s_suppkey % 3 = 1 and s_nationkey != 3").select(F.concat_ws(" ", "s_name", "s_nationkey").alias("n"))
    return landed.read_player_ids(spark, land_elements(spark, sf), names=names, multi_line=False)


@query("s4_player_names", NAMES_SQL)
def s4(spark: Spark, sf: str) -> DataFrame:
    return landed.read_player_names(spark, land_elements(spark, sf), multi_line=False)


@query("s4_player_names_by_id", f"SELECT * FROM ({NAMES_SQL}) WHERE id % 4 = 2")
def s4_by_id(spark: Spark, sf: str) -> DataFrame:
    ids = a.table(spark, sf, "supplier").filter("s_suppkey % 4 = 2").select("s_suppkey")
    return landed.read_player_names(spark, land_elements(spark, sf), ids=ids, multi_line=False)


def land_season(rows: DataFrame, table: str, season: int) -> str:
    """An archived season as CSV below a fresh root; returns the root."""
    root = scratch_path(rows.sparkSession, "archive")
    rows.write.option("header", True).csv(f"{root}/{table}/season={season}")
    return root


@query("s5_player_info_archived", f"""WITH n AS ({NAMES_SQL}) SELECT s_suppkey AS id, s_name AS first_name,
       CAST(1 + s_suppkey % 5 AS INT) AS element_type, playername FROM supplier JOIN n ON s_suppkey = id WHERE s_suppkey % 2 = 0 AND playername IS NOT NULL""")
def s5_archived(spark: Spark, sf: str) -> DataFrame:
    """An archived season, and of it the players with certain names."""
    players = landed.read_player_info(spark, land_elements(spark, sf), multi_line=False).select("id", "first_name", "element_type", "playername")
    names = players.filter("id % 2 = 0 and playername is not null").select("playername")
    return landed.read_player_info(spark, land_season(players, "player_info", 19), names=names, season=19)


@query(
    "s5_player_info",
    f"""WITH n AS ({NAMES_SQL}) SELECT s_suppkey AS id, s_name AS first_name, CASE WHEN s_nationkey <> 3 THEN CAST(s_nationkey AS VARCHAR) END AS second_name,
       CAST(1 + s_suppkey % 5 AS INT) AS element_type, s_acctbal AS now_cost, playername FROM supplier JOIN n ON s_suppkey = id""",
)
def s5(spark: Spark, sf: str) -> DataFrame:
    items = T.StructType([*landed.ELEMENTS.fields, T.StructField("now_cost", T.DoubleType())])
    return landed.read_player_info(spark, land_elements(spark, sf), items=items, multi_line=False)


@query(
    "s6_player_history",
    a.with_ctes("details", extra={"n": NAMES_SQL}) + """
SELECT CAST(season_start_year AS VARCHAR) AS season_name, element AS element_code, SUM(minutes) AS minutes, playername
FROM details JOIN n ON element = id GROUP BY season_start_year, element, playername""",
)
def s6(spark: Spark, sf: str) -> DataFrame:
    past = (
        a.details(spark, sf).groupBy("season_start_year", "element").agg(F.sum("minutes").alias("minutes"))
        .withColumns({"season_name": F.col("season_start_year").cast("string"), "element_code": F.col("element")})
    )
    path = land(past, "history_past", [], ["season_name", "element_code", "minutes"], "history_past", "element")
    names = landed.read_player_ids(spark, land_elements(spark, sf), multi_line=False)
    items = T.StructType([*landed.HISTORY_PAST.fields, T.StructField("minutes", T.DoubleType())])
    return landed.read_player_hist(spark, path, names, items=items, multi_line=False)


@query(
    "s7_player_details",
    a.with_ctes("details", extra={"n": NAMES_SQL}) + """
SELECT element, fixture, CAST(kickoff_time AS DATE) AS kickoff_date, was_home, minutes, goals_scored, influence, selected, playername
FROM details JOIN n ON element = id""",
)
def s7(spark: Spark, sf: str) -> DataFrame:
    details = a.details(spark, sf).withColumn("kickoff_time", F.date_format("kickoff_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    items = [c for c in landed.HISTORY.fieldNames() if c in details.columns]
    path = land(details, "history", chunk_of("fixture"), items, "history", "element")
    names = landed.read_player_ids(spark, land_elements(spark, sf), multi_line=False)
    rows = landed.read_player_details(spark, path, names, multi_line=False)
    kickoff = F.to_date(landed.utc_timestamp(F.col("kickoff_time"))).alias("kickoff_date")
    return rows.select("element", "fixture", kickoff, "was_home", "minutes", "goals_scored", "influence", "selected", "playername")


@query(
    "s8_rounds",
    a.with_ctes("games") + """SELECT CAST(season_start_year * 1000 + GW AS INT) AS id, BOOL_AND(finished) AS finished,
       STRFTIME(MIN(kickoff), '%Y-%m-%d') AS deadline_time FROM games GROUP BY season_start_year, GW""",
)
def s8(spark: Spark, sf: str) -> DataFrame:
    events = (
        a.games(spark, sf).groupBy("season_start_year", "GW")
        .agg(F.bool_and("finished").alias("finished"), F.date_format(F.min("kickoff"), "yyyy-MM-dd").alias("deadline_time"))
        .withColumn("id", F.col("season_start_year") * 1000 + F.col("GW"))
    )
    path = land(events, "events", [F.col("season_start_year")], landed.EVENTS.fieldNames(), "events")
    return landed.read_rounds(spark, path, multi_line=False)


@query(
    "s2_fixtures_archived",
    a.with_ctes("games") + """SELECT GW, id, home, team_h, away, team_a, finished, CAST(kickoff AS DATE) AS kickoff_date, team_h_score, team_a_score
FROM games WHERE season_start_year = 1997""",
)
def s2_archived(spark: Spark, sf: str) -> DataFrame:
    rows = a.games(spark, sf).filter("season_start_year = 1997").select(
        *[c for c in landed.GAMES.fieldNames() if c != "kickoff"], F.date_format("kickoff", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("kickoff"))
    games = landed.read_fixtures(spark, land_season(rows, "games", 1997), season=1997)
    return games.withColumn("kickoff_date", F.to_date("kickoff")).drop("kickoff")


@query(
    "s7_player_details_archived",
    a.with_ctes("details") + "SELECT element AS playerid, fixture, minutes, goals_scored FROM details WHERE season_start_year = 1998 AND element % 5 = 3",
)
def s7_archived(spark: Spark, sf: str) -> DataFrame:
    """An archived season, and of it the players with certain ids."""
    rows = a.details(spark, sf).filter("season_start_year = 1998").select(F.col("element").alias("playerid"), "fixture", "minutes", "goals_scored")
    ids = a.table(spark, sf, "supplier").filter("s_suppkey % 5 = 3").select("s_suppkey")
    return landed.read_player_details(spark, land_season(rows, "player_details", 1998), ids=ids, season=1998)


@query(
    "s7_player_details_by_name",
    a.with_ctes("details", extra={"n": NAMES_SQL}) + """SELECT element, fixture, minutes, playername FROM details JOIN n ON element = id
WHERE element % 6 = 2 AND playername IS NOT NULL""",
)
def s7_by_name(spark: Spark, sf: str) -> DataFrame:
    path = land(a.details(spark, sf), "history", chunk_of("fixture"), ["element", "fixture", "minutes"], "history", "element")
    players = landed.read_player_ids(spark, land_elements(spark, sf), multi_line=False)
    names = players.filter("id % 6 = 2 and playername is not null").select("playername")
    return landed.read_player_details(spark, path, players, names=names, multi_line=False).select("element", "fixture", "minutes", "playername")


@query(
    "s8_rounds_archived",
    a.with_ctes("games") + """SELECT GW AS id, BOOL_AND(finished) AS finished, STRFTIME(MIN(kickoff), '%Y-%m-%d') AS deadline_time
FROM games WHERE season_start_year = 1996 AND GW IN (3, 9, 30) GROUP BY GW""",
)
def s8_archived(spark: Spark, sf: str) -> DataFrame:
    events = a.games(spark, sf).filter("season_start_year = 1996").groupBy(F.col("GW").alias("id")).agg(
        F.bool_and("finished").alias("finished"), F.date_format(F.min("kickoff"), "yyyy-MM-dd").alias("deadline_time"))
    return landed.read_rounds(spark, land_season(events, "rounds", 1996), rounds=[3, 9, 30], season=1996)


GAME_CSV = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("team_h", T.LongType()), T.StructField("home", T.StringType()),
    T.StructField("kickoff", T.TimestampNTZType()), T.StructField("finished", T.BooleanType()),
    T.StructField("team_h_score", T.IntegerType()),
])
CSV_COLUMNS = ["id", "team_h", "home", "finished", "team_h_score"]


def land_archive(spark: Spark, sf: str) -> tuple[str, list[int]]:
    """Games as CSV by season, whole numbers with gaps written as pandas does, and a row index."""
    root = scratch_path(spark, "archive")
    games = a.games(spark, sf).select(
        F.col("id").alias("Unnamed: 0"), *CSV_COLUMNS, F.date_format("kickoff", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("kickoff"),
        F.col("season_start_year").alias("season"),
    ).withColumn("team_h_score", F.col("team_h_score").cast("double"))
    games.write.partitionBy("season").option("header", True).csv(f"{root}/games")
    return root, [r.season for r in games.select("season").distinct().orderBy("season").collect()]


@query("s9_season_csv", a.with_ctes("games") + f"SELECT {', '.join(CSV_COLUMNS)}, CAST(kickoff AS DATE) AS kickoff_date, season_start_year FROM games")
def s9(spark: Spark, sf: str) -> DataFrame:
    root, years = land_archive(spark, sf)
    frames = [seasons.read_season_csv(spark, root, "games", y, GAME_CSV).withColumn("season_start_year", F.lit(y)) for y in years]
    return union_by_name(*frames).withColumn("kickoff_date", F.to_date("kickoff")).drop("kickoff")


@query("s10_load_seasons", a.with_ctes("games") + f"SELECT {', '.join(CSV_COLUMNS)}, season_start_year FROM games")
def s10(spark: Spark, sf: str) -> DataFrame:
    """The newest season with all archived ones and one that was never archived."""
    root, years = land_archive(spark, sf)

    def reader(season: int) -> DataFrame:
        return seasons.read_season_csv(spark, root, "games", season, GAME_CSV)

    current = a.games(spark, sf).filter(F.col("season_start_year") == years[-1]).select(CSV_COLUMNS)
    return seasons.load_seasons(current, years[-1], reader, [years[0] - 1, *years[:-1]]).select(*CSV_COLUMNS, "season_start_year")


@query("s9_columns_by_name", a.with_ctes("games") + "SELECT id, team_h, home, finished FROM games")
def s9_by_name(spark: Spark, sf: str) -> DataFrame:
    """One season whose files have their columns in different orders."""
    root = scratch_path(spark, "archive")
    games = a.games(spark, sf).select("id", "team_h", "home", "finished")
    for part, columns in ((0, ["id", "team_h", "home", "finished"]), (1, ["team_h", "finished", "id", "home"])):
        rows = games.filter(F.col("id") % 2 == part).select(columns)
        rows.write.mode("append").option("header", True).csv(f"{root}/games/season=20")
    return seasons.read_season_csv(spark, root, "games", 20, GAME_CSV)


@query(
    "s12_land_twice",
    a.with_ctes("games") + """, newest AS (SELECT MAX(season_start_year) AS y FROM games)
SELECT id, season_start_year, team_h, finished, CASE WHEN season_start_year = y THEN COALESCE(team_h_score, -1) ELSE team_h_score END AS team_h_score
FROM games, newest WHERE season_start_year >= y - 4""",
)
def s12_land_twice(spark: Spark, sf: str) -> DataFrame:
    """Two landed snapshots of the newest season above four archived ones, through the landing driver."""
    root, years = land_archive(spark, sf)
    games = a.games(spark, sf).select("id", "team_h", "home", "finished", "team_h_score", "team_a", "season_start_year", "kickoff")
    now = games.filter(F.col("season_start_year") == years[-1]).drop("season_start_year")

    def archive(season: int) -> DataFrame:
        rows = seasons.read_season_csv(spark, root, "games", season, GAME_CSV)
        return rows.join(games.filter(F.col("season_start_year") == season).select("id", "team_a"), "id")

    store = scratch_path(spark, "landing")
    earlier = range(years[-1] - 4, years[-1])
    landing.refresh_table(spark, store, "games", now, years[-1], earlier, archive)
    again = now.withColumn("team_h_score", F.coalesce("team_h_score", F.lit(-1)))
    landing.refresh_table(spark, store, "games", again, years[-1], earlier, archive)
    return snapshots.read_snapshot(spark, store, "games").select("id", "season_start_year", "team_h", "finished", "team_h_score")


@query("s11_read_snapshot", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def s11(spark: Spark, sf: str) -> DataFrame:
    """Two versions are written; the newest is read."""
    root = scratch_path(spark, "snapshots")
    orders = a.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    snapshots.write_snapshot(orders.filter("o_totalprice > 100000"), root, "orders")
    snapshots.write_snapshot(orders, root, "orders")
    return snapshots.read_snapshot(spark, root, "orders")


@query(
    "s12_refresh_in_place",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_acctbal ELSE c_acctbal + 1 END AS c_acctbal FROM customer",
)
def s12(spark: Spark, sf: str) -> DataFrame:
    """A table is refreshed from itself and an overlapping snapshot."""
    root = scratch_path(spark, "snapshots")
    customers = a.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    snapshots.write_snapshot(customers, root, "customers")
    new = customers.filter("c_acctbal >= 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    merged = refresh(snapshots.read_snapshot(spark, root, "customers"), new, ["c_custkey"])
    snapshots.write_snapshot(merged, root, "customers")
    return snapshots.read_snapshot(spark, root, "customers")


@query(
    "s13_result_tables",
    f"""SELECT o_orderstatus AS status, {r6('AVG(o_totalprice)')} AS mean, 'label_1' AS label, 'Decision Tree' AS algorithm FROM orders GROUP BY 1
UNION ALL SELECT o_orderpriority, {r6('AVG(o_totalprice)')}, 'label_X', 'Random Forest' FROM orders GROUP BY 1""",
)
def s13(spark: Spark, sf: str) -> DataFrame:
    """A part that is written twice is replaced; other parts stay."""
    root = scratch_path(spark, "results")
    orders = a.table(spark, sf, "orders")

    def means(column: str) -> DataFrame:
        return orders.groupBy(F.col(column).alias("status")).agg(F.avg("o_totalprice").alias("mean"))

    snapshots.write_result(means("o_orderpriority"), root, "metrics", "label_1", "Decision Tree")
    snapshots.write_result(means("o_orderpriority"), root, "metrics", "label_X", "Random Forest")
    snapshots.write_result(means("o_orderstatus"), root, "metrics", "label_1", "Decision Tree")
    return rounded(snapshots.read_results(spark, root, "metrics"))
