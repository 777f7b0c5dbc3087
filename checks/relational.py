"""Projections, filters, joins, aggregates, windows, sorting, unions, functions and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import adapters as a
from checks.composites import STANDINGS, snapshots, OLD_SQL, NEW_SQL
from checks.registry import query, r6, rounded
from touchline.functions import scalar
from touchline.operators import asof, ordered, relational as rel
from touchline.plans import games as games_plan, standings
from touchline.plans.games import PLAYED_ORDER, TEAM

Spark = SparkSession

# ---- projections and filters


@query("p1_select_columns", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def p1(spark: Spark, sf: str) -> DataFrame:
    return a.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")


@query("p2_rename_columns", "SELECT p_partkey AS id, p_name AS playername, p_size FROM part")
def p2(spark: Spark, sf: str) -> DataFrame:
    part = a.table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    return part.withColumnsRenamed({"p_partkey": "id", "p_name": "playername"})


@query("p3_drop_columns", "SELECT s_suppkey, s_nationkey FROM supplier")
def p3(spark: Spark, sf: str) -> DataFrame:
    return a.table(spark, sf, "supplier").drop("s_name", "s_acctbal")


@query("p4_prefix_columns", "SELECT s_suppkey AS tbl_s_suppkey, s_name AS tbl_s_name, s_nationkey AS tbl_s_nationkey, s_acctbal AS tbl_s_acctbal FROM supplier")
def p4(spark: Spark, sf: str) -> DataFrame:
    return rel.add_prefix(a.table(spark, sf, "supplier"), "tbl_")


@query("p5_not_null", a.with_ctes("games") + "SELECT id, team_h_score FROM games WHERE team_h_score IS NOT NULL")
def p5(spark: Spark, sf: str) -> DataFrame:
    return a.games(spark, sf).filter(F.col("team_h_score").isNotNull()).select("id", "team_h_score")


@query("p6_equality_filters", a.with_ctes("games") + "SELECT id, team_h, team_a FROM games WHERE finished = TRUE AND team_h = 7")
def p6(spark: Spark, sf: str) -> DataFrame:
    return a.games(spark, sf).filter(F.col("finished") & (F.col("team_h") == 7)).select("id", "team_h", "team_a")


@query("p7_membership", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def p7(spark: Spark, sf: str) -> DataFrame:
    customers = a.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return rel.filter_in(customers, "c_mktsegment", ["BUILDING", "MACHINERY"])


@query("p7_membership_long_list", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 5 = 2")
def p7_long(spark: Spark, sf: str) -> DataFrame:
    """A list beyond what is written into a filter stays a table."""
    keys = a.table(spark, sf, "orders").filter("o_orderkey % 5 = 2").select("o_orderkey")
    return rel.filter_in(a.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", keys)


@query("p8_compare_columns", a.with_ctes("games") + "SELECT id, team_h_score, team_a_score FROM games WHERE team_h_score > team_a_score AND team_a_score < team_h")
def p8(spark: Spark, sf: str) -> DataFrame:
    condition = (F.col("team_h_score") > F.col("team_a_score")) & (F.col("team_a_score") < F.col("team_h"))
    return a.games(spark, sf).filter(condition).select("id", "team_h_score", "team_a_score")


@query(
    "p9_case_mapping",
    a.with_ctes("players") + """SELECT fixture, element,
       CASE element_type WHEN 1 THEN 'G' WHEN 2 THEN 'D' WHEN 3 THEN 'M' ELSE 'F' END AS position FROM players""",
)
def p9(spark: Spark, sf: str) -> DataFrame:
    position = scalar.case_map(F.col("element_type"), {1: "G", 2: "D", 3: "M"}, "F")
    return a.players(spark, sf).select("fixture", "element", position.alias("position"))


@query("p10_constant_columns", "SELECT o_orderkey, 23 AS season_start_year, 'home' AS side FROM orders")
def p10(spark: Spark, sf: str) -> DataFrame:
    return a.table(spark, sf, "orders").select("o_orderkey", F.lit(23).alias("season_start_year"), F.lit("home").alias("side"))


@query("p11_columns_like", "SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount FROM lineitem")
def p11(spark: Spark, sf: str) -> DataFrame:
    lines = a.table(spark, sf, "lineitem")
    prices = rel.cols_like(lines, any_of=["price", "discount", "tax"], none_of=["tax"], dtype=T.DoubleType)
    return lines.select("l_orderkey", "l_linenumber", *prices)


@query("p12_block_difference", "SELECT l_orderkey, l_linenumber, l_quantity - l_discount AS diff_1, l_extendedprice - l_tax AS diff_2 FROM lineitem")
def p12(spark: Spark, sf: str) -> DataFrame:
    lines = a.table(spark, sf, "lineitem")
    diffs = rel.block_diff(lines, ["l_quantity", "l_extendedprice"], ["l_discount", "l_tax"], ["diff_1", "diff_2"])
    return diffs.select("l_orderkey", "l_linenumber", "diff_1", "diff_2")


# ---- joins


@query("j1_lookup", "SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def j1(spark: Spark, sf: str) -> DataFrame:
    customers, nations = a.table(spark, sf, "customer"), a.table(spark, sf, "nation")
    return rel.lookup(customers, nations, "c_nationkey", "n_nationkey", "n_name", "nation").select("c_custkey", "nation")


HOME_POINTS = """SELECT season_start_year AS s, team_id_season AS t, next_id AS n, win FROM team_games WHERE next_id IS NOT NULL"""


@query(
    "j2_inner_join_multi_key",
    a.with_ctes("team_games", extra={"form": HOME_POINTS})
    + "SELECT g.id, g.season_start_year, g.team_h, f.win FROM games g JOIN form f ON g.season_start_year = f.s AND g.team_h = f.t AND g.id = f.n",
)
def j2(spark: Spark, sf: str) -> DataFrame:
    games = a.games(spark, sf)
    form = games_plan.team_games(games).select("season_start_year", "team_id_season", "next_id", "win")
    pairs = [("season_start_year", "season_start_year"), ("team_h", "team_id_season"), ("id", "next_id")]
    return rel.join_on(games.select("id", "season_start_year", "team_h"), form, pairs)


DAILY = """SELECT season_start_year AS t_s, CAST(kickoff AS DATE) AS t_d, team_id_season AS t_t, COUNT(*) AS t_games FROM team_rows GROUP BY ALL"""


def _daily(spark: Spark, sf: str) -> DataFrame:
    rows = games_plan.team_rows(a.games(spark, sf)).withColumn("d", F.to_date("kickoff"))
    counts = rows.groupBy(F.col("season_start_year").alias("s"), "d", F.col("team_id_season").alias("t"))
    return rel.add_prefix(counts.agg(F.count(F.lit(1)).alias("games")), "t_")


@query(
    "j3_join_prefixed_on_date",
    a.with_ctes("team_rows", extra={"daily": DAILY})
    + """SELECT g.id, t_games FROM games g JOIN daily ON g.season_start_year = t_s AND CAST(g.kickoff AS DATE) = t_d AND g.team_h = t_t""",
)
def j3(spark: Spark, sf: str) -> DataFrame:
    games = a.games(spark, sf).select("id", "season_start_year", "team_h", F.to_date("kickoff").alias("kickoff_date"))
    pairs = [("season_start_year", "t_s"), ("kickoff_date", "t_d"), ("team_h", "t_t")]
    return rel.join_on(games, _daily(spark, sf), pairs).select("id", "t_games")


@query(
    "j4_left_join_prefixed",
    a.with_ctes("team_rows", extra={"daily": DAILY + " HAVING COUNT(*) > 1"})
    + """SELECT g.id, t_games FROM games g LEFT JOIN daily ON g.season_start_year = t_s AND CAST(g.kickoff AS DATE) = t_d AND g.team_h = t_t""",
)
def j4(spark: Spark, sf: str) -> DataFrame:
    games = a.games(spark, sf).select("id", "season_start_year", "team_h", F.to_date("kickoff").alias("kickoff_date"))
    pairs = [("season_start_year", "t_s"), ("kickoff_date", "t_d"), ("team_h", "t_t")]
    daily = _daily(spark, sf).filter("t_games > 1")
    return rel.join_on(games, daily, pairs, "left").select("id", "t_games")


@query(
    "j5_join_shared_names",
    a.with_ctes("details", "info")
    + "SELECT d.fixture, d.element, d.season_start_year, i.element_type FROM details d JOIN info i ON d.season_start_year = i.season_start_year AND d.element = i.id",
)
def j5(spark: Spark, sf: str) -> DataFrame:
    details = a.details(spark, sf).select("fixture", "element", "season_start_year")
    info = a.info(spark, sf).withColumnRenamed("id", "element")
    return details.join(info, ["season_start_year", "element"])


@query("j6_group_total_on_rows", a.with_ctes("players") + "SELECT fixture, element, minutes, SUM(minutes) OVER (PARTITION BY fixture, was_home) AS team_minutes FROM players")
def j6(spark: Spark, sf: str) -> DataFrame:
    players = a.players(spark, sf).select("fixture", "element", "minutes", "was_home")
    return rel.with_group_agg(players, ["fixture", "was_home"], {"team_minutes": F.sum("minutes")}).drop("was_home")


@query(
    "j7_asof_standings",
    a.with_ctes("team_games", extra={k: STANDINGS[k] for k in ("running", "dates", "latest")})
    + "SELECT season_start_year, team_id_season, next_kickoff_date, kickoff_date, team_points, number_of_games FROM latest",
)
def j7(spark: Spark, sf: str) -> DataFrame:
    days = standings.match_days(games_plan.team_rows(a.games(spark, sf)))
    dates = days.select("season_start_year", F.col("kickoff_date").alias("next_kickoff_date")).distinct()
    latest = asof.asof_last_before(
        days, dates, ["season_start_year"], ["team_id_season"], "kickoff_date", "next_kickoff_date"
    )
    return latest.drop("points_from_last_game")


@query(
    "j8_rows_before_each_date",
    a.with_ctes("team_games", extra={k: STANDINGS[k] for k in ("running", "dates")})
    + """SELECT r.season_start_year, next_kickoff_date, COUNT(*) AS earlier_rows, CAST(SUM(points_from_last_game) AS BIGINT) AS earlier_points
FROM running r JOIN dates d ON r.season_start_year = d.season_start_year WHERE r.kickoff_date < d.next_kickoff_date
GROUP BY r.season_start_year, next_kickoff_date""",
)
def j8(spark: Spark, sf: str) -> DataFrame:
    """What the many-to-many join with ``<`` holds per date, from running sums over days."""
    days = (
        games_plan.team_rows(a.games(spark, sf))
        .select("season_start_year", F.to_date("kickoff").alias("next_kickoff_date"), standings.points().alias("points"))
        .groupBy("season_start_year", "next_kickoff_date")
        .agg(F.count(F.lit(1)).alias("day_rows"), F.sum("points").alias("day_points"))
    )
    layout = ordered.measure_layout(days, ["season_start_year"], ["next_kickoff_date"])
    running = ordered.cumulative(days, layout, {"upto_rows": "day_rows", "upto_points": "day_points"})
    return running.select(
        "season_start_year", "next_kickoff_date",
        (F.col("upto_rows") - F.col("day_rows")).alias("earlier_rows"),
        (F.col("upto_points") - F.col("day_points")).alias("earlier_points"),
    ).filter("earlier_rows > 0")


@query(
    "j9_rank_values",
    a.with_ctes("team_games", extra=STANDINGS)
    + "SELECT season_start_year, team_id_season, next_kickoff_date, p1 AS win_points, p18 AS regulation_points FROM held WHERE p1 IS NOT NULL AND p18 IS NOT NULL",
)
def j9(spark: Spark, sf: str) -> DataFrame:
    # Rank 2 is held on every date with two teams, so only ranks 1 and 18 can drop a date.
    table = standings.league_table(games_plan.team_rows(a.games(spark, sf)), ranks={"second": 2})
    by = ["season_start_year", "next_kickoff_date"]
    held = rel.attach_rank_values(table, by, "position", "team_points", {"win_points": 1, "regulation_points": 18})
    return held.select(*TEAM, "next_kickoff_date", "win_points", "regulation_points")


@query("j10_semi_join", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def j10(spark: Spark, sf: str) -> DataFrame:
    ids = a.table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return rel.semi_join(a.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ids, "o_orderkey")


@query(
    "j11_grouped_aggregates_side_by_side",
    a.with_ctes("players", extra={
        "everyone": "SELECT fixture, MAX(minutes) AS max_all_minutes FROM players GROUP BY fixture",
        "keepers": "SELECT fixture, MAX(saves) AS max_g_saves FROM players WHERE element_type = 1 GROUP BY fixture",
        "forwards": "SELECT fixture, MAX(threat) AS max_f_threat FROM players WHERE element_type = 4 GROUP BY fixture",
    }) + "SELECT * FROM everyone LEFT JOIN keepers USING (fixture) LEFT JOIN forwards USING (fixture)",
)
def j11(spark: Spark, sf: str) -> DataFrame:
    kind = F.col("element_type")
    blocks = [("max_all_", None, ["minutes"]), ("max_g_", kind == 1, ["saves"]), ("max_f_", kind == 4, ["threat"])]
    return rel.group_max_if(a.players(spark, sf), ["fixture"], blocks)


# ---- aggregates


@query("a1_group_sum_null_keys", a.with_ctes("games") + "SELECT team_h_score, SUM(GW) :: BIGINT AS rounds FROM games GROUP BY team_h_score")
def a1(spark: Spark, sf: str) -> DataFrame:
    return a.games(spark, sf).groupBy("team_h_score").agg(F.sum("GW").alias("rounds"))


@query("a2_group_max", a.with_ctes("games") + "SELECT team_h_score, MAX(id) AS max_id, MAX(GW) AS max_GW FROM games WHERE team_h_score IS NOT NULL GROUP BY team_h_score")
def a2(spark: Spark, sf: str) -> DataFrame:
    return rel.group_max(a.games(spark, sf), ["team_h_score"], ["id", "GW"], "max_")


@query("a3_conditional_group_max", a.with_ctes("players") + "SELECT fixture, MAX(CASE WHEN element_type = 2 THEN influence END) AS max_d_influence, MAX(CASE WHEN element_type = 3 THEN influence END) AS max_m_influence FROM players GROUP BY fixture")
def a3(spark: Spark, sf: str) -> DataFrame:
    kind = F.col("element_type")
    blocks = [("max_d_", kind == 2, ["influence"]), ("max_m_", kind == 3, ["influence"])]
    return rel.group_max_if(a.players(spark, sf), ["fixture"], blocks)


@query("a4_best_group", "SELECT c_mktsegment, ROUND(SUM(c_acctbal), 2) AS total FROM customer GROUP BY c_mktsegment ORDER BY total DESC, c_mktsegment LIMIT 1")
def a4(spark: Spark, sf: str) -> DataFrame:
    totals = a.table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("total"))
    return rel.top_k(totals, "total", 1, "c_mktsegment").withColumn("total", F.round("total", 2))


@query("a5_distinct", a.with_ctes("games") + "SELECT DISTINCT season_start_year, CAST(kickoff AS DATE) AS kickoff_date FROM games")
def a5(spark: Spark, sf: str) -> DataFrame:
    return a.games(spark, sf).select("season_start_year", F.to_date("kickoff").alias("kickoff_date")).distinct()


@query(
    "a6_keep_last",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) x WHERE rn = 1",
)
def a6(spark: Spark, sf: str) -> DataFrame:
    version = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    last = rel.dedup_last(a.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], version)
    return last.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "a7_distinct_counts",
    a.with_ctes("games") + """SELECT 'team_h_score' AS feature, COUNT(DISTINCT team_h_score) + MAX(CASE WHEN team_h_score IS NULL THEN 1 ELSE 0 END) AS n_values FROM games
UNION ALL SELECT 'home', COUNT(DISTINCT home) + MAX(CASE WHEN home IS NULL THEN 1 ELSE 0 END) FROM games
UNION ALL SELECT 'id', COUNT(DISTINCT id) FROM games""",
)
def a7(spark: Spark, sf: str) -> DataFrame:
    return rel.n_unique(a.games(spark, sf), ["team_h_score", "home", "id"])


@query(
    "a9_min_and_counts",
    a.with_ctes("games") + "SELECT CASE WHEN finished THEN 'train' ELSE 'score' END AS split, MIN(CAST(EXTRACT(YEAR FROM kickoff) AS INT)) AS first_year, COUNT(*) AS n FROM games GROUP BY 1",
)
def a9(spark: Spark, sf: str) -> DataFrame:
    base = games_plan.games_base(a.games(spark, sf))
    return base.groupBy(F.col("train_score").alias("split")).agg(
        F.min("kickoff_year").alias("first_year"), F.count(F.lit(1)).alias("n")
    )


# ---- windows


def _rows(spark: Spark, sf: str) -> tuple[DataFrame, ordered.GroupLayout]:
    games = a.games(spark, sf)
    return games_plan.team_rows(games), games_plan.team_layouts(games)[0]


TEAM_WINDOW = "PARTITION BY season_start_year, team_id_season ORDER BY kickoff, id"


@query("w1_next_id", a.with_ctes("team_rows") + f"SELECT id, team_id_season, LEAD(id) OVER ({TEAM_WINDOW}) AS next_id FROM team_rows")
def w1(spark: Spark, sf: str) -> DataFrame:
    rows, layout = _rows(spark, sf)
    return ordered.lead_by(rows, layout, "id", "next_id").select("id", "team_id_season", "next_id")


@query(
    "w2_next_home_id",
    a.with_ctes("team_rows") + "SELECT id, team_id_season, LEAD(id) OVER (PARTITION BY team_id_season ORDER BY season_start_year, kickoff, id) AS next_id_home FROM team_rows WHERE home = 1",
)
def w2(spark: Spark, sf: str) -> DataFrame:
    rows = games_plan.team_rows(a.games(spark, sf)).filter("home = 1")
    layout = ordered.measure_layout(rows, ["team_id_season"], ["season_start_year", *PLAYED_ORDER])
    return ordered.lead_by(rows, layout, "id", "next_id_home").select("id", "team_id_season", "next_id_home")


@query(
    "w3_rolling_mean",
    a.with_ctes("team_rows") + f"SELECT id, team_id_season, {r6(f'AVG(goals_scored) OVER ({TEAM_WINDOW} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)')} AS mean_10_goals_scored FROM team_rows",
)
def w3(spark: Spark, sf: str) -> DataFrame:
    rows, layout = _rows(spark, sf)
    means = ordered.rolling_mean(rows, layout, ["goals_scored"], 10, "mean_10_")
    return rounded(means.select("id", "team_id_season", "mean_10_goals_scored"))


@query(
    "w4_rolling_max",
    a.with_ctes("details") + "SELECT fixture, element, MAX(influence) OVER (PARTITION BY season_start_year, element ORDER BY kickoff_time, fixture ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS max_6_influence FROM details",
)
def w4(spark: Spark, sf: str) -> DataFrame:
    details = a.details(spark, sf).select("season_start_year", "element", "fixture", "kickoff_time", "influence")
    layout = ordered.measure_layout(details, ["season_start_year", "element"], ["kickoff_time", "fixture"])
    return ordered.rolling_max(details, layout, ["influence"], 6, "max_6_").select("fixture", "element", "max_6_influence")


@query(
    "w5_running_sum",
    a.with_ctes("team_rows") + f"SELECT id, team_id_season, CAST(SUM(win) OVER ({TEAM_WINDOW} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS wins, CAST(SUM(goals_scored) OVER ({TEAM_WINDOW} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS goals FROM team_rows",
)
def w5(spark: Spark, sf: str) -> DataFrame:
    rows, layout = _rows(spark, sf)
    return ordered.cumulative(rows, layout, {"wins": "win", "goals": "goals_scored"}).select("id", "team_id_season", "wins", "goals")


@query(
    "w6_latest_per_group",
    a.with_ctes("team_rows") + "SELECT id, season_start_year, team_id_season FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY season_start_year, team_id_season ORDER BY CAST(kickoff AS DATE) DESC, kickoff, id) AS rn FROM team_rows) x WHERE rn = 1",
)
def w6(spark: Spark, sf: str) -> DataFrame:
    rows = games_plan.team_rows(a.games(spark, sf)).withColumn("kickoff_date", F.to_date("kickoff"))
    return ordered.first_per(rows, TEAM, ["-kickoff_date", *PLAYED_ORDER]).select("id", *TEAM)


@query(
    "w7_position",
    a.with_ctes("team_rows") + """, totals AS (SELECT season_start_year, team_id_season, CAST(SUM(win) AS BIGINT) AS wins FROM team_rows GROUP BY ALL)
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY season_start_year ORDER BY wins DESC, team_id_season) AS INT) AS position FROM totals""",
)
def w7(spark: Spark, sf: str) -> DataFrame:
    totals = games_plan.team_rows(a.games(spark, sf)).groupBy(*TEAM).agg(F.sum("win").alias("wins"))
    layout = ordered.measure_layout(totals, ["season_start_year"], ["-wins", "team_id_season"])
    return ordered.row_numbers(totals, layout, "position")


@query(
    "w8_neighbour_difference",
    a.with_ctes("team_rows") + f"SELECT id, team_id_season, COALESCE(goals_scored - LAG(goals_scored) OVER ({TEAM_WINDOW}), 0) AS to_previous, COALESCE(goals_scored - LEAD(goals_scored) OVER ({TEAM_WINDOW}), 0) AS to_next FROM team_rows",
)
def w8(spark: Spark, sf: str) -> DataFrame:
    rows, layout = _rows(spark, sf)
    diffs = {"to_previous": ("goals_scored", -1), "to_next": ("goals_scored", 1)}
    return ordered.diff_neighbour(rows, layout, diffs).select("id", "team_id_season", "to_previous", "to_next")


@query(
    "w9_row_number",
    a.with_ctes("team_rows") + "SELECT id, team_id_season, CAST(ROW_NUMBER() OVER (PARTITION BY team_id_season ORDER BY id) AS INT) AS row_number FROM team_rows",
)
def w9(spark: Spark, sf: str) -> DataFrame:
    rows = games_plan.team_rows(a.games(spark, sf)).select("id", "team_id_season")
    layout = ordered.measure_layout(rows, ["team_id_season"], ["id"])
    return ordered.row_numbers(rows, layout, "row_number")


@query("w10_share_of_group", "SELECT l_orderkey, l_linenumber, l_partkey, " + r6("l_quantity / SUM(l_quantity) OVER (PARTITION BY l_orderkey)") + " AS part FROM lineitem")
def w10(spark: Spark, sf: str) -> DataFrame:
    lines = a.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    totals = rel.with_group_agg(lines, ["l_orderkey"], {"total": F.sum("l_quantity")})
    part = scalar.share(F.col("l_quantity"), F.col("total"))
    return rounded(totals.select("l_orderkey", "l_linenumber", "l_partkey", part.alias("part")))


# ---- sort, top-k, union


@query("t1_multi_key_sort", a.with_ctes("games") + "SELECT season_start_year, GW, id FROM games ORDER BY season_start_year, GW DESC, id")
def t1(spark: Spark, sf: str) -> DataFrame:
    return a.games(spark, sf).select("season_start_year", "GW", "id").orderBy(*ordered.sort_columns(["season_start_year", "-GW", "id"]))


@query("t2_top_k", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def t2(spark: Spark, sf: str) -> DataFrame:
    return rel.top_k(a.table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice", 20, "p_partkey")


@query("u1_union_all", a.with_ctes("games") + "SELECT id, team_h AS team FROM games UNION ALL SELECT id, team_a FROM games")
def u1(spark: Spark, sf: str) -> DataFrame:
    games = a.games(spark, sf)
    home = games.select("id", F.col("team_h").alias("team"))
    return home.union(games.select("id", F.col("team_a").alias("team")))


@query("u2_union_missing_columns", a.with_ctes("games", extra={"prev": OLD_SQL, "fresh": NEW_SQL}) + "SELECT id, GW, finished FROM prev UNION ALL SELECT id, NULL, finished FROM fresh")
def u2(spark: Spark, sf: str) -> DataFrame:
    return rel.union_by_name(*snapshots(spark, sf)).select("id", "GW", "finished")


# ---- functions and reshaping


@query("f1_concat", "SELECT n_nationkey, n_name || ' ' || r_name AS playername FROM nation JOIN region ON n_regionkey = r_regionkey")
def f1(spark: Spark, sf: str) -> DataFrame:
    both = a.table(spark, sf, "nation").join(a.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return both.select("n_nationkey", F.concat("n_name", F.lit(" "), "r_name").alias("playername"))


@query("f2_casts", "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text, CAST(o_custkey AS DOUBLE) AS as_number, (o_totalprice > 100000) AS as_flag, CAST(CAST(o_custkey AS VARCHAR) AS INT) AS as_int FROM orders")
def f2(spark: Spark, sf: str) -> DataFrame:
    return a.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("as_text"),
        F.col("o_custkey").cast("double").alias("as_number"),
        (F.col("o_totalprice") > 100000).cast("boolean").alias("as_flag"),
        F.col("o_custkey").cast("string").cast("int").alias("as_int"),
    )


@query("f3_parse_timestamp", "SELECT event_id, CAST(EPOCH(DATE_TRUNC('second', ts)) AS BIGINT) AS seconds FROM events")
def f3(spark: Spark, sf: str) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    moment = scalar.utc_timestamp(iso)
    seconds = F.unix_date(F.to_date(moment)) * F.lit(86400).cast("bigint") + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    return a.table(spark, sf, "events").select("event_id", seconds.alias("seconds"))


@query("f3_parse_offsets", "SELECT event_id, CAST(EPOCH(DATE_TRUNC('second', ts)) AS BIGINT) AS seconds FROM events")
def f3_offsets(spark: Spark, sf: str) -> DataFrame:
    """Times written with offsets that differ by row."""
    hours = F.expr("cast(event_id % 25 as int) - 12")
    local = F.col("ts") + F.make_dt_interval(hours=hours)
    sign = F.when(hours < 0, "-").otherwise("+")
    text = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), sign, F.lpad(F.abs(hours).cast("string"), 2, "0"), F.lit(":00"))
    moment = scalar.utc_timestamp(text)
    seconds = F.unix_date(F.to_date(moment)) * F.lit(86400).cast("bigint") + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    return a.table(spark, sf, "events").select("event_id", seconds.alias("seconds"))


@query("f4_date_parts", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS y, CAST(EXTRACT(MONTH FROM o_orderdate) AS INT) AS m, CAST(STRFTIME(o_orderdate, '%y') AS INT) AS yy, STRFTIME(o_orderdate, '%Y-%m-%d') AS text FROM orders")
def f4(spark: Spark, sf: str) -> DataFrame:
    when = F.col("o_orderdate")
    return a.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date(when).alias("d"), F.year(when).alias("y"), F.month(when).alias("m"),
        scalar.two_digit_year(when).alias("yy"), F.date_format(when, "yyyy-MM-dd").alias("text"),
    )


@query("f5_arithmetic", a.with_ctes("games") + f"SELECT id, 38 - GW AS rounds_left, {r6('CAST(GW AS DOUBLE) / 38')} AS part FROM games")
def f5(spark: Spark, sf: str) -> DataFrame:
    return rounded(a.games(spark, sf).select("id", (F.lit(38) - F.col("GW")).alias("rounds_left"), (F.col("GW") / 38).alias("part")))


@query("f6_safe_rate", a.with_ctes("players") + f"SELECT fixture, element, {r6('CASE WHEN minutes > 0 THEN influence / minutes * 60 ELSE 0 END')} AS rate FROM players")
def f6(spark: Spark, sf: str) -> DataFrame:
    rate = scalar.safe_rate(F.col("influence"), F.col("minutes"))
    return rounded(a.players(spark, sf).select("fixture", "element", rate.alias("rate")))


@query("f7_fill_null", a.with_ctes("games") + "SELECT id, COALESCE(team_h_score, 0) AS team_h_score FROM games")
def f7(spark: Spark, sf: str) -> DataFrame:
    return a.games(spark, sf).select("id", F.coalesce("team_h_score", F.lit(0)).alias("team_h_score"))


@query("f8_floor_ceil_abs", "SELECT c_custkey, CAST(FLOOR(c_acctbal) AS BIGINT) AS low, CAST(CEIL(c_acctbal) AS BIGINT) AS high, ABS(c_acctbal) AS size FROM customer")
def f8(spark: Spark, sf: str) -> DataFrame:
    value = F.col("c_acctbal")
    return a.table(spark, sf, "customer").select("c_custkey", F.floor(value).alias("low"), F.ceil(value).alias("high"), F.abs(value).alias("size"))


@query("f9_round_half_even", "SELECT l_orderkey, l_linenumber, l_partkey, ROUND_EVEN(l_quantity / 8, 2) AS part FROM lineitem")
def f9(spark: Spark, sf: str) -> DataFrame:
    part = scalar.half_even(F.col("l_quantity") / 8)
    return a.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", part.alias("part"))


@query("f10_bins", "SELECT p_partkey, CASE WHEN p_size IS NOT NULL THEN GREATEST(1, LEN(LIST_FILTER([1.0, 10.0, 20.0, 35.0, 50.0], lambda e: e < p_size))) END AS bin FROM part")
def f10(spark: Spark, sf: str) -> DataFrame:
    edges = F.array(*[F.lit(e) for e in (1.0, 10.0, 20.0, 35.0, 50.0)])
    return a.table(spark, sf, "part").select("p_partkey", scalar.bin_index(F.col("p_size"), edges).cast("bigint").alias("bin"))


@query("r1_unpivot", "SELECT l_orderkey, l_linenumber, l_partkey, metric, value FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem) x UNPIVOT (value FOR metric IN (l_quantity, l_discount, l_tax))")
def r1(spark: Spark, sf: str) -> DataFrame:
    measures = ["l_quantity", "l_discount", "l_tax"]
    return a.table(spark, sf, "lineitem").unpivot(["l_orderkey", "l_linenumber", "l_partkey"], measures, "metric", "value")


@query("r2_home_away_rows", a.with_ctes("team_rows") + "SELECT id, team_id_season, team, home, goals_scored, goals_conceded FROM team_rows")
def r2(spark: Spark, sf: str) -> DataFrame:
    return games_plan.team_rows(a.games(spark, sf)).select("id", "team_id_season", "team", "home", "goals_scored", "goals_conceded")
