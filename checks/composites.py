"""Composite queries: games, form, standings, players, features, refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters as a
from checks.registry import query, r6, rounded
from touchline.functions.scalar import interactions
from touchline.plans import features, form, games as games_plan, players as players_plan, refresh, standings

Spark = SparkSession



def _team_games(spark: Spark, sf: str) -> DataFrame:
    return games_plan.team_games(a.games(spark, sf))


BASE_SQL = """
SELECT season_start_year, CAST(kickoff AS DATE) AS kickoff_date, GW, id, team_h, team_a,
       CASE WHEN COALESCE(finished, TRUE) THEN 'train' ELSE 'score' END AS train_score,
       CASE WHEN team_h_score > team_a_score THEN 1 ELSE 0 END AS label_1,
       CASE WHEN team_h_score = team_a_score THEN 1 ELSE 0 END AS "label_X",
       CASE WHEN team_h_score < team_a_score THEN 1 ELSE 0 END AS label_2,
       home, away, CAST(season_start_year AS VARCHAR) AS season,
       CAST(EXTRACT(YEAR FROM kickoff) AS INT) AS kickoff_year, CAST(EXTRACT(MONTH FROM kickoff) AS INT) AS kickoff_month,
       38 - GW AS rounds_left
FROM games
"""


@query("k1_games_base", a.with_ctes("games") + BASE_SQL)
def k1(spark: Spark, sf: str) -> DataFrame:
    return games_plan.games_base(a.games(spark, sf))


TEAM_COLUMNS = ["id", "season_start_year", "team_id_season", "team", "home", "win", "draw", "loss",
                "goals_scored", "goals_conceded", "next_id"]


@query("k2_team_games", a.with_ctes("team_games") + f"SELECT {', '.join(TEAM_COLUMNS)} FROM team_games")
def k2(spark: Spark, sf: str) -> DataFrame:
    return _team_games(spark, sf).select(TEAM_COLUMNS)


def form_sql(n: int, scope: str, side: str, source: str, next_id: str, rounding: bool = True) -> str:
    def mean(column: str) -> str:
        over = f"AVG({column}) OVER (PARTITION BY season_start_year, team_id_season ORDER BY kickoff, id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        return r6(over) if rounding else over

    measures = ",\n".join(
        f"{mean(c)} AS {stem}_latest_{n}_games_{scope}_{side}_team" for c, stem in form.MEASURES.items()
    )
    return f"SELECT team_id_season, {next_id}, season_start_year, {measures} FROM {source}"


@query("k3_overall_form", a.with_ctes("team_games") + form_sql(5, "overall", "home", "team_games", "next_id"))
def k3(spark: Spark, sf: str) -> DataFrame:
    games = a.games(spark, sf)
    layout, _ = games_plan.team_layouts(games)
    home, _ = form.overall_form(games_plan.team_games(games, layout), 5, layout)
    return rounded(home)


@query("k3_overall_form_away", a.with_ctes("team_games") + form_sql(5, "overall", "away", "team_games", "next_id"))
def k3_away(spark: Spark, sf: str) -> DataFrame:
    games = a.games(spark, sf)
    layout, _ = games_plan.team_layouts(games)
    _, away = form.overall_form(games_plan.team_games(games, layout), 5, layout)
    return rounded(away)


def venue_rows(home: bool) -> str:
    side = "home" if home else "away"
    return (
        f"SELECT *, LEAD(id) OVER (PARTITION BY team_id_season ORDER BY season_start_year, kickoff, id) AS next_id_{side} "
        f"FROM team_games WHERE home = {int(home)}"
    )


@query(
    "k4_venue_form",
    a.with_ctes("team_games", extra={"venue": venue_rows(True)})
    + form_sql(5, "home", "home", "venue", "next_id_home"),
)
def k4(spark: Spark, sf: str) -> DataFrame:
    return rounded(form.venue_form(_team_games(spark, sf), 5, True))


@query(
    "k4_venue_form_away",
    a.with_ctes("team_games", extra={"venue": venue_rows(False)})
    + form_sql(3, "away", "away", "venue", "next_id_away"),
)
def k4_away(spark: Spark, sf: str) -> DataFrame:
    return rounded(form.venue_form(_team_games(spark, sf), 3, False))


# The literal plan: every row with every later date of the season, then the newest row per team and date.
STANDINGS = {
    "running": """
SELECT season_start_year, kickoff, id, CAST(kickoff AS DATE) AS kickoff_date, team_id_season,
       CASE WHEN win = 1 THEN 3 WHEN draw = 1 THEN 1 ELSE 0 END AS points_from_last_game,
       CAST(SUM(CASE WHEN win = 1 THEN 3 WHEN draw = 1 THEN 1 ELSE 0 END)
            OVER (PARTITION BY season_start_year, team_id_season ORDER BY kickoff, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS team_points,
       COUNT(*) OVER (PARTITION BY season_start_year, team_id_season ORDER BY kickoff, id ROWS UNBOUNDED PRECEDING) AS number_of_games
FROM team_games""",
    "dates": "SELECT DISTINCT season_start_year, kickoff_date AS next_kickoff_date FROM running",
    "latest": """
SELECT * FROM (
  SELECT r.*, d.next_kickoff_date, 38 - number_of_games AS games_left_season,
         ROW_NUMBER() OVER (PARTITION BY r.season_start_year, team_id_season, next_kickoff_date
                            ORDER BY kickoff_date DESC, kickoff, id) AS rn
  FROM running r JOIN dates d ON r.season_start_year = d.season_start_year AND r.kickoff_date < d.next_kickoff_date
) x WHERE rn = 1""",
    "ranked": """
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY season_start_year, next_kickoff_date ORDER BY team_points DESC, team_id_season) AS INT) AS position
FROM latest""",
    "held": """
SELECT *, MAX(CASE WHEN position = 1 THEN team_points END) OVER d AS p1, MAX(CASE WHEN position = 4 THEN team_points END) OVER d AS p4,
       MAX(CASE WHEN position = 7 THEN team_points END) OVER d AS p7, MAX(CASE WHEN position = 18 THEN team_points END) OVER d AS p18,
       COALESCE(team_points - LAG(team_points) OVER w, 0) AS points_to_team_above,
       COALESCE(team_points - LEAD(team_points) OVER w, 0) AS points_to_team_below,
       COALESCE(games_left_season - LAG(games_left_season) OVER w, 0) AS games_left_diff_above,
       COALESCE(games_left_season - LEAD(games_left_season) OVER w, 0) AS games_left_diff_below
FROM ranked
WINDOW d AS (PARTITION BY season_start_year, next_kickoff_date),
       w AS (PARTITION BY season_start_year, next_kickoff_date ORDER BY position)""",
    "standings": """
SELECT season_start_year, team_id_season, number_of_games, points_from_last_game, team_points, games_left_season,
       next_kickoff_date, position, points_to_team_above, points_to_team_below, games_left_diff_above, games_left_diff_below,
       team_points - p1 AS points_to_win, team_points - p4 AS points_to_cl, team_points - p7 AS points_to_euro,
       team_points - p18 AS points_to_regulation
FROM held WHERE p1 IS NOT NULL AND p4 IS NOT NULL AND p7 IS NOT NULL AND p18 IS NOT NULL""",
}


@query("k5_league_table", a.with_ctes("team_games", extra=STANDINGS) + "SELECT * FROM standings")
def k5(spark: Spark, sf: str) -> DataFrame:
    return standings.league_table(games_plan.team_rows(a.games(spark, sf)))


RATES_SQL = ", ".join(
    f"CASE WHEN minutes > 0 THEN {c} / minutes * 60 ELSE 0 END AS hourly_rate_{c}" for c in players_plan.RATE_COLUMNS
)
RATE_NAMES = [f"hourly_rate_{c}" for c in players_plan.RATE_COLUMNS]
IMPACT_NAMES = [f"impact_game_{c}" for c in players_plan.IMPACT_COLUMNS + RATE_NAMES]


def _rounded_sql(columns: list[str]) -> str:
    return ", ".join(f"{r6(c)} AS {c}" for c in columns)


@query(
    "k6_hourly_rates",
    a.with_ctes("players", extra={"rates": f"SELECT *, {RATES_SQL} FROM players"})
    + f"SELECT fixture, element, {_rounded_sql(RATE_NAMES)} FROM rates",
)
def k6(spark: Spark, sf: str) -> DataFrame:
    rates = players_plan.hourly_rate(a.players(spark, sf), players_plan.RATE_COLUMNS)
    return rounded(rates.select("fixture", "element", *RATE_NAMES))


PLAYER_VIEWS = {
    "player_games": """
SELECT d.season_start_year, d.element AS player_id, d.fixture, CAST(d.kickoff_time AS DATE) AS kickoff_date,
       t.team_id_season, t.next_id, d.minutes, d.goals_scored, d.assists, d.clean_sheets, d.goals_conceded, d.saves,
       d.influence, d.creativity, d.threat, d.value, d.transfers_balance, d.selected,
       CASE i.element_type WHEN 1 THEN 'G' WHEN 2 THEN 'D' WHEN 3 THEN 'M' ELSE 'F' END AS position
FROM details d
JOIN info i ON d.season_start_year = i.season_start_year AND d.element = i.id
JOIN games g ON d.season_start_year = g.season_start_year AND d.fixture = g.id
JOIN team_games t ON t.season_start_year = g.season_start_year AND t.id = g.id
                 AND t.team_id_season = CASE WHEN d.was_home THEN g.team_h ELSE g.team_a END""",
    "rates": f"SELECT *, {RATES_SQL} FROM player_games",
    "shares": """
SELECT *, minutes / NULLIF(SUM(minutes) OVER (PARTITION BY season_start_year, team_id_season, fixture), 0) AS part FROM rates""",
    "impacts": "SELECT *, "
    + ", ".join(f"{c} * part AS impact_game_{c}" for c in players_plan.IMPACT_COLUMNS + RATE_NAMES)
    + " FROM shares",
}


@query(
    "k7_player_impact",
    a.with_ctes("details", "info", "team_games", extra=PLAYER_VIEWS)
    + f"SELECT season_start_year, player_id, fixture, position, {_rounded_sql(IMPACT_NAMES)} FROM impacts",
)
def k7(spark: Spark, sf: str) -> DataFrame:
    details = a.details(spark, sf)
    played = players_plan.player_games(details, a.info(spark, sf), _team_games(spark, sf))
    return rounded(
        players_plan.player_measures(played).select(
            "season_start_year", "player_id", "fixture", "position", *IMPACT_NAMES
        )
    )


def _stats_views() -> dict[str, str]:
    means, maxima = players_plan.rolling_names(6)
    over = "OVER (PARTITION BY season_start_year, player_id ORDER BY kickoff_date, fixture ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
    rolled = [f"AVG({c}) {over} AS {out}" for out, c in means.items()]
    rolled += [f"MAX({c}) {over} AS {out}" for out, c in maxima.items()]
    names = [*means, *maxima]
    keeper = [f for f in names if any(t in f for t in ("saves", "clean_sheet", "value", "selected", "goals_conceded"))]
    outfield = [f for f in names if f not in keeper]
    best = [f"MAX({f}) AS max_all_{f}" for f in names]
    best += [f"MAX(CASE WHEN position = 'G' THEN {f} END) AS max_g_{f}" for f in keeper]
    for letter in "DMF":
        best += [f"MAX(CASE WHEN position = '{letter}' THEN {f} END) AS max_{letter.lower()}_{f}" for f in outfield]
    return {
        "rolled": f"SELECT *, {', '.join(rolled)} FROM impacts",
        "stats": f"SELECT season_start_year, team_id_season, next_id, {', '.join(best)} FROM rolled "
        "WHERE next_id IS NOT NULL GROUP BY season_start_year, team_id_season, next_id",
    }


STATS_VIEWS = {**PLAYER_VIEWS, **_stats_views()}
STAT_NAMES = [
    prefix + f
    for prefix, _, columns in players_plan.position_blocks([n for names in players_plan.rolling_names(6) for n in names])
    for f in columns
]


@query(
    "k8_team_player_stats",
    a.with_ctes("details", "info", "team_games", extra=STATS_VIEWS)
    + f"SELECT season_start_year, team_id_season, next_id, {_rounded_sql(STAT_NAMES)} FROM stats",
)
def k8(spark: Spark, sf: str) -> DataFrame:
    games = a.games(spark, sf)
    stats = players_plan.team_player_stats(a.details(spark, sf), a.info(spark, sf), games_plan.team_games(games))
    return rounded(stats)


@query(
    "k9_table_interactions",
    a.with_ctes("team_games", extra=STANDINGS)
    + "SELECT season_start_year, team_id_season, next_kickoff_date, "
    + ", ".join(f"{r6(f'(number_of_games * {g}) * (CAST(number_of_games AS DOUBLE) / 38)')} AS nog_{g}" for g in features.GAPS)
    + " FROM standings",
)
def k9(spark: Spark, sf: str) -> DataFrame:
    table = standings.league_table(games_plan.team_rows(a.games(spark, sf)))
    data = interactions(table, features.GAPS, "number_of_games", "nog_")
    keys = ["season_start_year", "team_id_season", "next_kickoff_date"]
    return rounded(data.select(*keys, *[f"nog_{g}" for g in features.GAPS]))


FEATURE_VIEWS = {
    **STANDINGS,
    **STATS_VIEWS,
    "base": BASE_SQL,
    "home_rows": venue_rows(True),
    "away_rows": venue_rows(False),
    "form_h": form_sql(5, "overall", "home", "team_games", "next_id", False),
    "form_a": form_sql(5, "overall", "away", "team_games", "next_id", False),
    "form_hh": form_sql(5, "home", "home", "home_rows", "next_id_home", False),
    "form_aa": form_sql(5, "away", "away", "away_rows", "next_id_away", False),
}
FORM_NAMES = [
    f"{stem}_latest_5_games_{scope}_{side}_team"
    for scope, side in (("overall", "home"), ("overall", "away"), ("home", "home"), ("away", "away"))
    for stem in form.MEASURES.values()
]
TABLE_NAMES = ["number_of_games", "points_from_last_game", "team_points", "games_left_season", "position", "points_to_team_above",
               "points_to_team_below", "games_left_diff_above", "games_left_diff_below", "points_to_win", "points_to_cl",
               "points_to_euro", "points_to_regulation"]
SIDE_TABLES = (("home", "th", "ph"), ("away", "ta", "pa"))
FEATURE_COLUMNS = [
    "b.*", *(f"{r6(c)} AS {c}" for c in FORM_NAMES),
    *(f"{t}.{c} AS tbl_{side}_{c}" for side, t, _ in SIDE_TABLES for c in TABLE_NAMES),
    *(f"{r6(f'({t}.number_of_games * {t}.{c}) * (CAST({t}.number_of_games AS DOUBLE) / 38)')} AS tbl_{side}_nog_tbl_{side}_{c}"
      for side, t, _ in SIDE_TABLES for c in features.GAPS),
    *(f"{r6(f'{p}.{c}')} AS player_{side}_{c}" for side, _, p in SIDE_TABLES for c in STAT_NAMES),
    *(f"{r6(f'ph.{c} - pa.{c}')} AS player_diff_{c}" for c in STAT_NAMES),
]
FEATURES_SQL = a.with_ctes("details", "info", "team_games", extra=FEATURE_VIEWS) + f"""
SELECT {', '.join(FEATURE_COLUMNS)}
FROM base b
JOIN form_h fh ON b.season_start_year = fh.season_start_year AND b.team_h = fh.team_id_season AND b.id = fh.next_id
JOIN form_a fa ON b.season_start_year = fa.season_start_year AND b.team_a = fa.team_id_season AND b.id = fa.next_id
JOIN form_hh hh ON b.season_start_year = hh.season_start_year AND b.team_h = hh.team_id_season AND b.id = hh.next_id_home
JOIN form_aa aa ON b.season_start_year = aa.season_start_year AND b.team_a = aa.team_id_season AND b.id = aa.next_id_away
JOIN standings th ON b.season_start_year = th.season_start_year AND b.team_h = th.team_id_season AND b.kickoff_date = th.next_kickoff_date
JOIN standings ta ON b.season_start_year = ta.season_start_year AND b.team_a = ta.team_id_season AND b.kickoff_date = ta.next_kickoff_date
LEFT JOIN stats ph ON b.season_start_year = ph.season_start_year AND b.team_h = ph.team_id_season AND b.id = ph.next_id
LEFT JOIN stats pa ON b.season_start_year = pa.season_start_year AND b.team_a = pa.team_id_season AND b.id = pa.next_id
"""


def feature_data(spark: Spark, sf: str) -> DataFrame:
    return features.feature_table(a.games(spark, sf), a.details(spark, sf), a.info(spark, sf))


@query("k10_feature_table", FEATURES_SQL)
def k10(spark: Spark, sf: str) -> DataFrame:
    """All 320 columns."""
    return rounded(feature_data(spark, sf))


@query(
    "k11_next_games",
    a.with_ctes("games", extra={"base": BASE_SQL}) + """
, open_games AS (SELECT * FROM base WHERE train_score = 'score'),
sides AS (SELECT team_h AS team, id FROM open_games UNION ALL SELECT team_a, id FROM open_games),
numbered AS (SELECT id, ROW_NUMBER() OVER (PARTITION BY team ORDER BY id) AS rn FROM sides)
SELECT id, season_start_year, team_h, team_a FROM open_games WHERE id IN (SELECT id FROM numbered WHERE rn = 1)
""",
)
def k11(spark: Spark, sf: str) -> DataFrame:
    base = games_plan.games_base(a.games(spark, sf))
    return features.score_set(base).select("id", "season_start_year", "team_h", "team_a")


# Two overlapping snapshots: one taken at the start of 1999, one that starts in 1997 and lacks GW.
OLD_SQL = "SELECT id, season_start_year, team_h, team_a, GW, finished, team_h_score FROM games WHERE season_start_year < 1999"
NEW_SQL = "SELECT id, season_start_year, team_h, team_a, finished, team_h_score + 10 AS team_h_score FROM games WHERE season_start_year >= 1997"


def snapshots(spark: Spark, sf: str) -> tuple[DataFrame, DataFrame]:
    games = a.games(spark, sf)
    columns = ["id", "season_start_year", "team_h", "team_a", "GW", "finished", "team_h_score"]
    old = games.filter(F.col("season_start_year") < 1999).select(columns)
    new = games.filter(F.col("season_start_year") >= 1997).select(columns).drop("GW")
    return old, new.withColumn("team_h_score", F.col("team_h_score") + 10)


@query(
    "k12_refresh_games",
    a.with_ctes("games", extra={"prev": OLD_SQL, "fresh": NEW_SQL}) + """
, both_versions AS (
  SELECT id, season_start_year, team_h, team_a, GW, finished, team_h_score, 0 AS v FROM prev WHERE finished
  UNION ALL SELECT id, season_start_year, team_h, team_a, NULL, finished, team_h_score, 1 FROM fresh),
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY id, team_h, team_a, season_start_year ORDER BY v DESC) AS rn FROM both_versions)
SELECT id, season_start_year, team_h, team_a, GW, finished, team_h_score FROM numbered WHERE rn = 1
""",
)
def k12(spark: Spark, sf: str) -> DataFrame:
    return refresh.refresh_games(*snapshots(spark, sf))


@query(
    "k13_season_range",
    a.with_ctes("games", extra={"c": "SELECT MIN(CAST(EXTRACT(YEAR FROM kickoff) AS INT) % 100) AS s FROM games"})
    + "SELECT s AS current_season, s - 4 AS first_season, s - 1 AS last_season FROM c",
)
def k13(spark: Spark, sf: str) -> DataFrame:
    seasons = F.col("previous_seasons")
    return refresh.season_range(a.games(spark, sf)).select(
        "current_season", F.get(seasons, 0).alias("first_season"), F.get(seasons, 3).alias("last_season")
    )


@query(
    "k14_upsert_predictions",
    a.with_ctes("games") + """
, keyed AS (SELECT DISTINCT CAST(kickoff AS DATE) AS kickoff_date, home, away, season_start_year FROM games),
numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY kickoff_date, home, away ORDER BY v DESC) AS rn FROM (
    SELECT kickoff_date, home, away, CAST(0.25 AS DOUBLE) AS proba_1_fix, 0 AS v FROM keyed WHERE season_start_year < 1999
    UNION ALL SELECT kickoff_date, home, away, CAST(0.5 AS DOUBLE), 1 FROM keyed WHERE season_start_year >= 1997))
SELECT kickoff_date, home, away, proba_1_fix FROM numbered WHERE rn = 1
""",
)
def k14(spark: Spark, sf: str) -> DataFrame:
    keyed = a.games(spark, sf).select(F.to_date("kickoff").alias("kickoff_date"), "home", "away", "season_start_year").distinct()
    old = keyed.filter(F.col("season_start_year") < 1999).withColumn("proba_1_fix", F.lit(0.25))
    new = keyed.filter(F.col("season_start_year") >= 1997).withColumn("proba_1_fix", F.lit(0.5))
    return refresh.upsert_predictions(old, new).drop("season_start_year")
