"""One row per game, and one row per team and game."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.scalar import flag
from touchline.operators.ordered import GroupLayout, lead_by, measure_layout, measure_within

TEAM = ["season_start_year", "team_id_season"]
PLAYED_ORDER = ["kickoff", "id"]


def games_base(games: DataFrame, season_games: int = 38) -> DataFrame:
    """Keys, outcome labels and calendar features of every game (16 columns)."""
    home_goals, away_goals = F.col("team_h_score"), F.col("team_a_score")
    return games.select(
        "season_start_year",
        F.to_date("kickoff").alias("kickoff_date"),
        "GW",
        "id",
        "team_h",
        "team_a",
        # An unknown state counts as finished.
        F.when(F.coalesce("finished", F.lit(True)), "train").otherwise("score").alias("train_score"),
        flag(home_goals > away_goals).alias("label_1"),
        flag(home_goals == away_goals).alias("label_X"),
        flag(home_goals < away_goals).alias("label_2"),
        "home",
        "away",
        F.col("season_start_year").cast("string").alias("season"),
        F.year("kickoff").alias("kickoff_year"),
        F.month("kickoff").alias("kickoff_month"),
        (F.lit(season_games) - F.col("GW")).alias("rounds_left"),
    )


def team_rows(games: DataFrame) -> DataFrame:
    """Each game as two rows, one per team, from a single scan.

    An unplayed game has result flags 0 and no goals.
    """

    def side(is_home: int, team: str, name: str, scored: str, conceded: str):
        return F.struct(
            F.col(team).alias("team_id_season"),
            F.col(name).alias("team"),
            F.lit(is_home).alias("home"),
            flag(F.col(scored) > F.col(conceded)).alias("win"),
            flag(F.col(scored) == F.col(conceded)).alias("draw"),
            flag(F.col(scored) < F.col(conceded)).alias("loss"),
            F.col(scored).alias("goals_scored"),
            F.col(conceded).alias("goals_conceded"),
        )

    both = F.array(
        side(1, "team_h", "home", "team_h_score", "team_a_score"),
        side(0, "team_a", "away", "team_a_score", "team_h_score"),
    )
    used = {"team_h", "team_a", "home", "away", "team_h_score", "team_a_score"}
    kept = [c for c in games.columns if c not in used]
    return games.select(*kept, F.inline(both))


def team_layouts(games: DataFrame) -> tuple[GroupLayout, GroupLayout]:
    """Measured groups of (season, team) and of team alone, in playing order.

    Shared by everything built on team rows. Usually one count by team shows that nothing needs a cut.
    """
    rows = team_rows(games)
    by_team = measure_layout(rows, TEAM[1:], [TEAM[0], *PLAYED_ORDER])
    return measure_within(rows, by_team, TEAM, PLAYED_ORDER), by_team


def team_games(games: DataFrame, layout: GroupLayout | None = None) -> DataFrame:
    """Team rows with ``next_id``, the team's next game of the season."""
    rows = team_rows(games)
    return lead_by(rows, layout or measure_layout(rows, TEAM, PLAYED_ORDER), "id", "next_id")
