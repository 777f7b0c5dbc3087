"""Quirks of the composite queries on hand-made tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from touchline.plans import features, form, games as games_plan, players, refresh, standings

GAMES = (
    "id bigint, season_start_year int, kickoff timestamp_ntz, team_h bigint, team_a bigint, home string, away string, "
    "GW int, finished boolean, team_h_score int, team_a_score int"
)


def game(id, day, h, a, hs=None, as_=None, season=22, finished=True, hour=15):
    kickoff = None if day is None else datetime(2000 + season, 8, day, hour)
    return (id, season, kickoff, h, a, f"T{h}", f"T{a}", 1, finished, hs, as_)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), GAMES)


def test_unplayed_game_has_no_result(spark):
    base = games_plan.games_base(table(spark, game(1, 5, 1, 2, finished=None), game(2, 5, 1, 2, finished=False))).orderBy("id")
    rows = base.collect()
    assert [(r.label_1, r.label_X, r.label_2) for r in rows] == [(0, 0, 0)] * 2
    assert [r.train_score for r in rows] == ["train", "score"]  # an unknown state counts as finished
    team = games_plan.team_games(table(spark, game(1, 5, 1, 2), game(2, 6, 1, 3, 2, 0))).filter("team_id_season = 1")
    home, _ = form.overall_form(team, 3)
    latest = home.filter("next_id is null").first()
    assert latest.win_share_latest_3_games_overall_home_team == 0.5
    assert latest.avg_goals_scored_latest_3_games_overall_home_team == 2.0  # missing goals are skipped


def test_form_before_equals_form_joined_on_next_game(spark):
    rows = [game(i, 1 + i % 28, 1 + i % 3, 4 + i % 2, i % 4, i % 3) for i in range(40)]
    games = table(spark, *rows)
    layout, _ = games_plan.team_layouts(games)
    tg = games_plan.team_games(games, layout)
    home, _ = form.overall_form(tg, 5, layout)
    shifted = form.form_before(games_plan.team_rows(games), 5, layout)
    a = {(r.next_id, r.team_id_season): tuple(r)[3:] for r in home.filter("next_id is not null").collect()}
    b = {(r.id, r.team_id_season): tuple(r[m] for m in form.MEASURES.values()) for r in shifted.collect()}
    assert a == b


def test_venue_form_looks_over_seasons(spark):
    games = table(spark, game(1, 5, 1, 2, 1, 0, season=21), game(7, 5, 1, 2, 0, 0, season=22))
    tg = games_plan.team_games(games)
    over = form.venue_form(tg, 5, True).filter("season_start_year = 21").first()
    assert over.next_id_home == 7
    bounded = form.venue_form(tg, 5, True, season_bounded=True).filter("season_start_year = 21").first()
    assert bounded.next_id_home is None


def test_first_game_of_a_day_stands(spark):
    games = table(spark, game(1, 5, 1, 2, 1, 0, hour=12), game(2, 5, 1, 2, 1, 0, hour=18), game(3, 9, 1, 2, 0, 0),
                  game(4, None, 1, 2))
    found = standings.league_table(games_plan.team_rows(games), ranks={"win": 1}).orderBy("position").collect()
    assert [(r.team_id_season, r.team_points, r.number_of_games, r.points_to_team_above, r.points_to_team_below) for r in found] == [
        (1, 3, 1, 0, 3), (2, 0, 1, -3, 0)]
    assert standings.league_table(games_plan.team_rows(games)).count() == 0  # nobody holds rank 18


def test_equal_points_go_by_team(spark):
    games = table(spark, game(1, 5, 3, 4, 1, 1), game(2, 6, 1, 2, 0, 0), game(3, 9, 1, 2, 0, 0))
    last = standings.league_table(games_plan.team_rows(games), ranks={"win": 1}).filter(F.dayofmonth("next_kickoff_date") == 9)
    assert [r.team_id_season for r in last.orderBy("position").collect()] == [1, 2, 3, 4]


def test_nobody_played(spark):
    """A team without minutes gets null impact, which maxima skip."""
    columns = "season_start_year int, team_id_season bigint, fixture bigint, minutes double, influence double"
    rows = [(22, 1, 1, 0.0, 5.0), (22, 1, 2, 90.0, 5.0), (22, None, 3, None, 1.0)]
    impact = players.player_impact(spark.createDataFrame(rows, columns), ["influence"]).orderBy("fixture").collect()
    assert [r.impact_game_influence for r in impact] == [None, 5.0, None]
    rates = players.hourly_rate(spark.createDataFrame(rows, columns), ["influence"]).orderBy("fixture").collect()
    assert [r.hourly_rate_influence for r in rates] == [0.0, 5.0 / 90 * 60, 0.0]


def test_group_totals_with_a_null_key(spark):
    from touchline.operators.relational import with_group_agg

    rows = spark.createDataFrame([(1, 2), (1, 3), (None, 4), (None, 5)], "k int, v int")
    found = with_group_agg(rows, ["k"], {"t": F.sum("v")}).orderBy("v").collect()
    assert [r.t for r in found] == [5, 5, 9, 9]


def test_position_maxima(spark):
    from touchline.operators.relational import group_max_by

    rows = spark.createDataFrame(
        [(1, "G", 1.0, 9.0), (1, "D", 5.0, None), (1, "D", 7.0, None), (1, None, 8.0, 1.0), (2, "M", None, 2.0), (None, "G", 1.0, 1.0)],
        "k int, p string, x double, y double")
    out = group_max_by(rows, ["k"], "p", [("all_", None, ["x", "y"]), ("g_", "G", ["x"]), ("d_", "D", ["y"]), ("m_", "M", ["y"])])
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(1, 8.0, 9.0, 1.0, None, None), (2, None, 2.0, None, None, 2.0)]


def test_next_games_are_first_for_either_team(spark):
    score = table(spark, game(3, 9, 1, 2), game(2, 20, 2, 3), game(5, 8, 1, 3), game(6, 8, 4, 3))
    assert sorted(r.id for r in features.next_games(score).collect()) == [2, 3, 6]


def test_refresh_keeps_survivors_and_takes_newer(spark):
    columns = "id int, name string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], columns)
    new = spark.createDataFrame([(2, "c"), (3, "d"), (None, "m")], columns)
    found = {r.id: r.name for r in refresh.refresh(old, new, ["id"]).collect()}
    assert found == {1: "a", 2: "c", 3: "d", None: "m"}
    assert refresh.refresh(None, new, ["id"]).count() == 3


def test_season_range(spark):
    games = table(spark, game(1, 5, 1, 2, season=22), game(2, 5, 1, 2, season=23), game(3, None, 1, 2, season=1))
    row = refresh.season_range(games).first()
    assert (row.current_season, row.previous_seasons) == (22, [18, 19, 20, 21])


def test_feature_table_has_320_columns(spark):
    from checks.composites import feature_data

    columns = feature_data(spark, "/root/testdata/sf0.001").columns
    assert len(columns) == len(set(columns)) == 320
    assert sum(c.startswith("player_diff_") for c in columns) == 82
    assert sum(c.startswith("tbl_home_") for c in columns) == 13 + 6


def test_the_last_of_repeated_keys_stays(spark, tmp_path):
    """Inside one snapshot, in the order of its document."""
    import json

    from touchline.sources import landed

    path = tmp_path / "bootstrap.json"
    items = [{"id": k % 4, "first_name": f"n{k}", "second_name": "x", "element_type": 1} for k in range(40)]
    path.write_text(json.dumps({"elements": items}))
    new = landed.read_player_ids(spark, str(path))
    got = {r.id: r.playername for r in refresh.refresh(None, new, ["id"]).collect()}
    assert got == {k: f"n{36 + k} x" for k in range(4)}
    old = spark.createDataFrame([(0, "old"), (9, "a"), (9, "b")], "id bigint, playername string")
    got = {r.id: r.playername for r in refresh.refresh(old, new, ["id"]).collect()}
    assert got == {0: "n36 x", 1: "n37 x", 2: "n38 x", 3: "n39 x", 9: "b"}


def test_landing_and_building(spark, tmp_path):
    from touchline.plans import landing
    from touchline.sources.snapshots import read_snapshot

    root = str(tmp_path)
    current = table(spark, *[game(k, 1 + k % 20, 1 + k % 2, 2 - k % 2, 1, 0) for k in range(8)]).drop("season_start_year")
    archived = table(spark, game(1, 3, 1, 2, 0, 0, season=21)).drop("season_start_year")

    def archive(season):
        if season != 21:
            return spark.read.csv(str(tmp_path / "none"))
        return archived

    assert landing.land_all(spark, root, {"games": current}, {"games": archive}) == {"games": 1}
    assert read_snapshot(spark, root, "games").groupBy("season_start_year").count().orderBy("season_start_year").collect() == [(21, 1), (22, 8)]
    assert landing.land_all(spark, root, {"games": current.withColumn("GW", F.lit(7))}) == {"games": 2}
    assert read_snapshot(spark, root, "games").filter("season_start_year = 22 and GW = 7").count() == 8
    assert read_snapshot(spark, root, "games").filter("season_start_year = 21").count() == 1
    with pytest.raises(ValueError, match="player_details"):
        landing.build_data(spark, root)


def test_filter_by_a_table(spark, monkeypatch):
    """Values in a table are joined, with repeats and nulls, and none of them come to the driver."""
    from checks.relational import p7_long
    from touchline.operators.relational import filter_in

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (4, "e")], "k long, v string")
    wanted = spark.createDataFrame([(2,), (2,), (4,), (None,), (9,)], "other int")
    got = filter_in(rows, "k", wanted)
    assert got.columns == ["k", "v"] and sorted(r.v for r in got.collect()) == ["b", "c", "e"]
    with monkeypatch.context() as m:
        m.setattr(type(rows), "collect", lambda *_: 1 / 0)
        found = p7_long(spark, "/root/testdata/sf0.001")
    assert {r.o_orderkey % 5 for r in found.collect()} == {2}


def player_tables(spark):
    """Fixtures 1 and 2 in two seasons; player 2 has two positions in season 22, player 3 is unknown there."""
    details = spark.createDataFrame(
        [(s, p, f, p % 2 == 0, 30.0 * p, *[float(p + f)] * 11) for s in (21, 22) for p in (1, 2, 3, 4) for f in (1, 2)],
        "season_start_year int, element bigint, fixture bigint, was_home boolean, minutes double, "
        + ", ".join(f"{c} double" for c in players.RATE_COLUMNS + players.IMPACT_COLUMNS))
    details = details.withColumn("kickoff_time", F.make_date(F.lit(2022), F.lit(8), F.col("fixture").cast("int")).cast("timestamp_ntz"))
    known = [(21, 1, 1), (21, 2, 2), (21, 3, 3), (21, 4, 9), (22, 1, 1), (22, 2, 2), (22, 2, 3), (22, 4, 4), (None, 1, 2)]
    info = spark.createDataFrame(known, "season_start_year int, id bigint, element_type int")
    games = table(spark, *[game(f, f, 7, 8, 1, 0, season=s) for s in (21, 22) for f in (1, 2)])
    return details, info, games_plan.team_games(games)


def test_positions_are_the_same_broadcast_and_joined(spark, monkeypatch):
    details, info, team_games = player_tables(spark)
    columns = ["season_start_year", "player_id", "fixture", "position", "team_id_season", "next_id"]
    few = sorted(map(tuple, players.player_games(details, info, team_games).select(columns).collect()), key=str)
    monkeypatch.setattr(players, "MAX_BROADCAST_POSITIONS", 0)
    many = sorted(map(tuple, players.player_games(details, info, team_games).select(columns).collect()), key=str)
    assert few == many and len(few) == 16
    assert [(r[3], r[4], r[5]) for r in few if r[:3] == (22, 2, 1)] == [("D", 7, 2), ("M", 7, 2)]
    assert not [r for r in few if r[:2] == (22, 3)] and (21, 4, 2, "F", 7, None) in few


def test_rolled_player_values_move_once(spark):
    """The maxima of a team's next game need one shuffle of the rolled values, by that game; cut players give the same."""
    details, info, team_games = player_tables(spark)
    found = players.team_player_stats(details, info, team_games, 2)
    exchanges = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x and "next_id" in x]
    assert len(exchanges) == 1 and "hashpartitioning(next_id" in exchanges[0]
    rows = sorted(map(tuple, found.collect()))
    assert [r[:3] for r in rows] == [(21, 7, 2), (21, 8, 2), (22, 7, 2), (22, 8, 2)]
    spark.conf.set("spark.touchline.rowsPerBlock", "1")
    try:
        assert sorted(map(tuple, players.team_player_stats(details, info, team_games, 2).collect())) == rows
    finally:
        spark.conf.unset("spark.touchline.rowsPerBlock")


def test_player_rows_stay_with_their_game(spark):
    """Rows that lie by fixture get position, team and the team's minutes there; only the team rows move."""
    details, info, team_games = player_tables(spark)
    found = players.player_measures(players.player_games(details.repartition("fixture"), info, team_games))
    plan = found._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "team_id_season" not in line]
    assert len(wide) == 2 and all("fixture" in line or "id#" in line for line in wide)
    total = {(r.season_start_year, r.fixture, r.team_id_season): r.team_total_minutes for r in found.collect()}
    assert total[21, 1, 7] == 180.0 and total[22, 1, 7] == 240.0 and total[22, 1, 8] == 30.0


def test_join_where_rows_were_dealt(spark):
    """Equal to the join on all keys, with repeated ids, nulls and rows without a partner; the left rows stay."""
    from touchline.operators.relational import join_on, join_where_dealt

    rows = [(None if k % 7 == 0 else k % 5, None if k % 11 == 0 else k % 3, f"t{k % 2}", k) for k in range(60)]
    left = spark.createDataFrame(rows, "id int, season int, team string, v int").repartition("id")
    right = spark.createDataFrame(rows[::3], "game int, year int, side string, w int")
    pairs = [("season", "year"), ("team", "side")]
    for how in ("inner", "left"):
        expected = join_on(left, right, [("id", "game"), *pairs], how)
        found = join_where_dealt(left, right, ("id", "game"), pairs, how)
        assert found.columns == expected.columns == ["id", "season", "team", "v", "w"]
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = join_where_dealt(left, right, ("id", "game"), pairs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and "season" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_features_are_joined_where_player_values_lie(spark):
    """No shuffle of the wide feature rows: none goes by season and the teams of a game."""
    from checks.composites import feature_data

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = feature_data(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [x.partition("hashpartitioning")[2] for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert dealt and not [x for x in dealt if "season" in x and ("team_h" in x or "team_a" in x)]
