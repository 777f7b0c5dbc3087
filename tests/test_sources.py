import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from touchline.sources import landed, seasons, snapshots


@pytest.fixture
def bootstrap(tmp_path):
    document = {
        "teams": [{"id": 1, "short_name": "ARS", "name": "Arsenal"}, {"id": 2, "short_name": "AVL", "name": "Villa"}],
        "elements": [
            {"id": 10, "first_name": "Ada", "second_name": "Öst", "element_type": 1, "extra": 5},
            {"id": 11, "first_name": "Bo", "second_name": None, "element_type": 4, "extra": 6},
        ],
        "events": [{"id": 1, "finished": True, "deadline_time": "2023-08-11T17:30:00Z"}, {"id": 2, "finished": False}],
    }
    path = tmp_path / "bootstrap.json"
    path.write_text(json.dumps(document, indent=1), encoding="utf-8")
    return str(path)


@pytest.fixture
def summaries(tmp_path):
    folder = tmp_path / "summaries"
    folder.mkdir()
    for player in (10, 11):
        (folder / f"{player}.json").write_text(json.dumps({
            "history": [{"element": player, "fixture": f, "minutes": 90, "was_home": True} for f in (1, 2)],
            "history_past": [{"season_name": "2021/22", "element_code": 100 + player}],
        }, indent=1))
    return str(folder)


def test_one_document(spark, bootstrap):
    assert [r.short_name for r in landed.read_teams(spark, bootstrap).orderBy("id").collect()] == ["ARS", "AVL"]
    names = {r.id: r.playername for r in landed.read_player_ids(spark, bootstrap).collect()}
    assert names == {10: "Ada Öst", 11: None}
    assert landed.read_player_ids(spark, bootstrap, names=["Ada Öst"]).count() == 1
    assert landed.read_player_names(spark, bootstrap, ids=[11]).first().id == 11
    assert landed.read_player_info(spark, bootstrap, names=["Ada Öst"]).first().element_type == 1
    assert [r.id for r in landed.read_rounds(spark, bootstrap, rounds=[2]).collect()] == [2]


def test_fixtures_resolve_names(spark, bootstrap, tmp_path):
    path = tmp_path / "fixtures.json"
    path.write_text(json.dumps([
        {"event": 1, "id": 5, "team_h": 1, "team_a": 9, "finished": False, "kickoff_time": "2023-08-11T19:00:00Z"},
    ]))
    row = landed.read_fixtures(spark, str(path), landed.read_teams(spark, bootstrap)).first()
    assert (row.home, row.away, row.team_h, row.GW, row.team_h_score) == ("ARS", None, 1, 1, None)
    assert str(row.kickoff) == "2023-08-11 19:00:00"


def test_player_files_take_the_id_from_the_name(spark, bootstrap, summaries):
    players = landed.read_player_ids(spark, bootstrap)
    past = landed.read_player_hist(spark, summaries, players, ids=[10]).collect()
    assert [(r.element_code, r.playername) for r in past] == [(110, "Ada Öst")]
    assert landed.read_player_details(spark, summaries, players).count() == 4
    assert {r.element for r in landed.read_player_details(spark, summaries, players, names=["Ada Öst"]).collect()} == {10}
    with pytest.raises(ValueError):
        landed.read_player_details(spark, summaries, players, ids=[10], names=["Ada Öst"])


def test_seasons_skip_only_missing_ones(spark, tmp_path):
    folder = tmp_path / "player_info" / "season=20"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(",id,element_type,playername,note\n0,1,3.0,Zoë A,x\n1,2,,B C,y\n", encoding="utf-8")

    def reader(season):
        return landed.read_player_info(spark, str(tmp_path), season=season)

    archived = reader(20)
    assert archived.columns == ["id", "element_type", "playername", "note"]
    current = spark.createDataFrame([(7, "D E")], "id bigint, playername string")
    rows = seasons.load_seasons(current, 22, reader, [19, 20, 21]).orderBy("id").collect()
    assert [(r.id, r.season_start_year, r.element_type) for r in rows] == [(1, 20, 3), (2, 20, None), (7, 22, None)]

    def broken(season):
        raise RuntimeError("not a missing path")

    with pytest.raises(RuntimeError):
        seasons.load_seasons(current, 22, broken, [20])


def test_archived_details_filter(spark, tmp_path):
    folder = tmp_path / "player_details" / "season=20"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("fixture,playername,playerid\n1,A,4\n2,B,5\n")
    assert landed.read_player_details(spark, str(tmp_path), season=20, ids=[5]).first().fixture == 2
    assert landed.read_player_details(spark, str(tmp_path), season=20, names=["A"]).first().fixture == 1


def test_incomplete_version_is_ignored(spark, tmp_path):
    root = str(tmp_path / "store")
    assert snapshots.read_snapshot(spark, root, "t") is None
    assert snapshots.write_snapshot(spark.range(3).toDF("id"), root, "t") == 1
    (tmp_path / "store" / "t" / "version=2").mkdir()
    assert snapshots.read_snapshot(spark, root, "t").count() == 3
    assert snapshots.write_snapshot(spark.range(4).toDF("id"), root, "t") == 3
    assert snapshots.read_snapshot(spark, root, "t").count() == 4


def test_writers_take_different_versions(spark, tmp_path):
    from multiprocessing.pool import ThreadPool

    root = str(tmp_path / "store")
    with ThreadPool(4) as pool:
        versions = pool.map(lambda k: snapshots.write_snapshot(spark.range(k).toDF("id"), root, "t"), [5, 6, 7, 8])
    assert sorted(versions) == [1, 2, 3, 4]
    assert snapshots.read_snapshot(spark, root, "t").count() in (5, 6, 7, 8)


def test_csv_columns_go_by_name(spark, tmp_path):
    folder = tmp_path / "games" / "season=20"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("id,team_h,home\n1,5,A\n")
    (folder / "b.csv").write_text(",team_h,id,extra\n0,9,3,x\n")
    rows = landed.read_fixtures(spark, str(tmp_path), season=20).orderBy("id").collect()
    assert [(r.id, r.team_h, r.home, r.extra) for r in rows] == [(1, 5, "A", None), (3, 9, None, "x")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_in_any_session_zone(spark, zone):
    from touchline.functions.scalar import utc_timestamp

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = {"2023-11-05T06:30:00Z": "2023-11-05 06:30:00", "2023-03-12T02:30:00": "2023-03-12 02:30:00",
                 "2023-11-05T01:30:00-05:00": "2023-11-05 06:30:00", "2024-01-01 00:15:00.5+0530": "2023-12-31 18:45:00.500000",
                 "2023-11-05": "2023-11-05 00:00:00"}
        table = spark.createDataFrame([(t,) for t in texts], "t string")
        got = {r.t: str(r.u) for r in table.select("t", utc_timestamp(F.col("t")).alias("u")).collect()}
        assert got == texts
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_results_keep_other_parts(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([("a", 1.0)], "Metric string, `Metric value` double")
    snapshots.write_result(one, root, "metrics", "label_1", "Decision Tree")
    snapshots.write_result(one, root, "metrics", "label_2", "Decision Tree")
    snapshots.write_result(one.withColumn("Metric value", F.lit(2.0)), root, "metrics", "label_1", "Decision Tree")
    found = {r.label: r["Metric value"] for r in snapshots.read_results(spark, root, "metrics").collect()}
    assert found == {"label_1": 2.0, "label_2": 1.0}


def test_players_are_broadcast_to_their_documents_or_joined(spark, tmp_path, monkeypatch):
    """Documents are not shuffled while players are few; both ways give the same, unknown players and repeated names included."""
    lines = [json.dumps({"id": p, "history": [{"element": p, "fixture": f, "minutes": 1.0 * f} for f in range(p)]}) for p in range(6)]
    (tmp_path / "history.json").write_text("\n".join(lines))
    known = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", 5), (None, 4), ("e", 9)], "playername string, id bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = landed.read_player_details(spark, str(tmp_path), known, multi_line=False)
        assert "Exchange hashpartitioning" not in few._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(landed, "MAX_BROADCAST_PLAYERS", 0)
        many = landed.read_player_details(spark, str(tmp_path), known, multi_line=False)
        assert "Exchange hashpartitioning" in many._jdf.queryExecution().executedPlan().toString()
        rows = sorted(map(str, few.select("element", "fixture", "playername").collect()))
        assert rows == sorted(map(str, many.select("element", "fixture", "playername").collect())) and len(rows) == 1 + 3 + 3 + 5 + 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_documents_are_landed_compressed(spark, tmp_path):
    """A row takes some 300 bytes as JSON; on disk it takes less than a third."""
    from checks import adapters
    from checks.landed import chunk_of, land

    rows = adapters.details(spark, "/root/testdata/sf0.001").select("element", "fixture", "minutes", "influence", "creativity", "threat", "selected")
    path = land(rows, "history", chunk_of("fixture"), rows.columns, "history", "element")
    text = spark.read.text(path).agg(F.sum(F.length("value"))).first()[0]
    held = sum(p.stat().st_size for p in Path(path.removeprefix("file:")).rglob("part-*"))
    assert 0 < held < text / 3
