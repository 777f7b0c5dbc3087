import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from touchline.ml import explain, metrics, models, preprocess, search, significance
from touchline.ml.fold_statistics import ALL, held_out_quantiles
from touchline.ml.split import sizes, split
from touchline.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def numbers(spark):
    r = random.Random(3)
    rows = []
    for i in range(400):
        y = int(r.random() < 0.4)
        rows.append((i, y, r.gauss(y, 1), None if i % 9 == 0 else float(r.randint(0, 40)), r.randint(0, 3), "ab"[y] if r.random() < 0.8 else "c", r.random()))
    return spark.createDataFrame(rows, "id int, y int, a double, b double, few int, text string, noise double").cache()


@pytest.mark.parametrize("accuracy", [10_000, 40])
def test_bracketed_quantiles_are_exact(spark, numbers, accuracy):
    probs = [0.0, 0.2, 0.5, 0.8, 0.95, 1.0]
    found = exact_quantiles(numbers, ["a", "b", "few"], probs, accuracy=accuracy)
    local = numbers.toPandas()
    for c in ("a", "b", "few"):
        assert np.allclose(found[c], np.nanquantile(local[c].astype(float), probs))
    direct = exact_quantiles(numbers, ["a", "b", "few"], probs)
    assert all(np.allclose(found[c], direct[c]) for c in direct)


def test_quantiles_of_a_mostly_constant_column(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 0.0).otherwise(F.col("id").cast("double")).alias("x"))
    want = np.quantile(rows.toPandas()["x"], [0.1, 0.5, 0.7, 0.9])
    assert np.allclose(exact_quantiles(rows, ["x"], [0.1, 0.5, 0.7, 0.9], accuracy=100)["x"], want)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 17, 4000])
def test_split_sizes(spark, n):
    parts = {r.split: r["count"] for r in split(spark.range(n), ["id"]).groupBy("split").count().collect()}
    assert tuple(parts.get(p, 0) for p in ("train", "test", "validation")) == sizes(n)
    moved = split(spark.range(n).repartition(3), ["id"]).filter("split = 'test'")
    assert set(moved.collect()) == set(split(spark.range(n), ["id"]).filter("split = 'test'").collect())


def test_tests_equal_the_built_in_statistics(spark, numbers):
    """The same F and p as Spark's own selection statistics."""
    jvm = spark._jvm.org.apache.spark.ml.stat
    levels = numbers.select(F.array(F.ascii("text").cast("double")).alias("l"), F.array(F.col("y").cast("double")).alias("f"))
    from pyspark.ml.functions import array_to_vector

    frame = levels.select(array_to_vector("f").alias("features"), F.col("l")[0].alias("label"))
    want = jvm.ANOVATest.test(frame._jdf, "features", "label").collect()[0]
    got = significance.with_p_values(significance.anova_oneway(numbers, ["text"], "y")).first()
    assert got.F == pytest.approx(want.getAs("fValues").apply(0), rel=1e-9)
    assert got.p == pytest.approx(want.getAs("pValues").apply(0), rel=1e-6)

    frame = numbers.select(array_to_vector(F.array("a")).alias("features"), F.col("y").cast("double").alias("label"))
    want = jvm.FValueTest.test(frame._jdf, "features", "label").collect()[0]
    got = significance.with_p_values(significance.f_regression(numbers, ["a"], "y")).first()
    assert got.F == pytest.approx(want.getAs("fValues").apply(0), rel=1e-9)
    assert got.p == pytest.approx(want.getAs("pValues").apply(0), rel=1e-6)


def test_f_survival_limits():
    assert significance.f_survival(0.0, 3, 10) == 1.0
    assert significance.f_survival(math.inf, 3, 10) == 0.0
    assert significance.f_survival(None, 3, 10) is None and significance.f_survival(1.0, 0, 10) is None
    assert significance.f_survival(4.96, 1, 10) == pytest.approx(0.05, abs=2e-4)


def test_selection_kinds(spark, numbers):
    assert significance.few_valued(numbers, ["a", "b", "few"]) == ["few"]
    selected, tests = significance.select_features(numbers, "y", ["id"])
    assert {"a", "text"} <= set(selected) and "noise" not in selected
    assert tests.count() == 5
    constant = numbers.withColumn("one", F.lit(1.0)).withColumn("none", F.lit(None).cast("double"))
    assert significance.select_features(constant, "y", ["id"])[0] == selected


def test_components_equal_numpy(spark, numbers):
    scaled = preprocess.standardise(numbers.fillna(0.0, ["b"]), ["a", "b", "noise"])
    model = PipelineModel(preprocess.pca_block(scaled, ["z_a", "z_b", "z_noise"], "games", 2))
    got = np.array(model.transform(scaled).orderBy("id").select(vector_to_array("games_pca").alias("v")).toPandas()["v"].tolist())
    z = scaled.orderBy("id").select("z_a", "z_b", "z_noise").toPandas().to_numpy()
    _, vectors = np.linalg.eigh(np.cov(z.T))
    axes = vectors[:, ::-1][:, :2]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(2)])
    assert np.allclose(got, z @ axes, atol=1e-8)


def test_preprocessing_order_and_filling(spark, numbers, tmp_path):
    data = numbers.withColumn("void", F.lit(None).cast("double"))
    plan = preprocess.build_preprocessor(data, ["a", "b", "text", "void"], {"tbl": ["nois", "few"]}, exclude=("id", "y"))
    model = plan.fit(data)
    model.write().overwrite().save(str(tmp_path / "m"))
    out = PipelineModel.load(str(tmp_path / "m")).transform(data)
    names = preprocess.feature_names(out)
    assert names[:4] == ["a", "b", "tbl_pca_0", "tbl_pca_1"] and len(names) == 7
    first = np.array([r.v for r in out.select(vector_to_array("features").alias("v")).collect()])
    local = numbers.toPandas()
    filled = local["b"].fillna(local["b"].median())
    assert np.allclose(np.sort(first[:, 1]), np.sort((filled - filled.mean()) / filled.std(ddof=0)))


def test_held_out_statistics_are_those_of_the_rows_left(spark, numbers):
    """Medians, means, deviations and axes of every fold held out, and of all rows, against one fit each."""
    rows = search.stratified_folds(numbers, ["id"], "y").withColumn("same", F.lit(7.5)).withColumn("void", F.lit(None).cast("double"))
    rows = rows.withColumn("odd", F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("a") * -1e6)).cache()
    columns = ["a", "b", "few", "noise", "same", "void", "odd"]
    fills = held_out_quantiles(rows, columns, [0.0, 0.3, 0.5, 1.0], "fold")
    plan = preprocess.build_preprocessor(rows, ["a", "b", "same", "void"], {"tbl": ["nois", "few", "b", "void"], "games": ["a", "odd"]}, exclude=("id", "y", "fold", "text"))
    fitted = plan.fit_folds(rows, "fold")
    assert set(fitted) == set(fills) == {ALL, 0, 1, 2}
    for fold, model in fitted.items():
        left = rows if fold == ALL else rows.filter(F.col("fold") != fold)
        local = left.toPandas()
        for c in columns:
            known = local[c].astype(float).dropna()
            assert (c in fills[fold]) == (len(known) > 0)
            if len(known):
                assert fills[fold][c] == pytest.approx(np.quantile(known, [0.0, 0.3, 0.5, 1.0]), rel=1e-15)
        if fold == ALL:
            left = rows.fillna(fills[fold]["odd"][2], ["odd"])  # the plain fit keeps NaN
        one = plan.fit(left.withColumn("odd", F.nanvl("odd", F.lit(fills[fold]["odd"][2]))))
        clean = rows.withColumn("odd", F.nanvl("odd", F.lit(None).cast("double")))
        ours, theirs = (np.array([r.v for r in m.transform(clean).orderBy("id").select(vector_to_array("features").alias("v")).collect()]) for m in (model, one))
        assert ours.shape == theirs.shape
        assert np.allclose(ours[:, :3], theirs[:, :3], rtol=1e-9, atol=1e-9)
        assert np.allclose(np.abs(ours), np.abs(theirs), rtol=1e-7, atol=1e-7)


def test_stages_of_folds_can_be_stored(spark, numbers, tmp_path):
    plan = preprocess.build_preprocessor(numbers, ["a", "text"], {"tbl": ["nois", "few"]}, exclude=("id", "y"))
    model = plan.fit_folds(numbers)[ALL]
    model.write().overwrite().save(str(tmp_path / "m"))
    out, again = (m.transform(numbers) for m in (model, PipelineModel.load(str(tmp_path / "m"))))
    assert preprocess.feature_names(again)[:3] == ["a", "tbl_pca_0", "tbl_pca_1"]
    assert sorted(map(str, out.select("id", "features").collect())) == sorted(map(str, again.select("id", "features").collect()))


def test_folds_are_stratified(spark, numbers):
    folds = search.stratified_folds(numbers, ["id"], "y").groupBy("fold").agg(F.sum("y").alias("s"), F.count("*").alias("n")).collect()
    assert len(folds) == 3 and max(f.s for f in folds) - min(f.s for f in folds) <= 1
    held = search.assemble_training(numbers.limit(10), numbers.limit(5), ["id"], "y", cross_validate=False)
    assert {r.fold: r["count"] for r in held.groupBy("fold").count().collect()} == {-1: 10, 0: 5}


def test_candidates():
    assert len(models.candidates(models.GRIDS["Decision Tree"])) == 2 * 9 * 5 * 3
    assert len(models.candidates(models.GRIDS["Gradient Boosting"])) == 2 * 6 * 6 * 8 * 3
    assert len(models.candidates(models.GRIDS["Regularised Boosting"])) == 8 * 5 * 3 * 3 * 3 * 3
    drawn = models.candidates(models.GRIDS["Random Forest"], 30, seed=1)
    assert len({str(c) for c in drawn}) == 30 and drawn == models.candidates(models.GRIDS["Random Forest"], 30, seed=1)


def test_pick_params_skips_over_fitted(spark):
    schema = "candidate int, params string, mean_train_score double, mean_test_score double"
    rows = [(0, "a", 0.99, 0.9), (1, "b", 0.9, 0.6), (2, "c", 0.8, 0.75), (3, "d", 0.8, 0.75)]
    assert search.pick_params(spark.createDataFrame(rows, schema)).first().params == "c"
    assert search.pick_params(spark.createDataFrame(rows[:2], schema)).first().params == "a"


def test_ranking_metrics_with_cut_groups(spark, small_blocks):
    r = random.Random(5)
    rows = [(int(r.random() < 0.4), r.randint(0, 300) / 300) for _ in range(900)]
    df = spark.createDataFrame(rows, "y int, p double")
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(df, "y", "p").first().roc_auc == pytest.approx(want, rel=1e-12)
    area, last = 0.0, (0.0, 1.0)
    for t in sorted({p for _, p in rows}, reverse=True):
        hits, predicted = sum(p >= t for p in pos), sum(p >= t for _, p in rows)
        now = (hits / len(pos), hits / predicted)
        area += (now[0] - last[0]) * (now[1] + last[1]) / 2
        last = now
    assert metrics.pr_auc(df, "y", "p").first().pr_auc == pytest.approx(area, rel=1e-12)


def test_metrics_without_predictions(spark):
    row = metrics.classification_metrics(spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double"), "y", "p").first()
    assert (row.accuracy, row.precision_1, row.recall_1, row.precision_0, row.f1_1) == (1.0, 1.0, 1.0, 1.0, 1.0)


def test_importance_and_curves(spark, numbers):
    plan = preprocess.build_preprocessor(numbers, ["a", "b"], {}, exclude=("id", "y"))
    prepared = plan.fit(numbers).transform(numbers).withColumn("label", F.col("y").cast("double"))
    model = models.build("Logistic Regression", {"C": 1.0, "elasticNetParam": 0.0, "maxIter": 50}, 400).fit(prepared)
    table = explain.feature_importance(spark, model, preprocess.feature_names(prepared)).collect()
    assert table[0].Feature == "a" and table[0]["Feature importance"] == abs(table[0].Coefficients)
    grid = explain.feature_grid(prepared, 0, 8)
    assert len(grid) == 8 and grid == sorted(grid)
    average, curves = explain.partial_dependence(model, prepared, 0, "a", grid, ["id"])
    line = [r.average for r in average.orderBy("value").collect()]
    assert line == sorted(line) and average.orderBy("value").first().centred == 0.0
    assert curves.count() == 400 * 8


def test_registered_training_is_the_whole_search(spark, monkeypatch):
    """The training queries go through all five grids, 30 draws as drawn, and three folds."""
    from checks import learning

    seen = {}

    def fit(candidates, held_out, *rest, **more):
        seen.update({name: (own, len(held_out)) for name, own in candidates.items()})
        return {name: spark.createDataFrame([(0, "{}", 0.5, 0.5)], search.RESULT_SCHEMA) for name in candidates}

    monkeypatch.setattr(search, "search_all", fit)
    rows = learning.m13(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.algorithm for r in rows) == sorted(models.GRIDS)
    assert seen == {name: (models.candidates(grid, 30), 3) for name, grid in models.GRIDS.items()}

    calls = []
    monkeypatch.setattr(learning.training, "train", lambda *args, **more: calls.append((args[5], more)) or args[0])
    monkeypatch.setattr(learning, "write_snapshot", lambda *a: None)
    monkeypatch.setattr(learning, "read_snapshot", lambda *a: spark.range(1))
    monkeypatch.setattr(learning.training, "write_splits", lambda *a: None)
    learning._train(spark.range(1), ["label_1"])
    assert calls == [(models.GRIDS, {"draws": 30, "folds": 3})]


def test_folds_lie_in_as_many_tasks_as_their_rows_need(spark, monkeypatch):
    """Whatever the shuffle setting, with the same rows in the same places; numbering by label alone leaves two full tasks."""
    monkeypatch.setattr(search, "ROWS_PER_TASK", 100)
    found = []
    for partitions in ("8", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            numbers = spark.range(300).select("id", (F.col("id") % 2).alias("y"), (F.xxhash64("id") % 1000 / 1000.0).alias("x"))
            rows = search.stratified_folds(numbers, ["id"], "y")
            plan = preprocess.build_preprocessor(rows, ["x"], {}, exclude=("id", "y", search.FOLD))
            folds = search.prepare_folds(rows, "y", plan.fit_folds(rows, search.FOLD))
            assert [f.rows for f in folds] == [200] * 3
            held = [f.cached.rdd.glom().map(lambda part: [str(r) for r in part]).collect() for f in folds]
            for f in folds:
                f.cached.unpersist()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert [len(parts) for parts in held] == [3] * 3 and max(len(p) for parts in held for p in parts) < 200
        found.append(held)
    assert found[0] == found[1]
