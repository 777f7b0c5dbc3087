"""Trees against plain search, prefixes against separate fits, and both ways of growing against each other."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from touchline.ml import explain, models, search
from touchline.ml.growth import Boost, Spec, grow, member_tree
from touchline.ml.tree_model import jobs_for
from touchline.ml.trees import Rows, bin_folds, candidate_scores


def sample(n=300, width=4, seed=1):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 9, (n, width)).astype(np.uint8)
    y = (rng.random(n) < 0.2 + 0.6 * ((bins[:, 0] > 4) ^ (bins[:, 1] > 6))).astype(float)
    return bins, y


def brute(bins, y, rows, depth, least, split):
    """A classification tree by trying every cut of every feature; nested tuples."""
    n, s = len(rows), y[rows].sum()
    best = None
    if depth and n >= split and 0 < s < n:
        for f in range(bins.shape[1]):
            for c in range(8):
                left = rows[bins[rows, f] <= c]
                right = rows[bins[rows, f] > c]
                if min(len(left), len(right)) < least or not len(left) or not len(right):
                    continue
                gain = sum(x.sum() * (len(x) - x.sum()) / len(x) * k for x, k in ((y[rows], 2), (y[left], -2), (y[right], -2)))
                if gain > 1e-10 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, c, left, right)
    if best is None:
        return (n, s)
    _, f, c, left, right = best
    return (f, c, brute(bins, y, left, depth - 1, least, split), brute(bins, y, right, depth - 1, least, split))


def nested(tree, node=0):
    if tree.left[node] < 0:
        return (tree.n[node], tree.s[node])
    return (tree.feature[node], tree.cut[node], nested(tree, tree.left[node]), nested(tree, tree.right[node]))


def test_members_and_depths_are_the_separate_trees():
    bins, y = sample()
    members = ((1, 2), (1, 30), (5, 2), (20, 2), (60, 90))
    levels = [(a, b) for a, b, _, _ in grow(bins, (np.ones(len(y)), y), Spec("gini", members), 6, 0)]
    for m, (least, split) in enumerate(members):
        for depth in (0, 1, 3, 6):
            got = member_tree([a for a, _ in levels], [b for _, b in levels], m, depth)
            assert nested(got) == brute(bins, y, np.arange(len(y)), depth, least, split)


def features(spark, n=240):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 5)).round(2)
    x[:, 4] = rng.integers(0, 2, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] + x[:, 4] - 0.5)))).astype(float)
    rows = [(i, x[i].tolist(), float(y[i]), i % 3 > 0) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, x array<double>, label double, fit boolean").repartition(3)
    return df.select("id", array_to_vector("x").alias("features"), "label", "fit").cache()


CANDIDATES = {
    "Decision Tree": [{"impurity": i, "maxDepth": d, "minInstancesPerNode": m, "minSplit": s}
                      for i, d, m, s in (("gini", 2, 1, 2), ("gini", 7, 1, 2), ("gini", 7, 10, 2), ("entropy", 30, 5, 10))],
    "Random Forest": [{"featureSubsetStrategy": f, "maxDepth": d, "minInstancesPerNode": m, "numTrees": t, "bootstrap": True}
                      for f, d, m, t in (("sqrt", 3, 1, 4), ("sqrt", 9, 1, 30), ("sqrt", 9, 20, 7), ("all", 5, 2, 4))],
    "Gradient Boosting": [{"loss": o, "stepSize": 0.1, "maxDepth": d, "minInstancesPerNode": 2, "maxIter": t}
                          for o, d, t in (("log_loss", 3, 2), ("log_loss", 3, 5), ("exponential", 2, 3))],
    "Regularised Boosting": [{"stepSize": 0.3, "maxDepth": 3, "minChildWeight": 2, "gamma": g, "regLambda": 1.0, "maxIter": t}
                             for g, t in ((0.0, 4), (1.0, 4), (1.0, 2))],
}


def all_scores(binned, names=CANDIDATES, only=None):
    jobs, shares, first = [], {}, 0
    for name in names:
        own = CANDIDATES[name]
        picked = own if only is None else [own[only]]
        more, parts = jobs_for(name, picked, binned.features, 42, first)
        jobs, shares, first = jobs + more, shares | parts, first + len(picked)
    rows = candidate_scores(binned, jobs, shares).orderBy("candidate", "fold", "fit", "score", "y").collect()
    return [tuple(r) for r in rows]


def test_prefixes_are_the_separate_fits(spark):
    df = features(spark)
    binned = bin_folds({0: df, 1: df.withColumn("fit", ~F.col("fit"))}, "features", "label")
    joint = all_scores(binned)
    assert len(joint) == 2 * 240 * sum(map(len, CANDIDATES.values()))
    at = 0
    for name, own in CANDIDATES.items():
        for k in range(len(own)):
            alone = all_scores(binned, [name], k)
            assert [r[1:] for r in joint if r[0] == at] == [r[1:] for r in alone], (name, own[k])
            at += 1


def test_both_ways_grow_the_same(spark):
    df = features(spark)
    binned = bin_folds({0: df}, "features", "label")
    small = all_scores(binned)
    spark.conf.set("spark.touchline.treeBroadcastBytes", "0")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        assert not binned.small
        assert all_scores(binned) == small
        fitted = models.build("Random Forest", {"numTrees": 3, "maxDepth": 4}, 240).fit(df)
    finally:
        spark.conf.unset("spark.touchline.treeBroadcastBytes")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(fitted.trees) == 3


@pytest.mark.parametrize("name", list(CANDIDATES))
def test_saved_models_score_as_the_search(spark, tmp_path, name):
    df = features(spark)
    whole = df.withColumn("fit", F.lit(True))
    params = CANDIDATES[name][1]
    fitted = models.build(name, params, 240).fit(whole)
    PipelineModel([fitted]).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    p = F.get(vector_to_array("probability"), 1)
    got = sorted(r[0] for r in loaded.transform(df).select(p).collect())
    assert got == sorted(r[0] for r in fitted.transform(df).select(p).collect())
    want = sorted(r[3 + 1] for r in all_scores(bin_folds({0: whole}, "features", "label"), [name], 1))
    assert got == pytest.approx(want, abs=1e-9)
    assert fitted.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_pruning_and_leaf_values():
    """One round on one flag: leaves are G / (H + lambda); a gain below gamma removes the split."""
    bins = np.repeat([[0], [1]], [6, 10], axis=0).astype(np.uint8)
    y = np.array([0, 0, 0, 0, 1, 1] + [1] * 8 + [0, 0], float)
    rows = Rows(bins, y, np.ones(16), np.arange(16, dtype=np.uint64))
    boost = Boost("second", 0.5, 1, Spec("second", ((1, 2),), reg_lambda=1.0))
    levels = [(a, b) for a, b, _, _ in grow(bins, boost.derivatives(np.zeros(16), rows.y, rows.fit), boost.scaled(), 1, 0)]
    tree = member_tree([a for a, _ in levels], [b for _, b in levels], 0, 1)
    assert boost.values(tree)[1:] == pytest.approx([0.5 * (2 - 3) / (1.5 + 1), 0.5 * (8 - 5) / (2.5 + 1)])
    gain = 1 / 2.5 + 9 / 3.5 - 4 / 5
    kept, gone = (Boost("second", 0.5, 1, boost.spec, g).cut_back(tree) for g in (gain - 0.01, gain + 0.01))
    assert kept.left[0] == 1 and gone.left[0] == -1


def test_search_table(spark):
    df = features(spark)
    folds = [search.Fold(df.filter("fit"), df.filter("not fit"), 160, df)]
    logistic = [{"C": 1, "elasticNetParam": e, "maxIter": m} for e in (1.0, 0.0) for m in (2, 1000, 10000)]
    found = search.search_all(CANDIDATES | {"Logistic Regression": logistic}, folds)
    for name, table in found.items():
        rows = table.orderBy("candidate").collect()
        assert [r.candidate for r in rows] == list(range(len(logistic if name == "Logistic Regression" else CANDIDATES[name])))
        assert all(0 <= r.mean_test_score <= 1 and math.isfinite(r.mean_train_score) for r in rows)
    deep = found["Decision Tree"].orderBy("candidate").collect()
    assert deep[1].mean_train_score > deep[0].mean_train_score
    lines = found["Logistic Regression"].orderBy("candidate").collect()
    assert lines[0].mean_test_score == lines[1].mean_test_score == lines[2].mean_test_score


@pytest.mark.parametrize("name", list(CANDIDATES))
def test_curves_are_the_scores_of_changed_rows(spark, name):
    df = features(spark)
    fitted = models.build(name, CANDIDATES[name][1], 240).fit(df)
    for index, grid in ((0, [-1.0, -0.25, 0.0, 0.31, 2.0]), (4, [0.0, 1.0])):
        average, curves = explain.partial_dependence(fitted, df, index, "f", grid, ["id"])
        x = vector_to_array("features")
        for g in grid:
            changed = df.withColumn("features", array_to_vector(F.transform(x, lambda v, i: F.when(i == index, F.lit(g)).otherwise(v))))
            want = {r.id: r.p for r in fitted.transform(changed).select("id", F.get(vector_to_array("probability"), 1).alias("p")).collect()}
            got = {r.id: r.p for r in curves.filter(F.col("value") == g).collect()}
            assert got == pytest.approx(want, abs=1e-9)
            assert average.filter(F.col("value") == g).first().average == pytest.approx(sum(want.values()) / len(want))


@pytest.mark.parametrize("mix", [0.0, 1.0, 0.5])
def test_logistic_steps_end_where_the_library_does(spark, mix):
    df = features(spark).repartition(5)
    for c in (0.05, 3.0):
        ours = models.build("Logistic Regression", {"C": c, "elasticNetParam": mix, "maxIter": 10}, 240).fit(df)
        theirs = LogisticRegression(standardization=False, regParam=1 / (c * 240), elasticNetParam=mix, maxIter=5000, tol=1e-13).fit(df)
        assert ours.coefficients.toArray() == pytest.approx(theirs.coefficients.toArray(), abs=2e-5)
        assert ours.intercept == pytest.approx(theirs.intercept, abs=2e-5)
        p = F.get(vector_to_array("probability"), 1)
        assert sorted(r[0] for r in ours.transform(df).select(p).collect()) == pytest.approx(sorted(r[0] for r in theirs.transform(df).select(p).collect()), abs=1e-5)
