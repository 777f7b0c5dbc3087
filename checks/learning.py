"""Quantiles, split, feature tests, preprocessing, models, metrics and the training drivers."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters as a
from checks.composites import feature_data
from checks.registry import query, r6, rounded
from touchline.ml import explain, metrics, models, outcomes, preprocess, search, significance
from touchline.ml.models import LABEL
from touchline.ml.split import split
from touchline.operators.quantiles import QUINTILES, quantile_edges
from touchline.plans import training
from touchline.session import scratch_path
from touchline.sources.snapshots import load_model, read_snapshot, save_model, write_snapshot

Spark = SparkSession

EDGE_COLUMNS = ["price", "quantity", "discount"]


def _edges_sql(column: str) -> str:
    quantiles = ", ".join(str(q) for q in QUINTILES)
    return f"SELECT '{column}' AS feature, LIST_SORT(LIST_DISTINCT(QUANTILE_CONT({column}, [{quantiles}]))) AS edges FROM factors"


EDGES = " UNION ALL ".join(_edges_sql(c) for c in EDGE_COLUMNS)


@query(
    "a8_quintile_edges",
    a.with_ctes("factors", extra={"e": EDGES, "numbered": "SELECT feature, GENERATE_SUBSCRIPTS(edges, 1) - 1 AS i, UNNEST(edges) AS edge FROM e"})
    + f"SELECT feature, CAST(i AS INT) AS i, {r6('edge')} AS edge FROM numbered",
)
def a8(spark: Spark, sf: str) -> DataFrame:
    edges = quantile_edges(a.factors(spark, sf), EDGE_COLUMNS)
    return rounded(edges.select("feature", F.posexplode("edges").alias("i", "edge")))


@query(
    "m1_exact_split",
    """WITH ranked AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY MD5(CONCAT(CAST(o_orderkey AS VARCHAR), '|', '42'))) AS r, COUNT(*) OVER () AS n FROM orders),
sized AS (SELECT *, CAST(CEIL(0.4 * n) AS BIGINT) AS held FROM ranked)
SELECT o_orderkey, CASE WHEN r <= n - held THEN 'train' WHEN r <= n - CAST(CEIL(0.5 * held) AS BIGINT) THEN 'test' ELSE 'validation' END AS split FROM sized""",
)
def m1(spark: Spark, sf: str) -> DataFrame:
    return split(a.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 42)


ANOVA = {
    "price_edges": _edges_sql("price"),
    "discount_edges": _edges_sql("discount"),
    "levels": """
SELECT 'flag' AS feature, flag AS level, y FROM factors
UNION ALL SELECT 'few', CAST(few AS VARCHAR), y FROM factors
UNION ALL SELECT 'price', CAST(GREATEST(1, LEN(LIST_FILTER(edges, lambda e: e < price))) AS VARCHAR), y FROM factors, price_edges
UNION ALL SELECT 'discount', CAST(GREATEST(1, LEN(LIST_FILTER(edges, lambda e: e < discount))) AS VARCHAR), y FROM factors, discount_edges WHERE discount IS NOT NULL""",
    "cells": "SELECT feature, level, COUNT(*) AS n, CAST(SUM(y) AS DOUBLE) AS s FROM levels GROUP BY feature, level",
    "totals": "SELECT feature, COUNT(*) AS k, CAST(SUM(n) AS DOUBLE) AS n, SUM(s) AS s, SUM(s * s / n) AS means FROM cells GROUP BY feature",
}


@query(
    "m2_anova",
    a.with_ctes("factors", extra=ANOVA)
    + f"""SELECT feature, {r6('((means - s * s / n) / (k - 1)) / ((s - means) / (n - k))')} AS "F", CAST(k - 1 AS BIGINT) AS df1, CAST(n - k AS BIGINT) AS df2 FROM totals""",
)
def m2(spark: Spark, sf: str) -> DataFrame:
    factors = a.factors(spark, sf)
    edges = {r.feature: r.edges for r in quantile_edges(factors, ["price", "discount"]).collect()}
    by_level = significance.anova_oneway(factors, ["flag", "few"], "y")
    return rounded(by_level.unionByName(significance.anova_binned(factors, edges, "y")))


@query(
    "m3_f_regression",
    a.with_ctes("factors", extra={"r": """
SELECT 'few' AS feature, CORR(few, y) AS r, COUNT(few) AS n FROM factors UNION ALL SELECT 'quantity', CORR(quantity, y), COUNT(quantity) FROM factors
UNION ALL SELECT 'discount', CORR(discount, y), COUNT(discount) FROM factors"""})
    + f"""SELECT feature, {r6('r * r * (n - 2) / (1 - r * r)')} AS "F", CAST(1 AS BIGINT) AS df1, n - 2 AS df2 FROM r""",
)
def m3(spark: Spark, sf: str) -> DataFrame:
    return rounded(significance.f_regression(a.factors(spark, sf), ["few", "quantity", "discount"], "y"))


@query("m4_feature_selection")
def m4(spark: Spark, sf: str) -> DataFrame:
    selected, tests = significance.select_features(a.factors(spark, sf), "y", exclude=[])
    return tests.withColumn("selected", F.col("feature").isin(selected))


@query(
    "m5_median_imputation",
    a.with_ctes("factors") + f"SELECT {r6('AVG(price)')} AS price, {r6('AVG(COALESCE(discount, (SELECT QUANTILE_CONT(discount, 0.5) FROM factors)))')} AS discount FROM factors",
)
def m5(spark: Spark, sf: str) -> DataFrame:
    factors = a.factors(spark, sf)
    fill = preprocess.medians(factors, ["price", "discount"])
    return rounded(factors.fillna(fill).agg(F.avg("price").alias("price"), F.avg("discount").alias("discount")))


@query(
    "m6_mode_imputation",
    """WITH modes AS (
  SELECT team_h_score AS v, COUNT(*) AS n FROM (SELECT CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS team_h_score FROM orders) x
  WHERE team_h_score IS NOT NULL GROUP BY 1)
SELECT o_orderkey, COALESCE(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END,
  (SELECT v FROM modes ORDER BY n DESC, v LIMIT 1)) AS priority FROM orders""",
)
def m6(spark: Spark, sf: str) -> DataFrame:
    known = F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority"))
    orders = a.table(spark, sf, "orders").select("o_orderkey", known.alias("priority"))
    return preprocess.impute_modes(orders, ["priority"])


@query(
    "m7_standardise",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    + r6("(l_quantity - AVG(l_quantity) OVER ()) / STDDEV_POP(l_quantity) OVER ()") + " AS z_l_quantity, "
    + r6("(l_tax - AVG(l_tax) OVER ()) / STDDEV_POP(l_tax) OVER ()") + " AS z_l_tax FROM lineitem",
)
def m7(spark: Spark, sf: str) -> DataFrame:
    lines = a.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax")
    return rounded(preprocess.standardise(lines, ["l_quantity", "l_tax"]).drop("l_quantity", "l_tax"))


@query("m8_principal_components")
def m8(spark: Spark, sf: str) -> DataFrame:
    scaled = preprocess.standardise(a.numbers(spark, sf), [f"e_{i:02d}" for i in range(64)])
    model = PipelineModel(preprocess.pca_block(scaled, [f"z_e_{i:02d}" for i in range(64)], "games"))
    parts = vector_to_array("games_pca")
    return model.transform(scaled).select("vec_id", *[parts[i].alias(f"component_{i}") for i in range(5)])


@query(
    "m9_one_hot",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_returnflag = 'A' AS DOUBLE) AS is_a, CAST(l_returnflag = 'R' AS DOUBLE) AS is_r FROM lineitem",
)
def m9(spark: Spark, sf: str) -> DataFrame:
    """Fitted without ``N``, so that value is unknown when all rows are encoded."""
    lines = a.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    stages = preprocess.one_hot(lines.filter("l_returnflag <> 'N'"), ["l_returnflag"])
    at = {value: i for i, value in enumerate(stages[0].labelsArray[0])}
    hot = vector_to_array("l_returnflag_hot")
    return PipelineModel(stages).transform(lines).select(
        "l_orderkey", "l_linenumber", "l_partkey", hot[at["A"]].alias("is_a"), hot[at["R"]].alias("is_r")
    )


NUMBER_FAMILIES = {"games": ["e_0", "e_1"], "tbl": ["e_2", "e_3"], "player": ["e_4", "e_5", "e_6"]}


def _prepared(spark: Spark, sf: str) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """Embeddings with features and label, half of the dimensions taken as selected."""
    rows = a.numbers(spark, sf)
    chosen = [c for c in rows.columns if c.startswith("e_")][::2]
    plan = preprocess.build_preprocessor(rows, chosen, NUMBER_FAMILIES, exclude=("vec_id", "y"))
    model = plan.fit(rows)
    return rows, model.transform(rows).withColumn(LABEL, F.col("y").cast("double")), model


@query("m10_preprocessing")
def m10(spark: Spark, sf: str) -> DataFrame:
    _, prepared, _ = _prepared(spark, sf)
    names = preprocess.feature_names(prepared)
    entries = vector_to_array(preprocess.FEATURES)
    return prepared.select("vec_id", *[F.get(entries, i).alias(n) for i, n in enumerate(names)])


@query(
    "m11_stratified_folds",
    """WITH hashed AS (SELECT doc_id, quality, ROW_NUMBER() OVER (PARTITION BY quality ORDER BY MD5(CONCAT(CAST(doc_id AS VARCHAR), '|', '42'))) AS r FROM labels)
SELECT doc_id, quality, CAST((r - 1) % 3 AS INT) AS fold FROM hashed""",
)
def m11(spark: Spark, sf: str) -> DataFrame:
    labels = a.table(spark, sf, "labels").select("doc_id", "quality")
    parts = split(labels, ["doc_id"], 7)
    train, rest = parts.filter("split = 'train'"), parts.filter("split <> 'train'")
    return search.assemble_training(train.drop("split"), rest.drop("split"), ["doc_id"], "quality")


SMALL_PARAMS = {
    "Logistic Regression": {"C": 0.1, "elasticNetParam": 0.0, "maxIter": 50},
    "Decision Tree": {"maxDepth": 4, "impurity": "gini"},
    "Random Forest": {"numTrees": 10, "maxDepth": 4},
    "Gradient Boosting": {"maxIter": 3, "maxDepth": 3, "stepSize": 0.03},
    "Regularised Boosting": {"maxIter": 3, "maxDepth": 3, "stepSize": 0.03, "gamma": 0.1},
}


@query("m12_classifiers")
def m12(spark: Spark, sf: str) -> DataFrame:
    _, prepared, _ = _prepared(spark, sf)
    n, scored = prepared.count(), None
    for name, params in SMALL_PARAMS.items():
        fitted = models.build(name, params, n).fit(prepared)
        part = fitted.transform(prepared).select(
            F.lit(name).alias("algorithm"), "vec_id", F.get(vector_to_array("probability"), 1).alias("p")
        )
        scored = part if scored is None else scored.unionByName(part)
    return scored


# The reference draws 30 combinations of each grid and validates them on three folds.
DRAWS, FOLDS = 30, 3


def _search(spark: Spark, sf: str) -> DataFrame:
    """All five algorithms: one row per algorithm and candidate."""
    rows = search.stratified_folds(a.numbers(spark, sf), ["vec_id"], "y", FOLDS)
    plan = preprocess.build_preprocessor(rows, [], NUMBER_FAMILIES, exclude=("vec_id", "y", "fold"))
    held_out = search.prepare_folds(rows, "y", plan.fit_folds(rows, search.FOLD))
    found = search.search_all({name: models.candidates(grid, DRAWS) for name, grid in models.GRIDS.items()}, held_out)
    return reduce(DataFrame.unionByName, [results.select(F.lit(name).alias("algorithm"), "*") for name, results in found.items()])


@query("m13_parameter_search")
def m13(spark: Spark, sf: str) -> DataFrame:
    return _search(spark, sf)


@query(
    "m14_pick_parameters",
    """WITH results AS (SELECT p_size AS candidate, CAST(p_size AS VARCHAR) AS params, AVG(p_retailprice) / 1500 AS mean_train_score,
       MIN(p_retailprice) / 1400 AS mean_test_score FROM part GROUP BY p_size)
SELECT candidate, params FROM results
ORDER BY CASE WHEN mean_train_score <= 0.95 AND mean_train_score - mean_test_score <= 0.2 AND mean_train_score / mean_test_score <= 1.3 THEN 0 ELSE 1 END,
         mean_test_score DESC, candidate LIMIT 1""",
)
def m14(spark: Spark, sf: str) -> DataFrame:
    results = a.table(spark, sf, "part").groupBy(F.col("p_size").alias("candidate")).agg(
        (F.avg("p_retailprice") / 1500).alias("mean_train_score"), (F.min("p_retailprice") / 1400).alias("mean_test_score")
    )
    picked = search.pick_params(results.withColumn("params", F.col("candidate").cast("string")))
    return picked.select("candidate", "params")


def _confusion_sql(source: str, p: str = "p", by: str = "split") -> dict[str, str]:
    return {
        "counts": f"""SELECT {by}, COUNT(*) FILTER ({p} >= 0.5 AND y = 1) AS tp, COUNT(*) FILTER ({p} >= 0.5 AND y <> 1) AS fp,
       COUNT(*) FILTER ({p} < 0.5 AND y <> 1) AS tn, COUNT(*) FILTER ({p} < 0.5 AND y = 1) AS fn FROM {source} GROUP BY {by}""",
        "rates": f"""SELECT {by}, (tp + tn) / (tp + tn + fp + fn) AS accuracy, COALESCE(tn / NULLIF(tn + fn, 0), 1) AS precision_0,
       COALESCE(tp / NULLIF(tp + fp, 0), 1) AS precision_1, COALESCE(tn / NULLIF(tn + fp, 0), 1) AS recall_0,
       COALESCE(tp / NULLIF(tp + fn, 0), 1) AS recall_1 FROM counts""",
        "confusion": """SELECT *, COALESCE(2 * precision_0 * recall_0 / NULLIF(precision_0 + recall_0, 0), 0) AS f1_0,
       COALESCE(2 * precision_1 * recall_1 / NULLIF(precision_1 + recall_1, 0), 0) AS f1_1 FROM rates""",
    }


MEASURES = ["accuracy", "precision_0", "precision_1", "recall_0", "recall_1", "f1_0", "f1_1"]


@query(
    "m15_threshold_metrics",
    a.with_ctes("scored", extra=_confusion_sql("scored"))
    + f"SELECT split, {', '.join(f'{r6(m)} AS {m}' for m in MEASURES)} FROM confusion",
)
def m15(spark: Spark, sf: str) -> DataFrame:
    return rounded(metrics.classification_metrics(a.scored(spark, sf), "y", "p", 0.5, ["split"]))


# Ranking metrics from their definitions: every positive against every negative score, and every threshold.
ROC = {
    "by_score": "SELECT split, p, COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS pos FROM scored GROUP BY split, p",
    "roc": """SELECT l.split, SUM(l.pos * (r.n - r.pos) * CASE WHEN l.p > r.p THEN 1.0 WHEN l.p = r.p THEN 0.5 ELSE 0.0 END) AS wins,
       (SELECT CAST(SUM(y) AS DOUBLE) * (COUNT(*) - SUM(y)) FROM scored s WHERE s.split = l.split) AS pairs
       FROM by_score l JOIN by_score r ON l.split = r.split GROUP BY l.split""",
}


@query("m16_roc_auc", a.with_ctes("scored", extra=ROC) + f"SELECT split, {r6('CAST(wins AS DOUBLE) / pairs')} AS roc_auc FROM roc")
def m16(spark: Spark, sf: str) -> DataFrame:
    return rounded(metrics.roc_auc(a.scored(spark, sf), "y", "p", ["split"]))


def _prc_sql(score: str, source: str, prefix: str) -> dict[str, str]:
    return {
        f"{prefix}_cells": f"SELECT split, {score} AS s, COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS pos FROM {source} GROUP BY 1, 2",
        f"{prefix}_points": f"""SELECT split, s, SUM(pos) OVER w AS hits, SUM(n) OVER w AS predicted, SUM(pos) OVER (PARTITION BY split) AS total
       FROM {prefix}_cells WINDOW w AS (PARTITION BY split ORDER BY s DESC)""",
        f"{prefix}_curve": f"""SELECT split, hits / total AS recall, hits / predicted AS prec,
       LAG(hits / total, 1, 0) OVER (PARTITION BY split ORDER BY s DESC) AS recall_before,
       LAG(hits / predicted, 1, 1) OVER (PARTITION BY split ORDER BY s DESC) AS prec_before FROM {prefix}_points""",
        f"{prefix}": f"SELECT split, SUM((recall - recall_before) * (prec + prec_before) / 2) AS area FROM {prefix}_curve GROUP BY split",
    }


@query("m17_pr_auc", a.with_ctes("scored", extra=_prc_sql("p", "scored", "prc")) + f"SELECT split, {r6('area')} AS pr_auc FROM prc")
def m17(spark: Spark, sf: str) -> DataFrame:
    return rounded(metrics.pr_auc(a.scored(spark, sf), "y", "p", ["split"]))


LONG_NAMES = {"Accuracy {}": "accuracy", "Precision {}: 0": "precision_0", "Precision {}: 1": "precision_1",
              "Recall {}: 0": "recall_0", "Recall {}: 1": "recall_1", "F1-score {}: 0": "f1_0", "F1-score {}: 1": "f1_1"}
LONG_SQL = " UNION ALL ".join(
    [f"SELECT '{name.format(shown)}' AS \"Metric\", {c} AS v FROM confusion WHERE split = '{part}'"
     for name, c in LONG_NAMES.items() for part, shown in (("train", "Train"), ("validation", "Val"))]
    + [f"SELECT 'AUC-ROC {shown}', CAST(wins AS DOUBLE) / pairs FROM roc WHERE split = '{part}'"
       for part, shown in (("train", "Train"), ("validation", "Val"))]
    + ["SELECT 'AUC-PRC Train', area FROM prc_labels WHERE split = 'train'",
       "SELECT 'AUC-PRC Val', area FROM prc WHERE split = 'validation'"]
)


@query(
    "m18_metrics_table",
    a.with_ctes("scored", extra={
        **_confusion_sql("scored"), **ROC, **_prc_sql("p", "scored", "prc"),
        **_prc_sql("CASE WHEN p >= 0.5 THEN 1.0 ELSE 0.0 END", "scored", "prc_labels"), "long": LONG_SQL,
    }) + f"""SELECT 'Score' AS "Algorithm", "Metric", {r6('v')} AS "Metric value" FROM long""",
)
def m18(spark: Spark, sf: str) -> DataFrame:
    return rounded(metrics.metrics_long(metrics.evaluate(a.scored(spark, sf), "Score")))


def _fitted(spark: Spark, sf: str, algorithm: str):
    _, prepared, prepare = _prepared(spark, sf)
    return models.build(algorithm, SMALL_PARAMS[algorithm], prepared.count()).fit(prepared), prepared, prepare


@query("m19_feature_importance")
def m19(spark: Spark, sf: str) -> DataFrame:
    fitted, prepared, _ = _fitted(spark, sf, "Logistic Regression")
    return explain.feature_importance(spark, fitted, preprocess.feature_names(prepared))


@query("m20_partial_dependence")
def m20(spark: Spark, sf: str) -> DataFrame:
    """Average curves of the nine most important features."""
    fitted, prepared, _ = _fitted(spark, sf, "Random Forest")
    names = preprocess.feature_names(prepared)
    top = [r.Feature for r in explain.feature_importance(spark, fitted, names).limit(9).collect()]
    curves = None
    for feature in top:
        grid = explain.feature_grid(prepared, names.index(feature))
        average, _ = explain.partial_dependence(fitted, prepared, names.index(feature), feature, grid, ["vec_id"])
        curves = average if curves is None else curves.unionByName(average)
    return curves


@query(
    "m21_best_algorithm",
    """SELECT c_mktsegment AS "Algorithm" FROM customer GROUP BY c_mktsegment ORDER BY ROUND(SUM(c_acctbal / 10000), 6) DESC, c_mktsegment LIMIT 1""",
)
def m21(spark: Spark, sf: str) -> DataFrame:
    customers = a.table(spark, sf, "customer")
    shown = customers.select(F.col("c_mktsegment").alias("Algorithm"), (F.col("c_acctbal") / 10000).alias("AUC-ROC Val"))
    return metrics.best_algorithm(shown).select("Algorithm")


@query(
    "m22_normalised_outcomes",
    a.with_ctes("scored", extra={
        "three": "SELECT doc_id, p + 0.01 AS p1, (1 - p) / 2 AS px, 0.3 AS p2 FROM scored",
        "total": "SELECT *, CAST(p1 + px + p2 AS DOUBLE) AS s FROM three"})
    + """SELECT doc_id, ROUND_EVEN(p1 / s * 100, 0) / 100 AS proba_1_fix, ROUND_EVEN(px / s * 100, 0) / 100 AS "proba_X_fix",
       ROUND_EVEN(p2 / s * 100, 0) / 100 AS proba_2_fix FROM total""",
)
def m22(spark: Spark, sf: str) -> DataFrame:
    three = a.scored(spark, sf).select(
        "doc_id", (F.col("p") + 0.01).alias("proba_1"), ((1 - F.col("p")) / 2).alias("proba_X"), F.lit(0.3).alias("proba_2")
    )
    return outcomes.normalise_outcomes(three).select("doc_id", *[f"proba_{o}_fix" for o in outcomes.OUTCOMES])


@query("s14_model_round_trip")
def s14(spark: Spark, sf: str) -> DataFrame:
    rows, _, prepare = _prepared(spark, sf)
    fitted, _, _ = _fitted(spark, sf, "Decision Tree")
    root = scratch_path(spark, "models")
    save_model(PipelineModel([*prepare.stages, fitted]), root, "label_1", "Decision Tree")
    scored = load_model(root, "label_1", "Decision Tree").transform(rows)
    return scored.select("vec_id", F.get(vector_to_array("probability"), 1).alias("p"))


# Closed forms: with one 0/1 feature a tree's leaves are the group means, an unpenalised logistic model reaches the same,
# its coefficient is the log odds ratio, and the partial dependence is the two means.

FLAGS = "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS x, CASE WHEN o_orderkey % 5 < CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 1 END THEN 1 ELSE 0 END AS y FROM orders"
FLAG_PARAMS = {
    "Decision Tree": {"maxDepth": 1, "impurity": "gini"},
    "Logistic Regression": {"C": 1e12, "elasticNetParam": 0.0, "maxIter": 200, "tol": 1e-12},
}


def flags(spark: Spark, sf: str) -> DataFrame:
    flag = F.col("o_orderstatus") == "F"
    rows = a.table(spark, sf, "orders").select(
        "o_orderkey", flag.cast("double").alias("x"), (F.col("o_orderkey") % 5 < F.when(flag, 3).otherwise(1)).cast("double").alias(LABEL))
    return VectorAssembler(inputCols=["x"], outputCol=preprocess.FEATURES).transform(rows)


def flag_model(rows: DataFrame, algorithm: str):
    return models.build(algorithm, FLAG_PARAMS[algorithm], rows.count()).fit(rows)


@query("m8_two_components", f"""WITH z AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity - AVG(l_quantity) OVER ()) / STDDEV_POP(l_quantity) OVER () AS a,
  (l_extendedprice - AVG(l_extendedprice) OVER ()) / STDDEV_POP(l_extendedprice) OVER () AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, {r6('GREATEST(ABS(a + b), ABS(a - b)) / SQRT(2.0)')} AS larger, {r6('LEAST(ABS(a + b), ABS(a - b)) / SQRT(2.0)')} AS smaller FROM z""")
def m8_two(spark: Spark, sf: str) -> DataFrame:
    """Of two standardised columns the axes are their sum and their difference, in either order."""
    lines = a.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    scaled = preprocess.standardise(lines, ["l_quantity", "l_extendedprice"])
    model = PipelineModel(preprocess.pca_block(scaled, ["z_l_quantity", "z_l_extendedprice"], "games"))
    parts = vector_to_array("games_pca")
    return rounded(model.transform(scaled).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.greatest(F.abs(parts[0]), F.abs(parts[1])).alias("larger"),
        F.least(F.abs(parts[0]), F.abs(parts[1])).alias("smaller")))


@query("m12_group_means", f"""WITH d AS ({FLAGS}), m AS (SELECT x, AVG(y) AS p FROM d GROUP BY x)
SELECT algorithm, o_orderkey, ROUND(p + 1e-9, 4) AS p FROM d JOIN m USING (x), (VALUES ('Decision Tree'), ('Logistic Regression')) AS v(algorithm)""")
def m12_means(spark: Spark, sf: str) -> DataFrame:
    rows, scored = flags(spark, sf), None
    for name in FLAG_PARAMS:
        part = flag_model(rows, name).transform(rows).select(
            F.lit(name).alias("algorithm"), "o_orderkey", F.round(F.get(vector_to_array("probability"), 1) + 1e-9, 4).alias("p"))
        scored = part if scored is None else scored.unionByName(part)
    return scored


# One flag and one split: each round adds to a flag's margin the rate times its sum of first orders over that of second orders.
BOOSTED = {
    "log_loss": ("Gradient Boosting", {"loss": "log_loss", "maxDepth": 1, "stepSize": 0.3, "minInstancesPerNode": 1}),
    "exponential": ("Gradient Boosting", {"loss": "exponential", "maxDepth": 1, "stepSize": 0.3, "minInstancesPerNode": 1}),
    "second": ("Regularised Boosting", {"maxDepth": 1, "stepSize": 0.5, "minChildWeight": 1, "gamma": 0.1, "regLambda": 1.0}),
    "pruned": ("Regularised Boosting", {"maxDepth": 1, "stepSize": 0.5, "minChildWeight": 1, "gamma": 1e9, "regLambda": 1.0}),
}


def _boosted_sql() -> str:
    steps = {
        "log_loss": ("LN(t.p / (1 - t.p))", lambda f: f"0.3 * (m.p - 1 / (1 + EXP(-{f}))) / (1 / (1 + EXP(-{f})) * (1 - 1 / (1 + EXP(-{f}))))", 1),
        "exponential": ("LN(t.p / (1 - t.p)) / 2", lambda f: f"0.3 * (m.p * EXP(-{f}) - (1 - m.p) * EXP({f})) / (m.p * EXP(-{f}) + (1 - m.p) * EXP({f}))", 2),
        "second": ("CAST(0 AS DOUBLE)", lambda f: f"0.5 * m.n * (m.p - 1 / (1 + EXP(-{f}))) / (m.n * (1 / (1 + EXP(-{f})) * (1 - 1 / (1 + EXP(-{f})))) + 1)", 1),
        "pruned": ("CAST(0 AS DOUBLE)", lambda f: f"0.5 * t.n * (t.p - 1 / (1 + EXP(-{f}))) / (t.n * (1 / (1 + EXP(-{f})) * (1 - 1 / (1 + EXP(-{f})))) + 1)", 1),
    }
    parts = []
    for model, (start, step, slope) in steps.items():
        parts.append(f"""SELECT '{model}' AS model, x, 1 / (1 + EXP(-{slope} * f1)) AS p1, 1 / (1 + EXP(-{slope} * f2)) AS p2 FROM (
  SELECT x, f1, f1 + {step('f1')} AS f2 FROM (SELECT m.x, f0 + {step('f0')} AS f1 FROM m, t, (SELECT {start} AS f0 FROM t) s) m1 JOIN m USING (x), t)""")
    return f"""WITH d AS ({FLAGS}), m AS (SELECT x, COUNT(*) AS n, AVG(y) AS p FROM d GROUP BY x), t AS (SELECT COUNT(*) AS n, AVG(y) AS p FROM d),
scores AS ({" UNION ALL ".join(parts)})
SELECT model, rounds, o_orderkey, ROUND(CASE WHEN rounds = 1 THEN p1 ELSE p2 END + 1e-9, 4) AS p FROM d JOIN scores USING (x), (VALUES (1), (2)) AS v(rounds)"""


@query("m12_boosted_flags", _boosted_sql())
def m12_boosted(spark: Spark, sf: str) -> DataFrame:
    """One and two rounds of every kind of boosting on one flag, where each has a closed form; a split below gamma goes."""
    rows, scored = flags(spark, sf), None
    n = rows.count()
    for model, (algorithm, params) in BOOSTED.items():
        for rounds in (1, 2):
            part = models.build(algorithm, params | {"maxIter": rounds}, n).fit(rows).transform(rows).select(
                F.lit(model).alias("model"), F.lit(rounds).alias("rounds"), "o_orderkey", F.round(F.get(vector_to_array("probability"), 1) + 1e-9, 4).alias("p"))
            scored = part if scored is None else scored.unionByName(part)
    return scored


@query("m12_forest_means", f"""WITH d AS ({FLAGS}), m AS (SELECT x, AVG(y) AS p FROM d GROUP BY x)
SELECT numTrees, o_orderkey, ROUND(p + 1e-9, 4) AS p FROM d JOIN m USING (x), (VALUES (1), (30)) AS v(numTrees)""")
def m12_forest(spark: Spark, sf: str) -> DataFrame:
    """Without drawn rows every tree of a forest gives the group means."""
    rows, scored = flags(spark, sf), None
    for trees in (1, 30):
        fitted = models.build("Random Forest", {"bootstrap": False, "numTrees": trees, "maxDepth": 3, "featureSubsetStrategy": "all"}, 1).fit(rows)
        part = fitted.transform(rows).select(
            F.lit(trees).alias("numTrees"), "o_orderkey", F.round(F.get(vector_to_array("probability"), 1) + 1e-9, 4).alias("p"))
        scored = part if scored is None else scored.unionByName(part)
    return scored


@query("s14_saved_group_means", f"WITH d AS ({FLAGS}), m AS (SELECT x, AVG(y) AS p FROM d GROUP BY x) SELECT o_orderkey, {r6('p')} AS p FROM d JOIN m USING (x)")
def s14_means(spark: Spark, sf: str) -> DataFrame:
    """A saved and loaded tree gives the group means."""
    rows, root = flags(spark, sf), scratch_path(spark, "models")
    save_model(PipelineModel([flag_model(rows, "Decision Tree")]), root, "label_1", "Decision Tree")
    scored = load_model(root, "label_1", "Decision Tree").transform(rows)
    return rounded(scored.select("o_orderkey", F.get(vector_to_array("probability"), 1).alias("p")))


@query("m19_log_odds_ratio", f"""WITH d AS ({FLAGS}), m AS (SELECT AVG(y) FILTER (WHERE x = 1) AS p, AVG(y) FILTER (WHERE x = 0) AS q FROM d)
SELECT 'x' AS "Feature", ROUND(LN(p / (1 - p)) - LN(q / (1 - q)) + 1e-9, 3) AS "Coefficients",
       ROUND(ABS(LN(p / (1 - p)) - LN(q / (1 - q))) + 1e-9, 3) AS "Feature importance" FROM m""")
def m19_odds(spark: Spark, sf: str) -> DataFrame:
    table = explain.feature_importance(spark, flag_model(flags(spark, sf), "Logistic Regression"), ["x"])
    return table.select("Feature", *[F.round(F.col(c) + 1e-9, 3).alias(c) for c in ("Coefficients", "Feature importance")])


@query("m20_two_means", f"""WITH d AS ({FLAGS}), m AS (SELECT x, AVG(y) AS p FROM d GROUP BY x), f AS (SELECT MIN_BY(p, x) AS p0 FROM m)
SELECT o_orderkey, CAST(m.x AS DOUBLE) AS value, {r6('m.p')} AS p, {r6('m.p - p0')} AS centred, {r6('m.p')} AS average FROM d, m, f""")
def m20_means(spark: Spark, sf: str) -> DataFrame:
    """Individual and average curves of a tree on one flag: at 0 and 1 they are the two means."""
    rows = flags(spark, sf)
    model = flag_model(rows, "Decision Tree")
    average, curves = explain.partial_dependence(model, rows, 0, "x", explain.feature_grid(rows, 0), ["o_orderkey"])
    return rounded(curves.join(average.select("value", "average"), "value").select("o_orderkey", "value", "p", "centred", "average"))


def _train(data: DataFrame, labels: list[str]) -> tuple[str, DataFrame]:
    spark, root = data.sparkSession, scratch_path(data.sparkSession, "training")
    write_snapshot(data, root, "data")
    training.write_splits(read_snapshot(spark, root, "data"), root)
    parts = [read_snapshot(spark, root, name) for name in ("train", "test", "validation")]
    for label in labels:
        result = training.train(*parts, label, root, models.GRIDS, draws=DRAWS, folds=FOLDS)
    return root, result


@query("k15_train")
def k15(spark: Spark, sf: str) -> DataFrame:
    return _train(feature_data(spark, sf), ["label_1"])[1]


@query("k16_score")
def k16(spark: Spark, sf: str) -> DataFrame:
    """Three models on all features, then the next games scored with the best algorithm."""
    root, _ = _train(feature_data(spark, sf), ["label_1", "label_X", "label_2"])
    return training.score(spark, root, read_snapshot(spark, root, "score"))
