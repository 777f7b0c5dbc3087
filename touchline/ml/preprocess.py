"""Imputation, scaling, principal components and one-hot encoding as one ML pipeline."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import PCA, ElementwiseProduct, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.ml.fold_statistics import ALL, fold_moments, held_out_quantiles
from touchline.operators.quantiles import exact_quantiles
from touchline.operators.relational import cols_like, long_form, with_names

FEATURES = "features"
COMPONENTS = 5

# Columns that are never features, and the name terms of the feature families.
NOT_FEATURES = [
    "season_start_year", "GW", "id", "team_h", "team_a", "home", "away", "train_score", "kickoff_year",
    "kickoff_month", "kickoff_date", "label_1", "label_X", "label_2",
]
# Text in memory that is a number wherever the feature table has been stored and read back.
NUMERIC_TEXT = ("season",)
FAMILIES = {
    "games": ["_games_overall_", "_games_home_", "_games_away_"],
    "tbl": ["tbl_"],
    "player": ["player_"],
}


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians; a column without values is left out."""
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per text column, the smallest on ties.

    Counted per value first, so the candidates of a column never meet in one buffer.
    """
    if not columns:
        return {}
    best = (
        long_form(df, columns, "string").filter(F.col("x").isNotNull())
        .groupBy("feature_no", "x").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("feature_no").agg(F.min_by("x", F.struct(-F.col("n"), F.col("x"))).alias("mode"))
    )
    return {r.feature: r["mode"] for r in with_names(best, columns).collect()}


def impute_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(modes(df, columns), subset=list(columns))


def scales(
    df: DataFrame, columns: Sequence[str], fill: Mapping[str, float] | None = None
) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, as they are after filling where ``fill`` is given.

    Filled values enter by their number, so the rows are not rewritten. A constant column gets
    deviation 1, a column without values is left out.
    """
    if not columns:
        return {}
    stats = (
        long_form(df, columns).groupBy("feature_no")
        .agg(
            F.count("x").alias("n"), F.count_if(F.col("x").isNull()).alias("gaps"),
            F.avg("x").alias("m"), F.var_pop("x").alias("v"),
        )
        .collect()
    )
    found = {}
    for row in stats:
        name = columns[row.feature_no]
        if not row.n:
            continue
        center, spread = row.m, row.v
        if fill and row.gaps:
            center = (row.n * row.m + row.gaps * fill[name]) / (row.n + row.gaps)
            known, filled = row.n * (row.v + (row.m - center) ** 2), row.gaps * (fill[name] - center) ** 2
            spread = (known + filled) / (row.n + row.gaps)
        found[name] = (center, math.sqrt(spread) if spread > 0 else 1.0)
    return {c: found[c] for c in columns if c in found}


def standardise(df: DataFrame, columns: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Append ``(x - mean) / population deviation``; nulls stay null."""
    return df.select("*", *[
        ((F.col(c) - F.lit(m)) / F.lit(s)).alias(prefix + c) for c, (m, s) in scales(df, columns).items()
    ])


def _sql_scaling(fill: Mapping[str, float], scale: Mapping[str, tuple[float, float]], modal: Mapping[str, str]) -> str:
    """All imputation and scaling as one projection."""
    parts = [
        f"(coalesce(double(`{c}`), {fill[c]!r}D) - {m!r}D) / {s!r}D AS `z_{c}`" for c, (m, s) in scale.items()
    ]
    for c, value in modal.items():
        text = value.replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"coalesce(`{c}`, '{text}') AS `m_{c}`")
    return f"SELECT *, {', '.join(parts)} FROM __THIS__" if parts else "SELECT * FROM __THIS__"


def pca_block(df: DataFrame, columns: Sequence[str], name: str, k: int = COMPONENTS) -> list[Transformer]:
    """Stages that turn scaled columns into ``<name>_pca``, each axis signed so that its largest
    loading is positive. Fitting aggregates a columns x columns matrix; its size does not grow with rows."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol=f"__{name}")
    raw = PCA(k=min(k, len(columns)), inputCol=f"__{name}", outputCol=f"__{name}_raw").fit(assembler.transform(df))
    loadings = raw.pc.toArray()
    strongest = abs(loadings).argmax(axis=0)
    signs = [1.0 if loadings[row, i] >= 0 else -1.0 for i, row in enumerate(strongest)]
    signed = ElementwiseProduct(
        scalingVec=Vectors.dense(signs), inputCol=f"__{name}_raw", outputCol=f"{name}_pca"
    )
    return [assembler, raw, signed]


def one_hot(df: DataFrame, columns: Sequence[str]) -> list[Transformer]:
    """Stages that turn each text column into ``<column>_hot``; an unknown value becomes all zeros."""
    if not columns:
        return []
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_index" for c in columns], handleInvalid="keep"
    ).fit(df)
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_hot" for c in columns], dropLast=True
    ).fit(indexer.transform(df))
    return [indexer, encoder]


def signed_axes(correlation: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` axes of a covariance or correlation matrix, each signed so that its largest loading is positive."""
    _, vectors = np.linalg.eigh(correlation)
    axes = vectors[:, ::-1][:, :k]
    strongest = np.abs(axes).argmax(axis=0)
    return axes * np.where(axes[strongest, np.arange(axes.shape[1])] >= 0, 1.0, -1.0)


@dataclass(frozen=True)
class Preprocessor:
    """Selected numeric columns, components of each family, one-hot text columns, in this order."""

    numeric: list[str]
    families: dict[str, list[str]]
    categorical: list[str] = field(default_factory=list)
    components: int = COMPONENTS

    def fit(self, df: DataFrame) -> PipelineModel:
        columns = list(dict.fromkeys([*self.numeric, *[c for f in self.families.values() for c in f]]))
        fill = medians(df, columns)
        known = [c for c in columns if c in fill]  # columns without any value are dropped
        modal = modes(df, self.categorical)
        scaling = SQLTransformer(statement=_sql_scaling(fill, scales(df, known, fill), modal))
        scaled = scaling.transform(df)

        stages: list = [scaling]
        inputs = [f"z_{c}" for c in self.numeric if c in fill]
        blocks = [(n, [f"z_{c}" for c in members if c in fill]) for n, members in self.families.items()]
        blocks = [(name, block) for name, block in blocks if block]
        for name, block in blocks:
            stages += pca_block(scaled, block, name, self.components)
            inputs.append(f"{name}_pca")
        hot = one_hot(scaled, [f"m_{c}" for c in modal])
        stages += hot
        inputs += [f"m_{c}_hot" for c in modal]
        if not inputs:
            raise ValueError("no features left")
        stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
        return PipelineModel(stages)


    def fit_folds(self, df: DataFrame, fold: str | None = None) -> dict[int, PipelineModel]:
        """The fitted stages for each fold held out, and for all rows (``ALL``), from statistics that add up.

        Medians, means, deviations and the axes of every family come from one pass for the moments and a few for the medians, for all
        folds together; each equals :meth:`fit` on the rows that are left. Text columns are counted per fold held out.
        """
        columns = list(dict.fromkeys([*self.numeric, *[c for f in self.families.values() for c in f]]))
        fills = held_out_quantiles(df, columns, [0.5], fold)
        if not columns:
            folds = [] if fold is None else [r[0] for r in df.select(fold).distinct().collect() if r[0] is not None and r[0] >= 0]
            fills = {f: {} for f in [ALL, *folds]}
        shift = {c: fills[ALL].get(c, [0.0])[0] for c in columns}
        moments = fold_moments(df, columns, shift, fold) if columns else {}
        empty = moments[ALL] - moments[ALL] if moments else None
        models = {}
        for held_out, known in fills.items():
            left = df if held_out == ALL else df.filter(F.col(fold) != held_out)
            fill = {c: known[c][0] for c in columns if c in known}
            scale: dict[str, tuple[float, float]] = {}
            axes: dict[str, np.ndarray] = {}
            if fill:
                of = moments[ALL] if held_out == ALL else moments[ALL] - moments.get(held_out, empty)
                middle = np.array([shift[c] for c in columns])
                mean, cov = of.filled(np.array([fill.get(c, 0.0) for c in columns]) - middle)
                deviation = np.sqrt(np.diag(cov))
                deviation = np.where(deviation > 0, deviation, 1.0)
                scale = {c: (float(mean[i] + middle[i]), float(deviation[i])) for i, c in enumerate(columns) if c in fill}
                correlation = cov / np.outer(deviation, deviation)
                for name, members in self.families.items():
                    own = [columns.index(c) for c in members if c in fill]
                    if own:
                        axes[name] = signed_axes(correlation[np.ix_(own, own)], min(self.components, len(own)))
            models[held_out] = self._stages(left, fill, scale, modes(left, self.categorical), axes)
        return models

    def _stages(self, df: DataFrame, fill: Mapping[str, float], scale: Mapping[str, tuple[float, float]], modal: Mapping[str, str],
                axes: Mapping[str, np.ndarray]) -> PipelineModel:
        scaling = SQLTransformer(statement=_sql_scaling(fill, scale, modal))
        stages: list = [scaling]
        inputs = [f"z_{c}" for c in self.numeric if c in fill]
        for name, loadings in axes.items():
            stages.append(VectorAssembler(inputCols=[f"z_{c}" for c in self.families[name] if c in fill], outputCol=f"__{name}"))
            stages.append(Rotation(f"__{name}", f"{name}_pca", loadings.tolist()))
            inputs.append(f"{name}_pca")
        stages += one_hot(scaling.transform(df), [f"m_{c}" for c in modal]) if modal else []
        inputs += [f"m_{c}_hot" for c in modal]
        if not inputs:
            raise ValueError("no features left")
        return PipelineModel([*stages, VectorAssembler(inputCols=inputs, outputCol=FEATURES)])


class Rotation(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Multiplies a vector column by a matrix, entry by entry in column expressions."""

    inputCol = Param(Params._dummy(), "inputCol", "vector to rotate")
    outputCol = Param(Params._dummy(), "outputCol", "rotated vector")
    loadings = Param(Params._dummy(), "loadings", "one list for each entry of the input")

    def __init__(self, inputCol: str = "", outputCol: str = "", loadings: Sequence[Sequence[float]] = ()):  # noqa: N803
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, loadings=[list(map(float, row)) for row in loadings])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = self.getOrDefault(self.loadings)
        x, width = vector_to_array(self.getOrDefault(self.inputCol)), len(rows[0])
        zipped = [F.lit([row[k] for row in rows]) for k in range(width)]
        parts = [F.aggregate(F.zip_with(x, axis, lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v) for axis in zipped]
        out = self.getOrDefault(self.outputCol)
        names = [{"idx": i, "name": str(i)} for i in range(width)]
        meta = {"ml_attr": {"attrs": {"numeric": names}, "num_attrs": width}}
        return dataset.withColumn(out, array_to_vector(F.array(*parts)).alias(out, metadata=meta)).withMetadata(out, meta)


def build_preprocessor(
    df: DataFrame,
    selected: Sequence[str],
    families: Mapping[str, Sequence[str]] = FAMILIES,
    exclude: Sequence[str] = tuple(NOT_FEATURES),
    components: int = COMPONENTS,
) -> Preprocessor:
    """Selected columns by type, and every numeric column of each family, selected or not.

    A column whose text form is a number (``season``) counts as numeric.
    """
    usable = [c for c in df.columns if c not in exclude]
    text = {
        c for c in usable if isinstance(df.schema[c].dataType, T.StringType) and c not in NUMERIC_TEXT
    }
    members = {
        name: [c for c in cols_like(df, any_of=terms) if c in usable and c not in text]
        for name, terms in families.items()
    }
    return Preprocessor(
        [c for c in usable if c in selected and c not in text],
        {name: found for name, found in members.items() if found},
        [c for c in usable if c in selected and c in text],
        components,
    )


def feature_names(df: DataFrame, column: str = FEATURES) -> list[str]:
    """Names of the vector's entries, in order, from the column's metadata."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    entries = sorted((a for g in groups for a in g), key=lambda a: a["idx"])
    return [a["name"].removeprefix("z_") for a in entries]

