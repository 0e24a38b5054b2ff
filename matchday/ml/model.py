"""Training, search, persistence, scoring and explanation of the weighted
multi-class tree model with ``pyspark.ml``.

Trees in MLlib reject NaN/NULL features, so every feature gets a median
imputation (fitted on training rows only) plus a 0/1 ``<col>_na``
indicator, which keeps the "was missing" signal the reference's booster
learned from NaN directly.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from matchday.functions.bins import BIN_EDGES, decode_expected


@dataclass(frozen=True)
class TreeParams:
    """Hyper-parameters (reference defaults in comments; the boosted model
    maps n_estimators -> maxIter, max_depth -> maxDepth, learning_rate ->
    stepSize, subsample -> subsamplingRate, colsample -> featureSubsetStrategy)."""

    max_iter: int = 20            # reference grid point: 1000 trees
    max_depth: int = 5            # reference grid point: 7
    step_size: float = 0.1        # reference grid point: 0.005
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    min_info_gain: float = 0.0    # role of the booster's gamma
    num_trees: int = 50           # random forest only
    seed: int = 1298


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Numeric columns not listed in ``exclude`` (keys, targets, labels)."""
    ex = set(exclude)
    return [
        f.name for f in df.schema.fields
        if f.name not in ex and f.dataType.typeName() in ("double", "float", "integer", "long")
    ]


def na_indicator_stage(feats: Sequence[str]) -> SQLTransformer:
    """Pipeline stage adding ``<col>_na`` = 1.0 where the feature is NULL
    (saved with the model, so scoring rebuilds the same indicators)."""
    cols = ", ".join(f"CAST(`{c}` IS NULL OR isnan(`{c}`) AS DOUBLE) AS `{c}_na`" for c in feats)
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


def build_pipeline(
    feats: Sequence[str],
    kind: str = "rf",
    params: TreeParams = TreeParams(),
    label: str = "label",
    weight: str | None = "weight",
) -> Pipeline:
    """Imputer(median) -> VectorAssembler -> classifier / regressor.

    ``kind``: ``rf`` (random forest, native multi-class), ``gbt_ovr``
    (boosted trees, one-vs-rest over the classes) or ``gbt_reg`` (boosted
    regression on the label value)."""
    imputed = [c + "_imp" for c in feats]
    na_feats = [c + "_na" for c in feats]
    stages = [
        na_indicator_stage(feats),
        Imputer(inputCols=list(feats), outputCols=imputed, strategy="median"),
        VectorAssembler(inputCols=imputed + na_feats, outputCol="features", handleInvalid="keep"),
    ]
    common = dict(featuresCol="features", labelCol=label)
    if kind == "rf":
        est = RandomForestClassifier(
            numTrees=params.num_trees, maxDepth=params.max_depth, seed=params.seed,
            subsamplingRate=params.subsampling_rate, featureSubsetStrategy=params.feature_subset,
            minInfoGain=params.min_info_gain, **common,
        )
        if weight:
            est.setWeightCol(weight)
    elif kind == "gbt_ovr":
        base = GBTClassifier(
            maxIter=params.max_iter, maxDepth=params.max_depth, stepSize=params.step_size,
            subsamplingRate=params.subsampling_rate, featureSubsetStrategy=params.feature_subset,
            minInfoGain=params.min_info_gain, seed=params.seed,
        )
        est = OneVsRest(classifier=base, parallelism=4, **common)
        if weight:
            est.setWeightCol(weight)
    elif kind == "gbt_reg":
        est = GBTRegressor(
            maxIter=params.max_iter, maxDepth=params.max_depth, stepSize=params.step_size,
            subsamplingRate=params.subsampling_rate, featureSubsetStrategy=params.feature_subset,
            minInfoGain=params.min_info_gain, seed=params.seed, lossType="squared", **common,
        )
        if weight:
            est.setWeightCol(weight)
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    return Pipeline(stages=stages + [est])


def random_param_maps(est, n_draws: int, seed: int = 1298) -> list[dict]:
    """Random-search draws (driver side, ``n_draws`` small dicts):
    trees ~ U{300..999}, depth ~ U{4..12}, rate one of 0.01 / 0.1 / 0.5,
    minimum gain ~ InvGamma(1.8), rows and columns per tree 0.85.  The
    booster's L2 penalty has no counterpart in MLlib trees."""
    rng = random.Random(seed)
    inner = est.getClassifier() if isinstance(est, OneVsRest) else est
    trees = inner.getParam("maxIter") if inner.hasParam("maxIter") else inner.getParam("numTrees")
    maps = []
    for _ in range(n_draws):
        m = {
            trees: rng.randint(300, 999),
            inner.getParam("maxDepth"): rng.randint(4, 12),
            inner.getParam("subsamplingRate"): 0.85,
            inner.getParam("featureSubsetStrategy"): "0.85",
            inner.getParam("minInfoGain"): 1.0 / rng.gammavariate(1.8, 1.0),
        }
        if inner.hasParam("stepSize"):
            m[inner.getParam("stepSize")] = rng.choice([0.01, 0.1, 0.5])
        maps.append(m)
    return maps


def cross_validate(
    pipeline: Pipeline,
    train: DataFrame,
    fold_col: str = "fold",
    param_maps: list[dict] | None = None,
    metric: str = "mse",
    parallelism: int = 3,
):
    """CrossValidator over precomputed folds (``foldCol``); scored by MSE of
    the class codes (the reference's search metric) or by accuracy."""
    est = pipeline.getStages()[-1]
    maps = param_maps or ParamGridBuilder().addGrid(est.maxDepth, [est.getOrDefault("maxDepth")]).build()
    if metric == "mse":
        ev = RegressionEvaluator(metricName="mse", labelCol="label", predictionCol="prediction")
    else:
        ev = MulticlassClassificationEvaluator(metricName=metric, labelCol="label", predictionCol="prediction")
    cv = CrossValidator(
        estimator=pipeline, estimatorParamMaps=maps, evaluator=ev,
        foldCol=fold_col, parallelism=parallelism, collectSubModels=False,
    )
    return cv.fit(train)


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    return pipeline.fit(train)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def softmax_column(raw: Column) -> Column:
    """Raw scores of the classes as probabilities that add up to 1; the
    greatest score is subtracted first, so that no exponential overflows."""
    e = F.transform(raw, lambda x: F.exp(x - F.array_max(raw)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def score(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predicted class code, its decoded bin label and expected mark
    (label + 6; the lowest bin decodes to -14) and the winning probability
    (one-vs-rest raw scores are normalised by a softmax).  ``model`` is a
    fitted pipeline or a :class:`matchday.ml.boost.Booster`."""
    out = model.transform(df)
    if "probability" not in out.columns:
        p = softmax_column(vector_to_array("rawPrediction"))
    elif isinstance(out.schema["probability"].dataType, ArrayType):
        p = F.col("probability")
    else:
        p = vector_to_array("probability")
    pairs = []
    for i, lo in enumerate(BIN_EDGES[:-1]):
        pairs += [F.lit(i), F.lit(lo)]
    code = F.col("prediction").cast("int")
    return out.select(
        *keep,
        code.alias("predicted_code"),
        F.element_at(F.create_map(*pairs), code).alias("expected_fv_scaled_binned"),
        decode_expected(code).alias("expected_fv"),
        F.array_max(p).alias("probability"),
    )


def feature_importance(model: PipelineModel) -> list[tuple[str, float]]:
    """(feature, importance) from the fitted trees; one-vs-rest models are
    averaged over the per-class models.  Small: one entry per feature."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names = [c[:-4] if c.endswith("_imp") else c for c in assembler.getInputCols()]
    est = model.stages[-1]
    if hasattr(est, "featureImportances"):
        imp = est.featureImportances.toArray()
    else:
        arrs = [m.featureImportances.toArray() for m in est.models]
        imp = [sum(v) / len(arrs) for v in zip(*arrs)]
    return sorted(zip(names, map(float, imp)), key=lambda t: -t[1])


def accuracy(df: DataFrame, truth: str = "label", pred: str = "prediction") -> float:
    r = df.agg(F.avg((F.col(truth).cast("double") == F.col(pred)).cast("double")).alias("a")).first()
    return float(r["a"]) if r and r["a"] is not None else math.nan


def validate(pipeline: Pipeline, sample: DataFrame, fold_col: str = "fold") -> list[float]:
    """Accuracy of each fold model on its held-out fold (the fold models
    are fitted on the other folds of ``sample``)."""
    folds = sorted(r[fold_col] for r in sample.select(fold_col).distinct().collect())
    out = []
    for f in folds:
        m = pipeline.fit(sample.filter(F.col(fold_col) != f))
        out.append(accuracy(m.transform(sample.filter(F.col(fold_col) == f))))
    return out
