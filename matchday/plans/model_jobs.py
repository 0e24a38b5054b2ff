"""Model jobs: train on the split, persist, reload, score; search, fold
models, regression, importances, metrics of the model's own predictions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.functions.bins import encode_label
from matchday.ml import boost as B
from matchday.ml import model as M
from matchday.ml.explain import booster_importance
from matchday.operators.assemble import with_role_dummies
from matchday.operators.metrics import prediction_metrics, regression_scores
from matchday.operators.prune import drop_sparse_columns, drop_sparse_rows
from matchday.operators.split import (
    contiguous_folds,
    encode_labels,
    label_codes,
    stratified_folds,
    stratified_split,
    validation_sample,
)
from matchday.session import scratch_path

KEYS = ["name", "surname", "season", "round_no"]
NON_FEATURES = KEYS + ["role", "fwd_fantavoto", "fwd_fv_scaled", "fv_bin", "label", "weight", "row_id", "split", "fold"]
# --- fixed values ------------------------------------------------------------------
COL_NULL_SHARE = 0.25
ROW_NULL_SHARE = 0.30
TOP_K = 40
VALIDATION_ROWS = 1000
N_FOLDS = 5
# -----------------------------------------------------------------------------------

#: The registered jobs run a short form of the one grid point (B.BoostParams(): 1000
#: rounds of depth 7 at rate 0.005), so that they end in a test's time.
TRIAL = B.BoostParams(rounds=12, depth=4, rate=0.3)
#: Draws of the search (the reference's number); each runs all its rounds at its own depth.
N_DRAWS = 80

# Outputs of the jobs by (application, job, parameters, input files): the pruned
# training table, the labelled rows with their split, the model and its
# predictions are written once and read by all queries below.
_OUTPUTS: dict[tuple, str] = {}


def forget() -> None:
    """Lets the next query run its jobs again (the files go with the session)."""
    _OUTPUTS.clear()


def _inputs(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the files in the folder: other content is another key."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files, found = fs.listFiles(path, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def _once(spark: SparkSession, sf_dir: str, job: str, params, run) -> str:
    """The output folder of ``run(folder)``, unless this session has it."""
    key = (spark.sparkContext.applicationId, job, params, _inputs(spark, sf_dir))
    if key not in _OUTPUTS:
        base = scratch_path(spark, f"models/{job}-{uuid.uuid4().hex}")
        run(base)
        _OUTPUTS[key] = base
    return _OUTPUTS[key]


def _data_job(spark: SparkSession, sf_dir: str) -> str:
    """Training table -> sparse columns dropped (null share > 0.25 over ALL
    rows, targets and keys exempt) -> sparse rows dropped (null share > 0.3
    over the surviving columns) -> role dummies -> rows with a target ->
    bins -> split -> class codes of the labels that the split has, in the
    reference's order.  The profile is one aggregate whose result has one row
    per column.  The split is a column of the written rows, which are
    partitioned by it, so train and test are read back without a join."""
    from matchday.plans.queries import labelled_rows, training_set

    def run(base):
        training_set(spark, sf_dir).write.parquet(f"{base}/table")
        ts = spark.read.parquet(f"{base}/table")
        pruned, _dropped = drop_sparse_columns(
            ts, COL_NULL_SHARE, exempt=["fwd_fantavoto", "fwd_fv_scaled"], keys=KEYS + ["role"]
        )
        with_role_dummies(drop_sparse_rows(pruned, ROW_NULL_SHARE)).write.parquet(f"{base}/pruned")
        lr = labelled_rows(spark, sf_dir, spark.read.parquet(f"{base}/pruned"))
        data = stratified_split(lr, ["fv_bin", "role"], "row_id").filter(F.col("label").isNotNull())
        data.write.partitionBy("split").parquet(f"{base}/labelled")

    return _once(spark, sf_dir, "data", None, run)


def _rows(spark: SparkSession, sf_dir: str, split: str | None = None) -> tuple[DataFrame, list[str]]:
    """Labelled rows (of one side of the split) and their feature columns."""
    data = spark.read.parquet(f"{_data_job(spark, sf_dir)}/labelled")
    feats = M.feature_columns(data, NON_FEATURES)
    return (data if split is None else data.filter(F.col("split") == split)), feats


def _training_job(spark: SparkSession, sf_dir: str, kind: str = "boost", params=None) -> str:
    """Folder with the fitted ``model`` and its ``predictions`` of all labelled
    rows.  ``kind``: ``boost`` (softmax boosting), or an estimator of
    :func:`matchday.ml.model.build_pipeline` with its TreeParams."""
    params = TRIAL if params is None else params

    def run(base):
        data, feats = _rows(spark, sf_dir)
        train = data.filter(F.col("split") == "train").withColumn("label", F.col("label").cast("double"))
        if kind == "boost":
            classes = data.agg(F.max("label").alias("m")).first()["m"]
            B.fit_booster(
                train, feats, "label", "weight", "row_id", 1 + (-1 if classes is None else int(classes)), params
            ).save(spark, f"{base}/model")
        else:
            M.save(M.fit(M.build_pipeline(feats, kind=kind, params=params), train), f"{base}/model")
        M.score(_model(spark, base, kind), data, KEYS + ["split", "label"]).write.parquet(f"{base}/predictions")

    return _once(spark, sf_dir, f"model-{kind}", params, run)


def _model(spark: SparkSession, base: str, kind: str = "boost"):
    return B.Booster.load(spark, f"{base}/model") if kind == "boost" else M.load(f"{base}/model")


def q28_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted softmax boosting: fit on the train split, saved, reloaded;
    the score of every labelled row (split column tells in/out of sample)."""
    return spark.read.parquet(f"{_training_job(spark, sf_dir)}/predictions")


def q28d_labelled_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, class (encoded again from the saved bin label) and split of the
    rows that the model sees."""
    rows, _ = _rows(spark, sf_dir)
    return rows.select(*KEYS, encode_label(F.col("fv_bin")).alias("label"), "split")


def q28e_label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved labels of train and test encoded again from the data: dense codes
    of the labels that occur.  The middle class is left out beforehand, so
    the codes differ from the fixed seven."""
    rows, _ = _rows(spark, sf_dir)
    rows = rows.where("fv_bin <> 0.0").select(*KEYS, "fv_bin", "split")
    return encode_labels(rows, "fv_bin", label_codes(rows, "fv_bin"))


def q28b_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top and bottom 40 features by tree importance."""
    imp = _model(spark, _training_job(spark, sf_dir)).importance()
    rows = [(n, v, i + 1, "top") for i, (n, v) in enumerate(imp[:TOP_K])]
    tail = imp[-TOP_K:]
    rows += [(n, v, len(imp) - len(tail) + i + 1, "bottom") for i, (n, v) in enumerate(tail)]
    return spark.createDataFrame(rows, "feature string, importance double, rank int, side string")


def q30_permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy drop on the test split when one feature is permuted."""
    test, _ = _rows(spark, sf_dir, "test")
    return booster_importance(_model(spark, _training_job(spark, sf_dir)), test, "row_id")


def q31_prediction_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's own train and test predictions measured: per split and
    class precision, recall, F1 and support, the averages, accuracy,
    balanced accuracy and Matthews correlation, and the distribution of true
    and predicted classes, under the classes' bin labels."""
    preds = spark.read.parquet(f"{_training_job(spark, sf_dir)}/predictions")
    return prediction_metrics(preds, "split", "label", "predicted_code")


def q35_param_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random search: draws on five class-stratified folds of the train split,
    scored by the mean squared error of the class codes; every draw runs all
    its rounds on every fold.  One row per draw and fold."""

    def run(base):
        train, feats = _rows(spark, sf_dir, "train")
        folded = stratified_folds(train, ["fv_bin"], "row_id")
        n = train.agg(F.max("label").alias("m")).first()["m"]
        draws = B.random_draws(N_DRAWS)
        found = B.search(folded, feats, "label", "weight", "row_id", int(n or 0) + 1, "fold", N_FOLDS, draws)
        found.write.parquet(f"{base}/results")

    return spark.read.parquet(f"{_once(spark, sf_dir, 'search', N_DRAWS, run)}/results")


def _validation_job(spark: SparkSession, sf_dir: str) -> str:
    """The five fold models of the validation sample, saved with their scores
    and the sample they were measured on."""

    def run(base):
        train, feats = _rows(spark, sf_dir, "train")
        sample = stratified_folds(validation_sample(train, "row_id", VALIDATION_ROWS), ["fv_bin"], "row_id", n_folds=N_FOLDS)
        sample.write.parquet(f"{base}/sample")
        sample = spark.read.parquet(f"{base}/sample")
        n = train.agg(F.max("label").alias("m")).first()["m"]
        models, errors = B.fit_folds(sample, feats, "label", "weight", "row_id", int(n or 0) + 1, "fold", N_FOLDS, TRIAL)
        rows = []
        for fold, (model, e) in enumerate(zip(models, errors, strict=False)):
            model.save(spark, f"{base}/fold-{fold}")
            rows.append((fold, int(e["n"]), int(e["right"]) / e["n"] if e["n"] else None, f"fold-{fold}"))
        spark.createDataFrame(rows, "fold int, n_rows long, accuracy double, model string").write.parquet(f"{base}/scores")

    return _once(spark, sf_dir, "validation", TRIAL, run)


def q36_validation_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of each fold model on the fold it did not see (1000 rows of
    the train split), and the name under which it is kept."""
    return spark.read.parquet(f"{_validation_job(spark, sf_dir)}/scores")


def _regression_job(spark: SparkSession, sf_dir: str) -> str:
    """Squared-loss boosting of the scaled target: each train row predicted by
    the model of the other contiguous folds, test rows by the model of all."""

    def run(base):
        train, feats = _rows(spark, sf_dir, "train")
        test, _ = _rows(spark, sf_dir, "test")
        folded = contiguous_folds(train, ["season", "round_no", "surname", "name"], N_FOLDS)
        folded.write.parquet(f"{base}/folded")
        folded = spark.read.parquet(f"{base}/folded")
        models, _errors = B.fit_folds(folded, feats, "fwd_fv_scaled", None, "row_id", 0, "fold", N_FOLDS, TRIAL)
        final = B.fit_booster(train, feats, "fwd_fv_scaled", None, "row_id", 0, TRIAL)
        final.save(spark, f"{base}/model")
        columns = [*KEYS, "fwd_fv_scaled", "prediction"]
        out = final.transform(test).select(F.lit("test").alias("part"), *columns)
        for fold, m in enumerate(models):
            out = out.unionByName(m.transform(folded.where(F.col("fold") == fold)).select(F.lit("folds").alias("part"), *columns))
        out.write.parquet(f"{base}/predictions")

    return _once(spark, sf_dir, "regression", TRIAL, run)


def q37_regression_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MSE, explained variance and median absolute error of the regressor's
    predictions: rows of the train split out of fold, and the test split."""
    preds = spark.read.parquet(f"{_regression_job(spark, sf_dir)}/predictions")
    out = None
    for part in ("folds", "test"):
        one = regression_scores(preds.where(F.col("part") == part), "fwd_fv_scaled", "prediction")
        one = one.select(F.lit(part).alias("part"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def q28c_watchlist_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for the coach's watch list: rows of the newest season up
    to the final round of the scoring window, sorted by season, surname,
    name, round.  The watch list is derived from the data (every forward,
    role 'A', with their team)."""
    from matchday.operators.calendar import last_played_round
    from matchday.plans import views as V
    from matchday.plans.queries import player_master

    model = _model(spark, _training_job(spark, sf_dir))
    rows = spark.read.parquet(f"{_data_job(spark, sf_dir)}/pruned")
    final_round = last_played_round(V.calendar(spark, sf_dir)).first()["final_round"]   # one row
    newest = rows.agg(F.max("season").alias("s")).first()["s"]                         # one row
    watch = (
        player_master(V.player_match(spark, sf_dir))
        .filter(F.col("role") == "A")
        .select(F.col("name").alias("_w_name"), F.col("surname").alias("_w_surname"), "team")
        .distinct()
    )
    cond = F.col("name").eqNullSafe(F.col("_w_name")) & F.col("surname").eqNullSafe(F.col("_w_surname"))
    scored_rows = rows.filter((F.col("season") == newest) & (F.col("round_no") <= final_round)).join(
        watch, cond
    )
    preds = M.score(model, scored_rows, KEYS + ["team"])
    return preds.select(
        *KEYS, "team",
        F.col("expected_fv_scaled_binned").alias("expected_fv_scaled"),
        "expected_fv", "probability",
    ).orderBy("season", "surname", "name", "round_no")
