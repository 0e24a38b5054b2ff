"""The model jobs' outputs against SQL over the written predictions, and kept models."""

import duckdb
import pytest
from pyspark.sql import functions as F

from matchday.ml import boost as B
from matchday.ml import model as M
from matchday.operators.split import encode_labels, label_codes
from matchday.plans import model_jobs as MJ

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def short(spark):
    """Trial runs short enough for the smallest tables."""
    old = MJ.TRIAL, MJ.N_DRAWS
    MJ.TRIAL, MJ.N_DRAWS = B.BoostParams(rounds=3, depth=2, rate=0.4), 3
    MJ.forget()
    yield
    MJ.TRIAL, MJ.N_DRAWS = old
    MJ.forget()


def test_outputs_are_kept_by_parameters(spark, short):
    one = MJ._training_job(spark, SF, params=MJ.TRIAL)
    assert MJ._training_job(spark, SF, params=MJ.TRIAL) == one
    assert MJ._training_job(spark, SF, kind="rf", params=M.TreeParams(num_trees=2, max_depth=2)) != one
    assert MJ._inputs(spark, SF) != MJ._inputs(spark, "/root/testdata/sf0.01")


def test_metrics_equal_sql(spark, short):
    base = MJ._training_job(spark, SF, params=MJ.TRIAL)
    got = {(r["split"], r["kind"], r["label"], r["measure"]): r["value"] for r in MJ.prediction_metrics(
        spark.read.parquet(f"{base}/predictions"), "split", "label", "predicted_code").collect()}
    preds = f"'{base.removeprefix('file:')}/predictions/*.parquet'"
    for split, label, tp, support, predicted in duckdb.sql(f"""
        with c as (select split, label, predicted_code as p, count(*) n from {preds} group by all),
        l as (select distinct split, label from c union select distinct split, p from c)
        select l.split, l.label, coalesce(sum(n) filter (c.label = l.label and p = l.label), 0),
               coalesce(sum(n) filter (c.label = l.label), 0), coalesce(sum(n) filter (p = l.label), 0)
        from l join c using (split) group by l.split, l.label""").fetchall():
        key = (split, "class", str(label))
        assert got[*key, "support"] == support
        assert got[*key, "recall"] == pytest.approx(tp / support if support else 0)
        assert got[*key, "precision"] == pytest.approx(tp / predicted if predicted else 0)
    right = duckdb.sql(f"select split, avg((label = predicted_code)::int) from {preds} group by split").fetchall()
    for split, share in right:
        assert got[split, "summary", None, "accuracy"] == pytest.approx(share)
    # the distribution carries the bins' labels
    edges = {k[2] for k in got if k[1] == "distribution"}
    assert edges <= {"-20.0", "-2.5", "-0.5", "0.0", "0.5", "2.5", "4.5"}


def test_regression_equals_sql(spark, short):
    got = {r["part"]: r for r in MJ.q37_regression_model(spark, SF).collect()}
    base = MJ._regression_job(spark, SF).removeprefix("file:")
    for part, n, mse, exvar, med in duckdb.sql(f"""
        select part, count(*), avg((fwd_fv_scaled - prediction) ** 2),
               1 - var_pop(fwd_fv_scaled - prediction) / var_pop(fwd_fv_scaled),
               quantile_cont(abs(fwd_fv_scaled - prediction), 0.5)
        from '{base}/predictions/*.parquet' group by part""").fetchall():
        r = got[part]
        assert (r["n"], r["mse"], r["explained_variance"], r["median_abs_error"]) == (
            n, pytest.approx(mse), pytest.approx(exvar), pytest.approx(med))
    rows = spark.read.parquet(f"{MJ._regression_job(spark, SF)}/predictions")
    assert rows.count() == MJ._rows(spark, SF)[0].count()


def test_fold_models_load_and_reproduce_their_scores(spark, short):
    scores = MJ.q36_validation_models(spark, SF).collect()
    base = MJ._validation_job(spark, SF)
    sample = spark.read.parquet(f"{base}/sample")
    assert sample.count() == min(1000, MJ._rows(spark, SF, "train")[0].count()) and len(scores) == 5
    for r in scores:
        p = B.Booster.load(spark, f"{base}/{r['model']}").transform(sample.where(F.col("fold") == r["fold"]))
        assert p.agg(F.avg((F.col("prediction") == F.col("label")).cast("int")).alias("a")).first()["a"] == pytest.approx(r["accuracy"])


def test_search_rows(spark, short):
    rows = MJ.q35_param_search(spark, SF).collect()
    assert len(rows) == 15 and {r["fold"] for r in rows} == set(range(5)) and sorted({r["rank"] for r in rows}) == [1, 2, 3]
    assert all(r["mse"] >= 0 for r in rows if r["n_rows"])


def test_search_runs_draws_whole(spark, short):
    ran = {(r["draw"], r["rounds"], r["depth"], r["rate"], r["gain"], r["l2"]) for r in MJ.q35_param_search(spark, SF).collect()}
    assert ran == {(i, p.rounds, p.depth, p.rate, p.gain, p.l2) for i, p in enumerate(B.random_draws(3))}


def test_permutation_importance_equals_copied_rows(spark, short):
    from matchday.ml.explain import permutation_importance

    got = {r["feature"]: r for r in MJ.q30_permutation_importance(spark, SF).collect()}
    test, feats = MJ._rows(spark, SF, "test")
    want = permutation_importance(MJ._model(spark, MJ._training_job(spark, SF, params=MJ.TRIAL)), test, feats, "row_id").collect()
    assert len(got) == len(want) == len(feats)
    for r in want:
        g = got[r["feature"]]
        assert g["base_accuracy"] == pytest.approx(r["base_accuracy"]) and g["permuted_accuracy"] == pytest.approx(r["permuted_accuracy"])


def test_label_codes(spark):
    rows = [(2.5,), (-20.0,), (None,), (0.5,), (2.5,)]
    df = spark.createDataFrame(rows, "lab double").withColumn("label", F.lit("old"))
    codes = label_codes(df, "lab")
    assert sorted(map(tuple, codes.collect())) == [(-20.0, 0), (0.5, 1), (2.5, 2)]
    got = encode_labels(df, "lab", codes).collect()
    assert sorted([(r["lab"], r["label"]) for r in got], key=str) == sorted([(2.5, 2), (-20.0, 0), (None, None), (0.5, 1), (2.5, 2)], key=str)
    assert label_codes(df.limit(0), "lab").collect() == []


def test_softmax_column(spark):
    df = spark.createDataFrame([([1000.0, -1000.0, 999.0],), ([0.0, 0.0, 0.0],)], "raw array<double>")
    rows = [r["p"] for r in df.select(M.softmax_column(F.col("raw")).alias("p")).collect()]
    assert all(abs(sum(p) - 1) < 1e-12 for p in rows) and rows[0][1] == 0.0 and rows[0][0] == pytest.approx(1 / (1 + 2.718281828 ** -1))
