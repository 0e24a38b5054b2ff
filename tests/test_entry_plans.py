import pytest

import __spark_entry__ as entry
from matchday.plans.oracle import oracle_sql
from matchday.plans.queries import QUERIES

MODEL = ["q28_train_score", "q28b_feature_importance", "q28c_watchlist_predictions",
         "q30_permutation_importance", "q31_prediction_metrics", "q35_param_search", "q36_validation_models",
         "q37_regression_model"]
ORACLE_FREE = set(MODEL)
# they run a stream or the training job when they are built; see the tests of those
EAGER = ORACLE_FREE | {"q28d_labelled_split", "q28e_label_codes", "q07c_quality_gate", "q38_stream_features",
                        "q39_stream_dedup", "q40_stat_files", "q29_stream_upsert", "q29b_stream_calendar", "q29c_stream_statistics",
                         "q32_round_csvs", "q33_fixture_files", "q33b_calendar_files"}
SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "presenza_cnt10" in df.columns


def test_every_query_has_oracle_unless_model(spark):
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(qs) and set(sql) <= set(qs)
    assert set(QUERIES) - set(oracle_sql()) == ORACLE_FREE


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in EAGER])
def test_no_cartesian_products(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _partitionless_windows(plan: str) -> list[str]:
    """Window specs without PARTITION BY: their first argument is already a
    sort order (ASC/DESC) or the frame itself."""
    import re

    out = []
    for first in re.findall(r"windowspecdefinition\(([^,]*)", plan):
        if " ASC" in first or " DESC" in first or first.startswith("specifiedwindowframe"):
            out.append(first)
    return out


def test_partitionless_window_detector(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    bad = spark.range(5).select("*", F.row_number().over(Window.orderBy("id")).alias("r"))
    good = spark.range(5).select("*", F.row_number().over(Window.partitionBy(F.col("id") % 2).orderBy("id")).alias("r"))
    assert _partitionless_windows(_plan(bad)) and not _partitionless_windows(_plan(good))


@pytest.mark.parametrize("name", [n for n in oracle_sql() if n not in EAGER])
def test_no_single_partition_window(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert not _partitionless_windows(plan)


def test_player_features_one_window_exchange(spark):
    df = entry.queries()["q01_player_features"](spark, SF)
    plan = _plan(df)
    # one exchange for the marks aggregate, one for all rolling windows;
    # the duplicate-key mean reuses the window partitioning
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Window [") == 1


def test_player_target_has_no_join(spark):
    plan = _plan(entry.queries()["q03_player_target"](spark, SF))
    assert "Join" not in plan


def test_smoke_queries_small(spark):
    for n in ["q02_player_master", "q04_stat_collapse", "q09_last_round", "q19_confusion", "q24_html_extract"]:
        assert entry.queries()[n](spark, SF).count() >= 1


def test_model_queries_share_one_training_job(spark):
    qs = entry.queries()
    scored = qs["q28_train_score"](spark, SF)
    assert scored.count() > 0 and {r["split"] for r in scored.select("split").distinct().collect()} == {"train", "test"}
    assert qs["q28d_labelled_split"](spark, SF).count() == scored.count()
    assert qs["q28b_feature_importance"](spark, SF).count() > 0
    assert qs["q28c_watchlist_predictions"](spark, SF).columns[-1] == "probability"
    assert qs["q30_permutation_importance"](spark, SF).count() > 0
    # the metrics of the model's predictions against a plain SQL form
    metrics = qs["q31_prediction_metrics"](spark, SF)
    got = {(r["split"], r["measure"]): r["value"] for r in metrics.filter("kind = 'summary'").collect()}
    scored.createOrReplaceTempView("scored")
    for r in spark.sql("select split, avg(cast(label = predicted_code as double)) a from scored group by split").collect():
        assert abs(got[r["split"], "accuracy"] - r["a"]) < 1e-9


def test_streamed_statuses_and_statistics_follow_the_cleaning_rules(spark):
    qs = entry.queries()
    for streamed, direct in (("q29b_stream_calendar", "q08_calendar_stale_drop"), ("q29c_stream_statistics", "q04_stat_collapse")):
        a, b = qs[streamed](spark, SF), qs[direct](spark, SF)
        assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).isEmpty()


def test_stream_keeps_microseconds(spark):
    rows = {(r["user_id"], r["event_type"]): r["ts"] for r in entry.queries()["q29_stream_upsert"](spark, SF).collect()}
    ev = spark.read.parquet(f"{SF}/events.parquet").groupBy("user_id", "event_type").agg({"ts": "max"})
    assert rows == {(r[0], r[1]): r[2] for r in ev.collect()}
