"""Memory of a task and repeated work of the data jobs: tables dealt by key
before they are aggregated, each input read once."""

import random

from matchday import session
from matchday.operators import clean, prune, quality, reshape
from matchday.operators.features import round_cols
from matchday.plans import queries as Q

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_follows_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    df = session.spread(spark.range(2_000).withColumnRenamed("id", "k"), "k")
    assert df.rdd.getNumPartitions() == 20  # a given number: not merged again
    assert df.count() == 2_000


def test_statistics_are_read_and_shuffled_once(spark):
    plan = _plan(Q.q07b_duplicate_team_rows(spark, SF))
    assert plan.count("FileScan parquet [l_orderkey") == 1
    # statistics, goals and fixtures by fixture; the join with customers may add two
    assert plan.count("REPARTITION_BY_NUM") == 3 and plan.count("Exchange hashpartitioning") <= 5


def test_stream_statistics_distinct_after_one_shuffle(spark):
    plan = _plan(Q.q29c_stream_statistics(spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1


def test_collapse_passes_rows_of_keys_with_one_value(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3, 4, None]), rng.choice("ab"), rng.choice([None, None, 1.0, 2.0]), rng.choice([None, 3.0, 4.0])) for _ in range(24)]
    got = clean.collapse_amended(spark.createDataFrame(rows, "fixture_id int, fixture_stat string, home double, away double"))
    want = []
    for key in {r[:2] for r in rows}:
        mine = [r for r in rows if r[:2] == key]
        if sum(r[2] is not None for r in mine) > 1:
            best = [max((r[c] for r in mine if r[c] is not None), default=None) for c in (2, 3)]
            want.append((*key, *best))
        else:
            want += mine
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_pivot_is_one_aggregate(spark):
    df = spark.createDataFrame([(1, "x", "a", 1.0), (1, "x", "a", 2.0), (1, "x", None, 9.0), (2, "x", "c", None)], "i int, s string, k string, v double")
    out = reshape.pivot_mean(df, ["i", "s"], "k", ["b", "a"], "v")
    assert out.columns == ["i", "s", "b", "a"] and _plan(out).count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, out.collect())) == [(1, "x", None, 1.5), (2, "x", None, None)]


def test_sparse_rows_builds_the_training_table_once(spark, monkeypatch):
    calls, real = [], session.materialize
    monkeypatch.setattr(session, "materialize", lambda df: (calls.append(df.columns), real(df))[1])
    plan = _plan(Q.q14_sparse_rows(spark, SF))
    assert any("fwd_fv_scaled" in c and "role" in c for c in calls)
    assert "Join" not in plan and "Window" not in plan  # reads the written table


def test_null_shares_count_values(spark):
    df = spark.createDataFrame([(1, None), (2, 3), (None, None)], "a int, b int")
    assert {r[0]: r[1] for r in prune.null_shares(df).collect()} == {"a": 1 / 3, "b": 2 / 3}
    assert [r[1] for r in prune.null_shares(df.limit(0)).collect()] == [None, None]


def test_gate_counts_keys_in_tasks_of_bounded_size(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    seen, real = [], quality.duplicate_keys
    monkeypatch.setattr(quality, "duplicate_keys", lambda df, keys: (seen.append(df.rdd.getNumPartitions()), real(df, keys))[1])
    df = spark.createDataFrame([(i % 90, i) for i in range(100)], "k int, v int")
    accepted, rejected = quality.gate_unique(df, ["k"], tmpdir_path + "/gate")
    assert (accepted.count(), rejected.count()) == (80, 20) and seen == [10]


def test_whole_numbers_are_rounded_without_a_decimal(spark):
    values = [0.0, -0.0, 3.0, -7.0, 1e300, 1.23456789, -2.0000005, 2.0000005, 0.1234565, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in round_cols(df).collect()]
    want = [r[0] for r in df.selectExpr("round(x, 6)").collect()]
    assert repr(got) == repr(want)
