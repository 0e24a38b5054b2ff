from pyspark.sql import functions as F

from matchday.operators.clean import apply_name_fix, collapse_amended, drop_stale_status
from matchday.operators.reshape import home_away_rows, pivot_mean, pivot_unique, prefix_columns, unpivot_split


def test_stale_status_strict_and_default(spark):
    rows = [(1, 1, "NS", 1), (1, 1, "FT", 2), (2, 1, "NS", 1), (3, 1, "NS", 1), (3, 1, "NS", 2)]
    df = spark.createDataFrame(rows, "fixture_id long, league_id long, status_short string, landed int")
    strict = {(r["fixture_id"], r["status_short"]) for r in drop_stale_status(df).collect()}
    assert strict == {(1, "FT"), (2, "NS")}
    soft = drop_stale_status(df, strict=False, newest=["landed"]).collect()
    assert sorted((r["fixture_id"], r["status_short"], r["landed"]) for r in soft) == [
        (1, "FT", 2), (2, "NS", 1), (3, "NS", 2)]


def test_amended_stat_collapse(spark):
    rows = [(1, "s", 5.0, 4.0), (1, "s", 7.0, 3.0), (2, "s", 5.0, 1.0), (2, "s", None, 2.0)]
    df = spark.createDataFrame(rows, "fixture_id long, fixture_stat string, home double, away double")
    out = sorted((tuple(r) for r in collapse_amended(df).collect()), key=str)
    # key 1: two non-null homes -> independent max; key 2: one non-null -> both rows pass
    assert out == sorted([(1, "s", 7.0, 4.0), (2, "s", None, 2.0), (2, "s", 5.0, 1.0)], key=str)


def test_name_fix_null_safe_and_either_field(spark):
    players = spark.createDataFrame(
        [("a", "x"), (None, "y"), ("c", "z")], "name string, surname string")
    fix = spark.createDataFrame(
        [("a", "x", "A", "X"), (None, "y", "B", "Y"), ("c", "z", None, "Z")],
        "name string, surname string, name_correct string, surname_correct string")
    out = sorted((tuple(r) for r in apply_name_fix(players, fix).collect()), key=str)
    # NULL name matches NULL; one correction present -> both fields replaced
    assert out == sorted([("A", "X"), ("B", "Y"), (None, "Z")], key=str)


def test_home_away_rows_and_prefix(spark):
    df = spark.createDataFrame([(10, 1, 2, 3.0, 4.0)], "fid long, h long, a long, hv double, av double")
    rows = home_away_rows(df, ["fid"], {"home": {"team": "h", "val": "hv"}, "away": {"team": "a", "val": "av"}}, side_col="side")
    assert sorted((r["team"], r["val"], r["side"]) for r in rows.collect()) == [(1, 3.0, "home"), (2, 4.0, "away")]
    assert prefix_columns(rows, ["fid"], "op_").columns == ["fid", "op_team", "op_val", "op_side"]


def test_unpivot_pivot_round_trip(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, None, 2)], "fixture_id long, home_ht_goal int, away_ht_goal int")
    long = unpivot_split(df, ["fixture_id"], ["home_ht_goal", "away_ht_goal"], "side", "stat")
    back = pivot_mean(long, ["fixture_id", "stat"], "side", ["away", "home"], "value")
    got = sorted(tuple(r) for r in back.collect())
    assert got == [(1, "ht_goal", 0.0, 1.0), (2, "ht_goal", 2.0, None)]


def test_pivot_styles_all_null_rows(spark):
    rows = [(1, "a", 1.0), (1, "b", None), (2, "a", None)]
    df = spark.createDataFrame(rows, "k long, f string, v double")
    team_style = pivot_unique(df, ["k"], "f", ["a", "b"], "v")
    assert team_style.count() == 2  # all-NULL row of key 2 is kept


def test_quality_checks_and_append(spark):
    import pytest

    from matchday.operators.clean import append_distinct
    from matchday.operators.quality import assert_unique, duplicate_keys, unmatched_keys

    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        assert_unique(df, ["k"])
    assert_unique(df, ["k", "v"])
    other = spark.createDataFrame([(2,)], "k long")
    assert [r["k"] for r in unmatched_keys(df, other, ["k"]).collect()] == [1]
    assert append_distinct(df, df.union(spark.createDataFrame([(3, "d")], "k long, v string"))).count() == 4


def test_collapse_single_row_null_and_rare_keys(spark):
    rows = [(1, "s", None, 4.0),                       # one row, NULL home: kept as is
            (2, "s", None, 1.0), (2, "s", None, 2.0),  # several rows, no non-NULL home: all kept
            (3, "s", 3.0, None), (3, "s", 5.0, 6.0)]   # two non-NULL homes: collapsed
    df = spark.createDataFrame(rows, "fixture_id long, fixture_stat string, home double, away double")
    out = sorted((tuple(r) for r in collapse_amended(df).collect()), key=str)
    exp = [(1, "s", None, 4.0), (2, "s", None, 1.0), (2, "s", None, 2.0), (3, "s", 5.0, 6.0)]
    assert out == sorted(exp, key=str)
