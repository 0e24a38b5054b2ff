import random

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from matchday.functions.bins import bin_label
from matchday.operators.calendar import last_played_round, player_target
from matchday.operators.metrics import class_report, exact_quantile, summary_scores
from matchday.operators.split import exact_rank, stratified_split


def test_skeleton_one_mark(spark):
    marks = spark.createDataFrame([("n", "s", 2020, 3, "T", 7.0)],
                                  "name string, surname string, season int, round_no int, team string, fantavoto double")
    out = player_target(marks).orderBy("round_no").collect()
    assert len(out) == 38
    assert all(r["team"] == "T" for r in out)  # filled both ways
    assert [r["round_no"] for r in out if r["fwd_fantavoto"] is not None] == [2]


def _brute_target(pdf, n_rounds=38):
    rows = []
    for (nm, sn, se), g in pdf.groupby(["name", "surname", "season"]):
        by_r = {r.round_no: r for r in g.itertuples()}
        teams = [by_r[r].team if r in by_r else None for r in range(1, n_rounds + 1)]
        ff = pd.Series(teams).ffill().bfill().tolist()
        fv = [by_r[r].fantavoto if r in by_r else None for r in range(1, n_rounds + 1)]
        for i, r in enumerate(range(1, n_rounds + 1)):
            nxt = fv[i + 1] if i + 1 < n_rounds else None
            rows.append((se, r, ff[i], nm, sn, None if nxt is None or pd.isna(nxt) else nxt))
    return sorted(rows, key=str)


def test_player_target_matches_brute_force(spark):
    rnd = random.Random(3)
    recs = set()
    data = []
    for _ in range(120):
        p = rnd.randint(0, 9)
        r = rnd.randint(1, 38)
        key = (p, r)
        if key in recs:
            continue
        recs.add(key)
        data.append(("n", f"s{p}", 2020, r, rnd.choice(["A", "B", None]), rnd.choice([None, rnd.random()])))
    schema = "name string, surname string, season int, round_no int, team string, fantavoto double"
    got = sorted((tuple(r) for r in player_target(spark.createDataFrame(data, schema)).collect()), key=str)
    exp = _brute_target(pd.DataFrame(data, columns=["name", "surname", "season", "round_no", "team", "fantavoto"]))
    assert got == exp


def test_last_played_round(spark):
    rows = []
    for r in range(1, 6):
        for i in range(4):
            st = "FT" if (r <= 3 or (r == 4 and i < 1)) else "NS"
            rows.append((r * 10 + i, 2020, r, st, f"2020-0{1 + r // 5}-01"))
    rows.append((999, 2019, 1, "FT", "2019-01-01"))
    df = spark.createDataFrame(rows, "fixture_id long, league_id int, round_no int, status_short string, event_date string")
    r = last_played_round(df.withColumn("event_date", F.to_timestamp("event_date"))).first()
    assert (r["last_round"], r["start_round"], r["final_round"]) == (3, 1, 5)


def test_bin_edges(spark):
    vals = [-20.0, -2.5, -0.5, 0.0, 0.49, 0.5, 4.5, 20.0, -21.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r["b"] for r in df.select(bin_label(F.col("v")).alias("b")).collect()]
    assert got == [-20.0, -2.5, -0.5, 0.0, 0.0, 0.5, 4.5, None, None]


def test_exact_rank_equals_row_number(spark):
    df = spark.range(3000).select(
        F.col("id"), (F.col("id") % 3).alias("s"),
        F.pmod(F.col("id") * 2654435761 + 11, F.lit(4294967296)).alias("h"),
    )
    # a tiny bucket count forces many rows per bucket and many buckets per stratum
    got = exact_rank(df, ["s"], "h", "id", bucket_bits=4)
    ref = df.select("id", F.row_number().over(Window.partitionBy("s").orderBy("h", "id")).alias("rank"))
    a = {r["id"]: r["rank"] for r in got.collect()}
    b = {r["id"]: r["rank"] for r in ref.collect()}
    assert a == b


def test_stratified_split_share(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 4).alias("s"))
    out = stratified_split(df, ["s"], "id").groupBy("s", "split").count().collect()
    counts = {(r["s"], r["split"]): r["count"] for r in out}
    for s in range(4):
        assert counts[(s, "test")] == 50 and counts[(s, "train")] == 200


def test_class_report_and_mcc(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] * 1 + [(2, 1)] * 1
    df = spark.createDataFrame(pairs, "t int, p int")
    rep = {r["label"]: r for r in class_report(df, "t", "p").collect()}
    assert abs(rep["0"]["precision"] - 5 / 6) < 1e-12 and abs(rep["0"]["recall"] - 5 / 7) < 1e-12
    assert rep["2"]["precision"] == 0.0 and rep["2"]["support"] == 1
    assert abs(rep["accuracy"]["f1_score"] - 8 / 12) < 1e-12
    # multi-class MCC from the confusion matrix, computed independently
    C = np.zeros((3, 3))
    for t, p in pairs:
        C[t, p] += 1
    t_k, p_k, c, s = C.sum(1), C.sum(0), np.trace(C), C.sum()
    mcc = (c * s - p_k @ t_k) / np.sqrt((s ** 2 - p_k @ p_k) * (s ** 2 - t_k @ t_k))
    got = summary_scores(df, "t", "p").first()
    assert abs(got["mcc"] - mcc) < 1e-12
    assert abs(got["balanced_accuracy"] - np.mean([5 / 7, 3 / 4, 0.0])) < 1e-12


def test_exact_quantile_with_ties(spark):
    rnd = np.random.default_rng(5)
    vals = np.concatenate([rnd.normal(size=2001), np.full(700, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    for q in (0.5, 0.1, 0.9):
        assert abs(exact_quantile(df, "x", q, bins=7) - float(np.quantile(vals, q))) < 1e-12


def test_exact_rank_null_stratum(spark):
    df = spark.range(200).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("s"),
        F.pmod(F.col("id") * 2654435761 + 5, F.lit(4294967296)).alias("h"),
    )
    got = {r["id"]: r["rank"] for r in exact_rank(df, ["s"], "h", "id", bucket_bits=3).collect()}
    ref = df.select("id", F.row_number().over(Window.partitionBy("s").orderBy("h", "id")).alias("rank"))
    assert got == {r["id"]: r["rank"] for r in ref.collect()}


def test_split_hash_takes_any_id(spark):
    from matchday.operators.split import mult_hash, stratified_split

    ids = [0, 1, 4_000_000_000, 2**62, 2**63 - 1, -1, -(2**63)]
    df = spark.createDataFrame([(i, "a") for i in ids], "id long, s string")
    got = {r["id"]: r["h"] for r in df.withColumn("h", mult_hash(df["id"], 1298)).collect()}
    assert got == {i: (i * 2654435761 + 1298) % 2**32 for i in ids}
    assert stratified_split(df, ["s"], "id").filter("split = 'test'").count() == 2


def test_player_with_marks_outside_the_rounds_only_gets_the_grid(spark):
    from matchday.operators.calendar import player_target

    marks = spark.createDataFrame(
        [("n", "late", 2020, 39, "t1", 7.0), ("n", "both", 2020, 39, "t9", 7.0), ("n", "both", 2020, 38, "t2", 6.0)],
        "name string, surname string, season int, round_no int, team string, fantavoto double",
    )
    rows = player_target(marks).collect()
    late = [r for r in rows if r["surname"] == "late"]
    both = [r for r in rows if r["surname"] == "both"]
    assert len(late) == 38 and {(r["team"], r["fwd_fantavoto"]) for r in late} == {(None, None)}
    assert len(both) == 38 and {r["team"] for r in both} == {"t2"}
    assert [r["fwd_fantavoto"] for r in both if r["round_no"] == 37] == [6.0]


def test_contiguous_folds_are_runs(spark):
    from matchday.operators.split import contiguous_folds

    df = spark.createDataFrame([(i * 7 % 23, "x") for i in range(23)], "k int, s string").repartition(4)
    rows = sorted((r["k"], r["fold"]) for r in contiguous_folds(df, ["k"], 5).collect())
    folds = [f for _, f in rows]
    assert folds == sorted(folds) and [folds.count(i) for i in range(5)] == [5, 5, 5, 4, 4]
    assert contiguous_folds(df.limit(3), ["k"], 5).count() == 3


def test_saved_labels_are_encoded_again(spark):
    from matchday.functions.bins import BIN_EDGES, encode_label

    df = spark.createDataFrame([(float(x),) for x in BIN_EDGES], "x double")
    assert [r[0] for r in df.select(encode_label(df["x"])).collect()] == [*range(len(BIN_EDGES) - 1), None]
