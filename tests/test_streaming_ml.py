import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.ml import model as M
from matchday.streaming.ingest import JSON_OPTIONS, current_state, ingest_stream

SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])


def _land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").options(**JSON_OPTIONS).json(path)


def test_stream_restart_only_new_files(spark, tmpdir_path):
    import datetime as dt

    t = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    landing, table, ckpt = (os.path.join(tmpdir_path, x) for x in ("landing", "rows", "ckpt"))
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]

    def state():
        ingest_stream(spark, landing, table, ckpt, SCHEMA, keys, order)
        rows = current_state(spark, table, SCHEMA, keys, order).collect()
        return sorted((r["user_id"], r["event_type"], r["value"], r["ts"]) for r in rows)

    _land(spark, landing, [(1, 7, "view", t, 1.0), (2, 7, "view", t + dt.timedelta(microseconds=1), 2.0)])
    assert state() == [(7, "view", 2.0, t + dt.timedelta(microseconds=1))]
    # a later landing with a newer event, an older one, a duplicate, and one a year late for its key
    _land(spark, landing, [(3, 7, "view", t + dt.timedelta(hours=2), 3.0), (4, 8, "click", t, 4.0),
                           (2, 7, "view", t + dt.timedelta(microseconds=1), 2.0),
                           (5, 9, "click", t - dt.timedelta(days=365), 5.0)])
    want = [(7, "view", 3.0, t + dt.timedelta(hours=2)), (8, "click", 4.0, t),
            (9, "click", 5.0, t - dt.timedelta(days=365))]
    assert state() == want
    assert state() == want  # nothing new
    _land(spark, landing, [(6, 8, "click", t + dt.timedelta(hours=5), 6.0)])
    assert state()[1] == (8, "click", 6.0, t + dt.timedelta(hours=5))


def test_replayed_batch_leaves_the_same_rows(spark, tmpdir_path):
    from matchday.streaming.ingest import landed_rows, write_batch

    rows = spark.createDataFrame([("a", 1, 2.0)], "player string, rnd int, v double")
    for _ in range(2):
        write_batch(rows, os.path.join(tmpdir_path, "rows"), 3)
    assert landed_rows(spark, os.path.join(tmpdir_path, "rows"), rows.schema).collect() == [("a", 1, 2.0, 3)]
    assert landed_rows(spark, os.path.join(tmpdir_path, "none"), rows.schema).count() == 0


def test_model_learns_separable_classes(spark, tmpdir_path):
    rows = []
    for i in range(600):
        c = i % 3
        rows.append((float(c) * 10 + (i % 7) * 0.1, None if i % 5 == 0 else float(i % 11), c, 1.0 + c))
    df = spark.createDataFrame(rows, "x double, noise double, label int, weight double").withColumn(
        "label", F.col("label").cast("double"))
    feats = ["x", "noise"]
    model = M.fit(M.build_pipeline(feats, kind="rf"), df)
    path = os.path.join(tmpdir_path, "model")
    M.save(model, path)
    loaded = M.load(path)
    acc = M.accuracy(loaded.transform(df))
    assert acc > 0.95
    scored = M.score(loaded, df, ["label"]).collect()
    assert {r["expected_fv"] for r in scored} <= {-14.0, 3.5, 5.5}
    assert M.feature_importance(loaded)[0][0] == "x"


def test_cv_search_and_validation(spark):
    from matchday.operators.split import stratified_folds, validation_sample

    rows = [(i, float(i % 3) * 10 + (i % 5) * 0.1, float(i % 3), 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "rid long, x double, label double, weight double")
    folded = stratified_folds(df, ["label"], "rid", n_folds=3)
    pipe = M.build_pipeline(["x"], kind="rf", params=M.TreeParams(num_trees=5, max_depth=3))
    cv = M.cross_validate(pipe, folded, metric="accuracy", parallelism=1)
    assert cv.avgMetrics[0] > 0.9
    sample = validation_sample(folded, "rid", n=150)
    assert sample.count() == 150
    assert all(a > 0.9 for a in M.validate(pipe, sample))
    draws = M.random_param_maps(pipe.getStages()[-1], 4)
    rf = pipe.getStages()[-1]
    assert len(draws) == 4 and all(4 <= d[rf.getParam("maxDepth")] <= 12 for d in draws)
    assert all(300 <= d[rf.getParam("numTrees")] <= 999 for d in draws)
    assert all(d[rf.getParam("subsamplingRate")] == 0.85 for d in draws)
    assert all(d[rf.getParam("featureSubsetStrategy")] == "0.85" for d in draws)
    gbt = M.build_pipeline(["x"], kind="gbt_reg").getStages()[-1]
    many = M.random_param_maps(gbt, 400)
    assert {d[gbt.stepSize] for d in many} == {0.01, 0.1, 0.5}
    gains = sorted(d[gbt.minInfoGain] for d in many)
    assert 0.5 < gains[200] < 0.9  # median of the inverse gamma with shape 1.8


def test_boosted_variants(spark):
    rows = [(float(i % 3) * 10 + (i % 5) * 0.1, float(i % 3), 1.0) for i in range(240)]
    df = spark.createDataFrame(rows, "x double, label double, weight double")
    params = M.TreeParams(max_iter=5, max_depth=3, step_size=0.3)
    ovr = M.fit(M.build_pipeline(["x"], kind="gbt_ovr", params=params), df)
    assert M.accuracy(ovr.transform(df)) > 0.95
    scored = M.score(ovr, df, ["label"]).collect()
    assert all(0.0 < r["probability"] <= 1.0 for r in scored)
    reg = M.fit(M.build_pipeline(["x"], kind="gbt_reg", params=params), df)
    err = reg.transform(df).select(F.avg(F.abs(F.col("prediction") - F.col("label"))).alias("e")).first()["e"]
    assert err < 0.2


def test_stream_refreshes_features_of_touched_entities(spark, tmpdir_path):
    from matchday.operators.rolling import RollSpec, rolling
    from matchday.streaming.ingest import ingest_with_features

    schema = T.StructType([T.StructField("player", T.StringType()), T.StructField("rnd", T.IntegerType()),
                           T.StructField("v", T.DoubleType())])
    fschema = T.StructType([T.StructField("player", T.StringType()), T.StructField("rnd", T.IntegerType()),
                            T.StructField("s3", T.DoubleType())])

    def compute(df):
        return rolling(df, ["player"], ["rnd"], [RollSpec("v", "sum", 3, 1, "s3")]).select("player", "rnd", "s3")

    landing = os.path.join(tmpdir_path, "landing")
    first = [("a", r, float(r)) for r in range(1, 6)] + [("b", r, 10.0 * r) for r in range(1, 4)]
    second = [("a", 6, 6.0), ("c", 1, 1.0)]
    spark.createDataFrame(first, schema).write.mode("append").json(landing)
    args = (spark, landing, os.path.join(tmpdir_path, "m"), os.path.join(tmpdir_path, "f"),
            os.path.join(tmpdir_path, "ck"), schema, ["player", "rnd"], ["rnd"], ["player"], compute,
            fschema)
    ingest_with_features(*args)
    spark.createDataFrame(second, schema).write.mode("append").json(landing)
    ingest_with_features(*args)
    feats = current_state(spark, os.path.join(tmpdir_path, "f"), fschema, ["player", "rnd"], [])
    full = compute(spark.createDataFrame(first + second, schema))
    assert sorted(tuple(r) for r in feats.collect()) == sorted(tuple(r) for r in full.collect())
