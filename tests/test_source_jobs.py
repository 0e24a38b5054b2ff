"""Quality gate, statistics documents and streams with state."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from matchday.operators.quality import gate_unique
from matchday.sources.json_api import parse_stat_documents, read_packed_stat_files, unpack_envelope, unpack_stat_envelope
from matchday.streaming.ingest import JSON_OPTIONS, dedup_ingest, landed_rows

SF = "/root/testdata/sf0.001"


def test_gate_parts_rows_and_fails_on_request(spark, tmpdir_path):
    rows = [(1, "a", 1.0), (1, "a", 2.0), (1, "b", 3.0), (None, "a", 4.0), (None, "a", 4.0), (2, None, 5.0)]
    df = spark.createDataFrame(rows, "k long, s string, v double")
    good, bad = gate_unique(df, ["k", "s"], f"{tmpdir_path}/gate")
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "b", 3.0), (2, None, 5.0)]
    assert sorted(map(tuple, bad.collect()), key=str) == [(1, "a", 1.0, 2), (1, "a", 2.0, 2), (None, "a", 4.0, 2), (None, "a", 4.0, 2)]
    with pytest.raises(ValueError, match="duplicate keys"):
        gate_unique(df, ["k", "s"], f"{tmpdir_path}/gate2", fail=True)
    assert spark.read.parquet(f"{tmpdir_path}/gate2/accepted").count() == 2  # written before the error
    good, bad = gate_unique(df.limit(0), ["k", "s"], f"{tmpdir_path}/gate3", fail=True)
    assert good.count() == 0 and bad.count() == 0


def test_statistics_documents(spark, tmpdir_path):
    full = {"fixture_stat": {"0": "Fouls", "1": "Shots", "2": "Fouls"}, "home": {"0": "1", "1": None, "2": "1"}, "away": {"0": "2", "2": "2"}}
    docs = [
        ("x/fixtureid-7_.json", json.dumps(full)), ("fixtureid-8_.json", json.dumps(full)), ("fixtureid-9_.json", "{broken"),
        ("noid.json", json.dumps(full)), ("fixtureid-10_.json", "{}"), ("fixtureid-11_.json", None),
    ]
    df = spark.createDataFrame(docs, "name string, content string")
    got = parse_stat_documents(df, F.col("name"), F.col("content"))
    want = [(i, *r) for i in (7, 8, None) for r in (("Fouls", "1", "2"), ("Shots", None, None))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    df.write.json(f"{tmpdir_path}/packed")
    only = spark.createDataFrame([(8,), (8,)], "fixture_id long")
    assert sorted(map(tuple, read_packed_stat_files(spark, f"{tmpdir_path}/packed", only).collect())) == [(8, "Fouls", "1", "2"), (8, "Shots", None, None)]


def test_envelopes(spark):
    answers = [
        (1, {"api": {"results": 2, "statistics": {"Fouls": {"home": "3", "away": None}, "Shots": {"home": "1", "away": "2"}}}}),
        (2, {"api": {"results": 0, "statistics": {"Fouls": {"home": "9", "away": "9"}}}}), (3, {"api": {"results": 1, "statistics": {}}}),
        (4, {"error": "x"}),
    ]
    df = spark.createDataFrame([(i, json.dumps(a)) for i, a in answers], "id long, payload string")
    assert sorted(map(tuple, unpack_stat_envelope(df, "payload", keep=["id"]).collect())) == [(1, "Fouls", "3", None), (1, "Shots", "1", "2")]
    lists = spark.createDataFrame([(1, '{"api": {"results": 2, "l": [{"name": "a"}, {"name": "b"}, {"name": "a"}]}}')], "id long, payload string")
    from pyspark.sql import types as T

    item = T.StructType([T.StructField("name", T.StringType())])
    assert unpack_envelope(lists, "payload", "l", item, ["id"], "name", "a").count() == 2


def test_repeats_inside_and_beyond_the_delay(spark, tmpdir_path):
    """Restarted after every delivery; run again without new files at the end."""
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    deliveries = [
        [("a", day(1)), ("a", day(1, 5)), ("b", day(2)), ("c", day(10))],
        [("c", day(11)), ("a", day(3)), ("d", day(12))],      # c inside its delay, a late: before the watermark (day 8)
        [("a", day(13)), ("c", day(11, 12)), ("d", day(13))],  # a anew, c and d inside
        [("c", day(14))],                                       # c's state ended on day 12, the watermark stands on day 11
        [("e", day(20))],
        [("c", day(21))],                                       # now it has gone
    ]
    for n, rows in enumerate(deliveries):
        df = spark.createDataFrame(rows, "k string, ts timestamp")
        df.coalesce(1).write.options(**JSON_OPTIONS).json(os.path.join(tmpdir_path, "landing", f"d={n}"))
        dedup_ingest(spark, f"{tmpdir_path}/landing/*", f"{tmpdir_path}/rows", f"{tmpdir_path}/ck", df.schema, ["k"], "ts", "2 days")
    dedup_ingest(spark, f"{tmpdir_path}/landing/*", f"{tmpdir_path}/rows", f"{tmpdir_path}/ck", df.schema, ["k"], "ts", "2 days")
    got = sorted((r["k"], r["ts"]) for r in landed_rows(spark, f"{tmpdir_path}/rows", df.schema).collect())
    keys = [k for k, _ in got]
    assert keys.count("a") == 2 and keys.count("b") == 1 and keys.count("c") == 2 and keys.count("d") == 1 and keys.count("e") == 1
    assert ("a", day(13)) in got and ("c", day(21)) in got and ("d", day(12)) in got


def test_streamed_features_equal_the_batch_job(spark):
    from matchday.plans.queries import QUERIES

    a, b = QUERIES["q38_stream_features"](spark, SF), QUERIES["q01_player_features"](spark, SF)
    assert a.count() == b.count() > 0 and a.exceptAll(b.select(*a.columns)).isEmpty()


def test_files_without_a_header_are_named(spark, tmpdir_path):
    from matchday.sources.landing import GRADE_COLUMNS, headerless_files, read_round_csvs

    row = "t1,a,b,P,6,0,0,0,0,0,0,0,6\n"
    for name, text in (("a2024_m1.csv", ",".join(GRADE_COLUMNS) + "\n" + row), ("a2024_m2.csv", row * 2)):
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write(text)
    assert [(r["file"].rsplit("/", 1)[1], r["n_rows"]) for r in headerless_files(spark, tmpdir_path).collect()] == [("a2024_m2.csv", 2)]
    assert read_round_csvs(spark, tmpdir_path).count() == 1
    with pytest.raises(ValueError, match="a2024_m2"):
        read_round_csvs(spark, tmpdir_path, fail=True)
