"""Jobs of the sources and streams: statistics files and envelopes, the
quality gate of the team unstack, streams with state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.operators.features import player_feature_names, player_features, round_cols
from matchday.operators.quality import duplicate_keys, gate_unique
from matchday.plans import views as V
from matchday.session import materialize, scratch_path, spread
from matchday.sources.json_api import read_packed_stat_files, unpack_envelope, unpack_stat_envelope
from matchday.streaming.ingest import JSON_OPTIONS, current_state, dedup_ingest, ingest_with_features, landed_rows

TEAM_KEYS = ["team_id", "team_name", "event_date", "fixture_id", "league_id", "fixture_stat"]
PLAYER_KEYS = ["team", "role", "name", "surname", "season", "round_no"]
#: repeats of an event are expected within so much of its time
DELAY = "2 days"


def q07c_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate before the team unstack, on rows of which every fifth fixture
    came twice with other values: the rejected keys and their row counts."""
    from matchday.plans.queries import stat_rows

    rows = materialize(stat_rows(spark, sf_dir, V.fixture_master(spark, sf_dir)))  # read for the table and for its copies
    planted = rows.where("fixture_id % 5 = 0").withColumn("val", F.col("val") + 1)
    _accepted, rejected = gate_unique(rows.unionByName(planted), TEAM_KEYS, scratch_path(spark, f"gate-{uuid.uuid4().hex}"))
    return duplicate_keys(spread(rejected.select(*TEAM_KEYS), *TEAM_KEYS), TEAM_KEYS)


def q38_stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks landed in three deliveries, the first of them once more at the
    end, streamed with a restart in between; each batch recomputes the
    features of the players it touched, from their rows so far."""
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    marks = V.player_match(spark, sf_dir)
    names = player_feature_names()
    features = player_features(marks).select(*PLAYER_KEYS, *names).schema
    third = [F.col("round_no") <= 10, F.col("round_no").between(11, 20), F.col("round_no") > 20]
    for n, which in enumerate([*third, third[0]]):
        marks.where(which).write.options(**JSON_OPTIONS).json(f"{base}/landing/delivery={n}")
        ingest_with_features(
            spark, f"{base}/landing/*", f"{base}/rows", f"{base}/features", f"{base}/checkpoint", marks.schema, PLAYER_KEYS, [],
            ["name", "surname"], player_features, features,
        )
    return round_cols(current_state(spark, f"{base}/features", features, PLAYER_KEYS, []).select(*PLAYER_KEYS, *names))


def q39_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed in three deliveries, each with repeats, streamed with a
    restart after each: repeats within two days of an event go, whether in
    time or late; an event given again days later counts as new."""
    ev = V.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    ends = ev.agg(F.min("ts").alias("a"), F.max("ts").alias("z")).first()  # one row
    if ends["z"] is None:
        return ev.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    mid = F.lit(ends["a"] + (ends["z"] - ends["a"]) / 2)
    early, late = ev.where(F.col("ts") < mid), ev.where(F.col("ts") >= mid)
    soon = late.where("event_id % 3 = 1").withColumn("ts", F.col("ts") + F.expr("INTERVAL 12 HOURS"))
    again = early.where("event_id % 5 = 0").withColumn("ts", F.lit(ends["z"]) + F.expr("INTERVAL 1 DAY"))
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    for n, rows in enumerate([early, early.where("event_id % 3 = 0").union(late), soon.union(again)]):
        rows.write.options(**JSON_OPTIONS).json(f"{base}/landing/delivery={n}")
        dedup_ingest(spark, f"{base}/landing/*", f"{base}/rows", f"{base}/checkpoint", ev.schema, ["event_id"], "ts", DELAY)
    out = landed_rows(spark, f"{base}/rows", ev.schema)
    return out.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


def q40_stat_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-oriented statistics files of all fixtures, landed packed, read
    back to rows of the finished fixtures."""
    path = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    rows = spread(V.fixture_stats(spark, sf_dir), "fixture_id")
    # a fixture has a handful of rows; the index is their place in its file
    each = rows.groupBy("fixture_id").agg(F.collect_list(F.struct("fixture_stat", "home", "away")).alias("r"))

    def column(name: str):
        return F.map_from_entries(F.transform("r", lambda x, i: F.struct(i.cast("string"), x[name]))).alias(name)

    each.select(
        F.concat(F.lit("fixtureid-"), F.col("fixture_id"), F.lit("_.json")).alias("name"),
        F.to_json(F.struct(column("fixture_stat"), column("home"), column("away"))).alias("content"),
    ).write.json(path)
    return read_packed_stat_files(spark, path, V.fixture_master(spark, sf_dir))


def q41_stat_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the statistics request, one per fixture: a dict of dicts in
    an envelope.  Every seventh says it has no results and is skipped."""
    stats = V.fixture_stats(spark, sf_dir).groupBy("fixture_id", "fixture_stat").agg(
        F.max("home").alias("home"), F.max("away").alias("away")
    )
    pair = F.struct("home", "away")
    each = stats.groupBy("fixture_id").agg(F.map_from_entries(F.collect_list(F.struct("fixture_stat", pair))).alias("statistics"))
    results = F.when(F.col("fixture_id") % 7 == 0, 0).otherwise(F.size("statistics")).alias("results")
    answers = each.select("fixture_id", F.to_json(F.struct(F.struct(results, "statistics").alias("api"))).alias("payload"))
    return unpack_stat_envelope(answers, "payload", keep=["fixture_id"])


def q41b_search_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a search, each with two items in a list; the items of the
    searched name are kept, answers without results are skipped."""
    ev = V.table(spark, sf_dir, "events")
    results = F.when(F.col("event_id") % 5 == 0, 0).otherwise(2)
    answers = ev.select("event_id", F.concat(
        F.lit('{"api": {"results": '), results.cast("string"), F.lit(', "leagues": [{"name": "'), F.col("event_type"),
        F.lit('", "k": '), F.get_json_object("props", "$.k"), F.lit('}, {"name": "another", "k": -1}]}}'),
    ).alias("payload"))
    return unpack_envelope(
        answers, "payload", "leagues", T.StructType([T.StructField("name", T.StringType()), T.StructField("k", T.LongType())]),
        keep=["event_id"], target_field="name", target="click",
    )
