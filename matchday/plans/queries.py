"""The registered jobs: each takes ``(spark, sf_dir)`` and returns a
DataFrame over the canonical views of :mod:`matchday.plans.views`.

The result is lazy, but building it can run jobs: written intermediate
tables, the skew check of rolling windows, null profiles, exact quantiles,
streams and model fits happen in the call.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.operators.assemble import opponent_features, training_table, with_role_dummies
from matchday.operators.calendar import (
    fixtures_per_round,
    last_played_round,
    player_target,
    team_schedule,
)
from matchday.operators.clean import (
    apply_name_fix,
    collapse_amended,
    drop_stale_status,
    needs_review,
    parse_stat_values,
)
from matchday.operators.features import (
    GOAL_STATS,
    player_feature_names,
    player_features,
    team_feature_names,
    round_cols,
    team_features,
    team_stat_rows,
)
from matchday.operators.quality import duplicate_keys
from matchday.operators.metrics import (
    class_report,
    confusion,
    label_distribution,
    regression_scores,
    summary_scores,
)
from matchday.operators.prune import drop_sparse_columns, drop_sparse_rows, row_null_share, sparse_column_report
from matchday.operators.reshape import pivot_mean, unpivot_split
from matchday.operators.split import class_weights, contiguous_folds, stratified_folds, stratified_split, with_bins
from matchday.operators.worklist import (
    budgeted,
    expand_template,
    landing_name,
    pending_fixtures,
    pending_rounds,
    pending_teams,
    rounds_in_window,
)
from matchday.plans import views as V
from matchday.session import spread, task_count
from matchday.sources.html import extract_list_items, extract_list_items_parsed
from matchday.sources.json_api import unpack_envelope
from pyspark.sql import types as T

# statistic names of the fixture_stats view (the pivot needs its value list)
DETAIL_STATS = ["Ball Possession", "Fouls", "Shots on Goal"]


def q01_player_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling player features (sums, std, presence count, centred means)."""
    return round_cols(player_features(V.player_match(spark, sf_dir)))


def player_master(marks: DataFrame) -> DataFrame:
    return marks.groupBy("team", "name", "surname", "role").agg(
        F.min("season").alias("season_min"),
        F.max("season").alias("season_max"),
        F.min("round_no").alias("match_min"),
        F.max("round_no").alias("match_max"),
    )


def q02_player_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players master: first/last season and round per team, name, role."""
    return player_master(V.player_match(spark, sf_dir))


def q03_player_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense season grid, team filled both ways, next round's mark."""
    return player_target(V.player_match(spark, sf_dir))


def collapsed_stats(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    return collapse_amended(parse_stat_values(spread(V.fixture_stats(spark, sf_dir), "fixture_id", tasks=tasks)))


def stat_rows(spark: SparkSession, sf_dir: str, master: DataFrame) -> DataFrame:
    """Per-team statistic rows.  Statistics and fixtures are dealt alike by
    fixture, once; collapse, pivot, join and distinct follow in place."""
    tasks = task_count(V.table(spark, sf_dir, "lineitem"))
    master = spread(master, "fixture_id", tasks=tasks)
    return team_stat_rows(collapsed_stats(spark, sf_dir, tasks), goal_stats(spark, sf_dir, master), master, V.AS_OF)


def q04_stat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse text statistics and collapse amended duplicates."""
    return collapsed_stats(spark, sf_dir)


def goal_stats(spark: SparkSession, sf_dir: str, master: DataFrame | None = None) -> DataFrame:
    m = V.fixture_master(spark, sf_dir) if master is None else master
    long = unpivot_split(
        m,
        ["fixture_id"],
        ["home_ht_goal", "away_ht_goal", "home_ft_goal", "away_ft_goal"],
        "team_side",
        "fixture_stat",
    )
    return pivot_mean(long, ["fixture_id", "fixture_stat"], "team_side", ["away", "home"], "value")


def q05_goals_unpivot_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goals per fixture: unpivot, split side/stat, pivot sides back."""
    return round_cols(goal_stats(spark, sf_dir))


def q06_team_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-team schedule rows with the next opponent of the season."""
    return team_schedule(V.fixture_master(spark, sf_dir), V.league_season(spark, sf_dir))


def team_feature_table(spark: SparkSession, sf_dir: str, master: DataFrame | None = None) -> DataFrame:
    from matchday.session import materialize

    master = V.fixture_master(spark, sf_dir) if master is None else master
    # written once: the skew check and the window both read it
    rows = materialize(stat_rows(spark, sf_dir, master))
    wide = team_features(rows, DETAIL_STATS + list(GOAL_STATS))
    cal = V.calendar(spark, sf_dir).select("league_id", "fixture_id", "round_no").distinct()
    return wide.join(cal, ["league_id", "fixture_id"], "left")


def q07_team_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling team features per fixture, with the calendar round."""
    return round_cols(team_feature_table(spark, sf_dir))


def amended_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar master plus a second landing in which statuses moved on:
    not-started fixtures of even rounds are now finished, postponed ones of
    even rounds are re-scheduled a week later."""
    cal = V.calendar(spark, sf_dir)
    even = F.col("round_no") % 2 == 0
    st = F.col("status_short")
    landing = cal.select(
        "fixture_id",
        "league_id",
        F.when(even & (st == "PST"), F.col("event_date") + F.expr("INTERVAL 7 DAYS"))
        .otherwise(F.col("event_date"))
        .alias("event_date"),
        F.when(even & (st == "PST"), F.col("round_no") + 1).otherwise(F.col("round_no")).alias("round_no"),
        F.when(even & (st == "NS"), "FT").when(even & (st == "PST"), "NS").otherwise(st).alias("status_short"),
    )
    return cal.unionByName(landing).distinct()


def q08_calendar_stale_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append a landing to the calendar master and drop stale NS rows."""
    return drop_stale_status(amended_calendar(spark, sf_dir))


def q09_last_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last played round of the newest league and the scoring window."""
    return last_played_round(V.calendar(spark, sf_dir))


def q09b_fixtures_per_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-quality count of fixtures per league and round."""
    return fixtures_per_round(V.calendar(spark, sf_dir))


def q10_name_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players master with manual name corrections applied."""
    master = player_master(V.player_match(spark, sf_dir))
    flagged = master.withColumn("needs_review", needs_review(F.col("surname")))
    return apply_name_fix(flagged, V.name_fix(spark, sf_dir))


TEAM_FEATURES = team_feature_names(DETAIL_STATS + list(GOAL_STATS))
PLAYER_FEATURES = player_feature_names()


def team_opponent_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchday.session import materialize

    # masters are persisted tables in a pipeline run: the fixture master and
    # the season dimension are read by several branches, so write them once
    master = materialize(V.fixture_master(spark, sf_dir))
    seasons = materialize(V.league_season(spark, sf_dir))
    # the team feature table feeds three branches (support keys, own side,
    # opponent side): compute it once
    tf = materialize(team_feature_table(spark, sf_dir, master)).join(seasons, "league_id")
    tf = tf.join(master.select("league_id", "fixture_id"), ["league_id", "fixture_id"], "left_semi")
    # the schedule known at the as-of instant reaches five days ahead
    cut = master.filter(F.col("event_date") <= F.expr(f"TIMESTAMP_NTZ '{V.AS_OF}' + INTERVAL 5 DAYS"))
    return opponent_features(
        tf, team_schedule(cut, seasons), V.team_map(spark, sf_dir), TEAM_FEATURES
    )


def q11_opponent_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team features with the next opponent's features (op_ prefix)."""
    return round_cols(team_opponent_table(spark, sf_dir))


def training_set(
    spark: SparkSession, sf_dir: str, with_team: bool = True, seasons: Sequence[int] | None = None
) -> DataFrame:
    """Training table of the selected seasons (all by default);
    ``with_team=False`` leaves out the team and opponent features (same rows
    and roles: those joins are 1:1 left joins)."""
    from matchday.session import materialize

    # read by the target grid, the player features and their skew check
    marks = materialize(V.player_match(spark, sf_dir))
    return training_table(
        player_target(marks),
        player_features(marks),
        team_opponent_table(spark, sf_dir) if with_team else None,
        PLAYER_FEATURES,
        TEAM_FEATURES,
        seasons=seasons,
    )


def q12_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player rows with player, team and opponent features and role dummies."""
    return round_cols(with_role_dummies(training_set(spark, sf_dir)))


TRAIN_KEYS = ["name", "surname", "season", "round_no"]
TARGETS = ["fwd_fantavoto", "fwd_fv_scaled"]


def q13_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null share of every training column and whether it is dropped."""
    return round_cols(
        sparse_column_report(training_set(spark, sf_dir), 0.25, exempt=TARGETS, keys=TRAIN_KEYS)
    )


def q14_sparse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows whose share of NULL fields, over the columns that the
    column pruning left, is at most 0.3."""
    from matchday.session import materialize

    # read by the profile and by the rows
    table = materialize(training_set(spark, sf_dir))
    ts, _dropped = drop_sparse_columns(table, 0.25, exempt=TARGETS, keys=[*TRAIN_KEYS, "role"])
    kept = drop_sparse_rows(ts, 0.3)
    return round_cols(
        kept.select(*TRAIN_KEYS, "fwd_fv_scaled", row_null_share(ts.columns).alias("row_null_share"))
    )


def labelled_rows(spark: SparkSession, sf_dir: str, ts: DataFrame | None = None) -> DataFrame:
    """Training rows with a target, its bin, class code and weight, and a
    numeric row id built from the view keys (for hash splits)."""
    # bins, weights, split and folds need only keys, role and target
    ts = (training_set(spark, sf_dir, with_team=False) if ts is None else ts).filter(
        F.col("fwd_fv_scaled").isNotNull()
    )
    # below 2^62 whatever the user id; rows that agree in it only tie in the split
    rid = (
        F.pmod(F.substring("surname", 2, 20).cast("long"), F.lit(1 << 48)) * 10000
        + F.pmod(F.col("season"), F.lit(100)) * 100
        + F.col("round_no")
    )
    return with_bins(ts.withColumn("row_id", rid), "fwd_fv_scaled")


def q15_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target bin (left-closed, lower-edge label) and class code per row."""
    lr = labelled_rows(spark, sf_dir)
    return round_cols(lr.select(*TRAIN_KEYS, "role", "fwd_fv_scaled", "fv_bin", "label", "weight"))


def q16_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class frequencies and label-keyed class weights."""
    return class_weights(labelled_rows(spark, sf_dir))


def q17_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic 80/20 split stratified on (bin, role)."""
    lr = labelled_rows(spark, sf_dir).select(*TRAIN_KEYS, "row_id", "role", "fv_bin")
    return stratified_split(lr, ["fv_bin", "role"], "row_id")


def q18_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-stratified 5 folds over the training part of the split."""
    lr = labelled_rows(spark, sf_dir).select(*TRAIN_KEYS, "row_id", "role", "fv_bin")
    train = stratified_split(lr, ["fv_bin", "role"], "row_id").filter(F.col("split") == "train")
    return stratified_folds(train.drop("split"), ["fv_bin"], "row_id")


def label_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-class (truth, prediction) pairs: embedding label vs a stand-in
    prediction derived from the vector id."""
    e = V.table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("label").alias("truth"), F.pmod("vec_id", F.lit(10)).cast("int").alias("pred"))


def q19_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts: quality (truth) vs toxic (prediction) labels."""
    lab = V.table(spark, sf_dir, "labels")
    return confusion(lab, "quality", "toxic")


def q20_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class precision/recall/F1/support plus averages."""
    return round_cols(class_report(label_pairs(spark, sf_dir), "truth", "pred"))


def q21_mcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, balanced accuracy and Matthews correlation."""
    return round_cols(summary_scores(label_pairs(spark, sf_dir), "truth", "pred"))


def q22_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MSE, explained variance and median absolute error of voto vs fantavoto."""
    pm = V.player_match(spark, sf_dir)
    return round_cols(regression_scores(pm, "fantavoto", "voto"))


def q23_label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True vs predicted label counts aligned by label."""
    return label_distribution(label_pairs(spark, sf_dir), "truth", "pred")


def q24_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List items out of HTML pages (pattern path), names split, cells read."""
    return extract_list_items(V.table(spark, sf_dir, "pages"))


def q24b_html_extract_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same extraction through the HTML parser path (mapInPandas)."""
    return extract_list_items_parsed(V.table(spark, sf_dir, "pages"))


def q25_json_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API envelopes around each event's payload, unpacked to rows."""
    ev = V.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    env = ev.select(
        "event_id", "user_id", "event_type",
        F.concat(F.lit('{"api": {"results": 1, "fixtures": ['), F.col("props"), F.lit("]}}")).alias("payload"),
    )
    item = T.StructType([T.StructField("k", T.LongType())])
    return unpack_envelope(env, "payload", "fixtures", item, keep=["event_id", "user_id", "event_type"])


# --- example request templates (the host is no real one) -------------------------
ROUND_URL = "https://api.example.invalid/v2/fixtures/league/%%league_id%%/round/%%round%%"
STATS_URL = "https://api.example.invalid/v2/statistics/fixture/%%fixture_id%%"
# -------------------------------------------------------------------------------


def q26_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budgeted list of calendar rounds and fixture statistics to fetch."""
    cal = V.calendar(spark, sf_dir)
    rounds = pending_rounds(cal, cal).select(
        F.lit("calendar").alias("kind"), "league_id", "round_no",
        F.lit(None).cast("long").alias("fixture_id"),
        landing_name([("leagueid", F.col("league_id")), ("round", F.col("round_no"))]).alias("file_name"),
        expand_template(ROUND_URL, {"league_id": F.col("league_id"), "round": F.col("round_no")}).alias("url"),
    )
    stats = pending_fixtures(V.fixture_master(spark, sf_dir), V.fixture_stats(spark, sf_dir)).select(
        F.lit("stats").alias("kind"), "league_id", F.lit(None).cast("int").alias("round_no"), "fixture_id",
        landing_name([("fixtureid", F.col("fixture_id"))]).alias("file_name"),
        expand_template(STATS_URL, {"fixture_id": F.col("fixture_id")}).alias("url"),
    )
    work = rounds.unionByName(stats)
    return budgeted(
        work, ["kind", "league_id", F.coalesce("round_no", F.lit(0)), F.coalesce("fixture_id", F.lit(0))]
    )


def q27_time_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event instants as UTC text, London wall time, unix seconds, +5 days."""
    from matchday.functions.timez import plus_days, to_local, unix_seconds_of_wall_clock

    ev = V.table(spark, sf_dir, "events").select("event_id", "ts")
    fmt = "yyyy-MM-dd HH:mm:ss"
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        "event_id",
        F.date_format(ts, fmt).alias("ts_utc"),
        F.date_format(to_local(ts, "Europe/London"), fmt).alias("ts_london"),
        unix_seconds_of_wall_clock(F.col("ts")).alias("unix_s"),
        F.date_format(plus_days(ts, 5), fmt).alias("cutoff_utc"),
    )


QUERIES = {
    "q01_player_features": q01_player_features,
    "q02_player_master": q02_player_master,
    "q03_player_target": q03_player_target,
    "q04_stat_collapse": q04_stat_collapse,
    "q05_goals_unpivot_pivot": q05_goals_unpivot_pivot,
    "q06_team_schedule": q06_team_schedule,
    "q07_team_features": q07_team_features,
    "q08_calendar_stale_drop": q08_calendar_stale_drop,
    "q09_last_round": q09_last_round,
    "q09b_fixtures_per_round": q09b_fixtures_per_round,
    "q10_name_fix": q10_name_fix,
    "q11_opponent_join": q11_opponent_join,
    "q12_training_set": q12_training_set,
    "q13_sparse_columns": q13_sparse_columns,
    "q14_sparse_rows": q14_sparse_rows,
    "q15_bins": q15_bins,
    "q16_class_weights": q16_class_weights,
    "q17_stratified_split": q17_stratified_split,
    "q18_folds": q18_folds,
    "q19_confusion": q19_confusion,
    "q20_class_report": q20_class_report,
    "q21_mcc": q21_mcc,
    "q22_regression_metrics": q22_regression_metrics,
    "q23_label_distribution": q23_label_distribution,
    "q24_html_extract": q24_html_extract,
    "q24b_html_extract_parser": q24b_html_extract_parser,
    "q25_json_unpack": q25_json_unpack,
    "q26_worklist": q26_worklist,
    "q27_time_normalise": q27_time_normalise,
}


def q29_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as daily JSON folders, streamed (availableNow) into a
    table: latest event per (user, event type), timestamps to the
    microsecond."""
    from matchday.session import scratch_path
    from matchday.streaming.ingest import current_state, ingest_stream, land_by_day

    ev = V.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value"
    )
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    land_by_day(ev, "ts", f"{base}/landing")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    ingest_stream(spark, f"{base}/landing", f"{base}/rows", f"{base}/checkpoint", ev.schema, keys, order)
    out = current_state(spark, f"{base}/rows", ev.schema, keys, order)
    return out.select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


def q29b_stream_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar and a later delivery of it, landed as JSON files and
    streamed; stale not-started rows are dropped from what has landed."""
    from matchday.session import scratch_path
    from matchday.streaming.ingest import JSON_OPTIONS, amended_state, ingest_stream

    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    rows = amended_calendar(spark, sf_dir)
    rows.write.options(**JSON_OPTIONS).json(f"{base}/landing")
    ingest_stream(spark, f"{base}/landing", f"{base}/rows", f"{base}/checkpoint", rows.schema)
    return amended_state(spark, f"{base}/rows", rows.schema, [drop_stale_status])


def q29c_stream_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture statistics landed as JSON files and streamed; amended ones
    collapsed."""
    from matchday.session import scratch_path
    from matchday.streaming.ingest import amended_state, ingest_stream

    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    rows = V.fixture_stats(spark, sf_dir)
    rows.write.json(f"{base}/landing")
    ingest_stream(spark, f"{base}/landing", f"{base}/rows", f"{base}/checkpoint", rows.schema)
    return amended_state(spark, f"{base}/rows", rows.schema, [parse_stat_values, collapse_amended], ["fixture_id"])


def q18b_contiguous_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five runs of consecutive labelled rows (the regressor's folds)."""
    lr = labelled_rows(spark, sf_dir).select(*TRAIN_KEYS, "fv_bin")
    return contiguous_folds(lr, ["season", "round_no", "surname", "name"])


TEAM_URL = "https://api.example.invalid/v2/fixtures/team/%%team_id%%/%%league_id%%"


def q26b_team_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team and round keys to fetch: teams of each league without a finished
    home fixture, and the rounds of the scoring window of all leagues."""
    f = V.fixture(spark, sf_dir)
    landed = V.fixture(spark, sf_dir, finished_only=True).select("league_id", F.col("home_team_id").alias("team_id"))
    teams = pending_teams(f, landed.withColumn("team_id", F.col("team_id").cast("long")))
    window = last_played_round(V.calendar(spark, sf_dir)).first()  # one row
    rounds = pending_rounds(V.calendar(spark, sf_dir), V.calendar(spark, sf_dir), overwrite=True)
    rounds = rounds_in_window(rounds, window["start_round"], window["final_round"])
    none = F.lit(None)
    return teams.select(
        F.lit("team").alias("kind"), "league_id", "team_id", none.cast("int").alias("round_no"),
        landing_name([("leagueid", F.col("league_id")), ("teamid", F.col("team_id"))]).alias("file_name"),
        expand_template(TEAM_URL, {"league_id": F.col("league_id"), "team_id": F.col("team_id")}).alias("url"),
    ).unionByName(rounds.select(
        F.lit("round").alias("kind"), "league_id", none.cast("long").alias("team_id"), "round_no",
        landing_name([("leagueid", F.col("league_id")), ("round", F.col("round_no"))]).alias("file_name"),
        expand_template(ROUND_URL, {"league_id": F.col("league_id"), "round": F.col("round_no")}).alias("url"),
    ))


def q32_round_csvs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks landed as CSVs per round, those of even rounds with a leading
    unnamed index column; read, appended to a master that does not exist yet,
    written by season and read back."""
    from matchday.operators.clean import append_distinct
    from matchday.session import scratch_path
    from matchday.sources.landing import GRADE_COLUMNS, read_or_empty, read_round_csvs
    from matchday.sources.sinks import write_table

    base = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    marks = V.player_match(spark, sf_dir).withColumn(
        "_file", F.format_string("a%d_m%d.csv", F.col("season").cast("int"), F.col("round_no").cast("int"))
    )
    odd, even = F.col("round_no") % 2 == 1, F.col("round_no") % 2 == 0
    writer = marks.filter(odd).select("_file", *GRADE_COLUMNS).write.partitionBy("_file")
    writer.option("header", True).csv(f"{base}/csv")
    numbered = marks.filter(even).select("_file", F.lit(0).alias(" "), *GRADE_COLUMNS)
    numbered.write.mode("append").partitionBy("_file").option("header", True).csv(f"{base}/csv")
    landed = read_round_csvs(spark, f"{base}/csv")
    master = append_distinct(read_or_empty(spark, f"{base}/master", landed.schema), landed)
    write_table(master, f"{base}/master", ["season"])
    return read_or_empty(spark, f"{base}/master", landed.schema)


def q33_fixture_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested fixture records landed as JSON and flattened to the master of
    finished fixtures; only leagues with two rows or more are written."""
    from matchday.session import scratch_path
    from matchday.sources.json_api import read_fixture_files
    from matchday.sources.sinks import write_if_enough

    base = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    f = V.fixture(spark, sf_dir)
    half = F.concat_ws("-", "home_ht_goal", "away_ht_goal")

    def team(side: str):
        key = F.col(f"{side}_team_id").cast("long")
        return F.struct(key.alias("team_id"), F.concat(F.lit("team "), key).alias("team_name"))

    f.select(
        "fixture_id", F.col("league_id").cast("long").alias("league_id"),
        F.unix_seconds(F.col("event_date").cast("timestamp")).alias("event_timestamp"),
        F.when(F.col("status_short") == "FT", "Match Finished").otherwise("Not Started").alias("status"),
        F.col("status_short").alias("statusShort"),
        team("home").alias("homeTeam"), team("away").alias("awayTeam"),
        # finished fixtures of every fifth number have no half-time score
        F.struct(F.when(F.col("fixture_id") % 5 != 0, half).alias("halftime")).alias("score"),
        F.col("home_ft_goal").cast("int").alias("goalsHomeTeam"), F.col("away_ft_goal").cast("int").alias("goalsAwayTeam"),
    ).write.json(f"{base}/json")
    master = read_fixture_files(spark, f"{base}/json", arrays=False)
    kept = write_if_enough(master, f"{base}/master", ["league_id"])
    out = spark.read.schema(kept.schema).parquet(f"{base}/master")
    return out.withColumn("event_date", F.col("event_date").cast("timestamp_ntz"))


def q33b_calendar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar records landed per league and round, dates as ISO text with
    an offset of two hours; league and round read from the names."""
    from matchday.session import scratch_path
    from matchday.sources.json_api import read_calendar_files

    path = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    local = F.date_format(F.col("event_date") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss")
    V.calendar(spark, sf_dir).select(
        F.format_string("leagueid-%d_round-%d_.json", F.col("league_id").cast("int"), F.col("round_no").cast("int")).alias("_file"),
        "fixture_id", F.col("league_id").cast("long").alias("league_id"),
        F.concat(local, F.lit("+02:00")).alias("event_date"),
        F.when(F.col("status_short") == "FT", "Match Finished").otherwise("Not Started").alias("status"),
        F.col("status_short").alias("statusShort"),
    ).write.partitionBy("_file").json(path)
    rows = read_calendar_files(spark, path, arrays=False)
    return rows.withColumn("event_date", F.col("event_date").cast("timestamp_ntz"))


def q34_marks_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks pages, one per player and round, in both layouts of the players'
    links, read back to team, name, role and nine cells."""
    from matchday.sources.html import CELL_CLASS, LIST_CLASS, MARK_CELLS, PLAYER_LINKS, extract_marks

    m = V.player_match(spark, sf_dir)
    key = F.xxhash64("surname", "season", "round_no")
    old = F.concat(F.lit(PLAYER_LINKS[1][0] + "serie-a/"), F.col("name"), F.lit("_"), F.col("surname"), F.lit("_928"))
    new = F.concat(F.lit(PLAYER_LINKS[0][0]), F.col("name"), F.lit("-"), F.col("surname"), F.lit("/77"))
    cells = [
        F.concat(F.lit(f'<div class="{CELL_CLASS} x"> '), F.coalesce(F.col(c).cast("string"), F.lit("-")), F.lit("\n</div>"))
        for c in MARK_CELLS
    ]
    html = F.concat(
        F.lit(f'<html><ul class="{LIST_CLASS}"><span class="teamNameIn">'), F.col("team"),
        F.lit('</span><li>header <div class="inParameter">V</div></li><li><span class="playerNameIn"><a href="'),
        F.when(F.col("round_no") % 2 == 0, old).otherwise(new),
        F.lit('">x</a></span><span class="playerRole">'), F.col("role"), F.lit("</span>"), *cells,
        F.lit("</li></ul></html>"),
    )
    rows = extract_marks(m.select(key.alias("page_id"), html.alias("html")))
    return rows.select("team", "name", "surname", "role", *MARK_CELLS)


def q07b_duplicate_team_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the team unstack with several values (averaged by q07)."""
    rows = stat_rows(spark, sf_dir, V.fixture_master(spark, sf_dir))
    return duplicate_keys(rows, ["team_id", "team_name", "event_date", "fixture_id", "league_id", "fixture_stat"])


def q10b_names_to_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names of the corrected master that someone should look at."""
    master = q10_name_fix(spark, sf_dir)
    return master.filter(needs_review(F.col("surname"))).select("name", "surname").distinct()


def q16b_class_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of classes that the labelled rows have."""
    return labelled_rows(spark, sf_dir).agg(F.countDistinct("label").alias("n_classes"))


def _register_model_jobs() -> None:
    from matchday.plans import model_jobs as MJ

    QUERIES["q28_train_score"] = MJ.q28_train_score
    QUERIES["q28b_feature_importance"] = MJ.q28b_feature_importance
    QUERIES["q28c_watchlist_predictions"] = MJ.q28c_watchlist_predictions
    QUERIES["q28d_labelled_split"] = MJ.q28d_labelled_split
    QUERIES["q28e_label_codes"] = MJ.q28e_label_codes
    QUERIES["q31_prediction_metrics"] = MJ.q31_prediction_metrics
    QUERIES["q35_param_search"] = MJ.q35_param_search
    QUERIES["q36_validation_models"] = MJ.q36_validation_models
    QUERIES["q37_regression_model"] = MJ.q37_regression_model
    for f in (
        q29_stream_upsert, q29b_stream_calendar, q29c_stream_statistics, q07b_duplicate_team_rows,
        q10b_names_to_review, q16b_class_count, q32_round_csvs, q33_fixture_files, q33b_calendar_files,
        q34_marks_pages, q18b_contiguous_folds, q26b_team_worklist,
    ):
        QUERIES[f.__name__] = f
    QUERIES["q30_permutation_importance"] = MJ.q30_permutation_importance
    from matchday.plans import source_jobs as SJ

    for f in (
        SJ.q07c_quality_gate, SJ.q38_stream_features, SJ.q39_stream_dedup, SJ.q40_stat_files, SJ.q41_stat_envelopes,
        SJ.q41b_search_envelopes,
    ):
        QUERIES[f.__name__] = f


_register_model_jobs()
