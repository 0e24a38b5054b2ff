"""JSON payloads: API envelopes, nested fixture records, column-oriented
statistics files, per-round calendar files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.functions.text import split_score
from matchday.functions.timez import to_local

FIXTURE_SCHEMA = T.StructType(
    [
        T.StructField("fixture_id", T.LongType()),
        T.StructField("league_id", T.LongType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("statusShort", T.StringType()),
        T.StructField("homeTeam", T.StructType([
            T.StructField("team_id", T.LongType()), T.StructField("team_name", T.StringType())])),
        T.StructField("awayTeam", T.StructType([
            T.StructField("team_id", T.LongType()), T.StructField("team_name", T.StringType())])),
        T.StructField("score", T.StructType([T.StructField("halftime", T.StringType())])),
        T.StructField("goalsHomeTeam", T.IntegerType()),
        T.StructField("goalsAwayTeam", T.IntegerType()),
    ]
)

CALENDAR_SCHEMA = T.StructType(
    [
        T.StructField("fixture_id", T.LongType()),
        T.StructField("league_id", T.LongType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("statusShort", T.StringType()),
    ]
)

STAT_PAIR = T.StructType([T.StructField("home", T.StringType()), T.StructField("away", T.StringType())])


def envelope_schema(payload_key: str, item: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("api", T.StructType([
            T.StructField("results", T.IntegerType()),
            T.StructField(payload_key, item),
        ]))]
    )


def unpack_envelope(
    df: DataFrame,
    col: str,
    payload_key: str,
    item_schema: T.StructType,
    keep: list[str] | None = None,
    target_field: str | None = None,
    target: str | None = None,
) -> DataFrame:
    """``{"api": {"results": n, "<payload_key>": [ {...}, ... ]}}`` -> one row
    per payload item (envelopes with ``results <= 0`` are skipped), optionally
    only items whose ``target_field`` equals ``target``."""
    keep = keep or []
    parsed = df.select(*keep, F.from_json(F.col(col), envelope_schema(payload_key, T.ArrayType(item_schema))).alias("_e"))
    items = parsed.filter(F.col("_e.api.results") > 0).select(
        *keep, F.explode(F.col(f"_e.api.{payload_key}")).alias("_i")
    ).select(*keep, "_i.*")
    if target_field is not None:
        items = items.filter(F.col(target_field) == F.lit(target))
    return items


def unpack_stat_envelope(df: DataFrame, col: str, payload_key: str = "statistics",
                         keep: list[str] | None = None) -> DataFrame:
    """Statistics payload ``{"Shots on Goal": {"home": "3", "away": "2"}, ...}``
    -> rows (fixture_stat, home, away)."""
    keep = keep or []
    schema = envelope_schema(payload_key, T.MapType(T.StringType(), STAT_PAIR))
    parsed = df.select(*keep, F.from_json(F.col(col), schema).alias("_e"))
    return parsed.filter(F.col("_e.api.results") > 0).select(
        *keep, F.explode(F.col(f"_e.api.{payload_key}")).alias("fixture_stat", "_v")
    ).select(*keep, "fixture_stat", F.col("_v.home").alias("home"), F.col("_v.away").alias("away"))


def flatten_fixtures(raw: DataFrame) -> DataFrame:
    """Nested fixture records -> fixture-master rows.  Goals are only kept
    for finished matches; a finished match without a half-time score reads
    it as ``0-0``; ``event_date`` is the UTC instant of the unix time."""
    finished = F.col("status") == "Match Finished"
    ht_home, ht_away = split_score(F.col("score.halftime"))
    return raw.select(
        "fixture_id", "league_id",
        F.timestamp_seconds("event_timestamp").alias("event_date"),
        "statusShort",
        F.col("homeTeam.team_id").alias("home_team_id"),
        F.col("homeTeam.team_name").alias("home_team_name"),
        F.col("awayTeam.team_id").alias("away_team_id"),
        F.col("awayTeam.team_name").alias("away_team_name"),
        F.when(finished, ht_home).alias("home_ht_goal"),
        F.when(finished, ht_away).alias("away_ht_goal"),
        F.when(finished, F.col("goalsHomeTeam")).alias("home_ft_goal"),
        F.when(finished, F.col("goalsAwayTeam")).alias("away_ft_goal"),
    )


def file_id(pattern: str, group: int = 1) -> Column:
    """Integer taken from the source file's name, or that of its folder, by
    ``pattern``."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group).cast("long")


def read_fixture_files(spark: SparkSession, path: str, arrays: bool = True) -> DataFrame:
    """Directory of fixture records, JSON arrays or one record a line ->
    finished fixtures."""
    raw = spark.read.schema(FIXTURE_SCHEMA).option("multiLine", arrays).json(path)
    return flatten_fixtures(raw).filter(F.col("statusShort") == "FT").distinct()


def read_calendar_files(spark: SparkSession, path: str, arrays: bool = True) -> DataFrame:
    """Directory of ``leagueid-<id>_round-<n>_.json`` arrays (or folders of
    that name with one record a line) -> calendar rows with the round taken
    from the name and ISO dates, with any offset, as UTC instants."""
    raw = spark.read.schema(CALENDAR_SCHEMA).option("multiLine", arrays).json(path)
    return raw.select(
        "fixture_id", "league_id",
        F.to_timestamp("event_date").alias("event_date"),
        file_id(r"round-(\d+)").cast("int").alias("match"),
        "status", "statusShort",
    )


def parse_stat_documents(docs: DataFrame, name: Column, value: Column, fixtures: DataFrame | None = None) -> DataFrame:
    """Column-oriented statistics documents named ``fixtureid-<id>_.json``
    (``{"fixture_stat": {"0": ..}, "home": {"0": ..}, "away": {"0": ..}}``)
    -> rows (fixture_id, fixture_stat, home, away).  A column that lacks an
    index gives NULL there; only fixtures present in ``fixtures`` when given
    (left-semi join); repeated rows collapse."""
    raw = docs.select(
        F.regexp_extract(name, r"fixtureid-(\d+)", 1).try_cast("long").alias("fixture_id"),
        F.from_json(value, T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))).alias("m"),
    )
    rows = raw.select(
        "fixture_id", "m", F.explode(F.col("m")["fixture_stat"]).alias("_i", "fixture_stat")
    ).select(
        "fixture_id", "fixture_stat",
        F.element_at(F.col("m")["home"], F.col("_i")).alias("home"),
        F.element_at(F.col("m")["away"], F.col("_i")).alias("away"),
    )
    # a file split holds a bounded number of statistics; the parts of four of
    # them that meet by fixture stay small in the join's sort and in distinct
    rows = rows.repartition(4 * max(1, docs.rdd.getNumPartitions()), "fixture_id")
    if fixtures is not None:
        rows = rows.join(fixtures.select("fixture_id").distinct(), "fixture_id", "left_semi")
    return rows.distinct()


def read_stat_files(spark: SparkSession, path: str, fixtures: DataFrame | None = None) -> DataFrame:
    """:func:`parse_stat_documents` of a folder of such files."""
    raw = spark.read.option("wholetext", True).text(path).select("value", F.col("_metadata.file_path").alias("name"))
    return parse_stat_documents(raw, F.col("name"), F.col("value"), fixtures)


def read_packed_stat_files(spark: SparkSession, path: str, fixtures: DataFrame | None = None) -> DataFrame:
    """The same of many small files packed as JSON lines ``{"name", "content"}``:
    a folder of millions of files of some hundred bytes is packed before it is
    read, as each file costs a listing and a task's share of opening it."""
    packed = spark.read.schema("name string, content string").json(path)
    return parse_stat_documents(packed, F.col("name"), F.col("content"), fixtures)


def localise(df: DataFrame, col: str = "event_date", tz: str = "Europe/London") -> DataFrame:
    """Display copy of an instant column in ``tz`` (storage stays UTC)."""
    return df.withColumn(col + "_local", to_local(F.col(col), tz))
