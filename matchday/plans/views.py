"""Canonical domain views over the driver's test tables.

The driver ships generic tables; these views give them the shape of the
domain tables (player marks per round, fixtures, fixture statistics, the
calendar, dimension maps).  Each view has an SQL twin in
:mod:`matchday.plans.oracle_views` so the DuckDB oracle sees identical
inputs.  All of them are projections / aggregates Spark derives from the
given tables, so their size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values of the test views ----------------------------------------
# league (calendar year of the fixture) -> season of the player marks
SEASON_OFFSET = 23
# team-name map covers nation keys 0..18; higher keys stay unmapped
MAPPED_TEAMS = 18
# as-of instant for "games already played" cuts (after every test date)
AS_OF = "2024-02-01 00:00:00"
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def player_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades table: one row per player and round (a day is a round).

    team, name, surname, role, season, round_no, voto, fantavoto and the
    seven count statistics.  ``voto`` is NULL for rounds without a mark.
    """
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    et, v = F.col("event_type"), F.col("value")
    agg = ev.groupBy(
        "user_id",
        F.year("ts").alias("season"),
        F.dayofmonth("ts").alias("round_no"),
    ).agg(
        F.round(F.avg(F.when(et == "view", v)) / 10, 6).alias("voto"),
        F.round(F.max(F.when(et == "click", v)) / 10, 6).alias("fantavoto"),
        F.count(F.when(et == "purchase", 1)).alias("gol"),
        F.sum(F.when(et == "error", 1)).cast("long").alias("ammonizione"),
        F.count(F.when(et == "click", 1)).alias("assist"),
        F.count(F.when((et == "purchase") & (v >= 40), 1)).alias("rigore"),
        F.count(F.when((et == "signup") & (v < 10), 1)).alias("rig_sbagliato"),
        F.sum(F.when((et == "view") & (v >= 100), 1)).cast("long").alias("autogol"),
        F.sum(F.when((et == "error") & (v >= 80), 1)).cast("long").alias("espulsione"),
    )
    uid = F.col("user_id")
    return agg.select(
        F.concat(F.lit("t"), (uid % 20).cast("string")).alias("team"),
        F.concat(F.lit("n"), (uid % 7).cast("string")).alias("name"),
        F.concat(F.lit("s"), uid.cast("string")).alias("surname"),
        F.when(uid % 4 == 0, "P")
        .when(uid % 4 == 1, "D")
        .when(uid % 4 == 2, "C")
        .otherwise("A")
        .alias("role"),
        "season",
        "round_no",
        "voto",
        "fantavoto",
        "gol",
        "ammonizione",
        "assist",
        "rigore",
        "rig_sbagliato",
        "autogol",
        "espulsione",
    )


def nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """team_id -> team_name (25 rows in every scale factor)."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_name")
    )


def fixture(spark: SparkSession, sf_dir: str, finished_only: bool = False) -> DataFrame:
    """Schedule / calendar: one row per fixture (league = year, round = ISO week).

    ``finished_only`` filters the SOURCE column (``o_orderstatus = 'F'``), so
    the predicate reaches the parquet reader; a filter on the derived
    ``status_short`` would stay a CASE expression above the scan."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    if finished_only:
        o = o.filter(F.col("o_orderstatus") == "F")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    key = F.col("o_orderkey")
    home_ht = (key % 3).cast("int")
    away_ht = F.floor("o_totalprice").cast("long") % 2
    return j.select(
        key.alias("fixture_id"),
        F.year("o_orderdate").alias("league_id"),
        F.weekofyear("o_orderdate").alias("round_no"),
        F.col("o_orderdate").alias("event_date"),
        F.when(F.col("o_orderstatus") == "F", "FT")
        .when(F.col("o_orderstatus") == "O", "NS")
        .otherwise("PST")
        .alias("status_short"),
        F.col("c_nationkey").alias("home_team_id"),
        ((F.col("c_nationkey") + 1 + key % 24) % 25).cast("int").alias("away_team_id"),
        home_ht.alias("home_ht_goal"),
        away_ht.alias("away_ht_goal"),
        (home_ht + (F.col("o_custkey") % 2).cast("int")).alias("home_ft_goal"),
        (away_ht + key % 2).alias("away_ft_goal"),
    )


def fixture_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished fixtures with team names (the reference's fixture master)."""
    f = fixture(spark, sf_dir, finished_only=True)
    names = nation_names(spark, sf_dir)
    home = names.select(
        F.col("team_id").alias("home_team_id"), F.col("team_name").alias("home_team_name")
    )
    away = names.select(
        F.col("team_id").alias("away_team_id"), F.col("team_name").alias("away_team_name")
    )
    # nation is a fixed 25-row dimension: broadcasting it is size-bounded
    return f.join(F.broadcast(home), "home_team_id", "left").join(
        F.broadcast(away), "away_team_id", "left"
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """League calendar: fixture_id, league_id, event_date, round_no,
    status_short - from the orders alone, which hold all of it."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("fixture_id"),
        F.year("o_orderdate").alias("league_id"),
        F.weekofyear("o_orderdate").alias("round_no"),
        F.col("o_orderdate").alias("event_date"),
        F.when(F.col("o_orderstatus") == "F", "FT")
        .when(F.col("o_orderstatus") == "O", "NS")
        .otherwise("PST")
        .alias("status_short"),
    ).select("fixture_id", "league_id", "event_date", "round_no", "status_short")


def fixture_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text statistics per fixture, with amended duplicates."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_quantity", "l_linenumber"
    )
    flag = F.col("l_returnflag")
    return li.select(
        F.col("l_orderkey").alias("fixture_id"),
        F.when(flag == "A", "Ball Possession")
        .when(flag == "N", "Shots on Goal")
        .otherwise("Fouls")
        .alias("fixture_stat"),
        F.when(flag == "A", F.concat(F.col("l_quantity").cast("string"), F.lit("%")))
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("home"),
        F.col("l_linenumber").cast("string").alias("away"),
    )


def team_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider team name -> marks-source team name ('t<key>')."""
    n = table(spark, sf_dir, "nation")
    return n.filter(F.col("n_nationkey") <= MAPPED_TEAMS).select(
        F.col("n_name").alias("team_name"),
        F.concat(F.lit("t"), F.col("n_nationkey").cast("string")).alias("team_marks"),
    )


def league_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """League id -> season dimension (one row per league in the calendar)."""
    return (
        calendar(spark, sf_dir)
        .select("league_id")
        .distinct()
        .select("league_id", (F.col("league_id") + SEASON_OFFSET).alias("season"))
    )


def name_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual name corrections: goalkeepers get both fields corrected,
    players of team t1 only the surname (the other field stays NULL)."""
    pm = player_match(spark, sf_dir).select("team", "name", "surname", "role")
    both = pm.filter(F.col("role") == "P").select(
        "name",
        "surname",
        F.upper("name").alias("name_correct"),
        F.concat(F.col("surname"), F.lit(" jr")).alias("surname_correct"),
    )
    one = pm.filter(F.col("team") == "t1").select(
        "name",
        "surname",
        F.lit(None).cast("string").alias("name_correct"),
        F.concat(F.col("surname"), F.lit("x")).alias("surname_correct"),
    )
    return both.unionByName(one).distinct()
