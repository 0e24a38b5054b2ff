"""Download work lists: which (league, round) calendars and which fixture
statistics still have to be fetched, within a daily request budget.

The HTTP calls themselves are not part of the engine; the plan-able part
is the key generation, the anti join against what already landed, the
budgeted ordering and the landing file name / request URL per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------
DAILY_BUDGET = 100          # requests per day on the free plan
N_ROUNDS = 38
# -------------------------------------------------------------------------------


def landing_name(parts: Sequence[tuple[str, Column]]) -> Column:
    """File name ``k1-v1_k2-v2_.json`` of a request key."""
    pieces = []
    for k, v in parts:
        pieces += [F.lit(f"{k}-"), v.cast("string"), F.lit("_")]
    return F.concat(*pieces, F.lit(".json"))


def parse_landing_name(name: Column) -> Column:
    """Inverse of :func:`landing_name`: ``map<key, value>``."""
    body = F.regexp_replace(F.regexp_replace(name, r"\.json$", ""), "_$", "")
    return F.str_to_map(body, F.lit("_"), F.lit("-"))


def expand_template(template: str, params: dict[str, Column]) -> Column:
    """Replace every ``%%key%%`` of ``template`` by the key's column value."""
    out: Column = F.lit(template)
    for k, v in params.items():
        out = F.replace(out, F.lit(f"%%{k}%%"), v.cast("string"))
    return out


def season_label(season: Column) -> Column:
    """``2019`` -> ``'2019-20'``."""
    return F.concat(
        season.cast("string"), F.lit("-"), F.lpad((F.pmod(season, F.lit(100)) + 1).cast("string"), 2, "0")
    )


def pending_rounds(
    leagues: DataFrame,
    landed: DataFrame,
    n_rounds: int = N_ROUNDS,
    overwrite: bool = False,
) -> DataFrame:
    """(league_id, round_no) keys of every league x round 1..n_rounds that
    has not landed yet (all of them with ``overwrite``).  The grid is an
    ``explode(sequence)`` per league - no cross join."""
    grid = leagues.select("league_id").distinct().select(
        "league_id", F.explode(F.sequence(F.lit(1), F.lit(n_rounds))).alias("round_no")
    )
    if overwrite:
        return grid
    return grid.join(landed.select("league_id", "round_no").distinct(), ["league_id", "round_no"], "left_anti")


def rounds_in_window(rounds: DataFrame, start: int, final: int) -> DataFrame:
    """Rounds from ``start`` up to, not including, ``final`` (the scoring
    window of the last played round)."""
    return rounds.filter(F.col("round_no").between(start, final - 1))


def pending_teams(schedule: DataFrame, landed: DataFrame, overwrite: bool = False) -> DataFrame:
    """(league_id, team_id) keys of every league's teams whose fixtures have
    not landed yet (all of them with ``overwrite``)."""
    sides = [schedule.select("league_id", F.col(c).cast("long").alias("team_id")) for c in ("home_team_id", "away_team_id")]
    teams = sides[0].union(sides[1]).distinct()
    if overwrite:
        return teams
    return teams.join(landed.select("league_id", "team_id").distinct(), ["league_id", "team_id"], "left_anti")


def pending_fixtures(finished: DataFrame, landed_stats: DataFrame, overwrite: bool = False) -> DataFrame:
    """Finished fixtures whose statistics have not landed yet."""
    f = finished.select("fixture_id", "league_id", "event_date").distinct()
    if overwrite:
        return f
    return f.join(landed_stats.select("fixture_id").distinct(), "fixture_id", "left_anti")


def budgeted(work: DataFrame, order: Sequence[str | Column], budget: int = DAILY_BUDGET) -> DataFrame:
    """The first ``budget`` work items by ``order`` (a top-k: Spark plans a
    TakeOrderedAndProject, each task keeps only its best ``budget`` rows)."""
    return work.orderBy(*order).limit(budget)
