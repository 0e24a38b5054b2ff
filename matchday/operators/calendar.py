"""Round calendars: the dense per-season target grid, the last played round,
and per-team schedules with the next opponent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchday.operators.reshape import home_away_rows


def player_target(
    marks: DataFrame,
    entity: Sequence[str] = ("name", "surname"),
    season: str = "season",
    rnd: str = "round_no",
    team: str = "team",
    value: str = "fantavoto",
    out: str = "fwd_fantavoto",
    n_rounds: int = 38,
) -> DataFrame:
    """Dense (player, season, round 1..n_rounds) grid with the team filled
    forward then backward and ``out`` = the next round's ``value``.

    No skeleton cross join and no join back: each mark row is expanded,
    inside its own partition, to the grid rounds it governs
    (``[round, next_round - 1]``, the first mark also ``[1, round]``).  The
    job is a partial aggregate (copies of a mark collapse map-side) and one
    window Exchange on (player, season) whose partitions hold at most
    ``n_rounds`` rows.  A player listed twice in one round keeps the row of
    the last team (by name order).  Marks outside 1..n_rounds give no value,
    but a player who has no others gets the whole grid, without a team.
    """
    k = [*entity, season]
    w = Window.partitionBy(*k).orderBy(F.col(rnd))
    # one mark per (player, season, round) as a partial aggregate first:
    # copies of a mark collapse map-side, so every window partition below
    # holds at most n_rounds rows
    m = (
        marks.select(
            *k, *[F.when(F.col(rnd).between(1, n_rounds), F.col(c)).alias(c) for c in (rnd, team, value)]
        )
        .groupBy(*k, rnd)
        .agg(F.max(F.struct(F.col(team).alias("t"), F.col(value).alias("v"))).alias("_m"))
        .select(*k, rnd, F.col("_m.t").alias(team), F.col("_m.v").alias(value))
    )
    team_filled = F.coalesce(
        F.last(team, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        F.first(team, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)),
    )
    spans = m.select(
        *k,
        F.col(rnd).alias("_r"),
        F.col(value).alias("_v"),
        team_filled.alias(team),
        F.lead(rnd).over(w).alias("_next_r"),
        F.lead(value).over(w).alias("_next_v"),
        F.lag(rnd).over(w).isNull().alias("_first"),
    )
    # the row without a round only stands for a player who has no other
    spans = spans.filter(F.col("_r").isNotNull() | F.col("_next_r").isNull())
    start = F.when(F.col("_first"), F.lit(1)).otherwise(F.col("_r"))
    end = F.coalesce(F.col("_next_r") - 1, F.lit(n_rounds))
    grid = spans.select("*", F.explode(F.sequence(start, end)).alias(rnd))
    nxt = F.col(rnd) + 1
    fwd = F.when(nxt == F.col("_r"), F.col("_v")).when(nxt == F.col("_next_r"), F.col("_next_v"))
    return grid.select(season, rnd, team, *entity, fwd.alias(out))


def last_played_round(
    cal: DataFrame,
    league: str = "league_id",
    rnd: str = "round_no",
    status: str = "status_short",
    date: str = "event_date",
    finished: str = "FT",
    min_share: float = 0.5,
    n_rounds: int = 38,
) -> DataFrame:
    """One row: the last round of the most recent league(s) in which more
    than ``min_share`` of the fixtures are ``finished``, and the scoring
    window around it (``start = last-2`` or 1, ``final = last+2`` or
    ``n_rounds + 1``).

    Every step is an aggregate; the only join is a semi join against the
    (one row per league) most-recent-league list.
    """
    firsts = cal.groupBy(league).agg(F.min(date).alias("_first"))
    newest = firsts.agg(F.max("_first").alias("_first"))
    recent = firsts.join(newest, "_first", "left_semi").select(league)
    cur = cal.join(recent, league, "left_semi")
    per_round = cur.groupBy(rnd).agg(
        F.count(status).alias("_obs"),
        F.count(F.when(F.col(status) == finished, 1)).alias("_fin"),
    )
    share = F.col("_fin") / F.col("_obs")
    last = per_round.agg(
        F.max(F.when((F.col("_fin") > 0) & (share > min_share), F.col(rnd))).alias("last_round"),
        F.count("*").alias("rounds_seen"),
    )
    lr = F.col("last_round")
    return last.select(
        lr,
        F.when(lr >= 3, lr - 2).otherwise(F.lit(1)).alias("start_round"),
        F.when(lr <= n_rounds - 2, lr + 2).otherwise(F.lit(n_rounds + 1)).alias("final_round"),
        "rounds_seen",
    )


def team_schedule(
    master: DataFrame,
    seasons: DataFrame,
    keep: Sequence[str] = ("fixture_id", "league_id", "event_date"),
) -> DataFrame:
    """Each fixture as two team rows (core team, opponent, home flag) with
    ``next_opponent`` = the opponent of the team's next fixture of the
    season (ordered by league, date, fixture id)."""
    m = master.join(seasons, "league_id")
    rows = home_away_rows(
        m,
        [*keep, "season"],
        {
            "core": {"core_team_id": "home_team_id", "opponent_team_id": "away_team_id"},
            "oppo": {"core_team_id": "away_team_id", "opponent_team_id": "home_team_id"},
        },
        side_col="play_home",
    )
    from matchday.operators.rolling import windowed

    def build(spec):
        guard = F.col("core_team_id").isNotNull() & F.col("season").isNotNull()
        return [F.when(guard, F.lead("opponent_team_id").over(spec)).alias("next_opponent")]

    # a team-season can be long: heavy ones go through the chunked plan
    return windowed(
        rows, ["core_team_id", "season"], ["league_id", "event_date", "fixture_id"], build,
        halo=0, ahead=1, bucket_prefix=2,
    )


def fixtures_per_round(cal: DataFrame, league: str = "league_id", rnd: str = "round_no") -> DataFrame:
    """Data-quality count: fixtures per (league, round)."""
    return cal.groupBy(league, rnd).agg(F.count("*").alias("n_fixtures"))
