"""Point-in-time assembly of the training table: team features with the
next opponent's features, player features and targets, forward fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.operators.fill import ffill_columns, ffill_bfill_column


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """One row per ``keys``: the values of ``cols`` from the row that is last
    by ``order``.  ``max_by`` is a declarative aggregate, so Spark combines
    map-side first and a hot key costs one partial row per task."""
    packed = F.struct(*[F.col(c).alias(c) for c in cols])
    by = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.max_by(packed, by).alias("_v")).select(*keys, "_v.*")


def opponent_features(
    team_feat: DataFrame,
    schedule: DataFrame,
    team_map: DataFrame,
    feature_cols: Sequence[str],
    rnd: str = "round_no",
) -> DataFrame:
    """Team features of each fixture plus the NEXT opponent's features at
    the same round (``op_`` prefix), with the marks-source team name.

    * next opponent: schedule rows that have team features, ``lead`` over
      the team's season (one Window, partition = team x season);
    * joined back on (team, league, fixture) - one row each side;
    * opponent side reduced to one row per (team, league, season, round)
      (the last fixture of that round), so the self join is 1:1 even when
      a team plays several fixtures in one round;
    * inner join to the team-name map (unmapped teams are dropped).
    """
    keys = ["league_id", "fixture_id"]
    support = team_feat.select("team_id", *keys).distinct()
    sched = schedule.join(
        support.withColumnRenamed("team_id", "core_team_id"), ["core_team_id", *keys], "left_semi"
    )
    from matchday.operators.rolling import windowed

    nxt = windowed(
        sched.select("core_team_id", "season", "league_id", "event_date", "fixture_id", "opponent_team_id"),
        ["core_team_id", "season"], ["league_id", "event_date", "fixture_id"],
        lambda spec: [F.lead("opponent_team_id").over(spec).alias("opponent_id")],
        halo=0, ahead=1, bucket_prefix=2,
    ).select(F.col("core_team_id").alias("team_id"), *keys, "opponent_id")
    tf = team_feat.join(nxt, ["team_id", *keys], "left")
    opp = latest_per_key(
        tf, ["team_id", "league_id", "season", rnd], ["event_date", "fixture_id"], feature_cols
    ).select(
        F.col("team_id").alias("opponent_id"),
        "league_id",
        "season",
        rnd,
        *[F.col(c).alias("op_" + c) for c in feature_cols],
    )
    tf = tf.join(opp, ["opponent_id", "league_id", "season", rnd], "left")
    mapped = tf.join(team_map, "team_name").drop("team_name").withColumnRenamed("team_marks", "team_name")
    return mapped.select(
        "team_id", "team_name", "event_date", "fixture_id", "league_id", "season", rnd,
        "opponent_id", *feature_cols, *["op_" + c for c in feature_cols],
    )


def role_dummies(role: str, values: Sequence[str]) -> list:
    return [(F.col(role) == v).cast("double").alias(f"{role}_{v}") for v in values]


def with_role_dummies(df: DataFrame, roles: Sequence[str] = ("A", "C", "D", "P")) -> DataFrame:
    """``df`` plus one 0/1 column per role.  Added after pruning, so that
    they count neither as columns nor as fields of a row there."""
    return df.select("*", *role_dummies("role", roles))


def training_table(
    target: DataFrame,
    player_feat: DataFrame,
    team_opp: DataFrame | None,
    player_cols: Sequence[str],
    team_cols: Sequence[str],
    rnd: str = "round_no",
    centre: float = 6.0,
    seasons: Sequence[int] | None = None,
) -> DataFrame:
    """Player rows (target grid) with player, team and opponent features.

    * player features: left join on (name, surname, season, round) NULL-safe
      on names, forward filled inside (player, season);
    * role filled forward then backward inside (player, season);
    * team + opponent features: computed on the small (team, season, round)
      table - ``team_opp`` reduced to the last fixture per round, filled
      forward over rounds present in the player rows - then joined back
      many-to-one;
    * the season selection is a filter on the target's seasons before any
      join; role dummies come after pruning (:func:`with_role_dummies`).  Same values as a tie-safe RANGE fill over player rows,
      without a window whose partition is a whole team's player rows.
    """
    pk = ["name", "surname", "season", rnd]
    if seasons is not None:
        target = target.filter(F.col("season").isin(*seasons))
        player_feat = player_feat.filter(F.col("season").isin(*seasons))
    t = target.select(
        *pk, "team", "fwd_fantavoto", (F.col("fwd_fantavoto") - centre).alias("fwd_fv_scaled")
    )  # the grid has one row per player and round
    pf = player_feat.select(*[F.col(c).alias("_pf_" + c) for c in pk], "role", *player_cols)
    cond = (
        F.col("name").eqNullSafe(F.col("_pf_name"))
        & F.col("surname").eqNullSafe(F.col("_pf_surname"))
        & (F.col("season") == F.col("_pf_season"))
        & (F.col(rnd) == F.col("_pf_" + rnd))
    )
    full = t.join(pf, cond, "left").drop(*["_pf_" + c for c in pk])
    pkeys, porder = ["name", "surname", "season"], [rnd]
    full = full.select(
        *pk, "team", "fwd_fantavoto", "fwd_fv_scaled",
        ffill_bfill_column(pkeys, porder, "role"),
        *ffill_columns(pkeys, porder, player_cols),
    )
    if team_opp is None:
        # player side only: the team joins are 1:1 left joins, so the rows
        # and roles are the same as with team features
        return full.select(
            "name", "surname", "season", rnd, "role", "fwd_fantavoto", "fwd_fv_scaled", *player_cols,
        )
    tcols = list(team_cols) + ["op_" + c for c in team_cols]
    per_round = latest_per_key(
        team_opp, ["team_name", "season", rnd], ["event_date", "fixture_id"], tcols
    ).withColumnRenamed("team_name", "team")
    # same (team, season, round) rows as ``full`` (a left join keeps them),
    # taken from the target grid so the joined table is not recomputed
    rounds = t.select("team", "season", rnd).distinct()
    filled = rounds.join(per_round, ["team", "season", rnd], "left").select(
        "team", "season", rnd, *ffill_columns(["team", "season"], [rnd], tcols)
    )
    out = full.join(filled, ["team", "season", rnd], "left")
    return out.select(
        "name", "surname", "season", rnd, "role", "fwd_fantavoto", "fwd_fv_scaled",
        *player_cols, *tcols,
    )
