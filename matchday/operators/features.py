"""Per-player and per-team rolling feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.functions.names import feature_name
from matchday.operators.rolling import RollSpec, windowed


@dataclass(frozen=True)
class FeatureWindows:
    """Window lengths of the feature families (defaults as the reference)."""

    mean_wind: tuple[int, ...] = (3, 7)
    sum_wind: tuple[int, ...] = (3, 7)
    sd_wind: tuple[int, ...] = (10,)
    count_wind: int = 10


@dataclass(frozen=True)
class PlayerColumns:
    """Column roles of a marks table."""

    entity: tuple[str, ...] = ("name", "surname")
    order: tuple[str, ...] = ("season", "round_no")
    attrs: tuple[str, ...] = ("team", "role")
    count_stats: tuple[str, ...] = (
        "gol", "assist", "rigore", "rig_sbagliato", "autogol", "ammonizione", "espulsione"
    )
    marks: tuple[str, ...] = ("voto", "fantavoto")
    presence_from: str = "voto"
    centre: float = 6.0
    extra_order: tuple[str, ...] = field(default=("team",))


def player_features(
    marks: DataFrame,
    cols: PlayerColumns = PlayerColumns(),
    windows: FeatureWindows = FeatureWindows(),
    dedupe_mean: bool = True,
) -> DataFrame:
    """Rolling player features, one row per (attrs, entity, order) key.

    * count stats (NULL -> 0): sums over ``sum_wind`` rows (min 2 rows) and
      sample std over ``sd_wind`` rows (min 2);
    * presence (mark present -> 1.0): count over ``count_wind`` rows;
    * marks centred on ``centre`` (NULL -> 0): means over ``mean_wind`` rows.

    All features share one partition/order, so Spark plans a single
    Exchange + Sort for the whole family.  With ``dedupe_mean`` duplicate
    keys are averaged (pivot-table semantics); that aggregate is clustered
    by a superset of the window keys, so it adds no shuffle.
    """
    keys = list(cols.attrs) + list(cols.entity) + list(cols.order)
    prepared = marks.select(
        *keys,
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols.count_stats],
        *[
            F.coalesce(F.col(c) - F.lit(cols.centre), F.lit(0.0)).alias(c)
            for c in cols.marks
        ],
        F.col(cols.presence_from).isNotNull().cast("double").alias("presenza"),
    )
    specs: list[RollSpec] = []
    for c in cols.count_stats:
        for n in windows.sum_wind:
            specs.append(RollSpec(c, "sum", n, 2, feature_name(c, f"s{n}")))
        for n in windows.sd_wind:
            specs.append(RollSpec(c, "std", n, 2, feature_name(c, f"sd{n}")))
    specs.append(
        RollSpec("presenza", "sum", windows.count_wind, 1, f"presenza_cnt{windows.count_wind}")
    )
    for c in cols.marks:
        for n in windows.mean_wind:
            specs.append(RollSpec(c, "mean", n, 1, feature_name(c, f"m{n}")))
    order = list(cols.order) + [c for c in cols.extra_order if c not in cols.order]

    def build(spec):
        from pyspark.sql import Window

        out = []
        for s in specs:
            w = spec.rowsBetween(-(s.rows - 1), Window.currentRow)
            v = F.col(s.source)
            agg = {"sum": F.sum, "mean": F.avg, "std": F.stddev_samp}[s.fn](v).over(w)
            out.append(F.when(F.count(v).over(w) >= s.min_rows, agg).alias(s.name))
        return out

    halo = max(s.rows for s in specs) - 1
    rolled = windowed(prepared, list(cols.entity), order, build, halo, bucket_prefix=2).select(
        *keys, *[s.name for s in specs]
    )
    names = sorted(s.name for s in specs)
    if dedupe_mean:
        rolled = rolled.groupBy(*keys).agg(*[F.avg(n).alias(n) for n in names])
    # pivot-table semantics: rows whose features are all NULL are dropped
    return rolled.filter(F.coalesce(*[F.col(n) for n in names]).isNotNull()).select(
        *keys, *names
    )


def player_feature_names(
    cols: PlayerColumns = PlayerColumns(), windows: FeatureWindows = FeatureWindows()
) -> list[str]:
    names = []
    for c in cols.count_stats:
        names += [feature_name(c, f"s{n}") for n in windows.sum_wind]
        names += [feature_name(c, f"sd{n}") for n in windows.sd_wind]
    names.append(f"presenza_cnt{windows.count_wind}")
    for c in cols.marks:
        names += [feature_name(c, f"m{n}") for n in windows.mean_wind]
    return sorted(names)


def round_cols(df: DataFrame, digits: int = 6, cols: Sequence[str] | None = None) -> DataFrame:
    """Round every double column (or ``cols``) for engine-independent output."""
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")
    }

    def rounded(c: str) -> Column:
        # round() goes through a decimal; whole numbers (counts, sums) need not (+ 0.0: no minus zero)
        x = F.col(c)
        return F.when(x == F.rint(x), x + F.lit(0.0)).otherwise(F.round(x, digits)).alias(c) if digits >= 0 else F.round(x, digits).alias(c)

    return df.select(*[rounded(c) if c in targets else F.col(c) for c in df.columns])


GOAL_STATS = ("ht_goal", "ft_goal")
TEAM_ORDER = ("league_id", "event_date", "fixture_id")


def team_stat_rows(
    stats: DataFrame,
    goals: DataFrame,
    master: DataFrame,
    as_of: str,
) -> DataFrame:
    """Per-team statistic rows: (fixture_id, event_date, league_id, team_id,
    team_name, fixture_stat, val).

    Detailed and goal statistics are stacked, joined to the fixture master
    (inner: statistics of unfinished fixtures have no team and are dropped
    by the reference as NULL keys), de-duplicated, split into one row per
    side in a single scan, cut at ``as_of`` and NULL values read as 0.
    """
    from matchday.operators.reshape import home_away_rows

    combo = stats.select("fixture_id", "fixture_stat", "home", "away").unionByName(
        goals.select("fixture_id", "fixture_stat", "home", "away")
    )
    mcols = ["fixture_id", "event_date", "league_id", "home_team_id", "home_team_name",
             "away_team_id", "away_team_name"]
    # no distinct here: a duplicate joined row only yields duplicate team
    # rows, which the one distinct below removes (one shuffle saved)
    j = combo.join(master.select(*mcols), "fixture_id")
    rows = home_away_rows(
        j,
        ["fixture_id", "event_date", "league_id", "fixture_stat"],
        {
            "home": {"team_id": "home_team_id", "team_name": "home_team_name", "val": "home"},
            "away": {"team_id": "away_team_id", "team_name": "away_team_name", "val": "away"},
        },
    ).distinct()
    return rows.filter(F.col("event_date") <= F.lit(as_of).cast("timestamp_ntz")).select(
        "fixture_id", "event_date", "league_id", "team_id", "team_name", "fixture_stat",
        F.coalesce(F.col("val"), F.lit(0.0)).alias("val"),
    )


def team_feature_names(
    stat_names: list[str], windows: FeatureWindows = FeatureWindows(), goal_stats=GOAL_STATS
) -> list[str]:
    names = []
    for s in stat_names:
        if s in goal_stats:
            names += [feature_name(s, f"s{n}") for n in windows.sum_wind]
        else:
            names += [feature_name(s, f"m{n}") for n in windows.mean_wind]
            names += [feature_name(s, f"sd{n}") for n in windows.sd_wind]
    return sorted(names)


def team_features(
    rows: DataFrame,
    stat_names: list[str],
    windows: FeatureWindows = FeatureWindows(),
    goal_stats: tuple[str, ...] = GOAL_STATS,
) -> DataFrame:
    """Wide team features, one row per (team, fixture).

    Windows run on the LONG table partitioned by (team, statistic): a
    fixture without a statistic has no row there, so the frame reaches one
    fixture further back (a wide table would count a NULL row).  Then one
    conditional aggregation unstacks the (feature, value) pairs.

    Non-goal statistics get means (min 2 rows) and sample std (min 2);
    goal statistics get sums (min 2).
    """
    from pyspark.sql import Window

    keys = ["team_id", "team_name", "fixture_stat"]
    lengths = sorted(set(windows.mean_wind) | set(windows.sum_wind) | set(windows.sd_wind))
    is_goal = F.col("fixture_stat").isin(*goal_stats)
    kind_names = [f"m{n}" for n in windows.mean_wind] + [f"sd{n}" for n in windows.sd_wind] + [
        f"s{n}" for n in windows.sum_wind
    ]

    def build(base):
        frame = {n: base.rowsBetween(-(n - 1), Window.currentRow) for n in lengths}
        v = F.col("val")
        # one count and one sum per frame length serve both means and sums
        # (Spark's avg is exactly sum / count), std only where needed
        cnt = {n: F.count(v).over(frame[n]) for n in lengths}
        tot = {n: F.sum(v).over(frame[n]) for n in set(windows.mean_wind) | set(windows.sum_wind)}
        std = {n: F.stddev_samp(v).over(frame[n]) for n in windows.sd_wind}
        out = []
        for n in windows.mean_wind:
            out.append(F.when(~is_goal & (cnt[n] >= 2), tot[n] / cnt[n]).alias(f"m{n}"))
        for n in windows.sd_wind:
            out.append(F.when(~is_goal & (cnt[n] >= 2), std[n]).alias(f"sd{n}"))
        for n in windows.sum_wind:
            out.append(F.when(is_goal & (cnt[n] >= 2), tot[n]).alias(f"s{n}"))
        return out

    base_cols = rows.select("team_id", "team_name", "event_date", "fixture_id", "league_id", "fixture_stat", "val")
    # bucket = (league, date): a prefix of the order, so positions stay exact
    rolled = windowed(base_cols, keys, list(TEAM_ORDER), build, max(lengths) - 1, bucket_prefix=2)
    kinds = {k: None for k in kind_names}
    # unstack: one conditional aggregate per (statistic, kind) - no explode
    aggs = []
    for st in stat_names:
        goal = st in goal_stats
        for k in kinds:
            if k.startswith("s") and not k.startswith("sd"):
                if not goal:
                    continue
            elif goal:
                continue
            aggs.append(
                F.avg(F.when(F.col("fixture_stat") == st, F.col(k))).alias(feature_name(st, k))
            )
    wide = rolled.groupBy("team_id", "team_name", "event_date", "fixture_id", "league_id").agg(*aggs)
    names = team_feature_names(stat_names, windows, goal_stats)
    return wide.select("team_id", "team_name", "event_date", "fixture_id", "league_id", *names)
