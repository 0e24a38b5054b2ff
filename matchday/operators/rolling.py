"""Row-count rolling aggregates over per-entity ordered series.

All frames are trailing ``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW`` with a
minimum number of non-null observations (pandas ``min_periods``); below it
the result is NULL.

Every spec that shares the partition/order lands in ONE ``Window`` node, so
any number of features costs a single Exchange + Sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGGS = {
    "sum": F.sum,
    "mean": F.avg,
    "std": F.stddev_samp,
    "count": F.count,
    "max": F.max,
    "min": F.min,
}


@dataclass(frozen=True)
class RollSpec:
    """One rolling feature: ``fn`` of ``source`` over the last ``rows`` rows."""

    source: str
    fn: str
    rows: int
    min_rows: int = 1
    out: str | None = None

    @property
    def name(self) -> str:
        return self.out or f"{self.source}_{self.fn}{self.rows}"


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def rolling_columns(
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    specs: Sequence[RollSpec],
) -> list[Column]:
    """The window expressions for ``specs`` (to use in a ``select``)."""
    base = Window.partitionBy(*_as_cols(keys)).orderBy(*_as_cols(order))
    out = []
    for s in specs:
        if s.fn not in _AGGS:
            raise ValueError(f"unknown rolling function {s.fn!r}")
        w = base.rowsBetween(-(s.rows - 1), Window.currentRow)
        v = F.col(s.source)
        agg = _AGGS[s.fn](v).over(w)
        if s.min_rows > 0:
            agg = F.when(F.count(v).over(w) >= s.min_rows, agg)
        out.append(agg.alias(s.name))
    return out


def rolling(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    specs: Sequence[RollSpec],
) -> DataFrame:
    """Append one column per spec; the row set is unchanged.

    ``order`` must be a total order inside a partition (add a tie-break
    column such as an event id), otherwise frames over ties are arbitrary.
    """
    return df.select("*", *rolling_columns(keys, order, specs))


# --- skew-safe windows ----------------------------------------------------------
#
# A plain window puts a whole entity in one task.  ``windowed`` routes the
# entities holding more than ``hot_rows`` rows through a chunked plan:
#
# 1. exact position of each row inside its entity without a whole-entity
#    window: counts per (entity, bucket) where the bucket is a PREFIX of the
#    order (monotone by construction), cumulative offsets over that small
#    table, rank inside (entity, bucket);
# 2. chunk = position // chunk_rows; the last ``halo`` rows of every chunk
#    are copied into the next chunk;
# 3. the same window expressions run per (entity, chunk) ordered by
#    position, halo copies are dropped.
#
# Row-count frames reaching back at most ``halo`` rows give exactly the plain
# result.

from collections.abc import Callable  # noqa: E402

from pyspark.sql import WindowSpec  # noqa: E402

HOT_ROWS_CONF = "matchday.rolling.hotRows"
CHUNK_ROWS_CONF = "matchday.rolling.chunkRows"
DEFAULT_HOT_ROWS = 5_000_000
DEFAULT_CHUNK_ROWS = 1_000_000


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    try:
        return int(df.sparkSession.conf.get(key, str(default)))
    except Exception:  # noqa: BLE001
        return default


def _chunked(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    build: Callable[[WindowSpec], list[Column]],
    halo: int,
    bucket_prefix: int,
    chunk_rows: int,
    ahead: int = 0,
) -> DataFrame:
    # a frame must never need rows from two chunks away
    chunk_rows = max(chunk_rows, halo + 1, ahead + 1)
    pre = order[:bucket_prefix]
    rest = order[bucket_prefix:]
    counts = df.groupBy(*keys, *pre).agg(F.count(F.lit(1)).alias("_bc"))
    w_cum = Window.partitionBy(*keys).orderBy(*pre).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(*keys, *pre, (F.sum("_bc").over(w_cum) - F.col("_bc")).alias("_off"))
    if rest:
        rk = F.row_number().over(Window.partitionBy(*keys, *pre).orderBy(*rest)) - 1
    else:
        rk = F.lit(0)
    ranked = df.select("*", rk.alias("_rk"))
    jk = [*keys, *pre]
    o = offsets.select(*[F.col(c).alias("_o_" + c) for c in jk], "_off")
    cond = None
    for c in jk:  # NULL-safe: a NULL key or bucket is a group of its own
        e = F.col(c).eqNullSafe(F.col("_o_" + c))
        cond = e if cond is None else cond & e
    pos = ranked.join(o, cond).withColumn("_pos", F.col("_off") + F.col("_rk"))
    chunk = F.floor(F.col("_pos") / F.lit(chunk_rows))
    within = F.pmod(F.col("_pos"), F.lit(chunk_rows))
    tail = (within >= chunk_rows - halo) & F.lit(halo > 0)     # also needed by the next chunk
    head = (within < ahead) & F.lit(ahead > 0)                 # also needed by the previous chunk
    dup = F.explode(F.filter(F.array(F.lit(0), F.when(tail, F.lit(1)), F.when(head, F.lit(-1))),
                             lambda x: x.isNotNull()))
    expanded = pos.select("*", dup.alias("_dup")).withColumn("_chunk", chunk + F.col("_dup"))
    spec = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    rolled = expanded.select(*df.columns, "_dup", *build(spec))
    return rolled.filter(F.col("_dup") == 0).drop("_dup")


def windowed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Callable[[WindowSpec], list[Column]],
    halo: int,
    bucket_prefix: int = 1,
    hot_rows: int | None = None,
    chunk_rows: int | None = None,
    ahead: int = 0,
) -> DataFrame:
    """``df`` plus the columns ``build(spec)`` returns, where ``spec`` is the
    partition/order to apply frames to (``spec.rowsBetween(-k, 0)``, k <=
    ``halo``; ``lead(.., k)`` with k <= ``ahead``).  Light entities use one
    plain window; entities above
    ``hot_rows`` rows (session conf ``matchday.rolling.hotRows``) the
    chunked plan described above.  ``hot_rows=0`` forces the plain plan."""
    keys, order = list(keys), list(order)
    hot = _conf_int(df, HOT_ROWS_CONF, DEFAULT_HOT_ROWS) if hot_rows is None else hot_rows
    chunk = _conf_int(df, CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS) if chunk_rows is None else chunk_rows
    plain_spec = Window.partitionBy(*keys).orderBy(*order)
    if hot <= 0:
        return df.select("*", *build(plain_spec))
    heavy = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot).select(*keys)
    # planning-time decision (one aggregate job; per-key partial counts
    # map-side): without heavy entities the plan stays the single-shuffle
    # window, so downstream operators keep its partitioning
    if not heavy.take(1):
        return df.select("*", *build(plain_spec))
    # NULL-safe, so that a heavy NULL key is split too; whether the list of
    # heavy keys is broadcast is for AQE to say, by its measured size
    h = heavy.select(*[F.col(k).alias("_h_" + k) for k in keys])
    same = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col("_h_" + k))
        same = e if same is None else same & e
    cold = df.join(h, same, "left_anti")
    hot_df = df.join(h, same, "left_semi")
    return cold.select("*", *build(plain_spec)).unionByName(
        _chunked(hot_df, keys, order, build, halo, bucket_prefix, chunk, ahead)
    )


def rolling_skew_safe(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    specs: Sequence[RollSpec],
    **kw,
) -> DataFrame:
    """:func:`rolling` through :func:`windowed` (same output)."""

    def build(spec: WindowSpec) -> list[Column]:
        out = []
        for s in specs:
            w = spec.rowsBetween(-(s.rows - 1), Window.currentRow)
            v = F.col(s.source)
            agg = _AGGS[s.fn](v).over(w)
            if s.min_rows > 0:
                agg = F.when(F.count(v).over(w) >= s.min_rows, agg)
            out.append(agg.alias(s.name))
        return out

    return windowed(df, keys, order, build, halo=max(s.rows for s in specs) - 1, **kw)
