"""Operator 4, mixing sources to target weights over a curriculum.

Every source has a weight schedule over training time 0..1.  Its integral
says which share of the source's target words is wanted up to a time; the
inverse of that cumulative demand gives each document the time at which its
words are due, and the documents are sorted by range of that position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.common import keep, md5_31, release, running_sum

#: weights of the sources in code-point order, repeating
WEIGHTS = (1, 2, 3)
#: a source's target stops at so many times its size
MAX_EPOCHS = 3
#: (time, multiplier) knots of the schedules, repeating with the weights: the
#: first fades out, the second is even, the third fades in
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, class, weight, source_size, target) for a table (source,
    source_size) of one row per source.

    All sizes together are shared by weight; what a source would get beyond
    ``max_epochs`` times its size is shared again among the others by weight,
    until none is above.  Each round is one aggregate that returns two
    numbers, whatever the number of sources.
    """
    n = sizes.count()
    # rank by code point: order-preserving ranges, counted, then ranked inside
    # (one partition as long as there are few sources)
    parts = max(1, -(-n // 100_000))
    ranged = sizes.repartitionByRange(parts, F.col("source").asc_nulls_last())
    ranged = keep(ranged.withColumn("_part", F.spark_partition_id()), "sources")
    each = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    ranked = ranged.withColumn("_rn", F.row_number().over(inside)).join(each, "_part")
    cls = F.pmod(F.col("_rn") - 1 + F.col("_off"), F.lit(len(weights))).cast("int")
    ranked = ranked.select("source", "source_size", cls.alias("class"))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.col("class") + 1))
    ranked = keep(ranked, "sources")
    cap = F.col("source_size") * max_epochs
    total = int(ranked.agg(F.sum("source_size")).first()[0] or 0)
    share = None  # target per unit of weight
    while True:
        full = F.lit(False) if share is None else cap <= F.lit(share) * F.col("weight")
        got = ranked.agg(
            F.sum(F.when(full, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(full, F.lit(0)).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not got["open"]:
            break
        new = float(total - int(got["capped"])) / float(got["open"])
        if share is not None and new <= share:
            break
        share = new
    target = cap.cast("double") if share is None else F.least(cap.cast("double"), F.lit(share) * F.col("weight"))
    return ranked.withColumn("target", target)


def _segments(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(integral up to here, time, length, multiplier at start, at end), with
    the integral over 0..1 scaled to 1."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    if not area > 0:
        raise ValueError("a schedule needs weight somewhere")
    out, done = [], 0.0
    for (t0, g0), (t1, g1) in zip(knots, knots[1:]):
        out.append((done, t0, t1 - t0, g0 / area, g1 / area))
        done += (t1 - t0) * (g0 + g1) / 2 / area
    return out


def due_time(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time by which the integral of the piecewise linear schedule has
    reached ``share`` (0..1) of its total: the inverse cumulative demand."""
    out = F.lit(float(knots[-1][0]))
    for done, t0, length, g0, g1 in reversed(_segments(knots)):
        rest = F.greatest(share - F.lit(done), F.lit(0.0))
        slope = (g1 - g0) / length
        if slope == 0:
            inside = rest / F.lit(g0) if g0 else F.lit(0.0)
        else:  # g0 x + slope x^2 / 2 = rest, by the stable form of the root
            root = F.sqrt(F.greatest(F.lit(g0 * g0) + F.lit(2 * slope) * rest, F.lit(0.0)))
            inside = F.when(rest <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * rest / (F.lit(g0) + root))
        end = done + length * (g0 + g1) / 2
        piece = F.lit(t0) + F.least(inside, F.lit(float(length)))
        out = F.when(share < F.lit(end), piece).otherwise(out) if end < 1 - 1e-12 else piece
    return out


def _key(doc_id: Column) -> Column:
    """Where a document stands among its source's: a uniform hash of its id."""
    return md5_31(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|mix")))


def _plan(docs, id_col, text_col, source_col, weights, schedules, max_epochs, place: Sequence[Column] = ()) -> DataFrame:
    """Narrow: the texts are read once.  ``place``: columns that tell rows
    apart that have id, size and checksum in common (as _p0, _p1, ...)."""
    text = F.col(text_col).cast("string")
    more = [f"_p{i}" for i in range(len(place))]
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        n_words(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("_crc"),
        *[c.alias(n) for c, n in zip(place, more, strict=True)],
    )
    base = keep(base, "sizes")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sizes = keep(sizes, "sizes")
    n_rows = int(sizes.agg(F.sum("n")).first()[0] or 0)
    targets = keep(source_targets(sizes.select("source", "source_size"), weights, max_epochs), "targets")
    ordered = running_sum(
        base, ["source"], _key(F.col("doc_id")), [F.col(c) for c in ("doc_id", "size", "_crc", *more)],
        {"before": F.col("size")}, n_rows,
    )
    t = targets.select(F.col("source").alias("_s"), "source_size", "target", "class")
    rows = ordered.join(t, F.col("source").eqNullSafe(F.col("_s")), "left")
    want = F.round("target").cast("long")
    taken, copies = F.lit(0).cast("long"), F.lit(0)
    for j in range(max_epochs):
        part = F.greatest(F.least(want - F.col("source_size") * j - F.col("before"), F.col("size")), F.lit(0))
        taken = taken + part
        copies = copies + (part > 0).cast("int")
    rows = rows.withColumn("taken", taken.cast("long")).withColumn("copies", copies.cast("int"))
    rows = rows.withColumn("position", position_of(F.lit(0), schedules))
    return rows.drop("_s")


def curriculum(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken,
    copies and position, sorted by position over ranges.

    A source's documents follow one another in an order fixed by a hash of
    the id (ties: size, checksum of the text), again and again, until the
    source's target is reached; the copy that crosses it is cut there, so
    that the words taken from a source are its target, rounded.  ``copies``
    counts the copies taken, the cut one included; ``position`` is the time
    at which the middle of the first copy is due.  Null ids are ordered like
    any value, null sources are one source after all others, documents
    without words take nothing (null position) and repeated rows count as
    rows.  Further columns of ``docs`` are not looked at.
    """
    rows = _plan(docs, id_col, text_col, source_col, weights, schedules, max_epochs)
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "taken", "copies", "position")
    order = [F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def position_of(copy: Column, schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES) -> Column:
    """Time at which copy number ``copy`` of a row of :func:`curriculum` is
    due; null if it isn't taken."""
    start = F.col("source_size") * copy + F.col("before")
    want = F.round("target").cast("long")
    part = F.least(want - start, F.col("size"))
    share = (start.cast("double") + part / F.lit(2.0)) / want
    out = None
    for i, knots in enumerate(schedules):
        here = due_time(share, knots)
        out = F.when(F.pmod("class", F.lit(len(schedules))) == i, here) if out is None else out.when(
            F.pmod("class", F.lit(len(schedules))) == i, here
        )
    return F.when(part > 0, out)


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """The training sequence: a row of ``docs`` for each copy taken, sorted
    by the time it is due.  The one copy of a source that its target cuts has
    only the words taken of it; cases as in :func:`curriculum`.

    The plan is made from narrow rows: these are sorted by time over ranges,
    and a range holds of each copy of a source one stretch of its documents'
    order.  The stretches (sources x copies x ranges rows at most) tell every
    text its ranges, so a text is dealt out once for each copy, and the
    running sum goes on inside the range from the stretch's own beginning.
    """
    spark = docs.sparkSession
    place = _place(docs)
    if place is None:
        docs = keep(docs, "documents")
        place = _place(docs)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(0, (ranges - 1).bit_length())
    names = ["_doc", "size", "_crc", *[f"_p{i}" for i in range(len(place))]]

    def keyed(rows: DataFrame) -> DataFrame:
        # a null id is ordered first, as the running sum does
        rows = rows.withColumn("_doc", F.struct(F.col("doc_id").isNotNull(), F.coalesce("doc_id", F.lit(0))))
        return rows.withColumn("_k", F.struct(_key(F.col("doc_id")).alias("h"), *[F.col(n) for n in names])).drop("_doc")

    plan = _plan(docs, id_col, text_col, source_col, weights, schedules, max_epochs, place).where("copies > 0")
    plan = keyed(plan).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    plan = plan.withColumn("_due", position_of(F.col("_copy"), schedules))
    plan = plan.repartitionByRange(ranges, "_due", "source", "_copy", "_k").withColumn("_part", F.spark_partition_id())
    plan = keep(plan.select("source", "_copy", "_k", "before", "source_size", "target", "class", "_part"), "plan")
    at = plan.groupBy(F.col("source").alias("_s"), "_copy", "_part").agg(
        F.min("_k").alias("_lo"), F.max("_k").alias("_hi"), F.min("before").alias("_from"),
        *[F.first(c).alias(c) for c in ("source_size", "target", "class")],
    )

    def bucket(key: Column) -> Column:
        return F.shiftright(key["h"], 31 - bits).cast("int")

    at = keep(at.withColumn("_b", F.explode(F.sequence(bucket(F.col("_lo")), bucket(F.col("_hi"))))), "stretches")
    release(plan)
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("_crc"), *[c.alias(f"_p{i}") for i, c in enumerate(place)],
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    rows = keyed(rows.where("size > 0")).withColumn("_kb", bucket(F.col("_k")))
    rows = rows.join(
        at, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_kb") == F.col("_b")) & F.col("_k").between(F.col("_lo"), F.col("_hi"))
    )
    rows = rows.select("doc_id", "source", "size", "_k", "_row", "_copy", "_part", "_from", "source_size", "target", "class")
    rows = rows.repartitionById(ranges, "_part")
    inside = Window.partitionBy("_part", "source", "_copy").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.col("_from") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    want = F.round("target").cast("long")
    rows = rows.withColumn("_taken", F.least(want - F.col("source_size") * F.col("_copy") - F.col("before"), F.col("size")))
    rows = rows.withColumn("_due", position_of(F.col("_copy"), schedules)).sortWithinPartitions("_due", "source", "_copy", "_k")
    text = F.col(f"_row.`{text_col}`").cast("string")
    # the words of the cut copy, with one space between them
    words = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), 1), F.lit(1), F.col("_taken").cast("int")), " ")
    cut = F.when(F.col("_taken") >= F.col("size"), text).otherwise(words)
    return rows.select(*[cut.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def _place(docs: DataFrame) -> list[Column] | None:
    """File and row of a table read from Parquet, None for other tables."""
    place = [F.xxhash64(F.col("_metadata.file_path")), F.col("_metadata.row_index")]
    if "_metadata" in docs.columns:
        return None
    try:
        docs.select(*place).schema  # noqa: B018 - analysed here
    except AnalysisException:
        return None
    return place
