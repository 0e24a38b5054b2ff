"""Incremental landing with Structured Streaming.

The reference rescans its landing folder on every run and appends to a
master.  Here the file source finds the files that are new, and each
micro-batch is written by ``foreachBatch`` to its own folder of the table's
rows: Parquet partitioned by batch, overwritten when a batch is replayed, so a
restart after the loss of an executor or of the driver leaves the same table.
The state is an aggregate on read.  Nothing is dropped for being late.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.session import spread

#: JSON keeps milliseconds unless told otherwise
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop repeated rows of the same key that arrive within ``delay`` of
    event time.  The state is bounded by the watermark, and rows later than
    it are dropped: for streams whose lateness has a known bound only."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order`` (map-side partial ``max_by``)."""
    others = [c for c in df.columns if c not in set(keys)]
    packed = F.struct(*[F.col(c) for c in others])
    by = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.max_by(packed, by).alias("_v")).select(*keys, "_v.*")


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows of one micro-batch, in a folder of their own."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")


def landed_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows written so far, with the ``batch`` that brought them."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    try:
        return spark.read.schema(full).parquet(path)
    except Exception as e:  # noqa: BLE001 - before the first batch
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], full)
        raise


def current_state(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The latest row per key; ties in ``order`` go to the newest batch."""
    return latest_per_key(landed_rows(spark, path, schema), keys, [*order, "batch"]).select(*schema.names)


def amended_state(
    spark: SparkSession, path: str, schema: T.StructType, rules: Sequence[Callable[[DataFrame], DataFrame]],
    keys: Sequence[str] = (),
) -> DataFrame:
    """All different rows ever landed, after the cleaning ``rules`` (stale
    statuses, amended statistics, ...).  Rows are dealt by ``keys`` (all
    columns, if none are named): rules that go by them shuffle no more."""
    rows = landed_rows(spark, path, schema).select(*schema.names)
    out = spread(rows, *(keys or schema.names)).distinct()
    for rule in rules:
        out = rule(out)
    return out


def run_stream(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    schema: T.StructType,
    each_batch: Callable[[DataFrame, int], None],
    fmt: str = "json",
    max_files: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Process every file that landed since the last run with the same
    ``checkpoint`` (``availableNow``), in micro-batches of ``max_files``
    files if it is given; ``transform`` is applied to the stream itself."""
    reader = spark.readStream.schema(schema).format(fmt).options(**(JSON_OPTIONS if fmt == "json" else {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(landing)
    query = (
        (stream if transform is None else transform(stream)).writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def ingest_stream(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    schema: T.StructType,
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    fmt: str = "json",
    max_files: int | None = None,
) -> None:
    """Land new files in ``table``.  With ``keys`` a batch writes only its
    latest row per key, otherwise its distinct rows: repeated deliveries
    disappear here or on read, whenever they arrive."""

    def _batch(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, keys, order).select(*schema.names) if keys else batch.distinct()
        write_batch(rows, table, batch_id)

    run_stream(spark, landing, checkpoint, schema, _batch, fmt, max_files)


def dedup_ingest(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    schema: T.StructType,
    keys: Sequence[str],
    ts: str,
    delay: str,
    fmt: str = "json",
    max_files: int | None = None,
) -> None:
    """Land new files without the repeats that come within ``delay`` of a
    key's first event time (:func:`dedup_stream`).  The keys seen are state
    that outlives a restart with the same ``checkpoint`` and is evicted by the
    watermark; a batch that is run again overwrites its own folder."""
    run_stream(
        spark, landing, checkpoint, schema, lambda batch, i: write_batch(batch, table, i), fmt, max_files,
        lambda stream: dedup_stream(stream, keys, ts, delay),
    )


def land_by_day(df: DataFrame, ts: str, path: str, fmt: str = "json") -> None:
    """Write ``df`` as one landing folder per event day (a replayable
    stand-in for files arriving over time)."""
    writer = df.withColumn("_day", F.to_date(F.col(ts))).write.mode("overwrite").partitionBy("_day")
    writer.options(**(JSON_OPTIONS if fmt == "json" else {})).format(fmt).save(path)


def refresh_for_touched(history: DataFrame, touched: DataFrame, entity: Sequence[str], compute) -> DataFrame:
    """``compute(history)`` restricted to the entities in ``touched``.

    Exact for per-entity computations (windows partitioned by the entity):
    an entity's features depend only on its own rows, so only entities a
    batch touched can change.  The history is cut by a left-semi join on the
    (batch-sized) touched key set."""
    keys = list(entity)
    return compute(history.join(touched.select(*keys).distinct(), keys, "left_semi"))


def ingest_with_features(
    spark: SparkSession,
    landing: str,
    table: str,
    features: str,
    checkpoint: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    entity: Sequence[str],
    compute,
    feature_schema: T.StructType,
    fmt: str = "json",
    max_files: int | None = None,
) -> None:
    """Landing stream that keeps a table and a derived feature table up to
    date: each batch is written, then the features of the entities it
    touched are recomputed from their own history and written as the same
    batch of ``features`` (read it with :func:`current_state`)."""

    def _batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(latest_per_key(batch, keys, order).select(*schema.names), table, batch_id)
        touched = batch.select(*entity).distinct()
        # only the touched entities' rows enter the merge
        rows = landed_rows(spark, table, schema).join(touched, list(entity), "left_semi")
        history = latest_per_key(rows, keys, [*order, "batch"]).select(*schema.names)
        write_batch(compute(history).select(*feature_schema.names), features, batch_id)

    run_stream(spark, landing, checkpoint, schema, _batch, fmt, max_files)
