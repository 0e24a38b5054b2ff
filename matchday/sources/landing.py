"""Landing readers for per-round CSV files and create-if-missing masters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values (layout of the marks files) --------------------------------
GRADE_COLUMNS = [
    "team", "name", "surname", "role",
    "voto", "gol", "assist", "rigore", "rig_sbagliato", "autogol",
    "ammonizione", "espulsione", "fantavoto",
]
GRADE_NUMERIC = GRADE_COLUMNS[4:]
FILE_PATTERN = r"a(\d{4})_m(\d+)\.csv"      # a<season>_m<round>.csv, a file or a folder of part files
UNKNOWN_NAME = "_unknown_"
# -----------------------------------------------------------------------------


def csv_fields(line: Column) -> Column:
    """The fields of one CSV line, as many as it has: unquoted ones trimmed
    of nothing, quoted ones without their quotes, empty ones NULL."""
    parts = F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')

    def value(x: Column) -> Column:
        quoted = F.regexp_extract(x, r'(?s)^\s*"(.*)"\s*$', 1)
        plain = F.when(x.rlike(r'(?s)^\s*".*"\s*$'), F.regexp_replace(quoted, '""', '"')).otherwise(x)
        return F.when(plain != "", plain)

    return F.transform(parts, value)


def _lines(spark: SparkSession, path: str, header_key: str) -> DataFrame:
    """(_file, _v, _is_header): the fields of every line that isn't blank."""
    raw = spark.read.text(path).filter(F.trim("value") != "")
    line = F.regexp_replace("value", "^\ufeff|\r$", "")
    rows = raw.select(F.col("_metadata.file_path").alias("_file"), csv_fields(line).alias("_v"))
    # array_contains is NULL (not false) when the array holds NULLs
    return rows.withColumn("_is_header", F.coalesce(F.array_contains(F.col("_v"), header_key), F.lit(False)))


def headerless_files(spark: SparkSession, path: str, header_key: str = "surname") -> DataFrame:
    """(file, n_rows) of the files of a folder that :func:`read_round_csvs`
    can't read, as no row of theirs names the columns."""
    lines = _lines(spark, path, header_key)
    each = lines.groupBy(F.col("_file").alias("file")).agg(F.max("_is_header").alias("_h"), F.count("*").alias("n_rows"))
    return each.where(~F.col("_h")).select("file", "n_rows")


def read_round_csvs(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = GRADE_COLUMNS,
    numeric: Sequence[str] = GRADE_NUMERIC,
    header_key: str = "surname",
    fail: bool = False,
) -> DataFrame:
    """Read a directory of per-round CSV files whose headers may differ
    (some files carry a leading unnamed index column).

    A single CSV read would map every file by the FIRST file's column
    positions and silently shift values.  Instead each line is split into
    its fields (any number of them; quoted fields may hold commas), the
    file's own header row (the row holding ``header_key``) is kept in a
    one-row-per-file table, and every data row takes each column from the
    position its file's header gives.  No per-file loop on the
    driver; the header table has one row per file.  ``season`` and
    ``match`` come from the file name ``a<season>_m<round>.csv``.

    Files without a header row give no rows (:func:`headerless_files` names
    them); with ``fail`` they raise an error.
    """
    if fail and (bad := headerless_files(spark, path, header_key).orderBy("file").take(5)):
        raise ValueError(f"no row with {header_key!r} in {[r['file'] for r in bad]}")
    rows = _lines(spark, path, header_key)
    headers = rows.filter("_is_header").select("_file", F.col("_v").alias("_h"))
    data = rows.filter("not _is_header").join(headers, "_file")
    out = []
    for c in columns:
        pos = F.array_position(F.col("_h"), c).cast("int")
        v = F.when(pos > 0, F.get(F.col("_v"), pos - 1))
        out.append((v.try_cast("double") if c in numeric else v).alias(c))
    fname = F.col("_file")
    res = data.select(
        *out,
        F.regexp_extract(fname, FILE_PATTERN, 1).cast("int").alias("season"),
        F.regexp_extract(fname, FILE_PATTERN, 2).cast("int").alias("match"),
    )
    return res.withColumn("name", F.coalesce(F.col("name"), F.lit(UNKNOWN_NAME)))


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Load a master table, or an empty frame with ``schema`` when it does
    not exist yet (first run)."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except Exception as e:  # noqa: BLE001 - missing path
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise
