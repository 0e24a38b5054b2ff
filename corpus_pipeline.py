"""The corpus pipeline: language, lines, near duplicates, mix, pieces.

``run`` applies STAGES to the table ``documents``; each stage's result is
written as Parquet and read again as the next one's documents.  All stages
but the last return the columns of ``documents``; a text that a stage changes
has its ``n_chars`` counted again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm import op03_pieces, op04_mix, op05_language, op07_jaccard, op10_lines
from matchday.llm.common import keep, release


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return docs.select(*columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus has (operator 5): those
    without a letter, or with hardly an n-gram known to any language, go."""
    return op05_language.in_known_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source and without long
    lines that ten different texts of the corpus contain (operator 10); no
    document goes, and one that is boilerplate all through stays whole."""
    less = op10_lines.drop_boilerplate(docs, "source", "text").select(*docs.columns)
    return _counted(op10_lines.drop_passages(less, "text"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word
    shingles (operator 7)."""
    return op07_jaccard.one_of_each(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: as many copies of each document as the target
    of its source takes, in the order of the curriculum (operator 4)."""
    return _counted(op04_mix.mixed_documents(docs), docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the sequence (operator 3)."""
    return op03_pieces.encode_documents(docs, with_ids=True)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pieces", pieces),
]

#: language identification, sentence pieces and the join's hashes have no SQL
#: form; tests/llm checks the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        after = keep(stage(spark, docs, sf_dir), name)
        release(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
