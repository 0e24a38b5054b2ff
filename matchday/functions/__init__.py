"""Column-level helpers built only from ``pyspark.sql.functions``."""

from matchday.functions.bins import (
    BIN_EDGES,
    CLASS_WEIGHTS,
    bin_label,
    bin_table,
)
from matchday.functions.names import feature_name, feature_name_col, split_person_name
from matchday.functions.text import clean_cell, percent_to_double, split_score
from matchday.functions.timez import to_local, unix_seconds, plus_days

__all__ = [
    "BIN_EDGES",
    "CLASS_WEIGHTS",
    "bin_label",
    "bin_table",
    "feature_name",
    "feature_name_col",
    "split_person_name",
    "clean_cell",
    "percent_to_double",
    "split_score",
    "to_local",
    "unix_seconds",
    "plus_days",
]
