"""matchday: Spark-native match-by-match sports analytics.

Every operator takes and returns a ``pyspark.sql.DataFrame`` and is
parameterised on key, order and value columns, so it runs on any
entity-by-event table.  Sub-packages:

* ``sources``   – landing readers (CSV rounds, JSON calendars / fixtures /
  stats, API envelopes, HTML pages) and sinks.
* ``functions`` – column-level helpers (bins, names, text cleaning, time).
* ``operators`` – relational building blocks (rolling windows, fills,
  reshapes, cleaning rules, splits, metrics, work lists).
* ``plans``     – the end-to-end jobs and the canonical test views.
* ``streaming`` – incremental landing with Structured Streaming.
* ``ml``        – training, scoring and model evaluation with pyspark.ml.
"""

from matchday.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
