"""Written tables leave no shuffle files behind."""

import glob
import time

from pyspark.sql import functions as F

from matchday.llm import common


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def test_keep_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = spark.range(20_000).select((F.col("id") % 7_000).alias("k"), F.col("id").alias("v"))
    sums = rows.groupBy("k").agg(F.sum("v").alias("v"))
    conf = spark.conf.get(common._CLEAN_CONF, None)
    kept = common.keep(sums.join(rows.repartition(3, "k").select("k").distinct(), "k"))
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    left = _shuffle_files(spark) - before
    # the frame is still there (no garbage collection did it), and can be used again
    assert not left
    assert spark.conf.get(common._CLEAN_CONF, None) == conf
    assert kept.count() == 7_000 and sums.agg(F.sum("v")).first()[0] == 20_000 * 19_999 // 2
    assert common.keep(sums).count() == 7_000
    common.release(kept)
