"""Classification and regression metrics as Spark aggregates.

One shuffle builds the confusion table (classes x classes rows, partial
aggregation map-side); every classification metric is derived from that
small table.  The median absolute error uses :func:`exact_quantile`, which
never gathers the whole column into one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.bins import decode_bin
from matchday.session import materialize


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """(truth, pred, n) for every observed pair."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count("*").alias("n")
    )


def counted(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """The confusion table, written: classes x classes rows that every
    metric below reads, so the table itself is read once."""
    return materialize(confusion(df, truth, pred))


def per_class(conf: DataFrame) -> DataFrame:
    """Per class: tp, support (true count), predicted count."""
    t = conf.groupBy(F.col("truth").alias("label")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"),
    )
    p = conf.groupBy(F.col("pred").alias("label")).agg(F.sum("n").alias("predicted"))
    return t.join(p, "label", "full").select(
        "label",
        F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("support", F.lit(0)).alias("support"),
        F.coalesce("predicted", F.lit(0)).alias("predicted"),
    )


def class_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """precision / recall / f1 / support per class plus accuracy, macro
    average and support-weighted average rows (zero when undefined)."""
    return report_of(counted(df, truth, pred))


def report_of(conf: DataFrame) -> DataFrame:
    """:func:`class_report` of a (written) confusion table."""
    pc = per_class(conf)
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    rows = pc.select(
        F.col("label").cast("string").alias("label"),
        prec.alias("precision"),
        rec.alias("recall"),
        "support",
        "tp",
    ).select(
        "*",
        F.when(F.col("precision") + F.col("recall") > 0,
               2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
        .otherwise(0.0).alias("f1_score"),
    )
    total = F.sum("support")
    summary = rows.agg(
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"), F.avg("f1_score").alias("m_f"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("w_p"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("w_r"),
        (F.sum(F.col("f1_score") * F.col("support")) / total).alias("w_f"),
        (F.sum("tp") / total).alias("acc"),
        total.alias("n"),
    )
    extra = summary.select(
        F.explode(F.array(
            F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1_score"),
                     F.col("n").alias("support")),
            F.struct(F.lit("macro avg").alias("label"), F.col("m_p").alias("precision"),
                     F.col("m_r").alias("recall"), F.col("m_f").alias("f1_score"),
                     F.col("n").alias("support")),
            F.struct(F.lit("weighted avg").alias("label"), F.col("w_p").alias("precision"),
                     F.col("w_r").alias("recall"), F.col("w_f").alias("f1_score"),
                     F.col("n").alias("support")),
        )).alias("_s")
    ).select("_s.*")
    return rows.select("label", "precision", "recall", "f1_score", "support").unionByName(extra)


def summary_scores(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """One row: n, accuracy, balanced accuracy (mean recall over classes
    present in the truth) and the multi-class Matthews correlation."""
    return summary_of(counted(df, truth, pred))


def summary_of(conf: DataFrame) -> DataFrame:
    """:func:`summary_scores` of a (written) confusion table."""
    pc = per_class(conf)
    agg = pc.agg(
        F.sum("support").alias("s"),
        F.sum("tp").alias("c"),
        F.sum(F.col("predicted") * F.col("support")).alias("pt"),
        F.sum(F.col("predicted") * F.col("predicted")).alias("pp"),
        F.sum(F.col("support") * F.col("support")).alias("tt"),
        F.avg(F.when(F.col("support") > 0, F.col("tp") / F.col("support"))).alias("bal"),
    )
    s, c = F.col("s").cast("double"), F.col("c").cast("double")
    num = c * s - F.col("pt")
    den = F.sqrt((s * s - F.col("pp")) * (s * s - F.col("tt")))
    return agg.select(
        F.col("s").alias("n"),
        (c / s).alias("accuracy"),
        F.col("bal").alias("balanced_accuracy"),
        F.when(den > 0, num / den).otherwise(0.0).alias("mcc"),
    )


def label_distribution(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """(label, n_true, n_pred): both series aligned on the label."""
    return distribution_of(confusion(df, truth, pred))


def distribution_of(conf: DataFrame) -> DataFrame:
    """:func:`label_distribution` of a confusion table."""
    both = conf.select(
        F.explode(F.array(
            F.struct(F.col("truth").alias("label"), F.col("n").alias("t"), F.lit(0).cast("long").alias("p")),
            F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("t"), F.col("n").alias("p")),
        )).alias("_s")
    ).select("_s.*")
    return both.groupBy("label").agg(
        F.sum("t").cast("long").alias("n_true"), F.sum("p").cast("long").alias("n_pred")
    )


def exact_quantile(df: DataFrame, col: str, q: float = 0.5, bins: int = 4096) -> float | None:
    """Exact linear-interpolated quantile of ``col`` (NULLs ignored).

    The range of the column is cut into ``bins`` equal bins; one aggregate
    counts them, and the bin that holds the wanted rank is cut again until
    it holds one value.  Every pass returns at most ``bins`` rows, whatever
    the number of rows; a bin keeps its least and greatest value, so gaps
    cost no pass.  Read ``df`` from a written table: it is scanned a few
    times.
    """
    base = df.select(F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    first = base.agg(F.count("*").alias("n"), F.min("_x").alias("a"), F.max("_x").alias("b")).first()
    n = first["n"]
    if n == 0:
        return None
    pos = q * (n - 1)
    rank = math.floor(pos)
    lo, hi, below = first["a"], first["b"], 0
    while lo < hi:
        width = (hi - lo) / bins
        x = F.col("_x")
        at = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else (x > F.lit(lo)).cast("long")
        got = base.filter(x.between(lo, hi)).groupBy(at.alias("_b")).agg(
            F.count("*").alias("n"), F.min("_x").alias("a"), F.max("_x").alias("b")
        ).collect()
        for r in sorted(got, key=lambda r: r["_b"]):
            if below + r["n"] > rank:
                break
            below += r["n"]
        lo, hi, inside = r["a"], r["b"], r["n"]
    count = n if first["a"] == first["b"] else inside
    if pos == rank or below + count > rank + 1:  # the next rank has the same value, or none is needed
        return lo
    above = base.filter(F.col("_x") > lo).agg(F.min("_x").alias("a")).first()["a"]
    return lo + (above - lo) * (pos - rank)


def regression_scores(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """One row: n, mse, explained variance and median absolute error."""
    e = (F.col(truth) - F.col(pred)).alias("_e")
    base = df.select(F.col(truth).alias("_y"), e).filter(
        F.col("_y").isNotNull() & F.col("_e").isNotNull()
    )
    base = materialize(base)  # two columns, scanned a few times
    med = exact_quantile(base.select(F.abs("_e").alias("_a")), "_a", 0.5)
    return base.agg(
        F.count("*").alias("n"),
        F.avg(F.col("_e") * F.col("_e")).alias("mse"),
        (1 - F.var_pop("_e") / F.var_pop("_y")).alias("explained_variance"),
    ).select("n", "mse", "explained_variance", F.lit(med).cast("double").alias("median_abs_error"))


def prediction_metrics(preds: DataFrame, split: str, truth: str, pred: str) -> DataFrame:
    """(split, kind, label, measure, value): :func:`class_report`,
    :func:`summary_scores` and :func:`label_distribution` of the predictions
    of each split, the distribution with the classes' bin labels.  The
    predictions are read once, for one table of (split, truth, prediction)
    counts."""
    both = preds.groupBy(
        F.col(split).alias("split"), F.col(truth).cast("int").alias("truth"), F.col(pred).cast("int").alias("pred")
    ).agg(F.count("*").alias("n"))
    both = materialize(both)  # splits x classes x classes rows
    out = None
    for name in ("train", "test"):
        conf = both.where(F.col("split") == name).drop("split")
        decoded = distribution_of(conf).withColumn("label", decode_bin(F.col("label")))
        for kind, df in (("class", report_of(conf)), ("summary", summary_of(conf)), ("distribution", decoded)):
            key = df.columns[0] if kind != "summary" else None
            values = [c for c in df.columns if c != key]
            stacked = F.explode(F.array(*[
                F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in values
            ]))
            label = F.col(key).cast("string") if key else F.lit(None).cast("string")
            df = df.select(F.lit(name).alias("split"), F.lit(kind).alias("kind"), label.alias("label"), stacked.alias("m"))
            df = df.select("split", "kind", "label", "m.measure", "m.value")
            out = df if out is None else out.unionByName(df)
    return out
