"""How well a score ranks a 0/1 label: ROC curve, area under it, confusion matrix and the usual rates."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.ranges import with_place

# Running sums over all distinct scores are formed in this many score ranges: 10 billion distinct scores make ranges of
# about 2.5 million.
RANGES = 4096


def _score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Distinct scores with their positives and negatives; equal scores meet in the group-by."""
    rows = df.select(F.col(score).cast("double").alias("score"), F.col(label).cast("bigint").alias("label"))
    return (
        rows.filter(F.col("score").isNotNull() & ~F.isnan("score") & F.col("label").isNotNull())
        .groupBy("score")
        .agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    )


def _running(df: DataFrame, score: str, label: str, ranges: int) -> DataFrame:
    """Per distinct score, from the highest down: positives and negatives above it and in all.

    A window without partitions would put every score into one task. Scores are cut into ranges of about equal size
    by a sketch; each range is summed on its own, and the totals of the at most `ranges` ranges are added.
    """
    counts = _score_counts(df, score, label)
    shares = ", ".join(f"{i / ranges}D" for i in range(1, ranges))
    cuts = counts.agg(F.expr(f"percentile_approx(score, array({shares}), {10 * ranges})").alias("cuts")).first()["cuts"]
    splits = [-float("inf"), *sorted(set(cuts or [0.0])), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="score", outputCol="range").transform(counts)
    down = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    # at most `ranges` rows
    totals = ranged.groupBy("range").agg(F.sum("pos").alias("range_pos"), F.sum("neg").alias("range_neg"))
    higher = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("range_pos").over(higher), F.lit(0)).alias("pos_offset"),
        F.coalesce(F.sum("range_neg").over(higher), F.lit(0)).alias("neg_offset"),
        F.sum("range_pos").over(everything).alias("all_pos"),
        F.sum("range_neg").over(everything).alias("all_neg"),
    )
    return (
        ranged.withColumns({"pos_upto": F.sum("pos").over(down), "neg_upto": F.sum("neg").over(down)})
        .join(F.broadcast(offsets), "range")
        .select(
            "score",
            "pos",
            "neg",
            (F.col("pos_upto") + F.col("pos_offset")).alias("tp"),
            (F.col("neg_upto") + F.col("neg_offset")).alias("fp"),
            "all_pos",
            "all_neg",
        )
    )


def roc_auc(df: DataFrame, score: str, label: str, ranges: int = RANGES) -> DataFrame:
    """One row (auc, n_pos, n_neg): the chance that a positive scores above a negative, ties counting half.

    Counted in whole numbers, exactly.
    """
    # twice the pairs a negative loses: all positives above it and, once, those beside it
    lost = F.col("neg").cast("decimal(19,0)") * (2 * F.col("tp") - F.col("pos")).cast("decimal(19,0)")
    return (
        _running(df, score, label, ranges)
        .agg(
            F.sum(lost).cast("double").alias("lost"),
            F.max("all_pos").alias("n_pos"),
            F.max("all_neg").alias("n_neg"),
        )
        .select(
            F.try_divide(
                F.col("lost"), 2.0 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
            ).alias("auc"),
            "n_pos",
            "n_neg",
        )
    )


def roc_curve(df: DataFrame, score: str, label: str, ranges: int = RANGES) -> DataFrame:
    """(threshold, fpr, tpr), one point per distinct score, and the start (0, 0) at one above the highest."""
    points = _running(df, score, label, ranges).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.col("all_neg").cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("all_pos").cast("double")).alias("tpr"),
    )
    rated = df.select(F.col(score).cast("double").alias("score"), label).filter("not isnan(score)")
    start = rated.filter(F.col(label).isNotNull()).agg((F.max("score") + 1).alias("threshold")).filter("threshold is not null")
    return points.union(start.select(F.col("threshold").cast(points.schema["threshold"].dataType), F.lit(0.0), F.lit(0.0)))


def metrics_by(df: DataFrame, by: list[str], score: str, label: str, prediction: str, ranges: int = RANGES) -> DataFrame:
    """Per group of `by`: n, auc, precision, recall, accuracy and f1, all out of one pass over the rows.

    Rows are counted per distinct score; areas and rates follow from these counts. A group's scores are cut into ranges
    of its own, at most `ranges`, each summed up by itself, so a group of any size is no single task. Groups are few,
    as models and parts are: each has an array of cuts that goes to every task. Rows without label, score or
    prediction are left out.
    """
    rows = df.select(*by, F.col(score).cast("double").alias("score"), F.col(label).cast("bigint").alias("y"), F.col(prediction).cast("bigint").alias("p"))
    counts = (
        rows.filter(F.col("score").isNotNull() & ~F.isnan("score") & F.col("y").isNotNull() & F.col("p").isNotNull())
        .groupBy(*by, "score")
        .agg(
            F.sum("y").alias("pos"),
            F.sum(1 - F.col("y")).alias("neg"),
            F.sum(F.col("y") * F.col("p")).alias("tp"),
            F.sum((1 - F.col("y")) * F.col("p")).alias("fp"),
        )
    )
    shares = ", ".join(f"{i / ranges}D" for i in range(1, ranges))
    cuts = counts.groupBy(*by).agg(F.expr(f"percentile_approx(score, array({shares}), {10 * ranges})").alias("cuts"))
    cuts = cuts.withColumn("cuts", F.array_distinct(F.coalesce("cuts", F.array().cast("array<double>"))))
    ranged = with_place(counts.join(F.broadcast(cuts), by), "score", "cuts", "range").drop("cuts")
    down = Window.partitionBy(*by, "range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*by).orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    pos_above = 2 * F.coalesce(F.sum("pos").over(down), F.lit(0)) + F.col("pos")
    # twice the pairs that a range's negatives lose against its own positives; earlier ranges' positives beat them all
    within = (
        ranged.withColumn("lost", F.col("neg").cast("decimal(19,0)") * pos_above.cast("decimal(19,0)"))
        .groupBy(*by, "range")
        .agg(F.sum("lost").alias("lost"), *[F.sum(c).alias(c) for c in ("pos", "neg", "tp", "fp")])
    )
    earlier = F.coalesce(F.sum("pos").over(above), F.lit(0)).cast("decimal(19,0)")
    totals = (
        within.withColumn("lost", F.col("lost") + 2 * F.col("neg").cast("decimal(19,0)") * earlier)
        .groupBy(*by)
        .agg(F.sum("lost").cast("double").alias("lost"), *[F.sum(c).alias(c) for c in ("pos", "neg", "tp", "fp")])
    )
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    return totals.select(
        *by,
        (F.col("pos") + F.col("neg")).alias("n"),
        F.try_divide(F.col("lost"), 2 * pos * neg).alias("auc"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, pos).alias("recall"),
        F.try_divide(tp + neg - fp, pos + neg).alias("accuracy"),
        F.when(tp > 0, F.try_divide(2 * tp, tp + fp + pos)).alias("f1"),
    )


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n)"""
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: counts of the confusion matrix, precision, recall, accuracy and F1; null where undefined."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )

    def share(a, b):
        return F.try_divide(a.cast("double"), b.cast("double"))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        # undefined, as precision and recall are, when nothing is found
        F.when(tp > 0, share(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    )
