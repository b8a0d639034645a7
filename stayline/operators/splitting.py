"""Stratified splits, folds and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.functions import hash_bucket
from stayline.staging import stage

SEED = 42
BUCKET_DIGITS = 4  # 65,536 buckets of the leading md5 digits


def _row_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))


def smallest_by_hash(
    df: DataFrame, key: str, wanted: Column, by: str | None = None, seed: int = SEED
) -> DataFrame:
    """Add ``_chosen``: true for exactly ``wanted`` rows per class, in md5 order.

    ``by`` is a label of any classes; ``wanted`` may use ``n``, the size of the
    class; ``key`` is unique.  Rows are counted per leading hash digits first.  Only the bucket
    in which the wanted number is reached is ranked row by row, about one row in
    65,536 of a class.
    """
    label = by or "_all"
    hashed = df.withColumn("_hash", _row_hash(key, seed)).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )
    if by is None:
        hashed = hashed.withColumn(label, F.lit(0))
    counts = hashed.groupBy(label, "_bucket").agg(F.count("*").alias("_n"))
    within = W.partitionBy(label).orderBy("_bucket")
    cumulative = counts.withColumns(
        {
            "_upto": F.sum("_n").over(within.rowsBetween(W.unboundedPreceding, W.currentRow)),
            "n": F.sum("_n").over(within.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        }
    ).withColumn("_wanted", wanted)
    edge = (
        cumulative.where((F.col("_upto") >= F.col("_wanted")) & (F.col("_wanted") > 0))
        .groupBy(label)
        .agg(
            F.min("_bucket").alias("_edge"),
            F.min_by(F.col("_wanted") - F.col("_upto") + F.col("_n"), "_bucket").alias("_rest"),
        )
    )
    edge = stage(edge.withColumnRenamed(label, "_class"))
    joined = hashed.join(edge, F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")
    in_edge = F.col("_bucket") == F.col("_edge")
    # Rows off the edge bucket need no rank, so they are kept out of the window.
    rank = F.row_number().over(W.partitionBy(label, "_bucket").orderBy("_hash", key))
    edge_rows = joined.where(in_edge).withColumn("_chosen", rank <= F.col("_rest"))
    other_rows = joined.where(F.coalesce(~in_edge, F.lit(True))).withColumn(
        "_chosen", F.coalesce(F.col("_bucket") < F.col("_edge"), F.lit(False))
    )
    chosen = edge_rows.unionByName(other_rows).drop("_hash", "_bucket", "_edge", "_rest")
    return chosen if by else chosen.drop(label)


def stratified_split(
    df: DataFrame,
    label: str = "churn",
    key: str = "userId",
    test_share: float = 0.2,
    seed: int = SEED,
) -> DataFrame:
    """Add ``is_test``: exactly round(test_share * n) rows of each class."""
    wanted = F.round(F.lit(test_share) * F.col("n")).cast("bigint")
    return smallest_by_hash(df, key, wanted, label, seed).withColumnRenamed("_chosen", "is_test")


def with_folds(df: DataFrame, key: str = "userId", folds: int = 8, seed: int = SEED) -> DataFrame:
    """Add ``fold``, a stable number 0..folds-1 per key."""
    return df.withColumn("fold", hash_bucket(key, f"-fold-{seed}", folds).cast("int"))


def class_weights(df: DataFrame, label: str = "churn") -> DataFrame:
    """Balanced weight per class: n / (classes * n_class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_class"))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return counts.select(
        label,
        "n_class",
        (
            F.sum("n_class").over(everything)
            / (F.count("*").over(everything) * F.col("n_class"))
        ).alias("weight"),
    )


def class_balance(df: DataFrame, label: str = "churn") -> DataFrame:
    """Counts of both classes and their ratio, the weight of a positive row."""
    counted = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    )
    return counted.withColumn("scale_pos_weight", F.try_divide("negatives", "positives"))


def with_balanced_weight(df: DataFrame, label: str = "churn", to: str = "weight") -> DataFrame:
    """Add the balanced class weight to every row (two classes)."""
    counts = df.agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("p"))
    negative = counts.select(F.try_divide(F.col("n"), 2 * (F.col("n") - F.col("p")))).scalar()
    positive = counts.select(F.try_divide(F.col("n"), 2 * F.col("p"))).scalar()
    return df.withColumn(to, F.when(F.col(label) == 1, positive).otherwise(negative))


def with_positive_weight(df: DataFrame, label: str = "churn", to: str = "weight") -> DataFrame:
    """Add the weight negatives / positives to positive rows, 1 to the others."""
    ratio = class_balance(df, label).select("scale_pos_weight").scalar()
    return df.withColumn(to, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))
