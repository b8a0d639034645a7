"""Exploratory summaries: counts, frequencies, medians, histograms, box plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions import code_label, floor_days, safe_ratio
from stayline.operators.ranking import column_quantiles, counted_values, exact_quantiles
from stayline.operators.splitting import smallest_by_hash
from stayline.operators.users import known_users
from stayline.schemas import CANCELLATION, PLAY_PAGE
from stayline.staging import stage

STATUS = {0: "Active", 1: "Churned"}


def log_time_range(log: DataFrame) -> DataFrame:
    ends = log.agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))
    return ends.withColumn("span_days", floor_days("min_ts", "max_ts"))


def table_profile(df: DataFrame) -> DataFrame:
    """Rows, non-null rows and type of each column, from one scan."""
    counts = [F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    one_row = df.agg(F.count("*").alias("_rows"), *counts)
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return one_row.unpivot("_rows", df.columns, "column", "non_null").select(
        "column", types[F.col("column")].alias("type"), F.col("_rows").alias("rows"), "non_null"
    )


def preview(log: DataFrame, rows: int = 5, order: Sequence[str] = ("ts", "tie")) -> DataFrame:
    return log.orderBy(*order).limit(rows)


def frequency(df: DataFrame, col: str) -> DataFrame:
    """Rows per value and their share of the sum of these counts."""
    counted = df.groupBy(col).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("share", safe_ratio("n", total))


def distinct_pages(log: DataFrame) -> DataFrame:
    return log.select("page").distinct().orderBy("page")


def pages_containing(log: DataFrame, text: str) -> DataFrame:
    """Distinct pages whose name contains ``text``, whatever the case."""
    return log.select("page").distinct().where(F.lower("page").contains(text.lower()))


def auth_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("auth").agg(F.count("*").alias("n"))


def churn_distribution(labels: DataFrame) -> DataFrame:
    """Users per class with the class's display label and share."""
    return frequency(labels, "churn").withColumn("status", code_label("churn", STATUS))


def churn_rate(labels: DataFrame) -> DataFrame:
    return labels.agg(F.coalesce(F.avg("churn"), F.lit(0.0)).alias("churn_rate"))


def songs_by_cohort(log: DataFrame, churn_page: str = CANCELLATION) -> DataFrame:
    """Plays of each user that has any, with the explicit label.

    Plays and label come from the same events, so one aggregate replaces the
    inner join of two.
    """
    per_user = (
        known_users(log)
        .groupBy("userId")
        .agg(
            F.count_if(F.col("page") == PLAY_PAGE).alias("song_count"),
            F.coalesce(F.max((F.col("page") == churn_page).cast("int")), F.lit(0)).alias("churn"),
        )
    )
    return per_user.where(F.col("song_count") > 0)


def cohort_medians(users: DataFrame, cols: Sequence[str], cohort: str = "churn") -> DataFrame:
    """Exact median of each column per cohort."""
    long = column_quantiles(users, cols, {"median": 0.5}, [cohort])
    wide = [F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"median_{c}") for c in cols]
    return long.groupBy(cohort).agg(*wide)


def counts_by(users: DataFrame, *cols: str) -> DataFrame:
    return users.groupBy(*cols).agg(F.count("*").alias("n"))


def gender_by_churn(log: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct (user, gender) rows counted per gender and class.

    A label belongs to a user, so events are made distinct before the join.
    """
    distinct = known_users(log).select("userId", "gender").dropDuplicates()
    return counts_by(distinct.join(labels.select("userId", "churn"), "userId"), "gender", "churn")


def histogram(
    df: DataFrame, col: str, width: float, by: Sequence[str] = (), start: float = 0.0
) -> DataFrame:
    """Rows per bin of equal width, per group."""
    bin_number = F.floor((F.col(col) - F.lit(start)) / F.lit(width))
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(*by, bin_number.alias("bin"))
        .agg(F.count("*").alias("n"))
        .withColumns(
            {"bin_from": F.lit(start) + F.col("bin") * F.lit(width)}
        )
    )


def boxplot(df: DataFrame, col: str, cohort: str = "churn") -> DataFrame:
    """Quartiles, whiskers at the last values inside 1.5 IQR, rows outside, per cohort."""
    quartiles = exact_quantiles(df, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [cohort])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fences = quartiles.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})
    fences = stage(fences.withColumnRenamed(cohort, "_cohort"))
    # Count equal values first: what is joined is one row per cohort and value.
    counted = counted_values(df, [col], [cohort])
    inside = F.col("_value").between(F.col("_low"), F.col("_high"))
    return (
        counted.join(fences, F.col(cohort).eqNullSafe(F.col("_cohort")))
        .groupBy(cohort, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_value"))).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("_n"))).alias("outliers"),
        )
    )


def scatter_points(users: DataFrame, x: str, y: str, cohort: str = "churn") -> DataFrame:
    """Distinct points per cohort with the number of users on each."""
    return users.groupBy(x, y, cohort).agg(F.count("*").alias("n"))


def scatter_sample(users: DataFrame, most: int = 1_000, cohort: str = "churn", key: str = "userId") -> DataFrame:
    """Rows to draw: exactly ``most`` of every cohort, or all if it has fewer, by a hash of the key.

    The same users are drawn each time, and a larger sample holds the smaller one.
    """
    wanted = F.least(F.col("n"), F.lit(most)).cast("bigint")
    return smallest_by_hash(users, key, wanted, cohort).where("_chosen").select(*users.columns)


def useless_features(df: DataFrame, features: Sequence[str], key: str = "userId") -> DataFrame:
    """Features that are constant, and features equal to an earlier one.

    One scan takes min, max and two fingerprints of each column against the row
    key; columns that agree on all four are then compared value by value in a
    second scan.
    """
    value = {f: F.col(f"`{f}`").cast("double") for f in features}
    first = []
    for i, f in enumerate(features):
        mark = F.xxhash64(F.col(key), F.coalesce(value[f], F.lit(float("nan"))))
        first += [
            F.min(value[f]).alias(f"min_{i}"),
            F.max(value[f]).alias(f"max_{i}"),
            F.count(value[f]).alias(f"n_{i}"),
            F.bit_xor(mark).alias(f"xor_{i}"),
            F.sum(F.shiftright(mark, 40)).alias(f"sum_{i}"),
        ]
    row = df.agg(F.count("*").alias("rows"), *first).collect()[0].asDict()
    prints = [tuple(row[f"{p}_{i}"] for p in ("min", "max", "n", "xor", "sum")) for i in range(len(features))]
    twins = [
        (i, j) for j in range(len(features)) for i in range(j) if prints[i] == prints[j]
    ]
    differing = {}
    if twins:
        counted = df.agg(
            *[
                F.count_if(~value[features[i]].eqNullSafe(value[features[j]])).alias(f"d_{i}_{j}")
                for i, j in twins
            ]
        ).collect()[0]
        differing = {(i, j): counted[f"d_{i}_{j}"] for i, j in twins}
    rows = []
    for j, f in enumerate(features):
        low, high, present, _, _ = prints[j]
        constant = present == 0 or (present == row["rows"] and low == high)
        same = [i for i in range(j) if differing.get((i, j)) == 0]
        rows.append((f, constant, features[same[0]] if same else None))
    return df.sparkSession.createDataFrame(
        rows, "feature STRING, is_constant BOOLEAN, duplicate_of STRING"
    )
