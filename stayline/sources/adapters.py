"""Test tables presented as activity logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.schemas import ACTIVITY_LOG

# Agents of the common desktop and mobile families.
AGENTS = (
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0.1985.125 Safari/537.36",
    "Mozilla/5.0 (Windows NT 6.1; WOW64; rv:31.0) Gecko/20100101 Firefox/31.0",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:31.0) Gecko/20100101 Firefox/31.0",
    "Mozilla/5.0 (Windows NT 6.3; WOW64; Trident/7.0; rv:11.0) like Gecko",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2 like Mac OS X) AppleWebKit/537.51.2 (KHTML, like Gecko) Version/7.0 Mobile/11D257 Safari/9537.53",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _typed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ACTIVITY_LOG.fields])


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as an activity log (30 days, five event types)."""
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id")
    kind = F.col("event_type")
    on_view = lambda value: F.when(kind == "view", value)
    agent = (
        F.when((user % 5 == 0) & (k % 4 == 1), F.lit(AGENTS[4]))
        .when(k % 3 == 0, F.lit(None).cast("string"))
        .when(user % 4 == 0, F.lit(AGENTS[0]))
        .when(user % 4 == 1, F.lit(AGENTS[1]))
        .when(user % 4 == 2, F.lit(AGENTS[2]))
        .otherwise(F.lit(AGENTS[3]))
    )
    page = (
        F.when(kind == "view", "NextSong")
        .when(kind == "click", "Thumbs Up")
        .when(kind == "purchase", "Add Friend")
        .when(kind == "signup", "Home")
        .when(k >= 95, "Submit Downgrade")
        .when(k == 94, "Cancellation Confirmation")
        .when(k < 5, "Thumbs Down")
        .otherwise("Error")
    )
    start = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")
    return _typed(
        table(spark, sf_dir, "events").select(
            user.alias("userId"),
            "ts",
            F.col("event_id").alias("tie"),
            F.when(k.between(40, 44), "Logged Out").otherwise("Logged In").alias("auth"),
            page.alias("page"),
            F.dayofmonth("ts").cast("bigint").alias("sessionId"),
            on_view(F.concat(F.lit("song_"), k)).alias("song"),
            on_view(F.concat(F.lit("artist_"), k % 20)).alias("artist"),
            on_view(F.col("value")).alias("length"),
            F.when(k % 10 == 3, F.lit(None).cast("string"))
            .when(k % 2 == 1, "paid")
            .otherwise("free")
            .alias("level"),
            F.when((k % 10 == 0) & (user % 29 != 7), F.when(user % 2 == 0, "F").otherwise("M")).alias("gender"),
            F.when(k % 7 == 0, F.concat(F.lit("city_"), user % 13)).alias("location"),
            F.when(k % 5 == 0, F.concat(F.lit("f_"), user)).alias("firstName"),
            F.concat(F.lit("l_"), user).alias("lastName"),
            agent.alias("userAgent"),
            F.when(k % 6 != 0, F.timestamp_add("DAY", -(user % 400), start)).alias("registration"),
        )
    )


def commerce_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as an activity log: long horizon, real inactivity.

    One event per order line, at the order's date; a returned line is a
    thumbs-down.  Events of one order are equal in ``ts`` and ``tie``, so
    order-dependent results read order-level columns only.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    since = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("registration"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag"
    )
    flag = F.col("l_returnflag")
    return _typed(
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(since, "o_custkey")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("userId"),
            F.col("o_orderdate").alias("ts"),
            F.col("o_orderkey").alias("tie"),
            F.lit("Logged In").alias("auth"),
            F.when(flag == "R", "Thumbs Down")
            .when(flag == "A", "Thumbs Up")
            .otherwise("NextSong")
            .alias("page"),
            F.col("o_orderkey").alias("sessionId"),
            F.col("p_name").alias("song"),
            F.col("p_brand").alias("artist"),
            F.col("l_quantity").alias("length"),
            F.col("o_orderpriority").alias("level"),
            F.col("c_mktsegment").alias("gender"),
            F.lit("store").alias("location"),
            F.lit("first").alias("firstName"),
            F.lit("last").alias("lastName"),
            F.lit(AGENTS[0]).alias("userAgent"),
            "registration",
        )
    )
