"""Scored history: append, and read per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_scores(scored: DataFrame, path: str, day: str) -> None:
    """Put one day's scores into a history table partitioned by day; a rerun replaces the day."""
    dated = scored.withColumn("day", F.lit(day).cast("date"))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append metric records (run_id, metric, value) with the time of recording."""
    dated = metrics.withColumn("recorded_at", F.current_timestamp())
    dated.coalesce(1).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    schema = "run_id STRING, metric STRING, value DOUBLE, recorded_at TIMESTAMP"
    return spark.read.schema(schema).parquet(path)


def append_parameters(spark: SparkSession, run_id: str, parameters: dict[str, object], path: str) -> None:
    """Append a run's parameters (run_id, name, value), so that two runs can be told apart."""
    rows = [(run_id, name, str(value)) for name, value in sorted(parameters.items())]
    frame = spark.createDataFrame(rows, "run_id STRING, name STRING, value STRING")
    frame.withColumn("recorded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)
