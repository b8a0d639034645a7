"""Newly arrived JSON log files, each file once: to a Parquet log, or to per-user state.

Meant for a scheduled run: it takes what is new, commits, and ends.  Lines that do not
fit the log go to a quarantine folder with the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.plans.incremental import add_batch
from stayline.schemas import TRIGGER_PAGES
from stayline.sources.tables import (
    LINE,
    MissingInput,
    bad_lines,
    checked_schema,
    read_parsed_log,
    read_quarantine,
    sound_lines,
    with_reason,
)
from stayline.staging import run, stage

FILES_PER_DAY = 8


def _new_lines(spark: SparkSession, source: str) -> DataFrame:
    reader = spark.readStream.schema(checked_schema()).option("columnNameOfCorruptRecord", LINE)
    return with_reason(reader.json(source))


def ingest_new_logs(
    spark: SparkSession, source: str, target: str, state: str, quarantine: str | None = None
) -> int:
    """Parse new files under ``source`` into ``target``; return the rows added.

    ``state`` is the query's checkpoint folder on shared storage; a run that is
    lost half-way is repeated without duplicates.  ``target`` is partitioned by
    day, so a featurize run over a date range reads only its days; a day's events
    meet in a few tasks first, so a day is a few files.  Broken lines go to
    ``quarantine``, a folder beside the checkpoint if none is given, by a query of
    their own, so that they too are written exactly once.
    """
    before = _rows(spark, target)
    sound = (
        sound_lines(_new_lines(spark, source))
        .withColumn("day", F.to_date("ts"))
        .repartition(F.col("day"), F.pmod(F.col("tie"), F.lit(FILES_PER_DAY)))
        .writeStream.format("parquet")
        .partitionBy("day")
        .option("path", target)
        .option("checkpointLocation", state)
    )
    broken = (
        bad_lines(_new_lines(spark, source))
        .writeStream.format("parquet")
        .option("path", quarantine or f"{state}-quarantine")
        .option("checkpointLocation", f"{state}-broken")
    )
    for query in [part.trigger(availableNow=True).start() for part in (sound, broken)]:
        query.awaitTermination()
    return _rows(spark, target) - before


def quarantined(spark: SparkSession, state: str, quarantine: str | None = None) -> DataFrame:
    """(reason, line) of all lines that runs with this ``state`` kept out."""
    return read_quarantine(spark, quarantine or f"{state}-quarantine")


def ingest_state(
    spark: SparkSession, source: str, store: str, state: str, triggers: Sequence[str] = TRIGGER_PAGES
) -> list[str]:
    """Add the events of new files under ``source`` to a store of per-user state; return the batches added.

    A batch is named after the checkpoint and its number, so one that is run again after a
    loss replaces itself.  Its broken lines lie in ``<store>/quarantine/batch=<name>``.
    """
    added: list[str] = []
    folder = state.rstrip("/").rsplit("/", 1)[-1]

    def take(lines: DataFrame, number: int) -> None:
        name = f"{folder}-{number}"
        with run(lines.sparkSession):
            checked = stage(lines)
            bad_lines(checked).write.mode("overwrite").parquet(f"{store}/quarantine/batch={name}")
            if add_batch(sound_lines(checked), store, name, triggers):
                added.append(name)

    _new_lines(spark, source).writeStream.foreachBatch(take).option("checkpointLocation", state).trigger(
        availableNow=True
    ).start().awaitTermination()
    return added


def _rows(spark: SparkSession, target: str) -> int:
    """Rows of the log, from its file footers; progress reports keep the last batches only."""
    try:
        return read_parsed_log(spark, target).count()
    except MissingInput:
        return 0
