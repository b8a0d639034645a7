"""Activity-log readers and feature-table readers and writers."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.functions import epoch_millis_to_ts
from stayline.schemas import ACTIVITY_LOG, RAW_LOG, SCORING_REQUEST
from stayline.staging import stage

DAY = T.StructField("day", T.DateType())


class MissingInput(FileNotFoundError):
    """The input path does not exist."""


class MalformedInput(ValueError):
    """More lines of a log are broken than the caller allows."""


def scan(reader, fmt: str, path: str) -> DataFrame:
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInput(f"input data not found at {path}") from error
        raise


def parse_log(raw: DataFrame) -> DataFrame:
    """Raw log rows to the activity-log schema.

    ``tie`` is a hash of the whole row, so events of one user that share a
    timestamp always come in the same order; rows that are equal in every column
    share it, and their order cannot matter.  A user id that is no whole number,
    such as the empty text of a visitor, is null, and so is a NaN length.
    """
    hashed = raw.withColumn("tie", F.xxhash64(*[F.col(f.name) for f in RAW_LOG.fields]))
    return hashed.withColumns(
        {
            "userId": F.col("userId").try_cast("bigint"),
            "ts": epoch_millis_to_ts("ts"),
            "registration": epoch_millis_to_ts("registration"),
            "length": F.nanvl("length", F.lit(None).cast("double")),
        }
    ).select(*ACTIVITY_LOG.fieldNames())


def json_schema() -> T.StructType:
    """The raw log's schema with the user id as text: logs write it either way."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "userId" else f.dataType) for f in RAW_LOG]
    )


#: Column that keeps a JSON line which does not fit the schema, and the last millisecond of the year 9999.
LINE = "_line"
LAST_MILLI = 253_402_300_799_999


def checked_schema() -> T.StructType:
    """The raw log's schema with room for the line itself where it does not fit."""
    return T.StructType([*json_schema().fields, T.StructField(LINE, T.StringType())])


def with_reason(raw: DataFrame) -> DataFrame:
    """Add ``reason``, null for a sound line, to rows read with ``checked_schema``.

    ``unreadable``: no JSON object; ``wrong type``: a field holds something else than
    its type; ``no time``: there is no ``ts``; ``bad time``: ``ts`` or ``registration``
    lies outside the calendar.  ``_line`` is filled for every row that has a reason.
    """
    fields = [f.name for f in RAW_LOG.fields]
    nothing = F.coalesce(*[F.col(c).cast("string") for c in fields]).isNull()
    out = lambda c: (F.col(c) < -LAST_MILLI) | (F.col(c) > LAST_MILLI)
    reason = (
        F.when(F.col(LINE).isNotNull() & nothing, "unreadable")
        .when(F.col(LINE).isNotNull(), "wrong type")
        .when(F.col("ts").isNull(), "no time")
        .when(out("ts") | out("registration"), "bad time")
    )
    told = raw.withColumn("reason", reason)
    return told.withColumn(LINE, F.when(reason.isNotNull(), F.coalesce(LINE, F.to_json(F.struct(*fields)))))


def sound_lines(checked: DataFrame) -> DataFrame:
    return parse_log(checked.where(F.col("reason").isNull()))


def bad_lines(checked: DataFrame) -> DataFrame:
    """(reason, line) of the lines that are kept out of the log."""
    return checked.where(F.col("reason").isNotNull()).select("reason", F.col(LINE).alias("line"))


def read_activity_log(
    spark: SparkSession, path: str, fmt: str = "json", quarantine: str | None = None, limit: float = 0.0
) -> DataFrame:
    """Scan a raw log (JSON lines, or Parquet/ORC with the same columns).

    JSON is parsed once, whole, and staged, so no broken line gets lost unseen: lines
    that do not fit are counted by reason, more of them than the share ``limit`` of all
    lines is an error, and fewer are appended to ``quarantine`` where it is given.
    """
    if fmt != "json":
        return parse_log(scan(spark.read.schema(RAW_LOG), fmt, path))
    reader = spark.read.schema(checked_schema()).option("mode", "PERMISSIVE")
    raw = scan(reader.option("columnNameOfCorruptRecord", LINE), "json", path)
    checked = stage(with_reason(raw))
    counts = {row.reason: row["count"] for row in checked.groupBy("reason").count().collect()}
    total = sum(counts.values())
    bad = {reason: n for reason, n in sorted(counts.items(), key=str) if reason is not None}
    if sum(bad.values()) > limit * total:
        raise MalformedInput(f"{sum(bad.values())} of {total} lines of {path} do not fit the log: {bad}")
    if bad and quarantine:
        bad_lines(checked).write.mode("append").parquet(quarantine)
    return sound_lines(checked)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """(reason, line) of quarantined lines; lines that were mended can be read again as a log."""
    return scan(spark.read.schema("reason STRING, line STRING"), "parquet", path)


def read_parsed_log(spark: SparkSession, path: str) -> DataFrame:
    """Scan a Parquet log that ``streaming.ingest`` wrote; ``day`` prunes folders."""
    log = scan(spark.read.schema(T.StructType([*ACTIVITY_LOG.fields, DAY])), "parquet", path)
    return log.select(*ACTIVITY_LOG.fieldNames(), "day")


def read_features(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Scan a feature table.

    Parquet brings its schema along.  For CSV give it: without one the types are
    inferred, which reads the file twice.
    """
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
        reader = reader if schema else reader.option("inferSchema", True)
    if schema:
        reader = reader.schema(schema)
    return scan(reader, fmt, path)


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a feature table; CSV carries a header line and no index."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str = "userId", buckets: int = 64) -> None:
    """Write a table in buckets of ``key``, sorted by it, under a name in the session's catalog.

    Tables with the same key and number of buckets join and group by the key without
    moving rows, so features, scores and labels that meet each day are worth it.  A
    bucket is one file; choose the number so that a file fits an executor's memory.
    """
    rows = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
    rows.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def save_feature_list(spark: SparkSession, names: list[str], path: str) -> None:
    """Store the ordered list of training columns beside the model."""
    rows = [(position, name) for position, name in enumerate(names)]
    spark.createDataFrame(rows, "position INT, name STRING").coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def load_feature_list(spark: SparkSession, path: str) -> list[str]:
    table = scan(spark.read.schema("position INT, name STRING"), "json", path)
    return [row.name for row in table.orderBy("position").collect()]


LEVEL_TABLE = "column INT, name STRING, position INT, level STRING"


def save_levels(spark: SparkSession, levels: dict[str, list[str]], path: str) -> None:
    """Store the dummy levels, in order; a column without levels keeps its place."""
    rows = [
        (number, name, position, level)
        for number, (name, found) in enumerate(levels.items())
        for position, level in [(-1, None), *enumerate(found)]
    ]
    spark.createDataFrame(rows, LEVEL_TABLE).coalesce(1).write.mode("overwrite").json(path)


def load_levels(spark: SparkSession, path: str) -> dict[str, list[str]]:
    levels: dict[str, list[str]] = {}
    table = scan(spark.read.schema(LEVEL_TABLE), "json", path)
    for row in table.orderBy("column", "position").collect():
        found = levels.setdefault(row.name, [])
        if row.level is not None:
            found.append(row.level)
    return levels


def request_rows(spark: SparkSession, records: list[dict]) -> DataFrame:
    """A few request records, as JSON objects, to a scoring table.

    Fields that are absent are null here; ``plans.scoring`` fills the optional
    ones and reports the required ones.
    """
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "record STRING")
    return lines.select(F.from_json("record", SCORING_REQUEST).alias("r")).select("r.*")


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Scan request records kept as JSON lines."""
    return scan(spark.read.schema(SCORING_REQUEST), "json", path)
