"""Time, ratio, label and hash expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis_to_ts(millis: Column | str) -> Column:
    """Epoch milliseconds as TIMESTAMP_NTZ in UTC, whatever the session zone is."""
    return F.timestamp_add("MILLISECOND", _col(millis), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def floor_days(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end, rounded down: minus half a day gives -1."""
    return F.floor(micros_between(start, end) / F.lit(MICROS_PER_DAY))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator, and 0 where the denominator is 0 or null."""
    return F.coalesce(F.try_divide(_col(numerator), _col(denominator)), F.lit(0.0))


def code_label(code: Column | str, labels: Mapping[int, str]) -> Column:
    """Map a small integer code to its display label."""
    out = F.lit(None).cast("string")
    for value, label in labels.items():
        out = F.when(_col(code) == F.lit(value), F.lit(label)).otherwise(out)
    return out


def _md5_long(key: Column | str, salt: str, digits: int) -> Column:
    text = F.concat(_col(key).cast("string"), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def hash_bucket(key: Column | str, salt: str, buckets: int) -> Column:
    """Stable bucket 0..buckets-1 from 32 bits of md5(key || salt)."""
    return F.pmod(_md5_long(key, salt, 8), F.lit(buckets)).cast("bigint")


def hash_fraction(key: Column | str, salt: str) -> Column:
    """Stable number in [0, 1) from 32 bits of md5(key || salt)."""
    return _md5_long(key, salt, 8).cast("double") / F.lit(4294967296.0)
