"""Running totals and quantiles over a whole table, spread over many tasks.

A window without a partition, or with one per class, runs in one task.  Here the
ordering column is cut into value ranges; each range is summed on its own and
starts from the total of the ranges below it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.staging import stage


def running_totals(
    grouped: DataFrame,
    value: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add running and overall sums in ascending order of ``value``.

    ``grouped`` holds one row per (``by``, ``value``).  Adds ``cum_<s>`` (this row
    included) and ``total_<s>`` for each of ``sums``.  Rows are cut into even
    ranges of (``by``, ``value``) and staged with the range's number, so all that
    follows sees the same cuts; ``ranges`` left out follows the session's settings.
    """
    by = list(by)
    keys = [F.col(c) for c in (*by, value)]
    ranged = grouped.repartitionByRange(ranges, *keys) if ranges else grouped.repartitionByRange(*keys)
    # One non-null key for window and join alike: a null group is a group like any
    # other, and rows that the window has placed need not move for the join.
    slot = F.struct(*by, F.spark_partition_id().alias("_range")).alias("_slot")
    grouped = stage(ranged.select(*grouped.columns, slot))
    totals = grouped.groupBy("_slot").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    over_ranges = W.partitionBy(*[f"_slot.{b}" for b in by]).orderBy("_slot._range")
    below = over_ranges.rowsBetween(W.unboundedPreceding, -1)
    everything = over_ranges.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = totals.select(
        "_slot",
        *[F.coalesce(F.sum(f"_sum_{s}").over(below), F.lit(0)).alias(f"_below_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(everything).alias(f"total_{s}") for s in sums],
    )
    up_to = W.partitionBy("_slot").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = grouped.withColumns({f"cum_{s}": F.sum(s).over(up_to) for s in sums})
    summed = inside.join(offsets, "_slot").withColumns(
        {f"cum_{s}": F.col(f"cum_{s}") + F.col(f"_below_{s}") for s in sums}
    )
    return summed.drop("_slot", *[f"_below_{s}" for s in sums])


def counted_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long table (``by``, column, _value, _n): equal values counted, nulls left out."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_value")) for c in cols]
    long = df.select(*by, F.explode(F.array(*cells)).alias("_cell")).select(*by, "_cell.*")
    counted = long.where(F.col("_value").isNotNull()).groupBy(*by, "column", "_value")
    return counted.agg(F.count("*").alias("_n"))


def column_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    shares: dict[str, float],
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per ``by`` group and column.

    Equal values are counted before any ordering, so neither a group nor a value
    that holds most rows ends up in one task; all columns share one ranking.
    """
    keys = [*by, "column"]
    ranked = running_totals(counted_values(df, cols, by), "_value", ["_n"], keys, ranges)

    def at_least(position: Column) -> Column:
        return F.min(F.when(F.col("cum__n") > position, F.col("_value")))

    aggregates = []
    for name, share in shares.items():
        position = F.lit(float(share)) * (F.col("total__n") - 1)
        aggregates += [
            at_least(F.floor(position)).alias(f"_lo_{name}"),
            at_least(F.ceil(position)).alias(f"_hi_{name}"),
            F.max(position - F.floor(position)).alias(f"_part_{name}"),
        ]
    between = {
        n: F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")
        for n in shares
    }
    found = ranked.groupBy(*keys).agg(*aggregates)
    return found.select(*keys, *[value.alias(n) for n, value in between.items()])


def exact_quantiles(
    df: DataFrame,
    value: str,
    shares: dict[str, float],
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """``column_quantiles`` of one column, one row per ``by`` group."""
    return column_quantiles(df, [value], shares, by, ranges).drop("column")
