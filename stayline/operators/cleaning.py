"""Event filters, attribute filling and the clean log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.schemas import LOGGED_IN, PROFILE_COLUMNS
from stayline.staging import stage

EVENT_ORDER = ("ts", "tie")


def logged_in(log: DataFrame) -> DataFrame:
    return log.where(F.col("auth") == LOGGED_IN)


def on_page(log: DataFrame, *pages: str) -> DataFrame:
    return log.where(F.col("page").isin(*pages))


def placed_by_time(
    events: DataFrame, key: str, order: Sequence[str], parts: int | None = None
) -> DataFrame:
    """Events cut into even parts of (user, time, tie), staged with the number ``_part`` of each.

    A part holds many light users or a piece of a heavy one, whatever share of the
    events that user has; parts grow with their number in time order.  ``parts``
    left out follows the session's shuffle settings.
    """
    by = [F.col(c) for c in (key, *order)]
    ranged = events.repartitionByRange(parts, *by) if parts else events.repartitionByRange(*by)
    return stage(ranged.withColumn("_part", F.spark_partition_id()))


def _carried(placed: DataFrame, cols: Sequence[str], key: str, order: Sequence[str]) -> DataFrame:
    """What each part of a user in several parts gets from the others.

    ``_in_<c>`` is the last known value of the parts before, ``_known_<c>`` the
    user's first known value.  At most one user is cut at an end of a part, so
    these users are fewer than the parts.
    """
    ends = placed.groupBy(key).agg(F.min("_part").alias("first"), F.max("_part").alias("last"))
    cut = stage(ends.where(F.col("first") < F.col("last")).select(key))
    at = F.struct(*order)
    edges = (
        placed.join(cut, key, "left_semi")
        .groupBy(key, "_part")
        .agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_last_{c}") for c in cols],
            *[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_first_{c}") for c in cols],
        )
    )
    per_user = W.partitionBy(key).orderBy("_part")
    before = per_user.rowsBetween(W.unboundedPreceding, -1)
    whole = per_user.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return edges.select(
        key,
        "_part",
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_in_{c}") for c in cols],
        *[F.first(f"_first_{c}", ignorenulls=True).over(whole).alias(f"_known_{c}") for c in cols],
    )


def fill_profile(
    log: DataFrame,
    cols: Sequence[str] = PROFILE_COLUMNS,
    key: str = "userId",
    order: Sequence[str] = EVENT_ORDER,
    parts: int | None = None,
) -> DataFrame:
    """Forward fill, then backward fill, each attribute within a user.

    Every part is filled on its own, starting from what earlier parts carry into
    it.  Where the forward fill finds nothing, every earlier value is null, so the
    backward fill equals the user's first known value.  Events without a user
    belong to no group and are left out.
    """
    events = log.where(F.col(key).isNotNull())
    placed = placed_by_time(events, key, order, parts)
    carried = stage(_carried(placed, cols, key, order))
    ordered = W.partitionBy(key, "_part").orderBy(*order)
    so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    all_rows = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    joined = placed.join(carried, [key, "_part"], "left")
    filled = joined.withColumns(
        {f"_out_{c}": F.last(c, ignorenulls=True).over(so_far) for c in cols}
        | {f"_here_{c}": F.first(c, ignorenulls=True).over(all_rows) for c in cols}
    )
    return filled.select(
        *[
            F.coalesce(f"_out_{c}", f"_in_{c}", f"_known_{c}", f"_here_{c}").alias(c)
            if c in cols
            else F.col(c)
            for c in events.columns
        ]
    )


def drop_incomplete(log: DataFrame, cols: Sequence[str] = PROFILE_COLUMNS) -> DataFrame:
    return log.na.drop("any", subset=list(cols))


def clean_log(
    log: DataFrame,
    cols: Sequence[str] = PROFILE_COLUMNS,
    order: Sequence[str] = EVENT_ORDER,
    parts: int | None = None,
) -> DataFrame:
    """Logged-in events with filled attributes, without users that stay incomplete."""
    return drop_incomplete(fill_profile(logged_in(log), cols, order=order, parts=parts), cols)
