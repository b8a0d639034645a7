"""One row per user: aggregates, first and last known values, derived features.

Filling attributes and dropping incomplete users needs no window here.  After
filling, a user's rows survive exactly when each profile column has a value
somewhere, and filling adds no new value, so first and last known values,
counts and the last event can be read from the unfilled events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import floor_days, micros_between, safe_ratio
from stayline.schemas import (
    ADD_FRIEND,
    PROFILE_COLUMNS,
    SUBMIT_DOWNGRADE,
    THUMBS_DOWN,
    THUMBS_UP,
    TRIGGER_PAGES,
)

PAGE_COUNTS = {
    "num_thumbs_up": THUMBS_UP,
    "num_thumbs_down": THUMBS_DOWN,
    "num_friends_added": ADD_FRIEND,
    "num_downgrades": SUBMIT_DOWNGRADE,
}


def known_users(log: DataFrame) -> DataFrame:
    return log.where(F.col("userId").isNotNull())


def last_interaction(log: DataFrame) -> DataFrame:
    return known_users(log).groupBy("userId").agg(F.max("ts").alias("last_ts"))


def engagement_counts(log: DataFrame) -> DataFrame:
    """Songs, listen time, distinct artists and distinct sessions per user.

    Two aggregates: counters would otherwise go through the expansion that
    distinct counts need.
    """
    per_user = known_users(log).groupBy("userId")
    sums = per_user.agg(
        F.count("song").alias("total_songs"),
        F.coalesce(F.sum("length"), F.lit(0.0)).alias("total_listen_time"),
    )
    return sums.join(_distinct_counts(log), "userId")


def _distinct_counts(log: DataFrame) -> DataFrame:
    return (
        known_users(log)
        .groupBy("userId")
        .agg(
            F.count_distinct("artist").alias("num_artists"),
            F.count_distinct("sessionId").alias("num_sessions"),
        )
    )


def page_counts(log: DataFrame, pages: dict[str, str] = PAGE_COUNTS) -> DataFrame:
    counts = [F.count_if(F.col("page") == page).alias(name) for name, page in pages.items()]
    return known_users(log).groupBy("userId").agg(*counts)


def _moment() -> Column:
    """Place of an event in the log's order (ts, tie), as one whole number.

    A number fits a hash-aggregate buffer, a struct would not.
    """
    micros = micros_between(F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), "ts")
    tie = F.coalesce(F.col("tie"), F.lit(0)).cast("decimal(38,0)")
    two_to = {n: F.lit(str(2**n)).cast("decimal(20,0)") for n in (63, 64)}
    return (micros.cast("decimal(19,0)") * two_to[64] + tie + two_to[63]).cast("decimal(38,0)")


def _first_known(value: str, at: str) -> Column:
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.struct(at, value)))


def _last_known(value: str, at: str) -> Column:
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(at, value)))


def _value_spans(log: DataFrame, cols: Sequence[str]) -> DataFrame:
    """First and last event of each combination of values a user shows.

    Strings cannot sit in a hash-aggregate buffer, so a direct ``max_by`` over
    events would sort every event.  Grouping by the values keeps the buffers
    primitive; the rows that are left are few.
    """
    return (
        known_users(log)
        .withColumn("_at", _moment())
        .groupBy("userId", *cols)
        .agg(
            F.min("_at").alias("from"),
            F.max("_at").alias("to"),
            F.max("ts").alias("to_ts"),
        )
    )


def first_profile(log: DataFrame) -> DataFrame:
    """First known gender and registration in the order (ts, tie)."""
    return (
        _value_spans(log, ("gender", "registration"))
        .groupBy("userId")
        .agg(
            _first_known("gender", "from").alias("gender"),
            _first_known("registration", "from").alias("registration"),
        )
    )


def last_level(log: DataFrame) -> DataFrame:
    """Last known subscription level in the order (ts, tie)."""
    return (
        _value_spans(log, ("level",))
        .groupBy("userId")
        .agg(_last_known("level", "to").alias("last_level"))
    )


def complete_users(log: DataFrame, cols: Sequence[str] = PROFILE_COLUMNS) -> DataFrame:
    """Users that have a value in every profile column."""
    counts = known_users(log).groupBy("userId").agg(*[F.count(c).alias(c) for c in cols])
    condition = F.lit(True)
    for c in cols:
        condition = condition & (F.col(c) > 0)
    return counts.where(condition).select("userId")


def user_activity(
    log: DataFrame,
    triggers: Sequence[str] = TRIGGER_PAGES,
    required: Sequence[str] = PROFILE_COLUMNS,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """What a churn label needs per complete user: last event, trigger events.

    ``extra`` adds aliased aggregates to the same scan.
    """
    per_user = (
        known_users(log)
        .groupBy("userId")
        .agg(
            F.max("ts").alias("last_ts"),
            F.count_if(F.col("page").isin(*triggers)).alias("num_triggers"),
            *[F.count(c).alias(f"_n_{c}") for c in required],
            *extra,
        )
    )
    condition = F.lit(True)
    for c in required:
        condition = condition & (F.col(f"_n_{c}") > 0)
    return per_user.where(condition).drop(*[f"_n_{c}" for c in required])


#: What a user's events are folded by; few values a user, so folding shrinks a log to a few rows a user.
FOLD_KEYS = ("gender", "registration", "level", "userAgent")


def profile_folds(
    log: DataFrame,
    triggers: Sequence[str] = TRIGGER_PAGES,
    required: Sequence[str] = PROFILE_COLUMNS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Events folded by user and profile values (and ``by``): sums, minima and maxima alone.

    Such rows merge: folds of parts of a log together are as good as folds of the whole.
    """
    counted = [c for c in required if c not in FOLD_KEYS]
    events = known_users(log)
    return events.withColumn("_at", _moment()).groupBy("userId", *by, *FOLD_KEYS).agg(
        F.min("_at").alias("_from"),
        F.max("_at").alias("_to"),
        F.max("ts").alias("_to_ts"),
        F.count("song").alias("_songs"),
        F.sum("length").alias("_length"),
        F.count_if(F.col("page").isin(*triggers)).alias("_triggers"),
        *[F.count_if(F.col("page") == p).alias(f"_{n}") for n, p in PAGE_COUNTS.items()],
        *[F.count(c).alias(f"_n_{c}") for c in counted],
    )


def merged_folds(folds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Folds with equal keys as one."""
    keys = ["userId", *by, *FOLD_KEYS]
    lowest, highest = ("_from",), ("_to", "_to_ts")
    sums = [c for c in folds.columns if c not in (*keys, *lowest, *highest)]
    return folds.groupBy(keys).agg(
        *[F.min(c).alias(c) for c in lowest],
        *[F.max(c).alias(c) for c in highest],
        *[F.sum(c).alias(c) for c in sums],
    )


def users_of_folds(folds: DataFrame, required: Sequence[str] = PROFILE_COLUMNS) -> DataFrame:
    """Complete users with everything that folds tell about them."""
    counted = [c for c in required if c not in FOLD_KEYS]
    per_user = folds.groupBy("userId").agg(
        _first_known("gender", "_from").alias("gender"),
        _first_known("registration", "_from").alias("registration"),
        F.max("_to_ts").alias("last_ts"),
        F.sum("_songs").alias("total_songs"),
        F.coalesce(F.sum("_length"), F.lit(0.0)).alias("total_listen_time"),
        *[F.sum(f"_{n}").alias(n) for n in PAGE_COUNTS],
        _last_known("level", "_to").alias("last_level"),
        _last_known("userAgent", "_to").alias("userAgent"),
        F.sum("_triggers").alias("num_triggers"),
        *[F.sum(f"_n_{c}").alias(f"_n_{c}") for c in counted],
    )
    condition = F.lit(True)
    for c in required:
        condition = condition & (F.col(f"_n_{c}") > 0 if c in counted else F.col(c).isNotNull())
    return per_user.where(condition).drop(*[f"_n_{c}" for c in counted])


def user_aggregates(
    log: DataFrame,
    triggers: Sequence[str] = TRIGGER_PAGES,
    required: Sequence[str] = PROFILE_COLUMNS,
) -> DataFrame:
    """All per-user aggregates of complete users.

    Two scans that share little more than the user column.  The first folds
    events by the profile values a user shows, with additive counts; its buffers
    are primitive, so it hash-aggregates with map-side combine, and the second
    step sees a few rows per user.  The other counts distinct artists and
    sessions, which would otherwise drag every counter through the expansion
    that distinct counts need.  Both end partitioned by user, so joining them
    moves nothing.  Keep a large log as Parquet: JSON would be parsed twice.
    """
    complete = users_of_folds(profile_folds(log, triggers, required), required)
    return complete.join(_distinct_counts(log), "userId")


def with_derived_features(users: DataFrame) -> DataFrame:
    """Add tenure in whole days and songs per session (0 where there is no session)."""
    return users.withColumns(
        {
            "tenure": floor_days("registration", "last_ts"),
            "avg_songs_per_session": safe_ratio("total_songs", "num_sessions"),
        }
    )


def tenure_user(log: DataFrame) -> DataFrame:
    """Days from the first known registration to the last event."""
    spans = _value_spans(log, ("registration",))
    users = spans.groupBy("userId").agg(
        _first_known("registration", "from").alias("registration"),
        F.max("to_ts").alias("last_ts"),
    )
    return users.select("userId", floor_days("registration", "last_ts").alias("tenure"))


def tenure_dataset(log: DataFrame) -> DataFrame:
    """Days from a user's earliest registration to the last event of the whole log."""
    end = log.agg(F.max("ts")).scalar()
    return (
        known_users(log)
        .groupBy("userId")
        .agg(F.min("registration").alias("registration"))
        .select("userId", floor_days(F.col("registration"), end).alias("tenure_days"))
    )


def songs_per_session(log: DataFrame) -> DataFrame:
    counts = (
        known_users(log)
        .groupBy("userId")
        .agg(
            F.count("song").alias("total_songs"),
            F.count_distinct("sessionId").alias("num_sessions"),
        )
    )
    return counts.withColumn("avg_songs_per_session", safe_ratio("total_songs", "num_sessions"))


def session_duration(log: DataFrame) -> DataFrame:
    """Average session length in seconds, from first to last event of a session."""
    sessions = (
        known_users(log)
        .where(F.col("sessionId").isNotNull())
        .groupBy("userId", "sessionId")
        .agg(F.min("ts").alias("from_ts"), F.max("ts").alias("to_ts"))
    )
    return (
        sessions.groupBy("userId")
        .agg(
            F.sum(micros_between("from_ts", "to_ts")).alias("_micros"),
            F.count("*").alias("num_sessions"),
        )
        .select(
            "userId",
            "num_sessions",
            safe_ratio(F.col("_micros") / F.lit(1_000_000.0), "num_sessions").alias(
                "avg_session_duration"
            ),
        )
    )


def play_trend(log: DataFrame, days: int = 14) -> DataFrame:
    """Plays in the last ``days`` days of the log, the plays before, and their slope.

    ``daily_slope`` is the least-squares slope of plays per day over those last
    days, days without plays included.  With the days numbered 0, 1, ... it needs
    only the number of plays and the sum of their day numbers, so one aggregate
    over the events is enough.
    """
    start = log.agg(F.max("ts") - F.expr(f"INTERVAL {int(days)} DAYS")).scalar()
    recent = F.col("ts") > start
    played = F.col("song").isNotNull()
    day = F.least(floor_days(start, F.col("ts")), F.lit(days - 1))
    day_sum = days * (days - 1) // 2
    day_squares = days * (days - 1) * (2 * days - 1) // 6
    spread = days * day_squares - day_sum * day_sum
    slope = (F.lit(days) * F.col("_days") - F.lit(day_sum) * F.col("recent_songs")) / F.lit(spread)
    return (
        known_users(log)
        .groupBy("userId")
        .agg(
            F.count_if(played & recent).alias("recent_songs"),
            F.count_if(played & ~recent).alias("earlier_songs"),
            F.coalesce(F.sum(F.when(played & recent, day)), F.lit(0)).alias("_days"),
        )
        .withColumns(
            {
                "recent_share": safe_ratio(
                    "recent_songs", F.col("recent_songs") + F.col("earlier_songs")
                ),
                "daily_slope": slope if days > 1 else F.lit(None).cast("double"),
            }
        )
        .drop("_days")
    )
