"""Churn labels and the id sets they are made of."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.cleaning import on_page
from stayline.operators.users import known_users, last_interaction
from stayline.schemas import CANCELLATION, TRIGGER_PAGES

INACTIVITY = timedelta(days=30)


def trigger_users(log: DataFrame, triggers: Sequence[str] = TRIGGER_PAGES) -> DataFrame:
    """Distinct users with any trigger page: the union of the per-page id sets."""
    return on_page(known_users(log), *triggers).select("userId").distinct()


def events_of(log: DataFrame, users: DataFrame) -> DataFrame:
    """Events of the given users; adaptive execution splits the events of heavy ones."""
    return known_users(log).join(users.select("userId"), "userId", "left_semi")


def inactive_users(log: DataFrame, threshold: timedelta = INACTIVITY) -> DataFrame:
    """Users whose last event lies strictly before the cut-off."""
    cutoff = log.agg(F.max("ts") - F.lit(threshold)).scalar()
    return last_interaction(log).where(F.col("last_ts") < cutoff)


def with_churn(users: DataFrame, threshold: timedelta = INACTIVITY) -> DataFrame:
    """Add the inferred label to a per-user table.

    1 for a user with a trigger event whose overall last event lies strictly
    before the last event of all these users minus ``threshold``.  ``users``
    needs ``last_ts`` and ``num_triggers`` and is read twice, so stage it first
    when it comes from the event log.
    """
    cutoff = users.agg(F.max("last_ts") - F.lit(threshold)).scalar()
    churned = (F.col("num_triggers") > 0) & (F.col("last_ts") < cutoff)
    return users.withColumn("churn", churned.cast("int"))


def explicit_churn(log: DataFrame, page: str = CANCELLATION) -> DataFrame:
    """1 for a user that ever visited ``page``."""
    visited = F.max((F.col("page") == page).cast("int"))
    return known_users(log).groupBy("userId").agg(F.coalesce(visited, F.lit(0)).alias("churn"))


def flag_events(log: DataFrame, labels: DataFrame) -> DataFrame:
    """Carry a per-user label to each of the user's events; 0 where none exists."""
    labelled = known_users(log).join(labels.select("userId", "churn"), "userId", "left")
    return labelled.withColumn("churn", F.coalesce("churn", F.lit(0)))


def join_labels(users: DataFrame, labels: DataFrame) -> DataFrame:
    """Inner join of a per-user table with a per-user label."""
    return users.join(labels.select("userId", "churn"), "userId", "inner")
