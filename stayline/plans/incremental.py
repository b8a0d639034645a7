"""User features over a growing log: every batch of new events is scanned once.

A store keeps the daily state of each batch (``operators.state``) under a folder of its
own, and a list of commits that says which batches count.  A batch whose run was lost
has no commit; running it again under the same name replaces what it had written.
Compaction writes several batches as one that replaces them.

Features come from the state alone.  For the log's events up to any day they are the rows
that ``featurize.user_features`` gives for those events, however they were split into batches
and whatever the order they came in.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators.agents import user_agent_fanout, with_agent_families
from stayline.operators.cleaning import logged_in
from stayline.operators.labels import INACTIVITY, with_churn
from stayline.operators.state import State, daily_state, merged, users_of_state
from stayline.operators.users import with_derived_features
from stayline.plans.featurize import FEATURE_COLUMNS
from stayline.schemas import TRIGGER_PAGES
from stayline.sources.tables import MissingInput, scan
from stayline.staging import delete, stage

TABLES = ("folds", "members", "sketches")
COMMIT = "batch STRING, replaces ARRAY<STRING>, triggers ARRAY<STRING>, whole_days_from DATE"


@dataclass(frozen=True)
class Commits:
    """What a store holds: batches that count, batches that were replaced, and what the state was built for."""

    live: tuple[str, ...]
    replaced: tuple[str, ...]
    triggers: tuple[str, ...] | None
    whole_days_from: date | None


def commits(spark: SparkSession, path: str) -> Commits:
    """A row a batch, so few."""
    try:
        rows = scan(spark.read.schema(COMMIT), "json", f"{path}/commits").collect()
    except MissingInput:
        rows = []
    gone = {old for row in rows for old in row.replaces}
    triggers = {tuple(row.triggers) for row in rows}
    if len(triggers) > 1:
        raise ValueError(f"{path} holds state for different trigger pages: {sorted(triggers)}")
    starts = [row.whole_days_from for row in rows if row.whole_days_from]
    return Commits(
        tuple(sorted({row.batch for row in rows} - gone)), tuple(sorted(gone)), next(iter(triggers), None), max(starts, default=None)
    )


def _write(spark: SparkSession, state: State, path: str, batch: str, replaces: Sequence[str], triggers: Sequence[str], start: date | None) -> None:
    for name, table in state.tables().items():
        table.sortWithinPartitions("day", "userId").write.mode("overwrite").parquet(f"{path}/{name}/batch={batch}")
    row = [(batch, [*replaces], [*triggers], start)]
    spark.createDataFrame(row, COMMIT).coalesce(1).write.mode("append").json(f"{path}/commits")


def add_batch(log: DataFrame, path: str, batch: str, triggers: Sequence[str] = TRIGGER_PAGES) -> bool:
    """Add the state of new events; False if a batch of this name counts already."""
    spark = log.sparkSession
    known = commits(spark, path)
    if known.triggers not in (None, tuple(triggers)):
        raise ValueError(f"{path} was built for the trigger pages {known.triggers}")
    if batch in (*known.live, *known.replaced):
        return False
    _write(spark, daily_state(logged_in(log), triggers), path, batch, [], triggers, None)
    return True


def _read(spark: SparkSession, path: str, batches: Sequence[str]) -> State:
    if not batches:
        raise MissingInput(f"no batch of events at {path}")
    return State(*(spark.read.parquet(*[f"{path}/{name}/batch={batch}" for batch in batches]) for name in TABLES))


def read_state(spark: SparkSession, path: str, until: date | None = None) -> State:
    """State of all batches, of events up to and including the day ``until``."""
    known = commits(spark, path)
    state = _read(spark, path, known.live)
    if until is None:
        return state
    if known.whole_days_from and until < known.whole_days_from - timedelta(days=1):
        raise ValueError(f"days before {known.whole_days_from} were folded into one")
    return state.each(lambda table: table.where(F.col("day") <= F.lit(until)))


def compact(spark: SparkSession, path: str, before: date | None = None) -> str:
    """Write all batches as one that replaces them; return its name.

    Days before ``before`` become one, so a long history is a row a user and profile.  The
    folders of replaced batches stay, for readers that started earlier, until ``clean``.
    """
    known = commits(spark, path)
    state = _read(spark, path, known.live)
    if before:
        last = F.lit(before - timedelta(days=1))
        state = state.each(lambda table: table.withColumn("day", F.when(F.col("day") < F.lit(before), last).otherwise(F.col("day"))))
    batch = f"compact-{uuid.uuid4().hex}"
    start = max((d for d in (before, known.whole_days_from) if d), default=None)
    _write(spark, merged(state), path, batch, known.live, known.triggers, start)
    return batch


def clean(spark: SparkSession, path: str) -> None:
    """Delete the folders of replaced batches."""
    for batch in commits(spark, path).replaced:
        for name in TABLES:
            delete(spark, f"{path}/{name}/batch={batch}")


def user_features(
    state: State, threshold: timedelta = INACTIVITY, ua_mode: str = "latest", distinct: str = "exact"
) -> DataFrame:
    """One wide row per user, as ``featurize.user_features`` gives it for the same events."""
    if ua_mode not in ("latest", "fanout"):
        raise ValueError("ua_mode is 'latest' or 'fanout'")
    users = with_churn(stage(users_of_state(state, distinct=distinct)), threshold)
    if ua_mode == "fanout":
        users = user_agent_fanout(users.drop("userAgent"), state.folds)
    return with_agent_families(with_derived_features(users)).select(*FEATURE_COLUMNS)


def features_of_days(
    state: State, days: Sequence[date], threshold: timedelta = INACTIVITY, distinct: str = "exact"
) -> DataFrame:
    """Features as they stood at the end of each of a few days, with the day as ``as_of``."""
    each = [
        user_features(state.each(lambda table, d=day: table.where(F.col("day") <= F.lit(d))), threshold, distinct=distinct).withColumn("as_of", F.lit(day))
        for day in days
    ]
    return reduce(DataFrame.unionByName, each)
