"""Activity log to user feature table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.agents import user_agent_fanout, with_agent_families
from stayline.operators.cleaning import logged_in
from stayline.operators.encoding import fit_levels, one_hot
from stayline.operators.labels import INACTIVITY, with_churn
from stayline.operators.users import user_activity, user_aggregates, with_derived_features
from stayline.schemas import CATEGORICAL_COLUMNS, PROFILE_COLUMNS, TRIGGER_PAGES
from stayline.staging import stage

FEATURE_COLUMNS = (
    "userId",
    "churn",
    "gender",
    "total_songs",
    "total_listen_time",
    "num_artists",
    "num_thumbs_up",
    "num_thumbs_down",
    "num_sessions",
    "num_friends_added",
    "num_downgrades",
    "last_level",
    "tenure",
    "avg_songs_per_session",
    "os",
    "browser",
)


def churn_labels(
    log: DataFrame,
    threshold: timedelta = INACTIVITY,
    triggers: Sequence[str] = TRIGGER_PAGES,
    required: Sequence[str] = PROFILE_COLUMNS,
) -> DataFrame:
    """userId and inferred churn of every complete logged-in user."""
    activity = stage(user_activity(logged_in(log), triggers, required))
    return with_churn(activity, threshold).select("userId", "last_ts", "churn")


def user_features(
    log: DataFrame,
    threshold: timedelta = INACTIVITY,
    triggers: Sequence[str] = TRIGGER_PAGES,
    ua_mode: str = "latest",
) -> DataFrame:
    """One wide row per user, categories not yet encoded.

    The per-user table is staged: it is small next to the log, and the cut-off
    needs a second look at it.  ``ua_mode="latest"`` keeps a user's last agent;
    ``"fanout"`` gives one row per user and distinct agent.
    """
    if ua_mode not in ("latest", "fanout"):
        raise ValueError("ua_mode is 'latest' or 'fanout'")
    events = logged_in(log)
    users = with_churn(stage(user_aggregates(events, triggers)), threshold)
    if ua_mode == "fanout":
        users = user_agent_fanout(users.drop("userAgent"), events)
    return with_agent_families(with_derived_features(users)).select(*FEATURE_COLUMNS)


def featurize(
    log: DataFrame,
    threshold: timedelta = INACTIVITY,
    triggers: Sequence[str] = TRIGGER_PAGES,
    ua_mode: str = "latest",
    levels: dict[str, list[str]] | None = None,
    require_churn: bool = True,
) -> tuple[DataFrame, dict[str, list[str]]]:
    """The encoded feature table and the levels it was encoded with.

    Give ``levels`` to encode new data like the training data.  Without any
    churned user the table is empty but has its full schema; for scoring, where
    no label is needed, turn ``require_churn`` off.
    """
    users = user_features(log, threshold, triggers, ua_mode)
    if ua_mode == "fanout":
        users = stage(users)  # below a join; the other form is a scan of a staged table
    return encoded(users, levels, require_churn)


def encoded(
    users: DataFrame, levels: dict[str, list[str]] | None = None, require_churn: bool = True
) -> tuple[DataFrame, dict[str, list[str]]]:
    """A wide per-user table with its categories encoded, and the levels; ``users`` is read several times."""
    if levels is None:
        levels = fit_levels(users, CATEGORICAL_COLUMNS)
    if require_churn:
        any_churn = users.agg(F.coalesce(F.max("churn"), F.lit(0))).scalar()
        users = users.where(any_churn == 1)
    return one_hot(users, levels), levels
