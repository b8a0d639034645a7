"""User agents per user, parsed once per distinct agent string."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions import browser_family, os_family
from stayline.operators.users import known_users
from stayline.staging import stage


def distinct_user_agents(log: DataFrame) -> DataFrame:
    """Distinct (user, agent) pairs; on a clean log no agent is null."""
    return (
        known_users(log)
        .where(F.col("userAgent").isNotNull())
        .select("userId", "userAgent")
        .dropDuplicates(["userId", "userAgent"])
    )


def agent_families(agents: DataFrame) -> DataFrame:
    """Distinct agent strings with their operating-system and browser family."""
    distinct = agents.select("userAgent").distinct()
    return distinct.select(
        "userAgent", os_family("userAgent").alias("os"), browser_family("userAgent").alias("browser")
    )


def with_agent_families(users: DataFrame) -> DataFrame:
    """Add ``os`` and ``browser`` to rows of one user and one agent each.

    There is one row per user (and agent), not per event, so the patterns are
    tested in place; a join back from the distinct strings would shuffle on the
    agent, where one popular string can hold a large share of all users.
    """
    return users.withColumns({"os": os_family("userAgent"), "browser": browser_family("userAgent")})


def user_agent_fanout(users: DataFrame, log: DataFrame) -> DataFrame:
    """Left join users to their distinct agents: a user with k agents gives k rows.

    The pairs are the many side, which adaptive execution splits where one user has
    very many agents; users without any agent are added.
    """
    pairs = stage(distinct_user_agents(log))
    matched = pairs.join(users, "userId")
    lonely = users.join(pairs.select("userId").distinct(), "userId", "left_anti")
    return matched.select(*users.columns, "userAgent").unionByName(
        lonely.withColumn("userAgent", F.lit(None).cast("string"))
    )
