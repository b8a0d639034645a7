"""Operating-system and browser families of a user-agent string.

A fixed list of families, tested in order; the first match wins.  Evaluate on
distinct agents (``operators.agents``), not on events.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Family name and the pattern that marks it, in order of precedence.
OS_PATTERNS = (
    ("Windows Phone", "Windows Phone"),
    ("Windows", "Windows"),
    ("iOS", "iPhone|iPad|iPod"),
    ("Android", "Android"),
    ("Mac OS X", "Mac OS X|Macintosh"),
    ("Chrome OS", "CrOS"),
    ("Ubuntu", "Ubuntu"),
    ("Linux", "Linux"),
)
BROWSER_PATTERNS = (
    ("Edge", r"Edge/|Edg/|EdgA/|EdgiOS/"),
    ("Opera", r"OPR/|Opera"),
    ("Chrome Mobile iOS", r"CriOS/"),
    ("Firefox iOS", r"FxiOS/"),
    ("Chrome Mobile", r"Android.*Chrome/.*Mobile"),
    ("Chromium", r"Chromium/"),
    ("Chrome", r"Chrome/"),
    ("Firefox Mobile", r"Mobile;.*Firefox/"),
    ("Firefox", r"Firefox/"),
    ("IE", r"MSIE |Trident/"),
    ("Mobile Safari", r"(iPhone|iPad|iPod).*Safari/"),
    ("Safari", r"Safari/"),
)
EMPTY_AGENT = "Unknown"
NO_MATCH = "Other"


def _family(agent: Column | str, patterns: tuple[tuple[str, str], ...]) -> Column:
    agent = F.col(agent) if isinstance(agent, str) else agent
    chain = F.when(agent.isNull() | (agent == ""), F.lit(EMPTY_AGENT))
    for family, pattern in patterns:
        chain = chain.when(agent.rlike(pattern), F.lit(family))
    return chain.otherwise(F.lit(NO_MATCH))


def os_family(agent: Column | str) -> Column:
    return _family(agent, OS_PATTERNS)


def browser_family(agent: Column | str) -> Column:
    return _family(agent, BROWSER_PATTERNS)
