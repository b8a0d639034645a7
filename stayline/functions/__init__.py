"""Column expressions; all run inside the JVM."""

from stayline.functions.agents import browser_family, os_family
from stayline.functions.scalars import (
    code_label,
    epoch_millis_to_ts,
    floor_days,
    hash_bucket,
    hash_fraction,
    micros_between,
    safe_ratio,
)

__all__ = [
    "browser_family",
    "code_label",
    "epoch_millis_to_ts",
    "floor_days",
    "hash_bucket",
    "hash_fraction",
    "micros_between",
    "os_family",
    "safe_ratio",
]
