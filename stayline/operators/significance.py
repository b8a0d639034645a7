"""Whether one model is better than another on the same rows, by a paired bootstrap.

Every row has a Poisson(1) weight of its own in every replicate, drawn from a hash of its
key, so no sample is stored, both models see the same one, and a task that is run again
draws it again.  Replicates go through in blocks: a row is copied once per block and holds
its weights in all replicates of it, and a row drawn n times is one row of weight n.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import safe_ratio
from stayline.operators.metrics import THRESHOLD, predicted_class
from stayline.operators.ranking import running_totals

REPLICATES = 200
#: Replicates whose weights a row holds at once.
BLOCK = 8
#: Highest weight that 32 bits tell apart, more or less.
_MOST = 11


def poisson_steps() -> list[int]:
    """Where 32 random bits pass to the next weight: the distribution function of Poisson(1)."""
    below = [math.fsum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(_MOST)]
    return [math.floor(share * 2**32) for share in below]


def _bits(key: str, replicate: Column) -> Column:
    text = F.concat(F.col(key).cast("string"), F.lit("-boot-"), replicate.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _steps_passed(bits: Column) -> Column:
    weight = F.lit(0)
    for step in poisson_steps():
        weight = weight + (bits >= F.lit(step)).cast("int")
    return weight


def poisson_weight(key: str, replicate: str) -> Column:
    return _steps_passed(_bits(key, F.col(replicate)))


def _weighted(df: DataFrame, key: str, replicates: int) -> DataFrame:
    """``df`` once per block of ``BLOCK`` replicates, with the row's weight in each of them as ``_w0``, ``_w1``, ...

    Place 0 of block 0 are the rows as they are, replicate -1.  A hash is a column of its
    own, so it is taken once and not at every step that its weight may pass.  The rows are
    few bytes and much work, so they are dealt over tasks by number and not by size.
    """
    df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = F.sequence(F.lit(0), F.lit(replicates // BLOCK))
    number = [F.col("_block") * BLOCK + (k - 1) for k in range(BLOCK)]
    hashed = df.withColumn("_block", F.explode(blocks)).withColumns({f"_bits{k}": _bits(key, n) for k, n in enumerate(number)})
    drawn = {k: F.coalesce(F.when(n < replicates, _steps_passed(F.col(f"_bits{k}"))), F.lit(0)) for k, n in enumerate(number)}
    weights = {f"_w{k}": F.when(number[k] < 0, 1).otherwise(w) for k, w in drawn.items()}
    return hashed.withColumns(weights).drop(*[f"_bits{k}" for k in range(BLOCK)])


def _by_replicate(summed: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """A row per replicate from rows per block with the columns ``<name><place>``."""
    places = [
        F.struct((F.col("_block") * BLOCK + (k - 1)).alias("replicate"), *[F.col(f"{n}{k}").alias(n) for n in names]) for k in range(BLOCK)
    ]
    return summed.select(*keep, F.inline(F.array(*places)))


def _f1(tp: str, fp: str, fn: str) -> Column:
    return safe_ratio(2 * F.col(tp), 2 * F.col(tp) + F.col(fp) + F.col(fn))


def _replicated_f1(rows: DataFrame, label: str, scores: dict[str, str], threshold: float) -> DataFrame:
    actual = F.col(label) == 1
    sums, names = [F.sum(f"_w{k}").alias(f"weight{k}") for k in range(BLOCK)], ["weight"]
    for name, score in scores.items():
        called = predicted_class(score, threshold) == 1
        for cell, chosen in (("tp", called & actual), ("fp", called & ~actual), ("fn", ~called & actual)):
            names.append(f"{name}_{cell}")
            sums += [F.sum(F.when(chosen, F.col(f"_w{k}")).otherwise(0)).alias(f"{name}_{cell}{k}") for k in range(BLOCK)]
    counted = _by_replicate(rows.groupBy("_block").agg(*sums), names).where(F.col("weight") > 0)
    return counted.select("replicate", *[_f1(f"{n}_tp", f"{n}_fp", f"{n}_fn").alias(n) for n in scores])


def _replicated_auc(rows: DataFrame, label: str, scores: dict[str, str]) -> DataFrame:
    """The AUC of all replicates of a block from one ranking: a score stands for the rows drawn with it."""
    weights, by, places = [f"_w{k}" for k in range(BLOCK)], ["_block", "model"], range(BLOCK)
    kept = rows.select("_block", F.col(label).alias("_label"), *[F.col(s).alias(n) for n, s in scores.items()], *weights)
    long = kept.unpivot(["_block", "_label", *weights], list(scores), "model", "_score")
    of = lambda k, value: F.sum(F.when(F.col("_label") == value, F.col(f"_w{k}")).otherwise(0))
    folded = long.where(F.col("_score").isNotNull() & F.col("_label").isNotNull()).groupBy(*by, "_score")
    folded = folded.agg(*[of(k, 1).alias(f"_pos{k}") for k in places], *[of(k, 0).alias(f"_neg{k}") for k in places])
    ranked = running_totals(folded, "_score", [f"_neg{k}" for k in places], by)
    exact = lambda number: number.cast("decimal(19,0)")
    won = {k: exact(F.col(f"_pos{k}")) * exact(2 * F.col(f"cum__neg{k}") - F.col(f"_neg{k}")) for k in places}
    summed = ranked.groupBy(*by).agg(
        *[F.sum(won[k]).cast("double").alias(f"won{k}") for k in places],
        *[F.sum(f"_{c}{k}").alias(f"{c}{k}") for c in ("pos", "neg") for k in places],
    )
    found = _by_replicate(summed, ["won", "pos", "neg"], ["model"])
    area = F.try_divide(F.col("won"), F.lit(2.0) * F.col("pos") * F.col("neg"))
    return found.groupBy("replicate").pivot("model", list(scores)).agg(F.first(area))


def paired_bootstrap(
    df: DataFrame,
    current: str = "current",
    candidate: str = "candidate",
    label: str = "churn",
    key: str = "userId",
    metric: str = "f1",
    replicates: int = REPLICATES,
    level: float = 0.95,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row: both values, their difference, its interval and the share of replicates that favour the candidate.

    ``df`` holds both models' scores of each row; ``metric`` is ``f1`` or ``roc_auc``.
    Replicates without an AUC, where a class was not drawn, are left out.
    """
    if metric not in ("f1", "roc_auc"):
        raise ValueError("metric is 'f1' or 'roc_auc'")
    scores = {"_current": current, "_candidate": candidate}
    weighted = _weighted(df, key, replicates)
    values = _replicated_f1(weighted, label, scores, threshold) if metric == "f1" else _replicated_auc(weighted, label, scores)
    difference = F.col("_candidate") - F.col("_current")
    drawn = F.col("replicate") >= 0
    summed = values.agg(
        F.max(F.when(~drawn, F.col("_current"))).alias("current_value"),
        F.max(F.when(~drawn, F.col("_candidate"))).alias("candidate_value"),
        F.sort_array(F.collect_list(F.when(drawn, difference))).alias("_sorted"),
        F.avg(F.when(drawn, (difference > 0).cast("int"))).alias("share_better"),
    )
    size = F.size("_sorted")
    tail = F.floor((1 - level) / 2 * size).cast("int")
    return summed.select(
        F.lit(metric).alias("metric"),
        "current_value",
        "candidate_value",
        (F.col("candidate_value") - F.col("current_value")).alias("difference"),
        F.get("_sorted", tail).alias("low"),
        F.get("_sorted", size - tail - 1).alias("high"),
        "share_better",
    )


def significant_gate(compared: DataFrame, factor: float = 1.05) -> DataFrame:
    """Add ``promote``: better by ``factor``, and the whole interval of the difference above 0."""
    better = F.col("candidate_value") > F.lit(factor) * F.col("current_value")
    return compared.withColumn("promote", F.coalesce(better & (F.col("low") > 0), F.lit(False)))
