"""Mixing sources to target weights: budgets down a tree, token prefixes of seeded epochs at its leaves.

Built-in functions only.  A leaf can give its tokens ``max_epochs`` times; a node as
much as its children together.  From the root down every node's budget is shared
among its children by weight, and what one child cannot give goes to its siblings by
weight; so a shortage leaves a family only when all of it is exhausted.  A leaf's
budget is a number of whole epochs and a rest, which takes the prefix of the next
epoch's seeded order.

Budgets are whole numbers.  The order is cut into 256 buckets by its first digits; only
totals per leaf and bucket are windowed, then the bucket where the prefix ends is cut
again, three times in all, so the largest leaf is never sorted.  The outcome per leaf
is two numbers, so documents are chosen where they are read.

Cases: null levels are a leaf of their own; null text has no tokens; a leaf without
tokens gives nothing; rows with equal id and text have one place in the order and
are taken together; the document in which a budget ends is taken whole; weights that
are not told are ``default``; an empty table gives an empty result; other columns
stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayline.staging import stage

#: Hexadecimal digits of an order; the bucket in which a prefix ends is narrowed down by
#: STEP_DIGITS at a time, so no window sees more than 16 ** STEP_DIGITS buckets of a leaf.
ORDER_DIGITS, STEP_DIGITS, NARROWED_DIGITS = 15, 2, 6
WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """``weights``: whole numbers by path, such as ``crawl/en``; ``share``: percent of all tokens asked for."""

    levels: Sequence[str] = ("domain", "lang", "source")
    weights: Mapping[str, int] = field(default_factory=dict)
    default: int = 1
    share: int = 90
    max_epochs: int = 4
    seed: str = "mix"


def n_tokens(text: Column) -> Column:
    """Words between blanks, tabs and line ends."""
    for space in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), " "), "")).cast("long")


def _path(levels: Sequence[str]) -> Column:
    return F.concat_ws("/", *(F.coalesce(F.col(level), F.lit("")) for level in levels))


def _order(mix: Mix, epoch: str, fingerprint: str) -> Column:
    """Place of a row in an epoch: the first digits of a hash of seed, epoch, id and text."""
    told = F.concat_ws("|", F.lit(mix.seed), F.col(epoch).cast("string"), F.col("doc_id").cast("string"), F.col(fingerprint))
    return F.conv(F.substring(F.md5(told), 1, ORDER_DIGITS), 16, 10).cast("long")


def _levels(mix: Mix) -> list[Column]:
    """The leaf of a row."""
    return [F.coalesce(F.col(level).cast("string"), F.lit("")).alias(f"__level{i}") for i, level in enumerate(mix.levels)]


def _own(mix: Mix) -> list[str]:
    return [f"__level{i}" for i in range(len(mix.levels))]


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Levels, tokens and budget of every leaf."""
    own = _own(mix)
    given = leaves.withColumn("capacity", F.col("tokens").cast(WIDE) * mix.max_epochs)
    asked = F.floor(F.sum("tokens").cast(WIDE) * mix.share / 100).cast(WIDE)
    root = given.agg(F.least(asked, F.sum("capacity")).cast(WIDE)).scalar()
    above, keys = None, ["__root"]
    for depth in range(1, len(own) + 1):
        path = own[:depth]
        pairs = [F.lit(x) for name, weight in mix.weights.items() if name.count("/") == depth - 1 for x in (name, weight)]
        told = F.try_element_at(F.create_map(*pairs), _path(path)) if pairs else F.lit(None).cast("int")
        nodes = given.groupBy(F.lit(0).alias("__root"), *path).agg(F.sum("capacity").cast(WIDE).alias("capacity"))
        nodes = nodes.withColumn("weight", F.coalesce(told, F.lit(mix.default)).cast(WIDE))
        nodes = nodes.join(above, keys) if above is not None else nodes.withColumn("budget", root)
        # siblings run dry in the order of capacity by weight; the first that does not sets the level for the rest
        ratio = F.when(F.col("weight") == 0, F.lit(float("inf"))).otherwise(F.col("capacity") / F.col("weight"))
        family = Window.partitionBy(*keys).orderBy("ratio", *path)
        nodes = nodes.withColumn("ratio", ratio.cast("double"))
        dry = F.coalesce(F.sum("capacity").over(family.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(WIDE)
        rest = F.sum("weight").over(family.rowsBetween(Window.currentRow, Window.unboundedFollowing)).cast(WIDE)
        nodes = nodes.withColumn("dry", dry).withColumn("rest", rest).withColumn("left", (F.col("budget") - F.col("dry")).cast(WIDE))
        exhausted = (F.col("weight") > 0) & (F.col("capacity") * F.col("rest") <= F.col("left") * F.col("weight"))
        nodes = nodes.withColumn("open", F.when(~exhausted, F.struct("ratio", *path, F.col("left").alias("l"), F.col("rest").alias("r"))))
        nodes = nodes.withColumn("level", F.min("open").over(Window.partitionBy(*keys)))
        shared = F.floor(F.try_divide(F.col("level.l") * F.col("weight"), F.col("level.r")))
        budget = F.when(exhausted, F.col("capacity")).otherwise(F.least(F.coalesce(shared, F.lit(0)).cast(WIDE), "capacity"))
        above = nodes.select("__root", *path, budget.cast(WIDE).alias("budget"))
        keys = ["__root", *path]
    return leaves.join(above.drop("__root"), own).select(*own, "tokens", F.col("budget").cast("long").alias("budget"))


def cuts(measured: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf the whole epochs and the place in the next epoch's order where its prefix ends."""
    own = _own(mix)
    leaves = stage(measured.groupBy(*own).agg(F.sum("tokens").alias("tokens")))
    shares = budgets(leaves, mix)
    epochs = F.when(F.col("tokens") > 0, F.floor(F.try_divide("budget", "tokens"))).otherwise(0).cast("long")
    shares = shares.withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    shares = stage(shares)
    asked = shares.where("rest > 0").select(*own, "epochs", "rest")
    placed = measured.join(asked, own).withColumn("place", _order(mix, "epochs", "fingerprint"))
    placed = stage(placed.select(*own, "rest", "tokens", "place", F.lit(0).cast("long").alias("so_far")))

    def before(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("before", F.col("so_far") + F.coalesce(F.sum("tokens").over(window), F.lit(0)))

    for digits in range(STEP_DIGITS, NARROWED_DIGITS + 1, STEP_DIGITS):
        bucket = F.shiftright("place", 4 * (ORDER_DIGITS - digits))
        placed = placed.withColumn("bucket", bucket)
        totals = placed.groupBy(*own, "rest", "so_far", "bucket").agg(F.sum("tokens").alias("tokens"))
        ends = before(totals, own, "bucket").where(F.col("before") < F.col("rest"))
        ends = stage(ends.where(F.col("rest") <= F.col("before") + F.col("tokens")).select(*own, "bucket", "before"))
        placed = placed.join(ends, [*own, "bucket"]).select(*own, "rest", "tokens", "place", F.col("before").alias("so_far"))
    last = placed.groupBy(*own, "rest", "so_far", "place").agg(F.sum("tokens").alias("tokens"))
    inside = before(last, own, "place").where(F.col("before") < F.col("rest"))
    found = inside.groupBy(*own).agg((F.max("place") + 1).alias("cut"))
    return shares.join(found, own, "left").select(*own, "epochs", F.coalesce("cut", F.lit(0)).alias("cut"))


def _counted(docs: DataFrame, mix: Mix) -> DataFrame:
    """(doc, tokens, copies): the whole row as one column, so no name of its columns can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    facts = [n_tokens(F.col("text")).alias("tokens"), F.md5(F.coalesce("text", F.lit(""))).alias("fingerprint")]
    rows = docs.select(whole, "doc_id", *facts, *_levels(mix))
    own = _own(mix)
    measured = stage(rows.select(*own, "doc_id", "tokens", "fingerprint"))
    told = rows.join(stage(cuts(measured, mix)), own)
    number = F.col("epochs") + F.when(_order(mix, "epochs", "fingerprint") < F.col("cut"), 1).otherwise(0)
    return told.select("doc", "tokens", number.alias("copies"))


def copies(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``copies``: how often each document is in the mix.

    Columns of these two names give way.
    """
    named = [F.col(f"doc.`{c}`") for c in docs.columns if c not in ("n_tokens", "copies")]
    return _counted(docs, mix).select(*named, F.col("tokens").alias("n_tokens"), "copies")


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mix itself: every document as often as its copies say; all columns stay."""
    numbered = _counted(docs, mix).where("copies > 0")
    return numbered.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
