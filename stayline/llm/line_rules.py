"""Quality rules: word and repetition counts of a text, and lines that many documents of a host share.

Built-in functions only.  One scan of the texts leaves a narrow table: counts per
document and (hash, words) per line.  Documents per host and line are counted
from it with a map-side combine, lines above the limits are joined back, and a
document that loses too much is rejected.  Equal texts of a host are one document
in these counts, so a group of exact copies does not make its own lines boilerplate.

A line is above the limits when more than ``max_docs`` different documents of its
host hold it, however many documents the host has: more documents never let a line
through again that fewer had removed.
A document is depleted when fewer than ``min_words`` words, or less than
``min_rest`` of its words, remain.

Cases: null text has no words and fails the base rules; an empty text likewise; null
source is a host of its own; repeated rows each get the same verdict; very long texts
are one row, repeated windows are found by one sort per text; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.staging import stage

#: White space other than the line feed and the blank, and symbols that the rules count.
OTHER_SPACE, SYMBOLS = "\t\x0b\x0c\r", "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_docs: int = 10
    min_rest: float = 0.5


def _without(text: Column, characters: str, by: str = "") -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def _repeat_words(repeated: Column) -> Column:
    """Words covered by three-word windows that start at these sorted positions."""
    steps = F.transform(repeated, lambda p, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), p - F.get(repeated, k - 1))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)


def line_hash(words: Column) -> Column:
    """Hash of a line: its words in lower case with single blanks between."""
    return F.xxhash64(F.lower(F.array_join(words, " ")))


def profile(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Counts of every row under the base rules, with its lines as (hash, words)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", text.alias("text"))
    rows = rows.withColumn("plain", _without(F.col("text"), OTHER_SPACE, " "))
    rows = rows.withColumn("line_words", F.transform(F.split("plain", "\n"), lambda line: F.array_remove(F.split(line, " "), "")))
    rows = rows.withColumn("words", F.flatten("line_words")).withColumn("n_words", F.size("words").cast("long"))
    windows = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2)),
    )
    rows = rows.withColumn("windows", windows)
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    numbered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("sorted", F.when(again, numbered))
    twice = F.filter(
        "sorted",
        lambda x, k: (F.get("sorted", k - 1)["h"] == x["h"]) | (F.get("sorted", k + 1)["h"] == x["h"]),
    )
    rows = rows.withColumn("repeated", F.sort_array(F.transform(twice, lambda x: x["i"])))
    raw = F.filter(F.split("text", "\n"), lambda line, i: F.size(F.get("line_words", i)) > 0)
    rows = rows.withColumn("raw_lines", raw)
    worded = F.filter("line_words", lambda words: F.size(words) > 0)
    lines = F.transform(worded, lambda words: F.struct(line_hash(words).alias("hash"), F.size(words).alias("words")))
    counted = rows.select(
        "row",
        "doc_id",
        "source",
        "n_words",
        (F.length("text") - F.length("plain") + F.length(_without(F.col("plain"), " \n"))).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("raw_lines") - F.size(F.array_distinct("raw_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("sorted").isNull(), F.lit(0).cast("long")).otherwise(_repeat_words(F.col("repeated"))).alias("n_repeat_words"),
        F.xxhash64("text", F.reverse("text")).alias("content"),
        lines.alias("lines"),
    )
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed)


def frequent_lines(profiled: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(source, hash, docs) of the lines above the limits; ``docs`` counts different texts of the host."""
    first = profiled.groupBy("source", "content").agg(F.min("row").alias("row"))
    hashes = F.array_distinct(F.transform("lines", lambda line: line["hash"]))
    held = profiled.join(first.select("row"), "row", "left_semi").select("source", F.explode(hashes).alias("hash"))
    counts = held.groupBy("source", "hash").agg(F.count("*").alias("docs")).where(F.col("docs") > limits.max_docs)
    return counts.select("source", "hash", "docs")


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Counts, ``base_failed``, words left after frequent lines are removed, and ``kept`` of every row."""
    profiled = stage(profile(docs, limits))
    frequent = stage(frequent_lines(profiled, limits))
    held = profiled.select("row", "source", F.explode("lines").alias("line"))
    above = frequent.select(F.col("source").alias("host"), "hash")
    removed = (
        held.join(above, (F.col("line.hash") == F.col("hash")) & F.col("source").eqNullSafe(F.col("host")), "left_semi")
        .groupBy("row")
        .agg(F.sum("line.words").alias("gone"))
    )
    rest = F.col("n_words") - F.coalesce("gone", F.lit(0))
    enough = (rest >= limits.min_words) & (rest >= limits.min_rest * F.col("n_words"))
    judged = profiled.drop("lines", "content").join(removed, "row", "left")
    return judged.withColumn("n_words_left", rest).withColumn("kept", ~F.col("base_failed") & enough).drop("row", "gone")


def remove_lines(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """``docs`` with the lines of ``frequent`` taken out of their texts.

    The lines of a text are matched one by one and put together again in order, so a
    host's list of frequent lines never has to fit into one row.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = stage(docs.select(whole, F.monotonically_increasing_id().alias("row")))
    lines = rows.select("row", "doc.source", F.posexplode(F.split("doc.text", "\n")).alias("at", "line"))
    words = F.array_remove(F.split(_without(F.col("line"), OTHER_SPACE, " "), " "), "")
    above = frequent.select(F.col("source").alias("host"), "hash")
    left = lines.withColumn("key", F.when(F.size(words) > 0, line_hash(words))).join(
        above, (F.col("key") == F.col("hash")) & F.col("source").eqNullSafe(F.col("host")), "left_anti"
    )
    texts = left.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("kept_lines"))
    joined = F.array_join(F.transform("kept_lines", lambda x: x["line"]), "\n")
    text = F.when(F.col("doc.text").isNotNull(), F.coalesce(joined, F.lit(""))).alias("text")
    return rows.join(texts, "row", "left").select(*[text if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])
