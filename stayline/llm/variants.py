"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

A word's counterpart one edit away shares its first half or its last half, so words are
dealt by both halves, the last one spelled backwards, once for the class of their own
length and once for that of words one shorter.  Such a list is sorted and scanned for
each of its words.  The edit matrix is kept as three cells a row, from one below to one
above the diagonal; the rows of the prefix that the next word shares with the one before
it are used again, and a run of words whose shared prefix is already more than one edit
away is skipped.  Lists with more than ``most`` words are dealt again by everything
but one character, which leaves a list of the few spellings of that character.

A word's form is its near word with the largest count, if that is ``times`` the word's own;
its root is where the forms end.  Counts along them grow, so they do end, and they are
followed by doubling the step.

Cases: a null text has no words, nor has an empty one; texts are read whole; rows of one
id count each, null ids are spelled as an empty string; ties go to the smaller
word in the order of code points; a word without near words is its own root; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.staging import stage

@dataclass(frozen=True)
class Spelling:
    """``garble``: one run in so many loses a character before it is counted, 0 for none."""

    least_chars: int = 7
    least_count: int = 2
    times: int = 10
    garble: int = 0
    most: int = 512

    def __post_init__(self) -> None:
        if self.times < 2:
            raise ValueError("a form must occur more often than its variant, or forms could lead round in a circle")


def _rows_of_the_matrix() -> dict[tuple[int, int, int], list[tuple[int, int, int] | None]]:
    """The row after each row, by which of the three characters beside it agree (bits 0 to 2); None beyond one edit.

    Cells above one edit count as two.
    """
    after = {}
    for a in range(3):
        for b in range(3):
            for c in range(3):
                following = []
                for agree in range(8):
                    low = min(a + (not agree & 1), b + 1, 2)
                    middle = min(b + (not agree & 2), c + 1, low + 1, 2)
                    high = min(c + (not agree & 4), middle + 1, 2)
                    row = (low, middle, high)
                    following.append(row if min(row) < 2 else None)
                after[a, b, c] = following
    return after


_AFTER = _rows_of_the_matrix()


def _shared(a: str, b: str, least: int) -> int:
    """Length of the common prefix, known to be ``least`` or more."""
    most = min(len(a), len(b))
    while least < most and a[least] == b[least]:
        least += 1
    return least


def near_pairs(words: list[str], shared: int = 0) -> Iterator[tuple[int, int]]:
    """(i, j), i < j, of the different words of a sorted list that are one edit apart; all share ``shared`` characters."""
    count = len(words)
    prefix = [0, *(_shared(words[k - 1], words[k], shared) for k in range(1, count))]
    longest = max(map(len, words), default=0)
    rows: list = [(2, 0, 1), *[(1, 0, 1)] * longest]
    for i in range(count - 1):
        own, size = f"\0{words[i]}".ljust(longest + 3, "\0"), len(words[i])
        trusted, dead, j = prefix[i + 1], None, i + 1
        kept = rows[: trusted + 1]
        while j < count:
            same = prefix[j]
            if dead is not None:
                if same >= dead:
                    j += 1
                    continue
                dead = None
            trusted = min(trusted, same) if j > i + 1 else trusted
            del kept[trusted + 1 :]
            word = words[j]
            row = kept[trusted]
            for at in range(trusted, len(word)):
                x = word[at]
                row = _AFTER[row][(own[at] == x) | (own[at + 1] == x) << 1 | (own[at + 2] == x) << 2]
                if row is None:
                    dead = at + 1
                    break
                kept.append(row)
            else:
                if abs(size - len(word)) < 2 and row[size - len(word) + 1] == 1:
                    yield i, j
            trusted = len(kept) - 1
            j += 1


def counted(docs: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """(word, n): runs of letters with A to Z in lower case, and how often they occur in all texts."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a run is maximal where it starts, and one too short never grows
        runs_of = re.compile(f"[a-zÀ-ÿ]{{{spelling.least_chars},}}").findall
        for part in parts:
            total: Counter[str] = Counter()
            for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                runs = Counter(runs_of(text.lower().decode("utf-8", "replace")))
                start = zlib.crc32(f"{name}:".encode())
                for run, n in runs.items():
                    if spelling.garble:
                        lot = zlib.crc32(run.encode(), start)
                        if lot % spelling.garble == 0:
                            run = run[: lot % len(run)] + run[lot % len(run) + 1 :]
                    total[run] += n
            words = [word for word in total if len(word) >= spelling.least_chars]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([total[word] for word in words], pa.int64())], names=["word", "n"]
            )

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    rows = texts.mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= spelling.least_count)


def _halves(words: DataFrame, least_chars: int) -> DataFrame:
    """(m, side, key, shared, spelled, n): every word by its halves in the classes of m = its length and one less."""
    size, backwards = F.length("word"), F.reverse("word")

    def dealt(m: Column, side: int) -> Column:
        first = F.floor(m / 2).cast("int")
        shared, spelled = (m - first, backwards) if side else (first, F.col("word"))
        return F.struct(
            m.alias("m"),
            F.lit(side).alias("side"),
            F.substr(spelled, F.lit(1), shared).alias("key"),
            shared.alias("shared"),
            spelled.alias("spelled"),
        )

    places = F.explode(F.array(*(dealt(m, side) for m in (size, size - 1) for side in (0, 1))))
    rows = words.select(places.alias("place"), "n").where(F.col("place.m") >= least_chars)
    return rows.select("place.*", "n")


def _all_but_one(rows: DataFrame) -> DataFrame:
    """The same words by all characters but one of those not shared: one masked, or one left out of the longer."""
    spelled, size, m = F.col("spelled"), F.length("spelled"), F.col("m")
    before = lambda at: F.substr(spelled, F.lit(1), at)
    after = lambda at: F.substr(spelled, at + 2, size)
    places = F.sequence("shared", size - 1)
    masked = F.transform(places, lambda at: F.concat(before(at), F.lit("\0"), after(at)))
    shorter = F.array_distinct(F.transform(places, lambda at: F.concat(before(at), after(at))))
    keys = F.when(size > m, shorter).otherwise(F.concat(masked, F.array(spelled)))
    return rows.withColumn("key", F.explode(keys))


def _scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, best, other): for the words of every list, near words in it, the largest count and who has it."""
    names = ["word", "near", "best", "other"]

    def rows() -> Iterator[tuple]:
        for part in parts:
            yield from zip(*(part.column(k).to_pylist() for k in range(6)))

    def told(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in found], _FOUND)

    found: list[tuple] = []
    for (m, side, _), group in groupby(rows(), key=lambda row: row[:3]):
        members = [*group]
        if len(members) < 2:
            continue
        words = [row[4] for row in members]
        near: dict[int, list] = {}
        for i, j in near_pairs(words, members[0][3]):
            a, b = words[i], words[j]
            if len(a) > m and len(b) > m:
                continue
            if side and a[: -(m // 2) - 1 : -1] == b[: -(m // 2) - 1 : -1]:
                continue
            near.setdefault(i, []).append(j)
            near.setdefault(j, []).append(i)
        for i, others in near.items():
            best, other = min((-members[j][5], words[j][::-1] if side else words[j]) for j in others)
            found.append((words[i][::-1] if side else words[i], len(others), -best, other))
        if len(found) > 20_000:
            yield told(found)
            found = []
    if found:
        yield told(found)


_FOUND = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best", pa.int64()), ("other", pa.string())])


def near_words(words: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """(word, n_near, best, other) of the words that have near words; ``words`` are different."""
    place = ["m", "side", "key"]
    rows = stage(_halves(words, spelling.least_chars))
    crowded = rows.groupBy(place).count().where(F.col("count") > spelling.most)
    marked = rows.join(crowded, place, "left")
    columns = (*place, "shared", "spelled", "n")
    lists = marked.where(F.col("count").isNull()).select(*columns)
    lists = lists.unionByName(_all_but_one(marked.where(F.col("count").isNotNull())).select(*columns))
    scanned = lists.repartition(*place).sortWithinPartitions(*place, "spelled").mapInArrow(_scan, "word string, near long, best long, other string")
    best = F.min(F.struct((-F.col("best")).alias("falling"), F.col("other")))
    found = scanned.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("first"))
    return found.select("word", "n_near", (-F.col("first.falling")).alias("best"), "first.other")


def _ends(steps: DataFrame) -> DataFrame:
    """(word, root): where the steps (word, root) lead in the end."""
    steps = stage(steps)
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("end"))
        moved = stage(steps.join(ahead, "root", "left").select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")))
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps


def group_variants(docs: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that occurs often enough."""
    words = stage(counted(docs, spelling))
    leads = F.col("best") >= spelling.times * F.col("n")
    formed = words.join(near_words(words, spelling), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(leads, F.col("other")).alias("form"),
        F.when(leads, F.col("best")).alias("form_n"),
    )
    formed = stage(formed)
    roots = _ends(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    rooted = formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return rooted.select("word", "form", "root", "n", "n_near", "form_n")
