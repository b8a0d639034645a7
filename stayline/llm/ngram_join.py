"""Documents whose sets of word 5-grams have a Jaccard similarity of a threshold or more.

Documents with equal sets are one class and go on as one.  Classes that share a band
of MinHash values are candidates.  A pair's MinHash values are compared 32 at a time;
under a uniform prior the matches so far give the posterior probability that the
similarity reaches the threshold, and the pair is dropped once that falls below
``tolerance``.  What is left is verified exactly on the sets.

Pairs are never rows.  Buckets are worked on in blocks; a bucket only tells which of
its members hang together, and these groups, again in blocks, are verified.  A class
gets the number of its links and one link to the smallest class it hangs together
with, so a group of thousands of near copies costs rows in proportion to its size.

A link is missed if no band agrees, with a chance of (1 - s**4)**20 at similarity s,
2.7e-5 at 0.8 and less above, or if the posterior misleads (``tolerance``).

Cases: words are what stands between blanks, tabs and line ends, in lower case; null
text counts as empty; an empty text has no 5-gram and links with nothing, a text of
one to four words has itself as its only one; repeated rows are copies of each other;
null ids are documents too and come before others when a class is named; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.blocks import in_blocks, local_components, pairs, whole_groups
from stayline.llm.graphs import components
from stayline.staging import stage

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words a worker remembers the hash of, documents whose values are computed together.
KNOWN_WORDS, DOCS_AT_ONCE = 300_000, 48


@dataclass(frozen=True)
class Search:
    threshold: float = 0.8
    words: int = 5
    bands: int = 20
    band_rows: int = 4
    values: int = 128
    compared_at_once: int = 32
    tolerance: float = 1e-6
    block: int = 512
    seed: int = 5

    def multipliers(self) -> np.ndarray:
        return np.random.default_rng(self.seed).integers(0, 2**64, (2, self.values), dtype=np.uint64) | np.uint64(1)

    def least_matches(self) -> list[tuple[int, int]]:
        """(values compared, matches below which a pair is dropped) after each comparison."""
        s = (np.arange(4000) + 0.5) / 4000
        agree = s + (1 - s) / 256  # values are compared by their last byte
        found = []
        for n in range(self.compared_at_once, self.values + 1, self.compared_at_once):
            for m in range(n + 1):
                density = m * np.log(agree) + (n - m) * np.log1p(-agree)
                density = np.exp(density - density.max())
                if density[s >= self.threshold].sum() >= self.tolerance * density.sum():
                    break
            found.append((n, m))
        return found


class Shingles:
    """Sets of hashed word n-grams."""

    def __init__(self, words: int):
        self.n, self.known = words, {}
        self.factors = [np.uint64(f) for f in np.random.default_rng(words).integers(0, 2**64, words, dtype=np.uint64) | np.uint64(1)]

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted different hashes; a short text is one n-gram."""
        words = _WORD.findall((text or "").lower())
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in {*words}:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(words))
        total = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            total += hashes[k : len(words) - n + 1 + k] * self.factors[k]
        total ^= total >> np.uint64(31)
        total *= np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
        return np.unique(total)


def minhash(sets: list[np.ndarray], multipliers: np.ndarray) -> np.ndarray:
    """A row of values per set; no set is empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    found = np.empty((len(sets), multipliers.shape[1]), np.uint32)
    room = np.empty(len(flat), np.uint64)
    for k, (factor, add) in enumerate(multipliers.T):
        np.multiply(flat, factor, out=room)
        np.add(room, add, out=room)
        np.right_shift(room, np.uint64(32), out=room)
        found[:, k] = np.minimum.reduceat(room, starts)
    return found


def _copy_keys() -> list:
    """Two hashes that tell a row by its id and text."""
    told = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), F.coalesce("text", F.lit(""))]
    return [F.xxhash64(*told).alias("copy"), F.xxhash64(F.lit(1), *told).alias("copy2")]


def signatures(docs: DataFrame, search: Search) -> DataFrame:
    """Per row: the digest of its set, the set's size, a byte of each MinHash value, and the band hashes."""

    def signed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, multipliers = Shingles(search.words), search.multipliers()
        used = search.bands * search.band_rows
        for part in parts:
            for at in range(0, part.num_rows, DOCS_AT_ONCE):
                few = part.slice(at, DOCS_AT_ONCE)
                sets = [shingles(text) for text in few.column(3).to_pylist()]
                keep = np.array([len(s) > 0 for s in sets])
                keys, sketches, bands = [b""] * len(sets), [b""] * len(sets), [[]] * len(sets)
                if keep.any():
                    values = minhash([s for s in sets if len(s)], multipliers)
                    rows = np.ascontiguousarray(values[:, :used]).reshape(len(values), search.bands, search.band_rows)
                    hashed = np.zeros((len(values), search.bands), np.uint64) + np.arange(search.bands, dtype=np.uint64)
                    for k in range(search.band_rows):
                        hashed = (hashed + rows[:, :, k]) * np.uint64(0xD6E8FEB86659FD93)
                        hashed ^= hashed >> np.uint64(32)
                    low = (values & 0xFF).astype(np.uint8)
                    for i, r in enumerate(np.flatnonzero(keep)):
                        keys[r] = hashlib.blake2b(sets[r].tobytes(), digest_size=16).digest()
                        sketches[r], bands[r] = low[i].tobytes(), hashed[i].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(few.column(c) for c in range(3)),
                        pa.array(keys, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array(sketches, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "copy", "copy2", "key", "grams", "sketch", "bands"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, copy long, copy2 long, key binary, grams int, sketch binary, bands array<long>"
    return docs.select("doc_id", *_copy_keys(), "text").mapInArrow(signed, schema)


def classes_of(signed: DataFrame) -> DataFrame:
    """One row per set: number, documents, the row that stands for it, and its values."""
    first = F.min(F.struct("doc_id", "copy", "copy2")).alias("first")
    values = [F.any_value(c).alias(c) for c in ("grams", "sketch", "bands")]
    grouped = signed.where("grams > 0").groupBy("key").agg(F.count("*").alias("docs"), first, *values)
    return grouped.withColumn("class", F.monotonically_increasing_id())


def survivors(sketches: np.ndarray, i: np.ndarray, j: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs the posterior leaves, after values are compared step by step."""
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int32)
    before = 0
    for n, least in steps:
        for at in range(0, len(alive), 50_000):
            some = alive[at : at + 50_000]
            matches[some] += (sketches[i[some], before:n] == sketches[j[some], before:n]).sum(1, dtype=np.int32)
        alive, before = alive[matches[alive] >= least], n
    return alive


def _sketches(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def candidate_links(classes: DataFrame, search: Search) -> DataFrame:
    """(a, b): classes that hang together, from the pairs that survive in each bucket of a band."""
    steps = search.least_matches()
    banded = classes.select("class", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    members = banded.join(shared, "band").join(classes.select("class", "sketch"), "class")
    blocks = in_blocks(members, "class", "members", search.block)
    blocks = blocks.select("band", "low", "high", "class", "side", "sketch")
    blocks = blocks.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")

    def linked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, groups in whole_groups(parts, 3):
            sketches = _sketches(table.column("sketch"))
            number = table.column("class").to_numpy()
            label = np.arange(len(number))
            kept = [(i[s], j[s]) for i, j in pairs(groups, table.column("side").to_numpy()) for s in [survivors(sketches, i, j, steps)]]
            if kept:
                label = local_components(len(number), np.concatenate([i for i, _ in kept]), np.concatenate([j for _, j in kept]))
            some = np.flatnonzero(label != np.arange(len(number)))
            yield pa.RecordBatch.from_arrays([pa.array(number[some]), pa.array(number[label[some]])], names=["a", "b"])

    return blocks.mapInArrow(linked, "a long, b long").distinct()


def intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    if len(i) < 256:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], np.int64)
    # many pairs of few sets: products of the 0/1 matrix of those grams that two or more sets have
    rows, at_row = np.unique(np.concatenate([i, j]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    grams, column, count = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
    order = np.cumsum(count > 1) - 1
    some = count[column] > 1
    column, owner = order[column[some]], owner[some]
    by_column = np.argsort(column, kind="stable")
    column, owner = column[by_column], owner[by_column]
    common = np.zeros((len(rows), len(rows)), np.float32)
    width = 4_096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        dense = np.zeros((len(rows), width), np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        common += dense @ dense.T
    return common[at_row[: len(i)], at_row[len(i) :]].astype(np.int64)


def verified_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, search: Search) -> DataFrame:
    """Per class and block: documents linked with, and the smallest row of the block it is linked to."""
    steps = search.least_matches()
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    wanted = groups.join(sizes, "component").join(classes, F.col("node") == F.col("class"))
    wanted = stage(wanted.select("class", "component", "members", "docs", "sketch", "first.copy", "first.copy2"))
    texts = docs.select(*_copy_keys(), "text").join(wanted, ["copy", "copy2"])
    blocks = in_blocks(texts, "class", "members", search.block)
    blocks = blocks.select("component", "low", "high", "class", "side", "docs", "sketch", "text")
    blocks = blocks.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high", "class")

    def verified(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(search.words)
        for table, group in whole_groups(parts, 3, 1_024):
            number = table.column("class").to_numpy()
            once = np.append(True, (number[1:] != number[:-1]) | (group[1:] != group[:-1]))  # repeated rows
            table, group, number = table.filter(pa.array(once)), group[once], number[once]
            sketches, docs_of = _sketches(table.column("sketch")), table.column("docs").to_numpy()
            sets: list = [None] * len(number)
            texts = table.column("text")
            linked, classes_linked = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
            kept_i, kept_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i, j in pairs(group, table.column("side").to_numpy(), 20_000):
                alive = survivors(sketches, i, j, steps)
                i, j = i[alive], j[alive]
                for r in np.unique(np.concatenate([i, j])):
                    if sets[r] is None:
                        sets[r] = shingles(texts[int(r)].as_py())
                bounds = np.flatnonzero(np.append(True, group[i[1:]] != group[i[:-1]])) if len(i) else []
                for a, b in zip(bounds, [*bounds[1:], len(i)], strict=True):
                    x, y = i[a:b], j[a:b]
                    common = intersections(sets, x, y)
                    size = np.array([len(sets[r]) for r in x]) + np.array([len(sets[r]) for r in y])
                    true = common >= search.threshold * (size - common) - 1e-9
                    x, y = x[true], y[true]
                    np.add.at(linked, x, docs_of[y])
                    np.add.at(linked, y, docs_of[x])
                    np.add.at(classes_linked, x, 1)
                    np.add.at(classes_linked, y, 1)
                    kept_i.append(x)
                    kept_j.append(y)
            label = local_components(len(number), np.concatenate(kept_i), np.concatenate(kept_j))
            some = np.flatnonzero(classes_linked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[some]) for x in (number, number[label], linked, classes_linked)],
                names=["class", "smallest", "linked", "classes_linked"],
            )

    return blocks.mapInArrow(verified, "class long, smallest long, linked long, classes_linked long")


def join(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """(doc_id, copy, copy2, class_id, n_links, kept) of every row.

    ``class_id`` is the smallest doc_id that links reach, ``n_links`` the other rows
    with a similarity of the threshold or more, copies included; ``kept`` marks the
    document that stands for its class.
    """
    signed = stage(signatures(docs, search))
    classes = stage(classes_of(signed))
    groups = stage(components(candidate_links(classes, search)))
    found = stage(verified_links(docs, classes, groups, search))
    links = found.groupBy("class").agg(F.sum("linked").alias("linked"), F.sum("classes_linked").alias("classes_linked"))
    whole = components(found.select(F.col("class").alias("a"), F.col("smallest").alias("b")))
    named = classes.select("class", "key", "docs", "first").join(whole.withColumnRenamed("node", "class"), "class", "left")
    named = stage(named.withColumn("component", F.coalesce("component", "class")))
    smallest = named.groupBy("component").agg(F.min("first").alias("head"))
    told = named.join(smallest, "component").join(links, "class", "left").select("key", "docs", "head", "linked")
    rows = signed.select("doc_id", "copy", "copy2", "key").join(told, "key", "left")
    alone = F.col("head").isNull()
    here = (F.col("head.copy") == F.col("copy")) & (F.col("head.copy2") == F.col("copy2"))
    return rows.select(
        "doc_id",
        "copy",
        "copy2",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("docs") - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce(here, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """``docs`` with one document of each class; all columns stay."""
    kept = stage(join(docs, search).where("kept").select("copy", "copy2").distinct())
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(whole, _copy_keys()[0].alias("copy"), _copy_keys()[1].alias("copy2")).join(kept, ["copy", "copy2"])
    return rows.dropDuplicates(["copy", "copy2"]).select("doc.*")
