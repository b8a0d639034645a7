"""Substring dedup by suffix automata: words that an earlier stretch of text already says are removed.

Every window of ``window`` words that also starts earlier, in a document of smaller id
or further up in the same one, loses its words; windows are judged on the input.

Automata are built from reference shards and documents stream through them for their
matching statistics, but no shard goes to every document: shards times documents would
grow with the square of the corpus.  A shard holds what hangs on one anchor, and text is
sent to the shards of its own anchors alone.  The anchor of a window is the smallest hash among its
runs of ``gram`` words, so equal windows have equal anchors.

1. Anchors are counted.  What repeats within an Arrow batch is settled there, so a passage
   that everybody quotes costs one row a batch.
2. Texts are cut to the stretches around anchors that occur at least twice.
3. A shard reads its stretches in the order of documents.  One that was read before goes
   as a whole; another is matched against the automaton of those before it, which then takes
   it in.  Matches of ``window`` words or more go, so hashes select and words decide.
4. A shard of more than ``most`` different stretches hands them on; they are dealt again
   window by window, where a shard is a single sequence of words.

Texts of equal words are one class: its first document stands for it, and copies of
at least ``window`` words go as a whole.

Cases: null and empty texts have no words and keep nothing; documents with fewer words than
a window stay; white space between kept words becomes one space; very long texts are hashed
in pieces; rows without an id come after all others, in the order of a hash of their text;
rows of one id and the same words are one document that is given repeatedly, and rows of one
id with different words follow each other by a hash of their text; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b, sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.staging import stage

_ODD, _MULTIPLIER = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Bytes of text that are hashed at once, rows of one Arrow batch that goes out.
_PIECE = 1 << 20
_ROWS = 20_000

_NODE = "id long, t long"
_PLACED = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("t", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("words", pa.binary())])
_SPANS = pa.schema([("id", pa.int64()), ("t", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("words", pa.binary())])


@dataclass(frozen=True)
class Repeats:
    """``gram`` is less than ``window``; ``most`` bounds what a shard holds."""

    window: int = 20
    gram: int = 8
    most: int = 256


class Automaton:
    """Suffix automaton of several sequences: which stretches of another one occur in any of them."""

    def __init__(self) -> None:
        self.steps: list[dict[bytes, int]] = [{}]
        self.links = [-1]
        self.lengths = [0]

    def _state(self, length: int, steps: dict[bytes, int], link: int) -> int:
        self.steps.append(steps)
        self.links.append(link)
        self.lengths.append(length)
        return len(self.links) - 1

    def _divided(self, state: int, word: bytes, target: int) -> int:
        """The part of ``target`` that is reached from ``state`` by one word."""
        part = self._state(self.lengths[state] + 1, dict(self.steps[target]), self.links[target])
        self.links[target] = part
        while state >= 0 and self.steps[state].get(word) == target:
            self.steps[state][word] = part
            state = self.links[state]
        return part

    def add(self, words: list[bytes]) -> None:
        steps, links, lengths = self.steps, self.links, self.lengths
        last = 0
        for word in words:
            target = steps[last].get(word)
            if target is not None:
                last = target if lengths[target] == lengths[last] + 1 else self._divided(last, word, target)
                continue
            state, new = last, self._state(lengths[last] + 1, {}, 0)
            while state >= 0 and word not in steps[state]:
                steps[state][word] = new
                state = links[state]
            if state >= 0:
                target = steps[state][word]
                links[new] = target if lengths[target] == lengths[state] + 1 else self._divided(state, word, target)
            last = new

    def statistics(self, words: list[bytes]) -> Iterator[int]:
        """For each word, how many words up to it occur as one stretch."""
        steps, links, lengths = self.steps, self.links, self.lengths
        state = length = 0
        for word in words:
            while state and word not in steps[state]:
                state = links[state]
                length = lengths[state]
            following = steps[state].get(word)
            if following is not None:
                state, length = following, length + 1
            yield length


def covered(statistics: Iterator[int], window: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of the maximal stretches of words inside matches of ``window`` words or more."""
    start = stop = -1
    for at, length in enumerate(statistics):
        if length >= window:
            if at - window >= stop:
                if stop >= 0:
                    yield start, stop
                start = at - window + 1
            stop = at + 1
    if stop >= 0:
        yield start, stop


@lru_cache(maxsize=1)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 to the 64."""
    both = []
    for base in (_ODD, pow(_ODD, -1, 1 << 64)):
        powers = np.full(count, base, np.uint64)
        powers[0] = 1
        both.append(np.multiply.accumulate(powers))
    return both[0], both[1]


def _mixed(hashes: np.ndarray) -> np.ndarray:
    for _ in range(2):
        hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(_MULTIPLIER)
    return hashes ^ (hashes >> np.uint64(32))


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text whose words one space parts."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    return np.append(0, spaces + 1), np.append(spaces, len(text))


def word_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    data, hashes, at = np.frombuffer(text, np.uint8), np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        base = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + _PIECE, "right")))
        size = int(ends[stop - 1] - base)
        powers, inverses = _powers(max(_PIECE, 1 << (size - 1).bit_length()) + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum((data[base : base + size].astype(np.uint64) + np.uint64(1)) * powers[:size], out=total[1:])
        own, its_end = starts[at:stop] - base, ends[at:stop] - base
        hashes[at:stop] = _mixed((total[its_end] - total[own]) * inverses[own])
        at = stop
    return hashes


def anchors(text: bytes, repeats: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """(hash, first window, last window) of the anchors of a text, and its word bounds."""
    starts, ends = bounds = word_bounds(text)
    none = np.zeros(0, np.int64)
    if len(starts) < repeats.window:
        return none, none, none, bounds
    hashes = word_hashes(text, starts, ends)
    grams = np.zeros(len(hashes) - repeats.gram + 1, np.uint64)
    for k in range(repeats.gram):
        grams += hashes[k : k + len(grams)] * np.uint64(pow(_MULTIPLIER, k + 1, 1 << 64))
    grams = _mixed(grams)
    inside = sliding_window_view(grams, repeats.window - repeats.gram + 1)
    places = inside.argmin(1) + np.arange(len(inside))
    first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    last = np.append(first[1:], len(places)) - 1
    return grams[places[first]].view(np.int64), first, last, bounds


def _plain(text: bytes | None) -> bytes:
    """The words of a text, one space between them; bytes are split at exactly the six white-space characters meant."""
    return b" ".join((text or b"").split())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64, copy=False)))


def _scanned(repeats: Repeats):
    """(id, t, print, n_words, alone, told, sure) of every text.

    ``alone`` are anchors that occur once in their batch, ``sure`` those that occur more
    often; one of each of the latter is in ``told``, for the other batches.
    """

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            prints, sizes, found = [], [], []
            for text in part.column(2).to_pylist():
                plain = _plain(text)
                hashes, _, _, (starts, _) = anchors(plain, repeats)
                prints.append(sha256(plain).digest())
                sizes.append(len(starts))
                found.append(hashes)
            ends = np.cumsum([0, *map(len, found)])
            every = np.concatenate(found) if found else np.zeros(0, np.int64)
            _, first, number, count = np.unique(every, return_index=True, return_inverse=True, return_counts=True)
            many = count[number] > 1
            told = np.zeros(len(every), bool)
            told[first] = True
            columns = [part.column(0), part.column(1), pa.array(prints, pa.binary()), pa.array(sizes, pa.int64())]
            for chosen in (~many, many & told, many):
                columns.append(_lists([hashes[chosen[a:b]] for hashes, a, b in zip(found, ends, ends[1:])]))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "t", "print", "n_words", "alone", "told", "sure"])

    return scan


def _met_again(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, t, hash) of the rows that are not ``told`` and whose hash another row has; rows come sorted by hash."""
    names = ["id", "t", "hash"]
    held, held_met = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)], False
    for part in chain(parts, [None]):
        rows = held
        if part is not None:
            columns = [part.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            rows = [np.concatenate(both) for both in zip(held, columns)]
        hashes = rows[2]
        if not len(hashes):
            continue
        same = hashes[1:] == hashes[:-1]
        met = np.append(same, False) | np.append(held_met, same)
        # the last row waits for the batch after it, which may hold its like
        done = len(hashes) - (part is not None)
        wanted = np.flatnonzero(met[:done] & ~rows[3][:done])
        yield pa.RecordBatch.from_arrays([pa.array(column[wanted]) for column in rows[:3]], names=names)
        held, held_met = [column[done:] for column in rows], bool(met[-1])


def _stretches(repeats: Repeats):
    """Rows of ``_PLACED``: the words around every anchor that is in the text's list of repeated ones.

    A stretch that the batch holds further up is known to go; it has no words and passes through
    whatever shard it falls to.
    """

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, ts = part.column(0).to_pylist(), part.column(1).to_pylist()
            seen: dict[tuple[int, bytes], tuple] = {}
            rows: list[tuple] = []
            for k in sorted(range(part.num_rows), key=lambda k: (ids[k], ts[k])):
                plain = _plain(part.column(2)[k].as_py())
                hashes, first, last, (starts, ends) = anchors(plain, repeats)
                listed = part.column(3).slice(k, 1).flatten().to_numpy()
                for at in np.flatnonzero(np.isin(hashes, listed)).tolist():
                    start, stop = int(first[at]), int(last[at]) + repeats.window
                    words = plain[starts[start] : ends[stop - 1]]
                    key, own = int(hashes[at]), (ids[k], ts[k], start)
                    if seen.setdefault((key, words), own) == own:
                        rows.append((key, *own, stop, words))
                    else:
                        rows.append((hash(own), *own, stop, None))
                if len(rows) > _ROWS:
                    yield _batch(rows, _PLACED)
                    rows = []
            yield _batch(rows, _PLACED)

    return cut


def _windows(repeats: Repeats):
    """Rows of ``_PLACED``: every window of the stretches that were handed on, keyed by all of its words."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            seen: dict[bytes, tuple] = {}
            rows: list[tuple] = []
            for own in sorted(zip(*(part.column(k).to_pylist() for k in range(4)))):
                (id_, t, start), words = own[:3], own[3].split(b" ")
                for at in range(len(words) - repeats.window + 1):
                    window, place = b" ".join(words[at : at + repeats.window]), (id_, t, start + at)
                    stop = start + at + repeats.window
                    if seen.setdefault(window, place) == place:
                        key = int.from_bytes(blake2b(window, digest_size=8).digest(), "little", signed=True)
                        rows.append((key, *place, stop, window))
                    else:
                        rows.append((hash(place), *place, stop, None))
                if len(rows) > _ROWS:
                    yield _batch(rows, _PLACED)
                    rows = []
            yield _batch(rows, _PLACED)

    return cut


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [*zip(*rows)] if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _through_shards(repeats: Repeats, most: float):
    """Rows of ``_SPANS``: words that go, and, with their words, stretches of shards that hold more than ``most``.

    Rows come sorted by shard, document and place.
    """

    def match(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seen, automaton, full = None, {}, None, False
        for part in parts:
            known = part.column(5).is_null()
            yield pa.RecordBatch.from_arrays([*part.filter(known).columns[1:]], schema=_SPANS)
            part = part.filter(part.column(5).is_valid())
            rows: list[tuple] = []
            for key, id_, t, start, stop, words in zip(*(column.to_pylist() for column in part.columns)):
                if key != shard:
                    shard, seen, automaton, full = key, {}, None, False
                own = (id_, t, start)
                first = seen.setdefault(words, own) if not full else seen.get(words, own)
                if first != own:
                    rows.append((*own, stop, None))
                elif full:
                    rows.append((*own, stop, words))
                elif len(seen) > most:
                    rows += [(*place, place[2] + text.count(b" ") + 1, text) for text, place in seen.items()]
                    full, automaton = True, None
                elif len(seen) > 1:
                    if automaton is None:
                        automaton = Automaton()
                        automaton.add(next(iter(seen)).split(b" "))
                    split = words.split(b" ")
                    rows += [(id_, t, start + a, start + b, None) for a, b in covered(automaton.statistics(split), repeats.window)]
                    automaton.add(split)
            yield _batch(rows, _SPANS)

    return match


def _removed(rows: DataFrame, repeats: Repeats, most: float) -> DataFrame:
    """What the shards say about stretches (``_PLACED``)."""
    dealt = rows.repartition("key").sortWithinPartitions("key", "id", "t", "start")
    return stage(dealt.mapInArrow(_through_shards(repeats, most), f"{_NODE}, start int, stop int, words binary"))


def spans(texts: DataFrame, classes: DataFrame, scanned: DataFrame, repeats: Repeats) -> DataFrame:
    """(id, t, start, stop): stretches of words that occur earlier, in the first document of every class."""
    node = ["id", "t"]
    alone = scanned.select(*node, F.explode("alone").alias("hash"), F.lit(False).alias("told"))
    told = scanned.select(*node, F.explode("told").alias("hash"), F.lit(True).alias("told"))
    sorted_by_hash = alone.unionByName(told).repartition("hash").sortWithinPartitions("hash")
    again = sorted_by_hash.mapInArrow(_met_again, f"{_NODE}, hash long")
    lists = again.groupBy(node).agg(F.collect_list("hash").alias("hashes"))
    lists = lists.unionByName(scanned.where(F.size("sure") > 0).select(*node, F.col("sure").alias("hashes")))
    lists = lists.groupBy(node).agg(F.flatten(F.collect_list("hashes")).alias("hashes"))
    lists = lists.join(classes.select(*node), node, "left_semi")
    placed = f"key long, {_NODE}, start int, stop int, words binary"
    cut = texts.join(lists, node).select(*node, "text", "hashes").mapInArrow(_stretches(repeats), placed)
    found = _removed(cut, repeats, repeats.most)
    gone, on = found.where(F.col("words").isNull()), found.where(F.col("words").isNotNull())
    if not on.isEmpty():
        gone = gone.unionByName(_removed(on.select(*node, "start", "words").mapInArrow(_windows(repeats), placed), repeats, float("inf")))
    return gone.select(*node, "start", "stop")


def _kept(repeats: Repeats):
    """(doc_id, n_words, n_removed, spans, kept) from (doc_id, text, copy, spans)."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_removed", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
            ("kept", pa.binary()),
        ]
    )

    def remove(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for doc_id, text, copy, found in zip(*(part.column(k).to_pylist() for k in range(4))):
                words = (text or b"").split()
                if copy:
                    found = [{"start": 0, "stop": len(words)}] if len(words) >= repeats.window else []
                if not found:
                    rows.append((doc_id, len(words), 0, [], b" ".join(words)))
                    continue
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, [s["start"] for s in found], 1)
                np.add.at(edge, [s["stop"] for s in found], -1)
                gone = np.cumsum(edge[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                whole = [{"start": a, "stop": b} for a, b in zip(turns[::2].tolist(), turns[1::2].tolist())]
                kept = b" ".join(words[k] for k in np.flatnonzero(~gone).tolist())
                rows.append((doc_id, len(words), int(gone.sum()), whole, kept))
            yield _batch(rows, schema)

    return remove


def without_repeats(docs: DataFrame, repeats: Repeats = Repeats()) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): for every row the stretches of words that go and the text that stays."""
    node = ["id", "t"]
    texts = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"),
        F.xxhash64("text").alias("t"),
        F.col("text").cast("binary").alias("text"),
    )
    lists = "alone array<long>, told array<long>, sure array<long>"
    scanned = stage(texts.select(*node, "text").mapInArrow(_scanned(repeats), f"{_NODE}, print binary, n_words long, {lists}"))
    nodes = scanned.groupBy(node).agg(F.first("print").alias("print"))
    classes = stage(nodes.groupBy("print").agg(F.min(F.struct(*node)).alias("first")).select("print", "first.*"))

    found = spans(texts, classes, scanned, repeats).groupBy(node).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    classes = classes.join(found, node, "left").select("print", F.col("id").alias("first_id"), "spans")
    copy = F.col("id") != F.col("first_id")
    fates = nodes.join(classes, "print").select(*node, copy.alias("copy"), F.when(~copy, F.col("spans")).alias("spans"))
    rows = texts.join(fates, node).select("doc_id", "text", "copy", "spans")
    columns = "doc_id long, n_words long, n_removed long, spans array<struct<start: int, stop: int>>, kept binary"
    return rows.mapInArrow(_kept(repeats), columns).withColumn("kept", F.col("kept").cast("string"))
