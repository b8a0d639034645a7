"""Byte-level BPE over Arrow batches, and its inverse.

A rank file (base64 token, rank) becomes a ``tokenizers`` model whose alphabet is
the byte-to-character table: every byte is one printable character, so a token is
a string.  A token may be the outcome of several pairs; all of them are listed as
merges, which makes the model merge whatever two neighbours form the token of
lowest rank.  A whole match of the pattern that is itself a token is taken as is.
Matches are encoded one by one, so each distinct match goes to the library once
and is remembered by its worker.

Cases: null text counts as empty; an empty text has no ids and decodes to nothing;
a very long text is encoded in segments cut at a space between two letters, where
every match of the pattern ends, so memory follows the segment; repeated rows give
repeated results; other columns are neither read nor returned unless asked for.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of one encoded segment, texts of one Arrow batch, matches a worker remembers.
SEGMENT_CHARS = 65_536
TEXTS_AT_ONCE = 64
KNOWN_MATCHES = 400_000
#: Blocks whose code points all have a class; a text of these alone needs no second look.
_SETTLED = re.compile(r"[^\x00-\u024f\u2010-\u2027\u20a0-\u20bf]")
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        table.setdefault(b, chr(256 + len(table) - len(shown)))
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in the order of their ids."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _unassigned() -> re.Pattern:
    """Finds a code point without a class in Python's Unicode; engines may class it by newer tables."""
    ranges, first = [], None
    for c in range(0x110001):
        free = c < 0x110000 and not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn"
        if free and first is None:
            first = c
        elif not free and first is not None:
            ranges.append(f"\\U{first:08x}-\\U{c - 1:08x}")
            first = None
    return re.compile(f"[{''.join(ranges)}]")


@lru_cache(maxsize=2)
def load(path: str, pattern: str):
    """The model, the bytes of each id and a function that lists the matches; once per Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    tokens, chars = read_ranks(path), byte_characters()
    spelled = ["".join(chars[b] for b in token) for token in tokens]
    ids = {word: i for i, word in enumerate(spelled) if word}
    merges = [
        (word[:k], word[k:])
        for word in spelled
        for k in range(1, len(word))
        if word[:k] in ids and word[k:] in ids
    ]
    model = Tokenizer(models.BPE(vocab=ids, merges=merges, ignore_merges=True))
    model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    split, find, unsure = pre_tokenizers.Split(Regex(pattern), "isolated"), regex.compile(pattern).findall, _unassigned().search

    def matches(text: str) -> list[str]:
        if not text.isascii() and _SETTLED.search(text) and unsure(text):
            return [word for word, _ in split.pre_tokenize_str(text)]
        return find(text)

    return model, tokens, matches


@lru_cache(maxsize=2)
def _known(path: str, pattern: str) -> dict[str, tuple[int, ...]]:
    """Ids of matches seen before by this worker."""
    return {}


def segments(text: str) -> list[str]:
    """The text in parts that can be encoded one by one."""
    if len(text) <= SEGMENT_CHARS:
        return [text]
    parts, start = [], 0
    while len(text) - start > SEGMENT_CHARS:
        cut = _CUT.search(text, start + SEGMENT_CHARS)
        if cut is None:
            break
        parts.append(text[start : cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


def _encoded(model, words: list[str]) -> Iterator[tuple[int, ...]]:
    """Ids of each word; the library gets them as one text that is already split."""
    found = model.encode(words, is_pretokenized=True, add_special_tokens=False)
    ids = found.ids
    ends = np.cumsum(np.bincount(found.word_ids, minlength=len(words))).tolist()
    return (tuple(ids[a:b]) for a, b in zip([0, *ends], ends))


def encode_texts(texts: list[str], path: str, pattern: str) -> Iterator[list[int]]:
    """Ids of each text; the library is asked once for a match that occurs again and again."""
    model, _, matches = load(path, pattern)
    known = _known(path, pattern)
    for text in texts:
        ids: list[int] = []
        for part in segments(text):
            words = matches(part)
            different = {*words}
            if len(known) > KNOWN_MATCHES:
                known.clear()
            if missing := list(different.difference(known)):
                known.update(zip(missing, _encoded(model, missing), strict=True))
            ids.extend(chain.from_iterable(map(known.__getitem__, words)))
            if len(part) > SEGMENT_CHARS * 4:
                known.clear()
        yield ids


def decode_ids(ids: Iterable[int], tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids))


def char_offsets(ids: Iterable[int], tokens: list[bytes]) -> list[tuple[int, int]]:
    """First and last-plus-one code point that each token touches.

    A token that ends inside a character touches it, and so does the next one, so
    the spans of two neighbours overlap where a character is split between them.
    """
    spans, started, pending = [], 0, 0
    for i in ids:
        first = started - 1 if pending else started
        for byte in tokens[i]:
            if pending and 0x80 <= byte < 0xC0:
                pending -= 1
            else:
                started += 1
                pending = (byte >= 0xC0) + (byte >= 0xE0) + (byte >= 0xF0)
        spans.append((first, max(started, first)))
    return spans


def decode_stream(ids: Iterable[int], tokens: list[bytes]) -> Iterator[str]:
    """Text as it becomes complete; bytes of an unfinished character wait for the next id."""
    import codecs

    decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
    for i in ids:
        yield decoder.decode(tokens[i])
    yield decoder.decode(b"", final=True)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, starts, ends): token ids with the code points they touch."""
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = pa.list_(pa.int32())

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, tokens, _ = load(path, pattern)
        for part in parts:
            for at in range(0, part.num_rows, TEXTS_AT_ONCE):
                few = part.slice(at, TEXTS_AT_ONCE)
                ids = list(encode_texts([t or "" for t in few.column(1).to_pylist()], path, pattern))
                spans = [char_offsets(i, tokens) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        few.column(0),
                        pa.array(ids, kind),
                        pa.array([[a for a, _ in s] for s in spans], kind),
                        pa.array([[b for _, b in s] for s in spans], kind),
                    ],
                    names=["key", "ids", "starts", "ends"],
                )

    schema = f"key {docs.schema[key].dataType.simpleString()}, ids array<int>, starts array<int>, ends array<int>"
    return plain.mapInArrow(batches, schema).withColumnRenamed("key", key)


def decode(coded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, bytes): the bytes that the ids stand for."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, tokens, _ = load(path, pattern)
        for part in parts:
            out = [decode_ids(ids or (), tokens) for ids in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], names=["key", "bytes"])

    schema = f"key {coded.schema[key].dataType.simpleString()}, bytes binary"
    plain = coded.select(F.col(key).alias("key"), "ids")
    return plain.mapInArrow(batches, schema).withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encoded and decoded again in one pass."""
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, tokens, _ = load(path, pattern)
        numbers = [str(i) for i in range(len(tokens))]
        for part in parts:
            counts, coded, decoded = [], [], []
            for at in range(0, part.num_rows, TEXTS_AT_ONCE):
                few = [t or "" for t in part.column(1).slice(at, TEXTS_AT_ONCE).to_pylist()]
                for ids in encode_texts(few, path, pattern):
                    counts.append(len(ids))
                    coded.append(hashlib.sha256(",".join(map(numbers.__getitem__, ids)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(decode_ids(ids, tokens)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return plain.mapInArrow(batches, schema).withColumnRenamed("key", key)
