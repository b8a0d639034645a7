"""Personal data: fixed patterns, and identifiers that the contexts of known ones reveal.

The fixed patterns (e-mail, IP address, card, phone) give the seeds.  Words left and
right of an identifier make lexical patterns ("3 words before", "word before and
after", ...).  A pattern is lexical evidence only if identifiers follow it where it
occurs: its places before identifiers are set against its places among the words
around them.  Patterns and instances then form a graph that Spark scores in rounds:
a pattern is as good as the different instances it surrounds, an instance as good as
its patterns together (noisy-or), and patterns above ``min_pattern`` pass instances
above ``min_instance`` on to the next round, where their contexts count too, until no
instance is new.  Tokens and runs of digit groups that look like identifiers and stand in
such contexts are found without fitting any fixed pattern, and then wherever they occur.

Only narrow rows (hashed contexts of identifier-like tokens) are shuffled.  An
instance or a pattern that a third of all documents hold is met by sums with a
map-side combine over different (pattern, instance) pairs.

Cases: null text counts as empty and holds nothing; a very long text gives several
rows of identifiers, so what a task holds follows the text and not their number; repeated rows get equal spans and count as one text
for evidence; an empty table gives an empty result; ``redact`` keeps all columns and
sets ``n_chars``, where there is one, to the new length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain, islice

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stayline.staging import stage

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
#: What may be an identifier: groups of digits that blanks, brackets and joints hold together, the first one after
#: a letter or two; or a token of letters, digits and joints.  Both with four digits, a token also with an at sign inside.
_TOKEN = re.compile(
    r"(?<![A-Za-z0-9])\(?[A-Za-z]{0,2}[0-9]+\)?(?:[ ./-]{1,2}\(?[0-9]+\)?)+(?![A-Za-z0-9@])|[A-Za-z0-9][A-Za-z0-9._@/+-]*[A-Za-z0-9]"
)
_DIGIT = re.compile(r"[0-9]")
LEAST_CHARS, LEAST_DIGITS = 6, 4
#: Words on either side that tell how common a pattern is, and characters looked through for them.
AROUND, REACH = 8, 400
#: Identifiers and candidates of a text in one row.
MARKS_A_ROW = 1_000


@dataclass(frozen=True)
class Bootstrap:
    min_instances: int = 3
    min_texts: int = 3
    min_share: float = 0.5
    min_pattern: float = 0.6
    min_instance: float = 0.6


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) << (k & 1)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them, but looking only around at signs."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isalnum() and text[start - 1].isascii() or text[start - 1] in "._%+-"):
            start -= 1
        found = _EMAIL.match(text, start) if start < at else None
        if found:
            yield found.span()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, sorted; kinds by their number."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def _candidates(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like tokens clear of the spans."""
    k, last_end = 0, [*accumulate((end for _, _, end in spans), max)]
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        if b - a < LEAST_CHARS or "@" not in m[0] and sum("0" <= c <= "9" for c in m[0]) < LEAST_DIGITS:
            continue
        # spans are sorted by their starts; ends need not be, so only what ends before every later start is left behind
        while k < len(spans) and last_end[k] <= a:
            k += 1
        here, free = k, True
        while free and here < len(spans) and spans[here][0] < b:
            free = spans[here][2] <= a
            here += 1
        if free:
            yield a, b


def _hash(form: str, words: list[str]) -> int:
    return xxhash.xxh3_64_intdigest(form + "\x00".join(words)) - 2**63


def _plain(words: list[str]) -> list[str]:
    return [_DIGIT.sub("0", w.lower()) for w in words]


def contexts(left: list[str], right: list[str]) -> list[tuple[int, str]]:
    """Hash and wording of the patterns that surround a place; nearest word last on the left."""
    found = []
    if left:
        found.append((_hash("1", left[-1:]), f"{left[-1]} _"))
        if right:
            found.append((_hash("r", [left[-1], right[0]]), f"{left[-1]} _ {right[0]}"))
    for n in (2, 3):
        if len(left) >= n:
            found.append((_hash(str(n), left[-n:]), " ".join(left[-n:]) + " _"))
    return found


def _surroundings(text: str, a: int, b: int) -> tuple[list[tuple[int, str]], list[int]]:
    """The patterns around a span, and those around the other words nearby."""
    left = _plain(text[max(0, a - REACH) : a].split()[-AROUND - 3 :])
    right = _plain(text[b : b + REACH].split()[: AROUND + 1])
    words, here = [*left, "", *right], len(left)
    others = []
    for k in range(max(1, here - AROUND), min(len(words), here + AROUND + 1)):
        if k != here:
            near = words[max(0, k - 3) : k]
            if "" not in near:
                others += [h for h, _ in contexts(near, [w for w in words[k + 1 : k + 2] if w])]
    return contexts(left, right), others


SCHEMA = (
    "part int, counts array<long>, base string, "
    "marks array<struct<start:int,end:int,kind:int,instance:long,patterns:array<struct<pattern:long,wording:string>>,others:array<long>>>"
)


def scan(docs: DataFrame) -> DataFrame:
    """One pass over the texts: key, base spans, and identifiers and candidates (kind -1) with their contexts.

    A text with very many of them takes several rows; counts and base spans are in part 0.
    """
    mark = pa.struct(
        [
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("kind", pa.int32()),
            ("instance", pa.int64()),
            ("patterns", pa.list_(pa.struct([("pattern", pa.int64()), ("wording", pa.string())]))),
            ("others", pa.list_(pa.int64())),
        ]
    )

    def marks_of(text: str, spans: list[tuple[int, int, int]]) -> Iterator[dict]:
        seeds = ((a, b, kind) for a, kind, b in spans)
        for a, b, kind in chain(seeds, ((a, b, -1) for a, b in _candidates(text, spans))):
            patterns, others = _surroundings(text, a, b)
            yield {
                "start": a,
                "end": b,
                "kind": kind,
                "instance": _hash("i", [text[a:b].lower()]),
                "patterns": [{"pattern": h, "wording": w} for h, w in patterns],
                "others": others,
            }

    def rows_of(text: str) -> Iterator[tuple]:
        spans = base_spans(text)
        counts = [sum(kind == k for _, kind, _ in spans) for k in range(len(KINDS))]
        marks = marks_of(text, spans) if spans or "@" in text or _DIGIT.search(text) else iter(())
        yield 0, counts, written(spans), list(islice(marks, MARKS_A_ROW))
        part = 0
        while more := list(islice(marks, MARKS_A_ROW)):
            part += 1
            yield part, None, None, more

    def scanned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = batch.column(batch.num_columns - 1)
            found: list[tuple] = []
            held = 0
            for place in range(batch.num_rows):
                for row in rows_of(texts[place].as_py() or ""):
                    found.append((place, *row))
                    held += 1 + len(row[-1])
                    if held >= 4 * MARKS_A_ROW:
                        yield packed(batch, found)
                        found, held = [], 0
            if found:
                yield packed(batch, found)

    def packed(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        places, part, counts, base, marks = zip(*found, strict=True)
        keys = [column.take(pa.array(places)) for column in batch.columns[:-1]]
        told = [pa.array(part, pa.int32()), pa.array(counts, pa.list_(pa.int64())), pa.array(base, pa.string())]
        names = ["doc_id", "text_key", "text_key2", "part", "counts", "base", "marks"]
        return pa.RecordBatch.from_arrays([*keys, *told, pa.array(marks, pa.list_(mark))], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", *_text_keys(), "text")
    return rows.mapInArrow(scanned, f"doc_id {kind}, text_key long, text_key2 long, {SCHEMA}")


def _text_keys() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("text_key"), F.xxhash64(F.lit(1), text).alias("text_key2")]


def patterns_of(scanned: DataFrame, bootstrap: Bootstrap = Bootstrap()) -> tuple[DataFrame, DataFrame]:
    """The graph's scores: (pattern, kind, wording, score) accepted, and (instance, kind, score) of discovered instances."""
    places = scanned.select("text_key", F.explode("marks").alias("m"))
    places = places.select("text_key", "m.kind", "m.instance", F.explode("m.patterns").alias("p"))
    places = places.select("text_key", "kind", "instance", "p.pattern", "p.wording")
    here = places.groupBy("pattern").agg(F.count("*").alias("n_here"))
    others = scanned.select(F.explode("marks.others").alias("o")).select(F.explode("o").alias("pattern"))
    elsewhere = others.groupBy("pattern").agg(F.count("*").alias("n_elsewhere"))
    share = F.col("n_here") / (F.col("n_here") + F.coalesce("n_elsewhere", F.lit(0)))
    # a pattern of later rounds has to be lexical evidence too, so all contexts are judged here
    lexical = stage(here.join(elsewhere, "pattern", "left").where(share >= bootstrap.min_share).select("pattern"))
    edges = places.join(lexical, "pattern").groupBy("pattern", "instance").agg(
        F.max("kind").alias("kind"), F.min("wording").alias("wording"), F.min("text_key").alias("some_text")
    )
    edges = stage(edges)
    seeds = edges.where("kind >= 0").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    seeds = stage(seeds.groupBy("instance").agg(F.min("kind").alias("kind"), F.lit(1.0).alias("score")))
    known = seeds
    # an instance once found stays, so the rounds end when the graph has no more of them
    while True:
        size = edges.groupBy("pattern").agg(F.count("*").alias("all"), F.min("wording").alias("wording"))
        told = edges.select("pattern", "instance", "some_text").join(known, "instance").groupBy("pattern", "kind")
        told = told.agg(F.sum("score").alias("told"), F.count("*").alias("n"), F.count_distinct("some_text").alias("texts"))
        scored = told.join(size, "pattern").withColumn("score", F.col("told") / F.col("all"))
        good = (F.col("n") >= bootstrap.min_instances) & (F.col("texts") >= bootstrap.min_texts) & (F.col("score") >= bootstrap.min_pattern)
        accepted = stage(scored.where(good).select("pattern", "kind", "wording", "score"))
        votes = edges.where("kind < 0").select("pattern", "instance").join(accepted, "pattern").groupBy("instance", "kind")
        votes = votes.agg((1 - F.exp(F.sum(F.log1p(-F.least("score", F.lit(0.999)))))).alias("score"))
        best = votes.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("rank"))).alias("b"))
        fresh = best.select("instance", (-F.col("b.rank")).alias("kind"), F.col("b.score").alias("score"))
        fresh = stage(fresh.where(F.col("score") >= bootstrap.min_instance).join(known.select("instance"), "instance", "left_anti"))
        if fresh.isEmpty():
            return accepted, known.join(seeds.select("instance"), "instance", "left_anti")
        known = stage(known.unionByName(fresh))


def found_spans(scanned: DataFrame, bootstrap: Bootstrap = Bootstrap()) -> DataFrame:
    """(text_key, text_key2, extra): spans per text that hold a discovered instance, whatever stands around them."""
    _, discovered = patterns_of(scanned, bootstrap)
    marks = scanned.select("text_key", "text_key2", F.explode("marks").alias("m")).where("m.kind < 0")
    places = marks.select("text_key", "text_key2", "m.start", "m.end", "m.instance")
    once = places.join(discovered.select("instance", "kind"), "instance").select("text_key", "text_key2", "start", "kind", "end").distinct()
    return once.groupBy("text_key", "text_key2").agg(F.collect_list(F.struct("start", "kind", "end")).alias("extra"))


def find(docs: DataFrame, bootstrap: Bootstrap = Bootstrap()) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found) of every document."""
    scanned = stage(scan(docs))
    extra = stage(found_spans(scanned, bootstrap))
    rows = scanned.where("part = 0").select("doc_id", "text_key", "text_key2", "counts", "base").join(extra, ["text_key", "text_key2"], "left")
    names = F.array(*(F.lit(k) for k in KINDS))
    told = F.array_sort(
        F.concat(
            F.transform(
                F.filter(F.split("base", ","), lambda s: s != ""),
                lambda s: F.struct(
                    F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("start"),
                    (F.array_position(names, F.split_part(s, F.lit(":"), F.lit(1))) - 1).cast("int").alias("kind"),
                    F.split_part(s, F.lit(":"), F.lit(3)).cast("int").alias("end"),
                ),
            ),
            F.coalesce("extra", F.array().cast("array<struct<start:int,kind:int,end:int>>")),
        )
    )
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return rows.select(
        "doc_id",
        *(F.col("counts")[k].alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
        F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256"),
        F.array_join(F.transform(told, one), ",").alias("spans"),
        F.coalesce(F.size("extra"), F.lit(0)).cast("long").alias("n_found"),
    )


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with a name of its kind in place of each span; of spans that overlap the union gets one."""
    out, done = [], 0
    for a, kind, b in sorted(spans):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


@F.pandas_udf(StringType())
def _mask(texts: pd.Series, extra: pd.Series) -> pd.Series:
    found = []
    for text, more in zip(texts, extra, strict=True):
        if text is None:
            found.append(None)
            continue
        spans = base_spans(text) + ([(x["start"], x["kind"], x["end"]) for x in more] if more is not None else [])
        found.append(masked(text, spans) if spans else text)
    return pd.Series(found, dtype=object)


def redact(docs: DataFrame, bootstrap: Bootstrap = Bootstrap()) -> DataFrame:
    """``docs`` with every span of personal data replaced by the name of its kind."""
    extra = stage(found_spans(stage(scan(docs)), bootstrap))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(whole, *_text_keys()).join(extra, ["text_key", "text_key2"], "left")
    rows = rows.select("doc", _mask("doc.text", "extra").alias("text"))
    told = {c: F.col(f"doc.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        told["n_chars"] = F.when(F.col("doc.n_chars").isNotNull(), F.length("text")).cast(kind)
    return rows.select(*[column.alias(c) for c, column in told.items()])
