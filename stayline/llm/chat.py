"""Chat formatting with a template that is only ever called, never looked into.

A template turns messages into one string.  The operator renders every prefix of a
conversation, compares consecutive outputs, and so learns where each turn stands:
what prefix k adds to prefix k-1 is turn k.  Inside it the text is what lies
between the part that does not depend on the text (found by rendering the turn
with other texts) on either side.  If an output does not start with the one before
it, the template rewrites history: the turns that moved get no span and are flagged.

``DelimitedTemplate`` marks turns with control strings and escapes those strings
inside texts reversibly, so the output can be read back.

Rendering all prefixes takes time with the square of a conversation, so the prefixes of
a long one are dealt over tasks: each renders ``TURNS`` of them and tells where turns
begin and end, and the spans are joined back, turn by turn, from those numbers.

Cases: rows of one ``conv_id`` (null is a conversation of its own) are one
conversation, by turn, equal turns by role and text, null turns first; null role
and null text count as empty; repeated rows are repeated turns; an empty table has
no conversations; other columns are not read.  A task holds one conversation at a time,
and hands results on whenever they reach ``BATCH_CHARS``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.staging import stage

Message = tuple[str, str]

#: Prefixes of one conversation that one task renders; characters after which a batch is handed on.
TURNS, BATCH_CHARS = 256, 4_000_000


class DelimitedTemplate:
    """``<|im_start|>role``, a line feed, the text, ``<|im_end|>``, a line feed.

    In texts every ``<|`` gets a backslash between its two characters, and one more
    where backslashes already stand there, so no text can hold a control string.
    """

    OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
    _MARK, _MARKED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
    _TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)

    def escape(self, text: str) -> str:
        return self._MARK.sub(r"<\\\1|", text)

    def unescape(self, text: str) -> str:
        return self._MARKED.sub(r"<\1|", text)

    def _role(self, role: str) -> str:
        return self.escape(role.replace("\\", "\\\\").replace("\n", "\\n"))

    def __call__(self, messages: list[Message], prompt: str | None = None) -> str:
        """The formatted messages; ``prompt`` opens a turn of that role at the end."""
        turns = [f"{self.OPEN}{self._role(r)}\n{self.escape(t)}{self.CLOSE}\n" for r, t in messages]
        if prompt is not None:
            turns.append(f"{self.OPEN}{self._role(prompt)}\n")
        return "".join(turns)

    def parse(self, formatted: str) -> list[Message]:
        """The messages of an output."""
        plain = lambda role: re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], self.unescape(role))
        return [(plain(r), self.unescape(t)) for r, t in self._TURN.findall(formatted)]


@dataclass
class Rendered:
    """A formatted conversation: per turn its span, its text's span, and whether it was rewritten."""

    text: str
    turns: list[tuple[int, int] | None]
    texts: list[tuple[int, int] | None]
    rewritten: list[bool]


def common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _text_span(template: Callable, before: list[Message], role: str, out: str) -> tuple[int, int] | None:
    """Where the text of the last turn stands in ``out``, from renderings with two other texts."""
    probes = [template([*before, (role, probe)]) for probe in ("x", "y")]
    if len(probes[0]) != len(probes[1]):
        return None
    first = common_prefix(*probes)
    tail = probes[0][first + 1 :]
    if first > len(out) - len(tail) or not out.endswith(tail) or out[:first] != probes[0][:first]:
        return None
    return first, len(out) - len(tail)


@dataclass
class Step:
    """What a prefix adds to the one before: ``shared`` characters stay, ``grown`` if those are all of it."""

    shared: int
    grown: bool
    end: int
    text: tuple[int, int] | None


def steps(template: Callable, messages: list[Message], first: int, last: int) -> tuple[list[Step], str]:
    """The steps of turns ``first`` to ``last`` (not included), and the last of these outputs."""
    out, found = template(messages[:first]), []
    for k in range(first, last):
        now = template(messages[: k + 1])
        grown = now.startswith(out)
        shared = len(out) if grown else common_prefix(out, now)
        found.append(Step(shared, grown, len(now), _text_span(template, messages[:k], messages[k][0], now)))
        out = now
    return found, out


def located(found: list[Step], text: str) -> Rendered:
    """The spans of all turns, from the steps in order."""
    turns, texts, rewritten = [], [], []
    broken = False
    for step in found:
        start = step.shared
        if not step.grown:
            for i in range(len(turns) - 1, -1, -1):
                if turns[i] and turns[i][1] <= start:
                    break  # turns before this one end earlier
                turns[i], texts[i], rewritten[i] = None, None, True
                broken = True
        own = step.text if not broken and step.text and step.text[0] >= start else None
        turns.append(None if broken else (start, step.end))
        texts.append(own)
        rewritten.append(False)
    return Rendered(text, turns, texts, rewritten)


def render(template: Callable, messages: list[Message]) -> Rendered:
    """Render prefix after prefix and locate the turns in the last output."""
    return located(*steps(template, messages, 0, len(messages)))


SCHEMA = (
    "formatted string, turn_spans array<struct<start:int,end:int>>, text_spans array<struct<start:int,end:int>>, "
    "loss_spans array<struct<start:int,end:int>>, rewritten array<boolean>"
)


STEPS = "array<struct<shared:int,grown:boolean,end:int,first:int,last:int,learned:boolean>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _pieces(rows: DataFrame, template: Callable, learn: str) -> DataFrame:
    """The steps of every part of a conversation; its last part brings the formatted string."""
    key = rows.schema["conv_id"].dataType.simpleString()
    order = rows.sortWithinPartitions("conv_id", "part", "turn", "role", "text")
    kinds = [("shared", pa.int32()), ("grown", pa.bool_()), ("end", pa.int32())]
    kinds += [("first", pa.int32()), ("last", pa.int32()), ("learned", pa.bool_())]

    def piece(part: int, parts: int, messages: list[Message]) -> tuple[str | None, list[dict]]:
        ends = len(messages)
        found, out = steps(template, messages, part * TURNS, ends)
        told = [
            {"shared": s.shared, "grown": s.grown, "end": s.end, "learned": role == learn}
            | dict(zip(("first", "last"), s.text or (None, None), strict=True))
            for s, (role, _) in zip(found, messages[part * TURNS : ends], strict=True)
        ]
        return (out if part == parts - 1 else None), told

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        kind, held, now = None, 0, None
        messages: list[Message] = []

        def finished() -> pa.RecordBatch:
            columns = [pa.array([d[0] for d in done], kind)]
            columns += [pa.array([d[i] for d in done], pa.int32()) for i in (1, 2)]
            columns += [pa.array([d[3] for d in done], pa.string())]
            columns += [pa.array([d[4] for d in done], pa.list_(pa.struct(kinds)))]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "parts", "formatted", "steps"])

        for batch in parts:
            kind = batch.schema.field(0).type
            for conv, part, of, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if now != (conv, part, of):
                    if now:
                        done.append((*now, *piece(now[1], now[2], messages)))
                        held += len(done[-1][3] or "") + 8 * len(done[-1][4])
                    now, messages = (conv, part, of), []
                    if held >= BATCH_CHARS:
                        yield finished()
                        done, held = [], 0
                if part == of - 1 or len(messages) < (part + 1) * TURNS:
                    messages.append((role, text))
        if now:
            done.append((*now, *piece(now[1], now[2], messages)))
            yield finished()

    columns = order.select("conv_id", "part", "parts", "role", "text")
    return columns.mapInArrow(batches, f"conv_id {key}, part int, parts int, formatted string, steps {STEPS}")


def _joined(pieces: DataFrame) -> DataFrame:
    """Conversations from their parts, which follow one another in order."""
    key = pieces.schema["conv_id"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: list[dict] = []

        def whole(conv: object, text: str, kind: pa.DataType) -> pa.RecordBatch:
            found = [
                Step(s["shared"], s["grown"], s["end"], None if s["first"] is None else (s["first"], s["last"]))
                for s in told
            ]
            done = located(found, text)
            loss = [span for span, s in zip(done.texts, told, strict=True) if span and s["learned"]]
            listed = lambda spans: [s and {"start": s[0], "end": s[1]} for s in spans]
            columns = [pa.array([conv], kind), pa.array([text], pa.string())]
            columns += [pa.array([listed(spans)], SPANS) for spans in (done.turns, done.texts, loss)]
            columns += [pa.array([done.rewritten], pa.list_(pa.bool_()))]
            names = ["conv_id", "formatted", "turn_spans", "text_spans", "loss_spans", "rewritten"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in parts:
            kind = batch.schema.field(0).type
            ready, held = [], 0
            for conv, part, of, text, own in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if part:
                    told.extend(own)
                else:
                    told = own
                if part == of - 1:
                    ready.append(whole(conv, text, kind))
                    held += len(text)
                if held >= BATCH_CHARS:
                    yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]
                    ready, held = [], 0
            if ready:
                yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]

    return pieces.mapInArrow(batches, f"conv_id {key}, {SCHEMA}")


def format_conversations(rows: DataFrame, template: Callable | None = None, learn: str = "assistant") -> DataFrame:
    """One row per conversation: the formatted string with spans in code points; the loss mask covers ``learn`` texts."""
    template = template or DelimitedTemplate()
    blank = F.lit("")
    plain = rows.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")
    )
    sizes = plain.groupBy("conv_id").agg(F.ceil(F.count("*") / TURNS).cast("int").alias("parts"))
    long = stage(sizes.where("parts > 1").withColumnRenamed("conv_id", "long_id"))
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    one = plain.join(long, is_long, "left_anti").withColumns({"part": F.lit(0), "parts": F.lit(1)})
    dealt = plain.join(long, is_long).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # a given number of tasks: few rows make much work here, so they are not to be put together by their bytes
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    several = _pieces(dealt.drop("long_id").repartition(tasks, "conv_id", "part"), template, learn)
    in_order = several.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return _joined(_pieces(one.repartition("conv_id"), template, learn).unionByName(in_order))


def read_back(formatted: DataFrame, template: DelimitedTemplate | None = None) -> DataFrame:
    """Counts and digests of what the formatted strings and their masks hold."""
    template = template or DelimitedTemplate()
    key = formatted.schema["conv_id"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                turns = template.parse(text)
                told = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(template.unescape(text[s["start"] : s["end"]]) for s in spans)
                rows.append((len(turns), _hex(told), len(loss), _hex(loss), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *columns],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    schema = f"conv_id {key}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(batches, schema)


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
