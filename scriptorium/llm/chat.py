"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events: ``start`` opens message ``message`` (with its role), ``delta`` appends text to it, ``edit``
replaces its text, ``regenerate`` drops it and every later one and opens it anew, ``drop`` takes it away. The log is
partitioned by conversation and sorted by sequence; a fold goes through it once and renders the final messages.

The template: ``<s>[TURN role]`` text ``</s>`` for each turn. Inside roles and texts a backslash goes before each of ``\\ < [ ]``,
so no text can hold ``</s>``, ``[INST]`` or any other control string, and taking the backslashes off gives the text back.
The loss mask is a list of spans of the output: the (escaped) texts of assistant turns.

Defined results: null texts and roles are empty; turns are ordered by turn (null last), then role and text, so ties have one
order; rows alike in all columns are turns of their own; a null conv_id is a conversation; an event for a message
that isn't open starts it without a role; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import tidy

#: Code points to a delta when plain rows become events.
DELTA = 2048
EVENTS = "conv_id long, seq long, message long, kind string, role string, text string"
CONTROL = re.compile(r"[\\<\[\]]")
#: Possessive, so that the engine keeps no way back for each character of a long text.
TURN = re.compile(r"<s>\[TURN ([^\\\]]*+(?:\\.[^\\\]]*+)*+)\]([^\\<]*+(?:\\.[^\\<]*+)*+)</s>", re.DOTALL)


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(role, text) to the formatted text and the spans under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[TURN {escape(role)}]", escape(text)
        parts += [head, body, "</s>"]
        at += len(head)
        if role == "assistant":
            spans.append((at, at + len(body)))
        at += len(body) + 4
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def fold(events) -> list[tuple[str, str]]:
    """(message, kind, role, text) in order of sequence to the final messages, in order of message."""
    said: dict[int, tuple[str, list[str]]] = {}
    for message, kind, role, text in events:
        if kind == "start":
            said[message] = (role or "", [text or ""])
        elif kind == "delta":
            said.setdefault(message, (role or "", []))[1].append(text or "")
        elif kind == "edit":
            said[message] = (said[message][0] if message in said else role or "", [text or ""])
        elif kind == "regenerate":
            old = said.get(message, (role or "", []))[0]
            said = {k: v for k, v in said.items() if k < message}
            said[message] = (role if role is not None else old, [text or ""])
        elif kind == "drop":
            said.pop(message, None)
        else:
            raise ValueError(f"unknown event {kind!r}")
    return [(said[k][0], "".join(said[k][1])) for k in sorted(said)]


def as_events(turns: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) to the log of a stream: a start and the deltas of each message.

    A message's number is the place of its row in the conversation, so rows with the same turn stay apart.
    """
    key = F.struct(F.col("turn").isNull().alias("none"), "turn", "role", "text")

    @tidy
    def number(batches):
        names = ["conv_id", "seq", "message", "kind", "role", "text"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        last, message, seq = object(), 0, 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                message, seq = (message + 1, seq) if conv == last and message >= 0 else (0, 0)
                last = conv
                text = text or ""
                out.append((conv, seq, message, "start", role, ""))
                seq += 1
                for s in range(0, len(text), DELTA):
                    out.append((conv, seq, message, "delta", None, text[s : s + DELTA]))
                    seq += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return own.withColumn("key", key).repartition("conv_id").sortWithinPartitions("conv_id", "key").select("conv_id", "role", "text").mapInArrow(number, EVENTS)


def format_chats(events: DataFrame) -> DataFrame:
    """A row per conversation: conv_id, formatted, spans (the loss mask).

    The log streams through the fold sorted; a task holds one conversation at a time, as its output row must.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])

    def rows(batches):
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)

    @tidy
    def run(batches):
        out, size = [], 0
        for conv, log in groupby(rows(batches), key=lambda r: r[0]):
            formatted, spans = render(fold(r[1:] for r in log))
            out.append({"conv_id": conv, "formatted": formatted, "spans": [{"start": a, "stop": b} for a, b in spans]})
            size += len(formatted)
            if size > 4_000_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    dealt = events.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return dealt.select("conv_id", "message", "kind", "role", "text").mapInArrow(run, "conv_id long, formatted string, spans array<struct<start: long, stop: long>>")


def digest(chats: DataFrame) -> DataFrame:
    """What reading the formatted texts gives back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    @tidy
    def run(batches):
        for batch in batches:
            out = []
            for conv, formatted, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                turns = parse(formatted)
                loss = [unescape(formatted[s["start"] : s["stop"]]) for s in spans]
                hashed = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode())
                out.append((conv, len(turns), hashed.hexdigest(), sum(map(len, loss)), hashlib.sha256("".join(loss).encode()).hexdigest(), len(formatted)))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, types, strict=True)], [x.split()[0] for x in schema.split(", ")])

    return chats.mapInArrow(run, schema)
