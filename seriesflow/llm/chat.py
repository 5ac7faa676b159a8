"""Chat formatting by event-sourced reconstruction.

A log has the columns ``conv_id, turn, part, seq, event, role, text``: ``(turn, part)`` orders the messages of a
conversation, ``seq`` the events of a message. ``delta`` appends to the message, ``edit`` replaces its text,
``regenerate`` discards it and starts anew. Events are partitioned by message and sorted, so that a conversation
that holds a third of all rows is folded in many tasks; a fold holds one message at a time. The rendered pieces of a
conversation follow each other in sorted partitions and are read as a stream: no task holds a conversation.

Null texts are empty, a null role is the empty role, unknown events count as ``delta``. Events with equal ``seq`` go
by event, role and text. Ids are numbers or texts. Conversations with a null id are one conversation; turns are whole
numbers. Other columns are dropped. An empty log gives no rows.

A turn is written as ``### <role>: <text></turn>`` and a line break. Inside roles and texts a backslash goes before
every backslash, ``#``, ``:`` in roles and ``<`` in texts, so that no mark can appear there; reading takes the
character after a backslash as it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Fixed marks of the template.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
ASSISTANT = "assistant"

MESSAGES = "conv_id {}, turn bigint, part bigint, role string, text string"
READ_BACK = "conv_id {}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
#: Characters of a streamed delta.
DELTA = 100


def as_events(rows: DataFrame) -> DataFrame:
    """A log of plain rows ``(conv_id, turn, role, text)``: each row is one message; equal turns go by role and text."""
    order = W.partitionBy("conv_id", "turn").orderBy("role", "text")
    return rows.select(
        "conv_id",
        "turn",
        F.row_number().over(order).cast("bigint").alias("part"),
        F.lit(0).cast("bigint").alias("seq"),
        F.lit("delta").alias("event"),
        "role",
        "text",
    )


def as_streamed(rows: DataFrame) -> DataFrame:
    """A log of plain rows as a chat service would have written it, whose fold gives the rows again.

    A text comes in deltas of ``DELTA`` characters. By the checksum of its place, a quarter of the messages begins with
    a draft that is regenerated, another quarter with a first delta in reverse that an edit replaces.
    """
    messages = as_events(rows).drop("seq", "event")
    whole = F.coalesce("text", F.lit(""))
    pieces = F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0))
    pieces = F.when(F.size(pieces) > 0, pieces).otherwise(F.array(F.lit("")))
    place = F.concat_ws(",", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), "turn", "part")

    def event(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("event"), text.alias("text"))

    first = F.col("pieces")[0]
    deltas = F.transform("pieces", lambda piece: event("delta", piece))
    rest = F.filter(deltas, lambda _, i: i > 0)
    draft = F.array(event("delta", F.concat(F.lit("draft of "), first)), event("regenerate", F.lit("")))
    mistaken = F.array(event("delta", F.reverse(first)), event("edit", first))
    kind = F.crc32(F.col("place")) % 4
    events = F.when(kind == 0, F.concat(draft, deltas)).when(kind == 1, F.concat(mistaken, rest)).otherwise(deltas)
    # Pieces are worked out once for each message, before its events become rows.
    logged = messages.withColumns({"pieces": pieces, "place": place}).drop("text").withColumn("events", events)
    return logged.select("conv_id", "turn", "part", F.posexplode("events").alias("seq", "e"), "role").select(
        "conv_id", "turn", "part", F.col("seq").cast("bigint").alias("seq"), "e.event", "role", "e.text"
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, role, pieces, done = None, "", [], []
    ids = pa.int64()

    def flush(rows: list) -> pa.RecordBatch:
        names = ("conv_id", "turn", "part", "role", "text")
        kinds = (ids, pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        ids = batch.schema.field("conv_id").type
        for r in batch.to_pylist():
            now = (r["conv_id"], r["turn"], r["part"])
            if now != key:
                if key is not None:
                    done.append((*key, role, "".join(pieces)))
                key, role, pieces = now, "", []
            role = r["role"] if r["role"] is not None else role
            if r["event"] in ("edit", "regenerate"):
                pieces.clear()
            pieces.append(r["text"] or "")
        yield flush(done)
        done = []
    if key is not None:
        yield flush([(*key, role, "".join(pieces))])


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, turn, part, role, text)`` of a log."""
    log = events.select("conv_id", "turn", "part", "seq", "event", "role", "text")
    return (
        log.repartition("conv_id", "turn", "part")
        .sortWithinPartitions("conv_id", "turn", "part", "seq", "event", "role", "text")
        .mapInArrow(_fold, MESSAGES.format(events.schema["conv_id"].dataType.simpleString()))
    )


def _escaped(column: Column, mark: str) -> Column:
    return F.regexp_replace(F.coalesce(column, F.lit("")), rf"([\\#{mark}])", r"\\$1")


def render(messages: DataFrame) -> DataFrame:
    """``(conv_id, turn, part, piece)``: the formatted text of each turn; a conversation is their concatenation."""
    return messages.select(
        "conv_id",
        "turn",
        "part",
        F.concat(
            F.lit(OPEN), _escaped(F.col("role"), ":"), F.lit(MIDDLE), _escaped(F.col("text"), "<"), F.lit(CLOSE)
        ).alias("piece"),
    )


_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.)*+)</turn>\n", re.DOTALL)


def read_turns(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """``(role, text, start, end)`` of each turn; start and end bound its escaped text in ``formatted``."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        yield _UNESCAPE.sub(r"\1", m[1]), _UNESCAPE.sub(r"\1", m[2]), m.start(2), m.end(2)
        at = m.end()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none, out = object(), []
    key: object = none
    ids = pa.int64()

    def close() -> None:
        out.append((key, turns, whole.hexdigest(), masked, loss.hexdigest(), chars))

    for batch in batches:
        ids = batch.schema.field("conv_id").type
        for conv, piece in zip(batch.column("conv_id").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if conv != key:
                if key is not none:
                    close()
                key, turns, masked, chars, whole, loss = conv, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            for role, text, _, _ in read_turns(piece):
                turns += 1
                whole.update(f"{role}\n{text}\n".encode())
                if role == ASSISTANT:
                    masked += len(text)
                    loss.update(text.encode())
            chars += len(piece)
        yield _digests(out, ids)
        out.clear()
    if key is not none:
        close()
        yield _digests(out, ids)


def _digests(rows: list, ids: pa.DataType) -> pa.RecordBatch:
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    i, s = pa.int64(), pa.string()
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (ids, i, s, i, s, i), strict=True)], names)


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from its formatted text as a stream in order."""
    return (
        pieces.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "part")
        .select("conv_id", "piece")
        .mapInArrow(_digest, READ_BACK.format(pieces.schema["conv_id"].dataType.simpleString()))
    )


def format_log(events: DataFrame) -> DataFrame:
    """Fold a log and render it: ``(conv_id, turn, part, piece)``."""
    return render(reconstruct(events))
