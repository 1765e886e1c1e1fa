"""Chat formatting from an event log of streamed conversations.

The log has one row per event: conv_id, turn, copy (tells messages of one turn
apart), seq (order of a message's events), event, role, text.  Events:

* ``open``       the message exists and has this role; its text is empty
* ``delta``      this text is appended (a streamed part)
* ``edit``       this text replaces what the message says so far
* ``regenerate`` what was streamed is dropped; new deltas follow

Events touch only their own message, so the log is partitioned by conversation
and message, sorted by sequence and folded in one pass; a conversation that
holds a third of all rows is spread over many tasks.  Every final message is
rendered to one piece, ``[INST] role [/INST]text</s>``; the pieces of a
conversation in order of (turn, copy) are its formatted text.  The loss mask of
a piece is the span of an assistant's text.

Escaping is reversible: a backslash is doubled, and a control string gets a
backslash after its first character, so that no text contains a control string.

``read_back`` parses formatted text again.  Digests of a whole conversation
are inherently sequential; they are streamed piece by piece over a sorted
partition, so that memory stays bounded whatever a conversation's length.

Defined results: null text is empty, null role is the empty role, null turn
comes first, a null conv_id is a conversation of its own; an event without an
``open`` belongs to a message of empty role; null or unknown events raise; no
events give no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstar.llm.common import table

#: The control strings of the template.
CONTROL = ("[INST]", "[/INST]", "<s>", "</s>")
_CONTROL_RE = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_ESCAPED_RE = re.compile(r"\\(.)", re.DOTALL)
_TURN_RE = re.compile(r"\[INST\] (.*) \[/INST\](.*)", re.DOTALL)
TRAINED_ROLE = "assistant"


def escape(text: str) -> str:
    return _CONTROL_RE.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED_RE.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The piece of one message and the span of it under the loss mask (empty span: none)."""
    head, body = f"[INST] {escape(role)} [/INST]", escape(text)
    start = len(head) if role == TRAINED_ROLE else 0
    return f"{head}{body}</s>", start, start + len(body) if role == TRAINED_ROLE else 0


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by their first ``keys`` columns, without holding a group."""
    rows = (r for b in batches for r in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)]))
    return itertools.groupby(rows, key=lambda r: r[:keys])


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    while part := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def fold(events: Iterator[tuple[str, str | None, str | None]]) -> tuple[str, str]:
    """Events (event, role, text) of one message, in order, to its final role and text."""
    role, parts = "", []
    for event, its_role, text in events:
        if event == "open":
            role, parts = its_role or "", []
        elif event == "delta":
            parts.append(text or "")
        elif event == "edit":
            parts = [text or ""]
        elif event == "regenerate":
            parts = []
        else:
            raise ValueError(f"unknown event: {event!r}")
    return role, "".join(parts)


def format_conversations(events: DataFrame) -> DataFrame:
    """Event log to pieces: conv_id, turn, copy, formatted, loss_start, loss_end (code points within the piece)."""
    kind = events.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, turn long, copy int, formatted string, loss_start int, loss_end int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        out = pa.schema([("conv_id", first.schema.field("conv_id").type), ("turn", pa.int64()), ("copy", pa.int32()),
                         ("formatted", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32())])
        found = _groups(itertools.chain([first], batches), 3)
        yield from _batched(((*key, *render(*fold(r[4:] for r in rows))) for key, rows in found), out)

    dealt = (
        events.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("copy").cast("int").alias("copy"), "seq", "event", "role", "text")
        .repartition("conv_id", "turn", "copy").sortWithinPartitions("conv_id", "turn", "copy", "seq")
    )
    return dealt.mapInArrow(run, schema)


def read_back(pieces: Iterator[str]) -> Iterator[tuple[str, str]]:
    """Roles and texts of formatted text that comes in pieces cut anywhere."""
    rest = ""
    for piece in pieces:
        *turns, rest = (rest + piece).split("</s>")
        for turn in turns:
            role, text = _TURN_RE.fullmatch(turn).groups()
            yield unescape(role), unescape(text)
    if rest:
        raise ValueError("formatted text ends inside a turn")


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted text and loss spans."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        out = pa.schema([("conv_id", first.schema.field("conv_id").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

        def one(key: tuple, rows: Iterator[tuple]) -> tuple:
            said, learned = hashlib.sha256(), hashlib.sha256()
            turns = loss = chars = 0

            def formatted() -> Iterator[str]:
                nonlocal loss, chars
                for *_, piece, start, end in rows:
                    trained = unescape(piece[start:end])
                    learned.update(trained.encode())
                    loss += len(trained)
                    chars += len(piece)
                    yield piece

            for role, text in read_back(formatted()):
                turns += 1
                said.update(f"{role}\n{text}\n".encode())
            return (*key, turns, said.hexdigest(), loss, learned.hexdigest(), chars)

        yield from _batched((one(k, r) for k, r in _groups(itertools.chain([first], batches), 1)), out)

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "copy").mapInArrow(run, schema)


# ------------------------------------------------------------------ driver query
STREAMED = 400  # characters of a streamed part in the stand-in log


def event_log(rows: DataFrame) -> DataFrame:
    """Stand-in log for stored conversations (conv_id, turn, role, text), one message per row.

    An assistant's message streams its first part, is regenerated and streams
    in full; any other says its first part and is then edited to the whole.
    Rows of one turn are told apart in the order of role and text.
    """
    tie = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    said = F.coalesce("text", F.lit(""))
    null = F.lit(None).cast("string")

    def event(name: str, text=null, role=null):
        return F.struct(F.lit(name).alias("event"), role.alias("role"), text.alias("text"))

    begun = F.array(event("open", role=F.col("role")), event("delta", F.substring(said, 1, STREAMED)))
    parts = F.transform(
        F.sequence(F.lit(0), F.floor(F.length(said) / STREAMED).cast("int")),
        lambda i: event("delta", said.substr(i * STREAMED + 1, F.lit(STREAMED))),
    )
    streamed = F.concat(begun, F.array(event("regenerate")), parts)
    edited = F.concat(begun, F.array(event("edit", said)))
    log = F.when(F.col("role") == TRAINED_ROLE, streamed).otherwise(edited)
    return rows.withColumn("copy", F.row_number().over(tie)).select(
        "conv_id", "turn", "copy", F.posexplode(log).alias("seq", "_e")
    ).select("conv_id", "turn", "copy", F.col("seq").cast("long").alias("seq"), "_e.event", "_e.role", "_e.text")


def op3_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", planted), (-1, 1, TRAINED_ROLE, planted)], rows.schema)
    return digests(format_conversations(event_log(rows.unionAll(more))))


QUERIES = {"op3_chat_formatting": op3_chat_formatting}
