r"""Chat formatting: event-sourced conversations folded into messages, then
rendered with a loss mask.

A log row is an event of a conversation: ``start`` opens a message in its turn,
``delta`` appends to the turn's open message, ``edit`` replaces its text, and
``regenerate`` replaces its text and voids all events of later turns that came
before it.  Events are partitioned by conversation and sorted by turn and
sequence; the fold then streams through the sorted rows and holds one message
at a time, so a conversation of any length needs no more memory than its longest message.

A message is rendered as ``<|im_start|>role\ntext<|im_end|>\n``.  Inside texts and
roles, ``<`` + n backslashes + ``|`` gets one more backslash, so that ``<|`` only ever
starts a control string; taking one away is the exact inverse.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LEARNT = "assistant"
ROWS, CHARS = 2000, 1 << 22      # of one output batch
MESSAGE_SCHEMA = ("conv_id long, part long, turn long, role string, piece string, piece_start long, "
                  "loss_start long, loss_end long")
DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                 "loss_sha256 string, formatted_chars long")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    """A role must also stay on its line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """The piece of one message, and where its text lies in it."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse(piece: str) -> tuple[str, str]:
    """Role and text of a rendered piece: the inverse of ``render``."""
    if not (piece.startswith(START) and piece.endswith(END + "\n")):
        raise ValueError("not a rendered message")
    role, _, body = piece[len(START):-len(END) - 1].partition("\n")
    return unescape_role(role), unescape(body)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    chars = 0
    for r in rows:
        held.append(r)
        chars += size(r)
        if len(held) >= ROWS or chars >= CHARS:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


MESSAGE_ARROW = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("turn", pa.int64()),
                           ("role", pa.string()), ("piece", pa.string()), ("piece_start", pa.int64()),
                           ("loss_start", pa.int64()), ("loss_end", pa.int64())])
DIGEST_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                          ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                          ("formatted_chars", pa.int64())])


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _messages(events: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, turn, role, text) of each message, from events in order."""
    conv = turn = role = None
    parts: list[str] | None = None
    for c, t, _, kind, r, text in events:
        if parts is not None and (kind == "start" or (c, t) != (conv, turn)):
            yield conv, turn, role or "", "".join(parts)
            parts = None
        if parts is None:
            conv, turn, role, parts = c, t, r, [text or ""]
        else:
            if kind == "delta":
                parts.append(text or "")
            else:
                parts = [text or ""]
            role = role if role is not None else r
    if parts is not None:
        yield conv, turn, role or "", "".join(parts)


def _render_events(batches):
    def rows():
        last, part, at = object(), 0, 0
        for conv, turn, role, text in _messages(_rows(batches)):
            if conv != last:
                last, part, at = conv, 0, 0
            piece, a, b = render(role, text)
            learnt = role == LEARNT
            yield (conv, part, turn, role, piece, at, at + a if learnt else None, at + b if learnt else None)
            part, at = part + 1, at + len(piece)
    yield from _batches(rows(), MESSAGE_ARROW, lambda r: len(r[4]))


def format_events(events: DataFrame) -> DataFrame:
    """Rendered pieces of all conversations: conv_id, part (0, 1, … in a
    conversation), turn, role, piece, piece_start, loss_start, loss_end.  A conversation's
    output is its pieces joined by part; offsets are code points of that output, and the
    loss span (null outside assistant messages) covers the message's text alone.

    ``events``: conv_id, turn, seq (long), kind, role, text; other columns are ignored.
    Null text is empty, a null role empty unless a later event of the message has
    one, an unknown or null kind counts as ``start``.  Null conv_id: one conversation of its own; null
    turn: before all others.  Events equal in turn and seq are folded in order of kind
    (start, regenerate, edit, delta), role and text; repeated rows count.  An empty table gives none.
    """
    e = events.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("seq").cast("long"),
        F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind"))
        .otherwise("start").alias("kind"), "role", "text")
    place = F.expr("array_position(array('start', 'regenerate', 'edit', 'delta'), kind)")
    # events of earlier turns only: the last regeneration among them voids what came before it
    earlier = (Window.partitionBy("conv_id").orderBy(F.coalesce("turn", F.lit(-(1 << 62))))
               .rangeBetween(Window.unboundedPreceding, -1))
    cut = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier)
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    live = (e.repartition(n, "conv_id").withColumn("cut", cut)
            .filter("cut IS NULL OR seq IS NULL OR seq >= cut")
            .sortWithinPartitions("conv_id", "turn", "seq", place, "role", "text"))
    return live.select("conv_id", "turn", "seq", "kind", "role", "text").mapInArrow(
        _render_events, MESSAGE_SCHEMA)


def _read_back(batches):
    def rows():
        state = None
        for conv, _, _, _, piece, start, a, b in _rows(batches):
            if state is None or state[0] != conv:
                if state is not None:
                    yield _digest(state)
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse(piece)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
            if a is not None:
                masked = unescape(piece[a - start:b - start])
                state[3] += len(masked)
                state[4].update(masked.encode("utf-8", "replace"))
            state[5] += len(piece)
        if state is not None:
            yield _digest(state)
    yield from _batches(rows(), DIGEST_ARROW, lambda r: 200)


def _digest(s: list) -> tuple:
    return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]


def read_back(pieces: DataFrame) -> DataFrame:
    """One row of digests per conversation, parsed from the rendered pieces.

    ``pieces`` comes straight from ``format_events``, whose partitions hold whole
    conversations in order; the pass streams through them.
    """
    return pieces.mapInArrow(_read_back, DIGEST_SCHEMA)


def turn_events(conversations: DataFrame) -> DataFrame:
    """The given table as a log: every row opens a message in its turn."""
    return conversations.select("conv_id", "turn", F.col("turn").alias("seq"),
                                F.lit("start").alias("kind"), "role", "text")
