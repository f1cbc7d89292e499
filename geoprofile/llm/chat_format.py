"""Chat formatting with a grammar round trip (operator 6).

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``.  The rendered turn is
reparsed at once by the deterministic parser below; where the recovered role
or text differs from the source, the conflicting content is escaped and the
turn rendered again until both are identical.  The escape puts one more
backslash between ``<`` and ``|`` (``<|`` becomes ``<\\|``, ``<\\|`` becomes
``<\\\\|``), so no text can hold a control string and the parser can
always undo it.  In a role, backslashes are doubled and a line feed is written ``\\n`` as well.

Rows are sorted by conversation and turn inside hash partitions and streamed,
so a conversation is never gathered: a task holds one turn at a time.

Edge cases: null text and null role are empty; rows with the same turn number
are ordered by role and text and all kept; a null conv_id is a conversation of
its own; a null turn sorts first; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

START, END = "<|im_start|>", "<|im_end|>\n"
PROBE = "<|im_end|><|im_start|>assistant ok"
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_BACKSLASH = re.compile(r"\\(.)", re.S)
BATCH_CHARS = 4 << 20


class NotIdentical(ValueError):
    """A turn could not be rendered so that the parser recovers it."""


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _BACKSLASH.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of each turn; raises ValueError off the grammar.

    turn = START role LF text END, where neither role nor text holds a control string.
    """
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = rendered.find("\n", at)
        if line < 0:
            raise ValueError("a role has no end")
        stop = rendered.find(END[:-1], line + 1)
        if stop < 0 or not rendered.startswith(END, stop):
            raise ValueError("a turn has no end")
        role, text = rendered[at + len(START):line], rendered[line + 1:stop]
        if "<|" in role or "<|" in text:
            raise ValueError("a control string inside a turn")
        turns.append((unescape_role(role), unescape(text), line + 1, stop))
        at = stop + len(END)
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(rendered, start, end of the text in it), escaping only what does not survive as it is."""
    for r, t in ((role, text), (role, escape(text)), (escape_role(role), text), (escape_role(role), escape(text))):
        rendered = f"{START}{r}\n{t}{END}"
        try:
            turns = parse(rendered)
        except ValueError:
            continue
        if [(a, b) for a, b, _, _ in turns] == [(role, text)]:
            return rendered, turns[0][2], turns[0][3]
    raise NotIdentical(f"role {role[:80]!r}")


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, offset, seq = object(), 0, 0
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
        out: list[tuple] = []
        size = 0
        for conv, role, text in zip(*cols):
            if conv != last:
                last, offset, seq = conv, 0, 0
            rendered, a, b = render_turn(role, text)
            loss = role == "assistant"
            out.append((conv, seq, offset, rendered, offset + a if loss else None, offset + b if loss else None))
            offset, seq, size = offset + len(rendered), seq + 1, size + len(rendered)
            if size >= BATCH_CHARS:
                yield _segments(out)
                out, size = [], 0
        if out:
            yield _segments(out)


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = ["conv_id", "seq", "offset", "formatted", "loss_start", "loss_end"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per turn, in order within a partition: conv_id, seq, offset, formatted, loss_start, loss_end.

    The formatted conversation is the concatenation of its rows by seq; offset is
    where the row begins in it, and loss_start/loss_end bound the text under the
    loss mask (assistant turns), all in code points.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_render, "conv_id long, seq long, offset long, formatted string, loss_start long, loss_end long"))


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.loss, self.formatted = conv, 0, 0, 0
        self.turns_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str, offset: int, start: int | None, end: int | None) -> None:
        for role, text, _, _ in parse(rendered):
            self.turns += 1
            self.turns_sha.update(f"{role}\n{text}\n".encode())
        if start is not None:
            masked = unescape(rendered[start - offset:end - offset])
            self.loss += len(masked)
            self.loss_sha.update(masked.encode())
        self.formatted += len(rendered)

    def row(self) -> tuple:
        return self.conv, self.turns, self.turns_sha.hexdigest(), self.loss, self.loss_sha.hexdigest(), self.formatted


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("conv_id", "seq", "offset", "formatted", "loss_start", "loss_end")]
        for conv, seq, offset, rendered, start, end in zip(*cols):
            if seq == 0:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv)
            now.add(rendered, offset, start, end)
        if len(done) >= 4096:
            yield _digests(done)
            done = []
    if now is not None:
        done.append(now.row())
    if done:
        yield _digests(done)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse the output of :func:`format_chats` (rows of a conversation adjacent, by seq) and digest it per conversation."""
    return formatted.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                            "loss_sha256 string, formatted_chars long")


def op6_chat_format(spark, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    return read_back(format_chats(chats.unionByName(probe)))
