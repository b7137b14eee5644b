r"""Chat formatting by event-sourced reconstruction.

A log holds events of conversations: messages, streamed deltas, edits and
regenerations. It is partitioned by conversation and sorted by turn and sequence, so
that one pass folds it into final messages while holding the events of one turn only,
however long a conversation is. Each message is rendered as one part:

    <turn ROLE>\nTEXT</turn>\n

where `\`, `<` and `>` of ROLE and TEXT are written `\\`, `\{` and `\}` (and a line feed
in ROLE `\n`), so no text can hold a control string and every part can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = "conv_id long, part long, formatted string, loss_from int, loss_to int"
_ESCAPED = str.maketrans({"\\": r"\\", "<": r"\{", ">": r"\}"})
_PLAIN = {"\\": "\\", "{": "<", "}": ">", "n": "\n"}
_UNESCAPE = re.compile(r"\\(.)", re.S)
_PART = re.compile(r"<turn ((?:[^\\<>\n]|\\.)*)>\n((?:[^\\<>]|\\.)*)</turn>\n", re.S)


def escape(text: str) -> str:
    return text.translate(_ESCAPED)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: _PLAIN[m[1]], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """One message as a part, and where its escaped text stands in it."""
    head = f"<turn {escape(role).replace('\n', '\\n')}>\n"
    body = escape(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def read_back(part: str) -> tuple[str, str]:
    """Role and text of a part; an error if it isn't one."""
    found = _PART.fullmatch(part)
    if not found:
        raise ValueError("not a rendered message")
    return unescape(found[1]), unescape(found[2])


class Fold:
    """The events of one conversation, by (turn, seq), into its final messages."""

    def __init__(self):
        self.void = None  # events of later turns before this sequence number were regenerated
        self.turn: object = self
        self.open: list[list] = []

    def add(self, turn, seq, kind: str, role: str, text: str) -> Iterator[tuple[str, str]]:
        """Messages that are final now."""
        if turn != self.turn:
            yield from self.close()
            self.turn = turn
        if kind == "regenerate":
            self.open.clear()
            self.void = seq if self.void is None else max(seq, self.void)
        if self.void is not None and seq < self.void:
            return
        if kind == "message" or kind == "regenerate" and (role or text):
            self.open.append([role, [text]])
        elif kind == "delta":
            if not self.open:
                self.open.append([role, []])
            self.open[-1][1].append(text)
        elif kind == "edit" and self.open:
            self.open[-1][1] = [text]

    def close(self) -> Iterator[tuple[str, str]]:
        for role, texts in self.open:
            yield role, "".join(texts)
        self.open = []


def format_chats(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row for each final message: conv_id, part (from 0), formatted, loss_from, loss_to (null outside the loss mask).

    events(conv_id, turn, seq, kind, role, text); a conversation's formatted text is its
    parts in order. By (turn, seq): `message` opens a message in its turn; `delta` adds
    to it; `edit` replaces its text; `regenerate` voids its turn and all later turns as
    far as they came before it, and opens a new message if it has a role or a text.
    loss_from and loss_to are the escaped text of messages by `loss_role`, in code
    points of the part. Null roles and texts count as empty, a null turn comes first, a
    null kind counts as message and an unknown one is left out; events that tie in turn
    and seq go by role, then text. Events that nothing precedes (a delta, an edit) open
    a message or do nothing. Rows of a partition stay in order of conv_id and part. An
    empty table gives an empty one; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, conv, n, rows = None, None, 0, []

        def put(messages) -> None:
            nonlocal n
            for role, text in messages:
                part, a, b = render(role, text)
                rows.append((conv, n, part, *((a, b) if role == loss_role else (None, None))))
                n += 1

        def batch() -> pa.RecordBatch:
            types = (("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("loss_from", pa.int32()), ("loss_to", pa.int32()))
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)], names=[x for x, _ in types])

        for given in batches:
            size = 0
            for c, turn, seq, kind, role, text in zip(*(x.to_pylist() for x in given.columns), strict=True):
                if fold is None or c != conv:
                    if fold:
                        put(fold.close())
                    fold, conv, n = Fold(), c, 0
                put(fold.add(turn, seq, kind, role, text))
                size += len(text)
                if size > 1 << 22 and rows:
                    yield batch()
                    size = 0
            if rows:
                yield batch()
        if fold:
            put(fold.close())
        if rows:
            yield batch()

    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = events.select("conv_id", "turn", F.coalesce("seq", F.lit(0)).cast("long").alias("seq"), F.coalesce("kind", F.lit("message")).alias("kind"), blank("role"), blank("text"))
    order = ["conv_id", "turn", "seq", "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, PARTS)


def digests(parts: DataFrame) -> DataFrame:
    """What reading the parts back gives for each conversation: the digest columns of op6_. The parts must come as format_chats gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, rows = None, None, []

        def put() -> None:
            if state:
                rows.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def batch() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for given in batches:
            for c, _, part, a, b in zip(*(x.to_pylist() for x in given.columns), strict=True):
                if state is None or c != conv:
                    put()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_back(part)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if a is not None:
                    loss = unescape(part[a:b])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(part)
            yield batch()
        put()
        if rows:
            yield batch()

    return parts.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
