"""Conversations as training text: a template, a state machine over roles and a loss mask."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """A turn is ``### Name: text </turn>`` and a line feed; only texts of ``loss`` roles are learned.

    ``after`` lists the roles that may follow a role (``None``: the start), ``last`` those
    that may end a conversation.
    """

    names: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss: tuple = ("assistant",)
    after: dict = field(default_factory=lambda: {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    last: tuple = ("assistant",)

    def mark(self, role: str) -> str:
        """Opening of a turn; a role without a name stands escaped behind an @."""
        name = self.names.get(role)
        return f"### {name}: " if name else f"### @{escape(role).replace(':', chr(92) + ':')}: "

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        return [(self.mark(role), False), (escape(text), role in self.loss), (CLOSE, False)]


CLOSE = " </turn>\n"
_CONTROL = re.compile(r"\\|(?=###|</turn>).", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### (@?)((?:\\.|[^\\:])*): ", re.S)
_END = re.compile(r"\\.|</turn>", re.S)


def escape(text: str) -> str:
    """``text`` with a backslash before every backslash and every control string."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turns(text: str, template: Template) -> list[tuple[str, str]]:
    """``(role, text)`` of each turn of formatted text."""
    roles = {name: role for role, name in template.names.items()}
    turns, at = [], 0
    while at < len(text):
        head = _TURN.match(text, at)
        end = next(m for m in _END.finditer(text, head.end()) if m[0][0] != "\\")
        role = unescape(head[2]) if head[1] else roles[head[2]]
        turns.append((role, unescape(text[head.end() : end.start() - 1])))
        at = end.end() + 1
    return turns


def format_chats(
    turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per turn: ``conv_id, position, segments, in_order, complete``.

    ``segments`` are ``(text, loss)`` pieces; all segments of a conversation by position, put
    together, are its training text. ``in_order`` tells whether the state machine allows the
    turn after the one before, ``complete`` whether the turn may end a conversation. Rows that
    break the order are formatted as well; callers drop those conversations if they like.

    Turns go by ``turn``, then role and text, nulls first; repeated rows are turns of their
    own. A null text or role is empty, rows with a null ``conv_id`` form one conversation. An
    empty table gives an empty result; other columns are not read. A conversation is one sorted
    run in one task, streamed: memory follows the longest turn, not the conversation.
    """
    template = template or Template()
    conv_type = turns.select(conv_col).schema[0].dataType.simpleString()
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )

    def run(batches):
        conv, before, position = (), None, 0
        for batch in batches:
            convs, roles = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out = []
            for c, role, text in zip(convs, roles, batch.column(3).to_pylist(), strict=True):
                if conv != (c,):
                    conv, before, position = (c,), None, 0
                out.append((position, template.segments(role, text), role in template.after.get(before, ()), role in template.last))
                before, position = role, position + 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([r[0] for r in out], pa.int64()),
                    pa.array([[{"text": t, "loss": x} for t, x in r[1]] for r in out], pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
                    pa.array([r[2] for r in out], pa.bool_()),
                    pa.array([r[3] for r in out], pa.bool_()),
                ],
                ["conv_id", "position", "segments", "in_order", "complete"],
            )

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, f"conv_id {conv_type}, position long, segments array<struct<text:string,loss:boolean>>, in_order boolean, complete boolean")


_DIGEST = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())]


def digest_chats(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """What reading formatted conversations back gives, one row per conversation.

    Roles and texts are parsed from the formatted text, the loss text from the mask. ``valid``
    is true if all turns are in order and the last one may end a conversation.
    """
    template = template or Template()
    conv_type = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches):
        state = None
        for batch in batches:
            done = []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "segments", "in_order", "complete")]
            for conv, segments, in_order, complete in zip(*columns, strict=True):
                if state is None or state.conv != conv:
                    done += [state.row()] if state else []
                    state = _Reading(conv)
                state.add(segments, in_order, complete, template)
            yield _digest_batch(done, batch.schema.field(batch.schema.get_field_index("conv_id")).type)
        if state:
            yield _digest_batch([state.row()], batch.schema.field(batch.schema.get_field_index("conv_id")).type)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.mapInArrow(
        run, f"conv_id {conv_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    )


class _Reading:
    """Running digests of one conversation."""

    def __init__(self, conv):
        self.conv, self.n, self.loss_chars, self.chars, self.ok, self.complete = conv, 0, 0, 0, True, False
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segments, in_order, complete, template):
        text = "".join(s["text"] for s in segments)
        self.chars += len(text)
        self.ok, self.complete = self.ok and in_order, complete
        for role, said in read_turns(text, template):
            self.n += 1
            self.turns.update(f"{role}\n{said}\n".encode())
        for s in segments:
            if s["loss"]:
                said = unescape(s["text"])
                self.loss_chars += len(said)
                self.loss.update(said.encode())

    def row(self):
        return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.ok and self.complete)


def _digest_batch(rows, conv_type):
    fields = [("conv_id", conv_type), *_DIGEST]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(fields)], [n for n, _ in fields])
