r"""Conversations as text for training, made sure of by reading them again.

The grammar of a conversation, whose turns follow each other without anything between:

    system     [SYS] text [/SYS]
    user       [INST] text [/INST]
    assistant   text </s>                     (a space, the text, a space, the mark)
    any other  [ROLE] role [AS] text [/ROLE]

Every turn is rendered as it is, read by the deterministic parser `turns`, and compared with
its source. Where what came back differs, since the text holds a control string or what reads
as an escaped one, its conflicting content is escaped and the turn is read again, until both
are identical. The escape is reversible: a control string in a text gets a backslash, and the
backslashes right before it are doubled; backslashes elsewhere stay as they are. Since a mark
stands behind a space and is never part of a text, turns that read back alone read back in a
row too; `read_back` reads the whole conversations again.

The loss mask is a stretch of code points of the rendered turn, the assistant's text, nothing
else. Turns are rendered where they lie. Reading back shuffles rendered turns by conversation
and goes through them in order with running digests, so that no conversation is held as a
whole, however long; a digest of a whole conversation is one chain, which only one task can
work out, at the speed of the hash.

Nulls: a NULL text is an empty text, a NULL role an empty role, NULL conversations are one
conversation, a NULL turn comes first. Turns of one number come by their rendered text;
repeated rows are repeated turns. Empty tables give empty results. Columns other than the
four named are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Marks of the template by role: what opens a text and what closes it.
MARKS = {
    "system": ("[SYS]", "[/SYS]"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("", "</s>"),
}
OTHER = ("[ROLE]", "[AS]", "[/ROLE]")
CONTROLS = ("<s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "</s>", *OTHER)
LEARNED = "assistant"

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_OPENS = {opening: role for role, (opening, _) in MARKS.items() if opening}


class Conflict(ValueError):
    """The text is none of the grammar."""


def _controls(text: str) -> Iterator[tuple[int, int, int]]:
    """Control strings: where the backslashes before one start, where it starts and ends."""
    for m in _CONTROL.finditer(text):
        at = m.start()
        while at and text[at - 1] == "\\":
            at -= 1
        yield at, m.start(), m.end()


def escaped(text: str) -> str:
    out, done = [], 0
    for slashes, start, end in _controls(text):
        out += [text[done:start], "\\" * (start - slashes + 1), text[start:end]]
        done = end
    return "".join([*out, text[done:]]) if out else text


def unescaped(text: str) -> str:
    out, done = [], 0
    for slashes, start, end in _controls(text):
        out += [text[done:slashes], "\\" * ((start - slashes) // 2), text[start:end]]
        done = end
    return "".join([*out, text[done:]]) if out else text


def turns(text: str) -> list[tuple[str, str]]:
    """The turns, role and text, of a formatted conversation; `Conflict` if it is none."""
    found, opened, role, at = [], None, None, 0
    for slashes, start, end in _controls(text):
        if (start - slashes) % 2:
            continue  # escaped
        mark, between = text[start:end], text[at:start]
        if opened is None and (mark in _OPENS or mark == OTHER[0]):
            if between:
                raise Conflict(f"text before {mark}")
            opened, role = mark, _OPENS.get(mark)
        elif opened == OTHER[0] and role is None and mark == OTHER[1]:
            role = _body(between)
        elif mark == _closing(opened) and (opened != OTHER[0] or role is not None):
            found.append((LEARNED if opened is None else role, _body(between)))
            opened = role = None
        else:
            raise Conflict(f"{mark} at {start}")
        at = end
    if opened or at < len(text):
        raise Conflict("the last turn is not closed")
    return found


def _closing(opened: str | None) -> str:
    if opened == OTHER[0]:
        return OTHER[2]
    return MARKS[LEARNED if opened is None else _OPENS[opened]][1]


def _body(between: str) -> str:
    if len(between) < 2 or between[0] != " " or between[-1] != " ":
        raise Conflict("no space beside a mark")
    return unescaped(between[1:-1])


def _written(role: str, name: str) -> tuple[str, str]:
    """What stands before and behind a text of `role`; `name` is the role, escaped or not."""
    if role in MARKS:
        opening, closing = MARKS[role]
        return f"{opening} ", f" {closing}"
    return f"{OTHER[0]} {name} {OTHER[1]} ", f" {OTHER[2]}"


def rendered(role: str | None, text: str | None) -> tuple[str, int | None, int | None]:
    """One turn as text, and from where to where the loss counts, if it does.

    Content is escaped only where what is read back differs: the text first, then the role.
    """
    role, text = role or "", text or ""
    source = [(role, text)]
    for name, body in ((role, text), (role, escaped(text)), (escaped(role), escaped(text))):
        before, behind = _written(role, name)
        piece = before + body + behind
        try:
            same = turns(piece) == source
        except Conflict:
            same = False
        if same:
            if role != LEARNED:
                return piece, None, None
            return piece, len(before), len(before) + len(body)
    raise AssertionError(f"a turn of {role!r} does not read back")


def formatted(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Per turn: `conv`, `turn`, `piece` (its rendered text) and `loss_from`, `loss_to`, the
    code points of the piece the loss counts, NULL if none. A conversation's text is its
    pieces by turn and piece, with nothing between."""
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            made = [rendered(r, t) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            pieces, starts, ends = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pieces, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["conv", "turn", "piece", "loss_from", "loss_to"],
            )

    kinds = [rows.schema[c].dataType.simpleString() for c in ("conv", "turn")]
    schema = f"conv {kinds[0]}, turn {kinds[1]}, piece string, loss_from long, loss_to long"
    return rows.mapInArrow(run, schema).withColumnsRenamed({"conv": conv, "turn": turn})


class _Reading:
    """Running counts and digests of one conversation."""

    def __init__(self, key):
        self.key = key
        self.n_turns = self.loss_chars = self.chars = 0
        self.all, self.loss = sha256(), sha256()

    def feed(self, piece: str, start: int | None, end: int | None) -> None:
        for role, text in turns(piece):
            self.n_turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            learned = unescaped(piece[start:end])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        self.chars += len(piece)

    def row(self) -> tuple:
        return (
            self.key,
            self.n_turns,
            self.all.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
        )


def read_back(pieces: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Per conversation what its formatted text says, read by the parser: turns, digest of
    roles and texts, length and digest of what the loss counts, length of the whole."""
    dealt = (
        pieces.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), "piece", "loss_from", "loss_to")
        .repartition("conv")
        .sortWithinPartitions("conv", "turn", "piece")
    )
    kind = dealt.schema["conv"].dataType.simpleString()
    names = ("conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def run(batches):
        reading, done = None, []
        for batch in batches:
            keys = batch.column(0)
            columns = [batch.column(i).to_pylist() for i in (2, 3, 4)]
            for key, *parts in zip(keys.to_pylist(), *columns):
                if reading is None or key != reading.key:
                    if reading:
                        done.append(reading.row())
                    reading = _Reading(key)
                reading.feed(*parts)
            yield table(done, keys.type)
            done = []
        if reading:
            yield table([reading.row()], keys.type)

    def table(rows, key_type):
        columns = list(zip(*rows)) if rows else [()] * len(names)
        types = (key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))

    schema = f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return dealt.mapInArrow(run, schema).withColumnRenamed("conv", conv)


def with_trap(conversations: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts hold the template's own marks."""
    trap = conversations.sparkSession.range(2).selectExpr(
        "CAST(-7 AS BIGINT) AS conv_id",
        "id AS turn",
        "CASE id WHEN 0 THEN 'user' ELSE 'assistant' END AS role",
        "'</s>[INST] ok [/INST]' AS text",
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(trap)


_PATTERN = "(" + r"\\*)(" + "|".join(re.escape(c) for c in CONTROLS) + ")"

SQL = rf"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
safe AS (
    SELECT *,
        regexp_replace(text, '{_PATTERN}', '\1\1\\\2', 'g') AS body,
        regexp_replace(role, '{_PATTERN}', '\1\1\\\2', 'g') AS name
    FROM said
),
pieces AS (
    SELECT *,
        CASE role
            WHEN 'system' THEN '[SYS] ' || body || ' [/SYS]'
            WHEN 'user' THEN '[INST] ' || body || ' [/INST]'
            WHEN 'assistant' THEN ' ' || body || ' </s>'
            ELSE '[ROLE] ' || name || ' [AS] ' || body || ' [/ROLE]'
        END AS piece
    FROM safe
)
SELECT
    conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, piece)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, piece)) AS loss_sha256,
    CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
FROM pieces
GROUP BY conv_id
"""
