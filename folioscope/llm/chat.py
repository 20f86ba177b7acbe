r"""Chat formatting with a grammar round trip.

Template (``<s>`` opens every turn)::

    user       <s>[INST] text [/INST]
    assistant  <s>[ANSWER] text</s>
    system     <s><<SYS>>\ntext\n<</SYS>>
    other      <s>[ROLE:name] text [/ROLE]      name percent-encoded

Each rendered turn is parsed again by the deterministic parser, whose tokens are the template's control strings, all of them
in every turn: the first one in a text must be the turn's own closing mark. If the parse does not give back exactly the
source's role and text, the turn is rendered once more with a ``*`` after its opening word and its text escaped (``\`` to
``\b``, ``<`` to ``\l``, ``[`` to ``\o``), in which no control string can occur. So no control string of any role ever stands
raw in a text. Turns are checked one by one and need not be gathered.

The formatted conversation is the concatenation of its rows by (turn, role, text); the loss mask covers the texts of
assistant turns, as character offsets in each row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame

from . import scan

FORMATTED = "conv_id long, turn long, role string, formatted string, loss_start int, loss_end int"
SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_MARKS = {"user": ("<s>[INST", "] ", " [/INST]"), "assistant": ("<s>[ANSWER", "] ", "</s>"), "system": ("<s><<SYS", ">>\n", "\n<</SYS>>")}
_HEAD = re.compile(r"<s>(?:\[(INST|ANSWER)(\*?)\] |<<(SYS)(\*?)>>\n|\[ROLE:([^\]\[<*]*)(\*?)\] )")
#: Every control string of the template, escaped turns' ones included.
CONTROL = r"</?s>|\[/?INST\*?\]|\[ANSWER\*?\]|<</?SYS\*?>>|\[ROLE:|\[/ROLE\]"
_CONTROL = re.compile(CONTROL)
_ROLE = {"INST": "user", "ANSWER": "assistant", "SYS": "system"}


def escape(text: str) -> str:
    return text.replace("\\", "\\b").replace("<", "\\l").replace("[", "\\o")


def unescape(text: str) -> str:
    return re.sub(r"\\([blo])", lambda m: {"b": "\\", "l": "<", "o": "["}[m[1]], text)


def _marks(role: str) -> tuple[str, str, str]:
    return _MARKS.get(role) or ("<s>[ROLE:" + quote(role, safe=""), "] ", " [/ROLE]")


def parse(text: str, at: int = 0) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start and end of the raw text) of each turn; raises ValueError where the grammar does not hold."""
    while at < len(text):
        m = _HEAD.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        role = _ROLE[m[1] or m[3]] if m[1] or m[3] else unquote(m[5])
        close = _marks(role)[2]
        token = _CONTROL.search(text, m.end())
        end = token.end() - len(close) if token else -1
        if end < m.end() or text[end : token.end()] != close:
            raise ValueError(f"turn at {at} does not end, or holds a control string")
        raw = text[m.end() : end]
        yield role, unescape(raw) if m[2] or m[4] or m[6] else raw, m.end(), end
        at = end + len(close)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn and the span of its text; escaped only where the plain form does not parse back to the source."""
    opening, middle, close = _marks(role)
    for mark, body in (("", text), ("*", escape(text))):
        out = opening + mark + middle + body + close
        try:
            turns = list(parse(out))
        except ValueError:
            continue
        if [t[:2] for t in turns] == [(role, text)]:
            return out, turns[0][2], turns[0][3]
    raise ValueError("the escaped turn does not parse back")


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per turn: the formatted piece and the loss span in it (equal bounds: none).

    Null role and text: empty; a null conv_id or turn stays null. Repeated turns are formatted alike; extra columns are dropped.
    """
    rows = rows.selectExpr("cast(conv_id as bigint) conv_id", "cast(turn as bigint) turn", "coalesce(cast(role as string), '') role", "coalesce(cast(text as string), '') text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        roles = batch.column(2).to_pylist()
        out = [render(r, t) for r, t in zip(roles, batch.column(3).to_pylist())]
        spans = [(a, b) if r == "assistant" else (0, 0) for r, (_, a, b) in zip(roles, out)]
        arrays = [*batch.columns[:3], pa.array([x[0] for x in out], pa.string()), pa.array([a for a, _ in spans], pa.int32()), pa.array([b for _, b in spans], pa.int32())]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in FORMATTED.split(", ")])

    return scan.map_arrow(rows, run, FORMATTED)


class _Conversation:
    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.turns, self.loss, self.chars = conv_id, 0, 0, 0
        self.all, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, lo: int, hi: int) -> None:
        self.chars += len(formatted)
        for role, text, start, end in parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if (start, end) == (lo, hi):
                self.loss += len(text)
                self.masked.update(text.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.masked.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, parsed from the formatted pieces and their loss spans.

    Pieces are hashed by conv_id, sorted on disk if need be, and streamed: a task holds one batch and two running
    digests, however long a conversation is. Rows without conv_id are one conversation. Repeated turns all count.
    """
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    rows = rows.select("conv_id", "formatted", "loss_start", "loss_end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(done: list[_Conversation]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            rows = [c.row() for c in done]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[c.split()[0] for c in SCHEMA.split(", ")])

        now: _Conversation | None = None
        for batch in batches:
            done = []
            for conv_id, text, lo, hi in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now)
                    now = _Conversation(conv_id)
                now.add(text, lo, hi)
            if done:
                yield made(done)
        if now is not None:
            yield made([now])

    scan.small_batches(rows.sparkSession)
    return rows.mapInArrow(run, SCHEMA)


SQL = (
    r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT *, CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 16 WHEN 'system' THEN 20 ELSE 19 + len(url_encode(role)) END AS marks FROM c
)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN len(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(marks + len(text) + CASE WHEN regexp_matches(text, '"""
    + CONTROL
    + r"""') THEN 1 + len(text) - len(translate(text, '\<[', '')) ELSE 0 END)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
)
