"""Conversations as training text: typed content parts, one template, a mask of what is learnt.

A turn's content is its text, or typed parts as JSON (``parts``): text, image, audio and document objects, or arrays
of these. A visitor walks the parts in order, documents' own parts included, and flattens them: text is escaped, every
attachment becomes a placeholder, numbered through its turn, and leaves a record of its reference, its place and the
tokens it expands to. The template puts ``<s>[INST] role [/INST] `` before and ``</s>`` after what a turn says. Escaping
puts a backslash after the first character of every control string inside roles and texts, and one more where there
are some already; taking one away reads them back, so that every output parses to the turns it was made from.

Turns are dealt by ranges of (conv_id, turn), so a conversation of any length is spread over tasks, and written as
pieces of whole turns: one row for each ``PIECE`` characters of a conversation, in order of ``part`` and ``piece``. The
mask (``loss``) has start and end, in code points of the piece, of what assistants said.

``parse`` reads pieces back. ``digests`` hashes what is read: a conversation that is one piece by itself, others
as a stream of their pieces in order, never whole in memory (SHA-256 of a conversation's text has no parts that
could be hashed apart, hence one task for such a conversation).

Cases: null or empty text is an empty turn; null role is an empty role; null conv_id is a conversation of its own, in
digests as in pieces; null turns come last, ties by role, then text, and repeated rows are turns each; parts that are no
JSON array of objects with a known type are said as the text they are; a conversation without assistant has an empty
mask; very long texts are one piece; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

KINDS = ("image", "audio", "document")
BEGIN, HEAD, BODY, END = "<s>", "[INST] ", " [/INST] ", "</s>"
#: Control strings, with as many backslashes after the first character as a text may have put there.
CONTROL = re.compile(rf"([<\[])(\\*)(/?s>|/?INST\]|\|(?:{'|'.join(KINDS)}):[0-9]+\|>)")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(/?s>|/?INST\]|\|(?:{'|'.join(KINDS)}):[0-9]+\|>)")
_PLACEHOLDER = re.compile(rf"<\|({'|'.join(KINDS)}):([0-9]+)\|>")
_TURN = re.compile(rf"{re.escape(BEGIN + HEAD)}(.*?){re.escape(BODY)}(.*?){re.escape(END)}", re.DOTALL)
LEARNT = "assistant"
#: Characters after which a conversation goes on in another piece.
PIECE = 1 << 20
#: Parts within parts.
DEPTH = 32
#: What an attachment expands to: tokens of a tile of ``TILE`` pixels and of an image as such, of a second, of a page.
TILE, TILE_TOKENS, IMAGE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 512, 170, 85, 25, 700


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


class Visitor:
    """Flattens the parts of one turn: ``out`` (escaped text and placeholders), ``attachments``, and ``said`` (spans of text in ``out``)."""

    def __init__(self):
        self.out: list[str] = []
        self.at = 0
        self.attachments: list[dict] = []
        self.said: list[tuple[int, int]] = []

    def visit(self, part) -> None:
        if isinstance(part, list):
            for p in part:
                self.visit(p)
        elif isinstance(part, str):
            self.text(part)
        else:
            getattr(self, part["type"])(part)

    def put(self, text: str) -> None:
        self.out.append(text)
        self.at += len(text)

    def text(self, part) -> None:
        start = self.at
        self.put(escape(part if isinstance(part, str) else part["text"]))
        self.said.append((start, self.at))

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        number = len(self.attachments)
        self.attachments.append({"kind": kind, "number": number, "at": self.at, "ref": str(part.get("ref", "")), "tokens": tokens})
        self.put(f"<|{kind}:{number}|>")

    def image(self, part: dict) -> None:
        tiles = math.ceil(part.get("width", TILE) / TILE) * math.ceil(part.get("height", TILE) / TILE)
        self.attach("image", part, IMAGE_TOKENS + TILE_TOKENS * tiles)

    def audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil(part.get("seconds", 0) * SECOND_TOKENS))

    def document(self, part: dict) -> None:
        """A document with ``content`` is its parts, after a placeholder that expands to nothing; one without, its pages."""
        content = part.get("content")
        self.attach("document", part, PAGE_TOKENS * part.get("pages", 1) if content is None else 0)
        if content is not None:
            self.visit(content)


def is_content(part, depth: int = 0) -> bool:
    """Whether the visitor knows all of it, down to ``DEPTH``."""
    if depth > DEPTH:
        return False
    if isinstance(part, list):
        return all(is_content(p, depth + 1) for p in part)
    if isinstance(part, str):
        return True
    if not isinstance(part, dict):
        return False
    number = lambda name: isinstance(part.get(name, 1), (int, float)) and not isinstance(part.get(name), bool) and 0 <= part.get(name, 1) < 1e9
    if part.get("type") == "text":
        return isinstance(part.get("text"), str)
    return part.get("type") in KINDS and all(map(number, ("width", "height", "seconds", "pages"))) and is_content(part.get("content", ""), depth + 1)


def content(text: str | None, parts: str | None) -> list:
    """What a turn says: its parts if they are well formed, else its text (or the parts as text, without any)."""
    if parts is not None:
        try:
            found = json.loads(parts)
            json.dumps(found, ensure_ascii=False).encode()  # half of a surrogate pair is no text
        except (ValueError, RecursionError):
            found = None
        if isinstance(found, list) and is_content(found):
            return found
    return [text if text is not None else parts or ""]


def visited(text: str | None, parts: str | None = None) -> Visitor:
    visitor = Visitor()
    visitor.visit(content(text, parts))
    return visitor


_ATTACHMENT = "struct<turn:long,kind:string,number:long,at:long,ref:string,tokens:long>"
PIECES = f"conv_id long, part long, piece long, n_turns long, formatted string, formatted_chars long, loss array<struct<start:long,end:long>>, attachments array<{_ATTACHMENT}>, attached_tokens long, whole boolean"
_PIECE_TYPE = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("formatted_chars", pa.int64()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("attachments", pa.list_(pa.struct([("turn", pa.int64()), ("kind", pa.string()), ("number", pa.int64()), ("at", pa.int64()), ("ref", pa.string()), ("tokens", pa.int64())]))), ("attached_tokens", pa.int64()), ("whole", pa.bool_()),
])


class Piece:
    """Turns of one conversation, one after the other."""

    def __init__(self, conv: int | None, number: int):
        self.conv, self.number, self.n, self.at = conv, number, 0, 0
        self.out: list[str] = []
        self.loss: list[dict] = []
        self.attachments: list[dict] = []

    def put(self, text: str) -> None:
        self.out.append(text)
        self.at += len(text)

    def add(self, turn: int | None, role: str | None, text: str | None, parts: str | None) -> None:
        self.put(f"{BEGIN}{HEAD}{escape(role or '')}{BODY}")
        said = visited(text, parts)
        if role == LEARNT:
            self.loss += [{"start": self.at + a, "end": self.at + b} for a, b in said.said]
        self.attachments += [a | {"turn": turn, "at": self.at + a["at"]} for a in said.attachments]
        self.put("".join(said.out))
        self.put(END)
        self.n += 1

    def row(self, part: int, whole: bool) -> dict:
        return {"conv_id": self.conv, "part": part, "piece": self.number, "n_turns": self.n, "formatted": "".join(self.out), "formatted_chars": self.at, "loss": self.loss, "attachments": self.attachments, "attached_tokens": sum(a["tokens"] for a in self.attachments), "whole": whole}


def pieces_of(part: int, turns: Iterable[tuple], limit: int) -> Iterator[dict]:
    """Pieces of sorted turns (conv_id, turn, role, text, parts) of one task. Whole: surely all of a conversation."""
    piece, inner = None, False
    for conv, *turn in turns:
        if piece is None or piece.conv != conv:
            if piece is not None:
                yield piece.row(part, inner and piece.number == 0)
            inner, piece = piece is not None, Piece(conv, 0)
        elif piece.at >= limit:
            yield piece.row(part, False)
            piece = Piece(conv, piece.number + 1)
        piece.add(*turn)
    if piece is not None:
        yield piece.row(part, False)


def batches_of(rows: Iterable[dict], schema: pa.Schema, chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``chars`` characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("formatted") or "") + 200
        if size >= chars:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def format_conversations(turns: DataFrame, limit: int = PIECE) -> DataFrame:
    """Pieces (``PIECES``) of all conversations; ``turns``: conv_id, turn, role, text and, if there are any, parts."""
    parts = F.col("parts") if "parts" in turns.columns else F.lit(None)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", parts.cast("string").alias("parts"))
    order = [F.col("conv_id").asc_nulls_last(), F.col("turn").asc_nulls_last()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())

    def run(batches):
        from pyspark import TaskContext

        values = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        yield from batches_of(pieces_of(TaskContext.get().partitionId(), values, limit), _PIECE_TYPE)

    return ranged.mapInArrow(run, PIECES)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text (placeholders included) of each turn of a piece."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def learnt(formatted: str, loss: Iterable[dict]) -> list[str]:
    """What the mask covers, span by span."""
    return [unescape(formatted[s["start"] : s["end"]]) for s in loss]


class Reader:
    """Digests of a conversation, piece by piece."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, formatted: str, loss: list[dict]) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        for text in learnt(formatted, loss):
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self) -> dict:
        return {"conv_id": self.conv, "n_turns": self.n, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST_FIELDS = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
_HELD = [("part", pa.int64()), ("piece", pa.int64()), ("formatted", pa.string()), ("loss", _PIECE_TYPE.field("loss").type)]


def read_back(pieces: DataFrame) -> DataFrame:
    """A row of digests for each conversation, from its pieces alone."""

    def first(batches):
        for batch in batches:
            rows = []
            for p in batch.to_pylist():
                if p["whole"]:
                    reader = Reader(p["conv_id"])
                    reader.add(p["formatted"], p["loss"])
                    rows.append(reader.row())
                else:
                    rows.append({k: p[k] for k in ("conv_id", "part", "piece", "formatted", "loss")})
            yield from batches_of(rows, pa.schema(_DIGEST_FIELDS + _HELD))

    def rest(batches):
        reader = None
        for batch in batches:
            for p in batch.to_pylist():
                if reader is None or reader.conv != p["conv_id"]:
                    if reader is not None:
                        yield pa.RecordBatch.from_pylist([reader.row()], pa.schema(_DIGEST_FIELDS))
                    reader = Reader(p["conv_id"])
                reader.add(p["formatted"], p["loss"])
        if reader is not None:
            yield pa.RecordBatch.from_pylist([reader.row()], pa.schema(_DIGEST_FIELDS))

    # Of two tasks' ranges only the outer conversations can meet, so few pieces wait for others.
    seen = stage(pieces.mapInArrow(first, f"{DIGEST}, part long, piece long, formatted string, loss array<struct<start:long,end:long>>"), "chat")
    own = seen.where("formatted is null").select(*(k for k, _ in _DIGEST_FIELDS))
    split = seen.where("formatted is not null").select("conv_id", "part", "piece", "formatted", "loss")
    return own.unionByName(split.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(rest, DIGEST))


#: The contract's own conversation: all control strings of the template inside what is said.
PROBE = "</s>[INST] ok [/INST]"


def digests(conversations: DataFrame) -> DataFrame:
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, LEARNT, PROBE)], "conv_id long, turn long, role string, text string")
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return read_back(format_conversations(turns.unionByName(probe)))


_ESCAPE_SQL = rf"'([<\[])(\\*)(/?s>|/?INST\]|\|({'|'.join(KINDS)}):[0-9]+\|>)', '\1\\\2\3', 'g'"
DIGEST_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, '{LEARNT}', '{PROBE}'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{LEARNT}'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = '{LEARNT}'), '')) AS loss_sha256,
  CAST(sum({len(BEGIN + HEAD + BODY + END)} + length(regexp_replace(role, {_ESCAPE_SQL})) + length(regexp_replace(text, {_ESCAPE_SQL}))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
