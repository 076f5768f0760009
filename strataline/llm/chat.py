"""Chat formatting: turns of typed content parts become template text with a loss mask, and can be read back.

A visitor flattens the parts of a turn in order: text is escaped, every other part becomes one placeholder that
names its attachment, and its expanded token count is recorded. A turn is written as

    <|im_start|>ROLE\\nBODY<|im_end|>\\n

Escaping is reversible: a backslash is added inside ``<|`` (and inside ``<\\|``, ``<\\\\|``, ...), so neither a
control string nor a placeholder can occur in escaped text. Roles also have backslashes and newlines escaped.

Formatting works on single turns. Reading a conversation back streams its turns in order through incremental
hashes: a conversation of any length needs the memory of one turn.

Defined cases: null text, role or parts are empty; a null conversation id is a conversation of its own; equal
turn numbers are ordered by role and text; repeated rows are repeated turns; an unknown part type is kept as a
placeholder of that type with the default count; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.common import map_rows, text_or_empty

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "\n"
LEARNED_ROLE = "assistant"

# A part of a turn. ``ref`` names its attachment; ``amount`` is its size: pixels as width x height for images,
# seconds of audio, pages of documents.
PART = "struct<type:string,text:string,ref:string,width:int,height:int,amount:double>"

_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<(\\*)\\\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|part:([^|]*)\|([^|]*)\|(\d+)\|>")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Piece(NamedTuple):
    """One visited part: its place in the body, whether it is prose, and what it attaches."""

    body: str
    is_text: bool
    type: str
    ref: str
    tokens: int


# Sizes and token counts beyond this are this.
MOST = (1 << 31) - 1


def _size(value: float | None, unknown: float) -> float:
    """A part's size; ``unknown`` where it is missing, no finite number, or not above zero."""
    return min(value, MOST) if value is not None and math.isfinite(value) and value > 0 else unknown


class PartVisitor:
    """Flattens parts. Image tokens follow the number of tiles, audio the seconds, documents the pages.

    A side of unknown size counts as one tile, unknown seconds as none and unknown pages as one.
    """

    def __init__(self, tile: int = 28, audio_rate: float = 12.5, page_tokens: int = 800, default_tokens: int = 1):
        self.tile, self.audio_rate, self.page_tokens, self.default_tokens = tile, audio_rate, page_tokens, default_tokens

    def visit(self, part: dict) -> Piece:
        return getattr(self, f"visit_{part['type'] or 'text'}", self.visit_other)(part)

    def visit_text(self, part: dict) -> Piece:
        return Piece(escape(part["text"] or ""), True, "text", "", 0)

    def visit_image(self, part: dict) -> Piece:
        across, down = (math.ceil(_size(part[side], self.tile) / self.tile) for side in ("width", "height"))
        return self.placeholder(part, across * down)

    def visit_audio(self, part: dict) -> Piece:
        return self.placeholder(part, math.ceil(_size(part["amount"], 0) * self.audio_rate))

    def visit_document(self, part: dict) -> Piece:
        return self.placeholder(part, math.ceil(_size(part["amount"], 1)) * self.page_tokens)

    def visit_other(self, part: dict) -> Piece:
        return self.placeholder(part, self.default_tokens)

    def placeholder(self, part: dict, tokens: int) -> Piece:
        kind, ref = (re.sub(r"[|%]", lambda m: f"%{ord(m[0]):02X}", part[k] or "") for k in ("type", "ref"))
        tokens = min(tokens, MOST)
        return Piece(f"<|part:{kind}|{ref}|{tokens}|>", False, kind, ref, tokens)


def format_turn(role: str | None, parts: list[dict] | None, visitor: PartVisitor) -> tuple[str, list, list, int]:
    """Formatted text, loss spans in it (only an assistant's prose), attachments in order, expanded tokens."""
    role = role or ""
    out = f"{START}{escape_role(role)}{NEWLINE}"
    loss, attached, tokens = [], [], 0
    for part in parts or []:
        piece = visitor.visit(part)
        if piece.is_text:
            if role == LEARNED_ROLE and piece.body:
                loss.append({"start": len(out), "end": len(out) + len(piece.body)})
        else:
            attached.append({"type": piece.type, "ref": piece.ref, "start": len(out), "tokens": piece.tokens})
            tokens += piece.tokens
        out += piece.body
    return out + END + NEWLINE, loss, attached, tokens


def text_part(text: Column) -> Column:
    """A text column as the only part of its turn."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast(
        "array<struct<type:string,text:string>>"
    )


def format_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", **sizes: float
) -> DataFrame:
    """One row per turn: conversation, turn, ``formatted``, ``loss`` spans, ``attachments``, ``expanded_tokens``.

    ``parts`` is an array of structs with any of PART's fields. Offsets are code points of ``formatted``.
    """
    visitor = PartVisitor(**sizes)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, at, who, content in rows:
            yield conv_id, at, *format_turn(who, content, visitor)

    kinds = {c: turns.schema[c].dataType.simpleString() for c in (conv, turn)}
    element = turns.schema[parts].dataType.elementType
    fields = [f.split(":") for f in PART.removeprefix("struct<").removesuffix(">").split(",")]
    content = F.transform(
        parts, lambda p: F.struct(*[(p[n] if n in element.names else F.lit(None)).cast(t).alias(n) for n, t in fields])
    )
    return map_rows(
        turns.select(conv, turn, F.col(role).cast("string"), content.alias(parts)),
        run,
        f"{conv} {kinds[conv]}, {turn} {kinds[turn]}, formatted string, loss array<struct<start:int,end:int>>, "
        "attachments array<struct<type:string,ref:string,start:int,tokens:int>>, expanded_tokens long",
    )


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn; placeholders are left out of the text."""
    m = _TURN.fullmatch(formatted)
    if m is None:
        raise ValueError("not a formatted turn")
    body = _PLACEHOLDER.sub("", m[2]) if "<|part:" in m[2] else m[2]
    return unescape_role(m[1]), unescape(body)


def read_back(formatted: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Digests of each conversation, taken from the output of ``format_turns`` alone."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        state = None
        for conv_id, text, loss in rows:
            if state is None or state[0] != conv_id:
                if state is not None:
                    yield closed(state)
                state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, said = read_turn(text)
            state[1] += 1
            state[2].update(f"{role}\n{said}\n".encode())
            for span in loss:
                learned = unescape(text[span["start"] : span["end"]])
                state[3] += len(learned)
                state[4].update(learned.encode())
            state[5] += len(text)
        if state is not None:
            yield closed(state)

    def closed(state: list) -> tuple:
        return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

    ordered = formatted.repartition(conv).sortWithinPartitions(conv, turn, "formatted").select(conv, "formatted", "loss")
    return map_rows(
        ordered,
        run,
        f"{conv} {formatted.schema[conv].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )


def plain_turns(conversations: DataFrame) -> DataFrame:
    """Turns whose text is their only part."""
    return conversations.select("conv_id", "turn", "role", text_part(text_or_empty("text")).alias("parts"))
