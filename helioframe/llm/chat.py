"""Chat formatting of conversations with typed content parts.

A visitor walks the parts of each turn in order. Text is written with its
control characters escaped; an image, audio or document part becomes a
numbered placeholder, its reference is recorded as an attachment, and the
tokens that the placeholder will expand to are counted. The loss mask holds
the spans of the assistant's content.

A turn is written ``<s>role\\ncontent</s>\\n``. In roles and texts, ``\\``,
``<`` and ``[`` are written ``\\e``, ``\\l`` and ``\\b``; no control string can
then occur inside them, and reading back undoes it exactly.

Null texts and roles are empty; parts of an unknown kind raise an error; turns
are ordered by turn (null first), then role, then text, so repeated rows stay
as turns of their own; an empty table gives an empty result; other columns are
ignored. A conversation is one output row, so it is put together in one task;
all conversations with the same content are still rows of their own.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import bound_batches

OPEN, CLOSE = "<s>", "</s>\n"
PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")
#: Tokens a placeholder expands to: image patches of this side, audio frames a second, tokens a page.
IMAGE_PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 12.5, 512

# Control characters and what is written for them. The escape
# sign itself comes first in writing and last in reading.
_ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))


def escape(text: str) -> str:
    for a, b in _ESCAPES:
        text = text.replace(a, b)
    return text


def escape_role(role: str) -> str:
    """Like a text, but on one line: a line feed ends the role."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(role.replace("\\n", "\n"))


def unescape(text: str) -> str:
    for a, b in reversed(_ESCAPES):
        text = text.replace(b, a)
    return text


@dataclass
class Rendering:
    """What the visitor has written so far."""

    pieces: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    expanded: int = 0

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


class PartVisitor:
    """Writes each part by the method of its kind."""

    def __init__(self, out: Rendering):
        self.out = out

    def visit(self, part: dict) -> None:
        method = getattr(self, f"visit_{part['kind']}", None)
        if method is None:
            raise ValueError(f"unknown kind of content part: {part['kind']!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.out.write(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        side = [math.ceil(max(part[x] or 1, 1) / IMAGE_PATCH) for x in ("width", "height")]
        self._attach(part, side[0] * side[1])

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil(max(part["seconds"] or 0, 0) * AUDIO_RATE) or 1)

    def visit_document(self, part: dict) -> None:
        self._attach(part, max(part["pages"] or 1, 1) * PAGE_TOKENS)

    def _attach(self, part: dict, tokens: int) -> None:
        out = self.out
        out.attachments.append({"index": len(out.attachments), "kind": part["kind"], "ref": part["ref"],
                                "start": out.length, "tokens": tokens})
        out.write(f"<{part['kind']}:{len(out.attachments) - 1}>")
        out.expanded += tokens


def render(turns: list[dict]) -> Rendering:
    out = Rendering()
    visitor = PartVisitor(out)
    for turn in turns:
        out.write(OPEN + escape_role(turn["role"] or "") + "\n")
        start = out.length
        for part in turn["parts"] or ():
            visitor.visit(part)
        if turn["role"] == "assistant":
            out.spans.append({"start": start, "length": out.length - start})
        out.write(CLOSE)
    return out


def text_part(text: Column) -> Column:
    """One text part as the parts of a turn."""
    empty = {"kind": F.lit("text"), "text": text, "ref": F.lit(None), "width": F.lit(None), "height": F.lit(None),
             "seconds": F.lit(None), "pages": F.lit(None)}
    return F.array(F.struct(*[c.alias(n) for n, c in empty.items()]).cast(PART))


def formatted(conversations: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans, attachments, expanded_tokens)`` of conversations.

    Rows are turns ``(conv_id, turn, role)`` with their ``parts`` (an array of
    :data:`PART`) or, without that column, a ``text``.
    """
    bound_batches(conversations.sparkSession)
    parts = F.col("parts") if "parts" in conversations.columns else text_part(F.col("text"))
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    attachment = pa.list_(pa.struct([("index", pa.int64()), ("kind", pa.string()), ("ref", pa.string()),
                                     ("start", pa.int64()), ("tokens", pa.int64())]))

    def run(batches):
        for batch in batches:
            got = [render(turns) for turns in batch.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(["".join(r.pieces) for r in got], pa.string()),
                 pa.array([r.spans for r in got], span), pa.array([r.attachments for r in got], attachment),
                 pa.array([r.expanded for r in got], pa.int64())],
                names=["conv_id", "formatted", "loss_spans", "attachments", "expanded_tokens"])

    kind = conversations.schema["conv_id"].dataType.simpleString()
    whole = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return whole.mapInArrow(
        run, f"conv_id {kind}, formatted string, loss_spans array<struct<start:bigint,length:bigint>>, "
             "attachments array<struct<index:bigint,kind:string,ref:string,start:bigint,tokens:bigint>>, expanded_tokens long")


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and contents of a formatted conversation, unescaped (placeholders stay as written)."""
    turns = []
    for turn in text.split(CLOSE)[:-1]:
        role, _, content = turn.removeprefix(OPEN).partition("\n")
        turns.append((unescape_role(role), unescape(content)))
    return turns


def read_back(conversations: DataFrame) -> DataFrame:
    """Digests of what :func:`formatted` wrote, from its output alone."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[s["start"]:s["start"] + s["length"]]) for s in spans)
                rows.append((len(turns), _sha("".join(f"{r}\n{c}\n" for r, c in turns)), len(loss), _sha(loss), len(text)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = conversations.schema["conv_id"].dataType.simpleString()
    return conversations.select("conv_id", "formatted", "loss_spans").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
