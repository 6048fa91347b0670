"""Conversations as training text: typed parts, a template, a loss mask, and the way back.

A message is a list of parts: text, image, audio or document. A visitor goes through them
in order; each kind has its own method. Text is escaped, everything else becomes a
placeholder in the text and an attachment beside it, which keeps the reference and the
number of tokens that the placeholder stands for. The k-th placeholder of a message is its
k-th attachment.

    <|im_start|>role<|im_sep|>parts, parted by <|part|><|im_end|>\\n

Texts and roles never hold ``<|``: one backslash is put between the two signs, and one more
where there are backslashes already. This can be undone without loss, and no text can
speak as another turn.

Messages are dealt out by range of (conversation, turn) and sorted, so that a task passes
through them in order and holds no conversation. It emits *segments*: at most
``MOST_TURNS`` turns or ``MOST_CHARS`` characters of one conversation, with their own text,
loss spans and attachments. A conversation of any length is many segments.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_TURNS, MOST_CHARS = 64, 1_000_000
#: Characters that a task gathers before it hands a batch to Spark.
BATCH_CHARS = 4_000_000

START, SEP, END, PART = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|part|>"
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>\n", re.S)
_OPEN, _CLOSED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")

PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CLOSED.sub(r"<\1|", text)


@dataclass(frozen=True)
class Expansion:
    """How many tokens a placeholder stands for."""

    patch: int = 28  # an image has one token for each square of so many pixels
    audio_per_second: float = 25.0
    page: int = 256  # tokens of a document's page

    def image(self, width: int | None, height: int | None) -> int:
        return max(1, math.ceil((width or 0) / self.patch) * math.ceil((height or 0) / self.patch))

    def audio(self, seconds: float | None) -> int:
        return max(1, math.ceil((seconds or 0) * self.audio_per_second))

    def document(self, pages: int | None) -> int:
        return max(1, (pages or 0) * self.page)


@dataclass
class Visitor:
    """Flattens the parts of one message. A kind without a method of its own is refused."""

    expansion: Expansion = Expansion()
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part["kind"] or "text"
        method: Callable | None = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"no such kind of content: {kind!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        self._place(part, self.expansion.image(part["width"], part["height"]))

    def visit_audio(self, part: dict) -> None:
        self._place(part, self.expansion.audio(part["seconds"]))

    def visit_document(self, part: dict) -> None:
        self._place(part, self.expansion.document(part["pages"]))

    def _place(self, part: dict, tokens: int) -> None:
        self.pieces.append(f"<|{part['kind']}|>")
        self.attachments.append({"kind": part["kind"], "ref": part["ref"], "tokens": tokens})

    @property
    def body(self) -> str:
        return PART.join(self.pieces)


def text_parts(text) -> F.Column:
    """The parts of a message that is one text."""
    null = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.cast("string").alias("text"),
            null.cast("string").alias("ref"),
            null.cast("int").alias("width"),
            null.cast("int").alias("height"),
            null.cast("double").alias("seconds"),
            null.cast("int").alias("pages"),
        )
    )


SEGMENT = (
    "conv_id long, turn long, role string, code long, segment long, whole boolean, n_turns int, "
    "formatted string, chars long, expanded_tokens long, loss array<struct<start:int,end:int>>, "
    "attachments array<struct<message:int,kind:string,ref:string,tokens:long>>"
)
_ORDER = ["conv_id", "turn", "role", "code"]


def formatted(
    messages: DataFrame,
    learned: str = "assistant",
    expansion: Expansion = Expansion(),
    most_turns: int = MOST_TURNS,
    most_chars: int = MOST_CHARS,
) -> DataFrame:
    """Segments of formatted conversations: up to ``most_turns`` turns, closed beyond ``most_chars``.

    ``messages`` has ``conv_id``, ``turn`` (whole numbers), ``role`` and ``parts`` (as
    ``PARTS``); other columns are left behind. Turns are ordered by ``turn``, then role and
    a hash of the parts; repeated rows are repeated turns. Null ids form one conversation,
    a null turn comes first, a null role or text is empty, a message without parts has an
    empty body. Texts of any length stay whole.

    In order by ``conv_id, turn, role, code, segment`` the texts of the segments are the
    conversation. ``whole`` tells that a segment is all of its conversation; it is false
    also where a task could not see that. ``loss`` has the places of the texts that
    ``learned`` says, without placeholders and marks, ``attachments`` the number of the message in the segment.
    """
    rows = messages.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.col("role").cast("string"),
        F.xxhash64("parts").alias("code"),
        "parts",
    )
    dealt = rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)

    def format_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema(_segment_schema())
        waiting, size, number, first = [], 0, 0, True
        for conv, turns in groupby(_rows(batches), key=lambda r: r["conv_id"]):
            last = None
            for segment in _segments(conv, turns, learned, expansion, most_turns, most_chars):
                if last is not None:
                    waiting.append(last | {"segment": number, "whole": False})
                    number += 1
                only, last = last is None, segment
                size += segment["chars"]
                if size > BATCH_CHARS:
                    yield pa.RecordBatch.from_pylist(waiting, schema=kind)
                    waiting, size = [], segment["chars"]
            # The neighbours of the first conversation may lie in other tasks; whether this
            # is the last one shows only when the next one comes.
            waiting.append(last | {"segment": number, "whole": only and not first})
            number, first = number + 1, False
        if waiting:
            waiting[-1]["whole"] = False
            yield pa.RecordBatch.from_pylist(waiting, schema=kind)

    return dealt.mapInArrow(format_, SEGMENT)


def _segment_schema() -> list[pa.Field]:
    loss = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    attached = pa.list_(
        pa.struct([("message", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
    )
    longs = {c: pa.int64() for c in ("conv_id", "turn", "code", "segment", "chars", "expanded_tokens")}
    kinds = longs | {"role": pa.string(), "formatted": pa.string(), "whole": pa.bool_(), "n_turns": pa.int32()}
    kinds |= {"loss": loss, "attachments": attached}
    names = [c.split()[0] for c in re.split(r", (?=\w+ \w)", SEGMENT)]
    return [pa.field(c, kinds[c]) for c in names]


def _rows(batches: Iterator[pa.RecordBatch], slice_: int = 256) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, slice_):
            yield from batch.slice(start, slice_).to_pylist()


def _segments(
    conv, turns: Iterator[dict], learned: str, expansion: Expansion, most_turns: int, most_chars: int
) -> Iterator[dict]:
    texts, loss, attached, at, tokens, head = [], [], [], 0, 0, None
    for row in turns:
        if head is not None and (len(texts) == most_turns or at > most_chars):
            yield _segment(conv, head, texts, loss, attached, at, tokens)
            texts, loss, attached, at, tokens, head = [], [], [], 0, 0, None
        visitor = Visitor(expansion)
        for part in row["parts"] or []:
            if part is not None:
                visitor.visit(part)
        head = head or row
        opening = START + escape(row["role"] or "") + SEP
        if row["role"] == learned:
            place = at + len(opening)
            for piece in visitor.pieces:
                if not piece.startswith("<|"):
                    loss.append({"start": place, "end": place + len(piece)})
                place += len(piece) + len(PART)
        attached += [{"message": len(texts), **a} for a in visitor.attachments]
        tokens += sum(a["tokens"] for a in visitor.attachments)
        texts.append(f"{opening}{visitor.body}{END}\n")
        at += len(texts[-1])
    yield _segment(conv, head, texts, loss, attached, at, tokens)


def _segment(conv, head, texts, loss, attached, at, tokens) -> dict:
    return {
        "conv_id": conv,
        **{c: head[c] for c in ("turn", "role", "code")},
        "n_turns": len(texts),
        "formatted": "".join(texts),
        "chars": at,
        "expanded_tokens": tokens,
        "loss": loss,
        "attachments": attached,
    }


def read_turns(text: str) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """Role and pieces of each turn of a formatted text. A piece is its kind and its text."""
    for turn in _TURN.finditer(text):
        role, body = turn.groups()
        pieces = body.split(PART)
        # An escaped text has no "<|", so what begins with it is a placeholder.
        yield unescape(role), [(p[2:-2], "") if p.startswith("<|") else ("text", unescape(p)) for p in pieces]


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(segments: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted texts and loss spans.

    Whole conversations are read where they are. The segments of the others are sorted by
    their order and read one after the other: a task holds one segment at a time and the
    state of two hash sums.
    """
    read = segments.select(*_ORDER, "segment", "whole", "formatted", "loss")
    narrow = read.where("whole").mapInArrow(_digest, DIGEST)
    rest = read.where("not whole").repartition("conv_id").sortWithinPartitions(*_ORDER, "segment")
    return narrow.union(rest.mapInArrow(_digest, DIGEST))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in DIGEST.split(", ")]
    kinds = [pa.string() if c.endswith("sha256") else pa.int64() for c in names]
    out: list[tuple] = []
    for conv, rows in groupby(_rows(batches, 16), key=lambda r: r["conv_id"]):
        turns, learned = hashlib.sha256(), hashlib.sha256()
        n = loss_chars = chars = 0
        for row in rows:
            text = row["formatted"]
            for role, pieces in read_turns(text):
                turns.update(f"{role}\n{''.join(x for _, x in pieces)}\n".encode())
                n += 1
            for span in row["loss"]:
                said = unescape(text[span["start"] : span["end"]])
                learned.update(said.encode())
                loss_chars += len(said)
            chars += len(text)
        out.append((conv, n, turns.hexdigest(), loss_chars, learned.hexdigest(), chars))
        if len(out) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
