"""Fill-in-the-middle texts, cut at line borders that remembered chunks tell.

A rolling hash of the last 32 bytes cuts every text into chunks where its content says so,
so that copies, quotations and repeated passages come out as equal chunks wherever they
stand. What a chunk has to say about borders is small: its lines, its code points, whether
a marker lies inside, and its first and last two bytes. Each task keeps these summaries
by the chunk's bytes; a chunk met again is compared byte by byte and not looked through
again. The summaries of a document add up from left to right. The running sums name the
chunk in which the k-th line ends, and only that chunk is opened.

Which chunks a task remembers changes nothing but time: the memory is bounded, and what
it forgot is counted again. Whole texts are cut, rearranged and rebuilt by Spark.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from fleetlens.llm.shared import fresh

#: Prefix, suffix and middle marker. Three ASCII bytes each.
MARKS = ("<P>", "<S>", "<M>")

WINDOW = 32
#: One position in 512 is a border.
BORDER_BITS = 9
SHORTEST, LONGEST = 64, 4096
#: Positions hashed at once, and bytes of chunks that a task remembers (twice, see Summaries).
SLICE, REMEMBERED = 1 << 20, 16 << 20

#: One odd-looking 32-bit number for each byte value.
_GEAR = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_GEAR = ((_GEAR ^ (_GEAR >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)
_INSIDE = bytes(range(0x80, 0xC0))  # UTF-8 bytes that do not begin a code point


class Summary(NamedTuple):
    lines: int  # line ends
    points: int  # code points that begin here
    marked: bool
    head: bytes
    tail: bytes


def borders(data: np.ndarray) -> np.ndarray:
    """Positions behind which the last ``WINDOW`` bytes ask for a border, in ascending order.

    Only whole windows count, so the border depends on these bytes and on nothing else.
    """
    found = []
    for start in range(0, len(data), SLICE):
        part = data[max(0, start - WINDOW + 1) : start + SLICE]
        code, reach = _GEAR[part], 1
        while reach < WINDOW:  # each step doubles the window of the sum
            code[reach:] += code[:-reach] << np.uint32(reach)
            reach *= 2
        at = np.flatnonzero(code[WINDOW - 1 :] >> np.uint32(32 - BORDER_BITS) == 0)
        found.append(at + max(0, start - WINDOW + 1) + WINDOW)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunks(text: bytes) -> list[bytes]:
    """The text in chunks of ``SHORTEST`` to ``LONGEST`` bytes; the last may be shorter."""
    out, start = [], 0
    for at in [*borders(np.frombuffer(text, np.uint8)).tolist(), len(text)]:
        while at - start > LONGEST:
            out.append(text[start : start + LONGEST])
            start += LONGEST
        if at - start >= SHORTEST or start < at == len(text):
            out.append(text[start:at])
            start = at
    return out


def summary(chunk: bytes) -> Summary:
    marked = any(m.encode() in chunk for m in MARKS)
    return Summary(chunk.count(b"\n"), len(chunk.translate(None, _INSIDE)), marked, chunk[:2], chunk[-2:])


class Summaries:
    """What this task knows of chunks, by their bytes.

    Two generations: when the young one is full it becomes the old one, and what nobody
    asked for since then is forgotten.
    """

    def __init__(self, most: int = REMEMBERED):
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.most, self.size, self.counted = most, 0, 0

    def __call__(self, chunk: bytes) -> Summary:
        found = self.young.get(chunk)
        if found is None:
            found = self.old.get(chunk)
            if found is None:
                found = summary(chunk)
                self.counted += 1
            if self.size + len(chunk) > self.most:
                self.old, self.young, self.size = self.young, {}, 0
            self.young[chunk] = found
            self.size += len(chunk)
        return found


@dataclass
class Cuts:
    """A text as running sums over its chunks."""

    parts: list[bytes]
    lines: list[int]  # line ends up to and including each chunk
    bytes: list[int]
    points: list[int]
    marked: bool
    n: int

    @classmethod
    def of(cls, text: bytes, known: Summaries) -> Cuts:
        parts = chunks(text)
        found = [known(p) for p in parts]
        marked, tail = False, b""
        for part, s in zip(parts, found):
            marked = marked or s.marked or any(m.encode() in tail + s.head for m in MARKS)
            tail = s.tail if len(part) > 1 else (tail + part)[-2:]
        lines = list(accumulate(s.lines for s in found))
        open_end = 1 if text and not text.endswith(b"\n") else 0
        return cls(
            parts,
            lines,
            list(accumulate(map(len, parts))),
            list(accumulate(s.points for s in found)),
            marked,
            (lines[-1] if lines else 0) + open_end,
        )

    def after(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first ``k`` lines."""
        if k <= 0 or not self.parts:
            return 0, 0
        if k > self.lines[-1]:  # the last line has no end
            return self.bytes[-1], self.points[-1]
        i = bisect_left(self.lines, k)
        part, at = self.parts[i], -1
        for _ in range(k - (self.lines[i - 1] if i else 0)):
            at = part.index(b"\n", at + 1)
        inside = part[: at + 1]
        before = (self.bytes[i - 1], self.points[i - 1]) if i else (0, 0)
        return before[0] + len(inside), before[1] + len(inside.translate(None, _INSIDE))


_FIELDS = ["n", "marked", "chars", "first", "second", "first_chars", "second_chars"]
_CUT = StructType([StructField(c, BooleanType() if c == "marked" else LongType()) for c in _FIELDS])


@F.arrow_udf(_CUT)
def _cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    known = Summaries()
    for texts, one, two in batches:
        rows = []
        for text, a, b in zip(texts, one.to_pylist(), two.to_pylist()):
            cuts = Cuts.of(text.as_py() or b"", known)
            x, y = sorted((a % (cuts.n + 1), b % (cuts.n + 1)))
            (first, first_chars), (second, second_chars) = cuts.after(x), cuts.after(y)
            chars = cuts.points[-1] if cuts.points else 0
            rows.append((cuts.n, cuts.marked, chars, first, second, first_chars, second_chars))
        kinds = [pa.bool_() if c == "marked" else pa.int64() for c in _FIELDS]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)]
        yield pa.StructArray.from_arrays(columns, names=_FIELDS)


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the hex SHA-256 of ``seed:key``; a null key is empty."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(code, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transformed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 7,
    share: int = 100,
    spm: int = 50,
    name: str = "fim",
) -> DataFrame:
    """``docs`` and a struct ``name`` (a longer name if that one is taken, always the last column).

    Its fields: ``n`` (lines), ``form`` (``plain``, ``psm`` or ``spm``), ``prefix_chars``,
    ``middle_chars``, ``suffix_chars`` (code points, null if plain) and ``output``. Of each
    hundred documents about ``share`` are rearranged, of these ``spm`` suffix first. Texts
    that are empty, null or hold a marker stay plain: their output is the text, empty for
    null. The draw depends on ``key`` and ``seed`` only, so repeated rows come out alike.
    No row moves to another task.
    """
    h1, h2, h3, h4 = draws(F.col(key), seed)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    work = fresh(docs, "_cut")
    cut = docs.withColumn(work, _cut(body, h1, h2))
    at = F.col(work)
    plain = (at["n"] == 0) | at["marked"] | (h3 % 100 >= share)
    piece = lambda start, end: F.substring(body, (start + 1).cast("int"), (end - start).cast("int"))
    prefix = piece(F.lit(0), at["first"])
    middle = piece(at["first"], at["second"])
    suffix = piece(at["second"], F.octet_length(body))
    p, s, m = (F.lit(x.encode()) for x in MARKS)
    form = F.when(plain, "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    output = (
        F.when(plain, body)
        .when(h4 % 100 < spm, F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.concat(p, prefix, s, suffix, m, middle))
    )
    chars = lambda c: F.when(~plain, c)
    out = F.struct(
        at["n"].alias("n"),
        form.alias("form"),
        chars(at["first_chars"]).alias("prefix_chars"),
        chars(at["second_chars"] - at["first_chars"]).alias("middle_chars"),
        chars(at["chars"] - at["second_chars"]).alias("suffix_chars"),
        output.cast("string").alias("output"),
    )
    return cut.select(*docs.columns, out.alias(fresh(docs, name)))


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The exact text, from the output and its form alone.

    A rearranged text holds each marker once, because texts with markers stay plain and no
    end of a marker is the beginning of another one.
    """
    p, s, m = marks
    between = lambda a, b: F.substring_index(F.substring_index(output, a, -1), b, 1)
    middle = F.substring_index(output, m, -1)
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
