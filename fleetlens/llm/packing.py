"""Packing documents into sequences of a fixed number of tokens.

Documents are tokenized and end with a separator; only longer ones are cut, into full
pieces after a first one that takes the rest. What remains to decide depends on piece
lengths only, and there are at most ``capacity`` different ones: the number of pieces of
each length is counted in Spark, and the packing is worked out on these counts, whole
runs of equal bins at a time. Pieces above a third of the capacity are matched first, at
most two to a bin: the longest takes the longest that still fits. Shorter pieces, longest
first, go where the least room is left that holds them. The plan says, for every length,
which bins take its 1st, 2nd, ... piece; each piece then finds its place by its number
among the pieces of its length, which is counted without bringing a length into one task.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import running_before, unit, written


@dataclass
class Run:
    """``times`` equal bins: each holds ``parts``, a list of (length, how many)."""

    times: int
    room: int
    parts: list


def plan_bins(counts: dict[int, int], capacity: int) -> list[Run]:
    """Bins for ``counts[length]`` pieces of each length, as runs of equal bins."""
    left = {n: c for n, c in counts.items() if c > 0}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError("lengths must lie between 1 and the capacity")
    runs: list[Run] = []
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        # The longest partner that fits; a itself is one if two of it fit.
        k = bisect_left(large, capacity - a + 1)
        b = large[k - 1] if k else None
        if b is None:
            runs.append(Run(left.pop(a), capacity - a, [(a, 1)]))
            large.pop()
            continue
        if b == a:
            pairs, odd = divmod(left[a], 2)
            if pairs:
                runs.append(Run(pairs, capacity - 2 * a, [(a, 2)]))
            left[a] = odd
            if odd:
                # The last one takes the longest of the shorter ones instead.
                large.remove(a)
                del left[a]
                if large:
                    b = large[-1]
                    runs.append(Run(1, capacity - a - b, [(a, 1), (b, 1)]))
                    left[b] -= 1
                    if not left[b]:
                        large.pop()
                        del left[b]
                else:
                    runs.append(Run(1, capacity - a, [(a, 1)]))
                continue
        else:
            pairs = min(left[a], left[b])
            runs.append(Run(pairs, capacity - a - b, [(a, 1), (b, 1)]))
            left[a] -= pairs
            left[b] -= pairs
        for n in {a, b}:
            if not left[n]:
                large.remove(n)
                del left[n]
    rooms: dict[int, list[Run]] = defaultdict(list)
    for run in runs:
        rooms[run.room].append(run)
    sizes = sorted(rooms)
    for n in sorted(left, reverse=True):
        rest = left[n]
        while rest:
            k = bisect_left(sizes, n)
            if k == len(sizes):
                fresh = -(-rest // (capacity // n))
                _put(rooms, sizes, Run(fresh, capacity, []))
                continue
            room = sizes[k]
            run = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                sizes.pop(k)
            each = room // n
            full, part = divmod(min(rest, each * run.times), each)
            for times, some in ((full, each), (1 if part else 0, part)):
                if times:
                    _put(rooms, sizes, Run(times, room - some * n, [*run.parts, (n, some)]))
            same = run.times - full - (1 if part else 0)
            if same:
                _put(rooms, sizes, Run(same, room, run.parts))
            rest -= full * each + part
    return [run for some in rooms.values() for run in some]


def _put(rooms: dict, sizes: list, run: Run) -> None:
    if run.room not in rooms:
        insort(sizes, run.room)
    rooms[run.room].append(run)


def places(runs: list[Run]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first number, first bin, start in the bin, pieces per bin, of its slots.

    A slot is one place for a length in each bin of a run: ``many`` pieces side by side.
    """
    slots: dict[int, list] = defaultdict(list)
    seen: dict[int, int] = defaultdict(int)
    bin_no = 0
    for run in runs:
        at = 0
        for n, many in run.parts:
            slots[n].append((seen[n], bin_no, at, many))
            seen[n] += many * run.times
            at += n * many
        bin_no += run.times
    return {n: tuple(np.array(c, np.int64) for c in zip(*s)) for n, s in slots.items()}


Added = tuple[tuple[str, int], ...]


def added_tokens(json_path: str) -> Added:
    """Text and id of the tokens that the vocabulary's JSON file adds to the ranks.

    They are matched wherever the text holds them. Other kinds of matching are refused.
    """
    with open(json_path, encoding="utf-8") as file:
        found = json.load(file).get("added_tokens") or []
    odd = [t["content"] for t in found if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
    if odd:
        raise ValueError(f"added tokens that are not matched as they stand: {odd}")
    return tuple((t["content"], t["id"]) for t in found)


@lru_cache(maxsize=2)
def _encoder(ranks_path: str, split: str, added: Added):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("corpus", pat_str=split, mergeable_ranks=ranks, special_tokens=dict(added))


@lru_cache(maxsize=2)
def _exact(json_path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


def _ids(text: str, encoder, json_path: str | None) -> list[int]:
    """The ids of a text. Very long runs of one kind of character overflow the fast splitter."""
    try:
        return encoder.encode(text, allowed_special="all")
    except ValueError:
        if json_path is None:
            raise
        return _exact(json_path).encode(text, add_special_tokens=False).ids


def cut_pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: the first one takes the remainder."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(
    docs: DataFrame,
    ranks_path: str,
    split: str,
    capacity: int = 2048,
    end_id: int = 0,
    keep_ids: bool = False,
    added: Added = (),
    json_path: str | None = None,
) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32[, ids]``.

    A document is the ids of its whole text and ``end_id``; null counts as empty. Byte-level
    BPE by rank file, which with the tokens of ``added`` gives the same ids as the
    vocabulary's JSON file (see ``added_tokens``). Texts that its splitter gives up on, such
    as a million blanks in a row, are encoded with that file itself if ``json_path`` names it.
    """
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if keep_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    kind = pa.schema([("doc_id", pa.int64()), *fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, split, added)
        for batch in batches:
            out: list[list] = [[] for _ in kind]
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array([*_ids(text.as_py() or "", encoder, json_path), end_id], "<u4")
                for k, (start, length) in enumerate(cut_pieces(len(ids), capacity)):
                    part = ids[start : start + length]
                    row = [key, k, start, length, zlib.crc32(part.tobytes())]
                    for column, value in zip(out, row + [part.astype(np.int32)] * keep_ids):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, kind)], schema=kind)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, ddl)


def pack(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``.

    ``parts`` should be a written table with the columns ``doc_id, piece, length``. Pieces
    of one length are exchangeable; which one goes where follows a hash of id and piece.
    Repeated rows are packed each; an empty table stays empty.
    """
    counts = {r[0]: r[1] for r in parts.groupBy("length").agg(F.count("*")).collect()}
    where = places(plan_bins(counts, capacity))
    keyed = parts.withColumn("_key", F.xxhash64("doc_id", "piece")).withColumn("_one", F.lit(1).cast("long"))
    numbered = running_before(
        keyed, ["length"], unit(F.col("_key")), ["_key", "doc_id", "piece"], "_one", "_number", sum(counts.values())
    )

    @F.arrow_udf("sequence_id long, offset long")
    def place(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        n, number = lengths.to_numpy(zero_copy_only=False), numbers.to_numpy(zero_copy_only=False)
        bins, offsets = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for length in np.unique(n):
            rows = n == length
            first, bin_no, at, many = where[int(length)]
            k = np.searchsorted(first, number[rows], "right") - 1
            inside = number[rows] - first[k]
            bins[rows] = bin_no[k] + inside // many[k]
            offsets[rows] = at[k] + inside % many[k] * length
        return pa.StructArray.from_arrays([pa.array(bins), pa.array(offsets)], names=["sequence_id", "offset"])

    placed = numbered.withColumn("_place", place("length", "_number"))
    return placed.select(*parts.columns, "_place.sequence_id", "_place.offset")


def packed(
    docs: DataFrame, ranks_path: str, split: str, capacity: int = 2048, added: Added = (), json_path: str | None = None
) -> DataFrame:
    """Documents as pieces with their places; see ``pieces`` and ``pack``."""
    return pack(written(pieces(docs, ranks_path, split, capacity, added=added, json_path=json_path), "pieces"), capacity)
