"""Near copies by 64-bit SimHash, searched in a grid of per-segment bit counts.

A fingerprint is cut into 32 segments of two bits, and each segment is counted. The
Manhattan distance of two count vectors never exceeds the number of differing bits. The
32 axes form groups, ``radius`` of them and as many again as keep half of the axes
together (three at least); vectors within ``radius`` differ in at most ``radius`` groups,
hence agree on all the others of some choice. Each choice is a grid, and pairs of one cell
are compared: first by Manhattan distance, then by the bits themselves. Cells with more
than ``cell_rows`` fingerprints are cut again by exact bits, with all but ``radius`` of
``6 * radius`` blocks held equal, which leaves twelve bits open: such a cell can hold 4096
fingerprints at most, so no pair is lost and no task grows with a group of copies.

Equal fingerprints are united before the search; copies never meet in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import shingles
from fleetlens.llm.shared import components, fresh, written

LOW = 0x5555555555555555
AXES = 32


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit number.

    Words are runs without ASCII white space, A-Z in lower case. A text with fewer words
    than a shingle is one shingle; a text without words (or null) has fingerprint zero.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return _signed(xxhash.xxh64_intdigest(joined, 42))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), 1 << 16):
        hashes = np.array(
            [digest(joined[s:e], 42) for s, e in zip(starts[k : k + (1 << 16)], ends[k : k + (1 << 16)])],
            dtype=">u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int64)
    return _signed(int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big"))


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes: bits that over half of them have; zero of none."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        some = hashes[k : k + (1 << 16)].astype(">u8")
        ones += np.unpackbits(some.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return _signed(int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(shingle: int = 3):
    """A column function: text -> fingerprint (long)."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(t.as_py(), shingle) for t in texts), pa.int64())

    return of


def _half(x: Column) -> Column:
    return F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(LOW))


def counts(x: Column) -> Column:
    """Bit counts of the 32 segments, two bits each in unary: 0, 01, 11.

    So the Manhattan distance of two vectors is the number of bits of their XOR.
    """
    low, high = x.bitwiseAND(F.lit(LOW)), _half(x)
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _masks(parts: int, open_parts: int, unit: int) -> list[int]:
    """Bit masks that leave ``open_parts`` of ``parts`` nearly equal parts out."""
    n = 64 // unit
    cuts = [round(i * n / parts) * unit for i in range(parts + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [
        _signed(sum(part[i] for i in range(parts) if i not in out))
        for out in combinations(range(parts), open_parts)
    ]


def _cells(fps: DataFrame, code: Column, masks: list[int]) -> DataFrame:
    cells = F.array(
        *(F.struct(F.lit(i).alias("grid"), code.bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(masks))
    )
    return fps.select("fp", F.inline(cells))


def _unary(x: np.ndarray) -> np.ndarray:
    low, high = x & np.uint64(LOW), (x >> np.uint64(1)) & np.uint64(LOW)
    return low | high | ((low & high) << np.uint64(1))


def cell_links(found: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join what lies within ``radius`` of each other in one cell, as a forest."""
    x = np.array(found, np.int64).view(np.uint64)
    near = _unary(x)
    parent = list(range(len(x)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for k in range(0, len(x), 256):
        lower = np.bitwise_count(near[k : k + 256, None] ^ near[None, k:]) <= radius
        i, j = np.nonzero(lower)
        ahead = j > i
        i, j = i[ahead] + k, j[ahead] + k
        exact = np.bitwise_count(x[i] ^ x[j]) <= radius
        for a, b in zip(i[exact].tolist(), j[exact].tolist()):
            ta, tb = top(a), top(b)
            if ta != tb:
                parent[max(ta, tb)] = min(ta, tb)
                links.append((found[a], found[b]))
    return links


def _searched(cells: DataFrame, radius: int) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [p for c in batch.column("fps") for p in cell_links(c.as_py(), radius)]
            yield pa.RecordBatch.from_pydict(
                {"a": [p[0] for p in links], "b": [p[1] for p in links]},
                schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]),
            )

    lists = cells.groupBy("grid", "cell").agg(F.collect_list("fp").alias("fps")).select("fps")
    return lists.mapInArrow(search, "a long, b long")


def near_links(fps: DataFrame, radius: int = 2, cell_rows: int = 2048) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints ``fp`` within ``radius`` bits.

    Pairs already connected through others of their cell may be left out; connected
    components are those of all pairs.
    """
    cells = _cells(fps, counts(F.col("fp")), _masks(radius + max(3, radius), radius, 2))
    sizes = written(
        cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1"), "simhash-cells"
    )
    shared = cells.join(sizes, ["grid", "cell"])
    links = _searched(shared.where(F.col("n") <= cell_rows), radius)
    crowded = written(shared.where(F.col("n") > cell_rows).select("fp").distinct(), "simhash-crowded")
    if crowded.isEmpty():
        return links
    fine = _cells(crowded, F.col("fp"), _masks(min(64, 6 * radius), radius, 1))
    pairs = fine.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return links.union(_searched(fine.join(pairs, ["grid", "cell"]), radius))


def near_copies(
    docs: DataFrame, shingle: int = 3, radius: int = 2, cell_rows: int = 2048, least: tuple[int, int] | None = None
) -> DataFrame:
    """Class and component of every document: ``doc_id, fp, component_id``.

    Two documents are linked if their fingerprints differ in ``radius`` bits or fewer, and
    also, with ``least``, if the Jaccard similarity of their shingles is that or more;
    ``component_id`` is the smallest id reachable over links. Null and empty texts have
    fingerprint zero and are linked like others. Repeated rows give repeated results; a
    row without id belongs to its component but does not name it. Columns other than
    ``doc_id`` and ``text`` are not looked at. An empty table gives an empty result.
    """
    marked, answer = _components(docs, shingle, radius, cell_rows, least)
    return marked.join(answer, "fp", "left").select(
        "doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _components(
    docs: DataFrame, shingle: int, radius: int, cell_rows: int, least: tuple[int, int] | None
) -> tuple[DataFrame, DataFrame]:
    """The documents as ``doc_id, body, fp``, and of each fingerprint that several rows have
    or that is linked ``fp, root, component_id``."""
    if least:
        rare = shingles.frequent(docs, shingle)
        marked = shingles.described(docs, shingle, least, rare, majority)
        marked = marked.withColumn("row", F.monotonically_increasing_id())
    else:
        marked = docs.select("doc_id", F.xxhash64("text").alias("body"), fingerprints(shingle)("text").alias("fp"))
    marked = written(marked, "simhash-docs")
    classes = written(
        marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "simhash-classes"
    )
    links = near_links(classes.select("fp"), radius, cell_rows)
    if least:
        links = links.union(_alike(docs, marked, shingle, least))
    roots = written(
        components(links, "simhash-links").select(
            F.col("node").alias("fp"), "root"
        ),
        "simhash-roots",
    )
    linked = classes.join(roots, "fp", "left").where("n > 1 or root is not null")
    linked = linked.select("fp", F.coalesce("root", "fp").alias("root"), "first")
    named = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked, written(linked.join(named, "root").select("fp", "root", "component_id"), "simhash-components")


def _alike(docs: DataFrame, marked: DataFrame, shingle: int, least: tuple[int, int]) -> DataFrame:
    """Links between the fingerprints of texts whose shingles are alike."""
    known = marked.where(F.col("doc_id").isNotNull() & F.col("code").isNotNull())
    # Of rows with one code one is taken; the others are looked up, so that no prefix moves.
    several = known.groupBy("code").agg(F.min("row").alias("_row"), F.count("*").alias("_n")).where("_n > 1")
    several = written(several.select("code", "_row"), "simhash-several")
    sets = known.join(several, "code", "left").where("_row is null or _row = row").drop("_row", "row")
    sets = written(sets, "simhash-sets")
    found = shingles.links(docs, sets, shingle, least)
    for side in ("a", "b"):
        found = found.join(sets.select(F.col("code").alias(side), F.col("fp").alias(f"_{side}")), side)
    return found.select(F.col("_a").alias("a"), F.col("_b").alias("b"))


def one_of_each(
    docs: DataFrame, shingle: int = 5, radius: int = 3, least: tuple[int, int] | None = None
) -> DataFrame:
    """``docs`` without near copies: of each component the document with the smallest id.

    All columns stay as they are. Rows without id stay. Rows that share an id go or stay by
    their texts: those of different components all stay; of equal or linked ones in one
    component one stays (the one with the smallest text hash, any one if the texts are equal).
    """
    marked, found = _components(docs, shingle, radius, 4096, least)
    # A fingerprint that no other row has is a component by itself, and not among these.
    rows = marked.where(F.col("doc_id").isNotNull()).select("doc_id", "body", "fp").join(found, "fp")
    best = rows.groupBy("root").agg(F.min(F.struct("doc_id", "body")).alias("_best")).select("_best.*", F.lit(True).alias("best"))
    texts = rows.groupBy("doc_id", "body").agg(F.count("*").alias("n")).join(best, ["doc_id", "body"], "left")
    body = fresh(docs, "_body")
    marks = written(texts.where("best is null or n > 1").withColumnRenamed("body", body), "simhash-marks")
    # Whole documents move only if these marks are too many to be handed to all tasks.
    mine = docs.where(F.col("doc_id").isNotNull()).withColumn(body, F.xxhash64("text"))
    single = mine.join(marks, ["doc_id", body], "left_anti")
    repeated = mine.join(marks.where("best"), ["doc_id", body], "left_semi").dropDuplicates(["doc_id", body])
    kept = single.select(*docs.columns).union(repeated.select(*docs.columns))
    return kept.union(docs.where(F.col("doc_id").isNull()))
