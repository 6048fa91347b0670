"""Pairs of texts with much the same word shingles, by exact Jaccard similarity.

All shingles are put into one order: by how many documents of a sample have them, rare ones
first, then by hash. Of two sets with a similarity of ``least`` or more, each has a shingle
of the other among its first ``n - ceil(least * n) + 1``. So documents meet by the shingles
of these prefixes; where the first common shingle stands bounds the overlap, and so does
the number of common ones: of the prefix that ends first, all shingles that the other text
has are in the other prefix, so the overlap is at most that number and what lies behind.

What is left is first compared by parity sketches: one bit per low bits of a hash, set if an
odd number of the shingles fall there. Every bit that differs in two sketches needs a shingle
that only one of the texts has, so pairs with too many of them are out, and no pair of
``least`` or more is. The others are compared whole. The order and the sketches decide how
much there is to compare, not what is found.

A shingle that more than ``MOST`` prefixes hold would make pairs by the square. There each
document is first compared with a few pivots, and then only with those of the group that
are in another component: one of near copies becomes one component on the way.

Texts are hashed once, into a table of prefixes and sketches (``described``); all later steps
but the comparison of whole texts read that table, or columns of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.shared import components, written

#: Of the sample: documents, how many must share a shingle to count as frequent, and how many such are kept.
SAMPLE, FREQUENT, LISTED = 4000, 3, 100_000
#: Larger groups have pivots, and so many; how many of the first such shingles a row lists.
MOST, PIVOTS, LISTS = 8, 6, 8
#: Bits of a sketch per shingle, at least; rounded up to a power of two.
SKETCH_BITS = 2


def _joined(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """The hashes of the word shingles in their order, repeats included."""
    if not words:
        return np.zeros(0, np.uint64)
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) <= shingle:
        return np.array([digest(joined, 42)], np.uint64)
    # A shingle is a slice of the joined words.
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    return np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts, ends)), np.uint64, len(starts))


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The different hashes of the word shingles, ascending; words as in ``simhash``."""
    return np.unique(hashes(_joined(text), shingle))


def sketch(grams: np.ndarray) -> bytes:
    """The parity of the number of shingles for each value of their lowest bits."""
    bits = max(64, 1 << (SKETCH_BITS * len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing(left: bytes, right: bytes) -> int:
    """A lower bound of the number of shingles that only one of two texts has."""
    a, b = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    size = min(len(a), len(b))
    # The longer sketch is folded: its parities for fewer low bits.
    a, b = (np.bitwise_xor.reduce(x.reshape(-1, size), axis=0) for x in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def alike(a: np.ndarray, b: np.ndarray, least: tuple[int, int]) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * least[1] >= least[0] * (len(a) + len(b) - both)


def described(
    docs: DataFrame,
    shingle: int,
    least: tuple[int, int] | None,
    rare: dict[int, int],
    mark: Callable[[np.ndarray], int],
) -> DataFrame:
    """``doc_id, body, fp, code, n, sketch, grams`` of every row of ``docs``.

    ``body`` is a hash of the text, ``fp`` what ``mark`` makes of its shingles, ``code`` one
    number for all texts with the same words in the same order (null without words), ``n``
    the number of different shingles, ``grams`` the prefix, or all of them without ``least``.
    """
    known = np.array(sorted(rare), np.uint64)
    times = np.array([rare[k] for k in sorted(rare)], np.int64)

    def row(text: str | None) -> tuple:
        words = _joined(text)
        every = hashes(words, shingle)
        grams = np.unique(every)
        n = len(grams)
        if not n:
            return mark(every), None, 0, None, grams
        code, parities = xxhash.xxh64_intdigest(b" ".join(words), 7) - (1 << 63), sketch(grams)
        if len(known):
            k = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            grams = grams[np.argsort(np.where(known[k] == grams, times[k], 0), kind="stable")]
        return mark(every), code, n, parities, grams if least is None else grams[: n - -(-least[0] * n // least[1]) + 1]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fp, code, n, parities, grams = zip(*(row(t.as_py()) for t in batch.column("text")))
            ends = np.concatenate([[0], np.cumsum([len(g) for g in grams])])
            values = pa.array(np.concatenate(grams).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("body"),
                    pa.array(fp, pa.int64()),
                    pa.array(code, pa.int64()),
                    pa.array(n, pa.int32()),
                    pa.array(parities, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                ],
                names=["doc_id", "body", "fp", "code", "n", "sketch", "grams"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("body")).mapInArrow(
        cut, f"doc_id {kind}, body long, fp long, code long, n int, sketch binary, grams array<long>"
    )


def frequent(docs: DataFrame, shingle: int) -> dict[int, int]:
    """Shingles that several documents of a sample have, and how many; a bounded list."""
    every = max(1, docs.count() // SAMPLE)
    some = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(every)) == 0)
    found = (
        described(some, shingle, None, {}, len)
        .select("code", F.explode("grams").alias("gram"))
        .groupBy("gram")
        .agg(F.count("*").alias("times"), F.min("code").alias("a"), F.max("code").alias("b"))
        .where((F.col("times") >= FREQUENT) & (F.col("a") != F.col("b")))
        .orderBy(F.col("times").desc(), "gram")
        .limit(LISTED)
    )
    return {r.gram % (1 << 64): r.times for r in found.select("gram", "times").collect()}


def _possible(least: tuple[int, int]):
    """Whether the overlap can be enough if rows ``x`` and ``y`` are the first common shingle."""
    a, b = least
    behind = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at")).cast("long")
    return behind * (a + b) >= (F.col("x.n") + F.col("y.n")).cast("long") * a


def _counted(light: DataFrame, heavy: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Pairs ``a, b`` that meet in light groups and have enough common prefix shingles.

    The first common one must be possible. Heavy groups make no pairs here, so all of their
    rows that both texts have count as common.
    """
    met = light.alias("x").join(light.alias("y"), "gram").where(F.col("x.code") < F.col("y.code"))
    pairs = (
        met.groupBy(F.col("x.code").alias("a"), F.col("y.code").alias("b"))
        .agg(
            F.count("*").alias("common"),
            F.max(_possible(least)).alias("near"),
            F.max("x.n").cast("long").alias("n"),
            F.max("y.n").cast("long").alias("m"),
        )
        .where("near")
    )
    held = heavy.groupBy("code").agg(F.count("*").alias("_held"))
    for side in ("a", "b"):
        more = held.select(F.col("code").alias(side), F.col("_held").alias(f"_{side}"))
        pairs = pairs.join(more, side, "left").fillna(0, [f"_{side}"])
    a, b = least
    behind = F.floor((F.greatest("n", "m") * a + (b - 1)) / b) - 1
    most = F.col("common") + F.least("_a", "_b") + behind
    return pairs.where(most * (a + b) >= (F.col("n") + F.col("m")) * a).select("a", "b")


def _pairs(rows: DataFrame) -> DataFrame:
    a, b = F.col("x.code"), F.col("y.code")
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _close(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs whose sketches allow a similarity of ``least``, as a written table."""
    a, b = least

    @F.arrow_udf("boolean")
    def allowed(left: pa.Array, right: pa.Array, sizes: pa.Array) -> pa.Array:
        rows = zip(left, right, sizes.to_pylist())
        return pa.array((differing(x.as_py(), y.as_py()) * (a + b) <= n * (b - a) for x, y, n in rows), pa.bool_())

    for side in ("a", "b"):
        more = sets.select(F.col("code").alias(side), F.col("n").alias(f"_n{side}"), F.col("sketch").alias(f"_{side}"))
        pairs = pairs.join(more, side)
    near = pairs.where(allowed("_a", "_b", (F.col("_na") + F.col("_nb")).cast("long")))
    return written(near.select("a", "b"), "shingle-pairs")


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, shingle: int, least: tuple[int, int]) -> DataFrame:
    """The pairs that are alike, by their whole texts; only texts of pairs move."""

    @F.arrow_udf("boolean")
    def check(left: pa.Array, right: pa.Array) -> pa.Array:
        sets = ((shingle_set(a.as_py(), shingle), shingle_set(b.as_py(), shingle)) for a, b in zip(left, right))
        return pa.array((alike(a, b, least) for a, b in sets), pa.bool_())

    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("code"))
    picked = written(sets.select("code", "doc_id", "body").join(sides.select("code").distinct(), "code"), "shingle-picked")
    # Rows that share an id may have different texts, and equal ones need one.
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("body")).join(picked, ["doc_id", "body"])
    texts = written(texts.select("code", "text").dropDuplicates(["code"]), "shingle-texts")
    both = sides.join(texts, "code").groupBy("a", "b")
    both = both.agg(F.min_by("text", "code").alias("_left"), F.max_by("text", "code").alias("_right"))
    return written(both.where(check("_left", "_right")).select("a", "b"), "shingle-links")


def links(docs: DataFrame, sets: DataFrame, shingle: int = 5, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """Links ``a, b`` that connect all codes with a similarity of ``least`` or more.

    ``sets`` is a written table with one row of ``described`` for each ``code``. Only pairs
    that are alike are linked; those already connected through others may be left out.
    """
    rows = sets.select("code", "n", F.posexplode("grams").alias("at", "gram"))
    shared = written(rows.groupBy("gram").agg(F.count("*").alias("held")).where("held > 1"), "shingle-grams")
    members = written(rows.join(shared, "gram"), "shingle-members")
    light, heavy = members.where(F.col("held") <= MOST), members.where(F.col("held") > MOST)
    pivot = lambda k: F.min(F.struct(F.xxhash64("code", F.lit(k)).alias("key"), "code", "n", "at"))
    tops = heavy.groupBy("gram").agg(F.array(*(pivot(k) for k in range(PIVOTS))).alias("_tops"))
    tops = written(tops.select("gram", F.inline(F.array_distinct("_tops"))), "shingle-pivots")
    near = heavy.alias("x").join(tops.alias("y"), "gram").where((F.col("x.code") != F.col("y.code")) & _possible(least))
    pairs = written(_counted(light, heavy, least).union(_pairs(near)).distinct(), "shingle-met")
    found = _verified(_close(pairs, sets, least), docs, sets, shingle, least)
    if heavy.isEmpty():
        return found
    heavy = _open(heavy, found)
    met = heavy.alias("x").join(heavy.alias("y"), "gram").where(
        (F.col("x.code") < F.col("y.code")) & (F.col("x.root") != F.col("y.root")) & _possible(least) & _first_common()
    )
    pairs = written(_pairs(met), "shingle-met")
    return found.union(_verified(_close(pairs, sets, least), docs, sets, shingle, least))


def _first_common():
    """False if rows ``x`` and ``y`` meet earlier in their orders, by what they have listed.

    Lists hold the first shingles in order. So if a common one is in both, the first common
    one is; if none is, nothing is known, and the pair is made here as well.
    """
    both = F.array_intersect("x.listed", "y.listed")
    return (F.size(both) == 0) | (F.get(both, F.lit(0)) == F.col("gram"))


def _open(heavy: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the groups with more than one component, with ``root`` and the first shingles ``listed``."""
    roots = written(components(found, "shingle-rounds").select(F.col("node").alias("code"), "root"), "shingle-roots")
    first = F.slice(F.array_sort(F.collect_list(F.struct("at", "gram"))), 1, LISTS).getField("gram").alias("listed")
    # The first LISTS rows of every text, before they are put together.
    order = F.row_number().over(Window.partitionBy("code").orderBy("at"))
    lists = heavy.withColumn("_order", order).where(F.col("_order") <= LISTS).groupBy("code").agg(first)
    rows = heavy.join(lists, "code").join(roots, "code", "left").withColumn("root", F.coalesce("root", "code"))
    rows = written(rows, "shingle-rooted")
    groups = rows.groupBy("gram").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("gram")
    return written(rows.join(groups, "gram"), "shingle-heavy")
