"""Spelling variants: words one edit apart, tied to the commonest of them.

Asymmetric q-chunks. Of two words that may be one edit apart the shorter one (of equal
ones each) is cut into two disjoint chunks; one edit leaves one of them whole. The longer
one brings its grams: pieces of the same size at every place within one shift of the
chunk's own, where the difference of the lengths says which shift. Only equal pieces at
fitting places meet. A common beginning or ending alone would bring large parts of a
vocabulary together, so the chunk that holds the edit is treated in the same way once
more: one of its two chunks is whole too. A meeting place is thus a whole half and a whole
quarter, three quarters of the word, for words of every length and frequency alike. A pair
that meets in several places counts in the first one. Every pair is verified by its edit
distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import written

RUN = re.compile("[a-zÀ-ÿ]+")
#: Different words that a task adds up before it hands them on.
GATHERED = 200_000


def words_of(doc_id: int | None, text: str | None, every: int = 97) -> Counter:
    """The words of one text: runs of letters, only A-Z lower-cased.

    One run in ``every``, chosen by the CRC-32 of ``<doc_id>:<run>``, loses one code point.
    """
    if not text:
        return Counter()
    # Only ASCII letters: bytes know no others.
    runs = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        code = zlib.crc32(run.encode(), start)
        if code % every == 0:
            at = code % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def vocabulary(
    docs: DataFrame, shortest: int = 5, least: int = 3, every: int = 97, gathered: int = GATHERED
) -> DataFrame:
    """``word, n``: words of ``shortest`` code points with ``least`` occurrences in all texts.

    A null text has no words, a null id counts as empty, repeated rows count each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def batch() -> pa.RecordBatch:
            words, n = list(found.keys()), list(found.values())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for rows in batches:
            for key, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                for word, n in words_of(key, text.as_py(), every).items():
                    if len(word) >= shortest:
                        found[word] += n
                if len(found) > gathered:
                    yield batch()
                    found.clear()
        if found:
            yield batch()

    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _places(word: Column, length: Column, longer: int, moved: int) -> list[Column]:
    """The four meeting places of a word, as hashes.

    ``length`` is that of the chunked word, ``longer`` by how much the other one is longer.
    ``moved`` is 0 for the chunked word and ``longer`` for the other one, whose grams stand
    so much later behind the edit.
    """
    half = F.floor(length / 2).cast("int")
    early, late = F.floor(half / 2).cast("int"), F.floor((length - half) / 2).cast("int")
    piece = lambda start, size: F.substring(word, start + 1, size)
    zero = F.lit(0)
    front, back = piece(zero, half), piece(half + moved, length - half)
    pairs = [
        (back, piece(zero, early)),
        (back, piece(early + moved, half - early)),
        (front, piece(half, late)),
        (front, piece(half + late + moved, length - half - late)),
    ]
    return [F.xxhash64(F.lit(4 * longer + k), length, *p) for k, p in enumerate(pairs)]


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of words that are one edit apart, once.

    ``words`` should be a written table of ``word, n`` without repeated words. ``a`` is the
    shorter word, or the smaller one of two as long.
    """
    base = words.select("word", "n", F.length("word").alias("size"))
    word, size = F.col("word"), F.col("size")
    chunked = base.select(
        F.posexplode(F.array(*_places(word, size, 0, 0), *_places(word, size, 1, 0))).alias("place", "code"),
        word.alias("a"),
        F.col("n").alias("a_n"),
    )
    grams = base.select(
        F.explode(F.array(*_places(word, size, 0, 0), *_places(word, size - 1, 1, 1))).alias("code"),
        word.alias("b"),
        F.col("n").alias("b_n"),
    )
    a, b, length = F.col("a"), F.col("b"), F.length("a")
    longer = F.length("b") - length
    first = F.lit(None).cast("int")
    for one in (1, 0):
        for k, (x, y) in reversed(list(enumerate(zip(_places(a, length, one, 0), _places(b, length, one, one))))):
            first = F.when((longer == one) & (x == y), 4 * one + k).otherwise(first)
    # Spark takes eight places a word for one, and would send them through the driver.
    return (
        chunked.join(grams.hint("merge"), "code")
        .where(((longer == 1) | (a < b)) & (F.levenshtein(a, b, 1) == 1) & (first == F.col("place")))
        .select("a", "a_n", "b", "b_n")
    )


def forms(words: DataFrame, factor: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n`` for every word of a written table ``word, n``.

    ``form`` is the commonest near word (of equally common ones the smallest by code
    points), if it is ``factor`` times as common as the word; else null. Both directions of
    a pair are reduced in the tasks that find it, before they are dealt out by word.
    """
    pairs = near_pairs(words)
    met = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
            F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
        )
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = (
        pairs.select(met.alias("_m"))
        .select("_m.*")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), best.alias("_best"))
    )
    common = -F.col("_best.less") >= factor * F.col("n")
    return words.join(near.hint("merge"), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("_best.near")).alias("form"),
        F.when(common, -F.col("_best.less")).alias("form_n"),
    )


def with_roots(found: DataFrame) -> DataFrame:
    """Add ``root``: from the word along ``form`` to the last one; the word itself without one.

    Counts at least double from word to form, so there are no circles, and a chain is no
    longer than the binary logarithm of the largest count. Each round doubles how far a
    word sees. A form that very many words share is a hot key of these joins; both sides
    are read from written tables, so that adaptive execution can split it. Nothing is
    broadcast: in memory, rows take a multiple of their place in a file.
    """
    steps = written(found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        next_ = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = steps.join(next_.hint("merge"), "root", "left")
        steps = written(
            joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "spelling-steps",
        )
        moved = not steps.where("_moved").isEmpty()
        steps = steps.drop("_moved")
        if not moved:
            break
    return found.join(steps.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, shortest: int = 5, least: int = 3, factor: int = 2, every: int = 97) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the corpus.

    See :func:`vocabulary`, :func:`forms` and :func:`with_roots`. An empty table, or one
    without words, gives no rows. Extra columns of ``docs`` are not read.
    """
    words = written(vocabulary(docs, shortest, least, every), "spelling-words")
    found = written(forms(words, factor), "spelling-forms")
    return with_roots(found).select("word", "form", "root", "n", "n_near", "form_n")
