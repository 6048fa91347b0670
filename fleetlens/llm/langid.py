"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword. For each bit of the code a binary classifier tells the
languages whose bit is one from the others; its evidence is the mean log-odds of the
text's n-grams, learned from n-gram counts over all labelled documents. Decoding takes
the codeword with the least loss, where a bit counts by the logistic loss of its margin,
so that unsure bits count little. A small lead over the second codeword is flagged.

N-grams (one to three letters, in lower case, words padded by a blank) are hashed into a
fixed number of buckets: counts and model are bounded by buckets x languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 12
UNKNOWN = "und"


def grams(text: str | None, buckets: int = BUCKETS) -> np.ndarray | None:
    """Counts of hashed n-grams; None for a text without letters."""
    if not text:
        return None
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    ascii_letter = (code >= 97) & (code <= 122)
    other = code > 127
    if other.any():
        values = np.unique(code[other])
        other &= np.isin(code, values[[chr(v).isalpha() for v in values.tolist()]])
    letter = ascii_letter | other
    if not letter.any():
        return None
    code = np.concatenate([[32], np.where(letter, code, 32), [32]])
    letter = code != 32
    two = code[:-1] * 1_000_003 + code[1:]
    three = two[:-1] * 1_000_003 + code[2:]
    found = [
        code[letter],
        two[letter[:-1] | letter[1:]] + 1,
        three[letter[1:-1]] + 2,
    ]
    keys = np.concatenate(found)
    keys = _mix(keys) % buckets
    return np.bincount(keys, minlength=buckets)


def _mix(x: np.ndarray) -> np.ndarray:
    y = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((y ^ (y >> np.uint64(29))) >> np.uint64(17)).astype(np.int64)


def codebook(n: int, seed: int = 7) -> np.ndarray:
    """One codeword of +1 and -1 per language; columns differ, also when negated.

    Up to six languages: all splits in two (the exhaustive code, whose words differ in
    2 ** (n - 2) bits). More: random splits, about ten bits per doubling.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 6:
        rest = range(1, n)
        columns = [[1 if i in ones else -1 for i in range(n)] for k in range(n - 1) for ones in ([0, *c] for c in combinations(rest, k))]
        return np.array(columns, float).T
    rng, columns = np.random.default_rng(seed), {}
    while len(columns) < 15 + 10 * int(np.ceil(np.log2(n))):
        c = rng.integers(0, 2, n) * 2 - 1
        c = c * c[0]
        if abs(c.sum()) < n:
            columns[c.tobytes()] = c
    return np.array(list(columns.values()), float).T


@dataclass(frozen=True)
class Model:
    """Languages, their codewords, and per bucket and bit the log-odds of "one"."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    sharpness: float = 8.0
    lead: float = 0.2

    def decode(self, counts: np.ndarray | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the choice is ambiguous."""
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, True
        n = counts.sum()
        margin = self.sharpness * (counts @ self.weights) / n * min(1.0, n / 20)
        loss = np.logaddexp(0, -self.code * margin).sum(1)
        order = np.argsort(loss, kind="stable")
        share = np.exp(-(loss - loss[order[0]]))
        score = float(1 / share.sum())
        second = share[order[1]] / share.sum() if len(order) > 1 else 0.0
        return self.languages[order[0]], score, bool(score - second < self.lead)


def gram_counts(docs: DataFrame, lang: str = "lang", buckets: int = BUCKETS) -> DataFrame:
    """``lang, bucket, n``: n-gram counts of each language, summed in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = grams(text.as_py(), buckets)
                if found is not None:
                    sums[name] = sums[name] + found if name in sums else found
        for name, found in sums.items():
            at = np.nonzero(found)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(found[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    used = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull()).select(lang, "text")
    rows = used.mapInArrow(count, "lang string, bucket int, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, buckets: int = BUCKETS, smooth: float = 0.5) -> Model:
    """Learn from all labelled documents. Languages x buckets numbers come to the driver."""
    rows = gram_counts(docs, buckets=buckets).collect()
    languages = tuple(sorted({r[0] for r in rows}))
    counts = np.zeros((len(languages), buckets))
    at = {name: i for i, name in enumerate(languages)}
    for name, bucket, n in rows:
        counts[at[name], bucket] = n
    code = codebook(len(languages))
    # Every language has the same say in a bit, however many documents it has.
    share = (counts + smooth) / (counts + smooth).sum(1, keepdims=True)
    ones, zeros = (code > 0).astype(float), (code < 0).astype(float)
    one = (ones.T @ share) / np.maximum(ones.sum(0), 1)[:, None]
    zero = (zeros.T @ share) / np.maximum(zeros.sum(0), 1)[:, None]
    weights = np.log(one / np.where(zero > 0, zero, one)).T if len(languages) else np.zeros((buckets, 1))
    return Model(languages, code, weights)


def identified(docs: DataFrame, model: Model, buckets: int = BUCKETS) -> DataFrame:
    """Add ``lang_pred, score, ambiguous`` in a struct ``found`` to ``docs``.

    Only the text is looked at. A text that is null or has no letters is "und" with score
    0, and so is everything if nothing was learned.
    """

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean")
    def decode(texts: pa.Array) -> pa.Array:
        rows = [model.decode(grams(t.as_py(), buckets)) for t in texts]
        columns = list(zip(*rows)) if rows else [[], [], []]
        kinds = (pa.string(), pa.float64(), pa.bool_())
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang_pred", "score", "ambiguous"]
        )

    return docs.withColumn("found", decode("text"))


def fold(key: Column) -> Column:
    """CRC-32 of the id as text, modulo 3; an id that is null counts as empty."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3
