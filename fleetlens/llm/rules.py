"""Quality rules as weak supervision: rules vote or abstain, EM weighs the votes.

Each rule looks at one property of a text and votes "good" (1), "bad" (-1) or abstains
(0). Documents with the same votes are alike to the model, and there are at most
``3 ** len(RULES)`` vote patterns, whatever the number of documents: the table of pattern
counts is what expectation-maximisation needs. It estimates, for good and for bad
documents, how often each rule gives each vote, and from these the probability that a
document with a pattern is good.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fleetlens.llm.shared import fresh, written

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_marks",
    "n_letters",
    "n_distinct",
    "n_ends",
    "n_bare",
)


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of a text, in the order of ``COUNTS``. Null counts as no text.

    Words are runs without ASCII white space, lines are cut at ``\\n`` and count if they
    hold a word. ``n_repeat_words`` are the words inside 3-word windows that the text has
    twice or more, the first ones included.
    """
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    lines = [line for line in raw.split(b"\n") if line.split(None, 1)]
    spaces = sum(raw.count(c) for c in (bytes([b]) for b in SPACE))
    ids = defaultdict(count().__next__)
    code = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    repeated = 0
    if n >= 3:
        pair = np.unique(code[:-1] * len(ids) + code[1:], return_inverse=True)[1]
        _, where, times = np.unique(pair[:-1] * len(ids) + code[2:], return_inverse=True, return_counts=True)
        twice = times[where] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= twice
        repeated = int(covered.sum())
    times = np.bincount(code, minlength=len(ids))
    upper = sum(times[k] for w, k in ids.items() if len(w) > 1 and w.isupper())
    bare = sum(times[k] for w, k in ids.items() if not _LETTER.search(w))
    ends = sum(line.rstrip()[-1:] in b".!?:;\"'" for line in lines)
    return (
        n,
        len(text) - spaces,
        sum(raw.count(bytes([b])) for b in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        int(upper),
        raw.count(b"!"),
        sum(map(str.isalpha, text)) if not text.isascii() else len(raw) - _others(raw),
        len(ids),
        ends,
        int(bare),
    )


_LETTER = re.compile(rb"[0-9A-Za-z\x80-\xff]")
_LETTERS = bytes(b for b in range(256) if chr(b).isascii() and chr(b).isalpha())


def _others(raw: bytes) -> int:
    return len(raw.translate(None, _LETTERS))


@F.arrow_udf(StructType([StructField(c, LongType()) for c in COUNTS]))
def measured(texts: pa.Array) -> pa.Array:
    rows = [measure(t.as_py()) for t in texts]
    columns = list(zip(*rows)) if rows else [[]] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(COUNTS))


@dataclass(frozen=True)
class Rule:
    """Good below ``good``, bad above ``bad``, abstains between or on too little text."""

    name: str
    ratio: Callable[[Callable[[str], Column]], tuple[Column, Column]]
    good: float
    bad: float
    least: int = 1

    def vote(self, of: Callable[[str], Column]) -> Column:
        top, base = self.ratio(of)
        x = top / F.when(base >= self.least, base)
        return F.when(x > self.bad, -1).when(x < self.good, 1).otherwise(0)


#: Ratios of counts and their two limits; every rule is "less is better".
RULES = (
    Rule("symbols", lambda c: (c("n_symbols"), c("n_words")), 0.05, 0.2),
    Rule("upper", lambda c: (c("n_upper"), c("n_words")), 0.1, 0.4),
    Rule("marks", lambda c: (c("n_marks"), c("n_words")), 0.1, 0.4),
    Rule("same_lines", lambda c: (c("n_dup_lines"), c("n_lines")), 0.1, 0.5, 3),
    Rule("same_words", lambda c: (c("n_repeat_words"), c("n_words")), 0.1, 0.4),
    Rule("few_words", lambda c: (c("n_words") - c("n_distinct"), c("n_words")), 0.5, 0.75),
    Rule("long_words", lambda c: (c("word_chars"), c("n_words")), 7.0, 9.0),
    Rule("no_letters", lambda c: (c("word_chars") - c("n_letters"), c("word_chars")), 0.08, 0.25),
    Rule("bare_words", lambda c: (c("n_bare"), c("n_words")), 0.02, 0.2),
    Rule("open_lines", lambda c: (c("n_lines") - c("n_ends"), c("n_lines")), 0.4, 0.8),
)


@dataclass(frozen=True)
class Base:
    """Hard limits besides the votes."""

    min_words: int = 50
    repeat_percent: int = 50


def pattern(of: Callable[[str], Column], rules=RULES) -> Column:
    """All votes as one number in base 3."""
    code = F.lit(0).cast("long")
    for rule in rules:
        code = code * 3 + rule.vote(of) + 1
    return code


#: Where the estimation starts: how often a rule votes "bad" on bad and on good documents.
START = (0.3, 0.01)


def posteriors(
    patterns: dict[int, int], n_rules: int, steps: int = 200, prior: float = 0.85, smooth: float = 1.0
) -> dict[int, float]:
    """Probability of "good" for each pattern, by expectation-maximisation.

    ``patterns`` has the number of documents of each pattern. A class is described by how
    often each rule votes bad, abstains or votes good on it. A bad document usually has
    one fault and passes the other rules, so the start expects few bad votes on bad
    documents and hardly any on good ones; this also fixes which class is which.
    """
    if not patterns:
        return {}
    keys = sorted(patterns)
    weight = np.array([patterns[k] for k in keys], float)
    votes = np.array([[k // 3**i % 3 for i in reversed(range(n_rules))] for k in keys])
    chosen = np.eye(3)[votes]
    share = np.einsum("p,prv->rv", weight, chosen) / weight.sum()
    abstain = np.clip(share[:, 1], 0.01, 0.9)
    table = np.stack([np.stack([b * (1 - abstain), abstain, (1 - b) * (1 - abstain)], 1) for b in reversed(START)])
    good = prior
    for _ in range(steps):
        each = np.einsum("prv,crv->pc", chosen, np.log(table)) + np.log([good, 1 - good])
        each = np.exp(each - each.max(1, keepdims=True))
        each /= each.sum(1, keepdims=True)
        mass = each * weight[:, None]
        seen = np.einsum("pc,prv->crv", mass, chosen) + smooth
        new = seen / seen.sum(2, keepdims=True)
        good = float(np.clip(mass[:, 0].sum() / weight.sum(), 0.01, 0.99))
        done = np.abs(new - table).max() < 1e-9
        table = new
        if done:
            break
    return dict(zip(keys, each[:, 0].tolist()))


def kept_documents(docs: DataFrame, base: Base = Base()) -> DataFrame:
    """``docs`` without the documents that the rules or ``base`` reject; all columns stay as they are."""
    name = fresh(docs, "_quality")
    table = written(docs.withColumn(name, measured("text")), "quality-docs")
    return judged(table, name, base).where(F.col(f"`{name}`.kept")).select(*docs.columns)


def judged(docs: DataFrame, counts: str, base: Base = Base(), rules=RULES) -> DataFrame:
    """Add ``base_failed, p_good, kept`` inside the struct column ``counts``.

    ``docs`` should be a written table; its patterns are counted first, over all rows.
    An empty table stays empty.
    """
    of = lambda c: F.col(f"`{counts}`.`{c}`")
    code = pattern(of, rules)
    found = {r[0]: r[1] for r in docs.groupBy(code.alias("p")).agg(F.count("*")).collect()}
    p_good = posteriors(found, len(rules))
    spark = docs.sparkSession
    # At most 3 ** len(rules) rows, whatever the number of documents.
    known = spark.createDataFrame([(k, v) for k, v in p_good.items()], "_pattern long, _p_good double")
    failed = (of("n_words") < base.min_words) | (
        100 * of("n_repeat_words") > base.repeat_percent * of("n_words")
    )
    return (
        docs.join(F.broadcast(known), code == F.col("_pattern"), "left")
        .withColumn(
            counts,
            F.col(counts)
            .withField("base_failed", failed)
            .withField("p_good", F.col("_p_good"))
            .withField("kept", ~failed & (F.col("_p_good") >= 0.5)),
        )
        .drop("_pattern", "_p_good")
    )
