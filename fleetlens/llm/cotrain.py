"""Quality classifier by co-training on two views of a document.

One classifier sees the content (shares of symbols, capitals, repeats, ...), the other
the page's metadata (source, language, size, line layout). Both start from the labelled
documents. In each round each view labels the unlabelled documents that it is sure of, and
the other view learns from those as well. At the end each view's log-odds are calibrated
on labelled documents that were never trained on, and the two are added up as evidence
from independent views. Fitting is Spark's own distributed logistic regression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.rules import measured
from fleetlens.llm.shared import written

SOURCES, LANGUAGES = 32, 8


def _ratio(a: str, b: str) -> Column:
    return F.coalesce(F.col(f"m.{a}") / F.nullif(F.col(f"m.{b}"), F.lit(0)), F.lit(0.0))


def _one_hot(name: str, n: int) -> list[Column]:
    at = F.pmod(F.hash(F.coalesce(F.col(name), F.lit(""))), F.lit(n))
    return [(at == i).cast("double") for i in range(n)]


def views(docs: DataFrame) -> DataFrame:
    """``doc_id, content, meta``: the two views as arrays of doubles.

    A null or empty text has zeros as content; missing metadata are a value of their own.
    """
    measured_docs = docs.select("doc_id", "source", "lang", "n_chars", measured("text").alias("m"))
    log = lambda c: F.log1p(F.greatest(c, F.lit(0)).cast("double"))
    content = F.array(
        _ratio("n_symbols", "n_words"),
        _ratio("n_upper", "n_words"),
        _ratio("n_marks", "n_words"),
        _ratio("n_repeat_words", "n_words"),
        _ratio("n_distinct", "n_words"),
        _ratio("n_bare", "n_words"),
        _ratio("n_letters", "word_chars"),
        _ratio("word_chars", "n_words"),
        log(F.col("m.n_words")),
    )
    n_chars = F.coalesce(F.col("n_chars"), F.lit(0))
    per_line = F.coalesce(n_chars / F.nullif(F.col("m.n_lines"), F.lit(0)), F.lit(0.0))
    meta = F.array(
        log(n_chars),
        log(F.col("m.n_lines")),
        log(per_line),
        _ratio("n_dup_lines", "n_lines"),
        _ratio("n_ends", "n_lines"),
        *_one_hot("lang", LANGUAGES),
        *_one_hot("source", SOURCES),
    )
    return measured_docs.select("doc_id", content.alias("content"), meta.alias("meta"))


@dataclass(frozen=True)
class Linear:
    weights: tuple[float, ...]
    bias: float

    def log_odds(self, view: str) -> Column:
        products = F.zip_with(view, F.array(*map(F.lit, self.weights)), lambda x, w: x * w)
        return F.aggregate(products, F.lit(float(self.bias)), lambda s, x: s + x)


def _fit(rows: DataFrame, view: str, label: Column, weight: Column, steps: int = 12) -> Linear:
    data = rows.select(array_to_vector(F.col(view)).alias("features"), label.cast("double").alias("label"), weight.alias("weight"))
    model = LogisticRegression(maxIter=steps, regParam=1e-3, weightCol="weight").fit(data.where("label is not null"))
    return Linear(tuple(map(float, model.coefficients)), float(model.intercept))


def _calibration(rows: DataFrame, odds: Column) -> tuple[float, float]:
    """Slope and shift of the log-odds (Platt), from labelled rows."""
    fitted = _fit(rows.select(F.array(odds).alias("s"), "label"), "s", F.col("label"), F.lit(1.0))
    return max(fitted.weights[0], 0.0), fitted.bias


def scored(
    docs: DataFrame,
    labels: DataFrame,
    rounds: int = 2,
    sure: float = 0.95,
    pseudo_weight: float = 0.5,
    calibration_share: int = 5,
) -> DataFrame:
    """``doc_id, p_content, p_meta, p_good, kept`` for every document.

    ``labels`` has ``doc_id, quality`` (0 or 1); of repeated labels the largest counts. One
    labelled document in ``calibration_share`` (by hash of the id) calibrates and never
    trains. Without labels of both classes there is nothing to learn: every probability is
    the share of good labels, or 0.5 without any. Repeated rows give repeated results.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(calibration_share)) == 0
    rows = written(
        written(views(docs), "quality-views").join(known, "doc_id", "left").withColumn("held", held & F.col("label").isNotNull()),
        "quality-rows",
    )
    counts = {(r[0], r[1]): r[2] for r in rows.where("label is not null").groupBy("held", "label").count().collect()}
    if any(not counts.get((h, c)) for h in (True, False) for c in (0.0, 1.0)):
        good, all_ = sum(n for (_, c), n in counts.items() if c), sum(counts.values())
        p = F.lit(good / all_ if all_ else 0.5)
        return rows.select("doc_id", p.alias("p_content"), p.alias("p_meta"), p.alias("p_good"), (p >= 0.5).alias("kept"))
    training = rows.where("not held")
    true = F.col("label")
    content = _fit(training, "content", true, F.lit(1.0))
    meta = _fit(training, "meta", true, F.lit(1.0))
    limit = math.log(sure / (1 - sure))

    def with_pseudo(teacher: Column) -> tuple[Column, Column]:
        taught = F.when(teacher > limit, 1.0).when(teacher < -limit, 0.0)
        return F.coalesce(true, taught), F.when(true.isNotNull(), 1.0).otherwise(pseudo_weight)

    for _ in range(rounds):
        by_content, by_meta = content.log_odds("content"), meta.log_odds("meta")
        content, meta = (
            _fit(training, "content", *with_pseudo(by_meta)),
            _fit(training, "meta", *with_pseudo(by_content)),
        )
    odds = {"content": content.log_odds("content"), "meta": meta.log_odds("meta")}
    held_rows = rows.where("held")
    prior = math.log(counts[True, 1.0] / counts[True, 0.0])
    calibrated = {}
    for view, o in odds.items():
        slope, shift = _calibration(held_rows, o)
        calibrated[view] = o * slope + shift
    both = calibrated["content"] + calibrated["meta"] - prior
    p = lambda o: 1 / (1 + F.exp(-o))
    return rows.select(
        "doc_id",
        p(calibrated["content"]).alias("p_content"),
        p(calibrated["meta"]).alias("p_meta"),
        p(both).alias("p_good"),
        (both >= 0).alias("kept"),
    )
