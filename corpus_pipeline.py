"""From documents to training sequences, in stages that are written and read again.

Each stage works on all that the one before it kept; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import lines, mixing, packing, rules, simhash
from fleetlens.llm.queries import added, levels, tokenizer, vocabulary_json
from fleetlens.llm.shared import written


def _whole_texts(spark: SparkSession) -> None:
    """Rows are whole texts here: fewer of them at once for the Python workers than by default."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 500:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed votes of the rules call good, short ones too."""
    _whole_texts(spark)
    return rules.kept_documents(docs, rules.Base(min_words=0))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of six or more words are cut; documents cut to nothing go."""
    _whole_texts(spark)
    return lines.cut_documents(docs, min_words=6)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays.

    Linked are fingerprints within three bits, and all texts whose five-word shingles have
    a Jaccard similarity of 0.8 or more.
    """
    _whole_texts(spark)
    return simhash.one_of_each(docs, shingle=5, radius=3, least=(4, 5))


#: Target weights that are not 1: English is more than the other languages.
WEIGHTS = {("domain0", "en"): 4, ("domain1", "en"): 3, ("domain2", "en"): 3}


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents of a nine tenths budget, handed down domain, language and source."""
    return mixing.mixed_documents(docs, levels(), share=(9, 10), weights=WEIGHTS, seed=42)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens."""
    _whole_texts(spark)
    ranks, split = tokenizer()
    return packing.packed(docs, ranks, split, 2048, added(), vocabulary_json())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: SQL has neither the estimation of rule accuracies nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
