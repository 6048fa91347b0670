"""Repeated line runs, found by prefix doubling over the corpus as sequences of line ids.

Every line with a word becomes an id; a document is a sequence of ids. Lines that occur
once can be in no repeated run, so only suffixes that begin with a repeated line are kept.
Their rank is their group's first place in the suffix array: first by one line, then, as
rank pairs (this suffix, the suffix behind the known prefix), by 2, 4, ... lines, until no
two suffixes share a prefix that long. A group of equal rank at some depth is an interval
of suffixes whose longest common prefix is at least that deep. Any depth between two
powers is two overlapping known prefixes.

A run counts if it has ``min_words`` words. In each interval the first occurrence (by
document, then line) stays and later ones are cut, each from its line on to the deepest
interval in which it comes later. Depths of ``min_words`` lines and more have the words by
themselves. Below that the prefixes that have them are looked up, from the shortest on
while the lines behind the first one have fewer words; what a longer one would add begins
one line further on. Spans that touch are one maximal run: all lines of every repeated run
go in its later copies, to the last line of the run.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from fleetlens.llm.shared import WORD, fresh, running_before, unit, written


#: A document is a row's id and a hash of its text: rows may share an id and not a text.
KEY = ["doc_id", "body"]


def _body() -> Column:
    return F.xxhash64("text")


def line_ids(docs: DataFrame) -> DataFrame:
    """``doc_id, body, seq, h1, h2, words``: the lines that hold a word, numbered by ``seq``.

    Lines are cut at ``\\n``. Rows equal in id and text are one document; their lines
    come once for each of them.
    """
    coded = F.transform(
        F.split("text", "\n", -1),
        lambda x: F.struct(
            F.xxhash64(x).alias("h1"),
            F.hash(x).alias("h2"),
            F.regexp_count(x, F.lit(WORD)).alias("words"),
        ),
    )
    held = F.filter(coded, lambda x: x["words"] > 0)
    return (
        docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .select("doc_id", _body().alias("body"), F.posexplode(held).alias("seq", "_l"))
        .select(*KEY, "seq", "_l.*")
    )


def _ranked(pairs: DataFrame, place, base: str | None, order: list[str]) -> DataFrame:
    """Give each pair group its first place in the suffix array, within its old group."""
    group = [base] if base else ["_all"]
    pairs = pairs if base else pairs.withColumn("_all", F.lit(0))
    ranked = running_before(pairs, group, place, order, "n", "_before")
    return ranked.withColumn("new_rank", F.col("_before") + (F.col(base) if base else F.lit(1)))


def suffix_ranks(ids: DataFrame, depth: int | None = None) -> list[DataFrame]:
    """Ranks at depths 1, 2, 4, ... lines: ``doc_id, body, seq, rank`` each.

    The first one also has ``words``. Suffixes alone in their interval are dropped on the
    way: no other suffix shares so long a prefix. Ends when none are left, or at ``depth``.
    """
    groups = written(
        ids.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1"), "line-groups"
    )
    total = groups.agg(F.sum("n")).first()[0] or 0
    first = _ranked(groups, unit(F.col("h1")), None, ["h1", "h2"]).select("h1", "h2", F.col("new_rank").alias("rank"))
    # Here the lines of equal rows become one: after this no step can multiply them.
    level = written(
        ids.join(written(first, "line-ranks"), ["h1", "h2"])
        .select(*KEY, "seq", "words", "rank")
        .dropDuplicates([*KEY, "seq"]),
        "line-suffixes",
    )
    levels, step = [level], 1
    while depth is None or 2 * step <= depth:
        here = level.select(*KEY, "seq", "rank")
        behind = level.select(*KEY, (F.col("seq") - step).alias("seq"), F.col("rank").alias("next"))
        both = written(here.join(behind, [*KEY, "seq"]), "line-pairs")
        pairs = written(
            both.groupBy("rank", "next").agg(F.count("*").alias("n")).where("n > 1"), "line-pair-groups"
        )
        if pairs.isEmpty():
            break
        place = F.col("next") / F.lit(float(total + 2))
        ranks = written(_ranked(pairs, place, "rank", ["next"]).select("rank", "next", "new_rank"), "line-ranks")
        level = written(
            both.join(ranks, ["rank", "next"]).select(*KEY, "seq", F.col("new_rank").alias("rank")), "line-suffixes"
        )
        levels.append(level)
        step *= 2
    return levels


def windows(levels: list[DataFrame], min_words: int) -> DataFrame:
    """For each suffix its short prefixes with ``min_words`` words: ``doc_id, body, seq, size``.

    The shortest, and others with fewer words behind their first line: at most
    ``min_words`` lines.
    Prefixes that reach over a line that occurs once are left out: no copy of them exists.
    """
    base = levels[0].select(*KEY, "seq", "words")
    open_, found = base.withColumn("sum", F.col("words")).withColumn("behind", F.lit(0).cast("long")), None
    for size in range(1, min_words + 1):
        done = open_.where(F.col("sum") >= min_words).select(*KEY, "seq", F.lit(size).alias("size"))
        found = done if found is None else found.union(done)
        if size == min_words:
            break
        more = base.select(*KEY, (F.col("seq") - size).alias("seq"), F.col("words").alias("_more"))
        open_ = written(
            open_.join(more, [*KEY, "seq"])
            .where((F.col("sum") < min_words) | (F.col("behind") + F.col("_more") < min_words))
            .select(*KEY, "seq", *((F.col(c) + F.col("_more")).alias(c) for c in ("sum", "behind"))),
            "line-windows",
        )
    return found


def _later(keyed: DataFrame, by: list[str], size: Column) -> DataFrame:
    """Of each interval all suffixes but the first: ``doc_id, body, seq, size``."""
    at = F.struct(*KEY, "seq")
    firsts = keyed.groupBy(*by).agg(F.count("*").alias("n"), F.min(at).alias("first")).where("n > 1")
    later = keyed.join(written(firsts, "line-firsts"), by).where(at != F.col("first"))
    return later.select(*KEY, "seq", size.cast("int").alias("size"))


def later_copies(docs: DataFrame, min_words: int = 6) -> DataFrame:
    """What of each document is a later copy: ``doc_id, body, spans``.

    ``spans`` are places ``start, end`` among the lines that hold a word, one for each line
    at which a later copy begins. ``body`` is the hash of the text. Documents with a null id
    or text take no part. Rows equal in id and text are one document, which is no copy of
    itself; of rows that share an id only, the one with the smaller hash comes first. An
    empty table gives no rows.
    """
    ids = written(line_ids(docs), "line-ids")
    levels = suffix_ranks(ids)
    short = written(windows(levels, min_words), "line-sized")
    keyed, found = None, None
    for j, level in enumerate(levels):
        step = 1 << j
        ranks = level.select(*KEY, "seq", "rank")
        if step >= min_words:
            deep = _later(ranks, ["rank"], F.lit(step))
            found = deep if found is None else found.union(deep)
        if step <= min_words:
            fit = short.where((F.col("size") >= step) & (F.col("size") < 2 * step))
            tail = ranks.select(*KEY, F.col("seq").alias("at"), F.col("rank").alias("tail"))
            part = (
                fit.join(ranks, [*KEY, "seq"])
                .withColumn("at", F.col("seq") + F.col("size") - step)
                .join(tail, [*KEY, "at"])
                .select(*KEY, "seq", "size", "rank", "tail")
            )
            keyed = part if keyed is None else keyed.union(part)
    keyed = written(keyed.distinct(), "line-intervals")
    later = _later(keyed, ["size", "rank", "tail"], F.col("size"))
    found = later if found is None else later.union(found)
    longest = found.groupBy(*KEY, "seq").agg(F.max("size").alias("size"))
    span = F.struct(F.col("seq").alias("start"), (F.col("seq") + F.col("size")).alias("end"))
    return longest.groupBy(*KEY).agg(F.collect_list(span).alias("spans"))


_RUN = StructType([StructField("first", IntegerType()), StructField("last", IntegerType())])


@F.arrow_udf(
    StructType(
        [StructField("text", StringType()), StructField("words", LongType()), StructField("runs", ArrayType(_RUN))]
    )
)
def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out, words, runs = [], [], []
    for text, some in zip(texts.to_pylist(), spans.to_pylist()):
        if text is None or not some:
            out.append(text)
            words.append(None)
            runs.append([])
            continue
        parts, own, end = text.split("\n"), [], 0
        held = [len(x.encode("utf-8", "surrogatepass").split()) for x in parts]
        at = [i for i, n in enumerate(held) if n]
        for s in sorted(some, key=lambda s: s["start"]):
            if own and s["start"] <= end:
                own[-1]["last"] = at[max(end, s["end"]) - 1]
            else:
                own.append({"first": at[s["start"]], "last": at[s["end"] - 1]})
            end = max(end, s["end"])
        gone = {i for r in own for i in range(r["first"], r["last"] + 1) if held[i]}
        out.append("\n".join(x for i, x in enumerate(parts) if i not in gone))
        words.append(sum(n for i, n in enumerate(held) if i not in gone))
        runs.append(own)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    return pa.StructArray.from_arrays(
        [pa.array(out, pa.string()), pa.array(words, pa.int64()), pa.array(runs, kind)],
        names=["text", "words", "runs"],
    )


def deduped(docs: DataFrame, min_words: int = 6, runs: str = "removed_runs", words: str = "words_left") -> DataFrame:
    """``docs`` with the lines of later copies cut from ``text``.

    Adds ``runs``, the maximal removed runs as first and last line numbers of the old text
    (word-less lines between two removed lines do not part a run, and stay), and ``words``,
    the words left, or null where nothing was cut. Null texts stay null. Rows equal in id
    and text come out alike; see :func:`later_copies`.
    """
    body, gone, new = fresh(docs, "_body"), fresh(docs, "_gone"), fresh(docs, "_new")
    cuts = later_copies(docs, min_words).select("doc_id", F.col("body").alias(body), F.col("spans").alias(gone))
    cuts = written(cuts, "line-cuts")
    # Always by shuffle: with a broadcast on small inputs only, their figures say nothing.
    joined = docs.withColumn(body, _body()).join(cuts.hint("merge"), ["doc_id", body], "left")
    joined = joined.withColumn(new, _without("text", F.col(gone)))
    others = [F.col(new)["text"].alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return joined.select(*others, F.col(new)["runs"].alias(runs), F.col(new)["words"].alias(words))


def cut_documents(docs: DataFrame, min_words: int = 6) -> DataFrame:
    """``docs`` with the columns they have, without repeated runs.

    ``n_chars``, if there, follows the new text. A document goes only if it had words and
    all of them were in later copies.
    """
    runs, words = fresh(docs, "_runs"), fresh(docs, "_words")
    out = deduped(docs, min_words, runs, words).where(f"`{words}` is null or `{words}` > 0")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(words).isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return out.select(*docs.columns)
