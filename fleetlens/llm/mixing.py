"""Mixing sources to target weights: a token budget handed down a tree of groups.

The leaves of the tree are groups of documents, for example domain / language / source.
A node's budget is shared among its children by weight. A child that has too few tokens
(even after ``max_epochs`` repetitions) gets all it has, and what it leaves goes to its
siblings by their weights; only what all of them cannot use is missing at the parent,
whose own siblings take it. Since a node's capacity is the sum of its children's, this is
one pass from the root down. All arithmetic is on whole numbers; rounding loses less
than one token per child.

Each leaf then takes whole epochs of its documents, and of the next epoch a prefix of
exactly the tokens that are left, in an order drawn from the seed, the epoch and the id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.shared import WORD, running_before, written


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(levels: list[str], weights: dict[tuple, int]) -> Column:
    """The weight of the node named by ``levels``; 1 if it is not listed."""
    chosen = [(k, w) for k, w in weights.items() if len(k) == len(levels)]
    parts = [
        (reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(levels, k))), w)
        for k, w in chosen
    ]
    return reduce(lambda c, p: F.when(p[0], p[1]).otherwise(c), parts, F.lit(1)).cast("long")


def budgets(leaves: DataFrame, levels: list[str], total: Column, weights: dict[tuple, int]) -> DataFrame:
    """Add ``budget`` to each leaf, given its ``capacity`` in tokens.

    ``total`` is the budget of the root. Nodes of weight zero get nothing.
    """
    out = leaves.withColumn("budget", total.cast("long"))
    for depth in range(1, len(levels) + 1):
        node, parent = levels[:depth], levels[: depth - 1]
        nodes = (
            out.groupBy(*node)
            .agg(F.sum("capacity").alias("_cap"), F.first("budget").alias("_budget"))
            .withColumn("_weight", _weight(node, weights))
            .where("_weight > 0")
        )
        family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
        before = family.orderBy(F.col("_cap") / F.col("_weight"), *node).rowsBetween(Window.unboundedPreceding, -1)
        nodes = (
            nodes.withColumn("_used", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
            .withColumn("_open", F.sum("_weight").over(family) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
            # A child is short if it has no more than an equal share of what is left.
            .withColumn("_short", F.expr("_cap * _open <= (_budget - _used) * _weight"))
            .withColumn("_left", F.col("_budget") - F.sum(F.expr("if(_short, _cap, 0)")).over(family))
            .withColumn("_rest", F.sum(F.expr("if(_short, 0, _weight)")).over(family))
            .select(*node, F.expr("if(_short, _cap, (_left * _weight) div _rest)").alias("_share"))
        )
        out = out.join(nodes, node).withColumn("budget", F.col("_share")).drop("_share")
    return out


def mix(
    docs: DataFrame,
    levels: dict[str, Column],
    share: tuple[int, int] = (1, 1),
    weights: dict[tuple, int] | None = None,
    max_epochs: int = 1,
    seed: int = 42,
) -> DataFrame:
    """The chosen rows: ``doc_id, <levels>, epoch, tokens, taken``.

    The root budget is ``share`` (numerator, denominator) of all tokens; tokens are words.
    ``taken`` is less than ``tokens`` only for the last document of a leaf's prefix. Levels
    that are null form a group named ''. Null and empty texts have no tokens: they come
    along with whole epochs and while a prefix is open. Repeated rows count each; rows
    with equal ids are ordered by size. A null id has the order of an empty id. A leaf
    without tokens gives no rows, and an empty table none.
    """
    names = list(levels)
    sized = written(
        docs.select(
            "doc_id",
            *(F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()),
            word_count(F.col("text")).alias("tokens"),
        ),
        "mix-docs",
    )
    leaves = sized.groupBy(*names).agg(F.sum("tokens").alias("leaf_tokens"))
    leaves = written(leaves.where("leaf_tokens > 0"), "mix-leaves")
    whole = leaves.groupBy(F.lit(0).alias("_one")).agg(F.sum("leaf_tokens").alias("_all"))
    total = F.expr(f"(_all * {int(share[0])}) div {int(share[1])}")
    capped = leaves.withColumn("capacity", F.col("leaf_tokens") * max_epochs).withColumn("_one", F.lit(0))
    capped = capped.join(whole, "_one").withColumn("_total", total).drop("_one", "_all")
    plan = written(
        budgets(capped, names, F.col("_total"), weights or {})
        .withColumn("full", F.expr("budget div leaf_tokens"))
        .withColumn("rest", F.expr("budget % leaf_tokens"))
        .select(*names, "full", "rest"),
        "mix-plan",
    )
    planned = written(
        sized.join(plan, names).withColumn(
            "key", F.md5(F.concat_ws("|", F.lit(str(seed)), "full", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        ),
        "mix-planned",
    )
    place = F.conv(F.substring("key", 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    placed = running_before(planned, names, place, ["key", "tokens"], "tokens", "before")
    last = F.expr("greatest(0, least(tokens, rest - before))")
    epochs = F.sequence(F.lit(0).cast("long"), F.when(F.col("before") < F.col("rest"), F.col("full")).otherwise(F.col("full") - 1))
    return (
        placed.where("full > 0 or before < rest")
        .withColumn("epoch", F.explode(epochs))
        .select(
            "doc_id",
            *names,
            F.col("epoch").cast("int").alias("epoch"),
            "tokens",
            F.when(F.col("epoch") < F.col("full"), F.col("tokens")).otherwise(last).alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, levels: dict[str, Column], **options) -> DataFrame:
    """``docs`` as far as ``mix`` chooses them in one epoch; all columns stay as they are.

    The last document of a prefix stays whole. Rows that share an id stay or go together,
    and rows without id go with the empty id's place.
    """
    chosen = written(mix(docs, levels, max_epochs=1, **options).select("doc_id").distinct(), "mix-chosen")
    with_id = docs.join(chosen.where("doc_id is not null").hint("merge"), "doc_id", "left_semi").select(*docs.columns)
    without = docs.where(F.col("doc_id").isNull())
    return with_id if chosen.where("doc_id is null").isEmpty() else with_id.union(without)
