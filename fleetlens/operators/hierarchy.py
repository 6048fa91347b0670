"""The series model: instances, types, hierarchies; search, trees and upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.ordered import first_rows

BY_RANK, BY_NAME, BY_COUNT = "rank", "name", "count"
ONE_LEVEL, UNTIL_CHILDREN = "one_level", "until_children"

# Hierarchies and instance fields of the sample model.
HIERARCHIES = {"ManufactureDate": ("year", "month"), "VehicleType": ("vehicle",)}


def with_model(
    events: DataFrame,
    instances: DataFrame,
    types: DataFrame | None = None,
    default_type: str | None = None,
) -> DataFrame:
    """Events with the attributes of their instance and its one type.

    The joins are Spark's choice: a model is broadcast only if it is small when it runs.
    """
    model = instances
    if default_type is not None:
        model = model.withColumn("typeId", F.coalesce("typeId", F.lit(default_type)))
    if types is not None:
        model = model.join(types, "typeId")
    return events.join(model, "deviceId")


def path_of(fields: Sequence[str]) -> Column:
    """The path of an instance in one hierarchy: its field values, outermost first, up to
    the first that is missing."""
    steps = F.array(*[F.col(f).cast("string") for f in fields])
    missing = F.array_position(F.transform(steps, lambda s: s.isNull()), F.lit(True))
    return F.when(missing > 0, F.slice(steps, F.lit(1), (missing - 1).cast("int"))).otherwise(steps)


def instance_search(
    instances: DataFrame,
    text: str = "",
    attributes: Sequence[str] = ("deviceId", "name", "description"),
    hierarchy: Sequence[str] = (),
    path: Sequence[str] = (),
    recursive: bool = True,
    sort: str = BY_RANK,
    take: int = 10,
) -> DataFrame:
    """Instances whose attributes contain all words of ``text``, ignoring case, below
    ``path`` of a hierarchy (or exactly there). The rank is the number of matches."""
    words = text.lower().split()
    haystack = F.lower(F.concat_ws(" ", *attributes))
    rows = instances.withColumn("_text", haystack)
    for word in words:
        rows = rows.where(F.contains(F.col("_text"), F.lit(word)))
    if path:
        for name, step in zip(hierarchy, path, strict=False):
            rows = rows.where(F.col(name).cast("string") == step)
        if not recursive and len(path) < len(hierarchy):
            rows = rows.where(F.col(hierarchy[len(path)]).isNull())
    matches = F.lit(0)
    for word in words:
        pieces = F.size(F.split(F.col("_text"), F.lit(_literal(word)))) - 1
        matches = matches + pieces
    rows = rows.withColumn("rank", matches.cast("long")).drop("_text")
    by = [F.col("rank").desc()] if sort == BY_RANK else []
    return rows.orderBy(*by, "name", "deviceId").limit(take)


def _literal(word: str) -> str:
    return "\\Q" + word.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def hierarchy_tree(
    instances: DataFrame,
    hierarchies: Mapping[str, Sequence[str]] = HIERARCHIES,
    below: Sequence[str] = (),
    expand: str = UNTIL_CHILDREN,
    sort: str | None = None,
) -> DataFrame:
    """Every node of the hierarchies with the number of instances at or below it.

    ``path`` starts with the hierarchy name. An instance whose level is missing counts at
    the level above it. A column ``hierarchyIds``, if there, names the hierarchies that an
    instance belongs to; without it an instance is in all of them. ``below`` keeps one subtree, and
    ``one_level`` its direct children. Instances are first counted per full path, so the
    prefixes multiply counts and not instances.
    """
    paths = None
    for name, fields in hierarchies.items():
        members = instances
        if "hierarchyIds" in instances.columns:
            members = members.where(F.array_contains("hierarchyIds", name))
        one = members.select(F.concat(F.array(F.lit(name)), path_of(fields)).alias("_path"))
        paths = one if paths is None else paths.unionByName(one)
    full = paths.groupBy("_path").agg(F.count(F.lit(1)).alias("_n"))
    depth = F.explode(F.sequence(F.lit(1), F.size("_path")))
    nodes = full.select("_path", "_n", depth.alias("_d")).select(
        F.slice("_path", F.lit(1), F.col("_d")).alias("_node"), "_n"
    )
    for i, step in enumerate(below):
        nodes = nodes.where(F.get("_node", F.lit(i)) == step)
    if below:
        nodes = nodes.where(F.size("_node") > len(below))
    if expand == ONE_LEVEL:
        nodes = nodes.where(F.size("_node") == len(below) + 1)
    # Grouped by the steps: a step may hold the sign that joins them in the text.
    tree = nodes.groupBy("_node").agg(F.sum("_n").alias("n"))
    tree = tree.select(
        F.array_join("_node", "/").alias("path"), F.size("_node").alias("level"), "n"
    )
    if sort == BY_COUNT:
        return tree.orderBy(F.col("n").desc(), "path")
    return tree.orderBy("path") if sort == BY_NAME else tree


def instance_suggest(
    instances: DataFrame,
    prefix: str,
    attributes: Sequence[str] = ("deviceId", "name"),
    take: int = 10,
) -> DataFrame:
    """Attribute values that begin with ``prefix``, ignoring case."""
    values = F.explode(F.array(*[F.col(a).cast("string") for a in attributes]))
    return (
        instances.select(values.alias("suggestion"))
        .where(F.startswith(F.lower("suggestion"), F.lit(prefix.lower())))
        .distinct()
        .orderBy("suggestion")
        .limit(take)
    )


def model_get(model: DataFrame, ids: Sequence, key: str = "deviceId") -> DataFrame:
    return model.where(F.col(key).isin(*ids))


def model_put(
    model: DataFrame, changes: DataFrame, key: str = "deviceId", order: Sequence[Column] = ()
) -> DataFrame:
    """Create or replace. Of several changes of one key the first in ``order`` counts, or
    the largest by all columns if no order is given."""
    by = order or [F.struct(*[c for c in changes.columns if c != key]).desc()]
    changes = first_rows(changes, [key], by)
    return model.join(changes.select(key), key, "left_anti").unionByName(changes)


def model_update(model: DataFrame, changes: DataFrame, key: str = "deviceId") -> DataFrame:
    """Replace existing rows only; a key that is missing is an error."""
    missing = changes.join(model.select(key), key, "left_anti").limit(1).collect()
    if missing:
        raise KeyError(f"no such {key}: {missing[0][key]!r}")
    return model_put(model, changes, key)


def model_delete(model: DataFrame, ids: DataFrame, key: str = "deviceId") -> DataFrame:
    return model.join(ids.select(key), key, "left_anti")
