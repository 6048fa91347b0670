"""Current state of each device: twins, patches and the status table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.scalars import json_number
from fleetlens.operators.dedup import remove_members
from fleetlens.operators.ordered import first_rows
from fleetlens.operators.windows import SEQUENCE, latest_per_device

# Event types and the device properties they set.
ROUTES = {"TEMP": "Temperature", "CO2": "CO2"}

PATCH = T.StructType(
    [
        T.StructField(
            "patch",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("op", T.StringType()),
                        T.StructField("path", T.StringType()),
                        T.StructField("value", T.VariantType()),
                    ]
                )
            ),
        )
    ]
)


def route(df: DataFrame) -> DataFrame:
    """Put ``value`` and ``complexData`` into the properties of the event's type.

    Other types only carry their time and sequence number.
    """
    columns = {}
    for kind, name in ROUTES.items():
        columns[name] = F.when(F.col("type") == kind, F.col("value"))
        columns[f"{name}Data"] = F.when(F.col("type") == kind, F.col("complexData"))
    columns["LastUpdate"] = F.col("createdAt")
    return df.withColumns(columns)


def routed(df: DataFrame, arrival: Sequence[str] = ("enqueuedAt", "eventId")) -> DataFrame:
    """Updates with what they set and ``_route``, the property group they belong to."""
    kind = F.when(F.col("type").isin(*ROUTES), F.col("type")).otherwise("other")
    names = [x for name in ROUTES.values() for x in (name, f"{name}Data")]
    rows = route(df).withColumn("_route", kind)
    return rows.select("deviceId", "_route", "LastUpdate", SEQUENCE, *names, *arrival)


def fold_routes(newest: DataFrame, arrival: Sequence[str] = ("enqueuedAt", "eventId")) -> DataFrame:
    """One row per device from its newest update of each ``_route``: a few rows each."""
    at = F.struct(*arrival)

    def last(name: str, of: Column | None = None) -> Column:
        when = at if of is None else F.when(of, at)
        return F.max_by(F.col(name), when).alias(name)

    merged = [last("LastUpdate"), last(SEQUENCE)]
    for kind_name, name in ROUTES.items():
        mine = F.col("_route") == kind_name
        merged += [last(name, mine), last(f"{name}Data", mine)]
    return newest.groupBy("deviceId").agg(*merged)


def twin_state(
    df: DataFrame,
    arrival: Sequence[str] = ("enqueuedAt", "eventId"),
) -> DataFrame:
    """Each property of a device as its last update in arrival order left it.

    One newest row per device and route leaves each task, so a busy device is no
    burden; the few rows of a device are then folded into one.
    """
    by = [F.col(c).desc() for c in arrival]
    return fold_routes(first_rows(routed(df, arrival), ["deviceId", "_route"], by), arrival)


def twins(devices: DataFrame, state: DataFrame) -> DataFrame:
    """A twin for every known device; properties are null until an event sets them."""
    return devices.join(state, "deviceId", "left")


def merge_twins(current: DataFrame, update: DataFrame) -> DataFrame:
    """Lay a newer partial state over the current one; both have a row per device."""
    names = [c for c in current.columns if c != "deviceId"]
    joined = current.alias("c").join(update.alias("u"), "deviceId", "full")
    columns = {n: F.coalesce(F.col(f"u.{n}"), F.col(f"c.{n}")) for n in names}
    return joined.select("deviceId", *[column.alias(n) for n, column in columns.items()])


def patch_flatten(
    df: DataFrame, message: str = "body", subject: str = "subject", id_: str = "id"
) -> DataFrame:
    """JSON patches to flat property events: ``/Front/Temperature`` to
    ``Front.Temperature``, values as they came, plus ``deviceId`` and ``eventId``.

    Only ``add`` and ``replace`` are kept, a message with nothing left is dropped, and a
    path set twice in one message is an error.
    """
    steps = F.from_json(F.col(message), PATCH)["patch"]

    def entry(step: Column) -> Column:
        path = F.substr(step["path"], F.lit(2))
        return F.struct(
            F.replace(path, F.lit("/"), F.lit(".")).alias("key"),
            step["value"].alias("value"),
        )

    def given(name: str, column: str) -> Column:
        return F.struct(
            F.lit(name).alias("key"),
            F.col(column).cast("string").cast("variant").alias("value"),
        )

    kept = F.filter(steps, lambda s: s["op"].isin("add", "replace"))
    # As a generator, the parser runs once per message for both the test and the fields.
    something = F.filter(F.array(kept), lambda k: F.size(k) > 0)
    ids = F.array(given("deviceId", subject), given("eventId", id_))
    entries = F.concat(F.transform("_kept", entry), ids)
    return df.select(subject, id_, F.explode(something).alias("_kept")).select(
        F.col(subject).alias("deviceId"),
        F.col(id_).alias("eventId"),
        F.to_json(F.map_from_entries(entries)).alias("props"),
    )


def status_rows(events: DataFrame, detail: str = "ComplexData") -> DataFrame:
    """The newest event of each device with the first five detail numbers extracted."""
    newest = latest_per_device(events, ["deviceId"], [SEQUENCE, "eventId"])
    return newest.withColumns(
        {f"MoreData{i}": json_number(detail, f"$.moreData{i}") for i in range(1, 6)}
    )


def update_status(
    status: DataFrame, batch: DataFrame, always_replace: bool = False
) -> DataFrame:
    """The status table after a batch (both in the form of :func:`status_rows`).

    A stored row with a higher sequence number stays, unless ``always_replace`` asks for
    the unconditional replacement of all devices in the batch.
    """
    if always_replace:
        return remove_members(status, batch, "deviceId").unionByName(batch)
    both = status.withColumn("_new", F.lit(0)).unionByName(
        batch.withColumn("_new", F.lit(1))
    )
    return first_rows(
        both, ["deviceId"], [F.col(SEQUENCE).desc(), F.col("_new").desc()]
    ).drop("_new")
