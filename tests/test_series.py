from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlens import fixtures
from fleetlens.operators import hierarchy, series

DAY = datetime(2024, 1, 1)
SPAN = series.Span(DAY, DAY + timedelta(hours=4))


@pytest.fixture(scope="module")
def samples(spark):
    at = lambda minutes: DAY + timedelta(minutes=minutes)
    rows = [
        ("a", at(-30), 0.0, "off", 1),
        ("a", at(60), 10.0, "on", 2),
        ("a", at(90), 40.0, "off", 3),
        ("a", at(210), 100.0, "on", 4),
        ("b", at(10), 5.0, "on", 5),
        ("b", at(300), 7.0, "on", 6),
    ]
    return spark.createDataFrame(
        rows, "deviceId string, createdAt timestamp, value double, mode string, eventId long"
    )


def table(df, *columns):
    return {(r["deviceId"], r["ts"].hour): tuple(r[c] for c in columns) for r in df.collect()}


def test_durations():
    assert series.duration("PT1M") == timedelta(minutes=1)
    assert series.duration("P1M") == timedelta(days=30)
    assert series.duration("P1Y2DT3H0.5S") == timedelta(days=367, hours=3, seconds=0.5)
    for bad in ("", "P", "1H", "PT"):
        with pytest.raises(ValueError):
            series.duration(bad)


def test_aggregate_fills_empty_intervals(samples):
    variables = {
        "mean": series.NumericVariable(F.col("value")),
        "on": series.NumericVariable(F.col("value"), F.sum, F.col("mode") == "on"),
        "spread": series.AggregateVariable(
            lambda e: F.max(e("value")) - F.min(e("value")), F.col("mode") != "broken"
        ),
    }
    got = table(series.series_aggregate(samples, SPAN, "PT1H", variables, fill=True), *variables)
    assert len(got) == 8
    assert got["a", 1] == (25.0, 10.0, 30.0)
    assert got["a", 0] == (None, None, None) and got["b", 0] == (5.0, 5.0, 0.0)


@pytest.mark.parametrize(
    ("kind", "want"),
    [
        (series.LINEAR, {0: 10 / 3, 1: 10.0, 2: 55.0, 3: 85.0}),
        (series.STEP, {0: 0.0, 1: 10.0, 2: 40.0, 3: 40.0}),
    ],
)
def test_interpolation_uses_the_boundary(samples, kind, want):
    how = series.Interpolation(kind, "PT1H")
    variable = series.NumericVariable(F.col("value"), interpolation=how)
    got = table(series.series_interpolate(samples, SPAN, "PT1H", variable, ids=["a"]), "value")
    assert {h: v for (_, h), (v,) in got.items()} == pytest.approx(want)


def test_interpolation_without_boundary_has_no_value_before(samples):
    variable = series.NumericVariable(F.col("value"), interpolation=series.Interpolation())
    got = table(series.series_interpolate(samples, SPAN, "PT1H", variable, ids=["a"]), "value")
    assert got["a", 0] == (None,) and got["a", 2] == (55.0,)


def test_category_durations_are_split_over_intervals(samples):
    variable = series.CategoricalVariable(F.col("mode"), {"running": ["on"]}, "stopped")
    got = series.series_categories(
        samples, SPAN, "PT1H", variable, ids=["a"], boundary="PT1H"
    ).collect()
    seconds = {(r["ts"].hour, r["label"]): (r["n"], r["seconds"]) for r in got}
    assert seconds == {
        (0, "stopped"): (0, 3600.0),
        (1, "running"): (1, 1800.0),
        (1, "stopped"): (1, 1800.0),
        (2, "stopped"): (0, 3600.0),
        (3, "stopped"): (0, 1800.0),
        (3, "running"): (1, 1800.0),
    }


def test_raw_events_page(samples):
    page = series.series_events(samples, SPAN, ids=["a"], properties=["value"], take=2)
    assert page.columns == ["deviceId", "createdAt", "value"]
    assert [r["value"] for r in page.collect()] == [10.0, 40.0]
    with pytest.raises(ValueError):
        series.series_events(samples, SPAN, take=250_001)


def test_event_schema_with_two_types_of_one_name(spark):
    df = spark.createDataFrame(
        [(DAY, '{"x":1}'), (DAY, '{"x":"one","y":true}'), (DAY, None)],
        "createdAt timestamp, props string",
    )
    got = series.event_schema(df, SPAN, "props").collect()
    assert {(r["name"], r["type"]) for r in got} == {
        ("createdAt", "timestamp"), ("x", "bigint"), ("x", "string"), ("y", "boolean"),
    }


@pytest.fixture(scope="module")
def model(spark):
    numbers = spark.range(24).select(
        F.format_string("device-%06d", "id").alias("deviceId"), F.col("id").alias("i")
    )
    return fixtures.sample_instances(numbers, "i").cache()


def test_search_paths_rank_and_names(model):
    find = lambda **how: [r["name"] for r in hierarchy.instance_search(model, **how).collect()]
    assert len(find(text="device SIMULATED", take=100)) == 24
    below = {"hierarchy": ("year", "month"), "path": ("2020", "2"), "take": 100}
    assert find(**below, sort=hierarchy.BY_NAME) == ["Device #1", "Device #13"]
    above = {"hierarchy": ("year", "month"), "path": ("2020",), "take": 100}
    assert len(find(**above)) == 24 and find(**above, recursive=False) == []
    assert find(text="#7")[0] == "Device #7"
    assert find(text="nothing*") == []


def test_tree_levels(model):
    tree = lambda **how: {r["path"]: r["n"] for r in hierarchy.hierarchy_tree(model, **how).collect()}
    assert tree(expand=hierarchy.ONE_LEVEL) == {"ManufactureDate": 24, "VehicleType": 24}
    assert tree(below=["VehicleType"]) == {"VehicleType/Car": 12, "VehicleType/Bus": 12}
    months = tree(below=["ManufactureDate", "2020"], sort=hierarchy.BY_COUNT)
    assert len(months) == 12 and set(months.values()) == {2}


def test_model_rows(model):
    changes = model.where("month = 1").withColumn("vehicle", F.lit("Truck"))
    assert hierarchy.model_put(model, changes).where("vehicle = 'Truck'").count() == 2
    assert hierarchy.model_update(model, changes).count() == 24
    strange = changes.withColumn("deviceId", F.lit("new"))
    with pytest.raises(KeyError):
        hierarchy.model_update(model, strange.limit(1))
    assert hierarchy.model_get(model, ["device-000003"]).count() == 1
    assert hierarchy.model_delete(model, changes).count() == 22
    events = model.select("deviceId")
    untyped = model.withColumn("typeId", F.lit(None).cast("string"))
    types = model.sparkSession.createDataFrame([("base", "Base")], "typeId string, typeName string")
    typed = hierarchy.with_model(events, untyped, types, default_type="base")
    assert typed.where("typeName = 'Base'").count() == 24


def test_missing_levels_and_memberships(spark):
    rows = [("a", 2020, 1, "Car", ["ManufactureDate"]), ("b", None, 3, "Bus", ["VehicleType"]), ("c", None, 3, "a/b", ["ManufactureDate", "VehicleType"])]
    model = spark.createDataFrame(rows, "deviceId string, year long, month long, vehicle string, hierarchyIds array<string>")
    got = {(r["path"], r["level"]): r["n"] for r in hierarchy.hierarchy_tree(model).collect()}
    # A missing year ends the path; it does not move the month up.
    assert got == {
        ("ManufactureDate", 1): 2, ("ManufactureDate/2020", 2): 1, ("ManufactureDate/2020/1", 3): 1,
        ("VehicleType", 1): 2, ("VehicleType/Bus", 2): 1, ("VehicleType/a/b", 2): 1,
    }


def test_put_keeps_one_row_per_key(model):
    again = model.where("month = 1").withColumn("vehicle", F.lit("Truck"))
    twice = again.union(again.withColumn("vehicle", F.lit("Tram")))
    put = hierarchy.model_put(model, twice, order=[F.col("vehicle")])
    assert put.count() == 24 and put.where("vehicle = 'Tram'").count() == 2
