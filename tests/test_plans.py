"""Contexts, signal tables, saving tables, cleansing and models."""

from datetime import datetime, timedelta
from math import sin

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugework.operators import cleanse
from gaugework.operators.definitions import SIGNAL_SCHEMA
from gaugework.operators.units import SCHEMA as UNIT_SCHEMA
from gaugework.plans import models
from gaugework.plans.context import (
    Context, ContextList, SCOPE_SCHEMA, Scope, merge_contexts, merge_scope_rows, merge_scopes, resolve_context, resolve_entities, resolve_scope,
)
from gaugework.plans.signals import SignalData, column_mapping, load_data, load_signals, table_to_samples
from gaugework.plans.tables import load_all_script_tables, load_script_table, DEFINITION_SCHEMA
from gaugework.session import literal_table

START = datetime(2021, 1, 1)
WELLS = [f"Well {i:03d}" for i in range(1, 6)]
SIGNALS = [
    ("static numeric signal", "sns", "Static", " ", "Dimensionless", "Sum", "Sum"),
    ("static string signal", "", "String", " ", "Dimensionless", "Sum", "Sum"),
    ("time numeric signal", "tns", "TimeDependent", " ", "Dimensionless", "Sum", "Sum"),
    ("time string signal", "", "StringTimeDependent", " ", "Dimensionless", "Sum", "Sum"),
    ("depth numeric signal", "", "DepthDependent", "m", "Length", "Sum", "Sum"),
    ("none", "", "TimeDependent", " ", "Dimensionless", "NoAggregation", "NoAggregation"),
    ("middle", "", "TimeDependent", " ", "Dimensionless", "Median", "Median"),
]
UNITS = [(" ", "Dimensionless", 1.0, 0.0), ("m", "Length", 1.0, 0.0), ("ft", "Length", 0.3048, 0.0)]


@pytest.fixture(scope="module")
def signals(spark):
    return literal_table(spark, SIGNALS, SIGNAL_SCHEMA)


@pytest.fixture(scope="module")
def units(spark):
    return literal_table(spark, UNITS, UNIT_SCHEMA)


@pytest.fixture(scope="module")
def data(spark):
    static = [(w, "static numeric signal", float(i), None) for i, w in enumerate(WELLS)] + [(w, "static string signal", None, "abcde"[i]) for i, w in enumerate(WELLS)]
    time, depth = [], []
    for i, w in enumerate(WELLS):
        for day in range(100):
            at = START + timedelta(days=day, hours=6)
            time += [(w, "time numeric signal", at, 1.0 + (i + day) % 3, None), (w, "time string signal", at, None, chr(97 + day % 26)),
                     (w, "none", at, float(day), None), (w, "middle", at, float(day), None)]
        depth += [(w, "depth numeric signal", float(z), 100 * sin(z + i), None) for z in range(10)]
    values = "value_num double, value_str string"
    return SignalData(
        literal_table(spark, static, f"entity string, signal string, {values}"),
        literal_table(spark, time, f"entity string, signal string, date timestamp_ntz, {values}").repartition(5),
        literal_table(spark, depth, f"entity string, signal string, depth double, {values}"),
    )


@pytest.fixture(scope="module")
def context(spark):
    names = literal_table(spark, [(w,) for w in [*WELLS, "Field 1"]], "name string")
    edges = literal_table(spark, [(w, "Field 1") for w in WELLS], "child string, parent string")
    return Context("c", resolve_scope(None, time_start="2021-01-01", time_end="2022-01-01", time_step="Daily", depth_start=0, depth_end=10, depth_step="Meter"), names, edges)


def test_static_rolls_up_to_the_field(data, signals, units, context):
    got = load_signals(data, signals, units, ["static numeric signal", "static string signal"], context)
    assert got.columns == ["Entity", "static numeric signal [ ]", "static string signal [ ]"]
    rows = {r[0]: (r[1], r[2]) for r in got.collect()}
    assert len(rows) == 6 and rows["Field 1"] == (10.0, "abcde") and rows["Well 003"] == (2.0, "c")


def test_time_depth_and_combined_rows(data, signals, units, context):
    time = load_signals(data, signals, units, ["tns", "time string signal"], context)
    assert time.columns == ["Entity", "Date", "time numeric signal [ ]", "time string signal [ ]"] and time.count() == 600
    depth = load_signals(data, signals, units, ["depth numeric signal"], context, depth_unit="ft")
    assert depth.columns == ["Entity", "Depth [ft]", "depth numeric signal [m]"] and depth.count() == 60
    assert depth.agg(F.max("`Depth [ft]`")).head()[0] == pytest.approx(9 / 0.3048)
    both = load_signals(data, signals, units, ["tns", "depth numeric signal [ft]", "sns"], context)
    assert both.columns == ["Entity", "Date", "Depth", "time numeric signal [ ]", "depth numeric signal [ft]", "static numeric signal [ ]"]
    assert both.count() == 6 * 100 * 10


def test_each_signal_keeps_its_own_aggregation(data, signals, units, context):
    scope = Context("m", resolve_scope(context.scope, time_step="Monthly"), context.entities, context.hierarchy)
    got = load_signals(data, signals, units, ["tns", "time string signal", "middle"], scope)
    january = {r["Entity"]: r for r in got.where("Date = '2021-01-01'").collect()}
    well = january["Well 001"]
    assert well["time numeric signal [ ]"] == sum(1.0 + day % 3 for day in range(31))
    assert well["time string signal [ ]"] == "".join(chr(97 + day % 26) for day in range(31))
    assert well["middle [ ]"] == 15.0
    assert january["Field 1"]["middle [ ]"] == 15.0


def test_no_aggregation_keeps_own_times(data, signals, units, context):
    plain = Context("n", context.scope, context.entities)
    got = load_signals(data, signals, units, ["none", "tns"], plain)
    assert got.where("hour(Date) = 6").count() == 500 and got.where("hour(Date) = 0").count() == 500
    assert got.where("`none [ ]` IS NOT NULL").count() == 500


def test_unknown_signal_and_empty_set(spark, data, signals, units):
    with pytest.raises(ValueError, match="unknown signals"):
        load_signals(data, signals, units, ["nothing"], Context())
    with pytest.raises(ValueError, match="empty"):
        load_signals(data, signals, units, ["tns"], Context(entities=literal_table(spark, [], "name string")))


def test_last_uses_the_raw_order(spark, signals, units):
    changed = signals.withColumn("interval_agg", F.lit("Last"))
    rows = [("w", "time numeric signal", START + timedelta(hours=h), v, None) for h, v in ((1, 9.0), (5, 2.0), (3, 7.0))]
    samples = literal_table(spark, rows, "entity string, signal string, date timestamp_ntz, value_num double, value_str string")
    got = load_signals(SignalData(time=samples), changed, units, ["tns"], Context(scope=Scope(time_step="Daily")))
    assert got.head()["time numeric signal [ ]"] == 2.0


def test_load_data_dispatch(spark, data):
    t, pairs = data.time, literal_table(spark, [("Well 001", "tns"), ("Well 001", "middle")], "entity string, signal string")
    assert load_data(t, "time", pairs, num_values=-2).count() == 2
    assert load_data(t, "time", pairs, start=START, end=START + timedelta(days=9)).count() == 9
    got = load_data(t, "time", pairs, START, START + timedelta(days=119), "day", gap_value=-5.0)
    assert got.count() == 120 and got.where("value_num = -5").count() == 20
    point = load_data(data.depth, "depth", start=2.5, end=2.5, interpolated=True)
    assert point.where("entity = 'Well 001'").head()["value_num"] == pytest.approx(50 * (sin(2) + sin(3)))
    assert load_data(data.depth, "depth", start=2.0, end=2.0).count() == 5
    assert load_data(data.static, "static").count() == 10


def test_scope_overrides_and_merge(spark):
    stored = Scope("s", START, None, "Hourly", 1.0, 2.0, "foot")
    s = resolve_scope(stored, depth_start=0.0, time_end="2021-02-01T00:00:00Z")
    assert s == Scope("s", START, datetime(2021, 2, 1), "Hourly", 0.0, 2.0, "Foot")
    merged = merge_scopes([s, Scope("t", START - timedelta(days=1), None, "min", 5.0, 0.0, "Meter")])
    assert (merged.time_start, merged.time_step, merged.depth_start, merged.depth_end, merged.depth_step) == (START - timedelta(days=1), "EveryMinute", 0.0, 2.0, "Foot")
    rows = literal_table(spark, [("a", START, None, "Daily", 0.0, 2.0, "Meter"), ("b", None, START, "Hourly", None, 9.0, None)], SCOPE_SCHEMA)
    assert tuple(merge_scope_rows(rows).head()) == (START, START, "Hourly", 0.0, 9.0, "Meter")


def test_contexts(spark):
    names = literal_table(spark, [("a",), ("b",)], "name string")
    entities = literal_table(spark, [("a", "Well"), ("b", "Field"), ("c", "Well")], "name string, type string")
    assert [r[0] for r in resolve_entities(entities, names, "well").collect()] == ["a"]
    assert {r[0] for r in resolve_entities(entities, None, "WELL").collect()} == {"a", "c"}
    assert resolve_entities(entities, names).count() == 2
    empty = literal_table(spark, [], "child string, parent string")
    assert resolve_context(None, None, names, empty).hierarchy is None
    one = Context("one", Scope(), names)
    merged = merge_contexts([one, {"name": "two", "entities": names, "scope": {"time_step": "d"}}])
    assert merged.entities.count() == 4 and merged.scope.time_step == "Daily"
    assert merge_contexts([one, one], distinct_entities=True).entities.count() == 2
    both = ContextList((one, Context("two", Scope(), names)))
    assert both.primary is one and both.entity_rows().count() == 4


def test_column_mapping_forms():
    mapping = {"a": "x", "b [m]": "y [ft]", "c": ("z", "cm"), "d": {"Signal": "v", "unit": "K"}, "e": ["w"]}
    got = column_mapping(["a [m]", "b [m]", "c", "d", "e [m]", "f [C]"], mapping)
    assert [g[1:] for g in got] == [("x", "m"), ("y", "ft"), ("z", "cm"), ("v", "K"), ("w", "m"), ("f", "C")]


def test_table_to_samples(spark, signals):
    rows = [(1, "w1", START, 0.5, None, "x", " "), (0, "w1", START, None, 3.0, "y", "7"), (2, "gone", START, 1.0, 1.0, "z", "1")]
    df = literal_table(spark, rows, "row int, Entity string, Date timestamp_ntz, `static numeric signal` double, `tns2` double, `static string signal` string, `time numeric signal` string")
    known = literal_table(spark, [("W1", "Well")], "name string, type string")
    ids = literal_table(spark, [("w1", "W1")], "old string, new string")
    got = table_to_samples(df, signals, None, ids, known, "well", "row").collect()
    by = {(r["signal"], r["value_str"], str(r["value_num"])) for r in got}
    assert by == {("static numeric signal", None, "None"), ("static string signal", "y", "None"), ("time numeric signal", None, "None"), ("time numeric signal", None, "7.0")}
    assert {r["entity"] for r in got} == {"W1"}


def test_script_tables(spark, data, signals, units, context):
    rows = [("B", 0, "Rate", "", 'E "time numeric signal" in " "'), ("A", 0, "Level", "ft", '"depth numeric signal" "ft"')]
    definitions = literal_table(spark, rows, DEFINITION_SCHEMA)
    got = load_script_table(definitions, -1, data, signals, units, context)
    assert got.columns == ["Entity", "Date", "Rate"]
    tables = load_all_script_tables(definitions, data, signals, units, context)
    assert list(tables) == ["A", "B"] and tables["A"].columns == ["Entity", "Depth", "Level [ft]"]


def test_cleanse(spark):
    df = literal_table(spark, [("w", "a", 5.0), ("w", "a", -1.0), ("w", "b", -1.0)], "entity string, signal string, value_num double")
    rules = {"a": "CASE WHEN value < 0 THEN NULL ELSE value * 2 END"}
    assert [r["value_num"] for r in cleanse.apply(df, rules).collect()] == [10.0, None, -1.0]
    assert cleanse.preview(df, rules).count() == 2


# --- models -----------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def plane(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(2, 600))
    rows = [(i, "e" + str(i % 3), float(a), float(b), float(3 + 2 * a - b * (1 + i % 3)), "up" if a + b > 0 else "down") for i, (a, b) in enumerate(zip(x, y))]
    return literal_table(spark, rows, "id int, e string, x double, y double, z double, c string").cache()


def test_per_entity_models_recover_the_coefficients(plane):
    fitted = models.train_per_entity(plane, "e", ["x", "y"], "z")
    for r in fitted.collect():
        assert r["n"] == 200 and r["coefficients"] == pytest.approx([3, 2, -(1 + int(r["e"][1]))])
    done = models.predict_per_entity(plane, fitted, "e", ["x", "y"])
    assert models.regression_metrics(done, "z").head()["r2"] == pytest.approx(1)


@pytest.mark.parametrize("normalisation", ["auto", "min max", "mean var", "log mean var", "bin", "superbin", "robust", "lp", "contrast"])
def test_every_normalisation_trains(plane, normalisation):
    model = models.train(plane, "reg", ["x", "y"], "z", normalisation)
    assert models.predict(model, plane).where("prediction IS NULL").count() == 0


@pytest.mark.parametrize("kind, trainer", [("binclass", None), ("binclass", "forest"), ("multi", "logistic"), ("bayes", None)])
def test_classes(plane, kind, trainer):
    model = models.train(plane, kind, ["x", "y"], "c", trainer=trainer)
    done = models.predict(model, plane).withColumn("hit", (F.col("prediction") == F.when(F.col("c") == "down", 0.0).otherwise(1.0)).cast("double"))
    assert done.agg(F.avg("hit")).head()[0] > 0.85


def test_missing_values_and_trainer_names(plane):
    holes = plane.withColumn("x", F.when(F.col("id") > 5, F.col("x")))
    assert models.complete_cases(holes, ["x", "y"]).count() == 594
    models.train(holes, "reg", ["x", "y"], "z")
    with pytest.raises(ValueError, match="trainer"):
        models.train(plane, "reg", ["x"], "z", trainer="kmeans")


def test_split_is_complete_and_stable(plane):
    parts = models.split(plane, "id", 0.2, 0.25)
    sizes = {k: v.count() for k, v in parts.items()}
    assert sum(sizes.values()) == 600 and abs(sizes["test"] - 120) < 40 and abs(sizes["validation"] - 120) < 40
    again = models.split(plane.repartition(7), "id", 0.2, 0.25)
    assert {r["id"] for r in parts["test"].collect()} == {r["id"] for r in again["test"].collect()}


def test_class_metrics(spark):
    df = literal_table(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("b", "c")], "y string, prediction string")
    got = {r["class"]: (r["support"], r["precision"], r["recall"]) for r in models.classification_metrics(df, "y").collect()}
    assert got == {"a": (2, 1.0, 0.5), "b": (2, 0.5, 0.5), "c": (0, 0.0, None)}


def test_clusters_and_statistics(plane):
    model = models.train(plane, "cluster", ["x", "y"], clusters=3)
    assert models.predict(model, plane).select("prediction").distinct().count() == 3
    stats = {r["column"]: r for r in models.training_statistics(plane, ["x", "y"], "z").collect()}
    assert stats["x"]["n_known"] == 600 and stats["x"]["label_correlation"] > 0.5
    assert models.feature_columns(["Entity", "Date", "a", "b"], "b") == ["a"]
