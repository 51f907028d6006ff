"""Aggregations, hot groups, lookups, windows and hierarchies against pandas and brute force."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugework.operators import aggregate as agg
from gaugework.operators import hierarchy, joins, window
from gaugework.operators.units import SCHEMA as UNIT_SCHEMA
from gaugework.operators.units import convert_rows, conversion, add_units
from gaugework.session import literal_table

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, some values and one key are null, many values repeat."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(6000):
        k = "hot" if i % 3 else (None if i % 30 == 0 else f"k{i % 17}")
        v = None if i % 41 == 0 else float(np.round(rng.normal(50, 20), 1))
        rows.append((k, START + timedelta(seconds=int(rng.integers(0, 9_000_000))), v, i))
    return literal_table(spark, rows, "k string, t timestamp_ntz, v double, i int").cache()


def by_key(df, value="value"):
    return {r["k"]: r[value] for r in df.collect()}


def groups(df):
    pdf = pd.DataFrame([r.asDict() for r in df.collect()])
    pdf["v"] = pdf["v"].astype(float)
    return {None if pd.isna(k) else k: g for k, g in pdf.groupby("k", dropna=False)}


REFERENCE = {
    "Sum": lambda g: g["v"].sum(), "Average": lambda g: g["v"].mean(), "Max": lambda g: g["v"].max(), "Min": lambda g: g["v"].min(),
    "Count": lambda g: g["v"].count(), "Median": lambda g: g["v"].median(), "StandardDeviation": lambda g: g["v"].std(),
    "Variance": lambda g: g["v"].var(), "Percentile": lambda g: g["v"].max(), "Range": lambda g: g["v"].max() - g["v"].min(),
    "Mode": lambda g: g["v"].mode().min(), "First": lambda g: g.dropna(subset="v").sort_values(["t", "v"])["v"].iloc[0],
    "Last": lambda g: g.dropna(subset="v").sort_values(["t", "v"])["v"].iloc[-1],
}


@pytest.mark.parametrize("how", list(REFERENCE))
def test_aggregations_match_pandas(skewed, how):
    got = by_key(agg.aggregate(skewed, ["k"], "v", how, "t"))
    expected = {k: REFERENCE[how](g) for k, g in groups(skewed).items()}
    assert got.keys() == expected.keys()
    for k in expected:
        assert got[k] == pytest.approx(expected[k]), (how, k)


@pytest.mark.parametrize("p", [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0])
def test_hot_percentile_is_exact(skewed, p):
    got = by_key(agg.exact_percentile(skewed, ["k"], "v", p, "value"))
    for k, g in groups(skewed).items():
        assert got[k] == pytest.approx(np.percentile(g["v"].dropna(), 100 * p)), k


@pytest.mark.parametrize("values", [[5.0] * 400, [float(i % 2) for i in range(401)], [0.0] * 399 + [1e9], [-1.5, 2.5] * 150])
def test_hot_percentile_with_ties(spark, values):
    df = literal_table(spark, [("a", v) for v in values], "k string, v double")
    for p in (0.0, 0.5, 0.75, 1.0):
        got = agg.exact_percentile(df, ["k"], "v", p, "value").collect()
        assert len(got) == 1 and got[0]["value"] == pytest.approx(np.percentile(values, 100 * p))


@pytest.mark.parametrize("p", [0.0, 0.3, 0.5, 0.9, 1.0])
def test_percentile_with_nan_and_infinities(spark, p):
    inf, nan = float("inf"), float("nan")
    data = {"a": [1.0, inf, inf, inf], "b": [-inf, -inf, 2.0], "c": [1.0, 2.0, nan, nan], "d": [None, 3.0], "e": [None, None], None: [4.0]}
    df = literal_table(spark, [(k, v) for k, vs in data.items() for v in vs], "k string, v double")
    got = by_key(agg.exact_percentile(df, ["k"], "v", p, "value"))
    assert set(got) == set(data)
    for k, vs in data.items():
        known = sorted((v for v in vs if v is not None), key=lambda v: (v != v, v))
        if not known:
            assert got[k] is None
            continue
        at = (len(known) - 1) * p
        low, high = known[int(np.floor(at))], known[int(np.ceil(at))]
        want = low if low == high or at == int(at) or (low != low and high != high) else low + (at - np.floor(at)) * (high - low)
        assert got[k] == pytest.approx(want, nan_ok=True), (k, got[k], want)


def test_text_aggregations(spark):
    rows = [("a", START + timedelta(hours=i), t) for i, t in enumerate(["ok", "oook", None, "ook", "ok"])] + [("b", START, None)]
    df = literal_table(spark, rows, "k string, t timestamp_ntz, v string")
    expected = {"Sum": "okoookookok", "Max": "oook", "Min": "ok", "First": "ok", "Last": "ok", "Count": 4, "Mode": "ok"}
    for how, value in expected.items():
        got = by_key(agg.aggregate(df, ["k"], "v", how, "t"))
        assert got["a"] == value, how
        assert got["b"] == (0 if how == "Count" else None), how
    with pytest.raises(ValueError):
        agg.aggregate(df, ["k"], "v", "Median", "t")


def test_concatenation_keeps_the_order_over_slices(spark):
    texts = [chr(97 + i % 26) for i in range(500)]
    rows = [("a", START + timedelta(seconds=17 * i), t) for i, t in enumerate(texts)]
    df = literal_table(spark, rows[::-1], "k string, t timestamp_ntz, v string").repartition(7)
    assert by_key(agg.concatenate(df, ["k"], "v", "t", "value"))["a"] == "".join(texts)
    depth = literal_table(spark, [("a", i * 0.3, t) for i, t in enumerate(texts)], "k string, d double, v string")
    assert by_key(agg.concatenate(depth, ["k"], "v", "d", "value", ","))["a"] == ",".join(texts)


def test_first_in_order_keeps_null(spark):
    df = literal_table(spark, [("a", 2, 5.0), ("a", 1, None), ("b", 1, 7.0)], "k string, r int, v double")
    assert by_key(agg.first_in_order(df, ["k"], "v", "r")) == {"a": None, "b": 7.0}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_lookup_equals_broadcast(spark, skewed, how, null_safe, monkeypatch):
    monkeypatch.setattr(joins, "SAMPLE_FRACTION", 0.5)
    monkeypatch.setattr(joins, "SAMPLE_HITS", 40)
    assert {r[0] for r in joins.frequent_keys(skewed, ["k"]).collect()} >= {"hot", None}
    side = spark.range(1).select(F.explode(F.array(F.lit("hot"), F.lit("k3"), F.lit(None).cast("string"), F.lit("absent"))).alias("name")).withColumn("x", F.length("name"))
    few = joins.lookup(skewed, side, [("k", "name")], how, null_safe)
    many = joins.lookup(skewed, side, [("k", "name")], how, null_safe, broadcast_rows=1)
    assert few.columns == many.columns
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    assert "__salt" in many._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_size_is_checked(spark):
    assert joins.fits(spark.range(10), 10) and not joins.fits(spark.range(11), 10)


@pytest.mark.parametrize("n", [1, 4, -4, 1200, -1200])
def test_first_and_last_values(skewed, n):
    got = window.first_values(skewed, ["k"], "t", n, ("i",))
    counts = {r["k"]: r["count"] for r in skewed.groupBy("k").count().collect()}
    kept = {r["k"]: r["count"] for r in got.groupBy("k").count().collect()}
    assert kept == {k: min(c, abs(n)) for k, c in counts.items()}
    hot = sorted(((r["t"], r["i"]) for r in skewed.where("k = 'hot'").collect()), reverse=n < 0)[: abs(n)]
    assert sorted(hot) == sorted((r["t"], r["i"]) for r in got.where("k = 'hot'").collect())


def test_interpolation(spark):
    rows = [("w", 0.0, 10.0), ("w", 1.0, 11.0), ("w", 3.0, 15.0), ("w", 2.0, None), ("x", 5.0, 1.0)]
    df = literal_table(spark, rows, "k string, d double, v double")
    for point, expected in ((1.0, 11.0), (2.0, 13.0), (0.25, 10.25), (3.0, 15.0), (4.0, None)):
        got = by_key(window.interpolate_at(df, ["k"], "d", "v", point))
        assert got["w"] == (None if expected is None else pytest.approx(expected)) and got["x"] is None


@pytest.mark.parametrize("step, n", [("EveryFifteenMinutes", 13), ("Hourly", 4), ("EverySecond", 3 * 3600 + 1)])
def test_grid_counts(spark, step, n):
    df = literal_table(spark, [("a", datetime(2024, 1, 1, 22), 1.0), ("a", datetime(2024, 1, 2, 1), 2.0)], "k string, t timestamp_ntz, v double")
    got = window.fill_grid(df, ["k"], "t", "v", step, 0.0)
    assert got.count() == n and got.where("v > 0").count() == 2
    assert got.agg(F.min("t"), F.max("t")).head() == (datetime(2024, 1, 1, 22), datetime(2024, 1, 2, 1))


def test_grid_by_month(spark):
    df = literal_table(spark, [("a", datetime(2023, 11, 1), 1.0), ("b", datetime(2024, 2, 1), 2.0)], "k string, t timestamp_ntz, v double")
    got = window.fill_grid(df, ["k"], "t", "v", "m", -9.0, F.lit("2023-11-20").cast("timestamp_ntz"), F.lit("2024-02-02").cast("timestamp_ntz"))
    assert got.count() == 8 and got.where("v = -9").count() == 6


def test_newest_row_per_nullable_key(spark):
    df = literal_table(spark, [(None, 1, "x"), (None, 2, "y"), ("a", 1, "z")], "k string, b int, v string")
    assert by_key(window.newest(df, ["k"], "b"), "v") == {None: "y", "a": "z"}


EDGES = [("w1", "f1"), ("w2", "f1"), ("w3", "f2"), ("f1", "r"), ("f2", "r"), ("r", None)]


def test_ancestors(spark):
    got = {tuple(r) for r in hierarchy.ancestors(literal_table(spark, EDGES, "child string, parent string")).select("descendant", "ancestor", "level").collect()}
    assert got == {("w1", "f1", 1), ("w2", "f1", 1), ("w3", "f2", 1), ("f1", "r", 1), ("f2", "r", 1), ("w1", "r", 2), ("w2", "r", 2), ("w3", "r", 2)}


def test_deep_chain_and_cycle(spark):
    chain = literal_table(spark, [(str(i), str(i + 1)) for i in range(8)], "child string, parent string")
    assert hierarchy.ancestors(chain).count() == 36
    deep = literal_table(spark, [(str(i), str(i + 1)) for i in range(40)], "child string, parent string")
    assert hierarchy.ancestors(deep).agg(F.max("level")).first()[0] == 40
    cycle = literal_table(spark, [("a", "b"), ("b", "a")], "child string, parent string")
    with pytest.raises(Exception, match="cycle"):
        hierarchy.ancestors(cycle).collect()


def test_rollup_keeps_leaves_and_adds_own_rows(spark):
    edges = literal_table(spark, EDGES, "child string, parent string")
    values = literal_table(spark, [("w1", 1, 1.0), ("w2", 1, 2.0), ("w3", 2, 4.0), ("f1", 1, 10.0), ("lone", 1, 9.0)], "entity string, b int, v double")
    got = {(r["entity"], r["b"]): r["v"] for r in hierarchy.rollup(values, edges, "entity", ["b"], {"v": F.sum}).collect()}
    assert got == {("w1", 1): 1.0, ("w2", 1): 2.0, ("w3", 2): 4.0, ("f1", 1): 13.0, ("f2", 2): 4.0, ("r", 1): 13.0, ("r", 2): 4.0, ("lone", 1): 9.0}
    counts = {(r["entity"], r["b"]): r["v"] for r in hierarchy.rollup(values, edges, "entity", ["b"], {"v": lambda c: F.count(c).cast("double")}).collect()}
    assert counts[("w1", 1)] == 1.0 and counts[("lone", 1)] == 9.0 and counts[("f1", 1)] == 3.0


def test_later_hierarchy_wins(spark):
    a = literal_table(spark, [("x", "1"), ("y", "1")], "child string, parent string")
    b = literal_table(spark, [("y", None), ("z", "2")], "child string, parent string")
    assert {tuple(r) for r in hierarchy.merge_hierarchies([a, b]).collect()} == {("x", "1"), ("y", None), ("z", "2")}


UNITS = [("m", "Length", 1.0, 0.0), ("cm", "Length", 0.01, 0.0), ("ft", "Length", 0.3048, 0.0), ("K", "Temperature", 1.0, 0.0), ("C", "Temperature", 1.0, 273.15)]


def test_centimetres_to_metres(spark):
    units = literal_table(spark, UNITS, UNIT_SCHEMA)
    scale, shift = conversion(units, [("cm", "m")])["cm", "m"]
    assert 3 * scale + shift == pytest.approx(0.03)
    df = literal_table(spark, [(3.0, "cm", "m"), (3.0, None, "m"), (3.0, " ", "m"), (3.0, "m", "m"), (20.0, "C", "K"), (3.0, "_", "m")], "v double, s string, t string")
    assert [r["o"] for r in convert_rows(df, units, "v", "s", "t", "o").collect()] == pytest.approx([0.03, 3.0, 3.0, 3.0, 293.15, 3.0])


def test_conversion_errors(spark):
    units = literal_table(spark, UNITS, UNIT_SCHEMA)
    with pytest.raises(ValueError, match="unknown unit"):
        conversion(units, [("cm", "mile")])
    with pytest.raises(ValueError, match="cannot convert"):
        conversion(units, [("cm", "K")])
    with pytest.raises(Exception, match="cannot be empty"):
        add_units(units, literal_table(spark, [(" ", "Length", 1.0, 0.0)], UNIT_SCHEMA)).collect()


@settings(max_examples=20, deadline=None)
@given(v=st.floats(-1e6, 1e6), a=st.sampled_from(["m", "cm", "ft"]), b=st.sampled_from(["m", "cm", "ft"]))
def test_conversion_there_and_back(spark, v, a, b):
    units = literal_table(spark, UNITS, UNIT_SCHEMA)
    f = conversion(units, [(a, b), (b, a)])
    there = v * f[a, b][0] + f[a, b][1]
    assert there * f[b, a][0] + f[b, a][1] == pytest.approx(v, abs=1e-6)
