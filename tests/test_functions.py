"""Names, vocabularies, casts, buckets and map projection on small frames."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugework.functions import buckets, casts, geo, names, vocabulary
from gaugework.session import literal_table


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [("rate [m3/d]", ("rate", "m3/d")), (" rate ", ("rate", "")), ("a [b] [c]", ("a", "b")), ("[x]", ("", "x")), ("open [b", ("open", ""))],
)
def test_split_header(spark, text, expected):
    assert names.split_header(text) == expected
    row = literal_table(spark, [(text,)], "h string").select(names.name_part(F.col("h")), names.unit_part(F.col("h"))).head()
    assert tuple(row) == expected


def test_entity_headers():
    assert names.split_entity_header("Well 1 : rate [m]") == ("Well 1", "rate [m]")
    assert names.split_entity_header("Date") == ("", "Date")
    assert names.split_entity_header("a:b") == ("", "a:b")


def test_formula_refs(spark):
    df = literal_table(spark, [('E "Oil" in "m3"',), ('"Oil"',), ("none",), ("",)], "f string")
    assert column(df, names.formula_signal(F.col("f"))) == ["Oil", "Oil", "", ""]
    assert column(df, names.formula_unit(F.col("f"))) == ["m3", " ", " ", " "]


@pytest.mark.parametrize(
    "kind, text, expected",
    [
        ("depth increment", "0.5m", "HalfMeter"), ("depth increment", "EighthMeter", "EighthMeter"), ("depth increment", "0.125 m", "EighthMeter"),
        ("time increment", "Every Five Minutes", "EveryFiveMinutes"), ("time increment", "1-Hour", "Hourly"), ("time increment", "3M", "Quarterly"),
        ("aggregation", "LONGEST", "Max"), ("aggregation", "no_agg", "NoAggregation"), ("signal type", "time string", "StringTimeDependent"),
        ("model type", "Multi-Class", "MultipleClassification"), ("normalisation", "mean var", "MeanVariance"),
    ],
)
def test_canonical_names(spark, kind, text, expected):
    assert vocabulary.canonical(kind, text) == expected
    df = literal_table(spark, [(text,)], "t string")
    assert column(df, vocabulary.canonical_column(kind, F.col("t"))) == [expected]


def test_unknown_names_raise(spark):
    with pytest.raises(ValueError):
        vocabulary.canonical("depth increment", "5m")
    df = literal_table(spark, [("nothing",)], "t string")
    with pytest.raises(Exception, match="unknown aggregation"):
        df.select(vocabulary.canonical_column("aggregation", F.col("t"))).collect()
    assert column(df, vocabulary.canonical_column("aggregation", F.col("t"), strict=False)) == [None]


def test_every_spelling_is_accepted():
    for kind, words in vocabulary.VOCABULARIES.items():
        for name, spellings in words.items():
            assert vocabulary.canonical(kind, name) == name
            for s in spellings:
                assert vocabulary.canonical(kind, s.upper()) == name


def test_strict_and_lenient_casts(spark):
    df = literal_table(spark, [("1.5",), ("x",)], "t string")
    assert column(df, casts.to_number(F.col("t"), strict=False)) == [1.5, None]
    with pytest.raises(Exception):
        df.select(casts.to_number(F.col("t"))).collect()
    with pytest.raises(Exception):
        df.select(casts.text_to_time(F.col("t"))).collect()


def test_truthiness(spark):
    df = literal_table(spark, [("false", 0, 0.5), ("", 2, 0.0)], "t string, n int, d double")
    assert column(df, casts.cast_column(df, "t", "bool")) == [True, False]
    assert column(df, casts.cast_column(df, "n", "boolean")) == [False, True]
    assert column(df, casts.cast_column(df, "d", "bool")) == [True, False]


def test_date_text(spark):
    texts = ["2024-01-02", "2024-01-02T03:04:05", "2024-01-02T03:04:05.000007", " later ", None]
    df = literal_table(spark, [(t,) for t in texts], "t string")
    assert column(df, casts.date_text(F.col("t"))) == [
        "2024-01-02T00:00:00.000000", "2024-01-02T03:04:05.000000", "2024-01-02T03:04:05.000007", "later", ""]


def test_missing_values(spark):
    df = literal_table(spark, [(None, None), ("  ", 1.0), ("a", 2.0)], "t string, n double")
    text = df.schema["t"].dataType
    assert column(df, casts.or_missing(F.col("t"), "numeric", text)) == ["NaN", "NaN", "a"]
    assert column(df, casts.or_missing(F.col("t"), "string", text)) == ["", "  ", "a"]
    assert column(df, casts.or_missing(F.col("t"), "bool", text)) == [None, None, "a"]
    assert column(df, casts.or_missing(F.col("n"), "numeric", df.schema["n"].dataType)) == ["NaN", "1.0", "2.0"]


_MOMENT = datetime(2024, 5, 17, 13, 47, 31, 250000)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize(
    "step, expected",
    [
        ("s", datetime(2024, 5, 17, 13, 47, 31)), ("min", datetime(2024, 5, 17, 13, 47)), ("5min", datetime(2024, 5, 17, 13, 45)),
        ("15min", datetime(2024, 5, 17, 13, 45)), ("h", datetime(2024, 5, 17, 13)), ("d", datetime(2024, 5, 17)), ("m", datetime(2024, 5, 1)),
        ("q", datetime(2024, 4, 1)), ("y", datetime(2024, 1, 1)),
    ],
)
def test_time_buckets_ignore_the_zone(spark, zone, step, expected):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = literal_table(spark, [(_MOMENT,), (None,)], "t timestamp_ntz")
        assert column(df, buckets.time_bucket(F.col("t"), step)) == [expected, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bucket_in_a_daylight_saving_gap(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = literal_table(spark, [(datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
        assert column(df, buckets.time_bucket(F.col("t"), "hour")) == [datetime(2024, 3, 10, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("step, width", list(vocabulary.DEPTH_STEP_METRES.items()))
def test_depth_bucket_edges(spark, step, width):
    depths = [i * width for i in range(40)]
    df = literal_table(spark, [(i, d) for i, d in enumerate(depths)], "i int, d double")
    assert df.where(buckets.depth_bucket(F.col("d"), step) != F.col("i")).count() == 0


def test_finest_and_coarsest():
    assert buckets.finest("time", ["d", "hour", None, "y"]) == "Hourly"
    assert buckets.coarsest("depth", ["ft", "0.1m"]) == "Foot"
    assert buckets.finest("time", []) is None


@settings(max_examples=25, deadline=None)
@given(x=st.floats(-2e7, 2e7), y=st.floats(-2e7, 2e7))
def test_projection_against_closed_form(spark, x, y):
    import math

    row = literal_table(spark, [(x, y, "EPSG:3857")], "x double, y double, crs string")
    got = geo.project_points(row).head()
    assert got["crs"] == "EPSG:4326"
    assert got["x"] == pytest.approx(math.degrees(x / geo.EARTH_RADIUS))
    assert got["y"] == pytest.approx(math.degrees(2 * math.atan(math.exp(y / geo.EARTH_RADIUS)) - math.pi / 2))
