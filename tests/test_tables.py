"""Reshaping, reference tables, stores, files and logs."""

from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugework.operators import reftable, reshape
from gaugework.operators.combine import check_reserved
from gaugework.operators.definitions import (
    PARAMETER_SCHEMA, SIGNAL_SCHEMA, enumeration, parameter, parameter_text, remapped, with_defaults,
)
from gaugework.operators.units import SCHEMA as UNIT_SCHEMA
from gaugework.session import literal_table, new_folder
from gaugework.sources import files, logs, pivot_store, series
from gaugework.sources.ref_store import RefTableStore
from gaugework.sources.signal_store import SignalStore

START = datetime(2025, 1, 1)
UNITS = [("ft", "Length", 0.3048, 0.0), ("cm", "Length", 0.01, 0.0), ("m", "Length", 1.0, 0.0)]
COLUMNS = "Entity string, Time timestamp_ntz, Key bigint, A double, B double, C double, D double, `E [ft]` double, `F [cm]` double"


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)


# --- reshaping -------------------------------------------------------------------------------------
def test_pivot_raises_on_duplicates_by_default(spark):
    df = literal_table(spark, [("e", "s", 1.0), ("e", "s", 2.0)], "Entity string, signal string, v double")
    with pytest.raises(Exception, match="duplicate rows"):
        reshape.pivot_signals(df, ["Entity"], {"s": ("v", "s")}).collect()


def test_pivot_strict_raises_on_duplicates(spark):
    df = literal_table(spark, [("w", "s", 1.0), ("w", "s", 2.0)], "Entity string, signal string, v double")
    assert reshape.pivot_signals(df, ["Entity"], {"s": ("v", "s")}, strict=False).head()["s"] == 2.0
    with pytest.raises(Exception, match="duplicate rows for signal s"):
        reshape.pivot_signals(df, ["Entity"], {"s": ("v", "s")}, strict=True).collect()


def test_wide_to_long_drops_empty_groups(spark):
    df = literal_table(spark, [(1, 1.0, None, "x"), (2, None, 4.0, None)], "Date int, `A : r` double, `B : r` double, `B : t` string")
    got = reshape.wide_to_long(df)
    assert got.columns == ["Date", "Entity", "r", "t"]
    assert rows_of(got, "Date", "Entity", "r", "t") == [(1, "A", 1.0, None), (1, "B", None, "x"), (2, "B", 4.0, None)]
    plain = literal_table(spark, [(1,)], "Date int")
    assert reshape.wide_to_long(plain) is plain


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 5)), st.floats(-1e3, 1e3), min_size=1, max_size=12))
def test_long_wide_long_is_identity(spark, cells):
    long = literal_table(spark, [(e, d, v) for (e, d), v in cells.items()], "Entity string, Date int, `rate [m]` double")
    back = reshape.wide_to_long(reshape.long_to_wide(long))
    assert rows_of(back, "Entity", "Date", "rate [m]") == rows_of(long, "Entity", "Date", "rate [m]")


def test_long_to_wide_by_row_and_limit(spark):
    long = literal_table(spark, [(0, "A", 1, 1.0), (1, "B", 1, 2.0)], "row int, Entity string, Date int, v double")
    assert reshape.long_to_wide(long.drop("row")).count() == 1
    assert reshape.long_to_wide(long, row_id="row").count() == 2
    many = literal_table(spark, [(f"e{i}", 1, float(i)) for i in range(2100)], "Entity string, Date int, v double")
    assert len(reshape.entities_in(many)) == 2100


def test_tab_lines_short_and_long(spark):
    df = literal_table(spark, [("a\tb\tc",), ("a",), ("a\tb\tc\td",), ('"a\tb\t"',)], "value string")
    got = reshape.tab_lines(df, ["x", "y", "z"])
    assert rows_of(got, "x", "y", "z") == [('"a', "b", '"'), ("a", "b", "c"), ("a", None, None)]


def test_table_from_rows_overrides_fixed_headers(spark):
    df = literal_table(spark, [(["7", "2024-01-01T00:00:00Z", "true", "1.5", ""],)], "r array<string>")
    got = reshape.table_from_rows(df, "r", ["Entity", "Date", "IsOpportunity", "x", "y"], ["Numeric", "String", "String", "Numeric", "Numeric"])
    assert tuple(got.head()) == ("7", datetime(2024, 1, 1), True, 1.5, None)


def test_reserved_names():
    check_reserved(["Entity", "Time", "Key"], ["Entity", "Time"])
    for bad in ("ID", "Timestamp [h]", "Entity [m]"):
        with pytest.raises(ValueError, match="reserved"):
            check_reserved(["Entity", "Time", bad], ["Entity", "Time"])


# --- reference tables ---------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def hundred(spark):
    rows = [
        ("Well 001" if i <= 50 else None, None if i % 10 == 9 else START + timedelta(hours=i), i, *[float(i * k) for k in range(1, 7)])
        for i in range(100)
    ]
    return literal_table(spark, rows, COLUMNS)


@pytest.fixture()
def store(spark, hundred):
    s = RefTableStore(spark, new_folder(spark, "ref"), literal_table(spark, UNITS, UNIT_SCHEMA))
    s.create("t", hundred, description="test")
    return s


def test_define_by_name_and_position(spark):
    df = literal_table(spark, [], "v double, Timestamp timestamp_ntz, Entity string, `Key [m]` bigint, ok boolean")
    t = reftable.define("t", df)
    assert (t.entity, t.time, t.key) == ("Entity", "Timestamp", reftable.ColumnInfo("Key", "m", "Numeric", "long"))
    assert [(c.name, c.unit, c.type) for c in t.values] == [("v", " ", "Numeric"), ("ok", " ", "Bool")]
    by_position = reftable.define("t", literal_table(spark, [], "a string, b timestamp_ntz, c string, d string"))
    assert (by_position.entity, by_position.time, by_position.key.name) == ("a", "b", "c")
    with pytest.raises(ValueError):
        reftable.define("t", literal_table(spark, [], "a string, b timestamp_ntz"))


def test_upserts_keep_a_hundred_rows(store, hundred):
    assert store.load("t").count() == 100
    store.save("t", hundred)
    store.save("t", hundred.withColumn("A", F.lit(-1.0)))
    assert store.load("t").count() == 100 and store.load("t").where("`A [ ]` = -1").count() == 100
    store.save("t", hundred, skip_existing=True)
    assert store.load("t").count() == 100 and store.load("t").where("`A [ ]` = -1").count() == 100
    with pytest.raises(ValueError, match="columns"):
        store.save("t", hundred.drop("A"))


def test_newest_of_repeated_keys_in_a_batch(store, hundred):
    twice = hundred.withColumn("n", F.lit(1)).unionByName(hundred.withColumns({"n": F.lit(2), "A": F.lit(-2.0)}))
    store.save("t", twice, order="n")
    assert store.load("t").count() == 100 and store.load("t").where("`A [ ]` = -2").count() == 100


def test_filters_units_and_top(store):
    got = store.load("t", start="2025-01-01", end="2025-01-02", columns=["F [cm]", "E [cm]"], all_columns=False, top=10,
                     entities="Well 001", where="[Entity] = 'Well 001' AND [Key] >= '20'")
    assert got.columns == ["Entity", "Time", "Key [ ]", "E [cm]", "F [cm]"]
    rows = got.collect()
    assert [r["Key [ ]"] for r in rows] == [20, 21, 22, 23, 24]
    assert rows[0]["E [cm]"] == pytest.approx(20 * 5 * 30.48) and rows[0]["F [cm]"] == pytest.approx(120)
    assert store.load("t", columns={"E": "m"}).columns[-2:] == ["E [m]", "F [cm]"]


def test_deletes(store, spark):
    store.delete("t", entities=["Well 001", None], start="2025-01-01", end="2025-01-10", drop_null_times=True, where="[Key] > '20'")
    assert {r[0] for r in store.load("t").select("`Key [ ]`").collect()} == set(range(21))
    store.delete("t", keys=literal_table(spark, [("Well 001", START, 0), ("Well 001", None, 9), ("nobody", START, 1)], "e string, t timestamp_ntz, k bigint"))
    assert {r[0] for r in store.load("t").select("`Key [ ]`").collect()} == set(range(1, 21)) - {9}
    store.delete("t", end="2024-01-01")
    assert store.load("t").count() == 19
    store.delete("t")
    assert store.load("t").count() == 0 and store.names() == ["t"]
    store.drop("t")
    assert store.names() == []


def test_month_without_rows_left_is_removed(spark):
    s = RefTableStore(spark, new_folder(spark, "ref"), literal_table(spark, UNITS, UNIT_SCHEMA))
    s.create("t", literal_table(spark, [("a", datetime(2024, m, 1), m, 1.0) for m in (1, 2, 3)] + [(None, None, 4, 1.0)], "Entity string, Time timestamp_ntz, Key int, v double"))
    s.delete("t", start="2024-02-01", end="2024-02-28")
    s.delete("t", entities=[None])
    assert {r[0] for r in s.load("t").select("`Key [ ]`").collect()} == {1, 3}


def test_big_keys_stay_apart(spark):
    s = RefTableStore(spark, new_folder(spark, "ref"), literal_table(spark, UNITS, UNIT_SCHEMA))
    df = literal_table(spark, [("a", START, 2**53, 1.0), ("a", START, 2**53 + 1, 2.0)], "Entity string, Time timestamp_ntz, Key bigint, v double")
    s.create("t", df)
    s.save("t", df)
    assert s.load("t").count() == 2


def test_condition_text():
    assert reftable.sql_condition("[A b] = '[x]' AND [C [m]] > 'it''s [y]'".replace("[C [m]]", "[C]")) == "`A b` = '[x]' AND `C` > 'it''s [y]'"


@settings(max_examples=8, deadline=None)
@given(st.sets(st.integers(0, 99), max_size=30))
def test_kept_and_deleted_make_all(spark, hundred, chosen):
    t = reftable.define("t", hundred)
    stored = reftable.to_stored(hundred, t, literal_table(spark, UNITS, UNIT_SCHEMA))
    keys = stored.where(F.col("Key").isin(list(chosen)) if chosen else F.lit(False)).select(*t.keys)
    kept = reftable.delete_rows(stored, t, keys=keys)
    assert {r["Key"] for r in kept.collect()} == set(range(100)) - chosen


def test_stored_unit_conversion_keeps_type(spark, hundred):
    t = reftable.define("t", hundred)
    given_rows = hundred.withColumnsRenamed({"E [ft]": "E [cm]", "A": "A [kg]"})
    got = reftable.to_stored(given_rows, t, literal_table(spark, UNITS, UNIT_SCHEMA))
    assert got.where("Key = 10").head()["E"] == pytest.approx(50 / 30.48)
    assert got.where("Key = 10").head()["A"] == 10.0


# --- signal store ---------------------------------------------------------------------------------------
def test_signal_store_round_trip(spark):
    s = SignalStore(spark, new_folder(spark, "sig"))
    odd = "*,$&^§()#//=2!~*' é"
    rows = [(odd, "rate: %/", START + timedelta(days=40 * i), float(i)) for i in range(4)]
    df = literal_table(spark, rows, "entity string, signal string, date timestamp_ntz, value_num double")
    s.save(df, "time")
    s.save(df.withColumn("value_num", F.col("value_num") + 1), "time")
    assert rows_of(s.scan(), "entity", "value_num") == [(odd, float(i + 1)) for i in range(4)]
    assert s.scan(["rate: %/"], start=START, end=START).count() == 1
    pair = literal_table(spark, [(odd, "rate: %/")], "entity string, signal string")
    s.delete(pair, "date", START, START + timedelta(days=41))
    assert rows_of(s.scan(), "value_num") == [(3.0,), (4.0,)]
    s.delete(pair)
    assert s.scan().count() == 0


def test_scan_prunes_directories(spark):
    s = SignalStore(spark, new_folder(spark, "sig"))
    df = spark.range(400).select(
        F.lit("w").alias("entity"), F.concat(F.lit("s"), F.col("id") % 3).alias("signal"),
        (F.lit(START) + F.make_dt_interval(days=F.col("id").cast("int"))).cast("timestamp_ntz").alias("date"), F.col("id").cast("double").alias("value_num"))
    s.save(df, "time")
    got = s.scan(["s1"], start=datetime(2025, 3, 1), end=datetime(2025, 3, 31))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "isnotnull(month" in plan
    assert got.count() == 10


def test_series_are_split_and_joined_again(spark):
    rows = [("w" if i % 4 else "v", "s", None, START + timedelta(minutes=i), float(i)) for i in range(1000)]
    df = literal_table(spark, rows, "Entity string, Signal string, Unit string, Date timestamp_ntz, Value double")
    for part, n in ((None, {1}), (F.date_trunc("hour", "Date"), {17})):
        nested = series.nest_series(df, part=part)
        assert {r["count"] for r in nested.groupBy("Entity").count().collect()} == n
        assert all(list(r["Data"]) == sorted(r["Data"]) for r in nested.collect())
        assert rows_of(series.flatten_series(nested), "Entity", "Date", "Value") == rows_of(df, "Entity", "Date", "Value")


def test_static_records(spark):
    df = literal_table(spark, [("w", "s", "m", 5.0)], "Entity string, Signal string, Unit string, Data double")
    assert tuple(series.flatten_series(df).head()) == ("w", "s", "m", 5.0)


# --- files, logs, definitions -------------------------------------------------------------------------
def test_csv_and_json_round_trip(spark):
    df = spark.range(1000).select(*[(F.rand(i) * 100).alias(c) for i, c in enumerate("ABCDEF")]).cache()
    base = new_folder(spark, "files")
    files.write_csv(df, f"{base}/csv")
    assert rows_of(files.read_csv(spark, f"{base}/csv", df.schema), "A", "F") == rows_of(df, "A", "F")
    files.write_json(df, f"{base}/json")
    assert rows_of(files.read_json(spark, f"{base}/json", df.schema), "A", "F") == rows_of(df, "A", "F")
    names = [r["name"] for r in files.list_files(spark, base, "csv/").collect()]
    assert names and all(n.startswith("csv/part-") for n in names)
    assert {r["name"].split("/")[0] for r in files.read_folder(spark, base).collect()} == {"csv", "json"}
    assert files.read_bytes(spark, f"{base}/csv/*.csv").where("length(content) > 0").count() >= 1
    assert files.read_text(spark, f"{base}/csv", whole=True).count() == len(names)


def test_empty_table(spark):
    t = files.empty_table(spark, {"a": "str", "b": "float64", "c": "datetime64[ns]", "d": "bool", "e": [1, 2.5], "f": ["x"]})
    assert t.count() == 0 and [x for _, x in t.dtypes] == ["string", "double", "timestamp_ntz", "boolean", "double", "string"]


def test_log_defaults(spark):
    path = new_folder(spark, "log")
    rows = literal_table(spark, [("hi", None), ("", "Own")], "message string, CATEGORY string")
    logs.append_logs(logs.log_rows(rows), path)
    logs.append_logs(logs.workflow_log_rows(rows.select("message"), "nightly"), path)
    got = logs.read_logs(spark, path)
    assert len(got.columns) == 21
    assert rows_of(got, "Message", "Category", "UserName") == [
        ("", "Own", None), ("", "Workflow Execution", "WorkflowService"), ("hi", "Python Script", None), ("hi", "Workflow Execution", "WorkflowService")]


def test_saved_pivots(spark):
    root = new_folder(spark, "pivot")
    pivot_store.save_pivot(spark.range(50), root, "p")
    assert pivot_store.load_pivot(spark, root, "p").count() == 50 and pivot_store.load_pivot(spark, root, "p", 7).count() == 7
    assert pivot_store.delete_pivot(spark, root, "p") and not pivot_store.delete_pivot(spark, root, "p")


def test_parameters_by_python_value(spark):
    given_values = {"n": 3.5, "s": "text", "l": [1, "b"], "d": {"a": 1}, "e": ("x", "y", ("z", 7), "w")}
    rows = [parameter(k, v) for k, v in given_values.items()] + [parameter("u", 2, unit="m")]
    df = spark.createDataFrame(rows, PARAMETER_SCHEMA)
    kinds = {r["name"]: r["value_type"] for r in df.collect()}
    assert kinds == {"n": "Numeric", "s": "String", "l": "List", "d": "Dictionary", "e": "Enumeration", "u": "NumericWithUnit"}
    text = {r["name"]: r["value"] for r in parameter_text(df).collect()}
    assert text["n"] == "3.5" and text["l"] == '["1","b"]' and text["e"] == '{"x":0,"y":1,"z":7,"w":8}'
    with pytest.raises(TypeError):
        parameter("bad", object())
    assert literal_table(spark, [(["a", "b"],)], "l array<string>").select(enumeration(F.col("l"))).head()[0] == {"a": 0, "b": 1}


def test_signal_defaults_and_remap(spark):
    long = "a signal with quite a long name, indeed"
    rows = [(long, "", "", "", None, "longest", "?"), ("s", "x", "time", "m", "Length", "", None)]
    got = with_defaults(literal_table(spark, rows, SIGNAL_SCHEMA)).collect()
    assert tuple(got[0]) == (long, long[:29], "Static", " ", "Dimensionless", "Max", "Sum")
    assert tuple(got[1]) == ("s", "x", "TimeDependent", "m", "Length", "Sum", "Sum")
    m = literal_table(spark, [("a", "b")], "old string, new string")
    df = literal_table(spark, [("a",), ("c",), (None,)], "e string")
    assert rows_of(remapped("e", m, df), "e") == [("b",), ("c",), (None,)]
