"""Many signals resampled as rows give what one expression per column gives."""

from datetime import datetime, timedelta

import pytest

from gaugework.operators.definitions import SIGNAL_SCHEMA
from gaugework.operators.units import SCHEMA as UNIT_SCHEMA
from gaugework.plans import signals as plans
from gaugework.plans.context import Context, Scope
from gaugework.session import literal_table

HOWS = ["Sum", "Average", "Max", "Min", "First", "Last", "Count", "StandardDeviation", "Variance", "Range", "Median", "Mode"]
UNITS = [("C", "Temperature", 1.0, 273.15), ("K", "Temperature", 1.0, 0.0), ("cK", "Temperature", 0.01, 0.0), (" ", "Dimensionless", 1.0, 0.0)]


@pytest.fixture(scope="module")
def given(spark):
    defined = [(f"{h} {i}", "", "TimeDependent", "C", "Temperature", "Sum", h) for h in HOWS for i in range(2)]
    defined.append(("note", "", "StringTimeDependent", " ", "Dimensionless", "Sum", "Max"))
    defined.append(("text", "", "StringTimeDependent", " ", "Dimensionless", "Sum", "Sum"))
    at, rows = datetime(2024, 1, 1), []
    for entity in ("a", "b", None):
        for n in range(40):
            when = at + timedelta(hours=7 * n)
            for j, (name, *_) in enumerate(defined[:-2]):
                if (n + j) % 3:  # some buckets lack a signal, some samples a value
                    rows.append((entity, name, when, None if n % 5 == 0 else float((n * j) % 11) / 4, None))
            rows.append((entity, "note", when, None, "x" * (n % 4)))
            rows.append((entity, "text", when, None, chr(97 + n % 26)))
    samples = literal_table(spark, rows, "entity string, signal string, date timestamp_ntz, value_num double, value_str string")
    return samples, literal_table(spark, defined, SIGNAL_SCHEMA), literal_table(spark, UNITS, UNIT_SCHEMA), [d[0] for d in defined]


def _load(given, wanted, step="Daily"):
    samples, defined, units, _ = given
    return plans.load_signals(plans.SignalData(time=samples), defined, units, wanted, Context(scope=Scope(time_step=step)))


def _rows(df):
    return sorted([tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in df.collect()], key=str)


def test_rows_and_columns_agree(given, monkeypatch):
    wanted = [*given[3], "Sum 0 [K]", "Sum 0 [cK]", "Max 1 [cK]", "Count 0 [K]", "Median 0 [K]", "Mode 1 [cK]"]
    monkeypatch.setattr(plans, "WIDE", 10_000)
    few = _load(given, wanted)
    expected, types = _rows(few), few.dtypes
    monkeypatch.setattr(plans, "WIDE", 0)
    many = _load(given, wanted)
    assert many.dtypes == types and _rows(many) == expected and len(expected) > 30


def test_each_median_alone(given, monkeypatch):
    together = {(r["Entity"], r["Date"]): (r["Median 0 [C]"], r["Median 1 [K]"]) for r in _load(given, ["Median 0", "Median 1 [K]"]).collect()}
    for place, name in enumerate(("Median 0 [C]", "Median 1 [K]")):
        alone = {(r["Entity"], r["Date"]): r[name] for r in _load(given, [name]).collect()}
        assert alone and all(together[k][place] == pytest.approx(v) for k, v in alone.items())


def test_one_scan_for_many_signals(given, monkeypatch, tmp_path):
    samples, defined, units, _ = given
    samples.write.parquet(str(tmp_path / "s"))
    stored = samples.sparkSession.read.parquet(str(tmp_path / "s"))
    monkeypatch.setattr(plans, "WIDE", 0)
    wanted = [f"{h} {i}" for h in HOWS[:10] for i in range(2)]
    df = plans.load_signals(plans.SignalData(time=stored), defined, units, wanted, Context(scope=Scope(time_step="Daily")))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_no_samples(given, monkeypatch):
    samples, defined, units, _ = given
    monkeypatch.setattr(plans, "WIDE", 0)
    done = plans.load_signals(plans.SignalData(time=samples.where("false")), defined, units, ["Sum 0", "Count 1"], Context(scope=Scope(time_step="Daily")))
    assert done.columns == ["Entity", "Date", "Sum 0 [C]", "Count 1 [C]"] and done.count() == 0
