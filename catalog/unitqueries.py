"""Units."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import SIGNALS_SQL, TIME_SQL, UNITS_SQL, signals, table, time_samples, units
from gaugework.operators.units import add_units, conversion, convert_rows, converted, measurements, units_of

_PASSES = "CASE WHEN unit IS NULL OR target IS NULL OR trim(unit) = '' OR trim(target) = '' OR unit = target THEN v"
_MIXED = """(SELECT p_partkey, p_retailprice AS v, CASE p_size % 5 WHEN 0 THEN 'cm' WHEN 1 THEN 'ft' WHEN 2 THEN NULL WHEN 3 THEN ' ' ELSE 'm' END AS unit, 'm' AS target FROM part)"""


@query("m1_convert_rows", f"""SELECT p_partkey, round({_PASSES} ELSE (v * s.factor + s.summand - t.summand) / t.factor END, 6) AS value
FROM {_MIXED} LEFT JOIN {UNITS_SQL} s ON s.name = unit LEFT JOIN {UNITS_SQL} t ON t.name = target""")
def rows_converted(spark, d):
    k = F.col("p_size") % 5
    unit = F.when(k == 0, "cm").when(k == 1, "ft").when(k == 3, "_").when(k == 4, "m")
    rows = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("v"), unit.alias("unit"), F.lit("m").alias("target"))
    return convert_rows(rows, units(spark), "v", "unit", "target", "value").select("p_partkey", F.round("value", 6).alias("value"))


@query("m1_convert_column", """SELECT p_partkey, round(p_retailprice * 0.01, 8) AS metres, round((p_retailprice + 273.15 - 255.3722222222222) / 0.5555555555555556, 6) AS fahrenheit FROM part""")
def column_converted(spark, d):
    pairs = [("cm", "m"), ("C", "F")]
    factors = conversion(units(spark), pairs)
    v = F.col("p_retailprice")
    return table(spark, d, "part").select(
        "p_partkey", F.round(converted(v, *factors["cm", "m"]), 8).alias("metres"), F.round(converted(v, *factors["C", "F"]), 6).alias("fahrenheit"))


@query("m2_units_of_used_measurements", f"""SELECT DISTINCT u.name, u.measurement FROM {TIME_SQL} s JOIN {SIGNALS_SQL} d ON s.signal = d.name
JOIN {UNITS_SQL} u ON u.measurement = d.measurement WHERE u.measurement = 'Currency'""")
def units_of_measurement(spark, d):
    used = time_samples(spark, d).select(F.col("signal").alias("name")).distinct()
    measured = signals(spark).join(used, "name", "left_semi").select("measurement").distinct()
    return units_of(units(spark), "Currency").join(measured, "measurement", "left_semi").select("name", "measurement")


@query("m2_measurements", """SELECT DISTINCT p_type AS measurement FROM part""")
def all_measurements(spark, d):
    return measurements(_part_units(spark, d))


def _part_units(spark, d):
    """A unit per part brand and type, the type being its measurement."""
    return table(spark, d, "part").groupBy(F.concat_ws("/", "p_brand", "p_type").alias("name"), F.col("p_type").alias("measurement")).agg(
        F.round(F.avg("p_size"), 6).alias("factor"), F.lit(0.0).alias("summand"))


@query("m3_add_units", """SELECT p_brand || '/' || p_type AS name, p_type AS measurement, CASE WHEN p_type = 'ECONOMY' THEN 1.0::DOUBLE ELSE round(avg(p_size), 6) END AS factor,
0.0::DOUBLE AS summand FROM part GROUP BY 1, 2""")
def added_units(spark, d):
    have = _part_units(spark, d)
    new = have.where("measurement = 'ECONOMY'").withColumns({"factor": F.lit(None).cast("double"), "summand": F.lit(None).cast("double")})
    return add_units(have, new)
