"""Definition tables: entities, signals, items, parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import ENTITIES_SQL, SIGNALS_SQL, TIME_SQL, entities, signals, table, time_samples
from catalog.predicates import ITEMS_SQL, PARAMETERS_SQL, items, parameters
from gaugework.operators import definitions as defs
from gaugework.operators import filters

_ENTITY = ["name", "type", "alias", "is_opportunity"]


@query("n1_add_entities", f"""SELECT name, CASE WHEN type = 'Supplier' THEN 'Vendor' ELSE type END AS type, alias, is_opportunity FROM {ENTITIES_SQL}
UNION ALL SELECT r_name, 'Region', CAST(NULL AS VARCHAR), false FROM region""")
def add_entities(spark, d):
    have = entities(spark, d)
    changed = filters.entities_of_types(have, "supplier").withColumn("type", F.lit("Vendor"))
    regions = table(spark, d, "region").select(F.col("r_name").alias("name"), F.lit("Region").alias("type"), F.lit(None).cast("string").alias("alias"), F.lit(False).alias("is_opportunity"))
    return defs.upsert_by_name(have, changed.unionByName(regions))


@query("n1_delete_entities", f"SELECT name, type FROM {ENTITIES_SQL} WHERE name NOT IN (SELECT c_name FROM customer WHERE c_acctbal < 0)")
def delete_entities(spark, d):
    gone = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_name").alias("name"))
    return defs.delete_by_name(entities(spark, d), gone).select("name", "type")


@query("n1_signal_defaults", """SELECT DISTINCT substr(p_name || ' / ' || p_type || ' / ' || p_brand, 1, 29) AS short_name, p_name || ' / ' || p_type || ' / ' || p_brand AS name, 'Static' AS type, ' ' AS unit,
'Dimensionless' AS measurement, 'Sum' AS hierarchy_agg, CASE WHEN p_type = 'ECONOMY' THEN 'Average' ELSE 'Sum' END AS interval_agg FROM part""")
def signal_defaults(spark, d):
    p = table(spark, d, "part").select(F.concat_ws(" / ", "p_name", "p_type", "p_brand").alias("name"), "p_type").distinct()
    blank = F.lit("")
    how = F.when(F.col("p_type") == "ECONOMY", "mean").otherwise("no such name")
    raw = p.select("name", blank.alias("short_name"), blank.alias("type"), blank.alias("unit"), F.lit(None).cast("string").alias("measurement"), blank.alias("hierarchy_agg"), how.alias("interval_agg"))
    return defs.with_defaults(raw)


@query("n1_delete_signals", f"SELECT entity, signal, count(*) AS n FROM {TIME_SQL} WHERE signal IN (SELECT name FROM {SIGNALS_SQL} WHERE measurement <> 'Currency') GROUP BY ALL")
def delete_signals(spark, d):
    left = defs.delete_by_name(signals(spark), signals(spark).where("measurement = 'Currency'").select("name"))
    return filters.known_signals_only(time_samples(spark, d), left).groupBy("entity", "signal").agg(F.count(F.lit(1)).alias("n"))


@query("n2_rename_everywhere", f"""SELECT 'entities' AS source, CASE name WHEN 'Supplier#000000003' THEN 'Renamed' ELSE name END AS name FROM {ENTITIES_SQL}
UNION ALL SELECT 'links', CASE s_name WHEN 'Supplier#000000003' THEN 'Renamed' ELSE s_name END FROM supplier JOIN lineitem ON l_suppkey = s_suppkey""")
def rename_everywhere(spark, d):
    s, l = table(spark, d, "supplier"), table(spark, d, "lineitem")
    links = l.join(s, l["l_suppkey"] == s["s_suppkey"]).select(F.col("s_name").alias("entity"))
    done = defs.rename_everywhere({"entities": entities(spark, d), "links": links}, "Supplier#000000003", "Renamed", {"entities": "name", "links": "entity"})
    return done["entities"].select(F.lit("entities").alias("source"), "name").unionByName(
        done["links"].select(F.lit("links").alias("source"), F.col("entity").alias("name")))


@query("n2_rename_type", f"SELECT name, CASE type WHEN 'Supplier' THEN 'Vendor' ELSE type END AS type FROM {ENTITIES_SQL}")
def rename_type(spark, d):
    return defs.rename_everywhere({"e": entities(spark, d)}, "Supplier", "Vendor", {"e": "type"})["e"].select("name", "type")


@query("n3_upsert_items", f"""SELECT type, name, CASE WHEN type = 'Scope' THEN 'changed' ELSE array_to_string(labels, ',') END AS labels FROM {ITEMS_SQL}""")
def upsert_items(spark, d):
    new = items(spark, d).where("type = 'Scope'").withColumn("labels", F.array(F.lit("changed")))
    return defs.upsert_by_name(items(spark, d), new, ["type", "name"]).withColumn("labels", F.array_join("labels", ","))


@query("n3_delete_items", f"SELECT type, name FROM {ITEMS_SQL} WHERE NOT list_contains(labels, 'red')")
def delete_items(spark, d):
    gone = filters.item_labels(items(spark, d)).where("label = 'red'").select("type", "name").distinct()
    return defs.delete_by_name(items(spark, d), gone, ["type", "name"]).select("type", "name")


@query("n3_item_field", f"SELECT name, labels[1] AS first_label, len(labels) AS n_labels FROM {ITEMS_SQL}")
def item_field(spark, d):
    return items(spark, d).select("name", F.get("labels", F.lit(0)).alias("first_label"), F.size("labels").cast("bigint").alias("n_labels"))


@query("n4_enumeration_ids", """SELECT doc_id, item, max(id) AS id FROM (SELECT p_partkey AS doc_id, string_split(p_name, ' ') AS l FROM part), LATERAL (SELECT unnest(l) AS item, unnest(generate_series(0, len(l) - 1)) AS id) GROUP BY ALL""")
def enumeration_ids(spark, d):
    words = table(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), F.split("p_name", " ").alias("l"))
    done = words.select("doc_id", F.explode(defs.enumeration(F.col("l"))).alias("item", "id"))
    return done.withColumn("id", F.col("id").cast("bigint"))


@query("n5_read_parameters", f"""SELECT name, value_type, CASE value_type WHEN 'String' THEN str ELSE CAST(round(num) AS BIGINT)::VARCHAR END AS value FROM {PARAMETERS_SQL}""")
def read_parameters(spark, d):
    p = parameters(spark, d).withColumn("num", F.round("num"))
    done = defs.parameter_text(p)
    return done.withColumn("value", F.regexp_replace("value", r"\.0$", ""))


@query("n5_parameter_in_query", f"""SELECT entity, signal, count(*) AS n FROM {TIME_SQL} WHERE value_num > (SELECT num / 20 FROM {PARAMETERS_SQL} WHERE name = 'p0') GROUP BY ALL""")
def parameter_in_query(spark, d):
    # One row whatever the table holds: null, and so no sample, where the parameter is missing or no number.
    limit = parameters(spark, d).where("name = 'p0'").agg(F.min("num")).head()[0]
    rows = time_samples(spark, d).where(F.col("value_num") > F.lit(limit).cast("double") / 20)
    return rows.groupBy("entity", "signal").agg(F.count(F.lit(1)).alias("n"))


@query("n5_rename_and_delete", f"SELECT CASE name WHEN 'p1' THEN 'first' ELSE name END AS name, value_type FROM {PARAMETERS_SQL} WHERE value_type <> 'String'")
def rename_and_delete(spark, d):
    renamed = defs.rename_everywhere({"p": parameters(spark, d)}, "p1", "first", {"p": "name"})["p"]
    gone = filters.parameters_of_type(renamed, "String").select("name")
    return defs.delete_by_name(renamed, gone).select("name", "value_type")


@query("n6_listing_by_kind", f"SELECT type, count(*) AS n FROM {ITEMS_SQL} GROUP BY 1 UNION ALL SELECT value_type, count(*) FROM {PARAMETERS_SQL} GROUP BY 1")
def listing(spark, d):
    i = items(spark, d).groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    p = parameters(spark, d).groupBy(F.col("value_type").alias("type")).agg(F.count(F.lit(1)).alias("n"))
    return i.unionByName(p)


@query("n6_one_definition", f"SELECT type, name FROM {ITEMS_SQL} WHERE type = 'Scope' AND name = 'Supplier#000000005'")
def one_definition(spark, d):
    return filters.items_of_type(items(spark, d), "Scope").where("name = 'Supplier#000000005'").select("type", "name")
