"""Hierarchies as (child, parent) edges, one parent per child: closure and rollup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.operators.joins import lookup
from gaugework.session import kept

def edges_from_map(df: DataFrame, relation: str) -> DataFrame:
    """A child -> parent map column as edge rows."""
    return df.select(F.explode(relation).alias("child", "parent"))


def paths(edges: DataFrame) -> DataFrame:
    """(node, path): every node that has a parent, with its ancestors from the parent upwards.

    Only nodes that are themselves parents matter above the first level. Their paths are built on those
    few nodes and double with each join until none grows, whatever the depth; the many leaf edges are joined
    to them once. A cycle raises: a path that meets its own node, or is longer than there are inner nodes.
    """
    known = edges.where("parent IS NOT NULL").select("child", "parent")
    parents = known.select("parent").distinct()
    none = F.array().cast("array<string>")
    inner = known.join(parents.withColumnRenamed("parent", "child"), "child", "left_semi")
    above = kept(inner.select(F.col("child").alias("node"), F.array("parent").alias("path")))
    nodes, reach = above.count(), 1
    while True:
        if above.where(F.array_contains("path", F.col("node")) | (F.size("path") > nodes)).limit(1).count():
            raise ValueError("the hierarchy has a cycle")
        if above.where(F.size("path") >= reach).limit(1).count() == 0:
            break
        higher = above.select(F.col("node").alias("top"), F.col("path").alias("more"))
        above = kept(above.join(higher, F.element_at("path", -1) == F.col("top"), "left").select(
            "node", F.concat("path", F.coalesce("more", none)).alias("path")
        ))
        reach *= 2
    return lookup(known, above, [("parent", "node")]).select(
        F.col("child").alias("node"), F.concat(F.array("parent"), F.coalesce("path", none)).alias("path")
    )


def ancestors(edges: DataFrame) -> DataFrame:
    """(descendant, ancestor, level) for every strict ancestor, level 1 being the parent."""
    return paths(edges).select(
        F.col("node").alias("descendant"), F.posexplode("path").alias("level", "ancestor")
    ).withColumn("level", F.col("level") + 1)


def pool(values: DataFrame, up: DataFrame, entity: str) -> DataFrame:
    """Every row under its own entity (``own`` true) and under each ancestor in ``up``, the paths.

    ``values`` should already be reduced to one row per entity and bucket, which takes the weight out of
    a hot entity.
    """
    joined = values.join(up.withColumnRenamed("node", "__node"), F.col(f"`{entity}`") == F.col("__node"), "left")
    targets = F.concat(F.array(entity), F.coalesce("path", F.array().cast("array<string>")))
    spread = joined.select(
        *[F.col(f"`{c}`") for c in values.columns if c != entity], F.posexplode(targets).alias("__level", entity)
    )
    return spread.withColumn("own", F.col("__level") == 0).drop("__level")


def rolled(value: Column, aggregate: Callable[[Column], Column]) -> Column:
    """Aggregate over a pool; where nothing arrives from below, the entity's own value stays as it is."""
    below = F.count(F.when(~F.col("own"), value))
    return F.when(below == 0, F.max(value)).otherwise(aggregate(value))


def rollup(
    values: DataFrame, edges: DataFrame, entity: str, keys: list[str],
    aggregates: dict[str, Callable[[Column], Column]],
) -> DataFrame:
    """Each entity's columns aggregated over its own row and all rows below it, in one grouping.

    Aggregates combine before the shuffle, so an entity with very many descendants is not gathered.
    """
    cells = [rolled(F.col(f"`{c}`"), how).alias(c) for c, how in aggregates.items()]
    return pool(values, paths(edges), entity).groupBy(entity, *keys).agg(*cells)


def merge_hierarchies(parts: list[DataFrame]) -> DataFrame:
    """Union of edges where the later hierarchy wins per child."""
    rows = [p.select("child", "parent", F.lit(i).alias("ordinal")) for i, p in enumerate(parts)]
    union = rows[0]
    for r in rows[1:]:
        union = union.unionByName(r)
    return union.groupBy("child").agg(F.max_by("parent", "ordinal").alias("parent"))
