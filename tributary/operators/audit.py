"""Audit queries over a graph snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.graph import endpoints


def summary(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(ontology_id, entities, relations, density, isolated)."""
    touched = endpoints(edges).distinct().withColumn("in_graph", F.lit(1))
    n = vertices.join(touched, "id", "left").groupBy("ontology_id").agg(F.count("*").alias("entities"), F.sum(1 - F.coalesce("in_graph", F.lit(0))).alias("isolated"))
    m = edges.groupBy("ontology_id").agg(F.count("*").alias("relations"))
    x = n.join(m, "ontology_id", "left").na.fill(0, ["relations"])
    pairs = F.col("entities") * (F.col("entities") - 1)
    return x.select("ontology_id", "entities", "relations", F.round(F.when(pairs == 0, 0.0).otherwise(F.col("relations") / pairs), 4).alias("density"), "isolated")


def coverage(vertices: DataFrame, edges: DataFrame, least: float = 0.5, names: int = 10) -> DataFrame:
    """(type, total, coverage, isolated_names): types of which too few vertices are in the graph."""
    touched = endpoints(edges).distinct().withColumn("in_graph", F.lit(1))
    x = vertices.join(touched, "id", "left").withColumn("in_graph", F.coalesce("in_graph", F.lit(0)))
    share = F.avg("in_graph")
    first = F.slice(F.array_sort(F.collect_set(F.when(F.col("in_graph") == 0, F.col("name_cn")))), 1, names)
    return x.groupBy("type").agg(F.count("*").alias("total"), share.alias("share"), first.alias("isolated_names")).filter(F.col("share") < least).select("type", "total", F.round("share", 2).alias("coverage"), "isolated_names")
