"""Collecting queries and their SQL by name, and the views that many of them read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.plans.tables import table


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None) -> Callable:
        """``sql`` may name the views v, e, r, a, o, c of VIEWS."""

        def add(f: Callable) -> Callable:
            if name in self.queries:
                raise ValueError(f"query {name} is there already")
            self.queries[name] = lambda spark, d: f(lambda t: view(spark, d, t))
            if sql:
                self.sql[name] = with_views(sql)
            return f

        return add


#: Short views: the latest version of each entity, each relation once, rules, actions, the typed purchase rows.
VIEWS = {
    "v": "SELECT id, ontology_id, name_cn, name_en, type, description, properties, confidence, version, created_at, updated_at, deleted_at FROM entities QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1",
    "e": "SELECT DISTINCT id, ontology_id, source_entity, target_entity, type, confidence, created_at FROM relations",
    "r": "SELECT * FROM logic_rules",
    "a": "SELECT * FROM actions",
}


def with_views(sql: str) -> str:
    used = [k for k in VIEWS if f" {k} " in f" {sql} ".replace("\n", " ").replace(",", " ").replace(")", " ").replace("(", " ")]
    views = ", ".join(f"{k} AS ({VIEWS[k]})" for k in used)
    body = sql.strip()
    if not views:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {views}, {body[14:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {views}, {body[5:]}"
    return f"WITH {views} {body}"


def latest(entities: DataFrame, *columns: str) -> DataFrame:
    """The latest version of each entity; columns that are not named are not carried along, as a struct is never pruned."""
    return entities.groupBy("id").agg(F.max_by(F.struct(*columns), "updated_at").alias("x")).select("id", "x.*")


def view(spark: SparkSession, d: str, name: str) -> DataFrame:
    if name == "v":
        df = table(spark, d, "entities")
        cols = ["ontology_id", "name_cn", "name_en", "type", "description", "properties", "confidence", "version", "created_at", "updated_at", "deleted_at"]
        return latest(df, *cols)
    if name == "e":
        return table(spark, d, "relations").select("id", "ontology_id", "source_entity", "target_entity", "type", "confidence", "created_at").distinct()
    return table(spark, d, {"r": "logic_rules", "a": "actions"}.get(name, name))
