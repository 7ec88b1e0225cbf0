"""Graph operators over vertices (id, ontology_id, name_cn, type, ...) and edges (id, source_entity, target_entity, type, ...)."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.plans.durable import cut


def endpoints(edges: DataFrame) -> DataFrame:
    """(id) of every end of every edge, with repeats."""
    return edges.select(F.explode(F.array("source_entity", "target_entity")).alias("id")).filter("id is not null")


def isolated(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    return vertices.join(endpoints(edges), "id", "left_anti")


def orphan_edges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with an end that is null or no vertex."""
    v = vertices.select("id").distinct()
    s = v.select(F.col("id").alias("source_entity"), F.lit(True).alias("has_s"))
    t = v.select(F.col("id").alias("target_entity"), F.lit(True).alias("has_t"))
    return edges.join(s, "source_entity", "left").join(t, "target_entity", "left").filter("has_s is null or has_t is null").select(*edges.columns)


def inner_edges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges between vertices of the set."""
    v = vertices.select("id")
    return edges.join(v.withColumnRenamed("id", "source_entity"), "source_entity", "left_semi").join(v.withColumnRenamed("id", "target_entity"), "target_entity", "left_semi").select(*edges.columns)


def named_edges(vertices: DataFrame, edges: DataFrame, columns: tuple[str, ...] = ("name_cn",)) -> DataFrame:
    """Edges with the names of both ends, null where an end is no vertex."""
    out = edges
    for end in ("source", "target"):
        out = out.join(vertices.select(F.col("id").alias(f"{end}_entity"), *[F.col(c).alias(f"{end}_{c}") for c in columns]), f"{end}_entity", "left")
    return out


def degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, in_degree, out_degree, degree): distinct edges at each end and at either."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("source_entity").alias("id"), F.lit(1).alias("out")), F.struct(F.col("target_entity").alias("id"), F.lit(0).alias("out")))).alias("x"), F.col("id").alias("edge")).select("x.*", "edge")
    per = ends.groupBy("id", "edge").agg(F.max("out").alias("o"), F.max(1 - F.col("out")).alias("i")).groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"), F.count("*").alias("degree"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return vertices.select("id").join(per, "id", "left").select("id", *[zero(c) for c in ("in_degree", "out_degree", "degree")])


def top_connected(vertices: DataFrame, edges: DataFrame, k: int = 10) -> DataFrame:
    n = endpoints(edges).groupBy("id").agg(F.count("*").alias("degree"))
    return vertices.select("id", "name_cn").join(n, "id").orderBy(F.desc("degree"), "id").limit(k)


def undirected(edges: DataFrame) -> DataFrame:
    """(a, b) in both directions, once, without loops."""
    e = edges.filter("source_entity <> target_entity")
    return e.select(F.explode(F.array(F.struct(F.col("source_entity").alias("a"), F.col("target_entity").alias("b")), F.struct(F.col("target_entity").alias("a"), F.col("source_entity").alias("b")))).alias("x")).select("x.*").distinct()


def neighbourhood(edges: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """(id, hops) of everything within ``depth`` undirected steps of ``start`` (id); stops early where nothing new is found."""
    if depth < 1:
        raise ValueError("the depth must be at least 1")
    pairs = undirected(edges)
    seen = start.select("id").distinct().withColumn("hops", F.lit(0))
    frontier = seen
    for hop in range(1, depth + 1):
        step = pairs.join(frontier.select(F.col("id").alias("a")), "a").select(F.col("b").alias("id")).distinct().join(seen, "id", "left_anti").withColumn("hops", F.lit(hop))
        frontier = cut(step)
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def distances(edges: DataFrame, start: DataFrame, max_hops: int | None = None) -> DataFrame:
    """(id, hops, parent): breadth-first search from ``start`` (id); the parent is the smallest of the level before.

    Vertices further than ``max_hops`` away are an error; without it all that can be reached are found. A
    neighbour of a level is in that level, the one before or the one after, so only two levels are looked at.
    """
    pairs = cut(undirected(edges))
    frontier = start.select("id").distinct().select("id", F.lit(0).alias("hops"), F.lit(None).cast("string").alias("parent"))
    seen, before = frontier, None
    for hop in itertools.count(1):
        known = frontier.select(F.col("id").alias("b"))
        known = known if before is None else known.unionAll(before.select(F.col("id").alias("b")))
        step = pairs.join(frontier.select(F.col("id").alias("a")), "a").join(known, "b", "left_anti").groupBy(F.col("b").alias("id")).agg(F.min("a").alias("parent"))
        before, frontier = frontier, cut(step.select("id", F.lit(hop).alias("hops"), "parent"))
        if frontier.isEmpty():
            return seen
        if max_hops is not None and hop > max_hops:
            raise RuntimeError(f"there are vertices more than {max_hops} steps away")
        seen = seen.unionByName(frontier)
        if hop % 20 == 0:
            seen = cut(seen)  # else the plan grows with the length of the path


def shortest_path(edges: DataFrame, source: str, target: str, max_hops: int | None = None) -> list[str] | None:
    """The vertices of a shortest path, null where there is none."""
    spark = edges.sparkSession
    seen = distances(edges, spark.createDataFrame([(source,)], "id string"), max_hops)
    path, at = [], target
    while at is not None:
        row = seen.filter(F.col("id") == at).select("parent").first()
        if row is None:
            return None
        path.append(at)
        at = row.parent
    return path[::-1]


def quality(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: counts, isolated vertices, members of duplicated names, orphan edges, quality and density."""
    n = vertices.agg(F.count("*").alias("nodes"))
    m = edges.agg(F.count("*").alias("edges"))
    iso = isolated(vertices, edges).agg(F.count("*").alias("isolated"))
    dup = vertices.groupBy("name_cn").agg(F.count("*").alias("k")).filter("k > 1").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("duplicate_names"))
    orphan = orphan_edges(vertices, edges).agg(F.count("*").alias("orphans"))
    x = n
    for one in (m, iso, dup, orphan):
        x = x.crossJoin(F.broadcast(one))  # single rows
    share = lambda a, b, w: F.when(F.col(b) == 0, 0.0).otherwise(F.least(F.lit(w), F.col(a) / F.col(b) * w))
    q = F.greatest(F.lit(0.0), 1 - share("isolated", "nodes", 0.4) - share("duplicate_names", "nodes", 0.25) - share("orphans", "edges", 0.25))
    return x.select("*", F.round(q, 4).alias("quality"), F.round(F.when(F.col("nodes") == 0, 0.0).otherwise(F.col("edges") / F.col("nodes")), 4).alias("density"))


def sanitise(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices without null or repeated ids; edges without loops and dangling ends.

    Of repeated ids the row with the smallest text stays, so that the result is always the same.
    """
    text = F.to_json(F.struct("*"))
    first = lambda df: df.withColumn("__n", F.row_number().over(Window.partitionBy("id").orderBy(text))).filter("__n = 1").drop("__n")
    v = first(vertices.filter("id is not null"))
    return v, inner_edges(v, first(edges.filter("id is not null and source_entity <> target_entity")))


def decayed_weights(events: DataFrame, at: str, delta: str, now, keys: list[str], weekly: float = 0.95) -> DataFrame:
    """Edge weights: increments that lose 5 % a week."""
    weeks = F.datediff(F.lit(now).cast("date"), F.col(at).cast("date")) / 7
    return events.groupBy(*keys).agg(F.sum(F.col(delta) * F.pow(F.lit(weekly), weeks)).alias("weight"))


def co_occurrence(instances: DataFrame, subject: str, concept: str) -> DataFrame:
    """(a, b, together, share_of_a): subjects that have both concepts, and their share of those that have a.

    The subjects of a concept are distinct first; a subject's concepts are paired, which is the result asked for.
    """
    x = instances.select(F.col(subject).alias("s"), F.col(concept).alias("c")).distinct()
    total = x.groupBy("c").agg(F.count("*").alias("n"))
    pairs = x.withColumnRenamed("c", "a").join(x.withColumnRenamed("c", "b"), "s").filter("a <> b").groupBy("a", "b").agg(F.count("*").alias("together"))
    return pairs.join(total.withColumnRenamed("c", "a"), "a").select("a", "b", "together", (F.col("together") / F.col("n")).alias("share_of_a"))


def guarded_query(spark, text: str, views: dict[str, DataFrame], scope: str = "ontology_id") -> DataFrame:
    """A read-only query over temporary views, each of which it must filter by the scope.

    The parsed statement must be no command, and every view that the plan reads must lie below a filter
    that compares the scope column; comments and texts that only name it do not count.
    """
    logical = "org.apache.spark.sql.catalyst.plans.logical."
    parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    kind = lambda name: spark._jvm.java.lang.Class.forName(logical + name)
    if any(kind(k).isInstance(parsed) for k in ("Command", "ParsedStatement")):
        raise ValueError("only reading queries are allowed")
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    out = spark.sql(text)

    def unscoped(node, scoped: bool) -> bool:
        name = node.nodeName()
        if name == "Filter":
            refs = node.condition().references().toSeq()
            scoped |= any(refs.apply(i).name() == scope for i in range(refs.size()))
        if name == "SubqueryAlias" and node.alias() in views and not scoped:
            return True
        children = node.children()
        return any(unscoped(children.apply(i), scoped) for i in range(children.size()))

    if unscoped(out._jdf.queryExecution().analyzed(), False):
        raise ValueError(f"the query must be limited by {scope}")
    return out


#: Words of a question and the template they choose, with its row limit.
QUESTIONS = [("有哪些", "nodes", 50), ("所有节点", "nodes", 100), ("关系", "edges", 50)]


def ask(question: str, vertices: DataFrame, edges: DataFrame, translate=None) -> tuple[DataFrame, float]:
    """(answer, confidence) of a question by template, or by an injected translator that returns a DataFrame."""
    if translate is not None:
        answer = translate(question, vertices, edges)
        if answer is not None:
            return answer, 0.7
    for word, kind, limit in QUESTIONS:
        if word in question:
            return (vertices if kind == "nodes" else edges).orderBy("id").limit(limit), 0.5
    return vertices.orderBy("id").limit(50), 0.3
