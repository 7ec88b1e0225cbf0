"""Keyword and vector search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def like_any(columns: list[Column], word: str) -> Column:
    """Whether any column holds the word, letter case aside; wildcards in it are plain characters."""
    plain = word.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(c.ilike(f"%{plain}%"), F.lit(False))
    return hit


def keyword(vertices: DataFrame, word: str) -> DataFrame:
    """(id, name, text): vertices whose names, description or properties hold a word."""
    cols = [F.col("name_cn"), F.col("name_en"), F.col("description"), F.to_json("properties")]
    return vertices.filter(like_any(cols, word)).select("id", F.col("name_cn").alias("name"), F.coalesce(F.nullif("description", F.lit("")), "name_cn").alias("text"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(vectors: DataFrame, key: str, vector: str, query: list[float], k: int = 5, where: Column | None = None) -> DataFrame:
    """(key, score): the k vectors with the largest cosine to a query; only the best of each partition are gathered."""
    src = vectors if where is None else vectors.filter(where)
    q = F.array(*[F.lit(float(x)) for x in query])
    return src.select(key, cosine(F.col(vector), q).alias("score")).orderBy(F.desc("score"), key).limit(k)


def nearest_of_all(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 5) -> DataFrame:
    """(query, key, score): for each query vector the k nearest; queries are read in blocks and scored against all vectors.

    ``queries`` is a stated set that is collected in blocks of bounded size.
    """
    import numpy as np
    import pyarrow as pa

    from tributary.plans.ship import ship

    ship(vectors)
    rows = queries.select(key, vector).collect()
    ids, mat = [r[0] for r in rows], np.array([r[1] for r in rows], np.float64).reshape(len(rows), -1)
    if not ids:
        return vectors.limit(0).select(F.col(key).alias("query"), key, F.lit(0.0).alias("score"))
    shared = vectors.sparkSession.sparkContext.broadcast((ids, mat / np.linalg.norm(mat, axis=1, keepdims=True)))
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches):
        names, unit = shared.value
        for b in batches:
            x = np.array(b.column(1).to_pylist(), np.float64)
            s = unit @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T
            top = np.argsort(-s, axis=1, kind="stable")[:, :k]
            own = np.array(b.column(0).to_pylist(), dtype=object)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(names, dtype=object), top.shape[1]).tolist(), b.schema.field(0).type), pa.array(own[top.ravel()].tolist(), b.schema.field(0).type), pa.array(np.take_along_axis(s, top, 1).ravel())], names=["query", "key", "score"])

    local = vectors.select(key, vector).mapInArrow(run, f"query {kind}, key {kind}, score double")
    best = local.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("d"), "key"))), 1, k).alias("x"))
    return best.select("query", F.explode("x").alias("x")).select("query", F.col("x.key").alias(key), (-F.col("x.d")).alias("score"))


def unified(vertices: DataFrame, word: str, vectors: DataFrame | None = None, query: list[float] | None = None, k: int = 20) -> DataFrame:
    """Vector search where there is a query vector, else keyword search."""
    if vectors is not None and query:
        return nearest(vectors, "id", "embedding", query, k)
    return keyword(vertices, word).select("id", F.lit(1.0).alias("score")).orderBy("id").limit(k)
