"""Exact cosine top-k of query vectors, in blocks of queries."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = 1024) -> DataFrame:
    """query_id, vec_id, similarity (6 digits) of the k nearest, of equal ones the least vec_id. queries (query_id, query) are a
    stated set: taken to the vectors in blocks of `block`, a matrix product for each; k rows a task and query are shuffled.

    A vector without length is like none: its similarity is 0."""
    out = None
    for part in blocks(queries, block):
        held = vectors.sparkSession.sparkContext.broadcast(part)  # at most `block` vectors
        near = vectors.select("vec_id", "embedding").mapInArrow(nearest(held, k), "query_id long, vec_id long, similarity double")
        out = near if out is None else out.unionByName(near)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, similarity double")
    order = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "vec_id")
    return out.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k).drop("rn")


def unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def blocks(queries: DataFrame, size: int):
    """(ids, unit vectors) of `size` queries at a time."""
    ids, rows = [], []
    for row in queries.select("query_id", "query").where("query IS NOT NULL").toLocalIterator():
        ids.append(row["query_id"])
        rows.append(row["query"])
        if len(ids) == size:
            yield np.array(ids, np.int64), unit(np.array(rows, np.float64))
            ids, rows = [], []
    if ids:
        yield np.array(ids, np.int64), unit(np.array(rows, np.float64))


def nearest(held, k: int, step: int = 1024):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("similarity", pa.float64())])

    def scan(batches):
        ids, matrix = held.value
        cut = np.full(len(ids), -np.inf)
        q, v, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("embedding")))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                found = part.column("embedding")
                x = unit(found.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), -1))
                like = np.round(x @ matrix.T, 6)
                row, col = np.nonzero(like >= cut)
                q, v, s = np.append(q, col), np.append(v, part.column("vec_id").to_numpy()[row]), np.append(s, like[row, col])
                order = np.lexsort((v, -s, q))
                q, v, s = q[order], v[order], s[order]
                first = np.searchsorted(q, q, "left")
                rank = np.arange(len(q)) - first
                keep = rank < k
                q, v, s, rank = q[keep], v[keep], s[keep], rank[keep]
                last = rank == k - 1
                cut[q[last]] = s[last]
        if len(q):
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(v), pa.array(s)], schema=schema)

    return scan
