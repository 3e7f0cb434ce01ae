"""Texts kept in blocks that are never shuffled, and sorted tables in buckets.

A batch of documents is written once, as rows of about BLOCK bytes that hold the ids and texts of
neighbouring documents. A block's number is chosen such that Spark's own bucket hash puts it into the bucket
its task writes, so the table is bucketed by block without a shuffle. What is found out about
stretches of the texts later goes to the blocks by an ordinary join on that number, in which the
texts stay where they are.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import batch_of, blocks, partitions, scratch, utf8

#: Bytes of text in a block (a longer text makes a block of its own).
BLOCK = 1 << 17
#: Bits of a block's number: its place in the task below, then the task, then the batch.
PLACE, TASK = 24, 20
COLUMNS = "blk long, ids array<long>, texts array<binary>"


def spark_hash(keys: np.ndarray) -> np.ndarray:
    """Spark's hash() of longs (Murmur3 with seed 42), by which it deals out rows and buckets."""
    u = np.uint32

    def turn(x, r):
        return x << u(r) | x >> u(32 - r)

    k = keys.astype(np.int64).view(np.uint64)
    h = np.full(len(k), 42, u)
    for half in (k & np.uint64(0xFFFFFFFF), k >> np.uint64(32)):
        h ^= turn(half.astype(u) * u(0xCC9E2D51), 15) * u(0x1B873593)
        h = turn(h, 13) * u(5) + u(0xE6546B64)
    h ^= u(8)
    h = (h ^ h >> u(16)) * u(0x85EBCA6B)
    h = (h ^ h >> u(13)) * u(0xC2B2AE35)
    return (h ^ h >> u(16)).view(np.int32)


def numbers(batch: int, task: int, buckets: int):
    """Numbers of blocks that belong into bucket `task` modulo buckets."""
    if task >= 1 << TASK:
        raise ValueError(f"more than {1 << TASK} tasks write texts")
    base = (batch << TASK | task) << PLACE
    for first in range(0, 1 << PLACE, 4096):
        tried = np.arange(base + first, base + first + 4096, dtype=np.int64)
        yield from tried[spark_hash(tried).astype(np.int64) % buckets == task % buckets].tolist()
    raise ValueError("too many blocks in one task")


def bucketed(df: DataFrame, buckets: int, keys: tuple[str, ...], path: str, order: bool = True) -> DataFrame:
    """df as a table at path, in buckets by its keys and sorted by them."""
    name = f"llm_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", path).bucketBy(buckets, *keys)
    (writer.sortBy(*keys) if order else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def opened(spark: SparkSession, schema: str, buckets: int, keys: tuple[str, ...], path: str, order: bool = True) -> DataFrame:
    """A table that bucketed() has written, maybe in another session."""
    name = f"llm_{uuid.uuid4().hex}"
    by = ", ".join(keys)
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) {f'SORTED BY ({by})' if order else ''} INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def store(docs: DataFrame, batch: int = 0, path: str | None = None) -> DataFrame:
    """blk, ids, texts: doc_id (long) and UTF-8 text of all rows of docs, in blocks."""
    buckets = partitions(docs.sparkSession)
    schema = pa.schema([("blk", pa.int64()), ("ids", pa.list_(pa.int64())), ("texts", pa.list_(pa.binary()))])

    def pack(batches):
        number = numbers(batch, TaskContext.get().partitionId(), buckets)
        for part in batches:
            ids, texts = part.column("doc_id"), part.column("text").cast(pa.binary())
            off = utf8(part.column("text"))[1]
            for a, b in blocks(off, BLOCK):
                edge = pa.array([0, b - a], pa.int32())
                lists = [pa.ListArray.from_arrays(edge, x.slice(a, b - a)) for x in (ids, texts)]
                yield batch_of(schema, [[next(number)], *lists])

    packed = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, COLUMNS)
    return bucketed(packed, buckets, ("blk",), path or scratch(docs.sparkSession), order=False)


def in_blocks(batch: pa.RecordBatch):
    """(block number, ids, bytes, offsets) of each block of an Arrow batch."""
    ids, texts, number = batch.column("ids"), batch.column("texts"), batch.column("blk").to_pylist()
    for r, blk in enumerate(number):
        data, off = utf8(texts[r].values)
        yield blk, ids[r].values, data, off
