"""What the operators share: durable intermediates and Arrow text access."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once in a Python worker (a longer document makes a block of its own).
BLOCK_BYTES = 1 << 19
#: Bytes of rows that go to a Python worker at once in the pipeline (a longer row makes a batch of its own).
BATCH_BYTES = 1 << 21


def scratch(spark: SparkSession) -> str:
    """A new folder name under spark.checkpoint.dir; where that is unset, a temporary folder, in local mode only."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.gettempdir() + "/checkpoints"
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/llm-{uuid.uuid4().hex}"


def durable(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write df to the shared scratch folder and read it back: lineage ends, lost executors don't matter."""
    path = scratch(df.sparkSession)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slim(df: DataFrame) -> DataFrame:
    """durable() for what is left of far larger tables: by a quarter of the usual number of tasks, so in fewer files."""
    return durable(df.coalesce(max(1, partitions(df.sparkSession) // 4)))


def drop(*tables: DataFrame) -> None:
    """Delete the files behind tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of the session hold about BATCH_BYTES at most, not only 10,000 rows or 64 MB: a worker, and the JVM
    beside it, keep what their largest batch took. Rows and results are the same; a lower bound that is set stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def free(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have, whatever the case of letters."""
    have = {c.lower() for c in docs.columns}
    while name in have:
        name = "_" + name
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key of the row's own: rows that repeat an id with another text stay apart, nulls are allowed."""
    return F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit("")))


def held_out() -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fetched(rows: DataFrame, most_bytes: int) -> list:
    """Rows (with a text) in their order, until the texts hold more than most_bytes: a bound on what reaches the driver."""
    out, size = [], 0
    for row in rows.toLocalIterator():
        size += len(row["text"] or "")
        if out and size > most_bytes:
            break
        out.append(row)
    return out


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets, without building Python strings."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES):
    """Row ranges (first, last) whose texts hold about limit bytes together."""
    first, n = 0, len(off) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
