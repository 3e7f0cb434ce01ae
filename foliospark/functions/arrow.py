"""Python workers: rows in small blocks in and out, and rows dealt to all tasks."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that go to a worker at once (a longer row makes a batch of its own), and rows that come back at once.
BATCH_BYTES, BATCH_ROWS = 1 << 21, 1 << 13
#: Rows made Python objects at once.
STEP = 64


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of the session hold about BATCH_BYTES at most; a lower bound that is set stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt evenly, or by keys, to as many tasks as a shuffle has: small rows that are much work in Python may all be in one
    file's part, and Spark joins small parts of a shuffle."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def objects(column: pa.Array) -> list:
    """What to_pylist gives; lists and structs are put together from their parts, each part made Python objects at once."""
    kind = column.type
    if not (pa.types.is_list(kind) or pa.types.is_struct(kind)):
        return column.to_pylist()
    if pa.types.is_list(kind):
        items = objects(column.flatten())
        ends = list(itertools.accumulate(column.value_lengths().fill_null(0).to_pylist(), initial=0))
        made = [items[a:b] for a, b in itertools.pairwise(ends)]
    else:
        names = [f.name for f in kind]
        made = [dict(zip(names, row, strict=True)) for row in zip(*map(objects, column.flatten()), strict=True)] if names else [{} for _ in range(len(column))]
    return [x if y else None for x, y in zip(made, column.is_valid().to_pylist(), strict=True)] if column.null_count else made


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """The rows of batches as tuples of Python objects, a few at a time; a map is a list of pairs, a struct a dict."""
    for batch in batches:
        step = max(1, min(STEP, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield from zip(*[objects(part.column(c)) for c in columns], strict=True)


def length(value) -> int:
    """Characters or bytes of a value and of all that is in it; a number counts eight."""
    if isinstance(value, str | bytes):
        return len(value)
    if isinstance(value, dict):
        value = value.values()
    elif not isinstance(value, list | tuple):
        return 8
    return sum(map(length, value))


def batched(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of BATCH_ROWS at most, and of about BATCH_BYTES of text, that in lists, maps and structs
    included (a longer row makes a batch of its own)."""
    texts = [i for i, f in enumerate(schema) if pa.types.is_string(f.type) or pa.types.is_binary(f.type)]
    nested = [i for i, f in enumerate(schema) if pa.types.is_nested(f.type)]
    held, size = [], 0
    for row in rows:
        own = sum(len(row[i]) for i in texts if row[i]) + sum(length(row[i]) for i in nested if row[i])
        if held and size + own > BATCH_BYTES:
            yield packed(held, schema)
            held, size = [], 0
        held.append(row)
        size += own
        if len(held) == BATCH_ROWS:
            yield packed(held, schema)
            held, size = [], 0
    if held:
        yield packed(held, schema)


def packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
