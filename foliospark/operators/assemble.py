"""Section texts from rows in reading order."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def sections(rows: DataFrame) -> DataFrame:
    """doc_id, segment, text: a segment begins where section_id exceeds all before it; figures open segments but give no text."""
    ordered = Window.partitionBy("doc_id").orderBy("reading_order", "pos").rowsBetween(Window.unboundedPreceding, 0)
    live = rows.where("reading_order <> -1").withColumn("segment", F.greatest(F.lit(0), F.max("section_id").over(ordered)))
    part = F.when(~F.col("label").eqNullSafe(F.lit("Figure")), F.struct("reading_order", "pos", F.concat("text", F.lit(" ")).alias("t")))
    grouped = live.groupBy("doc_id", "segment").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return grouped.select("doc_id", "segment", F.array_join(F.transform("parts", lambda p: p["t"]), "").alias("text"))


def append_shapes(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """Token rows and shape rows as one table, columns by name; a shape's missing columns are null."""
    return rows.unionByName(shapes, allowMissingColumns=True)


def last_bodies(parts: DataFrame) -> DataFrame:
    """doc_id, key, body: of parts with equal keys (doc_id, key, pos, body) the last wins."""
    return parts.groupBy("doc_id", "key").agg(F.max_by("body", "pos").alias("body"))
