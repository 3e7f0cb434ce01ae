"""Table cells: widths, column alignment, rules and row spans. Cells: doc_id, row_no, cell_no, colspan, rowspan, align, border."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def widths(cells: DataFrame) -> DataFrame:
    """Each cell with the columns it ends at, and its row's width."""
    row = Window.partitionBy("doc_id", "row_no")
    w = F.coalesce("colspan", F.lit(1))
    return cells.withColumn("ends", F.sum(w).over(row.orderBy("cell_no").rowsBetween(Window.unboundedPreceding, 0))).withColumn("width", F.sum(w).over(row))


def table_width(cells: DataFrame) -> DataFrame:
    rows = cells.groupBy("doc_id", "row_no").agg(F.sum(F.coalesce("colspan", F.lit(1))).alias("w"))
    return rows.groupBy("doc_id").agg(F.max("w").alias("width"))


def column_align(cells: DataFrame) -> DataFrame:
    """The most used alignment of each column among cells without spans, the first seen at a tie."""
    plain = widths(cells).where("coalesce(colspan, 1) = 1 AND align IS NOT NULL")
    counted = plain.groupBy("doc_id", F.col("ends").alias("col"), "align").agg(F.count("*").alias("n"), F.min("row_no").alias("first"))
    return counted.groupBy("doc_id", "col").agg(F.max_by("align", F.struct("n", -F.col("first"))).alias("align"))


def rules(cells: DataFrame) -> DataFrame:
    r"""Runs of columns with a border, by row. A run of all columns is as many \hline as the first column's border is wide."""
    at = widths(cells).select("doc_id", "row_no", "width", F.explode(F.sequence(F.col("ends") - F.coalesce("colspan", F.lit(1)) + 1, F.col("ends"))).alias("col"), "border")
    live = at.where("border > 0")
    run = F.col("col") - F.row_number().over(Window.partitionBy("doc_id", "row_no").orderBy("col"))
    runs = live.withColumn("run", run).groupBy("doc_id", "row_no", "width", "run").agg(F.min("col").alias("a"), F.max("col").alias("b"), F.min_by("border", "col").alias("wide"))
    whole = (F.col("a") == 1) & (F.col("b") == F.col("width"))
    lines = F.array_join(F.array_repeat(F.lit("\\hline"), F.col("wide").cast("int")), " ")
    return runs.select("doc_id", "row_no", F.when(whole, lines).otherwise(F.format_string("\\cline{%d-%d}", "a", "b")).alias("rule"))


def bars(cells: DataFrame) -> DataFrame:
    """doc_id, col, bars: a column's vertical rules, as many as its widest border (cells: border) among cells without spans."""
    plain = widths(cells).where("coalesce(colspan, 1) = 1")
    return plain.groupBy("doc_id", F.col("ends").alias("col")).agg(F.repeat(F.lit("|"), F.max("border").cast("int")).alias("bars"))


def square(cells: DataFrame) -> DataFrame:
    """Cells with the column they begin at (from 1), and the empty ones below cells of several rows, at the same column."""
    placed = widths(cells).withColumn("col", F.col("ends") - F.coalesce("colspan", F.lit(1)) + 1)
    below = placed.where("rowspan > 1").select("doc_id", "row_no", "cell_no", "col", F.explode(F.sequence(F.lit(1), F.col("rowspan") - 1)).alias("k"))
    below = below.select("doc_id", (F.col("row_no") + F.col("k")).alias("row_no"), "cell_no", "col", F.lit(True).alias("filler"))
    return placed.select("doc_id", "row_no", "cell_no", "col", F.lit(False).alias("filler")).unionByName(below)
