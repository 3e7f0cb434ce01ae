"""Lines, whitespace tokens and running numbers; every window is within one document.

Rows of one doc_id are one document to the windows; give rows that are documents of their own ids of their own.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def tokens(docs: DataFrame, pattern: str = r"\S+") -> DataFrame:
    """doc_id, line_no, col, text, pos: the tokens that a pattern finds (whitespace tokens) in document order, numbered within
    their row, without a shuffle."""
    word = lambda line, i: F.transform(F.regexp_extract_all(line, F.lit(pattern), F.lit(0)), lambda w, j: F.struct(i.alias("line_no"), j.alias("col"), w.alias("text")))
    found = docs.select("doc_id", F.posexplode(F.flatten(F.transform(F.split("text", "\n"), word))).alias("pos", "w"))
    return found.select("doc_id", "w.line_no", "w.col", "w.text", "pos")


def reading_numbers(labelled: DataFrame) -> DataFrame:
    """0-based number of every labelled row; null for the others."""
    order = Window.partitionBy("doc_id").orderBy("pos")
    return labelled.withColumn("raw", F.when(F.col("label").isNotNull(), F.count("label").over(order).cast("int") - 1))


def suppress_repeats(rows: DataFrame) -> DataFrame:
    """tex becomes empty where the row before has the same raw reading order."""
    before = F.lag("raw").over(Window.partitionBy("doc_id").orderBy("pos"))
    return rows.withColumn("tex", F.when(before == F.col("raw"), "").otherwise(F.col("tex")))


def section_numbers(rows: DataFrame) -> DataFrame:
    """section: how many headings (a boolean column) the document has up to the row, itself included."""
    order = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("section", F.count_if("heading").over(order).cast("int"))


def block_numbers(rows: DataFrame) -> DataFrame:
    """block: the sum of `breaks`, the number of block ends at a row, over all rows up to it."""
    order = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("block", F.sum(F.coalesce("breaks", F.lit(0))).over(order).cast("int"))


def list_numbers(items: DataFrame) -> DataFrame:
    """mark: an item's indent by level, and its number from 1 in an ordered list, else a star."""
    number = F.row_number().over(Window.partitionBy("doc_id", "list_no").orderBy("pos"))
    mark = F.when(F.col("numbered"), F.concat(number.cast("string"), F.lit(". "))).otherwise(F.lit("* "))
    return items.withColumn("mark", F.concat(F.repeat(F.lit("  "), F.col("level") - 1), mark))


def sample_page(rows: DataFrame, seed: int = 0) -> DataFrame:
    """Rows of one page, picked by a hash of document, page and seed."""
    name = F.concat_ws(":", "doc_id", "page_no", F.lit(str(seed)))
    one = rows.select("doc_id", "page_no").distinct().orderBy(F.md5(name.cast("binary")), "doc_id", "page_no").limit(1)
    return rows.join(F.broadcast(one), ["doc_id", "page_no"], "left_semi")


def pages_of(rows: DataFrame) -> DataFrame:
    """doc_id, pages: the sorted page numbers that a document has rows on."""
    return rows.groupBy("doc_id").agg(F.array_sort(F.collect_set("page_no")).alias("pages"))
