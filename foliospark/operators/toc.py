"""Section trees from heading levels."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Names of levels, 0 to 7.
LEVELS = ("title", "part", "chapter", "section", "subsection", "subsubsection", "paragraph", "subparagraph")


def edges(headings: DataFrame) -> DataFrame:
    """doc_id, section_id, level, nested_to for headings (doc_id, pos, level): the last heading of a smaller level, root 0 at worst."""
    order = Window.partitionBy("doc_id").orderBy("pos")
    numbered = headings.withColumn("section_id", F.row_number().over(order))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # the last id of each smaller level: greatest over them is the nearest
    last = [F.when(F.col("level") > lv, F.max(F.when(F.col("level") == lv, F.col("section_id"))).over(before)) for lv in range(len(LEVELS))]
    return numbered.select("doc_id", "section_id", "level", F.coalesce(F.greatest(*last), F.lit(0)).alias("nested_to"))


def with_root(tree: DataFrame) -> DataFrame:
    root = tree.select("doc_id").distinct().select("doc_id", F.lit(0).alias("section_id"), F.lit(-1).alias("nested_to"))
    return root.unionByName(tree.select("doc_id", "section_id", "nested_to"))


def paths(tree: DataFrame, deepest: int = len(LEVELS)) -> DataFrame:
    """The dotted path of every section. A section's level is above its parent's, so no path is longer than there are levels:
    one join a level, whatever the number of sections; `deepest` is for trees of other levels."""
    rows = tree.select("doc_id", "section_id", "nested_to", F.col("section_id").cast("string").alias("path"), F.lit(1).alias("depth"), F.col("nested_to").alias("up"))
    above = tree.select(F.col("doc_id").alias("a_doc"), F.col("section_id").alias("a_id"), F.col("nested_to").alias("a_up"))
    for _ in range(deepest - 1):
        rows = rows.join(above, (F.col("doc_id") == F.col("a_doc")) & (F.col("up") == F.col("a_id")), "left").select(
            "doc_id", "section_id", "nested_to", F.when(F.col("a_id").isNotNull(), F.concat(F.col("a_id").cast("string"), F.lit("."), "path")).otherwise(F.col("path")).alias("path"),
            (F.col("depth") + F.col("a_id").isNotNull().cast("int")).alias("depth"), F.coalesce("a_up", F.lit(0)).alias("up"),
        )
    return rows.select("doc_id", "section_id", "path", "depth")
