"""Agreement of labels with a gold standard."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def align(gold: DataFrame, found: DataFrame) -> DataFrame:
    """The k-th occurrence of a token on a page pairs with the k-th gold one, beyond their number with the first.

    Both: doc_id, page_no, text, pos, label."""
    key = ["doc_id", "page_no", "text"]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("pos"))
    # one row for each token text of a page, with the labels of its occurrences in order: no pairs are made
    g = gold.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "label"))).alias("all"))
    p = found.withColumn("rn", nth)
    at = F.when(F.col("rn") <= F.size("all"), F.col("rn")).otherwise(1)
    return p.join(g, key).select("doc_id", "page_no", "text", "pos", F.element_at("all", at)["label"].alias("gold"), F.col("label").alias("pred"))


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("gold", "pred").agg(F.count("*").alias("n"))


def kappa(pairs: DataFrame) -> DataFrame:
    """Agreement beyond chance; null where there are no pairs or one class alone, where it has no value."""
    c = confusion(pairs)
    total = c.agg(F.sum("n").alias("t"), F.sum(F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(0)).alias("agree"))
    g, p = c.groupBy(F.col("gold").alias("c")).agg(F.sum("n").alias("gn")), c.groupBy(F.col("pred").alias("c")).agg(F.sum("n").alias("pn"))
    chance = g.join(p, "c").agg(F.sum(F.col("gn") * F.col("pn")).alias("e"))
    po, pe = F.try_divide("agree", "t"), F.try_divide(F.coalesce("e", F.lit(0)), F.col("t") * F.col("t"))
    return total.join(F.broadcast(chance)).select(F.round(F.when(pe < 1, (po - pe) / (1 - pe)), 6).alias("kappa"))


def scores(pairs: DataFrame) -> DataFrame:
    """Precision, recall and F1 of every class in either column; 0 where undefined."""
    hit = F.col("gold") == F.col("pred")
    both = pairs.select(F.explode(F.array(F.struct(F.col("gold").alias("c"), hit.cast("int").alias("tp"), F.lit(1).alias("g"), F.lit(0).alias("p")), F.struct(F.col("pred").alias("c"), F.lit(0).alias("tp"), F.lit(0).alias("g"), F.lit(1).alias("p")))).alias("x")).select("x.*")
    s = both.groupBy(F.col("c").alias("label")).agg(F.sum("tp").alias("tp"), F.sum("g").alias("g"), F.sum("p").alias("p"))
    ratio = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(0.0), 6)
    tp, g, p = F.col("tp"), F.col("g"), F.col("p")
    return s.select("label", ratio(tp, p).alias("precision"), ratio(tp, g).alias("recall"), ratio(2 * tp, p + g).alias("f1"))


def encode(labels: DataFrame, column: str = "label") -> DataFrame:
    """Sorted distinct labels and their ordinals; labels are few."""
    return labels.select(column).distinct().select(column, (F.dense_rank().over(Window.orderBy(column)) - 1).alias("code"))


def rich_documents(rows: DataFrame, least: int = 3) -> DataFrame:
    """Documents with more than `least` different labels."""
    return rows.groupBy("doc_id").agg(F.countDistinct("label").alias("labels")).where(F.col("labels") > least)
