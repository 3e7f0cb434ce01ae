"""Colour keys: codecs, allocation of unused colours, and joins of tokens and shapes with annotations."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Levels a channel of figure colours has, and so the most figures of a document.
LEVELS = 11


def hex_key(n: Column) -> Column:
    return F.concat(F.lit("#"), F.lower(F.lpad(F.hex(n.cast("long")), 6, "0")))


def hex_channels(key: Column) -> Column:
    part = lambda i: F.conv(F.substring(key, 2 + 2 * i, 2), 16, 10).cast("int")
    return F.array(part(0), part(1), part(2))


def figure_key(n: Column, legacy: bool = False) -> Column:
    """The n-th figure colour, a digit 0 to 10 a channel; legacy writes 10 as 1 rather than 1.0."""
    digit = lambda d: F.when(d == LEVELS - 1, "1" if legacy else "1.0").otherwise(F.concat(F.lit("0."), d.cast("string")))
    n = n.cast("long")
    square = LEVELS * LEVELS
    return F.concat_ws(",", digit(F.floor(n / square)), digit(F.floor((n % square) / LEVELS)), digit(n % LEVELS))


def channel_key(x: Column) -> Column:
    """How a colour that was read is written: three components, cut to one digit."""
    part = lambda v: F.when(v == 1, "1.0").when((v >= 0) & (v < 1), F.concat(F.lit("0."), F.floor(v * 10).cast("string")))
    parts = [part(F.get(x, F.lit(i))) for i in range(3)]
    whole = F.size(x) == 3
    for p in parts:
        whole = whole & p.isNotNull()
    return F.when(whole, F.concat_ws(",", *parts))


def page_color(x: Column) -> Column:
    """#rrggbb of a colour array; black if it has no three components in 0 to 1."""
    good = x.isNotNull() & (F.size(x) >= 3) & F.forall(x, lambda v: (v >= 0) & (v <= 1))
    byte = lambda i: F.lower(F.lpad(F.hex(F.bround(F.get(x, F.lit(i)) * 255).cast("long")), 2, "0"))
    return F.when(good, F.concat(F.lit("#"), byte(0), byte(1), byte(2))).otherwise("#000000")


def palette(spark: SparkSession, hues: int = 359, levels: range = range(256, 50, -1), stride: int = 5) -> DataFrame:
    """ord, color: distinct colours of a rainbow, hues interleaved by `stride`, in order of their first candidate."""
    shades = len(levels)
    n = spark.range(hues * shades * shades)
    c = n.select(
        F.col("id"), F.floor(F.col("id") / (shades * shades)).alias("k"),
        ((F.lit(levels[0]) - F.floor(F.col("id") / shades) % shades) / 256).alias("s"), ((F.lit(levels[0]) - F.col("id") % shades) / 256).alias("v"),
    )
    # the k-th hue when they are taken 0, stride, 2*stride, ... then 1, 1+stride, ...
    order = [i for first in range(stride) for i in range(first, hues, stride)]
    h = F.element_at(F.array(*[F.lit(i) for i in order]), (F.col("k") + 1).cast("int")) / hues * 6
    c = c.withColumn("i", F.floor(h)).withColumn("f", h - F.floor(h))
    p, q, t = F.col("v") * (1 - F.col("s")), F.col("v") * (1 - F.col("s") * F.col("f")), F.col("v") * (1 - F.col("s") * (1 - F.col("f")))
    v, i = F.col("v"), F.col("i") % 6
    pick = lambda *cs: F.element_at(F.array(*cs), (i + 1).cast("int"))
    byte = lambda x: F.least(F.lit(255), F.floor(x * 255)).cast("long")
    rgb = byte(pick(v, q, p, p, t, v)) * 65536 + byte(pick(t, v, v, q, p, p)) * 256 + byte(pick(p, p, t, v, v, q))
    return c.select("id", rgb.alias("color")).groupBy("color").agg(F.min("id").alias("ord")).select("ord", "color")


def allocate(items: DataFrame, colors: DataFrame, existing: DataFrame) -> DataFrame:
    """Colour n of a document's unused ones for its n-th item. items: doc_id, n; colors: ord, color; existing: doc_id, color.

    A colour's rank among the unused ones is its order less the used ones before it, so only used
    colours are sorted within a document and the palette is never repeated for each document.
    An item for which no colour is left fails the query.
    """
    used = existing.join(colors, "color").select("doc_id", "ord").distinct()
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")) - 1
    gaps = used.withColumn("free", F.col("ord") - rank).groupBy("doc_id").agg(F.sort_array(F.collect_list("free")).alias("free"))
    at = items.join(gaps, "doc_id", "left").withColumn("ord", F.col("n") + F.coalesce(F.size(F.filter("free", lambda f: f <= F.col("n"))), F.lit(0)))
    given = F.coalesce("color", F.raise_error(F.concat(F.lit("no colour left for item "), F.col("n").cast("string"))).cast(colors.schema["color"].dataType))
    return at.join(colors, "ord", "left").select("doc_id", "n", given.alias("color"))


def needed(items: DataFrame, existing: DataFrame) -> int:
    """The colours that a palette must have for every document's items, whichever of them are used already."""
    most = lambda df: df.groupBy("doc_id").count().agg(F.max("count")).first()[0] or 0
    return most(items) + most(existing.select("doc_id", "color").distinct())


def annotate(tokens: DataFrame, annotations: DataFrame, existing: DataFrame) -> DataFrame:
    """Tokens left-joined with their annotation; a colour that the author used counts as none."""
    own = annotations.join(existing, ["doc_id", "color_key"], "left_anti")
    joined = tokens.join(own, ["doc_id", "color_key"], "left")
    return joined.withColumns({"reading": F.coalesce("reading", F.lit(-1)), "section": F.coalesce("section", F.lit(-1)), "block": F.coalesce("block", F.lit(-1)), "tex": F.coalesce("tex", F.lit(""))})


def annotate_shapes(shapes: DataFrame, annotations: DataFrame, offsets: DataFrame) -> DataFrame:
    """Shapes that have an annotation; their reading order follows the document's final diffusion offset."""
    return shapes.join(annotations, ["doc_id", "color_key"]).join(offsets, "doc_id", "left").withColumn("reading", F.col("reading") + F.coalesce("offset", F.lit(0)))


def standardized(annotations: DataFrame, fresh: DataFrame) -> DataFrame:
    """tex replaced where a standardised text of that colour exists."""
    return annotations.join(fresh.withColumnRenamed("tex", "new_tex"), ["doc_id", "color_key"], "left").withColumn("tex", F.coalesce("new_tex", "tex")).drop("new_tex")


def paint(rows: DataFrame, colors: DataFrame, black: str = "#000000") -> DataFrame:
    """Rows with the colour of their label (label, color; a row for each label), black where it has none."""
    return rows.join(colors, "label", "left").withColumn("color", F.coalesce("color", F.lit(black)))


def colored_text(word: Column, key: Column) -> Column:
    """TeX that sets a word in the colour #rrggbb."""
    return F.concat(F.lit(r"{\color[RGB]{"), F.array_join(hex_channels(key), ", "), F.lit("}"), word, F.lit("}"))


def batch(annotations: DataFrame) -> DataFrame:
    r"""doc_id, tex: a \section named by colour for every equation and table, in reading order."""
    part = F.struct("reading", "color_key", F.concat(F.lit("\\section{"), F.substring("color_key", 2, 6), F.lit("}\n"), F.col("tex"), F.lit("\n")).alias("t"))
    live = annotations.where(F.col("label").isin("Equation", "Table"))
    return live.groupBy("doc_id").agg(F.array_sort(F.collect_list(part)).alias("parts")).select("doc_id", F.array_join(F.transform("parts", lambda p: p["t"]), "").alias("tex"))


def split_batch(batches: DataFrame) -> DataFrame:
    r"""doc_id, color_key, tex of every section of a batch."""
    each = batches.select("doc_id", F.explode(F.regexp_extract_all("tex", F.lit(r"(?s)(\\section\{[0-9a-f]{6}\}\n.*?)(?=\\section\{[0-9a-f]{6}\}\n|\z)"), F.lit(1))).alias("s"))
    return each.select("doc_id", F.concat(F.lit("#"), F.substring("s", 10, 6)).alias("color_key"), F.regexp_replace(F.expr("substring(s, 18)"), r"\n\z", "").alias("tex"))
