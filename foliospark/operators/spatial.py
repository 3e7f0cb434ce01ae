"""Boxes: overlap of tokens with spans, lines that contain a token, and projections of page geometry."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

#: Bit, name if set, name if not (None: no name), in order.
FLAGS = ((1, "superscript", None), (2, "italic", None), (4, "serifed", "sans"), (8, "monospaced", "proportional"), (16, "bold", None))


def flags(n: Column) -> Column:
    parts = [F.when(n.bitwiseAND(F.lit(bit)) > 0, F.lit(yes)).otherwise(F.lit(no) if no else F.lit(None).cast("string")) for bit, yes, no in FLAGS]
    return F.array_compact(F.array(*parts))


def flip(height: Column, y1: Column, y0: Column) -> list[Column]:
    """Top-left y0 and y1 of a rectangle given from the bottom."""
    top = height - y1
    return [top.alias("y0"), (top + (y1 - y0)).alias("y1")]


def norm(x: Column, size: Column) -> Column:
    return F.least(F.lit(1000), F.greatest(F.lit(0), (x / size * 1000).cast("int")))


def _bins(y0: str, y1: str, height: float) -> Column:
    return F.explode(F.sequence(F.floor(F.col(y0) / height).cast("long"), F.floor(F.col(y1) / height).cast("long")))


def hull(of: WindowSpec, prefix: str) -> dict[str, Column]:
    """The box around all boxes of a window."""
    low = {f"{prefix}{c}": F.min(c).over(of) for c in ("x0", "y0")}
    return low | {f"{prefix}{c}": F.max(c).over(of) for c in ("x1", "y1")}


def shared(prefix: str) -> Column:
    """The area that the token's box (t_) has in common with another."""
    w = F.least("t_x1", f"{prefix}x1") - F.greatest("t_x0", f"{prefix}x0")
    h = F.least("t_y1", f"{prefix}y1") - F.greatest("t_y0", f"{prefix}y0")
    return F.when((w > 0) & (h > 0), w * h).otherwise(0.0)


def best_span(tokens: DataFrame, spans: DataFrame, band: float = 64.0) -> DataFrame:
    """Each token with its span: of the block that the token overlaps most the line that it overlaps most, of that the span;
    the first at a tie. spans: doc_id, page_no, block_no, line_no, span_no, box; a block or line is the box around its
    spans, and only blocks and lines of which a span overlaps the token count.

    Pages are cut in bands of `band` points: an equi-join of bands, then one aggregate; no page's pairs all meet."""
    t = tokens.select("doc_id", "page_no", "pos", *[F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "x1", "y1")]).withColumn("band", _bins("t_y0", "t_y1", band))
    block = Window.partitionBy("doc_id", "page_no", "block_no")
    line = Window.partitionBy("doc_id", "page_no", "block_no", "line_no")
    s = spans.withColumns(hull(block, "b_") | hull(line, "l_")).withColumn("band", _bins("y0", "y1", band))
    areas = {"in_block": shared("b_"), "in_line": shared("l_"), "area": shared("")}
    hit = t.join(s, ["doc_id", "page_no", "band"]).withColumns(areas).where("area > 0")
    order = F.struct("in_block", -F.col("block_no"), "in_line", -F.col("line_no"), "area", (-F.col("span_no")).alias("first"))
    best = hit.groupBy("doc_id", "page_no", "pos").agg(F.max(order).alias("m"))
    return best.select("doc_id", "page_no", "pos", (-F.col("m.first")).alias("span_no"), F.round("m.area", 4).alias("area"))


def containing_line(tokens: DataFrame, lines: DataFrame, band: float = 64.0) -> DataFrame:
    """The last line whose half-open box holds the token's midpoint."""
    t = tokens.withColumn("mx", (F.col("x0") + F.col("x1")) / 2).withColumn("my", (F.col("y0") + F.col("y1")) / 2).withColumn("band", F.floor(F.col("my") / band).cast("long"))
    s = lines.select("doc_id", "page_no", "line_no", *[F.col(c).alias(f"s_{c}") for c in ("x0", "y0", "x1", "y1")]).withColumn("band", _bins("s_y0", "s_y1", band))
    inside = (F.col("mx") >= F.col("s_x0")) & (F.col("mx") < F.col("s_x1")) & (F.col("my") >= F.col("s_y0")) & (F.col("my") < F.col("s_y1"))
    return t.join(s, ["doc_id", "page_no", "band"]).where(inside).groupBy("doc_id", "page_no", "pos").agg(F.max("line_no").alias("line_no"))
