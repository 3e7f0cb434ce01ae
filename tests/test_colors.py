"""Palettes as large as the data needs, and the small palette apart."""

import colorsys

import pytest

from foliospark.operators import color
from foliospark.plans import catalogue


def test_hot_customer_loses_no_order(spark, tmp_path):
    n = 4500
    spark.range(n + 3).selectExpr("id AS o_orderkey", f"CASE WHEN id < {n} THEN 1L ELSE 2L END AS o_custkey").write.parquet(str(tmp_path / "orders.parquet"))
    got = catalogue.existing_color_anti(spark, str(tmp_path)).collect()
    used = {k % 23 * 17 for k in range(n) if k % 3 == 0}
    own = [r["color"] for r in sorted(got, key=lambda r: r["n"]) if r["doc_id"] == 1]
    assert len(got) == n + 3 and own == [c for c in range(0, 17 * (n + 23), 17) if c not in used][:n]


def test_exhausted_palette_fails(spark):
    items = spark.createDataFrame([(1, i) for i in range(4)], "doc_id long, n long")
    used = spark.createDataFrame([(1, 0)], "doc_id long, color long")
    colors = lambda n: spark.range(n).selectExpr("id AS ord", "id * 17 AS color")
    assert sorted(r["color"] for r in color.allocate(items, colors(color.needed(items, used)), used).collect()) == [17, 34, 51, 68]
    with pytest.raises(Exception, match="no colour left"):
        color.allocate(items, colors(4), used).collect()


def rainbow(hues, levels):
    order = [i for first in range(5) for i in range(first, hues, 5)]
    rows = {}
    for h in order:
        for s in levels:
            for v in levels:
                r, g, b = (min(255, int(x * 255)) for x in colorsys.hsv_to_rgb(h / hues, s / 256, v / 256))
                rows.setdefault(r * 65536 + g * 256 + b, len(rows))
    return list(rows)


def test_small_palette(spark):
    got = [r["color"] for r in color.palette(spark, 30, range(256, 236, -1)).orderBy("ord").collect()]
    assert got == rainbow(30, range(256, 236, -1))


def test_registered_palette_is_whole(spark):
    assert catalogue.palette(spark, "").count() == 9188930
