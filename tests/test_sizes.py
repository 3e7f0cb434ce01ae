"""Work that grows with its input: long texts and many files in passes over them, rows dealt to all tasks, workers' batches small."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliospark.functions import arrow, article, html, latex
from foliospark.plans import catalogue
from foliospark.sources import papers

DATA = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def paper(spark):
    rows = [(1, "m.tex", "\\documentclass{a}\\input{b}\\include{ no}"), (1, "b.tex", "\\input{c}\\input{b}"), (1, "c.latex", "x"), (1, "z.tex", "\\input{m}"), (2, "m.tex", None)]
    return spark.createDataFrame(rows, "doc_id long, member string, text string")


def test_paper_colored_without_substrings(spark):
    """A text is cut and painted in one pass: by substrings of a whole text for each word it took the square of its length."""
    docs = spark.createDataFrame([(1, "\\begin{document}" + "é b " * 60 + "\\includegraphics{f}\\end{document}"), (2, None)], "doc_id long, text string")
    rows = latex.parse_latex(docs).selectExpr("*", "CASE WHEN kind = 'figure' THEN '0.1,0.2,1.0' WHEN reading = 1 THEN '#0a00ff' END AS color_key")
    found = latex.colored_documents(docs, rows)
    assert "substr" not in plan(found).lower()
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    assert got[1] == "\\begin{document}é {\\color[RGB]{10, 0, 255}b} " + "é b " * 59 + "\\colorbox[rgb]{0.1,0.2,1.0}{\\includegraphics{f}}\\end{document}" and got[2] is None


def test_parse_latex_without_a_join(spark):
    found = catalogue.QUERIES["parse_latex"](spark, DATA)
    assert "Join" not in plan(found) and "Exchange" not in plan(found)


def test_parse_macros_dealt_to_all_tasks(spark):
    found = catalogue.QUERIES["parse_macros"](spark, DATA)
    assert "REPARTITION_BY_NUM" in plan(found) and found.select("reading").mapInArrow(lambda batches: (b.slice(0, 1) for b in batches if b.num_rows), "reading int").count() > 1


def dealt_by(frame) -> str:
    text = plan(frame)
    return text[text.rindex("REPARTITION_BY_NUM") - 60 :] if "REPARTITION_BY_NUM" in text else ""


def test_article_tables_make_html_behind_the_shuffle(spark):
    """One shuffle of an order's numbers, to a fixed number of tasks; the rows' HTML went through it before."""
    text = plan(catalogue.QUERIES["article_tables"](spark, DATA))
    assert text.count("Exchange") == 1 and "REPARTITION_BY_NUM" in text and "ltx_tr" not in text[text.rindex("REPARTITION_BY_NUM") :]


def test_plain_pages_as_the_parser_reads_them():
    for page in ("<!DOCTYPE html><p>a &amp; b<br><p class=\"x\">c</p><td a=\"1\"/>&", "<title>a</title><script>x<!-- c --></script>", "<script>x", "<a b='c'>d</a>", "a < b", "<li/><li>x<li>y", "<P A=\"&lt;\"></P\n>"):
        tree = html.Tree()
        tree.feed(page)
        tree.close()
        assert html.parse(page) == tree.rows and article.elements(page)
    assert html._fast("<p a=\"b\">c &amp; d</p>") is not None and html._fast("<script>a") is None


def test_article_markdown_dealt_to_all_tasks(spark):
    assert dealt_by(catalogue.QUERIES["article_markdown"](spark, DATA))


def test_expand_macros_dealt_to_all_tasks(spark):
    assert dealt_by(catalogue.QUERIES["expand_macros"](spark, DATA))


def test_article_nodes_dealt_to_all_tasks(spark):
    assert dealt_by(catalogue.QUERIES["article_nodes"](spark, DATA))


def test_html_nodes_dealt_to_all_tasks(spark):
    assert dealt_by(catalogue.QUERIES["html_nodes"](spark, DATA))


def test_brace_balance_gets_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 26))
    catalogue.QUERIES["brace_balance"](spark, DATA)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == 1 << 21


def test_parse_html_in_small_blocks(spark):
    pages = spark.createDataFrame([(i, "<p>x</p>" * 40) for i in range(1000)], "page_id long, html string").coalesce(1)
    for made in (html.nodes(pages), article.nodes(pages)):
        sizes = [r["n"] for r in made.select("node").mapInArrow(lambda batches: (type(b).from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()]
        assert sum(sizes) == 81_000 and max(sizes) <= 10_000


def test_parse_html_of_long_texts_in_small_blocks(spark):
    """A block of few nodes with long texts has no more bytes than one of many short ones; one of 8,192 nodes had 400 MB here."""
    pages = spark.range(120).selectExpr("id AS page_id", "concat('<p>', repeat('x', 100000), '</p>') AS html").coalesce(1)
    sizes = html.nodes(pages).select("text").mapInArrow(lambda batches: (type(b).from_pydict({"n": [b.num_rows], "text": [sum(len(t) for t in b.column("text").to_pylist() if t)]}) for b in batches), "n long, text long").collect()
    assert sum(r["n"] for r in sizes) == 360 and sum(r["text"] for r in sizes) == 12_000_000
    made = list(arrow.batched(((i, "x" * 100_000) for i in range(120)), pa.schema([("page", pa.int64()), ("text", pa.string())])))
    assert sum(b.num_rows for b in made) == 120 and max(b.nbytes for b in made) < 1 << 22


def test_parse_article_of_a_long_text(spark):
    """A text that is longer than a block makes one of its own, between those of the others."""
    page = "<p class=\"ltx_p\">" + "y" * (3 << 20) + "</p>"
    found = article.nodes(spark.createDataFrame([(1, page), (2, "<p>a</p>"), (3, None)], "page_id long, html string").coalesce(1))
    assert sorted((r["page_id"], len(r["text"])) for r in found.collect() if r["text"]) == [(1, 3 << 20), (2, 1)]
    rows = [("y" * (3 << 20),), ("a",), (None,), ("b" * 10,)]
    assert [b.num_rows for b in arrow.batched(rows, pa.schema([("text", pa.string())]))] == [1, 3]


def test_parse_article_of_long_attributes_in_small_blocks(spark):
    """What attributes hold counts for a block as texts do; 120 links with targets of 100 KB were one block of 12 MB."""
    pages = spark.range(120).selectExpr("id AS page_id", """concat('<a href="', repeat('x', 100000), id, '">y</a>') AS html""").coalesce(1)
    found = article.nodes(pages).selectExpr("count(*)", "sum(length(attributes['target']))").first()
    assert tuple(found) == (360, 12_000_250)
    kinds = pa.schema([("map", pa.map_(pa.string(), pa.string())), ("list", pa.list_(pa.struct([("a", pa.string()), ("n", pa.int64())])))])
    long = "x" * 100_000
    for row in (([("a", long)], None), ([(long, None)], []), (None, [{"a": long, "n": 1}, None]), ([], [{"a": long, "n": None}])):
        made = list(arrow.batched([row] * 120, kinds))
        assert sum(b.num_rows for b in made) == 120 and max(b.nbytes for b in made) < 1 << 22
        assert made[0].to_pylist()[0] == dict(zip(("map", "list"), row, strict=True))


def test_long_tags_are_not_kept():
    """16,384 tags of any length were kept with their attributes, which grew with the input up to gigabytes."""
    long = "x" * 1000
    cases = ((html._tag, ("<p>",), (f'<a href="{long}">',)), (article.looks, ("p", "a"), ("p", f"ltx_p {long}")), (article._look, ("a", ""), ("ltx_align_justify", f"width:{long}")))
    for f, short, texts in cases:
        f(*short)
        before = f.cache_info().currsize
        assert f(*texts) == f(*texts) and f(*short) == f(*short) and f.cache_info().currsize == before
    assert [(r[3], r[4]) for r in article.elements(f'<a href="{long}">y</a>')] == [("article", {}), ("link", {"target": long}), ("text", {})]


def test_paper_files_in_one_shuffle(paper, spark):
    """Which file includes which is read once, a paper in a row; rounds of joins over all pairs of files took its place before."""
    assert plan(papers.reached(paper)).count("Exchange") == 1 and "Join" not in plan(papers.reached(paper))
    assert sorted(map(tuple, papers.reached(paper).collect())) == [(1, "b.tex"), (1, "c.latex"), (1, "m.tex")]


def test_files_of_a_paper_are_read_by_their_parts():
    """Lists of structs, with nulls and slices, as to_pylist has them, which takes them apart one by one."""
    files = [[{"member": "a", "names": ["x", None], "main": True}, None], None, [], [{"member": None, "names": None, "main": None}, {"member": "é", "names": [], "main": False}]]
    column = pa.array(files, pa.list_(pa.struct([("member", pa.string()), ("names", pa.list_(pa.string())), ("main", pa.bool_())])))
    for at in range(5):
        for n in range(5):
            assert arrow.objects(column.slice(at, n)) == files[at : at + n]
    assert [r for (r,) in arrow.rows_of([pa.record_batch([column], ["files"])], "files")] == files


def test_paper_includes_in_one_shuffle(paper, spark):
    found = papers.includes(paper)
    assert plan(found).count("Exchange") == 1 and "Join" not in plan(found)
    want = [(1, "b.tex", 0, "c", "c.latex"), (1, "b.tex", 1, "b", "b.tex"), (1, "m.tex", 0, "b", "b.tex"), (1, "m.tex", 1, "no", ""), (1, "z.tex", 0, "m", "m.tex")]
    assert sorted(map(tuple, found.collect())) == want


def test_papers_painted_without_a_shuffle_of_words(paper, spark, monkeypatch):
    docs = papers.ready(paper.withColumn("text", F.concat(F.lit("\\begin{document}a $x$ b c "), "text")))
    colors = spark.createDataFrame([(0, "#0a00ff"), (2, "#000001")], "reading int, color_key string")
    _, found = papers.annotated(docs, colors)
    got = sorted(map(tuple, found.collect()))
    assert "Join" not in plan(found) and len(got) == 1 and "color" in got[0][1]
    monkeypatch.setattr(papers, "HELD", 1)
    assert sorted(map(tuple, papers.annotated(docs, colors)[1].collect())) == got
