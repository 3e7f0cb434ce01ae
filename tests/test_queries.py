"""Every query against its SQL, the sequential rules against the closed forms, and sources on written files."""

import gzip
import io
import json
import math
import os
import random
import tarfile

import pytest

from foliospark.functions import html, latex
from foliospark.operators import color, diffuse, logs, toc, tokens
from foliospark.plans import catalogue, samples
from foliospark.sources import archives, files
from foliospark.streaming import resume

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"


def normal(frame):
    def cell(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return "None"
        return repr(float(x)) if isinstance(x, float) else str(int(x)) if hasattr(x, "__int__") and not isinstance(x, (str, bool, bytes)) else str(x)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(cell, r)) for r in frame[columns].itertuples(index=False, name=None))


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA).toPandas()
    if name in catalogue.ORACLES:
        assert normal(got) == normal(duck.sql(catalogue.ORACLES[name]).df())
    else:
        assert len(got)


def test_spread_rule(spark):
    rows = [(1, 0, 0, "A", 0, 0), (1, 0, 1, None, None, None), (1, 0, 2, "B", 1, 1), (1, 0, 3, None, None, None), (1, 1, 4, None, None, None)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "doc_id long, line_no int, pos int, label string, raw int, block int, text string")
    exact = {r["pos"]: r for r in diffuse.spread_exact(df).collect()}
    assert [exact[i]["reading_order"] for i in range(5)] == [0, 1, 2, 3, -1]
    assert [exact[i]["label"] for i in range(5)] == ["A", "A", "B", "B", None]
    rng, many = random.Random(2), []
    for doc in range(40):
        raw = 0
        for pos in range(rng.randint(1, 90)):
            label = rng.choice([None, None, None, None, "A", "B"]) if rng.random() < 0.7 else None
            many.append((doc, rng.randint(0, 3), pos, label, raw if label else None, rng.randint(0, 9) if label else None, "t"))
            raw += label is not None
    df = spark.createDataFrame(many, df.schema)
    fold = {(r["doc_id"], r["pos"]): (r["reading_order"], r["block_id"]) for r in diffuse.spread_exact(df).collect()}
    assert fold == {(r["doc_id"], r["pos"]): (r["reading_order"], r["block_id"]) for r in diffuse.spread(df).collect()}


def test_log_fixtures(spark):
    text = "one\n! Undefined control sequence.\nl.1 a\n  b\n? \n! Emergency stop.\nl.1 a\n  b\nNo pages of output.\n"
    found = logs.errors(tokens.lines(spark.createDataFrame([(1, text)], "doc_id long, text string")), 3).orderBy("line_no").collect()
    assert len(found) == 2 and all(len(r["error"].split("\n")) == 3 for r in found) and found[1]["error"].startswith("! Emergency stop.")
    got = {r["doc_id"]: r["failed"] for r in logs.failed(samples.logs(spark), "hpdflatex").collect()}
    assert got == {1: False, 3: False}


def test_color_codecs(spark):
    df = spark.createDataFrame([([0.5, 0.25, 1.0],), ([1.0, 0.0],), (None,), ([2.0, 0.0, 0.0],)], "c array<double>")
    assert [r[0] for r in df.select(color.channel_key(df["c"])).collect()] == ["0.5,0.2,1.0", None, None, None]
    assert [r[0] for r in df.select(color.page_color(df["c"])).collect()] == ["#8040ff", "#000000", "#000000", "#000000"]


def test_toc(spark):
    df = spark.createDataFrame([(1, i, lv) for i, lv in enumerate([0, 3, 4, 3])], "doc_id long, pos int, level int")
    got = sorted((r["section_id"], r["nested_to"]) for r in toc.with_root(toc.edges(df)).collect())
    assert got == [(0, -1), (1, 0), (2, 1), (3, 2), (4, 1)]


def test_walker():
    w = latex.Walker()
    w.walk(samples.DOCUMENT, 0, len(samples.DOCUMENT), None)
    found = [(samples.DOCUMENT[a:b], label, section) for a, b, _, _, label, section, _, _ in w.rows]
    assert ("First", "Section", 2) in found and ("$x+y$", "Equation", 2) in found and ("Short", "Abstract", 1) in found
    assert any(x[1] == "Figure" for x in found) and ("figure.", "Caption", 2) in found and ("one", "List", 3) in found


def test_html_tree():
    rows = html.parse("<p>a<b>b</b><p>c<ul><li>x<li>y</ul>")
    assert [r[3] for r in rows if r[1] == 0] == ["p", "p"] and sum(r[3] == "li" for r in rows) == 2
    assert html.markdown(html.parse("<h1>T</h1><p>a <b>b</b></p><ol><li>x</li><li>y</li></ol>")).startswith("# T\n\na **b**")


def archive(members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as tar:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return out.getvalue()


def test_archives_and_resume(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.gz").write_bytes(archive({"main.tex": b"x", "../evil.tex": b"no", "d/b.sty": "é".encode("latin-1")}))
    (folder / "b.gz").write_bytes(gzip.compress(b"one file"))
    (folder / "c.gz").write_bytes(b"%PDF")
    got = {(r["doc_id"], r["member"], r["kind"]) for r in archives.unpack(archives.scan(spark, str(folder))).collect()}
    assert got == {("a", "main.tex", "tar"), ("a", "d/b.sty", "tar"), ("b", "main.tex", "gz"), ("c", "file.pdf", "pdf")}
    texts = archives.unpack(archives.scan(spark, str(folder))).where("member = 'd/b.sty'").select(archives.decode(archives.F.col("content")).alias("t")).first()
    assert texts["t"] == "é"
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    work = lambda df: df.select("path", "length")
    for n in (3, 3, 4):
        if n == 4:
            (folder / "d.gz").write_bytes(b"new")
        resume.process(resume.archives(spark, str(folder)), work, out, check).awaitTermination()
        assert spark.read.parquet(out).count() == n


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("d", 0, 1, "Title", 0, 0, "t", 1, 0.0, 0.0, 1.0, 1.0, "f", 9.0, ["bold"], "", [1.0, 2.0], 0)], catalogue.files.schemas.DATA)
    files.write_tsv(rows, str(tmp_path / "t"))
    assert files.read_tsv(spark, str(tmp_path / "t")).collect() == rows.collect()
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "1.tar_1401.0001_3.txt").write_text("word\t1\t2\t3\t4\t0\t0\t0\tfont\tparagraph\n")
    gold = files.read_gold(spark, str(tmp_path / "g")).first()
    assert (gold["doc_id"], gold["page_no"], gold["label"]) == ("1.tar_1401.0001", 4, "paragraph")
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "amsmath.json").write_text(json.dumps({"includes": ["amstext"], "cmds": {"frac{a}{b}": None}, "envs": {}}))
    assert files.read_packages(spark, str(tmp_path / "p")).first()["package"] == "amsmath"
