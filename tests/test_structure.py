"""Grammar, papers of several files, renderings, trees, catalogues and archives on small cases."""

import gzip
import io
import random
import tarfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.functions import grammar, latex, rendering, textclean
from foliospark.operators import catalogues, evaluate, retrieve, spatial, tables, toc, tokens
from foliospark.plans import samples
from foliospark.sources import archives, files, papers


def walked(text, **more):
    w = latex.Walker(**more)
    w.walk(text, 0, len(text), "Paragraph")
    return [(text[r[0] : r[1]], r[4]) for r in w.rows]


def test_unknown_macros_keep_their_groups():
    assert walked(r"a \strange{no} % note" + "\n" + r"[nor] {this} b") == [("a", "Paragraph"), ("b", "Paragraph")]
    assert walked(r"\strange{x}") == [] and walked(r"\emph{x}y") == [("x", "Paragraph"), ("y", "Paragraph")]


def test_definitions_extend_the_grammar():
    assert walked(r"\mine{e} f") == [("f", "Paragraph")]
    assert walked(r"\newcommand{\mine}[2]{x}\mine{d}{e} {f}") == [("d", "Paragraph"), ("e", "Paragraph"), ("f", "Paragraph")]
    assert walked(r"\newenvironment{box}[1]{x}{y}\begin{box}{gone}in\end{box}") == [("in", "Paragraph")]
    assert walked(r"\packed{d}{e}", macros={"packed": "{"}) == [("d", "Paragraph"), ("e", "Paragraph")]
    assert walked(r"\section [s] {T}") == [("T", "Section")] and walked(r"\section*{T}") == [("T", "Section")]
    assert walked(r"a \vskip 3pt b \vskip\foo c") == [("a", "Paragraph"), ("b", "Paragraph"), ("c", "Paragraph")]
    assert walked(r"\begin{tabular}{ll}a&b\end{tabular}")[0] == ("a&b", "Table")


@pytest.mark.parametrize(("rows", "make"), [(samples.PACKAGES, textclean.split_packages), (samples.ENDS, textclean.single_end), (samples.ESCAPES, textclean.latex_escape), (samples.COMMENTS, textclean.strip_comments), (samples.BRACES, textclean.balance_braces), (samples.EXPANSIONS, latex.expand_macros)])
def test_text_functions(spark, rows, make):
    got = {r["text"]: r["r"] for r in samples.inputs(spark, rows).select("text", make(F.col("text")).alias("r")).collect()}
    assert got == dict(rows)


def test_math_synonyms(spark):
    got = {r["text"]: r["r"] for r in samples.inputs(spark, samples.MATH).select("text", textclean.normal_math(F.col("text"), True).alias("r")).collect()}
    assert got == dict(samples.MATH)
    pairs = [(f"${old}z$", f"\\({new}z\\)") for old, new in textclean.SYNONYMS]
    got = {r["text"]: r["r"] for r in samples.inputs(spark, pairs).select("text", textclean.normal_math(F.col("text"), True).alias("r")).collect()}
    assert got == dict(pairs) and len(pairs) == 32


def test_renderings():
    assert rendering.plain(r"\maketitle") == "[NO \\title GIVEN]\n    [NO \\author GIVEN]\n    [NO \\date GIVEN]\n" + "=" * 22 + "\n\n"
    assert rendering.plain(r"\title{On}\author{A}\date{B}\maketitle") == "On\n    A\n    B\n=====\n\n"
    assert rendering.plain(r"\chapter{one} \frac{\alpha}{2} \textbf{b}") == "\n\nCHAPTER: ONE\n α/2 b"


def test_roles_of_macros():
    assert walked(r"\ce{H2O} \lstinputlisting[x]{f.py}") == [(r"\ce{H2O}", "Equation"), (r"\lstinputlisting[x]{f.py}", "Equation")]
    assert walked(r"\titlearea{T}{A}") == [("T", "Title"), ("A", "Author")] and walked(r"\scalebox{0.5}{x}") == [("x", "Paragraph")]
    w = latex.Walker()
    text = r"\bibliography{refs} a \author[s]{N}"
    w.walk(text, 0, len(text), "Paragraph")
    assert [(r[3], r[4], r[5], r[6]) for r in w.rows] == [("bibliography", "Reference", 1, 0), (None, "Paragraph", 1, 1), (None, "Author", 1, 1)] and w.block == 2


def test_own_templates_and_parsers(spark):
    assert rendering.plain(r"\frac12 \unit{k}{g}", templates={"frac": "{1}:{2}", "unit": lambda groups, options: " ".join(groups)}, macros={"unit": "{{"}) == "1:2 k g"
    upper = rendering.renderer(templates={"emph": "{^1}"})
    assert spark.createDataFrame([(r"\emph{a}b",), (None,)], "t string").select(upper("t").alias("r")).collect() == [("Ab",), (None,)]

    def between(text, at, end):  # an argument between bars
        close = text.index("|", at + 1)
        return [("{", at + 1, close)], close + 1

    assert walked(r"\verbal|a b| c", parsers={"verbal": between}) == [("a", "Paragraph"), ("b", "Paragraph"), ("c", "Paragraph")]
    assert [r["text"] for r in tokens.tokens(spark.createDataFrame([(1, "a-b c")], "doc_id long, text string"), r"[a-z]").orderBy("pos").collect()] == ["a", "b", "c"]


def test_papers(spark):
    rows = [
        (1, "a.tex", "\\documentclass{x}\\input{b}\\include{ sub/c }\\input{nowhere}"), (1, "b.tex", "B\\input{a}\\input{c.tex}"), (1, "sub/c.latex", "C"), (1, "c.tex", "D\\input{c}"), (1, "z.tex", "\\documentclass{y}"),
        (2, "only.tex", "no class"), (3, "m.tex", None),
    ]
    members = spark.createDataFrame(rows, "doc_id long, member string, text string")
    assert [tuple(r) for r in papers.roots(members).collect()] == [(1, "z.tex")]  # a.tex is included, by b.tex
    first = members.where("member <> 'z.tex'")
    assert [tuple(r) for r in papers.roots(first).collect()] == [(1, "a.tex")]
    # what includes itself stays as it is
    assert papers.inlined(first).first()["text"] == "\\documentclass{x}B\\input{a}D\\input{c}C\\input{nowhere}"
    assert {r["member"] for r in papers.reached(first).collect()} == {"a.tex", "b.tex", "c.tex", "sub/c.latex"}
    assert papers.inlined(members.limit(0)).count() == 0


def test_annotated(spark):
    text = "\\documentclass{a}\\newcommand{\\k}{K}\\begin{document}one $x$ \\includegraphics{f} \\k\\end{document}"
    docs = papers.ready(spark.createDataFrame([(1, "m.tex", text), (2, "m.tex", "\\documentclass{a}\\begin{document}\\end{document}")], "doc_id long, member string, text string"))
    colors = spark.createDataFrame([(0, "#000001"), (1, "#000002"), (2, "0.1,0.2,0.3"), (3, "#000004")], "reading int, color_key string")
    _, got = papers.annotated(docs, colors)
    got = {r["doc_id"]: r["text"] for r in got.collect()}
    assert got[1] == "\\documentclass{a}\\newcommand{\\k}{K}\n\\begin{document}{\\color[RGB]{0, 0, 1}one} {\\color[RGB]{0, 0, 2}$x$} \\colorbox[rgb]{0.1,0.2,0.3}{\\includegraphics{f}} {\\color[RGB]{0, 0, 4}K}\\end{document}"
    assert got[2].endswith("\\begin{document}\\end{document}")


def test_paths_and_closures(spark):
    chain = spark.createDataFrame([(f"p{i}", f"p{i + 1}") for i in range(70)] + [("p70", "p3")], "package string, includes string")
    assert catalogues.closure(chain).where("root = 'p0'").count() == 71
    with pytest.raises(ValueError, match="chain"):
        catalogues.closure(chain, limit=5)
    tree = spark.createDataFrame([(1, i + 1, i) for i in range(8)] + [(2, 1, 0)], "doc_id long, section_id int, nested_to int")
    got = {(r["doc_id"], r["section_id"]): (r["path"], r["depth"]) for r in toc.paths(tree).collect()}
    assert got[1, 8] == ("1.2.3.4.5.6.7.8", 8) and got[2, 1] == ("1", 1) and len(got) == 9


def test_spans_by_block(spark):
    """The block comes first, then its line: the span that overlaps most may lie elsewhere."""
    box = "doc_id long, page_no int, {}x0 double, y0 double, x1 double, y1 double"
    token = spark.createDataFrame([(1, 1, 7, 0.0, 0.0, 10.0, 10.0)], box.format("pos int, "))
    spans = [(1, 1, 1, 1, 1, 0.0, 0.0, 4.0, 10.0), (1, 1, 1, 1, 2, 6.0, 0.0, 10.0, 10.0), (1, 1, 2, 1, 3, 0.0, 0.0, 9.0, 10.0)]
    got = spatial.best_span(token, spark.createDataFrame(spans, box.format("block_no int, line_no int, span_no int, "))).first()
    assert (got["span_no"], got["area"]) == (1, 40.0)  # the flat choice would be span 3


def test_rules_and_kappa(spark):
    cells = spark.createDataFrame([(1, 1, 1, 1, 1, "l", 2), (1, 1, 2, 1, 1, "l", 1), (1, 2, 1, 1, 1, "l", 1), (1, 2, 2, 1, 1, "l", 0)], "doc_id int, row_no int, cell_no int, colspan int, rowspan int, align string, border int")
    assert sorted(r["rule"] for r in tables.rules(cells).collect()) == ["\\cline{1-1}", "\\hline \\hline"]
    one = spark.createDataFrame([("a", "a")] * 3, "gold string, pred string")
    assert evaluate.kappa(one).first()["kappa"] is None and evaluate.kappa(one.limit(0)).first()["kappa"] is None


def test_tokens_need_no_shuffle(spark):
    found = tokens.tokens(spark.createDataFrame([(1, "a  b\n\nc"), (1, "d"), (2, None), (3, "")], "doc_id long, text string"))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in found.collect()) == [(1, 0, 0, "a", 0), (1, 0, 0, "d", 0), (1, 0, 1, "b", 1), (1, 2, 0, "c", 2)]


def test_nearest(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-2, 3, (300, 4)).astype(float)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, x[i].tolist()) for i in range(0, 300, 7)], "query_id long, query array<double>")
    size = np.sqrt((x * x).sum(1))
    u = x / np.where(size, size, 1)[:, None]
    want = set()
    for i in range(0, 300, 7):
        like = np.round(u @ u[i], 6)
        want |= {(i, int(j), float(like[j]) + 0.0) for j in np.lexsort((np.arange(300), -like))[:5]}
    for block in (1024, 10):
        got = {(r["query_id"], r["vec_id"], r["similarity"] + 0.0) for r in retrieve.top_k(vectors, queries, block=block).collect()}
        assert got == want
    assert retrieve.top_k(vectors, queries.limit(0)).count() == 0


def test_broken_archives(spark, tmp_path):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as tar:
        info = tarfile.TarInfo("a.tex")
        data = random.Random(1).randbytes(5000)
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))
    whole = out.getvalue()
    for blob in (whole[:200], whole[:-30], gzip.compress(b"x" * 99)[:-6], zlib.compress(b"y")):
        kinds = [m[1] for m in archives.open_archive(blob)]
        assert kinds == ["pdf"], kinds
    assert [m[:2] for m in archives.open_archive(whole)] == [("a.tex", "tar")]
    flipped = bytearray(gzip.compress(b"text" * 500))
    flipped[20] ^= 255
    assert [m[1] for m in archives.open_archive(bytes(flipped))] == ["pdf"]


def test_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name, text in (("a.tex", "A"), ("b.latex", "B\n"), ("c.txt", "C")):
        (tmp_path / "d" / name).write_text(text)
    assert sorted(tuple(r) for r in files.read_tex(spark, str(tmp_path / "d")).collect()) == [("a.tex", "A"), ("b.latex", "B\n")]
    (tmp_path / "e").mkdir()
    assert files.read_tex(spark, str(tmp_path / "e")).count() == 0
    rows = spark.createDataFrame([(f"d{i % 9}", i) for i in range(90)], "doc_id string, pos int")
    files.write_rows(rows, str(tmp_path / "rows"), buckets=4)
    assert sorted(map(tuple, files.read_rows(spark, str(tmp_path / "rows")).collect())) == sorted(map(tuple, rows.collect()))
    assert len([p for p in (tmp_path / "rows").iterdir() if p.is_dir()]) <= 4
    (tmp_path / "p.cwl").write_text("#include:q\n\\one{arg}[opt]#n\n\\begin{env}{x}\n\\end{env}\n# note\n")
    (tmp_path / "yathesis.cwl").write_text("\\two\n")
    (tmp_path / "expl3.cwl").write_text("\\three\n")
    got = {r["package"]: r for r in files.packages_of(files.read_completions(spark, str(tmp_path))).collect()}
    assert set(got) == {"p", "class-yathesis"} and got["p"]["includes"] == ["q"] and set(got["p"]["cmds"]) == {"one{}[]"} and set(got["p"]["envs"]) == {"env{}"}
    files.write_packages(files.packages_of(files.read_completions(spark, str(tmp_path))), str(tmp_path / "json"))


def test_grammar_of_packages(spark):
    found = grammar.loaded(spark.createDataFrame([(1, "\\documentclass[a4]{art}\\usepackage{x, y}\n\\RequirePackage [o] {z}")], "doc_id long, text string"))
    assert sorted(r["package"] for r in found.collect()) == ["class-art", "x", "y", "z"]
    base = {(r["kind"], r["name"]): r["args"] for r in grammar.base(spark).collect()}
    assert base["cmds", "frac"] == "{{" and base["envs", "tabular"] == "[{" and base["cmds", "section"] == "*[{"
    assert sorted(tuple(r) for r in catalogues.longest_arguments(samples.keys(spark)).collect()) == [("frac", "{{"), ("item", "["), ("sqrt", "[{")]


def test_decode(spark):
    texts = {"plain é ✓": ["utf-8", "utf-8-sig", "utf-16"], "café": ["latin-1", "utf-8"], "a “b”": ["cp1252"], "wide text": ["utf-16-le", "utf-16-be"], "": ["utf-8"]}
    rows = [(t.encode(e), t) for t, names in texts.items() for e in names] + [(None, None)]
    df = spark.createDataFrame([(bytearray(b) if b is not None else None, t) for b, t in rows], "c binary, t string")
    assert all(r[0] == r[1] for r in df.select(archives.decode(F.col("c")), "t").collect())
