r"""Queries of the TeX, HTML and log operators over whole tables.

The tables have no TeX, so each query writes some from the rows of a table (from documents, parts,
orders, line items), and its SQL says from the same rows what must come out, not how it is found.
"""

from __future__ import annotations

import gzip
import io
import tarfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import arrow, article, grammar, html, latex, rendering, symbols, textclean
from foliospark.operators import catalogues, color, labels, logs
from foliospark.plans.registry import query, table
from foliospark.sources import archives, files, papers


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _pick(key: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _sql_pick(key: str, values) -> str:
    return f"[{', '.join('NULL' if v is None else _q(v) for v in values)}][{key} % {len(values)} + 1]"


# -- names

_STEMS = ("title", "author", "institute", "abstract", "keywords", "footnote", "thanks", "caption", "section", "chapter", "part", "textbf", "address", "affiliation", "emph", "mycaption")
_NAME = f"CASE p_size % 3 WHEN 0 THEN 'short' WHEN 1 THEN 'sub' ELSE '' END || {_sql_pick('p_partkey', _STEMS)}"


def _name() -> Column:
    return F.concat(F.when(F.col("p_size") % 3 == 0, "short").when(F.col("p_size") % 3 == 1, "sub").otherwise(""), _pick(F.col("p_partkey"), _STEMS))


@query(f"""SELECT p_partkey AS id, CASE WHEN contains(n,'title') AND NOT contains(n,'short') THEN 'Title' WHEN (contains(n,'author') OR contains(n,'address') OR contains(n,'institut') OR contains(n,'affiliat')) AND NOT contains(n,'short') THEN 'Author'
 WHEN contains(n,'abstract') OR contains(n,'keyword') THEN 'Abstract' WHEN contains(n,'footnote') OR contains(n,'thanks') THEN 'Footer' WHEN n = 'caption' THEN 'Caption' WHEN contains(n,'section') OR n IN ('chapter','part') THEN 'Section' ELSE p_brand END AS label
 FROM (SELECT *, {_NAME} AS n FROM part)""")
def label_by_macro(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), labels.by_macro(_name(), F.col("p_brand")).alias("label"))


_KINDS = ("align", "thebibliography", "tikzpicture", "tabular", "algorithm", "itemize", "proof", "longtable", "abstract", "forest")


@query(f"""SELECT id, CASE WHEN math THEN 'Equation' WHEN n = 'thebibliography' THEN 'Reference' WHEN n IN ('tikzpicture', 'forest') THEN 'Figure' WHEN n IN ('tabular', 'longtable') THEN 'Table' WHEN n = 'algorithm' THEN 'Paragraph'
 WHEN up IS NULL OR up = 'Paragraph' THEN CASE n WHEN 'itemize' THEN 'List' WHEN 'abstract' THEN 'Abstract' ELSE 'Paragraph' END ELSE up END AS label
 FROM (SELECT p_partkey AS id, {_sql_pick('p_partkey', _KINDS)} AS n, p_size % 7 = 0 AS math, {_sql_pick('p_size', (None, 'Paragraph', 'List'))} AS up FROM part)""")
def label_by_kind(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("id"), labels.by_kind(_pick(F.col("p_partkey"), _KINDS), F.col("p_size") % 7 == 0, _pick(F.col("p_size"), (None, "Paragraph", "List"))).alias("label"))


@query("SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN 'none' ELSE lower(event_type) END AS label FROM events")
def normal_label(spark, d):
    return table(spark, d, "events").select(F.col("event_id").alias("id"), labels.normal_label(F.when(F.col("event_id") % 5 != 0, F.upper("event_type"))).alias("label"))


_MACROS, _CLASSES = ("affiliation", "author", "title"), ("revtex4-2", "elsarticle", "cas-dc", "article", "WileyNJD", "NJD", None)


@query(f"""SELECT c_custkey AS id, coalesce((m = 'affiliation' AND c IN ('revtex4-2', 'elsarticle', 'cas-dc')) OR (m = 'author' AND c IN ('WileyNJD', 'NJD')), false) AS skipped
 FROM (SELECT c_custkey, {_sql_pick('c_custkey', _MACROS)} AS m, {_sql_pick('c_nationkey', _CLASSES)} AS c FROM customer)""")
def skipped_macros(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), labels.skipped(_pick(F.col("c_custkey"), _MACROS), _pick(F.col("c_nationkey"), _CLASSES)).alias("skipped"))


_FILES = (".tex", ".sty", ".pdf", ".cls", ".latex", ".texx", "")


@query(f"SELECT p_partkey AS id FROM part WHERE p_partkey % {len(_FILES)} IN (0, 1, 3, 4)")
def tex_files(spark, d):
    return table(spark, d, "part").where(archives.tex_files(F.concat("p_name", _pick(F.col("p_partkey"), _FILES)))).select(F.col("p_partkey").alias("id"))


# -- compile logs: one of each order, with a stretch for each of its items

_ITEM = """items AS (SELECT l_orderkey AS doc_id, l_linenumber AS k, l_partkey AS p, l_suppkey AS s, l_quantity AS q, CASE WHEN l_partkey % 3 < 2 THEN 'tex' ELSE 'dvi' END AS ext, l_linenumber % 2 = 0 AS runs, 'c' || (l_linenumber % 3) AS c FROM lineitem),
 parts AS (SELECT *, CASE WHEN runs THEN '...' || chr(10) ELSE '' END || '[verbose]:  ~~~~~~~~~~~ Processing file ''f' || p || '.' || ext || '''' || chr(10)
 || CASE WHEN s % 4 = 0 THEN '<f' || p || '.' || ext || '> appears to be tex-type, but was neither included nor processable:' || chr(10) ELSE '' END || CASE WHEN q > 40 THEN '! Emergency stop.' || chr(10) ELSE '' END
 || CASE WHEN s % 3 = 0 THEN 'Generated PDF: f' || p || '.pdf<end of PDF name>' || chr(10) ELSE '' END || CASE WHEN s % 5 = 0 THEN 'Generated PostScript: f' || p || '.ps<end of PostScript name>' || chr(10) ELSE '' END AS body FROM items),
 at_ AS (SELECT *, row_number() OVER w AS i, count(*) FILTER (runs) OVER w AS seg FROM parts WINDOW w AS (PARTITION BY doc_id ORDER BY k, c, body ROWS UNBOUNDED PRECEDING))"""


def _logs(spark, d) -> DataFrame:
    t = table(spark, d, "lineitem").withColumn("ext", F.when(F.col("l_partkey") % 3 < 2, "tex").otherwise("dvi")).withColumn("runs", F.col("l_linenumber") % 2 == 0).withColumn("c", F.concat(F.lit("c"), F.col("l_linenumber") % 3))
    name = F.concat(F.lit("f"), "l_partkey", F.lit("."), "ext")
    body = F.concat(
        F.when(F.col("runs"), "...\n").otherwise(""), F.lit("[verbose]:  ~~~~~~~~~~~ Processing file '"), name, F.lit("'\n"),
        F.when(F.col("l_suppkey") % 4 == 0, F.concat(F.lit("<"), name, F.lit("> appears to be tex-type, but was neither included nor processable:\n"))).otherwise(""),
        F.when(F.col("l_quantity") > 40, "! Emergency stop.\n").otherwise(""),
        F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("Generated PDF: f"), "l_partkey", F.lit(".pdf<end of PDF name>\n"))).otherwise(""),
        F.when(F.col("l_suppkey") % 5 == 0, F.concat(F.lit("Generated PostScript: f"), "l_partkey", F.lit(".ps<end of PostScript name>\n"))).otherwise(""),
    )
    mark = F.when(F.col("runs"), F.concat(F.lit("[verbose]:  ~~~~~~~~~~~ Running "), "c", F.lit(" for the first time ~~~~~~~~"))).otherwise("")
    each = F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("k"), "c", body.alias("body"), mark.alias("mark"))))
    return t.groupBy(F.col("l_orderkey").alias("doc_id")).agg(each.alias("parts")).select("doc_id", F.array_join(F.transform("parts", lambda x: F.concat(x["mark"], x["body"])), "").alias("log"))


@query(f"""WITH {_ITEM}, f AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS n, 'f' || p || '.' || ext AS file, s FROM at_)
 SELECT doc_id, n, file FROM f WHERE NOT ends_with(file, '.dvi') AND (doc_id, file) NOT IN (SELECT doc_id, file FROM f WHERE s % 4 = 0)""")
def log_compiled_files(spark, d):
    return logs.compiled_files(_logs(spark, d))


@query(f"WITH {_ITEM} SELECT doc_id, arg_max(c, i) FILTER (runs) AS compiler FROM at_ GROUP BY 1")
def log_last_compiler(spark, d):
    return _logs(spark, d).select("doc_id", logs.last_compiler(F.col("log")).alias("compiler"))


@query(f"""WITH {_ITEM}, seg AS (SELECT doc_id, seg, max(c) FILTER (runs) AS compiler, string_agg(body, '' ORDER BY i) AS body FROM at_ WHERE seg > 0 GROUP BY 1, 2), last AS (SELECT doc_id, max(seg) AS most FROM seg GROUP BY 1)
 SELECT doc_id, (seg - 1)::INT AS n, compiler, body || CASE WHEN seg < most THEN '[verbose]:  ' ELSE '' END AS body FROM seg JOIN last USING (doc_id)""")
def log_segments(spark, d):
    return logs.segments(_logs(spark, d))


@query(f"WITH {_ITEM}, seg AS (SELECT doc_id, seg, max(c) FILTER (runs) AS compiler, bool_or(q > 40) AS bad FROM at_ WHERE seg > 0 GROUP BY 1, 2) SELECT doc_id, bool_or(bad AND compiler = 'c1') AS failed FROM seg GROUP BY 1")
def log_failed(spark, d):
    return logs.failed(_logs(spark, d), "c1")


@query(f"""WITH {_ITEM} SELECT doc_id, coalesce(string_agg('f' || p || '.pdf', ',' ORDER BY i) FILTER (s % 3 = 0), '') AS pdfs, coalesce(string_agg('f' || p || '.ps', ',' ORDER BY i) FILTER (s % 5 = 0), '') AS ps FROM at_ GROUP BY 1""")
def log_outputs(spark, d):
    names = lambda kind: F.array_join(logs.outputs(F.col("log"), kind), ",")
    return _logs(spark, d).select("doc_id", names("pdf").alias("pdfs"), names("ps").alias("ps"))


_OUTPUTS = "outs AS (SELECT DISTINCT l_orderkey AS doc_id, CASE WHEN l_suppkey % 3 = 0 THEN 'html' ELSE 'pdf' END AS type, 'o' || l_partkey AS path, base64(encode('part ' || l_partkey)) AS contents FROM lineitem WHERE l_suppkey % 4 < 2)"


def _outputs(spark, d) -> DataFrame:
    t = table(spark, d, "lineitem").where("l_suppkey % 4 < 2")
    return t.select(F.col("l_orderkey").alias("doc_id"), F.when(F.col("l_suppkey") % 3 == 0, "html").otherwise("pdf").alias("type"), F.concat(F.lit("o"), "l_partkey").alias("path"), F.base64(F.concat(F.lit("part "), "l_partkey").cast("binary")).alias("contents")).distinct()


@query(f"""WITH {_OUTPUTS} SELECT o_orderkey AS doc_id, o_orderstatus = 'F' AS success, n.doc_id IS NOT NULL AS has_output, coalesce(n.files, '') AS files FROM orders LEFT JOIN
 (SELECT doc_id, string_agg(type || ':' || path, ',' ORDER BY type, path) AS files FROM outs GROUP BY 1) n ON n.doc_id = o_orderkey""")
def compile_results(spark, d):
    found = logs.compiled(table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), (F.col("o_orderstatus") == "F").alias("success")), _outputs(spark, d))
    return found.select("doc_id", "success", "has_output", F.array_join(F.transform("output", lambda o: F.concat_ws(":", o["type"], o["path"])), ",").alias("files"))


@query(f"WITH {_OUTPUTS} SELECT doc_id, path, type, strlen('part ' || path[2:])::BIGINT AS bytes, sha256('part ' || path[2:]) AS sha256 FROM outs")
def output_manifest(spark, d):
    return files.manifest(_outputs(spark, d))


@query(f"""WITH {_OUTPUTS} SELECT o_orderkey AS doc_id, CASE WHEN o_orderstatus = 'F' OR n.doc_id IS NOT NULL THEN n.path END AS content FROM orders LEFT JOIN
 (SELECT doc_id, 'part ' || min(path)[2:] AS path FROM outs WHERE type = 'pdf' GROUP BY 1) n ON n.doc_id = o_orderkey""")
def first_output(spark, d):
    found = logs.compiled(table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), (F.col("o_orderstatus") == "F").alias("success")), _outputs(spark, d))
    parsed = found.select("doc_id", files.response(F.to_json(F.struct("success", "has_output", "output"))).alias("r"))
    return parsed.select("doc_id", files.first_output(F.col("r"), "pdf").cast("string").alias("content"))


@query("SELECT o_orderkey AS doc_id, 'order ' || o_custkey AS message FROM orders WHERE o_orderstatus = 'P'")
def error_report(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("order "), "o_custkey")).alias("error"))
    return files.error_report(rows)


# -- TeX text

_BRACED = r"translate(text, 'oaw', '{}\')"


@query(rf"""WITH t AS (SELECT doc_id, replace({_BRACED}, '\\{{', '\\ {{') AS s FROM documents), k AS (SELECT doc_id, unnest(x) AS tok, generate_subscripts(x, 1) AS i FROM (SELECT doc_id, regexp_extract_all(s, '(?s)\\.|[{{}}]|[^\\{{}}]+|\\') AS x FROM t)),
 c AS (SELECT *, sum(CASE tok WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS depth FROM k),
 e AS (SELECT *, least(0, coalesce(min(depth) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lowest, min(depth) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS later FROM c),
 g AS (SELECT doc_id, string_agg(tok, '' ORDER BY i) FILTER (NOT (tok = '}}' AND depth < lowest) AND NOT (tok = '{{' AND later >= depth)) AS result FROM e GROUP BY 1)
 SELECT t.doc_id, coalesce(result, '') AS result FROM t LEFT JOIN g USING (doc_id)""")
def brace_balance(spark, d):
    return table(spark, d, "documents").select("doc_id", textclean.balance_braces(F.translate("text", "oaw", "{}\\")).alias("result"))


@query(r"""SELECT p_partkey AS id, 'x ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: '\usepackage' || CASE WHEN p_size % 2 = 0 THEN '[utf8]' ELSE '' END || '{' || w || '}'), chr(10)) || ' y\usepackage{' || p_type || '}' || p_brand AS result FROM part""")
def usepackage_split(spark, d):
    tex = F.concat(F.lit("x \\usepackage"), F.when(F.col("p_size") % 2 == 0, "[utf8]").otherwise(""), F.lit("{"), F.replace("p_name", F.lit(" "), F.lit(",  ")), F.lit("} y\\usepackage{"), "p_type", F.lit("}"), "p_brand")
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), textclean.split_packages(tex).alias("result"))


@query(r"""SELECT doc_id, x[1] || CASE WHEN len(x) > 1 THEN '\end{document}' ELSE '' END || array_to_string(x[2:], '') AS result FROM (SELECT doc_id, string_split(text, ' the ') AS x FROM documents)""")
def single_end(spark, d):
    return table(spark, d, "documents").select("doc_id", textclean.single_end(F.replace("text", F.lit(" the "), F.lit("\\end{document}"))).alias("result"))


@query(r"""SELECT doc_id, CASE WHEN k > 0 THEN array_to_string(l[:k], chr(10)) || chr(10) ELSE '' END || '\begin{document}' || chr(10) AS result FROM (SELECT doc_id, l, least(doc_id % 4, len(l)) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))""")
def preamble(spark, d):
    lines = F.split("text", "\n")
    k = F.least((F.col("doc_id") % 4).cast("int"), F.size(lines))
    tex = F.array_join(F.concat(F.slice(lines, F.lit(1), k), F.array(F.lit("a \\begin{document} b")), F.slice(lines, k + 1, F.size(lines))), "\n")
    return table(spark, d, "documents").select("doc_id", textclean.preamble(tex).alias("result"))


_LOADED = "CASE WHEN p_size % 3 = 0 THEN 'a' || chr(10) || '\\usepackage{b}' || chr(10) || p_name || chr(10) || '\\usepackage[utf8]{c}' ELSE p_name END"


@query(f"SELECT p_partkey AS id, 'B' || CASE WHEN p_size % 3 = 0 THEN {_LOADED} || 'A' ELSE 'A' || p_name END || CASE WHEN p_size % 2 = 0 THEN chr(10) || p_type ELSE '' END AS result FROM part")
def postprocess_tex(spark, d):
    own = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("a\n\\usepackage{b}\n"), "p_name", F.lit("\n\\usepackage[utf8]{c}"))).otherwise(F.col("p_name"))
    tex = F.concat(own, F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("\n"), "p_type")).otherwise(""))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), textclean.postprocess(tex, "B", "A").alias("result"))


_CASES = " ".join(f"WHEN {_q(sign)} THEN {_q(tex)}" for sign, tex in textclean.ESCAPES.items())


@query(f"SELECT doc_id, array_to_string(list_transform(string_split(text, ''), lambda c: CASE c {_CASES} ELSE c END), '') AS result FROM documents")
def latex_escape(spark, d):
    return table(spark, d, "documents").select("doc_id", textclean.latex_escape(F.col("text")).alias("result"))


@query(r"SELECT doc_id, regexp_replace(replace(text, 'v', '%'), '(^|[^\\])(%[^\n]*(\n\s*)?)+', '\1', 'g') AS result FROM documents")
def strip_comments(spark, d):
    return table(spark, d, "documents").select("doc_id", textclean.strip_comments(F.replace("text", F.lit("v"), F.lit("%"))).alias("result"))


_OLD, _NEW = ([pair[i] for pair in textclean.SYNONYMS] for i in (0, 1))
_STYLE = ("", "\\displaystyle ", "\\textstyle ", "\\scriptstyle ")
_WRAP = (("\\(", "\\)"), ("\\[", "\\]"), ("$$", "$$"), ("$", "$"))


@query(f"""SELECT p_partkey AS id, '\\(' || ltrim(CASE WHEN p_partkey % 4 > 0 THEN ' ' ELSE '' END || p_name) || ' ' || {_sql_pick('p_partkey', _NEW)} || 'z ' || p_size || ' ' || p_type || '\\)' AS result FROM part""")
def math_normalize(spark, d):
    k = F.col("p_partkey")
    wrap = lambda i: _pick(F.col("p_size"), [w[i] for w in _WRAP])
    tex = F.concat(F.lit(" "), wrap(0), _pick(k, _STYLE), "p_name", F.lit(" "), _pick(k, _OLD), F.lit("z "), "p_size", F.lit("% note\n"), "p_type", wrap(1), F.lit("\n"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), textclean.normal_math(tex, True).alias("result"))


@query(r"""SELECT p_partkey AS id, '\newcommand{\v}[2]{<#1|#2>}\newcommand{\k}{K}\newenvironment{n}[1]{(#1)}{!}\begin{document}<' || p_name || '|' || p_type || '> K ' || p_brand || '(' || p_size || ')in' || p_name || '!\end{document}' AS result FROM part""")
def expand_macros(spark, d):
    head = "\\newcommand{\\v}[2]{<#1|#2>}\\newcommand{\\k}{K}\\newenvironment{n}[1]{(#1)}{!}\\begin{document}"
    tex = F.concat(F.lit(head + "\\v{"), "p_name", F.lit("}{"), "p_type", F.lit("} \\k "), "p_brand", F.lit("\\begin{n}{"), "p_size", F.lit("}in"), "p_name", F.lit("\\end{n}\\end{document}"))
    return arrow.dealt(table(spark, d, "part")).select(F.col("p_partkey").alias("id"), latex.expand_macros(tex).alias("result"))


@query(rf"""SELECT p_partkey AS id, '\begin{{document}}' || p_name || CASE WHEN p_size % 2 = 0 THEN '' ELSE '\{textclean.PLACEHOLDER}{{9}}' END || p_type AS kept, p_name || p_type AS bare FROM part""")
def placeholders(spark, d):
    mark = lambda i: F.concat(F.lit(f"\\{textclean.PLACEHOLDER}{{"), i, F.lit("}"))
    name = F.concat("p_name", F.when(F.col("p_size") % 2 == 0, mark(F.lit("1"))).otherwise(mark(F.lit("9"))), "p_type")
    held = F.create_map(F.lit("1"), F.lit(""), F.lit("2"), F.lit("\\begin{document}"))
    kept = textclean.restore_placeholders(F.concat(mark(F.lit("2")), name), held)
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), kept.alias("kept"), textclean.strip_placeholders(name).alias("bare"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, 'u', ' '), '(?m) $', '', 'g'), '(?m)\n[\t ]*$', chr(10), 'g'), '([^\n]) {2,}', '\1 ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+', '') AS text FROM documents""")
def md_postclean(spark, d):
    return table(spark, d, "documents").select("doc_id", textclean.clean_markdown(F.replace("text", F.lit("u"), F.lit(" "))).alias("text"))


@query(r"""SELECT page_id, regexp_replace(CASE WHEN regexp_matches(t, '\S') THEN regexp_replace(regexp_replace(t, '^\n+', chr(10)), '\n+$', chr(10)) ELSE regexp_replace(t, '^\n+|\n+$', '', 'g') END, '[ \t]+', ' ', 'g') AS text
 FROM (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN chr(10) || chr(10) || '  ' || chr(10) ELSE repeat(chr(10), (page_id % 3)::INT) || replace(html, '<', '   ') || repeat(chr(10), (page_id % 4)::INT) END AS t FROM pages)""")
def html_whitespace(spark, d):
    breaks = lambda n: F.repeat(F.lit("\n"), (F.col("page_id") % n).cast("int"))
    text = F.when(F.col("page_id") % 5 == 0, "\n\n  \n").otherwise(F.concat(breaks(3), F.replace("html", F.lit("<"), F.lit("   ")), breaks(4)))
    return table(spark, d, "pages").select("page_id", textclean.html_whitespace(text).alias("text"))


@query("SELECT doc_id, text FROM documents")
def decode_text(spark, d):
    encoded = F.when(F.col("doc_id") % 4 == 0, F.encode("text", "UTF-16LE"))
    marked = F.when(F.col("doc_id") % 4 == 1, F.concat(F.lit(b"\xef\xbb\xbf"), F.encode("text", "UTF-8"))).when(F.col("doc_id") % 4 == 2, F.concat(F.lit(b"\xfe\xff"), F.encode("text", "UTF-16BE")))
    plain = F.encode("text", "UTF-8")
    # without a mark, UTF-16 is told by the zeros between letters at the beginning
    content = F.when(F.substring("text", 1, 8).rlike("^[a-z A-Z]{4,}"), encoded).otherwise(None)
    return table(spark, d, "documents").select("doc_id", archives.decode(F.coalesce(content, marked, plain)).alias("text"))


@query("""SELECT doc_id::VARCHAR AS doc_id, unnest(CASE doc_id % 3 WHEN 0 THEN ['a/main.tex', 'b.sty'] WHEN 1 THEN ['main.tex'] ELSE ['file.pdf'] END) AS member, unnest(CASE doc_id % 3 WHEN 0 THEN ['tar', 'tar'] WHEN 1 THEN ['gz'] ELSE ['pdf'] END) AS kind,
 unnest(CASE doc_id % 3 WHEN 0 THEN [text, lang] WHEN 1 THEN [text] ELSE ['%PDF' || text] END) AS text FROM documents""")
def unpack_archives(spark, d):
    """Archives written from documents: tars with a file that would leave its folder, single files, and bytes of neither kind."""

    @F.pandas_udf("binary")
    def packed(i: pd.Series, text: pd.Series, lang: pd.Series) -> pd.Series:
        def one(i, text, lang):
            if i % 3 == 1:
                return gzip.compress(text.encode(), 1)
            if i % 3 == 2:
                return b"%PDF" + text.encode()
            out = io.BytesIO()
            with tarfile.open(fileobj=out, mode="w:gz", compresslevel=1) as tar:
                for name, data in (("a/main.tex", text), ("../out.tex", "no"), ("b.sty", lang)):
                    info = tarfile.TarInfo(name)
                    info.size = len(data.encode())
                    tar.addfile(info, io.BytesIO(data.encode()))
            return out.getvalue()

        return pd.Series([one(*row) for row in zip(i, text, lang, strict=True)])

    blobs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), packed("doc_id", "text", "lang").alias("content"))
    return archives.unpack(blobs).select("doc_id", "member", "kind", archives.decode(F.col("content")).alias("text"))


# -- catalogues and files

_MEMBERS = "CASE p_partkey % 5 WHEN 0 THEN [n] WHEN 1 THEN [n || '.tex'] WHEN 2 THEN [n || '.latex'] WHEN 3 THEN [n || '.latex', n || '.tex'] ELSE [] END"


@query(f"""SELECT p_partkey % 100 AS doc_id, n AS name, CASE p_partkey % 5 WHEN 0 THEN n WHEN 2 THEN n || '.latex' WHEN 4 THEN '' ELSE n || '.tex' END AS member FROM (SELECT p_partkey, 'n' || p_partkey AS n FROM part)""")
def resolve_files(spark, d):
    p = table(spark, d, "part").select((F.col("p_partkey") % 100).alias("doc_id"), F.concat(F.lit("n"), "p_partkey").alias("name"), (F.col("p_partkey") % 5).alias("k"))
    n = F.col("name")
    have = F.when(F.col("k") == 0, F.array(n)).when(F.col("k") == 1, F.array(F.concat(n, F.lit(".tex")))).when(F.col("k") == 2, F.array(F.concat(n, F.lit(".latex")))).when(F.col("k") == 3, F.array(F.concat(n, F.lit(".latex")), F.concat(n, F.lit(".tex"))))
    return archives.resolve(p.select("doc_id", "name"), p.select("doc_id", F.explode(have).alias("member")))


@query("""WITH k AS (SELECT p_partkey AS i, 'm' || p_size || CASE WHEN p_size % 11 = 0 THEN '_' ELSE '' END AS n, CASE WHEN p_partkey % 2 = 0 THEN '[' ELSE '' END || repeat('{', (p_partkey % 4)::INT) || CASE WHEN p_partkey % 9 = 0 THEN '(' ELSE '' END AS a FROM part),
 l AS (SELECT n, arg_max(a, (length(a), -i)) AS a FROM k GROUP BY 1) SELECT n AS name, a AS args FROM l WHERE NOT contains(a, '(') AND NOT ends_with(n, '_') AND n NOT IN (SELECT 'm' || n_nationkey FROM nation)""")
def macro_longest_args(spark, d):
    k = F.col("p_partkey")
    name = F.concat(F.lit("m"), "p_size", F.when(F.col("p_size") % 11 == 0, "_").otherwise(""))
    args = F.concat(F.when(k % 2 == 0, "[]").otherwise(""), F.repeat(F.lit("{}"), (k % 4).cast("int")), F.when(k % 9 == 0, "(>").otherwise(""))
    known = table(spark, d, "nation").select(F.concat(F.lit("m"), "n_nationkey").alias("name"))
    return catalogues.longest_arguments(table(spark, d, "part").select(k.alias("ord"), F.concat(name, args).alias("key")), known=known)


@query(r"""WITH p AS (SELECT p_partkey, '\' || CASE WHEN p_size % 7 = 0 THEN '@' ELSE '' END || split_part(p_name, ' ', 1) AS name, '\' || split_part(p_name, ' ', 1 + p_size % 2) || CASE WHEN p_size % 3 = 0 THEN 'x' ELSE ' ' END || p_type AS body, split_part(p_name, ' ', 1 + p_size % 2) || CASE WHEN p_size % 3 = 0 THEN 'x' || regexp_extract(p_type, '^[A-Za-z]*') ELSE '' END AS called FROM part)
 SELECT name, body FROM p WHERE name NOT IN (SELECT name FROM p WHERE p_partkey % 500 = 3) AND NOT contains(name, '@') AND called <> name[2:]""")
def private_macros(spark, d):
    word = lambda i: F.split_part("p_name", F.lit(" "), i)
    name = F.concat(F.lit("\\"), F.when(F.col("p_size") % 7 == 0, "@").otherwise(""), word(F.lit(1)))
    body = F.concat(F.lit("\\"), word((1 + F.col("p_size") % 2).cast("int")), F.when(F.col("p_size") % 3 == 0, "x").otherwise(" "), F.col("p_type"))
    p = table(spark, d, "part").select("p_partkey", name.alias("name"), body.alias("body"))
    return catalogues.private(p.select("name", "body"), p.where("p_partkey % 500 = 3").select("name").distinct())


@query("SELECT page_id, 'https://api.github.com/repos/o' || page_id || '/r/contents/a/b' || page_id || '?ref=main' AS url FROM pages")
def contents_url(spark, d):
    return table(spark, d, "pages").select("page_id", files.contents_url(F.concat(F.lit("https://github.com/o"), "page_id", F.lit("/r/tree/main/a/b"), "page_id")).alias("url"))


# -- colours

_LEVEL = "CASE WHEN {0} % 11 = 10 THEN '1.0' ELSE '0.' || ({0} % 11) END"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey % 9 > 0 THEN {_LEVEL.format('l_partkey')} || ',' || {_LEVEL.format('l_suppkey')} || ',' || {_LEVEL.format('l_linenumber')} END AS key FROM lineitem")
def channel_key(spark, d):
    # the middle of each tenth: what a colour of that digit may be read as
    level = lambda c: F.when(F.col(c) % 11 == 10, 1.0).otherwise((F.col(c) % 11 + 0.5) / 10)
    x = F.when(F.col("l_suppkey") % 9 > 0, F.array(level("l_partkey"), level("l_suppkey"), level("l_linenumber"))).otherwise(F.array(F.lit(0.5)))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", color.channel_key(x).alias("key"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey % 9 > 1 THEN printf('#%02x%02x%02x', l_partkey % 256, l_suppkey % 256, l_linenumber % 256) ELSE '#000000' END AS color FROM lineitem")
def page_color(spark, d):
    x = F.array(*[F.col(c) % 256 / 255 for c in ("l_partkey", "l_suppkey", "l_linenumber")])
    x = F.when(F.col("l_suppkey") % 9 > 1, x).when(F.col("l_suppkey") % 9 == 1, F.array(F.lit(2.0), F.lit(0.0), F.lit(0.0)))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", color.page_color(x).alias("color"))


_HUE = "h AS (SELECT i, row_number() OVER (ORDER BY i % 5, i) - 1 AS k FROM (SELECT range AS i FROM range(359))), l AS (SELECT range AS n, (256 - range) / 256 AS x FROM range(206))"


@query(f"""WITH {_HUE}, c AS (SELECT (k * 206 + s.n) * 206 + v.n AS id, floor(i / 359 * 6)::INT % 6 AS f, i / 359 * 6 - floor(i / 359 * 6) AS g, s.x AS s, v.x AS v FROM h, l s, l v),
 q AS (SELECT id, f, least(255, floor(v * 255))::INT AS v, least(255, floor(v * (1 - s) * 255))::INT AS p, least(255, floor(v * (1 - s * g) * 255))::INT AS q, least(255, floor(v * (1 - s * (1 - g)) * 255))::INT AS t FROM c),
 rgb AS (SELECT id, [v, q, p, p, t, v][f + 1] AS r, [t, v, v, q, p, p][f + 1] AS g, [p, p, t, v, v, q][f + 1] AS b FROM q), own AS (SELECT r, g, b, min(id) AS id FROM rgb GROUP BY ALL)
 SELECT r::BIGINT AS red, count(*) AS colors, sum(id)::BIGINT AS ords, sum(g * 256 + b)::BIGINT AS rest FROM own GROUP BY 1""")
def palette_by_red(spark, d):
    """The whole palette in 256 rows: its colours by red, with sums of their places and of their other channels."""
    c = color.palette(spark)
    return c.groupBy(F.floor(F.col("color") / 65536).alias("red")).agg(F.count("*").alias("colors"), F.sum("ord").alias("ords"), F.sum(F.col("color") % 65536).alias("rest"))


# -- converted HTML

@query("""SELECT p_partkey AS id, '## ' || p_name || chr(10) || chr(10) || p_type || ' _' || p_brand || '_ x' || translate(p_size::VARCHAR, '0123456789', '⁰¹²³⁴⁵⁶⁷⁸⁹') || ' [' || p_size || '].' || chr(10) || chr(10) || '* ' || split_part(p_name, ' ', 1) || chr(10) || '* ' || split_part(p_name, ' ', 2) || chr(10) AS markdown FROM part""")
def article_markdown(spark, d):
    page = F.concat(
        F.lit('<article><section class="ltx_section"><h2 class="ltx_title"><span class="ltx_tag ltx_tag_subsection">1.1</span>'), "p_name", F.lit('</h2><div class="ltx_authors">none</div><p class="ltx_p">'), "p_type",
        F.lit(' <em class="ltx_emph ltx_font_italic">'), "p_brand", F.lit("</em> x<sup>"), "p_size", F.lit('</sup> <cite class="ltx_cite"><a class="ltx_ref" href="#bib.bib'), "p_size", F.lit('">'), "p_size",
        F.lit('</a></cite>.</p><ul class="ltx_itemize"><li class="ltx_item">'), F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit('</li><li class="ltx_item"><p class="ltx_p">'), F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit("</p></li></ul></section></article>"),
    )
    return arrow.dealt(table(spark, d, "part")).select(F.col("p_partkey").alias("id"), article.article(page).getField("markdown").alias("markdown"))


_NODES = "node::INT AS node, coalesce(parent, -1)::INT AS parent, ord::INT AS ord, kind, text"


@query(f"""SELECT p_partkey AS id, {_NODES} FROM part, (VALUES (0, NULL, 0, 'article'), (1, 0, 0, 'section'), (2, 1, 0, 'heading'), (3, 2, 0, 'text'), (4, 1, 1, 'paragraph'), (5, 4, 0, 'text'), (6, 4, 1, 'italic'), (7, 6, 0, 'text'), (8, 1, 2, 'math'), (9, 1, 3, 'list'), (10, 9, 0, 'item'), (11, 10, 0, 'text')) n(node, parent, ord, kind),
 LATERAL (SELECT CASE node WHEN 3 THEN p_name WHEN 5 THEN p_type || ' ' WHEN 7 THEN p_brand WHEN 8 THEN 'x_' || p_size WHEN 11 THEN p_name END AS text)""")
def article_nodes(spark, d):
    page = F.concat(F.lit('<section class="ltx_section"><h2 class="ltx_title">'), "p_name", F.lit('</h2><p class="ltx_p">'), "p_type", F.lit(' <em class="ltx_emph ltx_font_italic">'), "p_brand", F.lit('</em></p><math class="ltx_Math" alttext="x_'), "p_size", F.lit('"></math><div class="ltx_rule">no</div><ul class="ltx_itemize"><li class="ltx_item">'), "p_name", F.lit("</li></ul></section>"))
    return article.nodes(arrow.dealt(table(spark, d, "part")).select(F.col("p_partkey").alias("id"), page.alias("html")), "id").select("id", "node", F.coalesce("parent", F.lit(-1)).alias("parent"), "ord", "kind", "text")


@query(f"""SELECT p_partkey AS id, {_NODES} FROM part, (VALUES (0, NULL, 0, 'document'), (1, 0, 0, 'div'), (2, 1, 0, 'p'), (3, 2, 0, 'text'), (4, 2, 1, 'br'), (5, 1, 1, 'p'), (6, 5, 0, 'text'), (7, 5, 1, 'b'), (8, 7, 0, 'text')) n(node, parent, ord, kind),
 LATERAL (SELECT CASE node WHEN 3 THEN p_name WHEN 6 THEN p_type || ' & ' WHEN 8 THEN p_brand END AS text)""")
def html_nodes(spark, d):
    page = F.concat(F.lit("<div><p>"), "p_name", F.lit("<br><p>"), "p_type", F.lit(" &amp; <b>"), "p_brand", F.lit("</b></div>"))
    return html.nodes(arrow.dealt(table(spark, d, "part")).select(F.col("p_partkey").alias("id"), page.alias("html")), "id").select("id", "node", F.coalesce("parent", F.lit(-1)).alias("parent"), "ord", "kind", "text")


@query(r"""WITH r AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n, l_partkey AS p FROM lineitem)
 SELECT k AS id, '\begin{table}' || chr(10) || '\begin{tabular}{l|r}' || chr(10) || string_agg(CASE WHEN p % 2 = 0 THEN '\hline' || chr(10) ELSE '' END || 'A\&' || n || ' & ' || p || ' \\', chr(10) ORDER BY n, p) || chr(10) || '\end{tabular}' || chr(10) || '\end{table}' || chr(10) || 'Order ' || k || '.' AS tex FROM r GROUP BY 1""")
def article_tables(spark, d):
    t = arrow.dealt(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p")).alias("r")), "k")
    rows = t.groupBy("k").agg(F.sort_array(F.collect_set("r")).alias("rows"))

    def row(r):
        top = F.when(r["p"] % 2 == 0, " ltx_border_t").otherwise("")
        return F.concat(F.lit('<tr class="ltx_tr"><td class="ltx_td ltx_align_left ltx_border_r'), top, F.lit('">A&amp;'), r["n"], F.lit('</td><td class="ltx_td ltx_align_right'), top, F.lit('">'), r["p"], F.lit("</td></tr>"))

    body = F.array_join(F.transform("rows", row), "")
    page = F.concat(F.lit('<figure class="ltx_table" id="T1"><table class="ltx_tabular">'), body, F.lit("</table><figcaption>Order "), "k", F.lit(".</figcaption></figure>"))
    return rows.select(F.col("k").alias("id"), F.element_at(article.article(page).getField("figures"), "TABLE:T1").alias("tex"))


_GREEK = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


@query("""SELECT p_partkey AS id, chr(CASE WHEN k = 4 THEN 1013 WHEN k = 20 THEN 981 WHEN k >= 17 THEN 946 + k ELSE 945 + k END) || '+' || chr(CASE WHEN k >= 17 THEN 914 + k ELSE 913 + k END) || ' ' || chr((119808 + p_size % 26)::INT) || chr(120120) || ' ' || nfc_normalize(chr((97 + p_size % 5)::INT) || chr(769)) || p_name AS result
 FROM (SELECT *, (p_partkey % 24)::INT AS k FROM part)""")
def unicode_symbols(spark, d):
    small, capital = _pick(F.col("p_partkey"), _GREEK), _pick(F.col("p_partkey"), [g.capitalize() for g in _GREEK])
    letter = lambda base, n: F.chr(F.lit(base) + F.col("p_size") % n)
    tex = F.concat(F.lit("\\"), small, F.lit("+\\"), capital, F.lit("{} \\mathbf{"), letter(65, 26), F.lit("}\\mathbb{A} \\'{"), letter(97, 5), F.lit("}"), "p_name")
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.replace(symbols.to_unicode(tex), F.lit("{}"), F.lit("")).alias("result"))


@query("""SELECT o_custkey AS id, string_agg('Order ' || o_orderkey || ' of ' || CASE WHEN o_orderkey % 3 = 0 THEN 'x ' || o_orderstatus || ' y' ELSE o_orderstatus END, '|' ORDER BY o_orderkey) AS items FROM orders GROUP BY 1""")
def bib_items(spark, d):
    inner = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("<ul><li>x</li> <li>"), "o_orderstatus", F.lit("</li> </ul>y"))).otherwise(F.col("o_orderstatus"))
    item = F.concat(F.lit('<li class="a ltx_bibitem" id="b"> Order <b>'), "o_orderkey", F.lit("</b>\n of  "), inner, F.lit("</li><li>no</li>"))
    rows = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", item.alias("t")))).alias("all"))
    page = F.concat(F.lit("<ul>"), F.array_join(F.transform("all", lambda x: x["t"]), ""), F.lit("</ul>"))
    return rows.select("id", F.array_join(html.references(page), "|").alias("items"))


# -- the walk over a document

_CLEAN = r"""l AS (SELECT doc_id, unnest(range(len(x))) AS i, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)), w AS (SELECT doc_id, i, regexp_extract_all(line, '[A-Za-z]+') AS w FROM l), v AS (SELECT doc_id, i, w, i % 5 AS kind FROM w WHERE len(w) > 0)"""


@query(f"""WITH {_CLEAN}, t AS (SELECT doc_id, i, 0 AS j, '$x' || i || '$' AS text, 'Equation' AS label FROM v WHERE kind = 3
 UNION ALL SELECT doc_id, i, unnest(range(1, len(w) + 1)), unnest(w), CASE kind WHEN 0 THEN 'Section' WHEN 4 THEN 'List' ELSE 'Paragraph' END FROM v), s AS (SELECT doc_id, i, count(*) FILTER (kind = 0) OVER (PARTITION BY doc_id ORDER BY i) AS section FROM v)
 SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1)::INT AS reading, text, label, section::INT AS section FROM t JOIN s USING (doc_id, i)""")
def parse_latex(spark, d):
    word = lambda x: F.array_join(F.regexp_extract_all(x, F.lit("[A-Za-z]+"), F.lit(0)), " ")

    def tex(x, i):
        body, kind = word(x), i % 5
        made = F.when(kind == 0, F.concat(F.lit("\\section{"), body, F.lit("}"))).when(kind == 3, F.concat(F.lit("$x"), i.cast("string"), F.lit("$ "), body)).when(kind == 4, F.concat(F.lit("\\begin{itemize}\\item "), body, F.lit("\\end{itemize}")))
        return F.when(body == "", "").otherwise(made.when(kind == 2, F.concat(F.lit("\n% a note\n"), body)).otherwise(body))

    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("\\documentclass{article}\n\\begin{document}\n"), F.array_join(F.transform(F.split("text", "\n"), tex), "\n"), F.lit("\n\\end{document}\n")).alias("text"))
    return latex.parse_latex(docs, texts=True).select("doc_id", "reading", "text", "label", "section")


_WALKED = r"""CASE WHEN p_size % 2 = 0 THEN 'Title' END"""


@query(r"""WITH w AS (SELECT p_partkey AS doc_id, p_size, list_concat(list_concat([p_size::VARCHAR], string_split(p_name, ' ')), CASE WHEN p_size % 2 = 0 THEN [p_brand] ELSE [] END) AS w FROM part)
 SELECT doc_id, unnest(range(len(w)))::INT AS reading, unnest(w) AS text FROM w""")
def parse_macros(spark, d):
    """Arguments of unknown macros have no label; a definition, or a package, makes a macro known."""
    p = table(spark, d, "part").withColumn("doc_id", F.col("p_partkey"))
    own = F.when(F.col("p_size") % 2 == 0, "\\newcommand{\\odd}[1]{x}").otherwise("")
    tex = F.concat(F.lit("\\begin{document}"), own, F.lit("\\strange{no}[nor] % \n {this} "), "p_size", F.lit(" \\packed{"), "p_name", F.lit("}{x}\\odd{"), "p_brand", F.lit("}\\end{document}"))
    # {x} is \packed's second argument where the package says so; it has none of its own
    docs = p.select("doc_id", F.concat(F.lit("\\usepackage{one}"), F.replace(tex, F.lit("{x}\\odd"), F.lit("\\odd"))).alias("text"))
    entries = spark.createDataFrame([("two", "cmds", "packed", "{")], "package string, kind string, name string, args string")
    found = latex.parse_latex(arrow.dealt(grammar.context(docs, entries, spark.createDataFrame([("one", "two")], "package string, includes string"))), texts=True)
    return found.select("doc_id", "reading", "text")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'p' || (p_partkey % 40) AS package, 'p' || (p_partkey % 40 * 3 + 1) % 40 AS includes FROM part), c AS (SELECT DISTINCT package AS root, package FROM e UNION SELECT c.root, e.includes FROM c JOIN e ON e.package = c.package),
 k AS (SELECT DISTINCT 'p' || (p_partkey % 40) AS package, 'm' || (p_size % 17) AS name, repeat('{', (p_partkey % 3)::INT) AS args FROM part), l AS (SELECT package, name, arg_max(args, length(args)) AS args FROM k GROUP BY ALL),
 d AS (SELECT doc_id, 'p' || (doc_id % 40) AS root FROM documents), r AS (SELECT DISTINCT doc_id, package FROM d JOIN c USING (root)), f AS (SELECT doc_id, name, arg_min(args, package) AS args FROM r JOIN l USING (package) GROUP BY ALL)
 SELECT d.doc_id, coalesce(string_agg(name || args, ',' ORDER BY name), '') AS macros FROM d LEFT JOIN f USING (doc_id) GROUP BY 1""")
def grammar_context(spark, d):
    p = table(spark, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey") % 40).alias("package"), F.concat(F.lit("p"), (F.col("p_partkey") % 40 * 3 + 1) % 40).alias("includes"), F.concat(F.lit("m"), F.col("p_size") % 17, F.repeat(F.lit("{}"), (F.col("p_partkey") % 3).cast("int"))).alias("key"))
    cmds = p.groupBy("package").agg(F.collect_set("key").alias("keys")).select("package", F.map_from_arrays("keys", F.transform("keys", lambda _: F.lit(""))).alias("cmds"), F.lit(None).cast("map<string,string>").alias("envs"))
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("\\documentclass[x]{a}\n\\usepackage [y] {q, p"), F.col("doc_id") % 40, F.lit("}")).alias("text"))
    found = grammar.context(docs, grammar.entries(cmds), p.select("package", "includes").distinct())
    return found.select("doc_id", F.array_join(F.transform(F.map_entries("macros"), lambda e: F.concat(e["key"], e["value"])), ",").alias("macros"))


@query("""WITH l AS (SELECT 'f' || (p_partkey % 20) AS package, p_size % 3 AS k, p_size AS n FROM part) SELECT DISTINCT package, CASE k WHEN 0 THEN 'includes' WHEN 1 THEN 'cmds' ELSE 'envs' END AS kind, CASE k WHEN 0 THEN 'g' || n WHEN 1 THEN 'm' || n || '{}[]' ELSE 'e' || n || '{}' END AS key FROM l""")
def package_files(spark, d):
    k, n = F.col("p_size") % 3, F.col("p_size").cast("string")
    line = F.when(k == 0, F.concat(F.lit("#include:g"), n)).when(k == 1, F.concat(F.lit("\\m"), n, F.lit("{arg}[an option]#n"))).otherwise(F.concat(F.lit("\\begin{e"), n, F.lit("}{x}")))
    lines = table(spark, d, "part").select(F.concat(F.lit("f"), F.col("p_partkey") % 20, F.lit(".cwl")).alias("file"), line.alias("line"))
    found = files.packages_of(lines.union(lines.select(F.lit("expl3.cwl"), F.lit("\\no"))))
    part = lambda kind, keys: found.select("package", F.lit(kind).alias("kind"), F.explode(keys).alias("key"))
    return part("includes", F.col("includes")).union(part("cmds", F.map_keys("cmds"))).union(part("envs", F.map_keys("envs")))


@query("""SELECT p_partkey AS id, chr(10) || chr(10) || '§ ' || upper(p_name) || chr(10) || p_type || ' ' || p_size || '/2[' || p_brand || '] ' || p_name || ' <u>' || chr(10) || '  * 5% ' || p_size || chr(10) || '  x y' AS text FROM part""")
def tex_rendering(spark, d):
    tex = F.concat(F.lit("\\section*{"), "p_name", F.lit("}\\textbf{"), "p_type", F.lit("} \\frac{"), "p_size", F.lit("}2\\footnote{"), "p_brand", F.lit("} \\href{u}{"), "p_name", F.lit("}\\begin{itemize}\\item 5\\% "), "p_size", F.lit("\\label{z}\\item[x] y% note\n\\end{itemize}"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), rendering.to_text(tex).alias("text"))


@query(r"""SELECT p_partkey AS id, '\usepackage{a}' || chr(10) || '\usepackage{' || p_brand || '}\foliokept{0}' || chr(10) || '\begin{document}<' || p_name || '>\end{document} z' AS text, '\newcommand{\v}[1]{<#1>}' AS removed FROM part""")
def clean_tex(spark, d):
    tex = F.concat(F.lit("\\usepackage{a, "), "p_brand", F.lit("}}\\newcommand{\\v}[1]{<#1>}\\begin{document}\\v{"), "p_name", F.lit("}\\end{document}{ z\\end{document}"))
    found = table(spark, d, "part").select("p_partkey", latex.clean(tex).alias("c"))
    return found.select(F.col("p_partkey").alias("id"), "c.text", F.col("c.removed")["0"].alias("removed"))


# -- papers of several files, made of the lines of documents, four to a file

_PAPER = r"""l AS (SELECT doc_id, unnest(range(len(x))) AS i, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)), v AS (SELECT doc_id, i, i // 4 AS k, regexp_extract_all(line, '[A-Za-z]+') AS w FROM l),
 c AS (SELECT doc_id, k, string_agg(array_to_string(w, ' '), chr(10) ORDER BY i) AS body FROM v GROUP BY ALL)"""
_HEAD, _TAIL = "\\documentclass{article}\n\\begin{document}\n", "\n\\input{gone}\n\\end{document}"


def _members(spark, d) -> DataFrame:
    words = lambda x: F.array_join(F.regexp_extract_all(x, F.lit("[A-Za-z]+"), F.lit(0)), " ")
    lines = table(spark, d, "documents").select("doc_id", F.transform(F.split("text", "\n"), words).alias("l"))
    ks = F.sequence(F.lit(0), F.ceil(F.size("l") / 4).cast("int") - 1)
    deep = F.filter(ks, lambda k: k % 3 == 0)
    file = lambda member, text: F.struct(member.alias("member"), text.alias("text"))
    input = lambda k: F.when(k % 3 == 0, F.concat(F.lit("\\input{ d"), k.cast("string"), F.lit("}\n"))).otherwise("")
    main = F.concat(F.lit(_HEAD), F.array_join(F.transform(ks, lambda k: F.concat(F.lit("\\include{c"), k.cast("string"), F.lit(".tex}"))), "\n"), F.lit(_TAIL))
    files = F.concat(
        F.transform(ks, lambda k: file(F.concat(F.lit("c"), k.cast("string"), F.lit(".tex")), F.concat(input(k), F.array_join(F.slice("l", k * 4 + 1, F.lit(4)), "\n")))),
        F.transform(deep, lambda k: file(F.concat(F.lit("d"), k.cast("string"), F.lit(".latex")), F.concat(F.lit("D"), k.cast("string")))), F.array(file(F.lit("main.tex"), main)),
    )
    return lines.select("doc_id", F.explode(files).alias("f")).select("doc_id", "f.member", "f.text")


@query(f"""WITH {_PAPER} SELECT doc_id, 'main.tex' AS member, k::INT AS n, 'c' || k || '.tex' AS name, 'c' || k || '.tex' AS included FROM c UNION ALL SELECT doc_id, 'c' || k || '.tex', 0, 'd' || k, 'd' || k || '.latex' FROM c WHERE k % 3 = 0
 UNION ALL SELECT doc_id, 'main.tex', count(*)::INT, 'gone', '' FROM c GROUP BY 1""")
def paper_includes(spark, d):
    return papers.includes(_members(spark, d))


@query(f"WITH {_PAPER} SELECT doc_id, 'main.tex' AS member FROM c GROUP BY 1 UNION ALL SELECT doc_id, 'c' || k || '.tex' FROM c UNION ALL SELECT doc_id, 'd' || k || '.latex' FROM c WHERE k % 3 = 0")
def paper_files(spark, d):
    return papers.reached(_members(spark, d))


@query(f"WITH {_PAPER} SELECT doc_id, 'main.tex' AS root, {_q(_HEAD)} || string_agg(CASE WHEN k % 3 = 0 THEN 'D' || k || chr(10) ELSE '' END || body, chr(10) ORDER BY k) || {_q(_TAIL)} AS text FROM c GROUP BY 1")
def paper_text(spark, d):
    return papers.inlined(_members(spark, d))


@query(rf"""WITH {_PAPER}, t AS (SELECT doc_id, k, -1 AS i, ['D' || k] AS w FROM c WHERE k % 3 = 0 UNION ALL SELECT doc_id, k, i, w FROM v), n AS (SELECT *, coalesce(sum(len(w)) OVER (PARTITION BY doc_id ORDER BY k, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM t),
 p AS (SELECT doc_id, k, i, array_to_string(list_transform(w, lambda x, j: '{{\color[RGB]{{' || ((before + j - 1) * 7 // 65536 % 256) || ', ' || ((before + j - 1) * 7 // 256 % 256) || ', ' || ((before + j - 1) * 7 % 256) || '}}' || x || '}}'), ' ') AS line FROM n)
 SELECT doc_id, {_q(_HEAD)} || '\newcommand{{\kept}}{{K}}' || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY k, i) || {_q(_TAIL)} AS text FROM p GROUP BY 1""")
def paper_colored(spark, d):
    """From files to coloured text: includes, cleaning with definitions taken out and put back, the walk, and a colour a word."""
    members = _members(spark, d).withColumn("text", F.when(F.col("member") == "main.tex", F.replace("text", F.lit(_HEAD), F.lit(_HEAD + "\\newcommand{\\kept}{K}\n"))).otherwise(F.col("text")))
    colors = spark.range(table(spark, d, "documents").agg(F.max(F.length("text"))).first()[0]).select(F.col("id").cast("int").alias("reading"), color.hex_key(F.col("id") * 7).alias("color_key"))
    _, text = papers.annotated(papers.ready(members), colors)
    return text
