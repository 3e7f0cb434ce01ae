"""Small cases for the tests of the grammar operators: (text, expected result) and small tables."""

from __future__ import annotations

import base64
import json

from pyspark.sql import DataFrame, SparkSession

#: (text, what comes out)
BRACES = [("a}b{c{d}e", "abc{d}e"), (r"\{kept\} {x}}", r"\{kept\} {x}"), (r"\\{y}", r"\\ {y}"), ("}{", ""), ("", "")]
PACKAGES = [(r"\usepackage[o,p]{a,b , c}z", "\\usepackage[o,p]{a}\n\\usepackage[o,p]{b}\n\\usepackage[o,p]{c}z"), ("none", "none"), (r"\usepackage{a}", r"\usepackage{a}")]
ENDS = [(r"A\end{document}B\end{document}C", r"A\end{document}BC"), ("none", "none"), ("", "")]
MATH = [(r"$a \le b$", r"\(a \leq b\)"), ("   ", ""), (r"\[\displaystyle x\]", r"\(x\)"), ("$x % c\ny$", r"\(x  y\)"), (r"$$a \rightarrow b$$", r"\(a \to b\)"), ("$ $", "")]
ESCAPES = [("50% & more_x", r"50\% \& more\_x"), (r"\{a}^~", r"\textbackslash{}\{a\}\^{}\textasciitilde{}"), ("<>#$", r"\textless{}\textgreater{}\#\$")]
EXPANSIONS = [
    (r"\newcommand{\v}[1]{\mathbf{#1}}\begin{document}\v{x} \v y\end{document}", r"\newcommand{\v}[1]{\mathbf{#1}}\begin{document}\mathbf{x} \mathbf{y}\end{document}"),
    (r"\newcommand{\a}{A}\newcommand{\b}{\a\a}\begin{document}\b!\end{document}", r"\newcommand{\a}{A}\newcommand{\b}{\a\a}\begin{document}AA!\end{document}"),
    (r"\newenvironment{n}{<}{>}\begin{document}\begin{n}i\end{n}\end{document}", r"\newenvironment{n}{<}{>}\begin{document}<i>\end{document}"),
    (r"\newcommand{\x}{}\begin{document}a\x b\end{document}", r"\newcommand{\x}{}\begin{document}a b\end{document}"),
    ("", ""),
]
COMMENTS = [("a % note\n  b", "a b"), (r"50\% of % all", r"50\% of "), ("", ""), ("x%\n%y\nz", "xz")]
PREAMBLES = [("\\documentclass{a}\n\\usepackage{b}\n\\begin{document}\nx", "\\documentclass{a}\n\\usepackage{b}\n\\begin{document}\n")]
BIBLIOGRAPHY = [('<ul><li class="ltx_bibitem" id="b1"> A <b>one</b>\n x</li><li>no</li><li class="ltx_bibitem">B</li></ul>', "A one x|B")]
ARTICLES = [
    ('<section class="ltx_section"><h2 class="ltx_title"><span class="ltx_tag ltx_tag_subsection">1.1</span>Intro</h2><p class="ltx_p">See <cite><a class="ltx_ref" href="#bib.bib3">3</a></cite> x<sup>2</sup>.</p></section>', "## Intro\n\nSee [3] x².\n"),
    ('<ol class="ltx_enumerate"><li class="ltx_item">one</li><li class="ltx_item"><p>two</p><p>more</p></li></ol>', "1. one\n2. two more\n"),
    ('<p class="ltx_p">a <math class="ltx_Math" alttext="x\\le y"></math> <em class="ltx_emph ltx_font_italic"> b </em>c</p><div class="ltx_ERROR">no</div>', "a \\(x\\leq y\\) _b_ c\n"),
    ('<dl class="ltx_description"><dt class="ltx_item">T:</dt><dd class="ltx_item">d</dd></dl>', "T: d\n"),
    ('<p>w<span class="ltx_note ltx_role_footnote"><span class="ltx_note_outer"><span class="ltx_note_content"><sup class="ltx_note_mark">1</sup>N.</span></span></span></p>', "w\n\n[FOOTNOTE:1][ENDFOOTNOTE]\n"),
    ("", ""),
]
ARTICLE_TABLES = [
    (
        '<figure class="ltx_table" id="T1"><table class="ltx_tabular"><tr class="ltx_tr"><td class="ltx_td ltx_align_left ltx_border_t ltx_border_r">A&amp;B</td><td class="ltx_td ltx_align_center ltx_border_t">1</td></tr>'
        '<tr class="ltx_tr"><td class="ltx_td ltx_align_left ltx_border_r">C</td><td class="ltx_td ltx_align_center ltx_border_b">2</td></tr></table><figcaption>Cap</figcaption></figure>',
        "\\begin{table}\n\\begin{tabular}{l|c}\n\\hline\nA\\&B & 1 \\\\\nC & 2 \\\\ \\cline{2-2}\n\\end{tabular}\n\\end{table}\nCap",
    ),
    ('<figure class="ltx_figure" id="F1"><img/><figcaption>Shown.</figcaption></figure>', "Shown."),
]
SYMBOLS = [(r"\'{e}\^\i \"u \c{c}", "éî ü ç"), (r"\alpha+\Omega \varphi x", "α+Ωφx"), (r"\mathbf{A1}\mathbb{R}\mathit{h}\mathfrak{C}", "𝐀𝟏ℝℎℭ"), (r"\alphabet", r"\alphabet"), ("", "")]
DOCUMENT = r"""\documentclass{article}
\title{On Things}
\author{A. Writer}
\begin{document}
\begin{abstract}Short text.\end{abstract}
\section{First}
Words with $x+y$ and \emph{more}. % a note

\begin{equation}a=b\end{equation}
\begin{figure}\includegraphics[width=1cm]{f.png}\caption{A figure.}\end{figure}
\subsection{Second}
\begin{itemize}\item one \item two\end{itemize}
\end{document}
"""


def inputs(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame([(a,) for a, _ in rows], "text string")


def names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n,) for n in ("title", "titlepage", "frontAuthor", "Abstract", "keywords", "mysection", "footnotes", "figcaption", "enumerate", "itemize", "description", "quote")], "name string")


def macros(spark: SparkSession) -> DataFrame:
    found = ("title", "shorttitle", "author", "institute", "abstract", "keywords", "footnote", "thanks", "caption", "section", "subsection", "chapter", "part", "textbf", "emph")
    return spark.createDataFrame([(n,) for n in found], "name string")


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, DOCUMENT), (2, ""), (3, None)], "doc_id long, text string")


def logs(spark: SparkSession) -> DataFrame:
    """1: two passes, the last stops; 2: a file that failed, and no pass; 3: a pass that stops after one that doesn't, with outputs."""
    begin = "[verbose]:  ~~~~~~~~~~~ "
    passes = lambda name: f"{begin}Running {name} for the first time ~~~~~~~~\n"
    read = lambda name: f"{begin}Processing file '{name}'\n"
    first = passes("alpha") + "(a.tex)\n" + passes("beta") + "! Emergency stop.\nl.9\n"
    second = read("one.tex") + read("one.dvi") + read("two words.tex") + "<two words.tex> appears to be tex-type, but was neither included nor processable:\n"
    third = passes("beta") + "fine\n" + passes("alpha") + " ! Emergency stop.\n! Emergency stop.\nGenerated PDF: a.pdf<end of PDF name>\nGenerated PDF: b c.pdf<end of PDF name>\nGenerated PostScript: m.ps<end of PostScript name>\n"
    return spark.createDataFrame([(1, first), (2, second), (3, third)], "doc_id long, log string")


def keys(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, k) for i, k in enumerate(["frac{}{}", "frac{}", "sqrt[]{}", "sqrt{}", "item[]", "item", "put(){}", "low_{}", "named{x}"])], "ord int, key string")


def responses(spark: SparkSession) -> DataFrame:
    pdf = base64.b64encode(b"pdf one").decode()
    rows = [
        (1, {"success": True, "has_output": True, "output": [{"type": "html", "path": "h", "contents": ""}, {"type": "pdf", "path": "p", "contents": pdf}]}),
        (2, {"success": False, "has_output": False, "log": "x", "output": [{"type": "pdf", "path": "p", "contents": pdf}]}),
        (3, {"success": True, "has_output": False, "output": []}),
    ]
    return spark.createDataFrame([(i, json.dumps(r)) for i, r in rows], "doc_id long, body string")


def members(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    wanted = spark.createDataFrame([(1, "main"), (1, "b.tex"), (1, "c")], "doc_id long, name string")
    have = spark.createDataFrame([(1, "main.tex"), (1, "main.latex"), (1, "b.tex"), (2, "c")], "doc_id long, member string")
    return wanted, have
