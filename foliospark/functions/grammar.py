r"""What macros and environments take: a base, what packages add, and what a document's own definitions add.

Signs of an argument: `*` a star, `[` an optional bracket group, `{` a group or one token. The base is plain LaTeX;
further ones are rows of a catalogue (package, kind, name, args), so a document's grammar is a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.operators import catalogues

#: Macros of plain LaTeX by their arguments.
MACROS = {
    "": "LaTeX TeX appendix bigskip centering clearpage cleardoublepage footnotesize hfill Huge huge indent labelwidth LARGE Large large linewidth listoffigures listoftables maketitle medskip newline newpage noindent normalsize par"
    " printbibliography quad qquad scriptsize small smallskip tableofcontents textwidth tiny today vfill vskip ldots dots alpha beta gamma delta epsilon lambda mu pi sigma theta omega",
    "*": "",
    "*[": "\\",
    "*[{": "author chapter lstinputlisting part section subsection subsubsection paragraph subparagraph",
    "*{": "hspace vspace",
    "*{[[{": "renewcommand providecommand newcommand",
    "*{[[{{": "renewenvironment provideenvironment newenvironment",
    "*{{": "DeclareMathOperator newtheorem",
    "[": "item pagebreak linebreak",
    "[{": "caption cite citep citet documentclass footnote footnotetext includegraphics RequirePackage selectlanguage sqrt title usepackage",
    "[{{": "colorbox textcolor",
    "[{[{{": "fcolorbox",
    "{": "address bibliography bibliographystyle bfseries ce date emph eqref ensuremath fbox hat include input keywords label mathbb mathbf mathcal mathfrak mathit mathrm mathsf mathtt mbox overline pageref ref text textbf textit textmd textrm textsc"
    " textsf textsl texttt textup thanks thispagestyle pagestyle tilde underline url vec widehat widetilde bibitem institute email affiliation abstract",
    "{{": "scalebox titlearea addcounter addlength frac href nicefrac setcounter setlength textfrac",
    "{{{": "multicolumn multirow resizebox",
}
#: Environments of plain LaTeX by their arguments.
ENVIRONMENTS = {
    "": "abstract align align* center description displaymath document enumerate eqnarray eqnarray* equation equation* flushleft flushright gather gather* itemize math multline multline* quote quotation titlepage verse verbatim",
    "[": "figure figure* table table* theorem lemma proof corollary definition example remark algorithm proposition",
    "[{": "tabular minipage array",
    "{": "thebibliography multicols longtable tabbing",
    "{[{": "tabular*",
}
CALL = r"\\(usepackage|RequirePackage|documentclass)\s*(?:\[[^\]]*\])?\s*\{([^}]*)\}"


def names(table: dict[str, str]) -> dict[str, str]:
    return {name: args for args, all_of in table.items() for name in all_of.split()}


def base(spark: SparkSession) -> DataFrame:
    """kind (cmds or envs), name, args of the base."""
    rows = [(kind, name, args) for kind, table in (("cmds", MACROS), ("envs", ENVIRONMENTS)) for name, args in names(table).items()]
    return spark.createDataFrame(rows, "kind string, name string, args string")


def entries(packages: DataFrame) -> DataFrame:
    """package, kind, name, args of package files (package, cmds map, envs map): see longest_arguments."""
    out = None
    for kind in ("cmds", "envs"):
        keys = packages.where(F.col(kind).isNotNull()).select("package", F.posexplode(F.map_keys(kind)).alias("ord", "key"))
        parts = catalogues.longest_arguments(keys.select(F.struct("package", "ord").alias("ord"), F.col("key")), by=("package",)).withColumn("kind", F.lit(kind))
        out = parts if out is None else out.unionByName(parts)
    return out.select("package", "kind", "name", "args")


def loaded(docs: DataFrame) -> DataFrame:
    """doc_id, package: what texts (doc_id, text) load themselves; a document class is class-<name>."""
    calls = docs.select("doc_id", F.explode(F.arrays_zip(F.regexp_extract_all("text", F.lit(CALL), F.lit(1)).alias("how"), F.regexp_extract_all("text", F.lit(CALL), F.lit(2)).alias("what"))).alias("c"))
    each = calls.select("doc_id", "c.how", F.explode(F.split("c.what", ",")).alias("name")).withColumn("name", F.trim("name")).where("name <> ''")
    return each.select("doc_id", F.when(F.col("how") == "documentclass", F.concat(F.lit("class-"), "name")).otherwise(F.col("name")).alias("package")).distinct()


def context(docs: DataFrame, catalogue: DataFrame, includes: DataFrame) -> DataFrame:
    """docs (doc_id, text) with macros and environments, maps of name to arguments: what the packages that a document
    loads, and those that these include, add to the base. catalogue: package, kind, name, args; includes: package, includes.

    Of definitions of one name in several packages the one of the first package by name counts."""
    own = loaded(docs)
    reach = catalogues.closure(includes)
    every = own.unionByName(own.join(reach.withColumnRenamed("package", "inner"), F.expr("package = root")).select("doc_id", F.col("inner").alias("package"))).distinct()
    first = every.join(catalogue, "package").groupBy("doc_id", "kind", "name").agg(F.min_by("args", "package").alias("args"))
    pick = lambda kind: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("name", "args")))))
    found = first.groupBy("doc_id").agg(pick("cmds").alias("macros"), pick("envs").alias("environments"))
    none = F.create_map().cast("map<string,string>")
    return docs.join(found, "doc_id", "left").withColumns({c: F.coalesce(c, none) for c in ("macros", "environments")})
