"""Semantic roles by names of environments and macros: cascades, the first match wins."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values: (parts of a name, label), in order.
ENVIRONMENTS = (
    (("title",), "Title"), (("author", "address"), "Author"), (("abstract", "keyword"), "Abstract"), (("section",), "Section"),
    (("footnote",), "Footer"), (("caption",), "Caption"), (("enum", "list", "itemize", "desc"), "List"),
)
#: Fixed values: (parts of a macro's name, label of its arguments).
SPOKEN = ((("author", "address", "institut", "affiliat"), "Author"), (("abstract", "keyword"), "Abstract"), (("footnote", "thanks"), "Footer"))
PALETTE = ("Abstract", "Author", "Caption", "Equation", "Figure", "Footer", "List", "Paragraph", "Reference", "Section", "Table", "Title")


def _any(name: Column, parts) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | name.contains(p)
    return out


def by_environment(name: Column) -> Column:
    low = F.lower(name)
    out = F.when(name.isNull(), F.lit(None).cast("string"))
    for parts, label in ENVIRONMENTS:
        out = out.when(_any(low, parts), label)
    return out.otherwise("Paragraph")


def by_macro(name: Column, current: Column) -> Column:
    """Label that a macro gives its arguments; other macros keep the current label."""
    short = name.contains("short")
    author, abstract, footer = (_any(name, parts) for parts, _ in SPOKEN)
    return (
        F.when(name.contains("title") & ~short, "Title")
        .when(author & ~short, "Author")
        .when(abstract, "Abstract")
        .when(footer, "Footer")
        .when(name == "caption", "Caption")
        .when(name.contains("section") | name.isin("chapter", "part"), "Section")
        .otherwise(current)
    )


def by_kind(name: Column, math: Column, parent: Column) -> Column:
    """Label of an environment's content by its kind."""
    return (
        F.when(math, "Equation").when(name.contains("bibliography"), "Reference").when(_any(name, ("tikz", "forest")), "Figure")
        .when(_any(name, ("tabular", "tabbing", "longtable")), "Table").when(name.startswith("algorithm"), "Paragraph")
        .when(parent.isNull() | (parent == "Paragraph"), by_environment(name)).otherwise(parent)
    )


def normal_label(label: Column) -> Column:
    return F.coalesce(F.lower(label), F.lit("none"))


def skipped(macro: Column, documentclass: Column) -> Column:
    """Macros whose arguments stay uncoloured in some document classes."""
    affiliation = (macro == "affiliation") & documentclass.isin("revtex4-2", "elsarticle", "cas-dc")
    return F.coalesce(affiliation | ((macro == "author") & F.lit("WileyNJD").contains(documentclass)), F.lit(False))
