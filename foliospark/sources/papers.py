r"""Papers of several files: which file includes which, one text of them, and the walk over whole papers.

Members are rows (doc_id, member, text). A paper's files meet in one row of a paper's size; papers never meet.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliospark.functions import arrow, grammar, latex, textclean

INCLUDE = r"\\(?:input|include)\s*\{\s*([^}]*?)\s*\}"
CALL = re.compile(INCLUDE, re.ASCII)
#: Colours that are taken to the documents; the words go to more of them.
HELD = 1 << 18
#: Endings of a name for which a file is looked for, in order.
ENDINGS = ("", ".tex", ".latex")


def calls(members: DataFrame) -> DataFrame:
    """doc_id, files: of each member of a paper its name (member), the names that it includes, in order, and whether it has a \\documentclass."""
    own = members.select("doc_id", F.struct("member", F.regexp_extract_all("text", F.lit(INCLUDE), F.lit(1)).alias("names"), F.col("text").contains("\\documentclass").alias("main")).alias("f"))
    return own.groupBy("doc_id").agg(F.collect_list("f").alias("files"))


def resolved(files: list[dict]) -> list[tuple[str, int, str, str]]:
    """(member, n, name, included) of every include of a paper's files."""
    have = {f["member"] for f in files}
    means = functools.cache(lambda name: next((name + e for e in ENDINGS if name + e in have), ""))
    return [(f["member"], n, name, means(name)) for f in files for n, name in enumerate(f["names"] or ())]


def root_of(files: list[dict], found: list[tuple]) -> str | None:
    """The first file by name that has a \\documentclass and that none includes, else the first that has one."""
    inner = {included for *_, included in found}
    return min(((f["member"] in inner, f["member"]) for f in files if f["main"]), default=(None, None))[1]


def below(root: str, found: list[tuple]) -> dict[str, None]:
    """root and what it includes, directly or not."""
    step, seen, todo = {}, {root: None}, [root]
    for member, _, _, included in found:
        if included:
            step.setdefault(member, []).append(included)
    while todo:
        fresh = [x for x in step.get(todo.pop(), ()) if x not in seen]
        seen |= dict.fromkeys(fresh)
        todo += fresh
    return seen


def _each(papers: DataFrame, rows, columns: str) -> DataFrame:
    """Rows that a function of a paper's files gives, doc_id before them."""
    schema = f"doc_id {papers.schema['doc_id'].dataType.simpleString()}, {columns}"
    types = to_arrow_schema(T._parse_datatype_string(schema))
    made = lambda batches: ((doc, *row) for doc, files in arrow.rows_of(batches, "doc_id", "files") for row in rows(files))
    return papers.where("doc_id IS NOT NULL").select("doc_id", "files").mapInArrow(lambda batches: arrow.batched(made(batches), types), schema)


def includes(members: DataFrame) -> DataFrame:
    """doc_id, member, n, name, included: every \\input and \\include of a file, and the file that it means ('' if none)."""
    return _each(calls(members), resolved, "member string, n int, name string, included string")


def roots(members: DataFrame) -> DataFrame:
    """doc_id, root: the first file by name that has a \\documentclass and that no other file includes, else the first that has one."""

    def rows(files):
        root = root_of(files, resolved(files))
        return [] if root is None else [(root,)]

    return _each(calls(members), rows, "root string")


def reached(members: DataFrame) -> DataFrame:
    """doc_id, member: the files that a paper's root includes, directly or not, itself too."""

    def rows(files):
        found = resolved(files)
        root = root_of(files, found)
        return [] if root is None else [(m,) for m in below(root, found)]

    return _each(calls(members), rows, "member string")


def inline(files: dict[str, str], root: str, above: tuple[str, ...] = ()) -> str:
    """The text of root with the texts of what it includes in their places; what isn't there, or includes itself, stays as it is."""

    def put(m):
        name = next((m[1] + e for e in ENDINGS if m[1] + e in files), None)
        return m[0] if name is None or name == root or name in above else inline(files, name, (*above, root))

    return re.sub(INCLUDE, put, files[root])


def inlined(members: DataFrame) -> DataFrame:
    """doc_id, root, text: one text of each paper that has a root."""
    own = members.select("doc_id", F.struct("member", F.coalesce("text", F.lit("")).alias("text")).alias("f")).groupBy("doc_id").agg(F.collect_list("f").alias("files"))

    def rows(files):
        texts = {f["member"]: f["text"] for f in files}
        if len(texts) < len(files):
            raise ValueError("a paper has two files of one name")
        plain = [{"member": m, "names": CALL.findall(t), "main": "\\documentclass" in t} for m, t in texts.items()]
        root = root_of(plain, resolved(plain))
        return [] if root is None else [(root, inline(texts, root))]

    return _each(own, rows, "root string, text string")


def ready(members: DataFrame, catalogue: DataFrame | None = None, packages: DataFrame | None = None) -> DataFrame:
    """doc_id, root, text, removed and, with a catalogue of packages, macros and environments: papers ready for the walk."""
    docs = inlined(members).select("doc_id", "root", latex.clean(F.col("text")).alias("c")).select("doc_id", "root", "c.text", "c.removed")
    return docs if catalogue is None else grammar.context(docs, catalogue, packages)


def annotated(docs: DataFrame, colors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Papers from ready() with their labelled rows in colour: (rows with color_key, doc_id and text with the definitions back).

    colors: reading, color_key: the colour of the n-th labelled row; figures take theirs as they are given."""
    rows = latex.parse_latex(docs).join(colors, "reading", "left")
    few = colors.select("reading", "color_key").limit(HELD + 1).collect()
    keys = {r["reading"]: r["color_key"] for r in few}
    if len(keys) == len(few) <= HELD:  # small enough for each worker: no word leaves its document
        painted = latex.painted_documents(docs.drop("root"), docs.sparkSession.sparkContext.broadcast(keys))
    else:
        painted = latex.colored_documents(docs.select("doc_id", "removed", "text"), rows)
    return rows, painted.select("doc_id", textclean.restore_placeholders(F.col("text"), F.col("removed")).alias("text"))
