r"""A compact TeX reader: expansion of private macros, and a walk that labels what is in a document.

State is a document's own; nothing is kept from one to the next.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliospark.functions import arrow, textclean
from foliospark.functions.grammar import ENVIRONMENTS, MACROS, names
from foliospark.operators.labels import ENVIRONMENTS as ROLES
from foliospark.operators.labels import SPOKEN

PLACEHOLDER = textclean.PLACEHOLDER

TOKEN = re.compile(r"%[^\n]*\n?\s*|\\[A-Za-z@]+|\\.|[\s\S]", re.S)
DEFINERS = {"\\newcommand", "\\renewcommand", "\\newenvironment", "\\renewenvironment"}


def tokenize(text: str) -> list[str]:
    """Comments (with the blanks after them), control words, control symbols and characters."""
    return TOKEN.findall(text)


def strip_comments(tokens: list[str]) -> list[str]:
    return [t for t in tokens if not t.startswith("%")]


WORD = re.compile(r"\\[A-Za-z@]+")


def controls(tokens: list[str]) -> list[int]:
    """The places of control words and symbols."""
    return [i for i, t in enumerate(tokens) if t[0] == "\\"]


def join(tokens: list[str]) -> str:
    out, at = [], 0
    for i in controls(tokens):
        if i + 1 < len(tokens) and tokens[i + 1][:1].isalpha() and WORD.fullmatch(tokens[i]):
            out += tokens[at : i + 1]
            out.append(" ")
            at = i + 1
    return "".join(out + tokens[at:])


@dataclass
class Definition:
    args: int
    body: list[str]
    end: list[str] | None = None


class Expander:
    """Expands the commands and environments that a text defines itself, within the document body."""

    def __init__(self, depth: int = 64):
        self.commands: dict[str, Definition] = {}
        self.environments: dict[str, Definition] = {}
        self.depth = depth

    @staticmethod
    def skip(t, i):
        while i < len(t) and (t[i].isspace() or t[i].startswith("%")):
            i += 1
        return i

    def group(self, t, i):
        """(content, next) of a braced group, or of the single token at i."""
        i = self.skip(t, i)
        if i >= len(t):
            return None, i
        if t[i] != "{":
            return [t[i]], i + 1
        level, j = 1, i + 1
        while j < len(t):
            level += (t[j] == "{") - (t[j] == "}")
            if not level:
                return t[i + 1 : j], j + 1
            j += 1
        return None, len(t)

    def define(self, t, i):
        """Next position after a definition at i, or None if it is malformed."""
        kind = t[i]
        i = self.skip(t, i + 1)
        if i < len(t) and t[i] == "*":
            i += 1
        name, i = self.group(t, i)
        if not name:
            return None
        args, i = 0, self.skip(t, i)
        if i < len(t) and t[i] == "[":
            if i + 2 >= len(t) or t[i + 1] not in "123456789" or t[i + 2] != "]":
                return None
            args, i = int(t[i + 1]), i + 3
        body, i = self.group(t, i)
        if body is None:
            return None
        name = "".join(name).strip()
        if kind.endswith("command"):
            if name.startswith("\\") and "@" not in name and name not in body:
                self.commands[name] = Definition(args, body)
            return i
        end, i = self.group(t, i)
        if end is None:
            return None
        self.environments[name] = Definition(args, body, end)
        return i

    def fill(self, body, values):
        out, i = [], 0
        while i < len(body):
            if body[i] == "#" and i + 1 < len(body) and body[i + 1].isdigit() and 0 < int(body[i + 1]) <= len(values):
                out += values[int(body[i + 1]) - 1]
                i += 2
            else:
                out.append(body[i])
                i += 1
        return out

    def expand(self, t, level=0):
        out, i = [], 0
        for at in controls(t):
            token = t[at]
            if at < i:
                continue
            if token in DEFINERS:
                j = self.define(t, at) or at + 1
                out += t[i:j]
                i = j
            elif token in self.commands and level < self.depth:
                out += t[i:at]
                d, i, values = self.commands[token], at + 1, []
                for _ in range(d.args):
                    value, i = self.group(t, i)
                    values.append(value or [])
                out += self.expand(self.fill(d.body, values), level + 1)
            elif token == "\\begin" and level < self.depth:
                name, j = self.group(t, at + 1)
                d = self.environments.get("".join(name or []))
                if d:
                    out += t[i:at]
                    values = []
                    for _ in range(d.args):
                        value, j = self.group(t, j)
                        values.append(value or [])
                    stop, nested = j, 1
                    while stop < len(t):
                        if t[stop] in ("\\begin", "\\end"):
                            other, after = self.group(t, stop + 1)
                            if other == name:
                                nested += 1 if t[stop] == "\\begin" else -1
                                if not nested:
                                    break
                        stop += 1
                    inner = t[j:stop]
                    i = after if stop < len(t) else stop
                    out += self.expand(self.fill(d.body, values) + inner + self.fill(d.end, values), level + 1)
        return out + t[i:]

    def run(self, text: str) -> str:
        if "\\new" not in text and "\\renew" not in text and text.isascii():
            return text  # no definitions, and no letter that a control word could run into
        t = tokenize(text)
        marks = controls(t)
        begin = next((i for i in marks if t[i] == "\\begin" and "".join(t[i + 1 : i + 11]) == "{document}"), None)
        i, head = 0, len(t) if begin is None else begin
        for at in marks:
            if at >= head:
                break
            if at >= i and t[at] in DEFINERS:
                i = self.define(t, at) or at + 1
        if begin is None:
            return join(self.expand(t))
        return join(t[:begin]) + join(self.expand(t[begin:]))


@F.pandas_udf(T.StringType())
def expand_macros(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else Expander().run(t) if t else "")


def take_out(text: str) -> tuple[str, dict[str, str]]:
    """Definitions replaced by numbered placeholders, and the definitions by number."""
    if "\\new" not in text and "\\renew" not in text:
        return text, {}
    tokens, out, held, i = tokenize(text), [], {}, 0
    for at in controls(tokens):
        stop = Expander().define(tokens, at) if at >= i and tokens[at] in DEFINERS else None
        if stop:
            out += tokens[i:at]
            out.append(f"\\{PLACEHOLDER}{{{len(held)}}}\n")
            held[str(len(held))] = "".join(tokens[at:stop])
            i = stop
    return "".join(out + tokens[i:]), held


def cleaned(text: str) -> tuple[str, dict[str, str]]:
    """Braces balanced, a line for each package, own macros expanded, definitions taken out, and one end of the document."""
    call = re.compile(r"\\usepackage(\[[^\]]*\])?\{([^}]*)\}")
    text = call.sub(lambda m: "\n".join(f"\\usepackage{m[1] or ''}{{{name.strip()}}}" for name in m[2].split(",")), textclean.balanced(text))
    text, held = take_out(Expander().run(text))
    head, end, rest = text.partition("\\end{document}")
    return head + end + rest.replace("\\end{document}", ""), held


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("removed", T.MapType(T.StringType(), T.StringType()))]))
def clean(text: pd.Series) -> pd.DataFrame:
    """A document ready for the walk: text, and the definitions that were taken out of it, by number (removed)."""
    return pd.DataFrame([(None, {}) if t is None else cleaned(t) for t in text], columns=["text", "removed"])


LEVELS = {"title": 0, "part": 1, "chapter": 2, "section": 3, "subsection": 4, "subsubsection": 5, "paragraph": 6, "subparagraph": 7}


#: Macros that stay as they are and whose arguments no label has.
QUIET = {"usepackage", "documentclass", "label", "ref", "eqref", "pageref", "cite", "citep", "citet", "input", "include", "newcommand", "renewcommand", "providecommand", "newenvironment", "renewenvironment", "end", "bibliographystyle", "setlength", "setcounter", "addlength", "addcounter"}
FORMULAS = {"equation", "align", "gather", "eqnarray", "multline", "displaymath", "math"}


def label_of_environment(name: str | None) -> str | None:
    """The label of the first role that a part of the name speaks of."""
    if name is None:
        return None
    return next((label for parts, label in ROLES if any(p in name.lower() for p in parts)), "Paragraph")


_MACROS, _ENVIRONMENTS = names(MACROS), names(ENVIRONMENTS)

#: (text, at, end) -> ([(sign, first, end)], end).
Parser = Callable[[str, int, int], tuple[list[tuple[str, int, int]], int]]


class Walker:
    """Rows (pos, pos_end, kind, name, label, section, block, reading) of the words, formulas and figures of a document.

    What a macro takes is looked up in the document's grammar, which its own \newcommand and \newenvironment extend
    for what follows. Of a macro that isn't in it, the groups that follow are its own and get no label.

    parsers: for a macro a function (text, at, end) that gives its arguments, as (sign, first, end), and where they end."""

    def __init__(self, macros: dict[str, str] | None = None, environments: dict[str, str] | None = None, parsers: dict[str, Parser] | None = None):
        self.rows, self.block, self.section, self.reading = [], 0, 0, 0
        self.macros = _MACROS | dict(macros or {})
        self.environments = _ENVIRONMENTS | dict(environments or {})
        self.parsers = parsers or {}

    def emit(self, a, b, kind, name, label):
        order = -1 if label is None else self.reading
        self.reading += label is not None
        self.rows.append((a, b, kind, name, label, self.section, self.block, order))

    PIECE = re.compile(r"%[^\n]*|\n[ \t]*\n|\\begin\s*\{([^}]*)\}|\\([A-Za-z@]+)\*?|\\.|\$\$?|[{}]|[^\s\\${}%]+", re.S)

    def walk(self, text: str, at: int, end: int, label: str | None):
        while at < end:
            m = self.PIECE.search(text, at, end)
            if not m:
                return
            at = m.end()
            s = m[0]
            if s.startswith("%") or s in "{}":
                continue
            if s.startswith("\n"):
                self.block += label is not None
            elif m[1] is not None:
                at = self.environment(text, m, end, label)
            elif m[2]:
                at = self.macro(text, m, end, label)
            elif s[0] == "$":
                close = text.find(s, at, end)
                close = end if close < 0 else close
                self.emit(m.start(), min(end, close + len(s)), "math", None, label and "Equation")
                at = min(end, close + len(s))
            elif s[0] != "\\":
                self.emit(m.start(), m.end(), "text", None, label)

    def environment(self, text, m, end, label):
        name = m[1]
        stop, nested = end, 1
        for x in re.compile(r"\\(begin|end)\s*\{" + re.escape(name) + r"\}").finditer(text, m.end(), end):
            nested += 1 if x[1] == "begin" else -1
            if not nested:
                stop, after = x.span()
                break
        else:
            after = end
        begin = self.arguments(text, m.end(), stop, self.environments.get(name, ""))[1]
        self.block += label is not None
        if name == "document":
            self.walk(text, begin, stop, "Paragraph")
        elif name.rstrip("*") in FORMULAS:
            self.emit(m.start(), after, "math", name, "Equation")
        elif "bibliography" in name:
            self.section += 1
            self.walk(text, begin, stop, "Reference")
        elif any(p in name for p in ("tikz", "forest")):
            self.emit(m.start(), after, "figure", name, "Figure")
        elif name != "CCSXML":
            inner = "Table" if any(p in name for p in ("tabular", "tabbing", "longtable")) else "Paragraph" if name.startswith("algorithm") else None
            self.walk(text, begin, stop, inner or (label_of_environment(name) if label in (None, "Paragraph") else label))
        self.block += label is not None
        return after

    BLANK = re.compile(r"(?:[ \t]|\n(?![ \t]*\n)|%[^\n]*\n?)*")

    SIGNS = {"[": re.compile(r"\\.|[\[\]]", re.S), "{": re.compile(r"\\.|[{}]", re.S)}
    ONE = re.compile(r"\\[A-Za-z@]+|\\.|.", re.S)

    def group(self, text, at, end):
        """The end of the group that opens at `at`, or None."""
        opened, level = text[at], 0
        for m in self.SIGNS[opened].finditer(text, at, end):
            if m[0][0] != "\\":
                level += 1 if m[0] == opened else -1
                if not level:
                    return m.start()
        return None

    def arguments(self, text, at, end, args: str | None):
        """(sign, first, end) of each argument from `at`, and where they end. args None: all groups that follow."""
        found, signs = [], iter(args or "")
        while True:
            sign = next(signs, None) if args is not None else None
            if args is not None and sign is None:
                return found, at
            here = self.BLANK.match(text, at, end).end()
            c = text[here : min(here + 1, end)]
            if sign == "*":
                at = here + 1 if c == "*" else at
            elif c and c in "[{" and (sign is None or c == sign):
                stop = self.group(text, here, end)
                if stop is None:
                    return found, at
                found.append((c, here + 1, stop))
                at = stop + 1
            elif sign == "{" and c and c not in "}]":
                token = self.ONE.match(text, here, end)
                found.append(("{", token.start(), token.end()))
                at = token.end()
            elif sign != "[":
                return found, at

    def define(self, text, spans, table):
        """What a definition adds to the grammar: a group for each argument that it names, after an optional one."""
        groups = [text[a:b].strip() for c, a, b in spans if c == "{"]
        number = next((text[a:b].strip() for c, a, b in spans if c == "["), "")
        if groups and "@" not in groups[0]:
            table[groups[0].lstrip("\\")] = "[" + "{" * int(number) if number.isdigit() else ""

    def macro(self, text, m, end, label):
        name = m[2]
        if name in self.parsers:
            spans, after = self.parsers[name](text, m.end(), end)
        elif name not in self.macros:
            return self.arguments(text, m.end(), end, None)[1]
        else:
            signs = self.macros[name]
            spans, after = self.arguments(text, m.end(), end, signs.removeprefix("*") if m[0].endswith("*") else signs)
        if name in ("newcommand", "newenvironment"):
            self.define(text, spans, self.macros if name == "newcommand" else self.environments)
        if name == "vskip":
            return re.compile(r"\s*-?[\d.]*\s*(?:[a-z]{2}(?![a-z])|\\[A-Za-z]+)?").match(text, after, end).end()
        groups = [(a, b) for c, a, b in spans if c == "{"]
        if name == "par":
            self.block += 1
        elif name == "includegraphics":
            self.emit(m.start(), after, "figure", name, "Figure")
        elif name in LEVELS and LEVELS[name] < 6:
            self.section += 1
            if groups:
                self.walk(text, *groups[-1], "Title" if name == "title" else "Section")
            self.block += name == "title" and label is not None
        elif name in ("lstinputlisting", "ce"):
            self.emit(m.start(), after, "math", name, "Equation")
            self.block += name != "ce" and label is not None
        elif name == "titlearea":
            self.section += 1
            for (a, b), to in zip(groups, ("Title", "Author"), strict=False):
                self.walk(text, a, b, to)
            self.block += label is not None
        elif "bibliography" in name and name != "bibliographystyle":
            self.section += 1
            self.emit(m.start(), after, "macro", name, "Reference")
            self.block += label is not None
        elif name not in QUIET:
            role = "Caption" if name == "caption" else next((to for parts, to in SPOKEN if any(p in name for p in parts) and "short" not in name), None)
            # a role is that of the last argument; other macros hand their label on to all of them
            for a, b in groups[-1:] if role or name in ("scalebox", "resizebox") else groups:
                self.walk(text, a, b, role or label)
            self.block += role in ("Author", "Abstract") and label is not None
        return after


def parse_latex(docs: DataFrame, parsers: dict[str, Parser] | None = None, texts: bool = False) -> DataFrame:
    """doc_id, pos, pos_end, kind, name, label, section, block, reading of every document's nodes; with texts also text, what
    is written from pos to pos_end.

    docs: doc_id, text and, if their packages are known, macros and environments (see grammar.context)."""
    grammar = [c for c in ("macros", "environments") if c in docs.columns]

    def nodes(batches):
        for doc, text, *added in arrow.rows_of(batches, "doc_id", "text", *grammar):
            w = Walker(**dict(zip(grammar, added, strict=True)), parsers=parsers)
            text = text or ""
            w.walk(text, 0, len(text), None)
            for row in w.rows:
                yield (doc, *row, text[row[0] : row[1]]) if texts else (doc, *row)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, pos int, pos_end int, kind string, name string, label string, section int, block int, reading int" + ", text string" * texts
    types = to_arrow_schema(T._parse_datatype_string(schema))
    return docs.select("doc_id", "text", *grammar).mapInArrow(lambda batches: arrow.batched(nodes(batches), types), schema)


@functools.lru_cache(1 << 16)
def _opening(kind: str, key: str) -> str:
    """What stands before a word in a colour, to be closed by a brace."""
    return f"\\colorbox[rgb]{{{key}}}{{" if kind == "figure" else f"{{\\color[RGB]{{{int(key[1:3], 16)}, {int(key[3:5], 16)}, {int(key[5:7], 16)}}}"


def painted(text: str, rows: list[dict]) -> str:
    """The text with its rows (pos, pos_end, kind, color_key, in order of pos) in their colours; without a colour a row stays as it is."""
    out, last = [], 0
    for x in rows:
        a, b, key = x["pos"], x["pos_end"], x["color_key"]
        if key is not None:
            out += (text[last:a], _opening(x["kind"], key), text[a:b], "}")
            last = b
    return "".join(out) + text[last:]


def colored_documents(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs, of which every text (doc_id, text) has its labelled rows (doc_id, pos, pos_end, kind, color_key) in their colour:
    words and formulas by \\color, figures by \\colorbox. The rest of a text stays as it is."""
    live = rows.where("label IS NOT NULL").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "pos_end", "kind", "color_key"))).alias("all"))
    joined = docs.join(live, "doc_id", "left")
    kept = [c for c in docs.columns if c != "text"]
    types = to_arrow_schema(joined.select(*kept, "text").schema)

    def paint(batches):
        for *own, text, rows in arrow.rows_of(batches, *kept, "text", "all"):
            yield *own, painted(text, rows) if text and rows else text

    return joined.select(*kept, "text", "all").mapInArrow(lambda batches: arrow.batched(paint(batches), types), joined.select(*kept, "text").schema)


def painted_documents(docs: DataFrame, keys: Broadcast) -> DataFrame:
    """colored_documents with the walk in the same pass; keys: the colours by reading."""
    grammar = [c for c in ("macros", "environments") if c in docs.columns]
    kept = [c for c in docs.columns if c not in ("text", *grammar)]
    schema = docs.select(*kept, "text").schema
    types = to_arrow_schema(schema)

    def paint(batches):
        held = keys.value
        for *own, text, added in ((*r[: len(kept) + 1], r[len(kept) + 1 :]) for r in arrow.rows_of(batches, *kept, "text", *grammar)):
            w = Walker(**dict(zip(grammar, added, strict=True)))
            w.walk(text or "", 0, len(text or ""), None)
            rows = sorted((a, b, kind, held.get(n)) for a, b, kind, _, label, _, _, n in w.rows if label is not None)
            yield *own, painted(text, [dict(zip(("pos", "pos_end", "kind", "color_key"), r, strict=True)) for r in rows]) if text else text

    return docs.select(*kept, "text", *grammar).mapInArrow(lambda batches: arrow.batched(paint(batches), types), schema)
