r"""Plain text of TeX: macros as templates over their arguments, the rest without its braces.

A template's {1}, {2}.. are the arguments in braces, ^ before one means capitals. What a macro takes is the
grammar's; a macro without a template gives the text of its arguments, one that takes none gives nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions.grammar import ENVIRONMENTS, MACROS, names
from foliospark.functions.latex import Walker
from foliospark.functions.symbols import unicode_text

#: Text of macros.
TEMPLATES = {
    "url": "<{1}>", "item": "\n  * ", "footnote": "[{1}]", "footnotetext": "[{1}]", "caption": "{1}", "href": "{2} <{1}>", "part": "\n\nPART: {^1}\n", "chapter": "\n\nCHAPTER: {^1}\n", "section": "\n\n§ {^1}\n",
    "subsection": "\n\n §.§ {1}\n", "subsubsection": "\n\n  §.§.§ {1}\n", "paragraph": "\n\n  {1}\n", "subparagraph": "\n\n    {1}\n", "textcolor": "{2}", "colorbox": "{2}", "fcolorbox": "{3}", "hspace": "", "vspace": "\n", "\\": "\n",
    "frac": "{1}/{2}", "nicefrac": "{1}/{2}", "textfrac": "{1}/{2}", "title": "", "author": "", "date": "",
}
#: Macros of which text says nothing.
SILENT = {"usepackage", "documentclass", "label", "bibliographystyle", "setlength", "setcounter", "newcommand", "renewcommand", "newenvironment", "renewenvironment", "includegraphics", "RequirePackage", "thispagestyle", "pagestyle"}
GROUP = re.compile(r"\{(\^?)(\d)\}")


class Renderer:
    """templates: more of them, or a function of (groups, options) in the place of one; macros: what more of them take."""

    def __init__(self, templates: dict[str, str | Callable[[list[str], list[str]], str]] | None = None, macros: dict[str, str] | None = None):
        self.macros, self.environments = names(MACROS) | (macros or {}), names(ENVIRONMENTS)
        self.templates = TEMPLATES | (templates or {})
        self.kept: dict[str, str] = {}
        self.reader = Walker()

    def title(self) -> str:
        """The heading that \\maketitle makes of title, author and date."""
        lines = [self.kept.get("title", "[NO \\title GIVEN]"), *("    " + self.kept.get(k, f"[NO \\{k} GIVEN]") for k in ("author", "date"))]
        return "\n".join(lines) + "\n" + "=" * max(map(len, lines)) + "\n\n"

    def fill(self, template: str, groups: list[str]) -> str:
        def one(m):
            value = groups[int(m[2]) - 1] if int(m[2]) <= len(groups) else ""
            return value.upper() if m[1] else value

        return GROUP.sub(one, template)

    def macro(self, name: str, groups: list[str], options: list[str]) -> str:
        if name == "maketitle":
            return self.title()
        if name in ("title", "author", "date") and groups:
            self.kept[name] = groups[-1]
        if name == "item" and options:
            return "\n  " + options[0]
        if name in SILENT:
            return ""
        made = self.templates.get(name)
        return made(groups, options) if callable(made) else "".join(groups) if made is None else self.fill(made, groups)

    PIECE = re.compile(r"%[^\n]*\n?[ \t]*|\\(begin|end)\s*\{([^}]*)\}|\\([A-Za-z@]+|.)|[{}$]|[^\\{}$%]+", re.S)

    def render(self, text: str) -> str:
        read, out, at = self.reader.arguments, [], 0
        while m := self.PIECE.match(text, at):
            at = m.end()
            if m[1]:
                at = read(text, at, len(text), self.environments.get(m[2], ""))[1] if m[1] == "begin" else at
            elif m[3]:
                signs = self.macros.get(m[3], "")
                spans, at = read(text, at, len(text), signs)
                inner = [(c, self.render(text[a:b])) for c, a, b in spans]
                if m[3] in "%&#_$ {}":
                    out.append(m[3])
                else:
                    out.append(self.macro(m[3], [t for c, t in inner if c == "{"], [t for c, t in inner if c == "["]))
                if not spans and m[3].isalpha():
                    at += text[at : at + 1] == " "
            elif m[0][0] not in "%{}$":
                out.append(m[0])
        return "".join(out)


def plain(text: str, **more) -> str:
    return Renderer(**more).render(unicode_text(text))


def renderer(**more) -> Callable[[Column], Column]:
    """A column function like to_text with templates and macros of one's own (see Renderer)."""

    @F.pandas_udf(T.StringType())
    def made(tex: pd.Series) -> pd.Series:
        return tex.map(lambda t: None if t is None else plain(t, **more))

    return made


to_text = renderer()
