r"""Accents, greek letters and math alphabets of TeX as Unicode text.

Every table is made from Unicode's own names: \vec x is x and a combining mark in composed form, \Omega the
letter of that name, \mathbf{A} the letter's bold variant where Unicode has one.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The macro of each combining mark.
ACCENTS = {
    "'": "ACUTE ACCENT", "`": "GRAVE ACCENT", '"': "DIAERESIS", "c": "CEDILLA", "^": "CIRCUMFLEX ACCENT", "~": "TILDE", "H": "DOUBLE ACUTE ACCENT", "k": "OGONEK", "=": "MACRON", "b": "MACRON BELOW",
    ".": "DOT ABOVE", "d": "DOT BELOW", "r": "RING ABOVE", "u": "BREVE", "v": "CARON", "vec": "RIGHT ARROW ABOVE", "dot": "DOT ABOVE", "hat": "CIRCUMFLEX ACCENT", "check": "CARON", "breve": "BREVE",
    "acute": "ACUTE ACCENT", "grave": "GRAVE ACCENT", "tilde": "TILDE", "bar": "OVERLINE", "ddot": "DIAERESIS", "not": "LONG SOLIDUS OVERLAY",
}
#: Greek names, the exceptions of small letters, and the variants.
GREEK = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
SMALL = {"epsilon": "GREEK LUNATE EPSILON SYMBOL", "phi": "GREEK PHI SYMBOL"}
VARIANTS = {"varepsilon": "GREEK SMALL LETTER EPSILON", "vartheta": "GREEK THETA SYMBOL", "varpi": "GREEK PI SYMBOL", "varrho": "GREEK RHO SYMBOL", "varsigma": "GREEK SMALL LETTER FINAL SIGMA", "varphi": "GREEK SMALL LETTER PHI"}
#: Unicode's word for each math alphabet.
ALPHABETS = {"mathbf": "BOLD", "mathit": "ITALIC", "mathsf": "SANS-SERIF", "mathtt": "MONOSPACE", "mathbb": "DOUBLE-STRUCK", "mathcal": "SCRIPT", "mathscr": "SCRIPT", "mathfrak": "FRAKTUR"}


def _letters() -> dict[str, str]:
    found = {}
    for name in GREEK:
        unicode_name = name.upper().replace("LAMBDA", "LAMDA")
        small = unicodedata.lookup(SMALL.get(name, f"GREEK SMALL LETTER {unicode_name}"))
        capital = unicodedata.lookup(f"GREEK CAPITAL LETTER {unicode_name}")
        found |= {name: small, name.capitalize(): capital, f"up{name}": small, f"Up{name}": capital}
    for name, unicode_name in VARIANTS.items():
        found |= {name: unicodedata.lookup(unicode_name), f"up{name}": unicodedata.lookup(unicode_name)}
    return found


LETTERS = _letters()
MARKS = {macro: unicodedata.lookup("COMBINING " + name) for macro, name in ACCENTS.items()}
DOTLESS = str.maketrans("ıȷ", "ij")


def styled(text: str, alphabet: str) -> str:
    """ASCII letters and digits in a math alphabet; where Unicode lacks a variant the character stays."""

    def one(c: str) -> str:
        if not (c.isascii() and c.isalnum()):
            return c
        what = f"DIGIT {unicodedata.name(c).split()[-1]}" if c.isdigit() else f"{'SMALL' if c.islower() else 'CAPITAL'} {c.upper()}"
        for name in (f"MATHEMATICAL {ALPHABETS[alphabet]} {what}", f"{ALPHABETS[alphabet].replace('FRAKTUR', 'BLACK-LETTER')} {what}", "PLANCK CONSTANT" if (c, alphabet) == ("h", "mathit") else ""):
            try:
                return unicodedata.lookup(name)
            except KeyError:
                continue
        return c

    return "".join(map(one, text))


_ARGUMENT = r"\s*(?:\{([^{}]*)\}|(\\[ij](?![A-Za-z])|\w))"
_SYMBOLS = "|".join(re.escape(m) for m in ACCENTS if not m.isalpha())
_WORDS = "|".join(sorted([*(m for m in ACCENTS if m.isalpha()), *ALPHABETS], key=len, reverse=True))
ACCENT = re.compile(rf"\\(?:({_SYMBOLS})|({_WORDS})(?![A-Za-z])){_ARGUMENT}")
LETTER = re.compile(r"\\([A-Za-z]+)(?![A-Za-z]) ?")


def unicode_text(text: str) -> str:
    """text with these macros replaced, inner ones first; other macros stay."""
    text = LETTER.sub(lambda m: LETTERS.get(m[1], m[0]), text)
    text = re.sub(r"\\([ij])(?![A-Za-z])(?:\{\})?", lambda m: "ı" if m[1] == "i" else "ȷ", text)

    def put(m):
        macro, body = m[1] or m[2], m[3] if m[3] is not None else m[4]
        if macro in ALPHABETS:
            return styled(body, macro)
        return "".join(unicodedata.normalize("NFC", c + MARKS[macro]) for c in (body.strip() or " ").translate(DOTLESS))

    while (new := ACCENT.sub(put, text)) != text:
        text = new
    return text


@F.pandas_udf(T.StringType())
def to_unicode(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicode_text(t))
