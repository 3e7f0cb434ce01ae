"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty.

A candidate is a whole string of 16 or more letters, digits and +/_=.-, or a run of key lines that follow
one another, whose edges are at most `reach` characters from a word that speaks of secrets; it has a letter
and a digit. Its novelty is the number of bytes by which it makes the compressed text around it longer, with a
dictionary of code and identifiers primed; text that repeats its surroundings or looks like code
costs little, a key costs nearly its entropy. Candidates of `least` bytes or more a character are spans
of kind "novel", next to the spans of the fixed patterns; where the whole costs less, its lines and the
parts between its dots are tried alone.

Defined cases: null and empty texts have no spans; a null id is kept; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")
#: Words that every match of ASSIGN has, and more that make a context sensitive.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
SENSITIVE = re.compile(r"(?ai:passw|secret|token|api_?key|credential|private|bearer|auth|akia)")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-][A-Za-z0-9+/_=.-]{14,}[A-Za-z0-9+/_=-]")
#: A line, after a candidate's, of key characters alone (line breaks may be written as \\n); a short one is the last of its run.
KEY_LINE = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*([A-Za-z0-9+/_=-]+)(?=[ \t]*(?:[\r\n\\\"']|\Z))")
#: What sets a short last line apart from a word.
TAIL = re.compile(r"[0-9+/=]")
KEY_LINE_BREAK = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)?[ \t]*")
PART = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LETTER, DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")
#: Code and identifiers the compressor knows beforehand.
DICTIONARY = (
    "import os sys json return self None True False def class for while if else elif try except function const let var public private static void int string "
    "password = token = secret = api_key = apikey access_key client_secret authorization: Bearer username localhost example.com http:// https:// www. .com .org "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 00000000 ffffffff deadbeef 12345678 a1b2c3d4 test_ user_id config settings environment "
    "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their"
).encode()


class Novelty:
    def __init__(self, around: int = 256):
        self.around = around
        self.zip = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(DICTIONARY, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False)

    def __call__(self, text: str, start: int, end: int) -> float:
        """Marginal compressed bytes of text[start:end] a character."""
        near = (text[max(0, start - self.around) : start] + "\n" + text[end : end + self.around]).encode()
        return (len(self.zip.compress(near + text[start:end].encode())) - len(self.zip.compress(near))) / (end - start)


def candidates(text: str):
    """(start, end) of every whole candidate string, key lines that follow it included."""
    at = 0
    while m := CANDIDATE.search(text, at):
        a, at = m.span()
        while line := KEY_LINE.match(text, at):
            if line.end(1) - line.start(1) < 16:
                if TAIL.search(line[1]) or text.startswith("-----END", KEY_LINE_BREAK.match(text, line.end()).end()):
                    at = line.end(1)
                break
            at = line.end(1)
        yield a, at


def spans(text: str, novelty: Novelty, least: float = 0.45, reach: int = 64) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, novelty) in code points, by start and kind."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [("assign", m.start(), m.end(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end(), None) for m in HEX.finditer(text)]
    words = [m.span() for m in SENSITIVE.finditer(text)] if SENSITIVE.search(low) else []
    ends = [e for _, e in words]
    for a, b in candidates(text) if words else ():
        near = bisect.bisect_left(ends, a - reach)
        if near == len(words) or words[near][0] > b + reach:
            continue
        parts = [m.span() for m in PART.finditer(text, a, b)]
        host = text[max(0, a - 1) : a] == "@" and "." in text[a:b]  # of a mail address: only its parts can be keys
        tried = parts if host else [(a, b)]
        for x, y in tried:
            if not (LETTER.search(text, x, y) and DIGIT.search(text, x, y)):
                continue
            if (cost := novelty(text, x, y)) >= least:
                out.append(("novel", x, y, cost))
            elif (x, y) == (a, b):
                tried += [p for p in parts if p != (a, b)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind: string, start: int, end: int, novelty: double>>"


def scan_secrets(docs: DataFrame, least: float = 0.45, reach: int = 64, column: str = "spans") -> DataFrame:
    """docs with a column (in the place of one of that name) of all secrets found in the text."""
    docs = docs.drop(column)
    names = docs.columns
    schema = docs.withColumn(column, F.lit(None).cast(SPANS)).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())]))

    def scan(batches):
        novelty = Novelty()
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b, "novelty": c} for k, a, b, c in spans(t.as_py() or "", novelty, least, reach)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*names, column])

    return docs.mapInArrow(scan, schema)


def redact(docs: DataFrame, mark: str = "[secret]", count: str = "secrets") -> DataFrame:
    """docs with every stretch that spans cover replaced by a mark, and their number in a column (in the place of one of that
    name); other texts stay as they are."""
    docs = docs.drop(count)
    names = docs.columns
    schema = docs.withColumn(count, F.lit(0)).schema

    def cut(batches):
        # spans are found here too: a scan of its own before this would take a second worker for each task
        novelty = Novelty()
        for batch in batches:
            texts, counts = batch.column("text").to_pylist(), []
            for i, text in enumerate(texts):
                found = spans(text or "", novelty)
                counts.append(len(found))
                if found:
                    parts, at = [], 0
                    for _, a, b, _ in found:
                        if a >= at:
                            parts += [text[at:a], mark]
                        at = max(at, b)
                    texts[i] = "".join(parts) + text[at:]
            columns = [pa.array(texts, batch.schema.field(c).type) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int32())], names=[*names, count])

    return docs.mapInArrow(cut, schema)


def table(docs: DataFrame) -> DataFrame:
    found = scan_secrets(docs.select(F.col("doc_id").cast("long"), "text")).drop("text")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), count("novel").alias("n_novel"),
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
    )
