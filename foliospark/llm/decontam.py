"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur in a text with k = rate * m edits. It is cut into k + 1 pieces:
one of them must occur unchanged. Pieces are found with an Aho-Corasick automaton over the whole text
(lower case, blanks collapsed), and the text around each hit is verified with Myers' bit-parallel edit
distance. Items go to the executors in blocks of bounded size, each against all documents.

Defined cases: null and empty texts match nothing; items without text are left out; items shorter than
`shortest` characters match without edits and as whole words only; repeated items and rows are matched each; a null id is kept; extra columns
are ignored.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import batch_of

MATCH = "doc_id long, item_id long, distance int, start int, end int, item_chars int"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(n: int, rate: float, piece: int) -> int:
    """Edits allowed in n characters: the rate, but no pieces shorter than `piece` characters."""
    return max(0, min(int(n * rate), n // piece - 1))


def cut(item: str, k: int) -> list[tuple[int, str]]:
    edges = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of the pattern to a substring of the text, and the first end of such a one."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph <<= 1
        mh <<= 1
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv & full
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    def __init__(self, items: list[tuple[int, str]], rate: float, piece: int, shortest: int = 0):
        self.shortest = shortest
        self.items = [(i, t, budget(len(t), rate, piece) if len(t) >= shortest else 0) for i, t in items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, k) in enumerate(self.items):
            for at, part in cut(text, k):
                pieces.setdefault(part, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for part, where in pieces.items():
            self.automaton.add_word(part, (len(part), where))
        if pieces:
            self.automaton.make_automaton()

    @staticmethod
    def whole(text: str, a: int, b: int) -> bool:
        """No word of the text goes on over an edge of text[a:b]."""
        cut = lambda p: 0 < p < len(text) and text[p - 1].isalnum() and text[p].isalnum()
        return not cut(a) and not cut(b)

    def find(self, text: str):
        """(item, distance, start, end, characters) of the best occurrence of each item."""
        if not self.items or not text:
            return
        begins: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for n, at in where:
                begins.setdefault(n, set()).add(end + 1 - size - at)
        for n, places in begins.items():
            item, pattern, k = self.items[n]
            if len(pattern) < self.shortest:
                whole = [p for p in places if self.whole(text, p, p + len(pattern))]
                if whole:
                    yield item, 0, min(whole), min(whole) + len(pattern), len(pattern)
                continue
            best = None
            stretches: list[list[int]] = []
            for p in sorted(places):
                a, b = max(0, p - k), min(len(text), p + len(pattern) + k)
                if stretches and a <= stretches[-1][1] and p - stretches[-1][2] <= 2 * k + 1:
                    stretches[-1][1:] = [b, p]
                else:
                    stretches.append([a, b, p])
            for a, b, _ in stretches:
                at = text.find(pattern, a, b)
                if at >= 0:
                    best = (0, at, at + len(pattern))
                    break
                distance, end = myers(pattern, text[a:b])
                if distance <= k and (best is None or distance < best[0]):
                    _, back = myers(pattern[::-1], text[a : a + end][::-1])
                    best = (distance, a + end - back, a + end)
            if best:
                yield item, *best, len(pattern)


def item_blocks(benchmark: DataFrame, size: int):
    """Items in blocks of about `size` characters, fetched block by block."""
    block, held = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL").toLocalIterator():
        text = normal(row["text"])
        if text:
            block.append((row["item_id"], text))
            held += len(text)
            if held >= size:
                yield block
                block, held = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, piece: int = 11, shortest: int = 24, block: int = 1 << 22) -> DataFrame:
    """One row for each document and item that it holds: distance, and where in the normal text."""
    spark = docs.sparkSession
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("item_chars", pa.int32())])
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    out = None
    for items in item_blocks(benchmark, block):
        held = spark.sparkContext.broadcast(items)  # at most `block` characters and one item

        def scan(batches, held=held):
            matcher = Matcher(held.value, rate, piece, shortest)
            for batch in batches:
                ids, rows = batch.column("doc_id"), []
                for i, text in enumerate(batch.column("text")):
                    for found in matcher.find(normal(text.as_py())):
                        rows.append((ids[i].as_py(), *found))
                if rows:
                    yield batch_of(schema, list(zip(*rows, strict=True)))

        part = slim.mapInArrow(scan, MATCH)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], MATCH)


def without(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, piece: int = 11, shortest: int = 24, block: int = 1 << 22) -> DataFrame:
    """The rows of docs, whatever their ids, that hold no item; each row is judged where it is, without a shuffle."""
    for items in item_blocks(benchmark, block):
        held = docs.sparkSession.sparkContext.broadcast(items)  # at most `block` characters and one item

        def scan(batches, held=held):
            matcher = Matcher(held.value, rate, piece, shortest)
            for batch in batches:
                clean = [next(matcher.find(normal(text.as_py())), None) is None for text in batch.column("text")]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs
