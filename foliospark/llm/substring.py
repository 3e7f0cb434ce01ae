"""Substring dedup with a log-structured index of window fingerprints.

Each batch of documents is searched against the index and then added to it. A batch gives sorted,
immutable runs in buckets: the classes of its window stretches (windows.py) with the first document of
each, the anchors with their one class or the mark of several, and, below anchors of several classes,
the digests of single windows with their first document. Runs of equal rank are merged by a full outer merge
join into one of the next rank before the next batch comes, so a batch is merge-joined with few runs. Repeats are verified by
128-bit BLAKE2b digests of the words themselves; the rolling hash only finds candidates. The texts of
a batch are kept in blocks with the index (textlog.py): a later batch is cleaned against earlier ones
whose tables are gone. save() and load() carry an index over to another session.

A word goes if a window that covers it starts, with equal words, in an indexed document with a smaller id:
results are those of a single batch if batches come in the order of ids.

Defined cases: a null or empty text has no words and keeps the hash of the empty string; a null id
counts as later than every other; rows with equal ids aren't earlier than each other; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import batch_of, drop, durable, partitions, scratch, slim
from .textlog import PLACE, TASK, bucketed, in_blocks, opened, store
from .windows import WHITESPACE, covered, digests, joined, occurrences, word_bounds, word_units

LAST = (1 << 63) - 1
#: Tables of a run: schema and keys. first, last: documents; blk, i, lo: block, place in it and first window of the stretch that stands for a class.
TABLES = {
    "classes": ("c1 long, c2 long, first long, last long, g long, n int, blk long, i int, lo int", ("c1", "c2")),
    "anchors": ("g long, c1 long, c2 long, several boolean", ("g",)),
    "windows": ("h1 long, h2 long, first long, last long", ("h1", "h2")),
}
FOUND = "blk long, i int, doc long, lo int, n int, g long, c1 long, c2 long"


@dataclass
class Run:
    rank: int
    buckets: int
    paths: dict[str, str]
    tables: dict[str, DataFrame]


def at_least(*columns):
    """The least of the columns that aren't null."""
    return F.least(*columns) if len(columns) > 1 else F.col(columns[0])


class WindowIndex:
    """An index of word windows that grows by batches.

    window: words in a window; gram: words in an anchor; path: the folder of the index (a new one by default).
    """

    def __init__(self, spark: SparkSession, window: int = 50, gram: int = 10, path: str | None = None):
        self.spark, self.window, self.gram = spark, window, gram
        self.path = path or scratch(spark)
        self.batches, self.made = 0, 0
        self.runs: list[Run] = []
        self.texts: list[tuple[int, str, DataFrame]] = []

    # -- tables

    def table(self, name: str, df: DataFrame, buckets: int) -> tuple[str, DataFrame]:
        self.made += 1
        path = f"{self.path}/{name}-{self.made}"
        columns = [c.split()[0] for c in TABLES[name][0].split(", ")]
        return path, bucketed(df.select(*columns), buckets, TABLES[name][1], path)

    def save(self) -> str:
        """Write the list of runs beside them; the folder of the index."""
        state = {"window": self.window, "gram": self.gram, "batches": self.batches, "made": self.made}
        state |= {"runs": [[r.rank, r.buckets, r.paths] for r in self.runs], "texts": [[n, path] for n, path, _ in self.texts]}
        self.spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").text(f"{self.path}/state")
        return self.path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> WindowIndex:
        state = json.loads(spark.read.text(f"{path}/state").first()[0])
        index = cls(spark, state["window"], state["gram"], path)
        index.batches, index.made = state["batches"], state["made"]
        for rank, buckets, paths in state["runs"]:
            index.runs.append(Run(rank, buckets, paths, {name: opened(spark, *TABLES[name][:1], buckets, TABLES[name][1], p) for name, p in paths.items()}))
        for n, where in state["texts"]:
            index.texts.append((n, where, opened(spark, "blk long, ids array<long>, texts array<binary>", n, ("blk",), where, order=False)))
        return index

    # -- passes over texts

    def fingerprints(self, texts: DataFrame) -> DataFrame:
        """A row for each stretch: where it is, its document, anchor and class."""
        window, gram = self.window, self.gram
        schema = pa.schema([("blk", pa.int64()), ("i", pa.int32()), ("doc", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("g", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64())])

        def scan(batches):
            for batch in batches:
                for blk, ids, data, off in in_blocks(batch):
                    first, end, words = word_bounds(data, off, WHITESPACE)
                    row, lo, n, g, _ = occurrences(word_units(data, first, end), words, window, gram)
                    if len(row):
                        text, start = joined(data, first, end)
                        a = lo + words[row]
                        c = digests(text, start[a].tolist(), start[a + n - 1 + window].tolist())
                        doc = np.array([LAST if x is None else x for x in ids.to_pylist()], np.int64)[row]
                        yield batch_of(schema, [np.full(len(row), blk), row, doc, lo, n, g.view(np.int64), c[:, 0], c[:, 1]])

        return texts.mapInArrow(scan, FOUND)

    def singles(self, texts: DataFrame, need: DataFrame) -> DataFrame:
        """The windows of the stretches in need (c1, c2, first, blk, i, lo, n): class, offset, first document and digest of each."""
        window = self.window
        schema = pa.schema([("c1", pa.int64()), ("c2", pa.int64()), ("at", pa.int32()), ("first", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])

        def expand(batches):
            for batch in batches:
                wanted = batch.column("need")
                for r, (_, _, data, off) in enumerate(in_blocks(batch)):
                    i, lo, n, c1, c2, doc = (x.to_numpy() for x in wanted[r].values.flatten())
                    first, end, words = word_bounds(data, off, WHITESPACE)
                    text, start = joined(data, first, end)
                    row = np.repeat(np.arange(len(i)), n)
                    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                    a = (lo + words[i])[row] + at
                    h = digests(text, start[a].tolist(), start[a + window].tolist())
                    yield batch_of(schema, [c1[row], c2[row], at, doc[row], h[:, 0], h[:, 1]])

        need = need.groupBy(F.col("blk").alias("nblk")).agg(F.collect_list(F.struct("i", "lo", "n", "c1", "c2", "first")).alias("need"))
        return texts.join(need.hint("shuffle_hash"), F.expr("blk = nblk")).select("blk", "ids", "texts", "need").mapInArrow(expand, "c1 long, c2 long, at int, first long, h1 long, h2 long")

    # -- the index

    def compact(self) -> None:
        """Merge runs of equal rank, two by two."""
        while len(self.runs) > 1 and self.runs[-1].rank == self.runs[-2].rank:
            b, a = self.runs.pop(), self.runs.pop()
            merged = {}
            for name, (columns, keys) in TABLES.items():
                left, right = a.tables[name].alias("a"), b.tables[name].alias("b")
                both = left.join(right, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "full_outer")
                pick = [F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys]
                if name == "anchors":
                    other = (F.col("a.c1") != F.col("b.c1")) | (F.col("a.c2") != F.col("b.c2"))
                    pick += [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("c1", "c2")]
                    pick += [(F.coalesce("a.several", F.lit(False)) | F.coalesce("b.several", F.lit(False)) | F.coalesce(other, F.lit(False))).alias("several")]
                else:  # the row of the smaller first document stands for both
                    mine = F.col("b.first").isNull() | (F.col("a.first") <= F.col("b.first"))
                    rest = [c.split()[0] for c in columns.split(", ") if c.split()[0] not in keys]
                    pick += [F.when(mine, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in rest if c != "last"]
                    pick += [F.greatest("a.last", "b.last").alias("last")]
                merged[name] = self.table(name, both.select(*pick), max(a.buckets, b.buckets))
            drop(*a.tables.values(), *b.tables.values())
            self.runs.append(Run(a.rank + 1, max(a.buckets, b.buckets), {k: p for k, (p, _) in merged.items()}, {k: t for k, (_, t) in merged.items()}))

    def known(self, name: str, own: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        """own, merge-joined with each run's table of that name; its columns get the run's number."""
        keys = TABLES[name][1]
        for k, run in enumerate(self.runs):
            theirs = run.tables[name].select(*[F.col(c).alias(f"r{k}_{c}") for c in (*keys, *columns)])
            own = own.join(theirs, [F.col(c) == F.col(f"r{k}_{c}") for c in keys], "left").drop(*[f"r{k}_{c}" for c in keys])
        return own

    def crowded(self, anchors: DataFrame) -> DataFrame:
        """Anchors of the batch below which the index and the batch have several classes: g, and the one class that
        the index has so far, if its windows aren't indexed yet (o1, o2)."""
        yes, no = F.lit(True), F.lit(False)
        several, many, o1, o2 = F.col("several"), no, F.lit(None).cast("long"), F.lit(None).cast("long")
        for k in range(len(self.runs)):
            c1, c2 = F.col(f"r{k}_c1"), F.col(f"r{k}_c2")
            many = many | F.coalesce(F.col(f"r{k}_several"), no) | F.coalesce((o1 != c1) | (o2 != c2), no)
            o1, o2 = F.coalesce(o1, c1), F.coalesce(o2, c2)
        several = several | many | F.coalesce((o1 != F.col("c1")) | (o2 != F.col("c2")), no)
        found = self.known("anchors", anchors, ("c1", "c2", "several")).select("g", several.alias("several"), F.when(many == yes, None).otherwise(o1).alias("o1"), F.when(many == yes, None).otherwise(o2).alias("o2"))
        return found.where("several").drop("several")

    def dedup(self, docs: DataFrame) -> DataFrame:
        """Search a batch, add it, and give its rows without the repeated words: doc_id, n_words, n_removed, kept (words joined by one space)."""
        self.compact()
        number, buckets = self.batches, partitions(self.spark)
        self.batches += 1
        where = f"{self.path}/texts-{number}"
        texts = store(docs, number, where)
        found = durable(self.fingerprints(texts))
        place = [F.min_by(c, "doc").alias(c) for c in ("blk", "i", "lo")]  # of one row: all three go by the same column
        classes = found.groupBy("c1", "c2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.min("g").alias("g"), F.min("n").alias("n"), *place)
        paths, tables = {}, {}
        paths["classes"], tables["classes"] = self.table("classes", classes, buckets)
        own = tables["classes"]
        shape = own.groupBy("g").agg(F.min("c1").alias("c1"), F.max("c1").alias("d1"), F.min("c2").alias("c2"), F.max("c2").alias("d2"))
        paths["anchors"], tables["anchors"] = self.table("anchors", shape.withColumn("several", F.expr("c1 <> d1 OR c2 <> d2")), buckets)
        crowded = slim(self.crowded(tables["anchors"]))

        runs = range(len(self.runs))
        seen = self.known("classes", own, ("first",))
        seen = seen.withColumn("least", at_least("first", *[F.coalesce(f"r{k}_first", F.lit(LAST)) for k in runs]))
        seen = seen.select("c1", "c2", "first", "last", "least", "g", "n", "blk", "i", "lo")
        seen = durable(seen) if self.runs else seen
        need = seen.where("least = first").join(crowded.select(F.col("g").alias("cg")), F.expr("g = cg"))
        singles = durable(self.singles(texts, need))
        windows = singles.select("h1", "h2", "first")
        for k, run in enumerate(self.runs):  # the classes so far alone below an anchor that has several now
            theirs = run.tables["classes"].join(crowded.where("o1 IS NOT NULL").select("o1", "o2"), F.expr("c1 = o1 AND c2 = o2"))
            for n, (_, _, old) in enumerate(self.texts):
                part = theirs.where(F.shiftright("blk", PLACE + TASK) == n)
                windows = windows.unionByName(self.singles(old, part).select("h1", "h2", "first"))
        spread = windows.groupBy("h1", "h2").agg(F.min("first").alias("first"), F.max("first").alias("last"))
        paths["windows"], tables["windows"] = self.table("windows", spread, buckets)
        before = self.known("windows", tables["windows"], ("first",)).withColumn("least", at_least("first", *[F.coalesce(f"r{k}_first", F.lit(LAST)) for k in runs])).where("least < last")
        before = before.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), "least")
        marked = singles.join(before, F.expr("h1 = b1 AND h2 = b2")).where("least < first")
        marked = marked.groupBy(F.col("c1").alias("m1"), F.col("c2").alias("m2")).agg(F.collect_list("at").alias("ats"))
        outcome = seen.join(marked, F.expr("c1 = m1 AND c2 = m2"), "left").where("least < last OR ats IS NOT NULL")
        # written, so that both sides of the next join are plain shuffles and a class of very many copies can be split
        outcome = slim(outcome.select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), "least", "ats"))
        hits = found.join(outcome, F.expr("c1 = k1 AND c2 = k2")).where("doc > least OR ats IS NOT NULL")
        spans = hits.select("blk", "i", "lo", F.when(F.col("doc") > F.col("least"), F.col("n")).alias("n"), F.when(F.col("doc") <= F.col("least"), F.col("ats")).alias("ats"))
        spans = durable(spans.groupBy(F.col("blk").alias("sblk")).agg(F.collect_list(F.struct("i", "lo", "n", "ats")).alias("spans")))
        drop(found, crowded, singles, outcome, *([seen] if self.runs else []))
        self.texts.append((buckets, where, texts))
        self.runs.append(Run(0, buckets, paths, tables))
        return self.cut(texts, spans)

    def cut(self, texts: DataFrame, spans: DataFrame) -> DataFrame:
        window = self.window
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])

        def scan(batches):
            for batch in batches:
                spans = batch.column("spans")
                for r, (_, ids, data, off) in enumerate(in_blocks(batch)):
                    first, end, words = word_bounds(data, off, WHITESPACE)
                    drop = np.zeros(len(first), bool)
                    if spans[r].is_valid:
                        i, lo, n, ats = spans[r].values.flatten()
                        a = words[i.to_numpy()] + lo.to_numpy()
                        size = np.diff(ats.fill_null([]).offsets.to_numpy()) if ats.null_count < len(ats) else np.zeros(len(a), np.int64)
                        whole = n.is_valid().to_numpy(zero_copy_only=False)
                        one = np.repeat(a, size) + ats.flatten().to_numpy() if size.any() else np.zeros(0, np.int64)
                        drop = covered(len(first), np.append(a[whole], one), np.append(n.drop_null().to_numpy(), np.ones(len(one), np.int64)), window)
                    text, start = joined(data, first[~drop], end[~drop])
                    edge = start[np.append(0, np.cumsum(~drop))[words]]
                    count = np.diff(words)
                    gone = np.diff(np.append(0, np.cumsum(drop))[words])
                    text = memoryview(text)
                    kept = [bytes(text[x : max(x, y - 1)]) for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                    yield batch_of(schema, [ids, count, gone, kept])

        return texts.join(spans.hint("shuffle_hash"), F.expr("blk = sblk"), "left").select("blk", "ids", "texts", "spans").mapInArrow(scan, "doc_id long, n_words long, n_removed long, kept binary")


def dedup_substrings(docs: DataFrame, window: int = 50, gram: int = 10, batches: int = 2) -> DataFrame:
    """Take docs in batches by id and remove what an earlier document has: doc_id, n_words, n_removed, kept."""
    index = WindowIndex(docs.sparkSession, window, gram)
    out = None
    for batch in by_id(docs, batches):
        part = index.dedup(batch)
        out = part if out is None else out.unionByName(part)
    return out


def by_id(docs: DataFrame, batches: int) -> list[DataFrame]:
    """docs in batches of rising ids (a null id comes last)."""
    key = F.coalesce(F.col("doc_id"), F.lit(LAST))
    cuts = docs.select(F.percentile_approx(key, [i / batches for i in range(1, batches)], 1000).alias("q")).first()["q"] or [] if batches > 1 else []
    edges = [None, *sorted(set(cuts)), None]
    return [docs.where((F.lit(True) if a is None else key > a) & (F.lit(True) if b is None else key <= b)) for a, b in zip(edges, edges[1:], strict=False)]


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


__all__ = ["WindowIndex", "by_id", "dedup_substrings", "digest"]
