"""Suffix-array dedup with a logarithmic family of indexes.

Each batch of documents gets a sparse suffix array: the suffixes that start at anchors (windows.py: in
every stretch of `window` bytes one is sampled, the same wherever the stretch occurs), with the bytes before
them that windows can cover. Suffixes of equal surroundings (128-bit BLAKE2b digests of the bytes) are one entry
that counts its copies. An entry whose anchor no other entry has can't match and gives its digest and place only;
the others are sorted by anchor and bytes and written with their bytes. A new batch is merge-scanned against
each existing level: below an anchor the entries of the batch and of the levels come in the order of their bytes, and
longest common prefixes of neighbours, to the right and to the left of the anchor, say which windows of `window`
bytes are equal. Levels of equal rank are merged, so sizes grow geometrically. Anchors that very many entries
share are dealt out by the digests of stretches, so that no task has them all.

The texts of a batch stay in blocks with the index (textlog.py), so a later batch finds what it shares
with earlier ones, and the earlier ones lose their copies too.

Defined cases: a null or empty text has no bytes; a null id is kept; repeated rows count as copies of
each other; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import batch_of, drop, durable, partitions, scratch, slim
from .substring import by_id
from .textlog import PLACE, TASK, bucketed, in_blocks, store
from .windows import BYTE_UNIT, covered, digests, occurrences

FOUND = "blk long, i int, lo int, n int, q int, g long, c1 long, c2 long"
ENTRY = "g long, s int, blk long, i int, lo int, n int, q int, whole boolean, before binary, suffix binary"
SPAN = "blk long, i int, lo int, n int"
#: Parts into which the entries of one anchor are dealt in the levels.
SALT = 8


def common(rows: list[bytes], width: int) -> np.ndarray:
    """Of each entry, the length of what it has in common with the entry before it, at its beginning."""
    size = np.array([len(r) for r in rows])
    text = np.zeros((len(rows), width + 1), np.uint8)
    inside = np.arange(width + 1) < size[:, None]
    text[inside] = np.frombuffer(b"".join(rows), np.uint8)
    out = np.zeros(len(rows), np.int64)
    differ = text[1:] != text[:-1]
    differ[:, width] = True
    out[1:] = np.minimum(differ.argmax(1), np.minimum(size[1:], size[:-1]))
    return out


def equal_windows(g, suffixes: list[bytes], before: list[bytes], n, q, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, offset) of the windows that several of the entries hold. Entries come sorted by anchor g and suffix; before
    has the bytes left of the anchor in reverse, n the windows of an entry and q the offset of its anchor."""
    m = len(n)
    fresh = np.append(True, g[1:] != g[:-1])
    right = np.where(fresh, -1, common(suffixes, window))
    order = np.array(sorted(range(m), key=lambda k: (g[k], before[k])))
    other = g[order]
    left = np.where(np.append(True, other[1:] != other[:-1]), -1, common([before[k] for k in order], window))
    rows, offsets = [], []
    lists = np.empty(m, np.int64)
    for i in range(int(q.max()) + 1):  # bytes of the window before the anchor
        has = np.flatnonzero((q - n < i) & (i <= q))
        if len(has) < 2:
            continue
        lists[order] = np.cumsum(left < i)
        key = np.cumsum(right < window - i)[has] * (m + 1) + lists[has]
        rank = np.argsort(key, kind="stable")
        key = key[rank]
        same = key[1:] == key[:-1]
        twice = np.append(same, False) | np.append(False, same)
        hit = has[rank[twice]]
        rows.append(hit)
        offsets.append(q[hit] - i)
    return (np.concatenate(rows), np.concatenate(offsets)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Level:
    def __init__(self, rank: int, **tables: DataFrame):
        self.rank, self.tables = rank, tables


class SuffixIndex:
    """window: bytes of a match; gram: bytes of an anchor; crowd: entries below one anchor from which on they are dealt out
    in stretches of `step` windows, by what a stretch holds rather than by the anchor (the result is the same)."""

    def __init__(self, spark: SparkSession, window: int = 200, gram: int = 48, crowd: int = 256, step: int = 12):
        self.spark, self.window, self.gram, self.crowd, self.step = spark, window, gram, crowd, step
        self.levels: list[Level] = []
        self.texts: list[DataFrame] = []
        self.spans: list[DataFrame] = []

    def anchored(self, texts: DataFrame) -> DataFrame:
        """A row for each sampled suffix: where its windows start, their number, the anchor's offset and hash, and the digest of its surroundings."""
        window, gram = self.window, self.gram
        schema = pa.schema([("blk", pa.int64()), *[(c, pa.int32()) for c in ("i", "lo", "n", "q")], ("g", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64())])

        def scan(batches):
            for batch in batches:
                for blk, _, data, off in in_blocks(batch):
                    row, lo, n, g, p = occurrences(BYTE_UNIT[data], off, window, gram)
                    if len(row):
                        a = off[row] + lo
                        c = digests(data, a.tolist(), (a + n - 1 + window).tolist())
                        yield batch_of(schema, [np.full(len(row), blk), row, lo, n, p - lo, g.view(np.int64), c[:, 0], c[:, 1]])

        return texts.mapInArrow(scan, FOUND)

    def entries(self, texts: DataFrame, need: DataFrame) -> DataFrame:
        """The entries in need (g, c1, blk, i, lo, n, q, whole) with the bytes before the anchor, and from it on, suffix."""
        window = self.window
        schema = pa.schema([("g", pa.int64()), ("s", pa.int32()), ("blk", pa.int64()), *[(c, pa.int32()) for c in ("i", "lo", "n", "q")], ("whole", pa.bool_()), ("before", pa.binary()), ("suffix", pa.binary())])

        def cut(batches):
            for batch in batches:
                wanted = batch.column("need")
                for r, (blk, _, data, off) in enumerate(in_blocks(batch)):
                    i, lo, n, q, g, s, whole = wanted[r].values.flatten()
                    a = off[i.to_numpy()] + lo.to_numpy()
                    end = (a + n.to_numpy() - 1 + window).tolist()
                    raw = data.tobytes()
                    anchor = (a + q.to_numpy()).tolist()
                    before = [raw[x:y] for x, y in zip(a.tolist(), anchor, strict=True)]
                    suffix = [raw[x:y] for x, y in zip(anchor, end, strict=True)]
                    yield batch_of(schema, [g, s, np.full(len(before), blk), i, lo, n, q, whole, before, suffix])

        salt = F.pmod("c1", F.lit(SALT)).cast("int").alias("s")
        need = need.groupBy(F.col("blk").alias("nblk")).agg(F.collect_list(F.struct("i", "lo", "n", "q", "g", salt, "whole")).alias("need"))
        return texts.join(need.hint("shuffle_hash"), F.expr("blk = nblk")).select("blk", "ids", "texts", "need").mapInArrow(cut, ENTRY)

    # -- the family of levels

    def table(self, df: DataFrame, *keys: str) -> DataFrame:
        return bucketed(df, partitions(self.spark), keys, scratch(self.spark))

    def level(self, rank: int, classes: DataFrame, anchors: DataFrame, entries: DataFrame) -> Level:
        n = partitions(self.spark)
        sorted_entries = entries.repartition(n, "g", "s").write.format("parquet").bucketBy(n, "g", "s").sortBy("g", "s", "suffix")
        name = scratch(self.spark)
        table_name = "llm_" + name.rsplit("-", 1)[1]
        sorted_entries.option("path", name).saveAsTable(table_name)
        return Level(rank, classes=classes, anchors=anchors, entries=self.spark.table(table_name))

    def compact(self) -> None:
        """Merge levels of equal rank, two by two."""
        while len(self.levels) > 1 and self.levels[-1].rank == self.levels[-2].rank:
            b, a = self.levels.pop(), self.levels.pop()
            left, right = (x.tables["classes"].alias(c) for x, c in ((a, "a"), (b, "b")))
            both = left.join(right, F.expr("a.c1 = b.c1 AND a.c2 = b.c2"), "full_outer")
            old = F.col("a.c1").isNotNull()
            pick = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("c1", "c2")] + [F.when(old, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in ("g", "n", "q", "blk", "i", "lo")]
            classes = both.select(*pick, (F.coalesce("a.copies", F.lit(0)) + F.coalesce("b.copies", F.lit(0))).alias("copies"))
            left, right = (x.tables["anchors"].alias(c) for x, c in ((a, "a"), (b, "b")))
            both = left.join(right, F.expr("a.g = b.g"), "full_outer")
            several = F.expr("coalesce(a.several, false) OR coalesce(b.several, false) OR coalesce(a.c1 <> b.c1 OR a.c2 <> b.c2, false)")
            anchors = both.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("g", "c1", "c2")], several.alias("several"))
            merged = self.level(a.rank + 1, self.table(classes, "c1", "c2"), self.table(anchors, "g"), a.tables["entries"].unionByName(b.tables["entries"]))
            drop(*a.tables.values(), *b.tables.values())
            self.levels.append(merged)

    def crowded(self, anchors: DataFrame) -> DataFrame:
        """Anchors of the batch below which the levels and the batch have several entries: g, and the one entry that the
        levels have so far, if its bytes aren't in them yet (o1, o2)."""
        no = F.lit(False)
        many, o1, o2 = no, F.lit(None).cast("long"), F.lit(None).cast("long")
        for k, level in enumerate(self.levels):
            anchors = anchors.join(level.tables["anchors"].select(*[F.col(c).alias(f"l{k}_{c}") for c in ("g", "c1", "c2", "several")]), F.expr(f"g = l{k}_g"), "left")
            c1, c2 = F.col(f"l{k}_c1"), F.col(f"l{k}_c2")
            many = many | F.coalesce(F.col(f"l{k}_several"), no) | F.coalesce((o1 != c1) | (o2 != c2), no)
            o1, o2 = F.coalesce(o1, c1), F.coalesce(o2, c2)
        several = F.col("several") | many | F.coalesce((o1 != F.col("c1")) | (o2 != F.col("c2")), no)
        return anchors.where(several).select("g", F.when(~many, o1).alias("o1"), F.when(~many, o2).alias("o2"))

    def add(self, docs: DataFrame) -> None:
        """Scan a batch against the levels, note the repeated windows on both sides, and make it a level."""
        self.compact()
        number = len(self.texts)
        texts = store(docs, number)
        found = durable(self.anchored(texts))
        some = F.xxhash64("blk", "i", "lo")
        place = [F.min_by(c, some).alias(c) for c in ("blk", "i", "lo")]  # of one row: all three go by the same key
        classes = self.table(found.groupBy("c1", "c2").agg(F.min("g").alias("g"), F.min("n").alias("n"), F.min("q").alias("q"), *place, F.count("*").alias("copies")), "c1", "c2")
        shape = classes.groupBy("g").agg(F.min("c1").alias("c1"), F.max("c1").alias("d1"), F.min("c2").alias("c2"), F.max("c2").alias("d2"))
        anchors = self.table(shape.select("g", "c1", "c2", F.expr("c1 <> d1 OR c2 <> d2").alias("several")), "g")
        crowded = slim(self.crowded(anchors))

        seen = classes
        for k, level in enumerate(self.levels):
            theirs = level.tables["classes"].select(*[F.col(c).alias(f"l{k}_{c}") for c in ("c1", "c2", "copies", "blk", "i", "lo")])
            seen = seen.join(theirs, F.expr(f"c1 = l{k}_c1 AND c2 = l{k}_c2"), "left")
        past = F.lit(0).cast("long")
        for k in range(len(self.levels)):
            past = past + F.coalesce(F.col(f"l{k}_copies"), F.lit(0))
        held = [F.coalesce(F.lit(None), *[F.col(f"l{k}_{c}") for k in range(len(self.levels))]).cast("int" if c != "blk" else "long").alias(f"old_{c}") for c in ("blk", "i", "lo")]
        seen = seen.select("c1", "c2", "g", "n", "q", "blk", "i", "lo", "copies", past.alias("past"), *held)
        seen = durable(seen) if self.levels else seen
        # written, so that both sides of the next join are plain shuffles and an entry of very many copies can be split
        again = slim(seen.where("copies + past > 1").select(F.col("c1").alias("a1"), F.col("c2").alias("a2")))
        spans = found.join(again, F.expr("c1 = a1 AND c2 = a2")).select("blk", "i", "lo", "n")
        spans = spans.unionByName(seen.where("past = 1").select(F.col("old_blk").alias("blk"), F.col("old_i").alias("i"), F.col("old_lo").alias("lo"), "n"))
        spans = durable(spans)
        drop(found, again)

        need = seen.where("past = 0").join(crowded.select(F.col("g").alias("cg")), F.expr("g = cg"))
        parts = [self.entries(texts, need.withColumn("whole", F.expr("copies > 1")))]
        for level in self.levels:  # entries so far alone below an anchor that has several now
            alone = level.tables["classes"].join(crowded.where("o1 IS NOT NULL").select("o1", "o2"), F.expr("c1 = o1 AND c2 = o2")).withColumn("whole", F.expr("copies > 1"))
            parts += [self.entries(old, alone.where(F.shiftright("blk", PLACE + TASK) == n)) for n, old in enumerate(self.texts)]
        fresh = parts[0]
        for part in parts[1:]:
            fresh = fresh.unionByName(part)
        level = self.level(0, classes, anchors, fresh)
        self.spans += [spans, durable(self.scan([*self.levels, level], crowded, number))]
        drop(crowded, *([seen] if self.levels else []))
        self.texts.append(texts)
        self.levels.append(level)

    def scan(self, levels: list[Level], crowded: DataFrame, number: int) -> DataFrame:
        """Windows that entries below the anchors in crowded have in common, of which one at least is of batch `number`: blk, i, lo, n."""
        wanted = crowded.select(F.col("g").alias("wg"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("ws"))
        both = None
        for level in levels:
            part = level.tables["entries"].join(wanted.hint("shuffle_hash"), F.expr("g = wg AND s = ws"), "left_semi")
            both = part if both is None else both.unionByName(part)
        large = durable(both.groupBy(F.col("g").alias("lg")).count().where(F.col("count") >= self.crowd).select("lg"))
        few = both.join(large, F.expr("g = lg"), "left_anti").select("g", "suffix", "before", "blk", "i", "lo", "n", "q", "whole")
        few = few.repartition(partitions(self.spark), "g").sortWithinPartitions("g", "suffix").mapInArrow(self.neighbours(), SPAN)
        many = both.join(large, F.expr("g = lg"), "left_semi")
        return few.unionByName(self.dealt(many, number))

    def neighbours(self):
        """A merge scan over entries in order; those of one anchor are bounded in number and come together."""
        window = self.window
        schema = pa.schema([("blk", pa.int64()), *[(c, pa.int32()) for c in ("i", "lo", "n")]])

        def matched(table):
            g = table.column("g").to_numpy()
            keep = np.append(g[1:] == g[:-1], False) | np.append(False, g[1:] == g[:-1])
            table = table.filter(pa.array(keep)).combine_chunks()
            if not len(table):
                return
            n, q = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "q"))
            before = [x[::-1] for x in table.column("before").to_pylist()]
            row, at = equal_windows(g[keep], table.column("suffix").to_pylist(), before, n, q, window)
            live = ~table.column("whole").to_numpy(zero_copy_only=False)[row]
            row, at = row[live], at[live]
            if not len(row):
                return
            order = np.lexsort((at, row))
            row, at = row[order], at[order]
            first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)))
            size = np.diff(np.append(first, len(row)))
            blk, i, lo = (table.column(c).to_numpy()[row[first]] for c in ("blk", "i", "lo"))
            yield batch_of(schema, [blk, i, lo + at[first], size])

        def scan(batches):
            rest = None
            for batch in batches:
                for at in range(0, len(batch), 4096):
                    table = pa.Table.from_batches([batch.slice(at, 4096)])
                    if rest is not None:
                        table = pa.concat_tables([rest, table])
                    g = table.column("g").to_numpy()
                    cut = int(np.searchsorted(g, g[-1], "left"))
                    rest = table.slice(cut).combine_chunks()
                    if cut:
                        yield from matched(table.slice(0, cut))
            if rest is not None:
                yield from matched(rest)

        return scan

    def dealt(self, many: DataFrame, number: int) -> DataFrame:
        """Windows that several entries below crowded anchors hold, by the digests of what they hold. Stretches that only
        earlier batches have were compared then."""
        window, step = self.window, self.step
        keys = pa.schema([*[(c, pa.int64()) for c in ("k1", "k2", "f1", "f2", "blk")], *[(c, pa.int32()) for c in ("i", "lo", "n")], ("whole", pa.bool_()), ("h", pa.list_(pa.int64()))])

        def divide(batches):
            """Stretches of `step` starts, placed by their distance from the anchor. All windows of a stretch hold its core."""
            for batch in batches:
                blk, i, lo, count, anchor = (batch.column(c).to_numpy() for c in ("blk", "i", "lo", "n", "q"))
                whole = batch.column("whole").to_pylist()
                near = [a + b for a, b in zip(batch.column("before").to_pylist(), batch.column("suffix").to_pylist(), strict=True)]
                rows, cores, fulls = [], [], []
                for r in range(len(batch)):
                    text, n, q = near[r], int(count[r]), int(anchor[r])
                    h = digests(text, list(range(n)), list(range(window, window + n)))
                    for k in range((q - n + 1) // step, q // step + 1):
                        top = q - k * step
                        a, b = max(0, top - step + 1), min(n - 1, top)
                        cores.append(b"%d:" % k + text[top : top - step + 1 + window])
                        fulls.append(b"%d:%d:%d:" % (k, top - a, b - a) + text[a : b + window])
                        rows.append((blk[r], i[r], lo[r] + a, b - a + 1, whole[r], h[a : b + 1].reshape(-1)))
                if rows:
                    core, full = (digests(b"".join(x), *edges(x)) for x in (cores, fulls))
                    yield batch_of(keys, [core[:, 0], core[:, 1], full[:, 0], full[:, 1], *list(zip(*rows, strict=True))])

        def edges(parts):
            end = np.cumsum([len(p) for p in parts])
            return np.append(0, end[:-1]).tolist(), end.tolist()

        split = durable(many.select("before", "suffix", "blk", "i", "lo", "n", "q", "whole").mapInArrow(divide, "k1 long, k2 long, f1 long, f2 long, blk long, i int, lo int, n int, whole boolean, h array<long>"))
        some = F.xxhash64("blk", "i", "lo")
        fresh = F.max(F.shiftright("blk", PLACE + TASK) == number).alias("fresh")
        stretches = split.groupBy("k1", "k2", "f1", "f2").agg(F.count("*").alias("copies"), fresh, F.min(F.struct(some.alias("o"), "blk", "i", "lo", "whole", "h")).alias("s"))
        stretches = durable(stretches.select("k1", "k2", "f1", "f2", "copies", "fresh", "s.*"))
        equal = stretches.where("copies > 1 AND fresh").select(F.col("f1").alias("e1"), F.col("f2").alias("e2"))
        whole = split.where("NOT whole").join(equal, F.expr("f1 = e1 AND f2 = e2")).select("blk", "i", "lo", "n")
        shared = stretches.groupBy(F.col("k1").alias("s1"), F.col("k2").alias("s2")).agg(F.count("*").alias("n"), F.max("fresh").alias("fresh")).where("n > 1 AND fresh").select("s1", "s2")
        single = stretches.join(shared, F.expr("k1 = s1 AND k2 = s2"))
        single = single.select("blk", "i", "lo", F.expr("whole OR copies > 1").alias("done"), "h", F.explode(F.sequence(F.lit(0), (F.size("h") / 2 - 1).cast("int"))).alias("at"))
        single = single.select("blk", "i", F.expr("lo + at").alias("lo"), "done", F.expr("h[2 * at]").alias("h1"), F.expr("h[2 * at + 1]").alias("h2"))
        twice = single.groupBy(F.col("h1").alias("t1"), F.col("h2").alias("t2")).count().where("count > 1").select("t1", "t2")
        return whole.unionByName(single.where("NOT done").join(twice, F.expr("h1 = t1 AND h2 = t2")).select("blk", "i", "lo", F.lit(1).alias("n")))

    # -- results

    def clean(self) -> DataFrame:
        """All rows so far without repeated bytes: doc_id, n_bytes, n_removed, n_spans, kept."""
        spans = None
        for part in self.spans:
            spans = part if spans is None else spans.unionByName(part)
        out = None
        if spans is not None:
            spans = durable(spans.groupBy(F.col("blk").alias("sblk")).agg(F.collect_list(F.struct("i", "lo", "n")).alias("spans")))
        for n, texts in enumerate(self.texts):
            own = spans.where(F.shiftright("sblk", PLACE + TASK) == n)
            part = texts.join(own.hint("shuffle_hash"), F.expr("blk = sblk"), "left").select("blk", "ids", "texts", "spans").mapInArrow(self.cut(), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
            out = part if out is None else out.unionByName(part)
        return out

    def cut(self):
        window = self.window
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

        def scan(batches):
            for batch in batches:
                spans = batch.column("spans")
                for r, (_, ids, data, off) in enumerate(in_blocks(batch)):
                    drop = np.zeros(len(data), bool)
                    if spans[r].is_valid:
                        i, lo, n = (x.to_numpy() for x in spans[r].values.flatten())
                        drop = covered(len(data), off[i] + lo, n, window)
                    fresh = drop & ~np.append(False, drop[:-1])
                    fresh[off[:-1][off[:-1] < len(data)]] = drop[off[:-1][off[:-1] < len(data)]]
                    total = lambda x: np.diff(np.append(0, np.cumsum(x))[off])
                    gone, text = total(drop), data[~drop].tobytes()
                    end = np.append(0, np.cumsum(np.diff(off) - gone))
                    kept = [text[a:b] for a, b in zip(end[:-1].tolist(), end[1:].tolist(), strict=True)]
                    yield batch_of(schema, [ids, np.diff(off), gone, total(fresh), kept])

        return scan


def dedup_bytes(docs: DataFrame, window: int = 200, gram: int = 48, batches: int = 2) -> DataFrame:
    """Remove every byte covered by a string of `window` bytes that also starts elsewhere."""
    index = SuffixIndex(docs.sparkSession, window, gram)
    for batch in by_id(docs, batches):
        index.add(batch)
    return index.clean()


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
