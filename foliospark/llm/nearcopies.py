"""Near copies: SimHash signatures, then what these can't reach by min-hash bands; every link by exact Jaccard similarity.

Two texts link if the sets of their shingles of `words` lower-cased (A-Z) words have a Jaccard similarity
of 0.8 or more. Texts of the same words are one node from the start, so groups of copies cost one row. SimHash fingerprints
of the shingles that differ in BITS places or fewer meet by simhash.py's deletion variants; such pairs are verified and
contracted first. Links at 0.8 lie at up to 14 bits and more, beyond any segments with one wildcard. For these each text has 96
min-hashes in 24 bands of 4; texts of different components with an equal band are candidates. A pair of similarity s shares none with
probability (1 - s^4)^24: 3.2e-6 at 0.8, less above. Under a key that few nodes share candidates are verified on their
texts pair by pair; under one that many share all pairs are compared whole, by products of the nodes' shingle sets in blocks.

Defined cases: texts without words are copies of each other; a text of fewer words than a shingle has
one, all its words; rows with equal or null ids are rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .base import batch_of, durable, partitions, row_key, utf8
from .components import components
from .windows import WHITESPACE, mix, word_bounds, word_units

BANDS, DEPTH = 24, 4
#: Bytes of the sketch that goes with a key, one of each min-hash.
SKETCH = 64
#: Bits in which fingerprints that meet may differ: of three segments one then differs in one bit at most.
BITS = 5
#: Nodes under one key from which on they are compared in blocks, and about the nodes and the bytes of text of a block.
MANY, BLOCK, BLOCK_TEXT = 48, 512, 1 << 23
#: Candidates whose sketches agree in fewer places can't be meant: at 0.8 the chance is under 1e-6.
LEAST = 34

_rng = np.random.default_rng(5)
_XOR = _rng.integers(0, 1 << 32, BANDS * DEPTH, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 31, BANDS * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(text: bytes, words: int) -> np.ndarray:
    """64-bit hashes of all shingles, in the order of the text."""
    data = np.frombuffer(text.lower(), np.uint8)
    first, end, _ = word_bounds(data, np.array([0, len(data)]), WHITESPACE)
    units = word_units(data, first, end)
    n = min(words, len(units))
    if not n:
        return units
    out = np.zeros(len(units) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out + units[i : i + len(out)])
    return out


def minima(hashes: np.ndarray) -> np.ndarray:
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(BANDS * DEPTH, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(h), 2048):
        x = h[a : a + 2048, None] ^ _XOR
        x *= _MUL
        np.minimum(out, x.min(0), out=out)
    return out


def fingerprint(hashes: np.ndarray) -> int:
    """SimHash: the bits set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[a : a + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.int64)[0])


def close(nodes: DataFrame) -> DataFrame:
    """a, b: nodes of equal fingerprints (each with the least of them), and the least nodes of fingerprints that link by SimHash."""
    prints = durable(nodes.where("fp IS NOT NULL").groupBy("fp").agg(F.min("node").alias("least")))
    linked = simhash.links(simhash.variants(prints.select("fp")), BITS).distinct()
    side = lambda c: prints.select(F.col("fp").alias(f"f{c}"), F.col("least").alias(f"n{c}"))
    far = linked.join(side("a"), F.expr("a = fa")).join(side("b"), F.expr("b = fb")).select("na", "nb")
    same = nodes.select("node", "fp").join(prints, "fp").where("node <> least").select("node", "least")
    return far.union(same).select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct()


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, key (of the row), node (hash of the words), fp (SimHash), bands, sketch; texts too short to link otherwise have no bands and no fp."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("node", pa.int64()), ("fp", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])
    slot = np.arange(1, BANDS + 1, dtype=np.uint64)

    def scan(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            nodes, prints, bands, sketches = [], [], [], []
            for i in range(len(batch)):
                text = data[off[i] : off[i + 1]].tobytes()
                tokens = text.lower().split()
                nodes.append(xxhash.xxh64_intdigest(b" ".join(tokens), 42) - (1 << 63))
                if len(tokens) < words:
                    prints.append(None)
                    bands.append([])
                    sketches.append(b"")
                    continue
                hashes = shingles(text, words)
                prints.append(fingerprint(hashes))
                least = minima(hashes)
                key = slot
                for part in least.reshape(BANDS, DEPTH).T:
                    key = mix(key ^ part.astype(np.uint64)) + slot
                bands.append(key.view(np.int64).tolist())
                sketches.append((least[:SKETCH] & np.uint32(255)).astype(np.uint8).tobytes())
            yield batch_of(schema, [batch.column("doc_id"), batch.column("key"), nodes, prints, bands, sketches])

    return docs.select(F.col("doc_id").cast("long"), row_key().alias("key"), "text").mapInArrow(scan, "doc_id long, key long, node long, fp long, bands array<long>, sketch binary")


def candidates(keyed: DataFrame) -> DataFrame:
    """a, b, key: nodes that share a band that few have; each node (a, no b) under the key of a band that many have."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])

    def pairs(key, node, sketch):
        if len(node) > MANY:
            return batch_of(schema, [node, pa.nulls(len(node), pa.int64()), np.full(len(node), key)])
        a, b = np.triu_indices(len(node), 1)
        good = (sketch[a] == sketch[b]).sum(1) >= LEAST
        a, b = node[a[good]], node[b[good]]
        return batch_of(schema, [np.minimum(a, b), np.maximum(a, b), pa.nulls(len(a), pa.int64())])

    def compare(batches):
        last, held = None, []
        done: list[pa.RecordBatch] = []

        def end():
            if sum(len(h[0]) for h in held) > 1:
                done.append(pairs(last, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])))

        for batch in batches:
            if not len(batch):
                continue
            key, node = (batch.column(c).to_numpy() for c in ("key", "node"))
            sketch = utf8(batch.column("sketch"))[0].reshape(-1, SKETCH)
            edge = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
            for s, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if last != key[s]:
                    end()
                    last, held = key[s], []
                held.append((node[s:e], sketch[s:e]))
            if done:
                yield pa.concat_batches(done)
                done.clear()
        end()
        yield from done

    n = partitions(keyed.sparkSession)
    return keyed.repartition(n, "key").sortWithinPartitions("key").mapInArrow(compare, "a long, b long, key long")


def verified(edges: DataFrame, texts: DataFrame, words: int, tenths: int) -> DataFrame:
    """Edges whose texts have a similarity of tenths / 10 or more."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(batches):
        for batch in batches:
            x, y = utf8(batch.column("ta")), utf8(batch.column("tb"))
            good = np.zeros(len(batch), bool)
            for i in range(len(batch)):
                s, t = (np.unique(shingles(d[o[i] : o[i + 1]].tobytes(), words)) for d, o in (x, y))
                both = len(np.intersect1d(s, t, assume_unique=True))
                good[i] = 10 * both >= tenths * (len(s) + len(t) - both)
            yield batch_of(schema, [batch.column(c).to_numpy()[good] for c in ("a", "b")])

    side = lambda c: texts.select(F.col("node").alias(f"n{c}"), F.col("text").alias(f"t{c}"))
    joined = edges.join(side("a"), F.expr("a = na")).join(side("b"), F.expr("b = nb"))
    return joined.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def forest(sets: list[np.ndarray], side: np.ndarray, tenths: int) -> list[tuple[int, int]]:
    """Links that join all that link between the two sides, or within the only one; all pairs are compared, by products of 0/1 columns."""
    n, size = len(sets), np.array([len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero((count > 1)[at])  # what one set alone has is in no intersection
    row, col = np.repeat(np.arange(n), size)[shared], (np.cumsum(count > 1) - 1)[at[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    left, right = (np.arange(n),) * 2 if side.min() == side.max() else (np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max()))
    both = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, int(col[-1]) + 1 if len(col) else 0, 2048):
        s, e = np.searchsorted(col, [a, a + 2048])
        has = np.zeros((n, 2048), np.float32)
        has[row[s:e], col[s:e] - a] = 1
        both += has[left] @ has[right].T
    good = 10 * both >= tenths * (size[left][:, None] + size[right][None, :] - both)
    group, out = np.arange(n), []
    for i, linked in zip(left.tolist(), good, strict=True):
        others = right[linked & (group[right] != group[i])]
        for j in others.tolist():
            if group[j] != group[i]:
                out.append((i, j))
                group[group == group[j]] = group[i]
    return out


def crowded(crowd: DataFrame, texts: DataFrame, parts: DataFrame, words: int, tenths: int) -> DataFrame:
    """a, b: of the nodes under each key links that join all that link; parts: components known before, which no link need join again."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches):
        last, held = None, []

        def end():
            if len({h[2] for h in held}) < 2:
                return
            sets = [np.unique(shingles(h[3], words)) for h in held]
            node = np.array([h[0] for h in held])
            found = np.array(forest(sets, np.array([h[1] for h in held]), tenths), np.int64).reshape(-1, 2)
            if len(found):
                yield batch_of(schema, [node[found].min(1), node[found].max(1)])

        for batch in batches:
            data, off = utf8(batch.column("text"))
            cols = [batch.column(c).to_pylist() for c in ("key", "lo", "hi", "node", "block", "component")]
            for key, lo, hi, node, block, component, a, b in zip(*cols, off[:-1].tolist(), off[1:].tolist(), strict=True):
                if last != (key, lo, hi):
                    yield from end()
                    last, held = (key, lo, hi), []
                held.append((node, block, component, data[a:b].tobytes()))
        yield from end()

    known = texts.join(parts.withColumnRenamed("node", "part"), F.expr("node = part"), "left").select("node", "text", F.coalesce("component", "node").alias("component"))
    rows = crowd.join(known, "node")
    size = crowd.join(texts.select("node", F.octet_length("text").alias("bytes")), "node").groupBy("key").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = size.select(F.col("key").alias("k"), F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_TEXT)).cast("int").alias("blocks"))
    dealt = rows.join(blocks, F.expr("key = k")).withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) AS int)")).withColumn("other", F.expr("explode(sequence(0, blocks - 1))"))
    dealt = dealt.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "component", "text")
    n = partitions(crowd.sparkSession)
    return dealt.repartition(n, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "node").mapInArrow(compare, "a long, b long")


def firsts(docs: DataFrame, words: int = 5, tenths: int = 8) -> DataFrame:
    """doc_id, key: of each group of near copies the row that is least by id (null last) and row key."""
    rows = durable(signatures(docs, words))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("least")
    nodes = durable(rows.groupBy("node").agg(least, *[F.first(c).alias(c) for c in ("fp", "bands", "sketch")]))
    near = durable(close(nodes))
    banded = durable(candidates(nodes.select(F.explode("bands").alias("key"), "node", "sketch")))
    edges = durable(banded.where("b IS NOT NULL").select("a", "b").distinct())
    crowd = banded.where("b IS NULL").select(F.col("a").alias("node"), "key")
    ends = [x.select(F.col(c).alias("node")) for x in (near, edges) for c in ("a", "b")]
    need = functools.reduce(DataFrame.union, [*ends, crowd.select("node")]).distinct().join(nodes, "node").select("node", F.col("least.doc_id").alias("id"), F.col("least.key").alias("k"))
    texts = docs.select(F.col("doc_id").cast("long"), row_key().alias("key"), "text").join(need, F.expr("key = k AND doc_id <=> id")).select("node", "text")
    if repeats(rows):
        texts = texts.dropDuplicates(["node"])
    texts = durable(texts)
    linked = durable(verified(near, texts, words, tenths))
    parts = components(linked)
    part = lambda c: parts.select(F.col("node").alias(f"n{c}"), F.col("component").alias(f"c{c}"))
    open_edges = edges.join(part("a"), F.expr("a = na"), "left").join(part("b"), F.expr("b = nb"), "left").where("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b")
    found = components(linked.union(verified(open_edges, texts, words, tenths)).union(crowded(crowd, texts, parts, words, tenths)))
    grouped = nodes.join(found.withColumnRenamed("node", "linked"), F.expr("node = linked"), "left").groupBy(F.coalesce("component", "node").alias("component"))
    return grouped.agg(F.min("least").alias("least")).select("least.doc_id", "least.key")


def repeats(rows: DataFrame) -> bool:
    """Whether a row occurs twice, with the same id and text."""
    return not rows.groupBy("doc_id", "key").count().where("count > 1").isEmpty()
