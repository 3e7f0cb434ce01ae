"""SimHash near duplicates by deletion-variant signatures.

Fingerprints have 64 bits and link at `bits` (4) or fewer differences. They are cut into three
segments: of two linked fingerprints one segment differs in one bit at most. Each segment is indexed
with each of its bits in turn made a wildcard, 64 rows a fingerprint; linked ones meet under an equal
key and are verified. Equal fingerprints are one node from the start, so groups of copies cost one
row. Under a key, pairs are compared with numpy; a key that many fingerprints share gives a spanning
forest of its links instead of all pairs.

Defined cases: null and empty texts have fingerprint 0 and link like any other; a null id never is a
component's id unless no other is in it; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import batch_of, durable, partitions, utf8
from .components import components

#: (first bit, number of bits) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints under one key from which on a forest is made.
MANY = 48


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id, fp: SimHash over shingles of `words` lower-cased (A-Z) words."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    digest = xxhash.xxh64_digest

    def scan(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            out = np.zeros((len(batch), 8), np.uint8)
            for i in range(len(batch)):
                tokens = data[off[i] : off[i + 1]].tobytes().lower().split()
                if not tokens:
                    continue
                text = b" ".join(tokens)
                ends = np.cumsum([len(t) + 1 for t in tokens])
                n = max(1, len(tokens) - words + 1)
                first = [0, *ends[: n - 1].tolist()]
                last = (ends[min(words, len(tokens)) - 1 :][:n] - 1).tolist()
                ones = np.zeros(64, np.int64)
                for at in range(0, n, 1 << 15):
                    hashes = b"".join([digest(text[a:b], 42) for a, b in zip(first[at : at + (1 << 15)], last[at : at + (1 << 15)])])
                    ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
                out[i] = np.packbits(2 * ones > n)
            yield batch_of(schema, [batch.column("doc_id"), out.view(">u8")[:, 0].astype(np.uint64).view(np.int64)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, fp long")


def variants(nodes: DataFrame) -> DataFrame:
    """key, fp: 64 one-wildcard segment variants of each fingerprint."""
    keys = []
    for first, size in SEGMENTS:
        segment = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << size) - 1).cast("long"))
        for bit in range(size):
            keys.append(segment.bitwiseAND(F.lit(((1 << size) - 1) & ~(1 << bit)).cast("long")).bitwiseOR(F.lit((first + bit) << 32).cast("long")))
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "fp")


def forest(x: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints x: balls around pivots, then links between near balls."""
    parent = list(range(len(x)))

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    edges, pivots, balls = [], [], []
    rest = np.arange(len(x))
    while len(rest):
        p = rest[0]
        near = np.bitwise_count(x[rest] ^ x[p]) <= bits
        ball = rest[near]
        for v in ball[1:].tolist():
            parent[v] = int(p)
            edges.append((x[p], x[v]))
        pivots.append(int(p))
        balls.append(ball)
        rest = rest[~near]
    centre = x[pivots]
    for i, p in enumerate(pivots):
        for j in (np.flatnonzero(np.bitwise_count(centre[i + 1 :] ^ centre[i]) <= 3 * bits) + i + 1).tolist():
            if find(p) == find(pivots[j]):
                continue
            for v in balls[i].tolist():
                close = np.flatnonzero(np.bitwise_count(x[balls[j]] ^ x[v]) <= bits)
                if len(close):
                    w = int(balls[j][close[0]])
                    edges.append((x[v], x[w]))
                    parent[find(v)] = find(w)
                    break
    return edges


def links(keyed: DataFrame, bits: int) -> DataFrame:
    """a, b: fingerprints that link, found among those with equal keys; every component stays connected."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(key, fp):
        """Links of small groups, each under the first key at which its fingerprints meet only."""
        slot = (key >> 32).astype(np.int64)
        for d in range(1, MANY):
            same = np.flatnonzero(key[d:] == key[:-d])
            if not len(same):
                return
            diff = fp[same] ^ fp[same + d]
            close = np.bitwise_count(diff) <= bits
            same, diff = same[close], diff[close]
            meet = np.full(len(same), -1, np.int64)
            for first, size in SEGMENTS:
                part = diff >> np.uint64(first) & np.uint64((1 << size) - 1)
                n = np.bitwise_count(part)
                at = first + np.where(n == 0, 0, np.log2(np.maximum(part, 1).astype(np.float64)).astype(np.int64))
                meet = np.where((meet < 0) & (n <= 1), at, meet)
            same = same[meet == slot[same]]
            if len(same):
                yield batch_of(schema, [fp[same].view(np.int64), fp[same + d].view(np.int64)])

    def compare(batches):
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        held: list[np.ndarray] = []

        def flush(keys, prints):
            edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            size = np.diff(np.append(edge, len(keys)))
            for e, n in zip(edge[size > MANY].tolist(), size[size > MANY].tolist(), strict=True):
                if found := forest(prints[e : e + n], bits):
                    x = np.array(found, np.uint64)
                    yield batch_of(schema, [x[:, 0].copy().view(np.int64), x[:, 1].copy().view(np.int64)])
            small = np.repeat((size <= MANY) & (size > 1), size)
            yield from pairs(keys[small], prints[small])

        for batch in batches:
            k, f = (batch.column(c).to_numpy() for c in ("key", "fp"))
            if len(keys) and k[-1] == keys[-1] and k[0] == k[-1]:  # a key goes on over whole batches
                held.append(f.view(np.uint64))
                continue
            if held:
                keys, prints = np.append(keys, np.full(sum(map(len, held)), keys[-1])), np.concatenate([prints, *held])
                held = []
            keys, prints = np.append(keys, k), np.append(prints, f.view(np.uint64))
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            if cut:
                yield from flush(keys[:cut], prints[:cut])
                keys, prints = keys[cut:], prints[cut:]
        if held:
            keys, prints = np.append(keys, np.full(sum(map(len, held)), keys[-1])), np.concatenate([prints, *held])
        if len(keys):
            yield from flush(keys, prints)

    n = partitions(keyed.sparkSession)
    return keyed.repartition(n, "key").sortWithinPartitions("key").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (the least id of all that are linked, directly or not)."""
    prints = durable(fingerprints(docs, words))
    nodes = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(variants(nodes.select("fp")), bits))
    rooted = nodes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    first = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = rooted.join(first, "component").select(F.col("fp").alias("cfp"), "component_id")
    return prints.join(classes, F.col("fp") == F.col("cfp")).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
