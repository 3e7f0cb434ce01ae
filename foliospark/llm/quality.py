"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation over the
counts of vote patterns of all documents estimates each labeller's accuracy and the share of good
documents; the posterior of a document's pattern is its label. A hashed linear scorer learns from a
bounded sample of documents (the `sample` least id hashes, each id once) with their posteriors and scores all texts.

Defined cases: null and empty texts get votes from their (zero) sizes and a score like any other; a null
id is kept; rows with equal ids are scored alike; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import batch_of, blocks, fetched, utf8
from .windows import BYTE_UNIT, WHITESPACE, mix, word_bounds, word_units

BITS = 14
LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
UPPER = np.array([65 <= b <= 90 for b in range(256)])
SIGN = np.array([33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'\"-()?" for b in range(256)])
#: Classes of bytes for the shape of a word.
SHAPE = np.array([0 if WHITESPACE[b] else 1 if UPPER[b] else 2 if LETTER[b] else 3 if 48 <= b <= 57 else 4 if chr(b) in ".," else 5 + b % 8 for b in range(256)], np.uint64)
#: Names of the measures; each is a share or a size.
MEASURES = ("words", "signs", "upper", "repeats", "distinct", "lines", "bars")


def measures(data: np.ndarray, off: np.ndarray):
    """A row of MEASURES for each text, with word hashes and offsets."""
    n = len(off) - 1
    first, end, words = word_bounds(data, off, WHITESPACE)
    units = word_units(data, first, end)
    size = np.maximum(1, np.diff(off))
    total = lambda table: np.diff(np.append(0, np.cumsum(table[data], dtype=np.int64))[off])
    letters = np.maximum(1, total(LETTER))
    out = np.zeros((n, len(MEASURES)))
    count = np.diff(words)
    out[:, 0] = count
    out[:, 1] = total(SIGN) / size
    out[:, 2] = total(UPPER) / letters
    same = np.append(0, np.cumsum(np.append(False, units[1:] == units[:-1])))
    out[:, 3] = (same[words[1:]] - same[np.minimum(words[:-1] + 1, words[1:])]) / np.maximum(1, count)
    row = np.repeat(np.arange(n, dtype=np.uint64), count)
    pairs = np.unique(mix(units ^ mix(row)), return_index=True)[1]
    out[:, 4] = np.bincount(row[pairs].astype(np.int64), minlength=n) / np.maximum(1, count)
    breaks = np.zeros(256, bool)
    breaks[10] = True
    out[:, 5] = total(breaks) / np.maximum(1, count)
    bar = np.zeros(256, bool)
    bar[ord("|")] = True
    out[:, 6] = total(bar) / np.maximum(1, count)
    return out, units, words, first, end


def votes(m: np.ndarray) -> np.ndarray:
    """Votes of the labellers, a column each: 1 good, -1 bad, 0 none."""
    words, signs, upper, repeats, distinct, lines, bars = m.T
    vote = lambda bad, good: np.where(bad, -1, np.where(good, 1, 0))
    return np.stack(
        [
            vote(signs > 0.06, signs < 0.02),
            vote(upper > 0.4, upper < 0.2),
            vote(repeats > 0.2, repeats < 0.05),
            vote((distinct < 0.3) & (words >= 20) & (words < 4000), (distinct > 0.5) & (words >= 20)),
            vote((bars > 0.2) | (lines > 0.5), (bars == 0) & (lines < 0.3)),
            vote(words < 5, words >= 30),
        ],
        axis=1,
    ).astype(np.int8)


def pattern(v: np.ndarray) -> np.ndarray:
    return ((v.astype(np.int64) + 1) * 3 ** np.arange(v.shape[1])).sum(1)


LABELLERS = 6


def unpattern(p: np.ndarray) -> np.ndarray:
    return p[:, None] // 3 ** np.arange(LABELLERS) % 3 - 1


def estimate(counts: dict[int, int], rounds: int = 200) -> dict[int, float]:
    """Posterior of good for each vote pattern: EM of a model in which labellers err on their own given the truth."""
    p = np.array(sorted(counts), np.int64)
    if not len(p):
        return {}
    n = np.array([counts[i] for i in p.tolist()], float)
    v = unpattern(p)
    good = (1 + np.tanh(v.sum(1) / 2)) / 2
    for _ in range(rounds):
        share = np.clip((n * good).sum() / n.sum(), 1e-3, 1 - 1e-3)
        like = np.log([1 - share, share])[:, None].repeat(len(p), 1)
        for kind, weight in ((0, n * (1 - good)), (1, n * good)):
            for j in range(LABELLERS):
                rate = np.array([((v[:, j] == x) * weight).sum() + 0.5 for x in (-1, 0, 1)])
                like[kind] += np.log(rate / rate.sum())[v[:, j] + 1]
        fresh = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
        done = np.abs(fresh - good).max() < 1e-9
        good = fresh
        if done:
            break
    return dict(zip(p.tolist(), good.tolist(), strict=True))


def features(data, off):
    """(row, column, value) of sparse features: hashed shapes of words, hashed words, and measures in steps."""
    m, units, words, first, end = measures(data, off)
    n = len(off) - 1
    shape = np.append(SHAPE[data], np.uint64(0))
    a, b = shape[first], shape[np.maximum(first, end - 1)]
    middle = shape[(first + end) // 2]
    kind = mix(a | b << np.uint64(8) | middle << np.uint64(16) | np.minimum(end - first, 12).astype(np.uint64) << np.uint64(24))
    row = np.repeat(np.arange(n), np.diff(words))
    weight = 1 / np.maximum(1, np.diff(words))[row]
    mask = np.uint64((1 << (BITS - 1)) - 1)
    step = np.floor(np.log2(1 + m * np.array([1, 64, 64, 64, 64, 64, 64]))).astype(np.int64)
    extra = (1 << BITS) + np.arange(len(MEASURES)) * 32 + np.clip(step, 0, 31)
    return (
        np.concatenate([row, row, np.repeat(np.arange(n), len(MEASURES))]),
        np.concatenate([(kind & mask).astype(np.int64), (units & mask).astype(np.int64) + (1 << (BITS - 1)), extra.reshape(-1)]),
        np.concatenate([weight * 4, weight, np.full(extra.size, 0.5)]),
        m,
    )


SIZE = (1 << BITS) + 32 * len(MEASURES)


class Linear:
    def __init__(self):
        self.w = np.zeros(SIZE)
        self.b = 0.0

    def logits(self, row, col, value, n):
        return np.bincount(row, self.w[col] * value, n) + self.b

    def fit(self, parts, target: np.ndarray, rounds: int = 60, rate: float = 0.5):
        row, col, value, n = parts
        power, at = np.full(SIZE, 1e-4), 1e-4
        for _ in range(rounds):
            g = (1 / (1 + np.exp(-np.clip(self.logits(row, col, value, n), -30, 30))) - target) / n
            grad = np.bincount(col, g[row] * value, SIZE)
            power += grad * grad
            at += g.sum() ** 2
            self.w -= rate * grad / np.sqrt(power)
            self.b -= rate * g.sum() / np.sqrt(at)
        return self


def patterns(docs: DataFrame) -> DataFrame:
    """doc_id, pattern: the votes of all labellers."""
    schema = pa.schema([("doc_id", pa.int64()), ("pattern", pa.int32())])

    def scan(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            out = [pattern(votes(measures(data[off[a] : off[b]], off[a : b + 1] - off[a])[0])) for a, b in blocks(off)]
            yield batch_of(schema, [batch.column("doc_id"), np.concatenate(out) if out else []])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, pattern int")


def train(docs: DataFrame, sample: int = 4000, most_bytes: int = 1 << 26):
    """(posterior by pattern, linear scorer). At most `sample` documents and most_bytes characters of text reach the driver."""
    counts = {r["pattern"]: r["n"] for r in patterns(docs).groupBy("pattern").agg(F.count("*").alias("n")).collect()}  # 729 patterns at most
    posterior = estimate(counts)
    ids = docs.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id")
    texts = [(r["text"] or "").encode() for r in sorted(fetched(rows, most_bytes), key=lambda r: r["doc_id"])]
    model = Linear()
    if texts:
        parts, targets, base = [], [], 0
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        data = np.frombuffer(b"".join(texts), np.uint8)
        for a, b in blocks(off):
            r, c, v, m = features(data[off[a] : off[b]], off[a : b + 1] - off[a])
            parts.append((r + base, c, v))
            targets.append(pattern(votes(m)))
            base += b - a
        row, col, value = (np.concatenate(x) for x in zip(*parts, strict=True))
        target = np.array([posterior[p] for p in np.concatenate(targets).tolist()])
        model.fit((row, col, value, len(texts)), target)
    return posterior, model


def quality(docs: DataFrame, sample: int = 4000) -> DataFrame:
    """doc_id, score (0 to 1, of the scorer), weak (posterior of the votes), good (score of a half or more)."""
    posterior, model = train(docs, sample)
    held = docs.sparkSession.sparkContext.broadcast((posterior, model))  # of fixed size
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("weak", pa.float64())])

    def scan(batches):
        posterior, model = held.value
        for batch in batches:
            data, off = utf8(batch.column("text"))
            score, weak = np.zeros(len(batch)), np.zeros(len(batch))
            for a, b in blocks(off):
                row, col, value, m = features(data[off[a] : off[b]], off[a : b + 1] - off[a])
                score[a:b] = 1 / (1 + np.exp(-np.clip(model.logits(row, col, value, b - a), -30, 30)))
                weak[a:b] = [posterior.get(p, 0.5) for p in pattern(votes(m)).tolist()]
            yield batch_of(schema, [batch.column("doc_id"), score, weak])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, score double, weak double").withColumn("good", F.col("score") >= 0.5)
