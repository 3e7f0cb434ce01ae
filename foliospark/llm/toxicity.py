"""Toxicity by a convolutional text classifier.

Words (runs of letters and digits, A-Z lower-cased) are hashed twice; a word's embedding is the pair of
both table rows, so two rare words must collide in both tables to be confused. Filters of several
widths slide over the embeddings, are max-pooled over the text and feed a logistic unit. Everything is
trained in numpy on the executors, on all labelled rows that aren't held out, each id once. They are dealt by a hash of the
id into shards of about SHARD_ROWS rows or SHARD_BYTES bytes of text. In a round every shard goes on from the common weights
for one epoch; what a weight gains is the mean over the shards that touched it. With one shard this is plain training. Only words in `seen`
of the texts fitted or more have an embedding, so that a text isn't learnt by its rarest words; all other words are zero. Thresholds are
calibrated by language on the fifth of the rows that isn't used for fitting, all of it, with scores in steps of 1 / STEPS, 0.5 at least; a
score itself sees the text alone. The driver gets weights, counts of slots and thresholds, whatever the number of rows.

Defined cases: null and empty texts have no words and get the score of an empty text; without labelled
rows of both kinds every score is 0 and nothing is flagged; of rows that repeat an id one is learnt from, of ids labelled both ways none; a null language uses the threshold of
all; extra columns are ignored.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import batch_of, blocks, held_out, utf8
from .windows import BYTE_UNIT, word_bounds, word_units

BITS, DIM, WIDTHS, FILTERS = 16, 8, (1, 2, 3), 8
#: Bytes that part words: all ASCII but letters and digits.
SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: A-Z count as a-z.
FOLDED = BYTE_UNIT.copy()
FOLDED[65:91] = BYTE_UNIT[97:123]
OFFSETS = [(w, j) for w in WIDTHS for j in range(w)]
#: About the rows, and the bytes of text, of one shard.
SHARD_ROWS, SHARD_BYTES = 8192, 1 << 26
#: Pieces in which the shards' weights are added up.
PARTS = 16
#: Bits of the map of learnable ids, by which most other texts are passed over before a shuffle.
MAP_BITS = 25
#: Steps of a score between 0 and 1 when thresholds are set.
STEPS = 1 << 16


def word_ids(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of every word, and row offsets in words."""
    first, end, words = word_bounds(data, off, SEPARATOR)
    h = word_units(data, first, end, FOLDED)
    mask = np.uint64((1 << BITS) - 1)
    return np.stack([h & mask, h >> np.uint64(32) & mask]).astype(np.int32), words


class TextCnn:
    """Hash-embedding CNN; weights: tables (2, 2^BITS, DIM), filters (2*DIM, offsets*FILTERS), bias and output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.05, (2, 1 << BITS, DIM)).astype(np.float32)
        self.conv = rng.normal(0, 0.3, (2 * DIM, len(OFFSETS) * FILTERS)).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.scale, self.shift = 1.0, 0.0

    def pooled(self, ids: np.ndarray, words: np.ndarray, where: bool = False):
        """Max-pooled filters of each row (0 at least), and where each maximum is."""
        rows = len(words) - 1
        best = np.zeros((rows, len(self.bias)), np.float32)
        at = np.zeros((rows, len(self.bias)), np.int64)
        size = np.diff(words)
        x = np.concatenate([self.table[0][ids[0]], self.table[1][ids[1]]], axis=1) @ self.conv
        k = 0
        for i, width in enumerate(WIDTHS):
            z = x[:, k * FILTERS : (k + 1) * FILTERS].copy()
            for j in range(1, width):
                z[: len(z) - j] += x[j:, (k + j) * FILTERS : (k + j + 1) * FILTERS]
            k += width
            full = np.flatnonzero(size >= width)
            if not len(full):
                continue
            # windows that would run into the next row don't count
            for j in range(1, width):
                z[words[1:][size >= j] - j] = -1e30
            part = slice(i * FILTERS, (i + 1) * FILTERS)
            top = np.maximum.reduceat(z, words[:-1][full], axis=0) + self.bias[part]
            best[full, part] = np.maximum(top, 0)
            if where:
                for r, t in zip(full.tolist(), top, strict=True):
                    at[r, part] = z[words[r] : words[r + 1]].argmax(0) + words[r]
        return best, at

    def logits(self, ids, words):
        return (self.pooled(ids, words)[0] @ self.out) * self.scale + self.shift

    def start(self) -> None:
        """Adagrad's sums: one a word and table, one a weight elsewhere."""
        self.power = [np.full(x, 1e-6, np.float32) for x in (self.table.shape[:2], self.conv.shape, self.bias.shape, self.out.shape)]

    def keep(self, texts_with: np.ndarray, seen: int) -> None:
        """Only slots that `seen` texts have get an embedding."""
        self.known = texts_with >= seen
        self.table[~self.known] = 0

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = 8, rate: float = 0.05, size: int = 32, seed: int = 1, seen: int = 3) -> None:
        done = [word_ids(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
        self.start()
        self.keep(slots(done), seen)
        self.learn(done, labels, epochs, rate, size, seed)

    def learn(self, done: list[np.ndarray], labels: np.ndarray, epochs: int, rate: float = 0.05, size: int = 32, seed: int = 1) -> None:
        """Go on from the weights as they are; done: the word ids of each text."""
        rng = np.random.default_rng(seed)
        bias = self.shift

        def adagrad(p, g, s):
            s += g * g
            p -= rate * g / np.sqrt(s)

        for _ in range(epochs):
            order = rng.permutation(len(done))
            for a in range(0, len(order), size):
                pick = order[a : a + size]
                ids = np.concatenate([done[i] for i in pick], axis=1)
                words = np.concatenate([[0], np.cumsum([done[i].shape[1] for i in pick])])
                if not ids.shape[1]:
                    continue
                best, at = self.pooled(ids, words, True)
                delta = (1 / (1 + np.exp(-np.clip(best @ self.out + bias, -30, 30))) - labels[pick]).astype(np.float32) / len(pick)
                flow = delta[:, None] * self.out * (best > 0)
                bias -= rate * 4 * float(delta.sum())
                conv = np.zeros_like(self.conv)
                keys, grads = [], []
                k = 0
                for i, width in enumerate(WIDTHS):
                    part = slice(i * FILTERS, (i + 1) * FILTERS)
                    r, f = np.nonzero(flow[:, part])
                    d = flow[:, part][r, f]
                    for j in range(width):
                        col = (k + j) * FILTERS + f
                        pos = at[:, part][r, f] + j
                        e = np.concatenate([self.table[0][ids[0][pos]], self.table[1][ids[1][pos]]], axis=1)
                        np.add.at(conv.T, col, e * d[:, None])
                        keys.append(pos)
                        grads.append(self.conv[:, col].T * d[:, None])
                    k += width
                adagrad(self.out, (best * delta[:, None]).sum(0), self.power[3])
                adagrad(self.bias, flow.sum(0), self.power[2])
                if keys:
                    pos, g = np.concatenate(keys), np.concatenate(grads)
                    for t in (0, 1):
                        u, inv = np.unique(ids[t][pos], return_inverse=True)
                        sums = np.zeros((len(u), DIM), np.float32)
                        np.add.at(sums, inv, g[:, t * DIM : (t + 1) * DIM])
                        u, sums = u[self.known[t][u]], sums[self.known[t][u]]
                        s = self.power[0][t]
                        s[u] += (sums * sums).mean(1)
                        self.table[t][u] -= rate * sums / np.sqrt(s[u])[:, None]
                adagrad(self.conv, conv, self.power[1])
        self.scale, self.shift = 1.0, bias

    def words(self) -> np.ndarray:
        """One row a slot of both tables: its embedding and Adagrad's sum."""
        return np.concatenate([self.table.reshape(-1, DIM), self.power[0].reshape(-1, 1)], axis=1)

    def rest(self) -> np.ndarray:
        """All other weights, their sums and the bias."""
        return np.concatenate([x.ravel() for x in (self.conv, self.bias, self.out, *self.power[1:])] + [[self.shift]]).astype(np.float64)

    def gain(self, words: np.ndarray, rest: np.ndarray) -> None:
        """Add what words() and rest() have gained."""
        self.table += words[:, :DIM].reshape(self.table.shape)
        self.power[0] += words[:, DIM].reshape(self.power[0].shape)
        for x in (self.conv, self.bias, self.out, *self.power[1:]):
            x += rest[: x.size].reshape(x.shape).astype(np.float32)
            rest = rest[x.size :]
        self.shift += float(rest[0])

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        out = np.zeros(len(off) - 1)
        for a, b in blocks(off, 1 << 17):
            ids, words = word_ids(data[off[a] : off[b]], off[a : b + 1] - off[a])
            out[a:b] = 1 / (1 + np.exp(-np.clip(self.logits(ids, words), -30, 30))) if ids.shape[1] else 1 / (1 + np.exp(-self.shift))
        return out


def slots(done: list[np.ndarray]) -> np.ndarray:
    """How many of the texts have each slot of both tables."""
    out = np.zeros((2, 1 << BITS), np.int64)
    for ids in done:
        for t in (0, 1):
            out[t][np.unique(ids[t])] += 1
    return out


def threshold(score: np.ndarray, label: np.ndarray, count: np.ndarray | None = None) -> float:
    """The cut with the best F1, in the middle of its gap; count: how many rows each entry stands for."""
    order = np.argsort(-score, kind="stable")
    n = np.ones(len(score), np.int64) if count is None else count[order]
    s, y = score[order], label[order] * n
    tp = np.cumsum(y)
    last = np.append(s[1:] != s[:-1], True)
    f1 = np.where(last, 2 * tp / (np.cumsum(n) + max(1, y.sum())), -1)
    best = int(f1.argmax())
    return float((s[best] + (s[best + 1] if best + 1 < len(s) else 0)) / 2)


def used() -> Column:
    """Rows to fit on; the other fifth calibrates."""
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("use")), F.lit(5)) != 0


def likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without most of the rows whose doc_id isn't in ids: a map of 2^MAP_BITS bits is all that is broadcast; a join must follow."""
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("map")), F.lit(1 << MAP_BITS))
    place, bit = F.floor(slot / 64).cast("int").alias("_at"), F.pmod(slot, F.lit(64)).cast("int")
    bits = ids.select(place, F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit")).groupBy("_at").agg(F.bit_or("_bit").alias("_bits"))
    mine = docs.select("*", place, bit.alias("_bit"))
    return mine.join(F.broadcast(bits), "_at").where("(shiftrightunsigned(_bits, _bit) & 1) = 1").select(*docs.columns)


def hashed(texts: DataFrame, agreed: DataFrame, shards: int) -> DataFrame:
    """doc_id, toxic, ids (both hashes of every word), shard: of each id its label and then its text, shards whole and in the order of ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("ids", pa.binary())])

    def scan(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            ids = []
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                ids.append(word_ids(data[a:b], np.array([0, b - a]))[0].astype(np.uint16).tobytes())
            yield batch_of(schema, [batch.column("doc_id"), pa.nulls(len(batch), pa.int32()), ids])

    found = texts.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, toxic int, ids binary")
    both = found.unionByName(agreed.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"), F.lit(None).cast("binary").alias("ids")))
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int")
    return both.withColumn("shard", shard).repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", F.col("toxic").asc_nulls_last())


def by_shard(batches):
    """(shard, word ids of each text, labels): texts take the label of their id that goes before them; the others are left out."""
    last, done, labels, label = None, [], [], (None, None)
    for batch in batches:
        for shard, id, toxic, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "toxic")), batch.column("ids"), strict=True):
            if shard != last:
                if done:
                    yield last, done, np.array(labels, np.float32)
                last, done, labels = shard, [], []
            if toxic is not None:
                label = id, toxic
            elif label[0] == id:
                done.append(np.frombuffer(ids.as_buffer(), np.uint16).reshape(2, -1).astype(np.int32))
                labels.append(label[1])
    if done:
        yield last, done, np.array(labels, np.float32)


def summed(fitted: DataFrame, work, made) -> list[np.ndarray]:
    """What work(word ids, labels) returns, a list of arrays, added up over the shards: rows of a first array in PARTS pieces, of which
    the driver gets what made(sums, number of shards where the row's last entry isn't 0) is, in 32 bits, and a second array with the number of shards.
    Shards are added in their order, so that partitions don't matter. A piece of gains has 295 KB: arrays of 512 KB or more take whole regions of the driver's heap."""
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("a", pa.binary())])
    result = pa.schema([("part", pa.int32()), ("a", pa.binary())])

    def each(batches):
        for shard, done, labels in by_shard(batches):
            rows, rest = work(done, labels)
            for i, x in enumerate(np.array_split(rows, PARTS)):
                yield batch_of(schema, [[i], [shard], [x.astype(np.float32).tobytes()]])
            yield batch_of(schema, [[PARTS], [shard], [rest.astype(np.float64).tobytes()]])

    def ended(part, total):
        x = made(total[:, :-1], total[:, -1:]).astype(np.float32) if part < PARTS else total
        return batch_of(result, [[part], [x.tobytes()]])

    def add(batches):
        last, total = None, None
        for batch in batches:
            for part, a in zip(batch.column("part").to_pylist(), batch.column("a").to_pylist(), strict=True):
                if part != last:
                    if last is not None:
                        yield ended(last, total)
                    last, total = part, 0.0
                if part < PARTS:
                    x = np.frombuffer(a, np.float32).reshape((2 << BITS) // PARTS, -1)
                    total = total + np.concatenate([x, x[:, -1:] != 0], axis=1).astype(np.float64)
                else:
                    total = total + np.append(np.frombuffer(a), 1.0)
        if last is not None:
            yield ended(last, total)

    parts = fitted.mapInArrow(each, "part int, shard int, a binary")
    found = parts.repartition(PARTS, "part").sortWithinPartitions("part", "shard").mapInArrow(add, "part int, a binary")
    got = {r["part"]: np.frombuffer(r["a"], np.float32 if r["part"] < PARTS else np.float64) for r in found.collect()}  # of fixed size
    return [np.concatenate([got[i].reshape((2 << BITS) // PARTS, -1) for i in range(PARTS)]), got[PARTS]]


def learnt(fitted: DataFrame, shards: int, epochs: int, seen: int = 3) -> TextCnn:
    """The model of all rows: one round of all epochs with one shard, else a round an epoch."""
    model = TextCnn()
    model.start()
    counts, _ = summed(fitted, lambda done, labels: (slots(done).reshape(-1, 1), np.zeros(0)), lambda sums, shards: sums)
    model.keep(counts[:, 0].reshape(2, -1), seen)
    context = fitted.sparkSession.sparkContext
    for i in range(1 if shards == 1 else epochs):
        held = context.broadcast(model)  # of fixed size

        def work(done, labels, held=held, i=i):
            net = copy.deepcopy(held.value)
            words, rest = net.words(), net.rest()
            net.learn(done, labels, epochs if shards == 1 else 1, seed=i + 1)
            return net.words() - words, net.rest() - rest

        words, rest = summed(fitted, work, lambda sums, shards: sums / np.maximum(1, shards))
        model.gain(words, rest[:-1] / rest[-1])
        held.destroy()
    return model


def calibrated(rows: DataFrame, model: TextCnn, least: int) -> dict:
    """Thresholds by language, and of all (''), from every row: counts of its labels at each step of the score are all that is grouped."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("lang", pa.string()), ("toxic", pa.int32()), ("step", pa.int32())])

    def scan(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            step = np.rint(held.value.scores(data, off) * STEPS).astype(np.int32)
            yield batch_of(schema, [batch.column("lang"), batch.column("toxic"), step])

    def cut(table):
        step, toxic, n = (table.column(c).to_numpy() for c in ("step", "toxic", "n"))
        return pa.table({"lang": table.column("lang")[:1], "cut": [threshold(step / STEPS, toxic, n)], "rows": [int(n.sum())], "bad": [int((toxic * n).sum())]})

    steps = rows.select("lang", F.col("toxic").cast("int"), "text").mapInArrow(scan, "lang string, toxic int, step int")
    counts = steps.groupBy("lang", "toxic", "step").agg(F.count("*").alias("n"))
    both = counts.where("lang IS NOT NULL").select(F.concat(F.lit("="), "lang").alias("lang"), "toxic", "step", "n")
    both = both.unionByName(steps.groupBy("toxic", "step").agg(F.count("*").alias("n")).withColumn("lang", F.lit("")))
    found = both.groupBy("lang").applyInArrow(cut, "lang string, cut double, rows long, bad long")
    cuts = {"": 0.5}
    for r in found.where("bad > 0").where(f"lang = '' OR rows >= {least} AND bad < rows").orderBy("lang").collect():  # one row a language
        if r["lang"] != "=":
            cuts[r["lang"][1:]] = max(0.5, r["cut"])
    return cuts


def train(docs: DataFrame, labels: DataFrame, least: int = 40, shard_rows: int = SHARD_ROWS, shard_bytes: int = SHARD_BYTES):
    """The model and its thresholds by language ('' is that of all), from all labelled rows that aren't held out."""
    fit = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    agreed = fit.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other").drop("other")
    rows = docs.select("doc_id", "lang", "text").where(F.col("doc_id").isNotNull() & ~held_out())
    # texts stay where they are while sizes are taken
    each = rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("bytes"))
    each = each.join(agreed, "doc_id", "left").withColumn("used", used() & F.col("toxic").isNotNull())
    size = F.coalesce(F.sum(F.when(F.col("used"), F.col("bytes"))), F.lit(0)).alias("bytes")
    known = each.agg(F.count_if("used").alias("used"), size, F.max("n").alias("most"), F.min("toxic").alias("low"), F.max("toxic").alias("high")).first()
    if known["low"] == known["high"] or not known["used"]:
        return None, {"": 2.0}
    rows = likely(rows, agreed)
    if known["most"] > 1:
        rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("row")).select("doc_id", "row.*")
    shards = max(1, -(-known["used"] // shard_rows), -(-known["bytes"] // shard_bytes))
    steps = max(1, known["used"] // shards // 32)
    fitted = hashed(rows.where(used()), agreed.where(used()), shards).persist(StorageLevel.DISK_ONLY)  # shards stay whole from round to round
    model = learnt(fitted, shards, min(60, max(6, 1500 // steps)))
    fitted.unpersist()
    return model, calibrated(rows.where(~used()).join(agreed, "doc_id"), model, least)


def score(docs: DataFrame, model, cuts: dict, column: str = "score", flag: str = "flagged") -> DataFrame:
    """docs with `column` (0 to 1) and `flag` (the score reaches the threshold of the row's language)."""
    spark = docs.sparkSession
    names = docs.columns
    schema = docs.withColumn(column, F.lit(0.0)).schema
    held = spark.sparkContext.broadcast(model)  # of fixed size: 2 * 2^BITS * DIM numbers

    def scan(batches):
        net = held.value
        for batch in batches:
            data, off = utf8(batch.column("text"))
            s = net.scores(data, off) if net else np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*names, column])

    cut = F.lit(cuts[""])
    for lang, c in cuts.items():
        if lang:
            cut = F.when(F.col("lang") == lang, c).otherwise(cut)
    return docs.mapInArrow(scan, schema).withColumn(flag, F.col(column) >= cut)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model, cuts = train(docs, labels)
    slim = docs.select(F.col("doc_id").cast("long"), "lang", "text")
    return score(slim, model, cuts)


def table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = toxicity(docs, labels)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "flagged")


__all__ = ["TextCnn", "score", "table", "threshold", "toxicity", "train"]
