"""Window, suffix and fingerprint operators against brute force."""

import hashlib
import random
import shutil
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from foliospark.llm import simhash, substring, suffix, textlog
from foliospark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g long, rid string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, "x") for i, t in rows], SCHEMA)


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["é", "ñandú", "a"]
    passages = [[rng.choice(words) for _ in range(k)] for k in (49, 50, 51, 60, 130)]
    rows = []
    for i in range(n):
        out = []
        for _ in range(rng.randint(0, 4)):
            out += [rng.choice(words) for _ in range(rng.randint(0, 90))]
            if rng.random() < 0.6:
                p = list(rng.choice(passages))
                if rng.random() < 0.3:
                    p[rng.randrange(len(p))] = "edit"
                out += p
        rows.append((i * 3, rng.choice([" ", "  ", "\n"]).join(out)))
    rows += [(1000, rows[5][1]), (1001, rows[5][1] + " tail"), (1002, None), (1003, ""), (1004, "a " * 400), (None, rows[7][1]), (4, "x y z")]
    return rows


def removed_words(rows, window):
    first = {}
    key = lambda i: (1 << 63) - 1 if i is None else i
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, key(i)), key(i))
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < key(i):
                gone.update(range(p, p + window))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_substrings(spark, batches):
    rows = corpus()
    got = substring.digest(substring.dedup_substrings(frame(spark, rows), batches=batches)).collect()
    assert Counter(tuple(r) for r in got) == removed_words(rows, 50)
    assert sum(r["n_removed"] for r in got) > 500


def removed_bytes(rows, window):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[p : p + window] for _, t in texts for p in range(len(t) - window + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - window + 1):
            if count[t[p : p + window]] > 1:
                gone[p : p + window] = True
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone[: len(t)]])).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("crowd", [3, 256])
def test_bytes(spark, crowd):
    rows = [*corpus(5), (2000, "ab" * 300), (2001, "q" * 199), (2002, "r" * 200), (2003, "r" * 200)]
    df = frame(spark, rows)
    index = suffix.SuffixIndex(spark, 200, 48, crowd)
    for batch in substring.by_id(df, 3):
        index.add(batch)
    got = suffix.digest(index.clean()).collect()
    assert Counter(tuple(r) for r in got) == removed_bytes(rows, 200)
    assert [level.rank for level in index.levels] == [1, 0]


def thue_morse(n, flip):
    return "".join("ab"[(i.bit_count() + flip) % 2] for i in range(n))


def test_structured_texts(spark):
    """Words that a polynomial hash modulo 2^64 can't tell apart: no window is shared, nothing goes."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join([*words[:20], thue_morse(1024, 0), *words[20:]])), (2, " ".join([*words[:20], thue_morse(1024, 1), *words[20:]]))]
    rows += [(3, thue_morse(4096, 0)), (4, thue_morse(3000, 1))]
    df = frame(spark, rows)
    assert Counter(tuple(r) for r in substring.digest(substring.dedup_substrings(df)).collect()) == removed_words(rows, 50)
    assert Counter(tuple(r) for r in suffix.digest(suffix.dedup_bytes(df)).collect()) == removed_bytes(rows, 200)


def test_index_outlives_its_texts(spark, tmp_path):
    """Batches are cleaned against earlier ones whose tables are gone, after save() and load() too."""
    rows = sorted(corpus(11), key=lambda r: (r[0] is None, r[0] or 0))
    index, got = substring.WindowIndex(spark, path=str(tmp_path / "index")), []
    for k in range(3):
        part = rows[k * len(rows) // 3 : (k + 1) * len(rows) // 3]
        folder = str(tmp_path / f"batch{k}")
        frame(spark, part).write.parquet(folder)
        got += substring.digest(index.dedup(spark.read.parquet(folder))).collect()
        shutil.rmtree(folder)
        index = substring.WindowIndex.load(spark, index.save())
    assert [run.rank for run in index.runs] == [1, 0]
    assert Counter(tuple(r) for r in got) == removed_words(rows, 50)


def test_blocks_lie_in_their_bucket(spark):
    keys = np.array([0, 1, -5, 1 << 40, 123456789012345], np.int64)
    assert [r[0] for r in spark.createDataFrame([(int(k),) for k in keys], "k long").selectExpr("hash(k)").collect()] == textlog.spark_hash(keys).tolist()
    texts = textlog.store(frame(spark, corpus()), 3)
    other = texts.select("blk").withColumnRenamed("blk", "b").hint("shuffle_hash")
    joined = texts.join(other.repartition(7), F.expr("blk = b"))
    assert joined.count() == texts.count() and texts.selectExpr("sum(size(ids))").first()[0] == len(corpus())
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1  # of the other side alone


def test_empty(spark):
    df = frame(spark, [])
    assert substring.dedup_substrings(df).count() == 0
    assert suffix.dedup_bytes(df).count() == 0
    assert simhash.near_duplicates(df).count() == 0


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    rng = random.Random(1)
    rows = corpus(9, 40)
    base = [rng.choice(["alpha", "beta", "Gamma", "É", "delta"]) + str(rng.randint(0, 50)) for _ in range(200)]
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(200)] = "edit%d" % rng.randint(0, 9)
        rows.append((5000 + i, " ".join(w)))
    got = {r["doc_id"]: r for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    fp = [(i, fingerprint(t)) for i, t in rows]
    parent = {k: k for k in range(len(fp))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fp)):
        for b in range(a):
            if (fp[a][1] ^ fp[b][1]).bit_count() <= 4:
                parent[find(a)] = find(b)
    least = defaultdict(lambda: 1 << 62)
    for k, (i, _) in enumerate(fp):
        least[find(k)] = min(least[find(k)], 1 << 62 if i is None else i)
    assert len(got) == len(rows)
    for k, (i, f) in enumerate(fp):
        assert got[i]["fingerprint"] == f"{f:016x}"
        assert got[i]["component_id"] == least[find(k)]


def test_forest_and_pairs_agree():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    x = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for b in base]))

    def groups(edges):
        p = {int(v): int(v) for v in x}

        def find(v):
            while p[v] != v:
                v = p[v]
            return v

        for a, b in edges:
            p[find(int(a))] = find(int(b))
        return {frozenset(int(v) for v in x if find(int(v)) == r) for r in {find(int(v)) for v in x}}

    pairs = [(a, b) for i, a in enumerate(x) for b in x[:i] if int(a ^ b).bit_count() <= 4]
    forest = simhash.forest(x, 4)
    assert len(forest) < len(x) and groups(pairs) == groups(forest)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (300, 100), (77, 76), (5, 5)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and got[300] == got[200] == 100 and got[77] == 76
