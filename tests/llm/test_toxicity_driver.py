"""What the shards of a round have learnt reaches the driver as one mean, in pieces that are small for its heap."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import toxicity

SHARDS = 3


@pytest.fixture
def fitted(spark):
    rows = [(i, f"w{i % 7} w{i % 11} w{i % 13} own{i % 100}" + (" scum" if i % 4 == 0 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return toxicity.hashed(docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")), SHARDS)


def test_pieces_of_a_round_are_small(spark, fitted, monkeypatch):
    kind, sizes = type(fitted), []
    plain = kind.collect

    def collect(self):
        found = plain(self)
        sizes.append([len(r["a"]) for r in found])
        return found

    monkeypatch.setattr(kind, "collect", collect)
    toxicity.learnt(fitted, SHARDS, 2)
    assert len(sizes) == 3 and max(max(x) for x in sizes) < 1 << 19
    assert all(sum(x) <= (2 << toxicity.BITS) * (toxicity.DIM + 1) * 4 + (1 << 15) for x in sizes)


def test_a_round_is_the_mean_of_its_shards(spark, fitted):
    """Held against shards learnt here, one after the other, with sums of 64 bits."""
    by: dict = {}
    for r in fitted.collect():
        by.setdefault(r["shard"], {}).setdefault(r["doc_id"], {}).update({k: r[k] for k in ("toxic", "ids") if r[k] is not None})
    shards = []
    for _, docs in sorted(by.items()):
        rows = [docs[k] for k in sorted(docs)]
        shards.append(([np.frombuffer(r["ids"], np.uint16).reshape(2, -1).astype(np.int32) for r in rows], np.array([r["toxic"] for r in rows], np.float32)))
    model = toxicity.TextCnn()
    model.start()
    model.keep(sum(toxicity.slots(done) for done, _ in shards), 3)
    start, rest = model.words(), model.rest()
    gains, rests = [], []
    for done, labels in shards:
        net = toxicity.copy.deepcopy(model)
        net.learn(done, labels, 1, seed=1)
        gains.append((net.words() - start).astype(np.float64))
        rests.append(net.rest() - rest)
    met = sum((g[:, -1:] != 0).astype(np.float64) for g in gains)
    model.gain((sum(gains) / np.maximum(1, met)).astype(np.float32), sum(rests) / len(shards))
    got = toxicity.learnt(fitted, SHARDS, 1)
    assert len(shards) == SHARDS and met.max() == SHARDS and 0 < (met == 1).sum()
    assert np.array_equal(got.table, model.table) and np.array_equal(got.power[0], model.power[0]) and np.allclose(got.rest(), model.rest(), rtol=1e-6)
