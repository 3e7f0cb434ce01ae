"""Near copies in crowds whose links are all close to 0.8, and the SimHash step, against brute force."""

import random

import numpy as np

import corpus_pipeline
from foliospark.llm import nearcopies
from tests.llm.test_nearcopies import frame, groups


def crowd(n, seed=6):
    """Texts of one base with some edits each; they share bands, but few pairs reach 0.8, and barely."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for _ in range(n):
        copy = list(base)
        for at in rng.sample(range(200), rng.randint(3, 5)):
            copy[at] = f"x{rng.randint(0, 999)}"
        rows.append(copy)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_no_link_is_lost_in_a_crowd(spark, monkeypatch):
    rows = crowd(400)
    want = sorted(min(i for i, _ in g) for g in groups(rows))
    assert 40 < len(want) < 360
    for block in (512, 60):
        monkeypatch.setattr(nearcopies, "BLOCK", block, raising=False)
        got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), "").collect())
        assert got == want


def test_fingerprints_meet(spark):
    """The SimHash step finds copies by itself, of few differing bits."""
    rng = random.Random(2)
    rows = []
    for k in range(20):
        words = [f"v{rng.randint(0, 9999)}" for _ in range(300)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:150], "edit", *words[150:]]))]
    signed = nearcopies.signatures(frame(spark, rows), 5)
    fp = {r["doc_id"]: r["fp"] for r in signed.collect()}
    node = {r["node"]: r["doc_id"] for r in signed.collect()}
    want = {(i, j) for i in fp for j in fp if i < j and np.bitwise_count(np.int64(fp[i] ^ fp[j]).view(np.uint64)) <= nearcopies.BITS}
    got = {tuple(sorted((node[r["a"]], node[r["b"]]))) for r in nearcopies.close(signed).collect()}
    assert got == want and len({(i, i + 1) for i in range(0, 40, 2)} & got) > 10
