"""The pipeline's near copies and row keys, against brute force."""

import random

import pytest

import corpus_pipeline
from foliospark.llm import nearcopies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def groups(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    out = {}
    for k in range(len(rows)):
        out.setdefault(find(k), []).append(rows[k])
    return list(out.values())


def corpus(seed=4):
    """Planted near copies around 0.8, and groups of more than MANY of them."""
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    rows = []
    for _ in range(40):
        base = text(rng.randint(60, 400))
        rows.append(base)
        for share in (0.01, 0.02, 0.03):
            copy = list(base)
            for _ in range(max(1, int(share * len(copy)))):
                copy[rng.randrange(len(copy))] = "edit"
            rows.append(copy)
    for n in (50, 300):
        base = text(n)
        for _ in range(nearcopies.MANY + 30):
            copy = list(base)
            for _ in range(rng.randint(1, 4)):
                copy[rng.randrange(n)] = f"x{rng.randint(0, 99)}"
            rows.append(copy)
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_near_copies(spark):
    rows = [*corpus(), (900, None), (901, ""), (902, " \n"), (903, "A b"), (904, "a  B"), (905, "a c")]
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), "").collect())
    want = groups(rows)
    assert got == sorted(min(i for i, _ in g) for g in want) and len(got) < 0.6 * len(rows)


def test_rows_of_one_id_are_rows_of_their_own(spark):
    base = [" ".join(f"v{k}x{i}" for i in range(60)) for k in range(6)]
    rows = [(None, base[0]), (None, base[1]), (None, base[2] + " tail"), (7, base[2]), (8, base[3]), (8, base[4]), (8, base[4]), (8, base[4] + " end"), (None, base[5]), (None, base[5])]
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), "").collect()]
    assert len(got) == len(set(got)) == 6 and {(None, base[0]), (None, base[1]), (7, base[2]), (8, base[3]), (None, base[5])} < set(got)


@pytest.mark.parametrize("id", [8, None])
def test_a_clean_row_stays_beside_a_contaminated_one(spark, tmp_path, id):
    item = " ".join(f"item{i}" for i in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = frame(spark, [(id, "clean words"), (id, f"some {item} more"), (9, "other")])
    got = {r["text"] for r in corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path)).collect()}
    assert got == {"clean words", "other"}
