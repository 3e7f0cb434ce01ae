"""Every stage, and the whole run, against brute force; and on tables of odd rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foliospark.llm import decontam, mixing, secrets, toxicity
from foliospark.session import local_session  # noqa: F401

DATA = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def groups(rows):
    """Components of 5-word Jaccard similarity of 0.8 or more, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - both
            if 10 * both >= 8 * union:
                parent[find(a)] = find(b)
    out = {}
    for k in range(len(rows)):
        out.setdefault(find(k), []).append(k)
    return list(out.values())


def contaminated(text, items):
    """Whether an item is in the text within its budget: edit distance of every item to the best substring."""
    t = decontam.normal(text)
    for item in items:
        k = decontam.budget(len(item), 0.08, 11) if len(item) >= 24 else 0
        row = [0] * (len(t) + 1)
        if len(item) < 24:
            if decontam.Matcher([(0, item)], 0.08, 11, 24).find(t) and any(True for _ in decontam.Matcher([(0, item)], 0.08, 11, 24).find(t)):
                return True
            continue
        if not any(part in t for _, part in decontam.cut(item, k)):
            continue  # no piece of it is there, so more than k edits are needed
        for i, p in enumerate(item):
            last, row[0] = row[0], i + 1
            for j, c in enumerate(t):
                last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (p != c))
        if min(row) <= k:
            return True
    return False


def test_run(spark):
    """All rows of run(), from the stages' rules applied one by one in Python."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    items = [decontam.normal(r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    model, cuts = toxicity.train(docs, labels)
    flagged = {r["doc_id"]: r["f"] for r in toxicity.score(docs, model, cuts, "s", "f").select("doc_id", "f").collect()}
    rows = [r.asDict() for r in docs.collect() if not flagged[r["doc_id"]]]
    texts = [(r["doc_id"], r["text"]) for r in rows]
    first = {min(texts[k][0] for k in g) for g in groups(texts)}
    rows = [r for r in rows if r["doc_id"] in first and not contaminated(r["text"], items)]
    novelty = secrets.Novelty()
    for r in rows:
        out, at, found = [], 0, sorted(s[1:3] for s in secrets.spans(r["text"] or "", novelty))
        for a, b in found:
            if a >= at:
                out += [r["text"][at:a], "[secret]"]
            at = max(at, b)
        if found:
            r["text"] = "".join(out) + r["text"][at:]
            r["n_chars"] = len(r["text"])
    last = mixing.sample(spark.createDataFrame([tuple(r.values()) for r in rows], docs.schema))
    key = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert key(corpus_pipeline.run(spark, DATA)) == key(last) and last.count() > 20


ODD = [(None, "no id"), (None, "another text without an id"), (None, None), (1, "one id " * 9), (1, "and a text that is all of its own, of some words more"), (2, ""), (3, " \n"), (4, "é" * 60000), (5, "copy of some words in a row here"), (5, "copy of some words in a row here"), (6, "Copy of  some words in a row here")]
EXTRA = ("row_key", "kept_id", "kept_key", "toxicity", "toxic", "spans", "secrets", "m_source", "c_source", "m_p", "score", "key", "node", "__key")


def odd(spark, rows=ODD):
    names = ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(i, t, "en" if i else None, "s", 1, *("z" * len(EXTRA))) for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {names}")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, odd(spark), DATA)
    rows = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    assert {c for c in got.columns} >= set(odd(spark).columns) - {"topic"} and all(r["c_source"] == "z" and r["m_source"] == "z" for r in got.collect())
    if name in ("toxicity", "decontamination", "secrets"):
        assert rows == sorted(ODD, key=str)
    if name == "near_duplicates":
        # empties are one group (2 is least), copies another (5); all others stay, those of one id or of none too
        assert rows == sorted([(None, "no id"), (None, "another text without an id"), ODD[3], ODD[4], ODD[5], ODD[7], ODD[8]], key=str)
    assert stage(spark, odd(spark, []), DATA).count() == 0


def test_contaminated_rows_go_by_row(spark):
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first()["text"]
    rows = [(None, item), (None, "clean"), (7, f"x {item} y"), (7, "clean too")]
    got = dict(corpus_pipeline.STAGES)["decontamination"](spark, odd(spark, rows), DATA)
    assert sorted(r["text"] for r in got.collect()) == ["clean", "clean too"]


def test_order_of_rows_means_nothing(spark):
    rows = list(ODD)
    random.Random(1).shuffle(rows)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    key = lambda df: sorted(map(str, df.select("doc_id", "text").collect()))
    assert key(stage(spark, odd(spark), DATA)) == key(stage(spark, odd(spark, rows).where(F.lit(True)), DATA))
