"""The unknown class of the licence scan learns from whole lines."""

from foliospark.llm import licenses


def test_unknown_lines_are_whole(spark):
    line = "plain words of prose " * 60 + "this work is free software"
    rows = licenses.training(spark.createDataFrame([(1, line), (2, "short line")], "doc_id long, text string"), 10).where("label = 0").collect()
    assert {r["line"] for r in rows} == {line, "short line"}


def test_marks_lose_nothing():
    """Every set of words that shares half a template, or has half its own words from one, passes what is tested first."""
    import random

    rng = random.Random(2)
    templates = [set(licenses._plain_words(t)) for f in licenses.FAMILIES for t in licenses.TEMPLATES[f]]
    marks, longest = licenses.marks(templates), max(map(len, templates))
    assert all(2 * len(t - marks) < len(t) for t in templates)
    every = sorted(set().union(*templates))
    for _ in range(4000):
        t = rng.choice(templates)
        words = set(rng.sample(sorted(t), rng.randint(0, len(t)))) | {f"x{i}" for i in range(rng.randint(0, 30))} | set(rng.sample(every, rng.randint(0, 3)))
        like = any(2 * len(words & u) >= len(u) or (len(words & u) >= 4 and 2 * len(words & u) >= len(words)) for u in templates)
        assert not like or words & marks or len(words) < longest
