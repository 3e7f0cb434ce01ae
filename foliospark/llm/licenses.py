"""License scans by a trained paragraph classifier, in DataFrame operations only.

A paragraph is a line, or two lines that follow each other and are both short enough (`wrap` characters) to be one
wrapped notice; such a pair counts only where neither of its lines does. A multinomial logistic regression over
sparse word 1- to 3-grams is trained on the templates below (whole, cut and within other words) as the licence
families and on a bounded sample of the corpus's own different lines without licence words as the unknown class. Every
paragraph is scored where it is, without a shuffle. A prediction counts if its probability reaches a cut,
calibrated on other variants and other lines than those the model has learnt from (the cut with the best F1, in the
middle of its gap), and if the paragraph shares half a template's words, or has half its own, four at least, from one.
The second condition is cheaper and so tested first; what can't meet it isn't cut into n-grams (see needed()).

Defined cases: null and empty texts have no paragraphs; repeated paragraphs, rows of one id and rows without an id
are judged each for itself and give a row each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import partitions

#: Short notices of common licence families.
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0.", "you may not use this file except in compliance with the License", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"],
    "mit": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "This software is licensed under the MIT license"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.", "it under the terms of the GNU General Public License as published by the Free Software Foundation", "This program is free software: you can redistribute it and/or modify it"],
    "cc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution license", "Licensed under CC BY-SA 4.0.", "Licensed under CC BY 4.0."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted", "Released under the BSD 3-Clause License."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0"],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. Unauthorized copying is prohibited."],
}
FAMILIES = sorted(TEMPLATES)
#: Words of which a line of the unknown class may have none.
NOTICE = r"licen[cs]e|copyright|permission|redistribut|rights reserved|warrant"

#: Shuffle partitions that go into one of the result.
PER_FILE = 8


def words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), "")


def grams(w: Column) -> Column:
    """Word 1-, 2- and 3-grams."""
    pair = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    triple = F.zip_with(pair, F.slice(w, 3, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(F.concat(w, pair, triple), lambda g: g.isNotNull())


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph (0-based line), line: lines with a letter."""
    return docs.select(F.col("doc_id").cast("long"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("paragraph", "line")).where(F.col("line").rlike(r"\p{L}"))


def paragraphs(docs: DataFrame, wrap: int = 160) -> DataFrame:
    """row (of docs), doc_id, paragraph (its first line, from 0), n_lines (1 or 2), words: all paragraphs with a word."""
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.split(F.coalesce("text", F.lit("")), "\n").alias("line"))
    following = F.slice("line", 2, F.size("line")).alias("next")
    at = own.select("row", "doc_id", F.posexplode(F.arrays_zip("line", following)).alias("paragraph", "z")).select("row", "doc_id", "paragraph", "z.line", "z.next")
    wrapped = (F.length("line") <= wrap) & (F.length("next") <= wrap) & F.col("line").rlike(r"\p{L}") & F.col("next").rlike(r"\p{L}")
    unit = lambda n, text: F.struct(F.lit(n).alias("n_lines"), words(text).alias("words"))
    units = F.array_compact(F.array(unit(1, F.col("line")), F.when(wrapped, unit(2, F.concat("line", F.lit(" "), "next")))))
    return at.select("row", "doc_id", "paragraph", F.explode(units).alias("u")).select("row", "doc_id", "paragraph", "u.*").where(F.size("words") > 0)


#: Words in the order in which text has them most often.
COMMON = "the of and to in a is for it on with as be by this are or an not from you all any may can use under".split()


def marks(templates: list[set[str]]) -> set[str]:
    """Words of which a text that has half the words of a template has at least one: the template's others are fewer than half.

    Common words are marks only where a template needs them for that, the rarer ones first."""
    out = set().union(*templates) - set(COMMON)
    for t in templates:
        for word in reversed([w for w in COMMON if w in t]):
            if 2 * len(t - out) < len(t):
                break
            out.add(word)
    return out


def needed(overlap: float) -> Column:
    """What every paragraph meets that shares enough words with a template (see scan_licenses), whatever the overlap from a half on:
    it has a mark and as many words of templates as half the shortest has, or four of them and so few words that this may be half."""
    templates = [set(_plain_words(t)) for f in FAMILIES for t in TEMPLATES[f]]
    if overlap < 0.5:
        return F.lit(True)
    literal = lambda ws: F.array(*[F.lit(w) for w in sorted(ws)])
    known = F.size(F.array_intersect("words", literal(set().union(*templates))))
    few = F.size(F.array_distinct("words")) < max(map(len, templates))
    return (F.arrays_overlap("words", literal(marks(templates))) & (known >= min((len(t) + 1) // 2 for t in templates))) | (few & (known >= 4))


def let(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shares(word_set: Column) -> Column:
    """An array with, for each family, the greatest part of a template's words, or of the own words (four at least), that both have."""
    templates = [(f, sorted(set(_plain_words(t)))) for f in FAMILIES for t in TEMPLATES[f]]
    literal = lambda ws: F.array(*[F.lit(w) for w in ws])
    every = literal(sorted({w for _, ws in templates for w in ws}))

    def families(n, own):
        part = lambda i, ws: F.greatest(n[i] / len(ws), F.when(n[i] >= 4, n[i] / own).otherwise(0.0))
        of = lambda f: [part(i, ws) for i, (g, ws) in enumerate(templates) if g == f]
        return F.array(*[F.greatest(*of(f)) if len(of(f)) > 1 else of(f)[0] for f in FAMILIES])

    shared = lambda ws: F.transform(F.array(*[literal(t) for _, t in templates]), lambda t: F.size(F.array_intersect(ws, t)))
    return let(word_set, lambda ws: let(F.array_intersect(ws, every), lambda known: let(shared(known), lambda n: families(n, F.size(ws)))))


def variants(text: str) -> tuple[list[str], list[str]]:
    """Forms of a template to learn from, and others to calibrate on."""
    part = text.split()
    most, half = max(4, len(part) * 2 // 3), max(4, len(part) * 3 // 4)
    return [text] * 4 + [f"{text} and the of in", f"here and there {text}", " ".join(part[:most])], [f"note {text}", f"{text} please see the file", " ".join(part[-half:]), " ".join(part[:half])]


def training(docs: DataFrame, sample: int) -> DataFrame:
    """line, label (0: unknown), held (to calibrate on)."""
    rows = []
    for i, family in enumerate(FAMILIES):
        for text in TEMPLATES[family]:
            learn, held = variants(text)
            rows += [(x, float(i + 1), False) for x in learn] + [(x, float(i + 1), True) for x in held]
    known = docs.sparkSession.createDataFrame(rows, "line string, label double, held boolean")
    other = lines(docs).where(~F.lower("line").rlike(NOTICE)).select(F.xxhash64("line").alias("h"), "line")
    least = other.select("h").distinct().orderBy("h").limit(sample).withColumnRenamed("h", "lh")  # at most `sample` numbers, so they may be broadcast
    other = other.join(F.broadcast(least), F.expr("h = lh")).groupBy("h").agg(F.min("line").alias("line"))
    return known.unionByName(other.select("line", F.lit(0.0).alias("label"), (F.pmod(F.xxhash64("line", F.lit(1)), F.lit(3)) == 0).alias("held")))


def best_cut(scored: list[tuple[float, bool]]) -> float:
    """The cut with the best F1 for (probability, is a licence), in the middle of its gap."""
    scored = sorted(scored, reverse=True)
    good = sum(k for _, k in scored)
    best, cut, hits = -1.0, 0.5, 0
    for n, (p, known) in enumerate(scored, 1):
        hits += known
        below = scored[n][0] if n < len(scored) else 0.0
        if below < p and 2 * hits / (n + good) > best:
            best, cut = 2 * hits / (n + good), (p + below) / 2
    return cut


def fit(docs: DataFrame, sample: int = 2000):
    """(counts of grams, classifier, cut): two models of Spark ML and a probability."""
    spark = docs.sparkSession
    rows = training(docs, sample).select("label", "held", grams(words(F.col("line"))).alias("grams"))
    templates = spark.createDataFrame([(t,) for f in FAMILIES for t in TEMPLATES[f]], "line string").select(grams(words(F.col("line"))).alias("grams"))
    counts = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=4096).fit(templates)
    data = counts.transform(rows).select("label", "held", "features").coalesce(1).cache()
    model = LogisticRegression(maxIter=60, regParam=0.002, family="multinomial").fit(data.where("NOT held"))
    p = F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES)))
    held = model.transform(data.where("held")).select(p, F.col("label") > 0).collect()  # bounded by the sample
    data.unpersist()
    return counts, model, best_cut([(r[0], r[1]) for r in held])


def scan_licenses(docs: DataFrame, sample: int = 2000, overlap: float = 0.5, wrap: int = 160) -> DataFrame:
    """doc_id, paragraph, n_lines, family, probability, overlap: one row for each licence paragraph."""
    counts, model, cut = fit(docs, sample)
    like = paragraphs(docs, wrap).where(needed(overlap)).withColumn("shares", shares(F.array_distinct("words"))).where(F.array_max("shares") >= overlap)
    scored = model.transform(counts.transform(like.withColumn("grams", grams(F.col("words")))))
    p = F.slice(vector_to_array("probability"), 2, len(FAMILIES))
    best = F.array_position(p, F.array_max(p)).cast("int")
    scored = scored.select("row", "doc_id", "paragraph", "n_lines", F.array_max(p).alias("probability"), F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), best).alias("family"), F.round(F.element_at("shares", best), 4).alias("overlap"))
    hits = scored.where((F.col("probability") >= cut) & (F.col("overlap") >= overlap))
    # a pair of lines counts where neither line does by itself, and no pair before it has its first line
    at = Window.partitionBy("row").orderBy("paragraph")
    near = F.max(F.when(F.col("n_lines") == 1, 1)).over(at.rangeBetween(0, 1)).isNotNull()
    earlier = F.max(F.when(F.col("n_lines") == 2, 1)).over(at.rangeBetween(-1, -1)).isNotNull()
    kept = hits.withColumn("hidden", (F.col("n_lines") == 2) & (near | earlier)).where("NOT hidden")
    found = kept.select("doc_id", "paragraph", "n_lines", "family", F.round("probability", 4).alias("probability"), "overlap")
    # far smaller than docs, so in fewer files: for each an executor's JVM starts processes that share its memory while they start
    return found.coalesce(-(-partitions(docs.sparkSession) // PER_FILE))


def _plain_words(text: str) -> list[str]:
    return [w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split() if w]


__all__ = ["FAMILIES", "TEMPLATES", "fit", "grams", "lines", "marks", "paragraphs", "scan_licenses", "words"]
