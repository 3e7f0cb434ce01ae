"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents are summed into cells (source, language, topic). Token weights of the cells are raked to the
target share of each source, language and topic in turn; after the last round documents are sampled
by a probability proportional to their cell's raked weight, scaled so that the expected tokens are
`fraction` of all (cells whose probability reaches 1 are kept whole and the rest is scaled up).

Targets are a power of what is there: share ~ tokens ** power for each of the three marginals, so they
are consistent with every table; given shares replace them. The topic is a column of the caller's or, by default, what
marks in the text say (the table of documents has none).

Defined cases: a null or empty text has no tokens and the least topic; nulls in source, language or
topic are a value of their own; rows with equal ids are sampled alike; extra columns are kept by
sample(), but for those with the names that it adds; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import durable, free

MARGINS = ("source", "lang", "topic")
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
ROUNDS, FRACTION = 12, 0.5
#: The part of all tokens by which a margin may be off.
TOLERANCE = 1e-4
#: Cells up to which one task fits them all and they are broadcast; beyond, margins are summed by value and joined.
FEW_CELLS = 50_000
CELL = ("m_source", "m_lang", "m_topic", "tokens")


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """What a document is made of, by its marks."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(F.instr(t, " | ") > 0, "table")
        .when((F.instr(t, "***") > 0) | (F.instr(t, "&&&") > 0) | (F.instr(t, "###") > 0), "symbols")
        .when(F.instr(t, "!!") > 0, "shouting")
        .otherwise("prose")
    )


def chance(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def keyed(docs: DataFrame, by: Column | None = None) -> tuple[DataFrame, dict[str, str]]:
    """docs with the values of the margins and the tokens, and the names of these columns. by: the topic, if not topic()."""
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    found = F.coalesce(by.cast("string"), F.lit("")) if by is not None else topic(F.col("text"))
    names = {m: free(docs, f"m_{m}") for m in (*MARGINS, "tokens")}
    columns = {"source": key("source"), "lang": key("lang"), "topic": found, "tokens": tokens(F.col("text"))}
    return docs.withColumns({names[m]: c for m, c in columns.items()}), names


def cells_of(docs: DataFrame, by: Column | None = None) -> DataFrame:
    """Tokens of each cell: m_source, m_lang, m_topic, tokens."""
    rows, names = keyed(docs, by)
    return rows.groupBy(*[F.col(names[m]).alias(f"m_{m}") for m in MARGINS]).agg(F.sum(names["tokens"]).alias("tokens"))


class Sums:
    """Sums over the cells of a margin: windows in one task while the cells are few, else an aggregation and a join by the
    margin's value, each round written, so that no task has all cells."""

    def __init__(self, few: bool):
        self.few = few

    def over(self, cells: DataFrame, margin: str, column: str, name: str) -> DataFrame:
        if self.few:
            return cells.withColumn(name, F.sum(column).over(Window.partitionBy(margin)))
        sums = cells.groupBy(F.col(margin).alias("s_key")).agg(F.sum(column).alias(name))
        return cells.join(sums, F.col(margin) == F.col("s_key")).drop("s_key")

    def done(self, cells: DataFrame) -> DataFrame:
        return cells if self.few else durable(cells)


def targets(cells: DataFrame, sums: Sums, total: float, powers: dict[str, float], shares: dict[str, DataFrame] | None) -> DataFrame:
    """cells (with w) with the target tokens of their value in each margin: t_source, t_lang, t_topic."""
    out = cells
    for m in MARGINS:
        out = sums.over(out, f"m_{m}", "w", "s")
        if shares and m in shares:
            given = shares[m].groupBy(F.col("value").alias("g_key")).agg(F.sum("share").alias("g_share"))
            there = sums.done(out.join(given, F.col(f"m_{m}") == F.col("g_key"), "left").drop("g_key"))
            once = there.select(f"m_{m}", "s", "g_share").distinct()
            have = once.agg(F.sum("g_share"), F.sum(F.when(F.col("g_share").isNull(), F.col("s")))).first()
            named, rest = float(have[0] or 0.0), float(have[1] or 0.0)
            left = max(0.0, 1.0 - named) if rest else 0.0
            scale = (1.0 - left) / named if named else 0.0
            share = F.coalesce(F.col("g_share") * scale, F.lit(left) * F.col("s") / F.lit(rest or 1.0))
            out = there.withColumn(f"t_{m}", F.when(F.col("s") > 0, share * total).otherwise(0.0)).drop("s", "g_share")
            continue
        # each value's power, summed once a value: its cells share it in proportion to their tokens
        out = out.withColumn("part", F.when(F.col("s") > 0, F.pow("s", F.lit(powers[m])) * F.col("w") / F.col("s")).otherwise(0.0))
        everything = out.agg(F.sum("part")).first()[0] or 1.0
        out = sums.done(out.withColumn(f"t_{m}", F.when(F.col("s") > 0, F.pow("s", F.lit(powers[m])) / everything * total).otherwise(0.0)).drop("s", "part"))
    return out


def rake(cells: DataFrame, powers: dict[str, float] = POWERS, rounds: int = ROUNDS, shares: dict[str, DataFrame] | None = None, few: bool = True, tolerance: float = TOLERANCE, most: int = 20) -> DataFrame:
    """cells (m_source, m_lang, m_topic, tokens) with raked token weights w, which sum to the tokens of all.

    Rounds go on, `rounds` at a time, until every margin is met within `tolerance` of all tokens, `most` times at
    most; targets that contradict each other or the cells there are (none has a value's tokens) raise an error then.
    shares: for a margin, a table (value, share) instead of the power of its tokens; values that it doesn't name share what
    is left of 1 in proportion to their tokens, and shares of more or, if all values are named, less than 1 are scaled to 1.
    """
    sums = Sums(few)
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    out = targets(cells.withColumn("w", F.col("tokens").cast("double")), sums, total, powers, shares)
    if not total:
        return out.select(*CELL, "w")
    for _ in range(most):
        for _ in range(rounds):
            for m in MARGINS:
                out = sums.over(out, f"m_{m}", "w", "s")
                out = out.withColumn("w", F.when(F.col("s") > 0, F.col("w") * F.col(f"t_{m}") / F.col("s")).otherwise(0.0)).drop("s")
            out = sums.done(out)
        out = durable(out.coalesce(1) if few else out)
        worst = 0.0
        for m in MARGINS:
            gap = out.groupBy(f"m_{m}").agg(F.abs(F.sum("w") - F.max(f"t_{m}")).alias("gap")).agg(F.max("gap")).first()[0]
            worst = max(worst, float(gap or 0.0))
        if worst <= tolerance * total:
            return out.select(*CELL, "w")
    raise ValueError(f"the targets can't be met: a margin is off by {worst / total:.3g} of all tokens after {most * rounds} rounds")


def calibrate(raked: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Cells with rate (raked weight a token) and probability min(1, scale * rate), such that tokens * probability sum to fraction * total.

    The scale is raised until the cells that it keeps whole stay the same; each step is one aggregation."""
    rated = raked.withColumn("rate", F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0))
    total = float(rated.agg(F.sum("tokens")).first()[0] or 0)
    scale, whole = 0.0, -1
    while True:
        full = F.col("rate") * scale >= 1
        row = rated.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(~full, F.col("tokens") * F.col("rate")).otherwise(0.0)), F.count(F.when(full, 1))).first()
        if row[2] == whole or not row[1] or not total:
            break
        whole, scale = row[2], max(scale, (total * fraction - float(row[0])) / float(row[1]))
    return rated.withColumn("p", F.least(F.lit(1.0), F.lit(scale) * F.col("rate"))).select(*CELL, "w", "rate", "p")


def plan(docs: DataFrame, powers: dict[str, float] = POWERS, rounds: int = ROUNDS, fraction: float = FRACTION, shares: dict[str, DataFrame] | None = None, by: Column | None = None, few_cells: int = FEW_CELLS) -> tuple[DataFrame, bool]:
    """Calibrated cells, and whether they are few."""
    cells = durable(cells_of(docs, by))
    few = cells.count() <= few_cells
    if few:
        cells = cells.coalesce(1)
    return durable(calibrate(rake(cells, powers, rounds, shares, few), fraction)), few


def sample(docs: DataFrame, powers: dict[str, float] = POWERS, rounds: int = ROUNDS, fraction: float = FRACTION, shares: dict[str, DataFrame] | None = None, by: Column | None = None, few_cells: int = FEW_CELLS) -> DataFrame:
    """The sampled rows of docs, with topic, tokens, weight (1 / p) and probability. by: the topic, if not topic()."""
    cells, few = plan(docs, powers, rounds, fraction, shares, by, few_cells)
    rows, names = keyed(docs, by)
    own = {m: free(rows, f"c_{m}") for m in (*MARGINS, "p")}
    cells = cells.select(*[F.col(f"m_{m}").alias(own[m]) for m in MARGINS], F.col("p").alias(own["p"]))
    on = [F.col(names[m]) == F.col(own[m]) for m in MARGINS]
    picked = rows.join(F.broadcast(cells) if few else cells, on).where(chance(F.col("doc_id")) < F.col(own["p"]))
    added = {"topic", "tokens", "probability", "weight"}
    p = F.col(own["p"])
    return picked.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added], F.col(names["topic"]).alias("topic"), F.col(names["tokens"]).alias("tokens"), F.round(p, 6).alias("probability"), F.round(1 / p, 6).alias("weight"))


def table(docs: DataFrame) -> DataFrame:
    return sample(docs.select("doc_id", "source", "lang", "text")).drop("text")


def oracle(documents: str = "documents", columns: str = "doc_id, source, lang") -> str:
    """DuckDB SQL for table()."""
    steps = [
        f"""WITH keyed AS (SELECT *, coalesce(source::VARCHAR, '') m_source, coalesce(lang::VARCHAR, '') m_lang,
 CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN contains(coalesce(text, ''), '***') OR contains(coalesce(text, ''), '&&&') OR contains(coalesce(text, ''), '###') THEN 'symbols'
 WHEN contains(coalesce(text, ''), '!!') THEN 'shouting' ELSE 'prose' END m_topic,
 len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT m_tokens FROM {documents}),
 cells AS (SELECT m_source, m_lang, m_topic, sum(m_tokens)::BIGINT tokens FROM keyed GROUP BY ALL),
 c0 AS (SELECT *, tokens::DOUBLE w, sum(tokens::DOUBLE) OVER () total FROM cells)"""
    ]
    last = "c0"
    for m in MARGINS:
        p = POWERS[m]
        steps.append(f"s_{m} AS (SELECT *, sum(w) OVER (PARTITION BY m_{m}) s FROM {last})")
        steps.append(f"a_{m} AS (SELECT *, sum(CASE WHEN s > 0 THEN pow(s, {p}) * w / s ELSE 0 END) OVER () AS alls FROM s_{m})")
        steps.append(f"t_{m} AS (SELECT * EXCLUDE (s, alls), CASE WHEN s > 0 THEN pow(s, {p}) / alls * total ELSE 0 END t_{m} FROM a_{m})")
        last = f"t_{m}"
    for r in range(ROUNDS):
        for m in MARGINS:
            steps.append(f"r{r}_{m} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(w) OVER (PARTITION BY m_{m}) > 0 THEN w * t_{m} / sum(w) OVER (PARTITION BY m_{m}) ELSE 0 END AS w) FROM {last})")
            last = f"r{r}_{m}"
    order = "ORDER BY rate DESC, m_source, m_lang, m_topic ROWS BETWEEN"
    steps.append(f"rated AS (SELECT *, CASE WHEN tokens > 0 THEN w / tokens ELSE 0 END rate FROM {last})")
    steps.append(f"cum AS (SELECT *, coalesce(sum(tokens) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0) kept, sum(tokens * rate) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING) tail FROM rated)")
    steps.append(f"scaled AS (SELECT *, CASE WHEN tail > 0 THEN (total * {FRACTION} - kept) / tail ELSE 0 END scale FROM cum)")
    steps.append("best AS (SELECT coalesce(arg_max(scale, rate), 1.0) scale FROM scaled WHERE scale * rate <= 1 AND scale >= 0)")
    steps.append("probs AS (SELECT m_source, m_lang, m_topic, least(1.0, best.scale * rate) p FROM scaled, best)")
    return ",\n ".join(steps) + f"""
 SELECT {columns}, m_topic topic, m_tokens tokens, round(p, 6) probability, round(1 / p, 6) weight FROM keyed JOIN probs USING (m_source, m_lang, m_topic)
 WHERE ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 < p"""
