"""Package catalogues: closure over includes, longest argument strings, merging of contexts, macro filters."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliospark.session import checkpoint

def closure(edges: DataFrame, limit: int = 1000) -> DataFrame:
    """root, package: everything a package includes, itself too. edges: package, includes.

    Each round follows what the last one found first and what wasn't there yet, until nothing is new; a chain of more than `limit`
    includes is an error, not a shorter result. Rounds are written to the checkpoint folder, so plans stay short."""
    step = edges.select(F.col("package").alias("p"), F.col("includes").alias("next")).distinct()
    seen = fresh = edges.select(F.col("package").alias("root"), "package").distinct()
    for _ in range(limit):
        found = fresh.join(step, F.col("package") == F.col("p")).select("root", F.col("next").alias("package")).distinct()
        fresh = checkpoint(found.join(seen, ["root", "package"], "left_anti"))
        if fresh.isEmpty():
            return seen
        seen = checkpoint(seen.unionByName(fresh))
    raise ValueError(f"a chain of more than {limit} includes")


def longest_arguments(keys: DataFrame, signs: str = "[{*", known: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """name, args: of keys `name[opt]{arg}` (key, ord) the longest argument signs of every name, the first at a tie.

    Names whose signs aren't all among `signs`, that end in _ or that `known` (name) has already are left out. by: parts of
    the struct ord within which names are apart."""
    parts = keys.select("ord", *[F.col(f"ord.{c}").alias(c) for c in by], F.regexp_extract("key", r"^([\w\\_:]+)", 1).alias("name"), F.col("key"))
    parts = parts.withColumn("args", F.regexp_replace(F.expr("substring(key, length(name) + 1)"), r"[}\]>]", ""))
    longest = parts.where("name <> ''").withColumn("size", F.length("args")).groupBy(*by, "name").agg(F.max("size").alias("most"), F.min_by("args", F.struct(-F.col("size"), "ord")).alias("args")).drop("most")
    allowed = F.array(*[F.lit(c) for c in signs])
    longest = longest.where((F.size(F.array_except(F.filter(F.split("args", ""), lambda c: c != ""), allowed)) == 0) & ~F.col("name").endswith("_"))
    return longest.join(known.select("name"), "name", "left_anti") if known is not None else longest


def merge(contexts: DataFrame) -> DataFrame:
    """Of definitions (name, priority, ord, body) the first by priority and order wins."""
    return contexts.withColumn("rn", F.row_number().over(Window.partitionBy("name").orderBy("priority", "ord"))).where("rn = 1").drop("rn")


#: A control word or symbol.
CONTROL = r"\\(?:[A-Za-z@]+|[^A-Za-z@])"


def private(defined: DataFrame, base: DataFrame) -> DataFrame:
    """Macros (name with its backslash, body) that no catalogue has, that are no internals and don't call themselves."""
    calls = F.array_contains(F.regexp_extract_all("body", F.lit(CONTROL), F.lit(0)), F.col("name"))
    return defined.join(base, "name", "left_anti").where(~F.col("name").contains("@") & ~calls)


def colorable(uses: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Macro uses (name) whose catalogue entry (name, discard, replacement) is kept and renders as more than blanks."""
    return uses.join(catalogue.where(~F.col("discard") & F.col("replacement").rlike(r"\S")).select("name"), "name", "left_semi")
