"""Compile logs: files, errors with context, segments of compilers, outcome. Rows: doc_id, log."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Marks in a log.
PROCESSED = r"\[verbose\]:  ~~~~~~~~~~~ Processing file '(.*?)'"
FAILED = r"<(.*?)> appears to be tex-type, but was neither included nor processable:"
STARTED = r"[~]+ Running (.*?) for the first time [~]+"
OUTPUT = {"pdf": r"Generated PDF: (.*)<end of PDF name>", "ps": r"Generated PostScript: (.*)<end of PostScript name>"}


def compiled_files(logs: DataFrame) -> DataFrame:
    """Processed files that did not fail and aren't .dvi."""
    all_of = lambda p: F.regexp_extract_all("log", F.lit(p), F.lit(1))
    done = logs.select("doc_id", F.posexplode(all_of(PROCESSED)).alias("n", "file"))
    bad = logs.select("doc_id", F.explode(all_of(FAILED)).alias("file"))
    return done.join(bad, ["doc_id", "file"], "left_anti").where(~F.col("file").endswith(".dvi")).select("doc_id", "n", "file")


def errors(lines: DataFrame, context: int = 5, mark: Column | None = None) -> DataFrame:
    """Lines that begin with ! and the context - 1 lines after. lines: doc_id, line_no, line."""
    ahead = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(0, context - 1)
    found = lines.withColumn("error", F.array_join(F.collect_list("line").over(ahead), "\n"))
    return found.where(F.col("line").startswith("!") if mark is None else mark).select("doc_id", "line_no", "error")


def last_compiler(log: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(log, F.lit(STARTED), F.lit(1)), F.lit(-1))


def segments(logs: DataFrame) -> DataFrame:
    """doc_id, n, compiler, body: from the end of a mark to the next mark."""
    names = F.regexp_extract_all("log", F.lit(STARTED), F.lit(1))
    parts = F.split("log", STARTED, -1)
    bodies = F.slice(parts, 2, F.size(parts))
    both = logs.select("doc_id", F.posexplode(F.arrays_zip(names.alias("compiler"), bodies.alias("body"))).alias("n", "s"))
    return both.select("doc_id", "n", "s.compiler", "s.body")


def failed(logs: DataFrame, compiler: str) -> DataFrame:
    stop = F.max(F.when(F.col("compiler") == compiler, F.col("body").rlike(r"(?m)^! Emergency stop\.")).otherwise(False))
    return segments(logs).groupBy("doc_id").agg(stop.alias("failed"))


def outputs(log: Column, kind: str) -> Column:
    """Names between the marks that a compile run prints for its outputs of a kind (pdf or ps)."""
    return F.regexp_extract_all(log, F.lit(OUTPUT[kind]), F.lit(1))


def compiled(logs: DataFrame, outputs: DataFrame) -> DataFrame:
    """doc_id, success, has_output, output: the results of compile runs (doc_id, success) with their outputs (doc_id, type,
    path, contents), by type and path; a run without outputs has an empty list."""
    each = F.array_sort(F.collect_list(F.struct("type", "path", "contents")))
    found = outputs.groupBy("doc_id").agg(each.alias("output"))
    none = F.array().cast("array<struct<type: string, path: string, contents: string>>")
    return logs.join(found, "doc_id", "left").select("doc_id", "success", F.col("output").isNotNull().alias("has_output"), F.coalesce("output", none).alias("output"))
