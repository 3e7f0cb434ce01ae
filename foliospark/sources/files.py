"""Token, gold, tree and package files, compile responses, and their sinks."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark import schemas


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold tokens (tab separated, no header) with doc_id and 1-based page from the file name."""
    rows = spark.read.csv(path, sep="\t", schema=schemas.GOLD, quote="").withColumn("file", F.regexp_extract(F.input_file_name(), r"([^/]+)\.[^.]*$", 1))
    return rows.withColumn("doc_id", F.regexp_extract("file", r"^(.*)_\d+$", 1)).withColumn("page_no", F.regexp_extract("file", r"_(\d+)$", 1).cast("int") + 1).drop("file")


def write_rows(rows: DataFrame, path: str, buckets: int = 64) -> None:
    """Canonical rows as Parquet in `buckets` folders by a hash of the document, sorted by document: its row groups can be
    skipped when one is read, and there are no more folders than buckets, however many documents."""
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    placed.repartition("bucket").sortWithinPartitions("bucket", "doc_id").write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def manifest(outputs: DataFrame) -> DataFrame:
    """doc_id, path, type, bytes, sha256 of every compiled output (doc_id, type, path, contents in base64)."""
    data = F.unbase64("contents")
    return outputs.select("doc_id", "path", "type", F.length(data).cast("long").alias("bytes"), F.sha2(data, 256).alias("sha256"))


def write_tsv(rows: DataFrame, path: str) -> None:
    """Tab separated with a header; arrays become JSON."""
    arrays = {f.name for f in rows.schema if f.dataType.typeName() == "array"}
    rows.select(*[F.to_json(c).alias(c) if c in arrays else F.col(c) for c in rows.columns]).write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="\\N")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    flat = spark.read.csv(path, sep="\t", header=True, inferSchema=False, nullValue="\\N")
    types = {f.name: f.dataType for f in T.StructType.fromDDL(schemas.DATA)}
    return flat.select(*[F.from_json(c, types[c].simpleString()).alias(c) if types[c].typeName() == "array" else F.col(c).cast(types[c]) for c in flat.columns if c in types])


def read_packages(spark: SparkSession, folder: str) -> DataFrame:
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    return spark.read.schema(schemas.PACKAGE).option("multiLine", True).json(folder).withColumn("package", name)


def write_packages(packages: DataFrame, folder: str) -> None:
    packages.write.mode("overwrite").json(folder)


def response(body: Column) -> Column:
    return F.from_json(body, schemas.RESPONSE)


def first_output(parsed: Column, kind: str) -> Column:
    """Bytes of the first output of a kind; null where the run neither succeeded nor has outputs."""
    good = parsed["success"] | parsed["has_output"]
    hit = F.try_element_at(F.filter(parsed["output"], lambda o: o["type"] == kind), F.lit(1))
    return F.when(good, F.unbase64(hit["contents"]))


def error_report(rows: DataFrame) -> DataFrame:
    """doc_id, message of every row that failed."""
    return rows.where("error IS NOT NULL").select("doc_id", F.col("error").alias("message"))


def contents_url(url: Column) -> Column:
    """The contents API address of a repository folder's web address."""
    p = r"^https://github\.com/([^/]+)/([^/]+)/(?:tree|blob)/([^/]+)/(.*)$"
    part = lambda i: F.regexp_extract(url, p, i)
    return F.when(url.rlike(p), F.concat(F.lit("https://api.github.com/repos/"), part(1), F.lit("/"), part(2), F.lit("/contents/"), part(4), F.lit("?ref="), part(3)))


#: Completion files that aren't read, those whose keys have blanks to drop, and those named otherwise.
UNREAD = ("diagxy.cwl", "calculator.cwl", "calculus.cwl", "expl3.cwl")
TIGHT = ("chemformula.cwl", "context-document.cwl", "class-beamer.cwl", "csquotes.cwl", "datatool.cwl", "newclude.cwl", "pgfplots.cwl", "tabu.cwl", "tikz.cwl")
RENAMED = {"yathesis": "class-yathesis"}


def read_completions(spark: SparkSession, folder: str) -> DataFrame:
    """file, line of the completion files of a folder."""
    lines = spark.read.text(f"{folder}/*.cwl")
    return lines.select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("file"), F.col("value").alias("line"))


def packages_of(completions: DataFrame) -> DataFrame:
    """package, includes, cmds, envs from lines (file, line): #include lines name packages, \\begin lines environments, other
    lines that begin with a macro its key, without what follows # and without the names in its groups."""
    rows = completions.where(~F.col("file").isin(*UNREAD))
    stem = F.regexp_replace("file", r"\.cwl$", "")
    for old, new in RENAMED.items():
        stem = F.when(stem == old, new).otherwise(stem)
    text = F.rtrim(F.when(F.col("file").isin(*TIGHT), F.replace("line", F.lit(" "), F.lit(""))).otherwise(F.col("line")))
    key = F.regexp_replace(F.regexp_replace(text, r"#.*$", ""), r"(?<=[\[{(<])[^\]})>]*(?=[\]})>])", "")
    rows = rows.select(stem.alias("package"), F.regexp_extract(text, r"^#include:(.*)$", 1).alias("include"), F.regexp_extract(text, r"^\\begin\{([^}]*)\}", 1).alias("env"), F.regexp_extract(key, r"^\\(?!begin\b|end\b)(\S.*)$", 1).alias("cmd"), key.alias("key"))
    env = F.when(F.col("env") != "", F.concat("env", F.regexp_replace("key", r"^\\begin\{[^}]*\}", "")))
    names = lambda c: F.array_sort(F.collect_set(c))
    blank = lambda a: F.map_from_arrays(a, F.transform(a, lambda _: F.lit(None).cast("string")))
    found = rows.groupBy("package").agg(names(F.when(F.col("include") != "", F.col("include"))).alias("includes"), names(F.when(F.col("cmd") != "", F.col("cmd"))).alias("c"), names(env).alias("e"))
    return found.select("package", "includes", blank(F.col("c")).alias("cmds"), blank(F.col("e")).alias("envs"))


def read_tex(spark: SparkSession, folder: str) -> DataFrame:
    """file, text of the .tex and .latex files of a folder (not of those below it)."""
    parts = [spark.read.text(f"{folder}/*{end}", wholetext=True) for end in (".tex", ".latex") if _any_file(spark, f"{folder}/*{end}")]
    if not parts:
        return spark.createDataFrame([], "file string, text string")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("file"), F.col("value").alias("text"))


def _any_file(spark: SparkSession, glob: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    return len(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []) > 0


def catalogue(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(package, kind, name, args) and (package, includes) of a folder of package files, for grammar.context."""
    from foliospark.functions import grammar

    packages = read_packages(spark, folder)
    return grammar.entries(packages), packages.select("package", F.explode("includes").alias("includes"))
