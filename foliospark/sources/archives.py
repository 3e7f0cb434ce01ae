"""Archives and text files: scan by binaryFile, unpack on the executors, decode, resolve names."""

from __future__ import annotations

import gzip
import io
import posixpath
import tarfile
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBERS = "doc_id string, member string, kind string, content binary, error string"


def scan(spark: SparkSession, folder: str, glob: str = "*.gz") -> DataFrame:
    """doc_id (name without its last suffix), content of every archive of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select(F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1).alias("doc_id"), "content", F.col("modificationTime").alias("modified"))


def safe(name: str) -> bool:
    """Whether a member stays within the folder it is unpacked to."""
    path = posixpath.normpath(name)
    return not (path.startswith(("/", "../")) or path == "..")


def open_archive(blob: bytes):
    """(member, kind, content) of a tar, else of a single gzipped file, else the bytes as a PDF."""
    try:
        with tarfile.open(fileobj=io.BytesIO(blob)) as tar:
            return [(m.name, "tar", tar.extractfile(m).read()) for m in tar if m.isfile() and safe(m.name)]
    except (tarfile.TarError, EOFError, OSError, zlib.error):  # no tar, or one that ends early
        pass
    try:
        return [("main.tex", "gz", gzip.decompress(blob))]
    except (OSError, EOFError, zlib.error):
        return [("file.pdf", "pdf", blob)]


def unpack(archives: DataFrame) -> DataFrame:
    """One row per member; an archive that can't be read gives a row with its error."""

    def rows(batches):
        for batch in batches:
            for doc, blob in zip(batch["doc_id"], batch["content"], strict=True):
                try:
                    out = [(doc, *m, None) for m in open_archive(bytes(blob))]
                except Exception as e:  # noqa: BLE001  a broken archive is a row, not a failed job
                    out = [(doc, None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(out, columns=["doc_id", "member", "kind", "content", "error"])

    return archives.select("doc_id", "content").mapInPandas(rows, MEMBERS)


#: Marks at the beginning of a text in another encoding.
MARKS = (("EFBBBF", "UTF-8"), ("FFFE", "UTF-16LE"), ("FEFF", "UTF-16BE"))


#: What Windows-1252 has in the places of Latin-1's control characters.
WESTERN = {chr(b): bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}


def decode(content: Column) -> Column:
    """By its byte order mark; without one UTF-16 where every other byte of the first ones is 0, UTF-8 where valid, else
    Windows-1252, which has Latin-1 but for its control characters."""
    head = F.hex(F.substring(content, 1, 8))
    out = F.when(content.isNull(), F.lit(None).cast("string"))
    for mark, name in MARKS:
        out = out.when(head.startswith(mark), F.decode(F.substring(content, 1 + len(mark) // 2, 1 << 30), name))
    out = out.when(head.rlike("^(?:[2-7][0-9A-F]00){2,}$"), F.decode(content, "UTF-16LE")).when(head.rlike("^(?:00[2-7][0-9A-F]){2,}$"), F.decode(content, "UTF-16BE"))
    one_byte = F.translate(F.decode(content, "ISO-8859-1"), "".join(WESTERN), "".join(WESTERN.values()))
    return out.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8")).otherwise(one_byte)


def resolve(wanted: DataFrame, members: DataFrame) -> DataFrame:
    """doc_id, name, member: the first of name, name.tex and name.latex that exists; '' if none."""
    tries = wanted.select("doc_id", "name", F.posexplode(F.array(F.col("name"), F.concat("name", F.lit(".tex")), F.concat("name", F.lit(".latex")))).alias("rank", "member"))
    found = tries.join(members.select("doc_id", "member"), ["doc_id", "member"], "left_semi").groupBy("doc_id", "name").agg(F.min_by("member", "rank").alias("found"))
    return wanted.join(found, ["doc_id", "name"], "left").select("doc_id", "name", F.coalesce("found", F.lit("")).alias("member"))


def tex_files(member: Column) -> Column:
    return member.rlike(r"\.(tex|latex|cls|sty)$")


def pending(inputs: DataFrame, done: DataFrame) -> DataFrame:
    """Inputs without an output yet."""
    return inputs.join(done.select("doc_id").distinct(), "doc_id", "left_anti")
