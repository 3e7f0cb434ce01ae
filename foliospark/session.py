"""Session set-up: a local session for work on one machine, and the package for the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def local_session(cores: str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Let the executors' Python import this package, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = Path(__file__).resolve().parent
        to = Path(tempfile.mkdtemp(prefix="foliospark-")) / "foliospark.zip"
        with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
            for path in root.rglob("*.py"):
                z.write(path, path.relative_to(root.parent))
        context.addPyFile(str(to))
    return spark


def checkpoint(df: DataFrame) -> DataFrame:
    """df, computed and written to the folder in spark.checkpoint.dir; a temporary folder where that is unset, in local mode only."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()
