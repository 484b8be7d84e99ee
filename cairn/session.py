"""Sessions: the defaults of this library and how its code reaches the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = Path(__file__).resolve().parent


#: Rows of an Arrow batch at most: texts may be long, and a batch is held several times on its way to a worker and back.
BATCH_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, which may not have it on their path, and bounds the session's Arrow batches.

    Repeated calls do nothing more.
    """
    sc = spark.sparkContext
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if getattr(sc, "_cairn_shipped", False):
        return
    to = Path(tempfile.mkdtemp(prefix="cairn-")) / "cairn_package.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(_ROOT.rglob("*.py")):
            z.write(p, os.path.join("cairn", p.relative_to(_ROOT)))
    sc.addPyFile(str(to))
    sc._cairn_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; on a local master it may be unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "/tmp/cairn-shared"
    return folder.rstrip("/")


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage, and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(name: str = "cairn", cores: str = "*", **conf: str) -> SparkSession:
    """A local session with adaptive execution, UTC and as many shuffle partitions as small data need."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(name)
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()
