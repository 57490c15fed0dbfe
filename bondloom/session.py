"""Session factory and table access."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bondloom")
    builder = builder.config("spark.driver.memory", memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once, for the operators that run Python there."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).parent
        folder = tempfile.mkdtemp(prefix="bondloom-")  # the driver serves it while it runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = Path(folder, "bondloom.zip")
        with zipfile.ZipFile(archive, "w") as file:
            for source in sorted(package.rglob("*.py")):
                file.write(source, source.relative_to(package.parent))
        sc.addPyFile(str(archive))
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there.

    The folder is the session's ``spark.checkpoint.dir``. Only where that is unset
    and the master is this one machine does a temporary folder take its place.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = os.path.join(tempfile.gettempdir(), f"bondloom-checkpoint-{sc.applicationId}")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, most_rows: int = 200_000) -> DataFrame:
    """A broadcast side if a checkpointed ``df`` of narrow rows is short, else ``df`` as it is."""
    return F.broadcast(df) if df.count() <= most_rows else df
