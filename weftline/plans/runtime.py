"""Session, table access, scratch space and code shipping shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Default session settings. Sizes of shuffles are left to adaptive execution.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.io.compression.codec": "zstd",
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.speculation": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings that the operators are written for."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("weftline")
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, a file or a folder of files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utc(df: DataFrame, *names: str) -> DataFrame:
    """Timestamp columns without a zone, so that results don't depend on the session's zone."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names if isinstance(df.schema[n].dataType, T.TimestampType)})


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir).

    Only a local session may go without that setting; it then gets a temporary folder. On a cluster a folder of one
    machine would lose data with an executor, so the missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if not is_local(spark):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="weftline-")


def settle(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared folder, with their lineage cut."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark))
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package's code to the Python workers, once for each application.

    Local ones need it too: they know the folder that the session was started from, which may be another.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="weftline-code-"), "weftline.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    atexit.register(shutil.rmtree, os.path.dirname(path), ignore_errors=True)
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
