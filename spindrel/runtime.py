"""Session-level helpers: sizing, reliable checkpoints, table access."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "spindrel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect (UTC, AQE, Arrow)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def task_count(spark: SparkSession) -> int:
    """Number of shuffle tasks an operator should spread its work over."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables in between, which all executors see.

    It is the cluster's ``spark.checkpoint.dir``. Only in local mode, where driver and executors share the machine, a folder
    is made if that is unset, and removed at the end; on a cluster it is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="spindrel-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def strip(col: Column | str) -> Column:
    """Without surrounding Unicode white space."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def fold(col: Column | str) -> Column:
    """Key of names that are equal but for letter case and surrounding white space."""
    return F.lower(strip(col))


def filled(col: Column | str) -> Column:
    """Neither null nor blank."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (F.length(strip(c)) > 0)
