"""Session helpers: reliable checkpoints and a default local session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for reliable checkpoints.

    A folder named in ``spark.checkpoint.dir`` or set on the context is used
    as it is.  Only where neither exists, and only on a local master, a
    temporary folder of this machine is made.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="filmloom-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(cpus: int | str | None = None, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("filmloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
