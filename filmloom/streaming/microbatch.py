"""Incremental runs: file streams in micro-batches with idempotent sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, folder: str, kind: str, *, fmt: str = "parquet", files: int = 1) -> DataFrame:
    """Files of a folder as a stream, so many per micro-batch. A path may name one file: as a pattern it needs no folder."""
    folder = folder.rstrip("/")
    if not folder.endswith("]") and folder.rpartition("/")[2].count("."):
        folder = f"{folder[:-1]}[{folder[-1]}]"
    return spark.readStream.schema(kind).format(fmt).option("maxFilesPerTrigger", files).load(folder)


def split(df: DataFrame, passes: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that go on to an expensive stage, and the others: a cheap filter runs before the model, not beside it."""
    ok = F.coalesce(passes, F.lit(False))
    return df.where(ok), df.where(~ok)


def run_once(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: list[str]) -> None:
    """Work through all files there are now, batch by batch, and add rows to a parquet table.

    A batch that runs again after a failure overwrites its own folder, so nothing
    is added twice; rows whose key an earlier batch has written are left out.
    """
    spark = stream.sparkSession
    jvm = spark._jvm

    def earlier(batch: int) -> list[str]:
        at = jvm.org.apache.hadoop.fs.Path(out)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return [f"{out}/{n}" for n in names if n.startswith("batch=") and int(n.split("=")[1]) < batch]

    def add(rows: DataFrame, batch: int) -> None:
        done = earlier(batch)
        fresh = rows.dropDuplicates(key)
        if done:
            fresh = fresh.join(spark.read.parquet(*done).select(*key), key, "left_anti")
        work(fresh).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(stream: DataFrame, time: str, label: str, *, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts per label and window of event time; rows later than the watermark no longer count."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), label).agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", label, "n")
