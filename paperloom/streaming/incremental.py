"""Incremental runs: files as a stream, marks of what is done, state by key, documents driven anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.operators.upkeep import upsert


def read_new(spark: SparkSession, folder: str, schema: T.StructType, files: int = 1000) -> DataFrame:
    """A stream of the Parquet files that come to a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def run(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], every: str | None = None):
    """Give each micro-batch to a function: once over all there is, or every so often ('5 minutes')."""
    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


class StateTable:
    """The last row of each key, as versions of a Parquet table beside a mark that names the one in force.

    A batch writes the version of its own number from the one before it, so a batch that runs again does no harm."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: list[str]):
        self.spark, self.path, self.key, self.order = spark, path, key, order

    def _version(self) -> int | None:
        try:
            rows = self.spark.read.parquet(f"{self.path}/mark").agg(F.max("version")).first()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
                raise
            return None
        return rows[0]

    def read(self, before: int | None = None) -> DataFrame | None:
        v = self._version()
        if v is not None and before is not None and v >= before:
            v = self.spark.read.parquet(f"{self.path}/mark").where(F.col("version") < before).agg(F.max("version")).first()[0]
        return None if v is None else self.spark.read.parquet(f"{self.path}/v={v}")

    def __call__(self, batch: DataFrame, number: int) -> None:
        old = self.read(before=number)
        new = upsert(old, batch, self.key, self.order) if old is not None else upsert(batch.limit(0), batch, self.key, self.order)
        new.write.mode("overwrite").parquet(f"{self.path}/v={number}")
        self.spark.createDataFrame([(number,)], "version bigint").coalesce(1).write.mode("append").parquet(f"{self.path}/mark")


def changed_since(blobs: DataFrame, mark: DataFrame) -> DataFrame:
    """Blobs modified after the high-water mark (one row, ``high``); all of them where it is null."""
    return blobs.crossJoin(F.broadcast(mark.select("high").limit(1))).where(F.col("high").isNull() | (F.col("last_modified") > F.col("high"))).drop("high")


def high_water(blobs: DataFrame) -> DataFrame:
    return blobs.agg(F.max("last_modified").alias("high"))


def deleted(before: DataFrame, now: DataFrame) -> DataFrame:
    """Names that a snapshot has lost; a stream of files can't see that."""
    return before.select("name").join(now.select("name"), "name", "left_anti")


def todo(blobs: DataFrame, done: DataFrame, requeued: DataFrame | None = None) -> DataFrame:
    """Blobs that aren't done, and those that are to run again in any case."""
    rest = blobs.join(done.select("name"), "name", "left_anti")
    if requeued is not None:
        rest = rest.unionByName(blobs.join(requeued.select("name"), "name", "left_semi")).dropDuplicates(["name"])
    return rest


def windowed_counts(events: DataFrame, time: str, key: str, width: str, late: str) -> DataFrame:
    """Counts by window of event time, closed once the watermark has passed."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
