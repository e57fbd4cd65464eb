"""Run a stream over the data available now and read its sink back."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkpack.operators.stage import new_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the state store stateful Python operators need."""
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    s.conf.set("spark.sql.session.timeZone", "UTC")
    s.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return s


def table_stream(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A parquet table as a stream. The path is given as a pattern because a plain stream path must be a folder,
    while a table may also be a single file."""
    schema = schema or spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def run_to_table(df: DataFrame, idle: bool = True) -> DataFrame:
    """idle: run micro-batches without data, which only timers need. Operators that live by the wall clock would run them
    for ever, so a run to the end of the input goes without."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle).lower())
    path, state = new_path(spark, "sink"), new_path(spark, "state")
    q = (df.writeStream.format("parquet").outputMode("append").option("path", path)
         .option("checkpointLocation", state).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


TICKS = "ts timestamp"


def run_and_close(spark: SparkSession, build: Callable[[DataFrame], DataFrame], close_ts: str) -> DataFrame:
    """Run a stream to the end of its input, then move its event clock to close_ts, so that every timer fires.

    build: from a stream of ticks (ts), rows that only move the clock, to the result. The second run continues the first
    one's checkpoint and reads a single tick; which keys still wait is known to the state alone.
    """
    control, path, state = (new_path(spark, kind) for kind in ("control", "sink", "state"))
    spark.createDataFrame([], TICKS).write.parquet(control)
    df = build(spark.readStream.schema(TICKS).parquet(control))
    for closing in (False, True):
        if closing:
            spark.range(1).select(F.lit(close_ts).cast("timestamp").alias("ts")).write.mode("append").parquet(control)
        q = (df.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", state).trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def run_each_batch(df: DataFrame, step: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    """Apply a batch function to every micro-batch and append its result; a repeated batch overwrites its own folder."""
    spark = df.sparkSession
    path, state = new_path(spark, "sink"), new_path(spark, "state")

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    q = df.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(f"{schema}, batch long").option("basePath", path).parquet(path).drop("batch")
