"""Runs of a stream over the files that have arrived, each from where the one before it stopped."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.staging import fresh_path

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_arrivals(spark: SparkSession, folder: str, schema: T.StructType, files_at_once: int | None = None) -> DataFrame:
    """A stream of the Parquet files under ``folder``, oldest first; all new ones are one batch unless limited."""
    reader = spark.readStream.schema(schema)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.parquet(folder)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def advance(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Take in all that has arrived, append what is final to the Parquet table ``output``, and stop.

    State and progress are kept in ``checkpoint``, in a folder that all executors share; the next call goes on
    from there, in this session or another, and a call that was interrupted is repeated without loss or copies. State
    lives in RocksDB, so it may be larger than an executor's memory.
    """
    spark = stream.sparkSession
    with _setting(spark, "spark.sql.streaming.stateStore.providerClass", _ROCKSDB):
        query = (
            stream.writeStream.format("parquet")
            .option("path", output)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def replay(deliveries: DataFrame, batch: str, plan: Callable[[DataFrame], DataFrame], closing: DataFrame | None = None) -> DataFrame:
    """What ``plan`` puts out when the batches of ``deliveries`` arrive one after another.

    Each batch is landed as files in the shared folder, then a run takes it in and stops; the next run starts from
    the checkpoint. ``closing`` is a last delivery whose times let the watermark pass all others.
    """
    spark, rows = deliveries.sparkSession, deliveries.drop(batch)
    inbox, output, checkpoint = (fresh_path(spark) for _ in range(3))
    numbers = [row[0] for row in deliveries.select(batch).distinct().orderBy(batch).collect()]  # one per batch
    landed = [deliveries.where(F.col(batch).eqNullSafe(F.lit(number))).drop(batch) for number in numbers]
    for part in [*landed, *([closing] if closing is not None else [])]:
        part.write.mode("append").parquet(inbox)
        stream = plan(read_arrivals(spark, inbox, rows.schema))
        advance(stream, output, checkpoint)
    if not numbers:
        rows.limit(0).write.mode("append").parquet(inbox)
        stream = plan(read_arrivals(spark, inbox, rows.schema))
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(output)
