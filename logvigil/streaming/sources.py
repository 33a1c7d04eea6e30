"""File streams over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def table_stream(spark: SparkSession, folder: str, name: str, max_files: int = 1) -> DataFrame:
    """A stored table as a stream: new files of the folder that match ``<name>*.parquet``."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*.parquet").option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def drain(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is available into a table, and read the table. ``complete`` results replace the table
    with each batch."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if mode == "complete":
        w = df.writeStream.outputMode(mode).option("checkpointLocation", path + "-checkpoint")
        w.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(df.schema).parquet(path)
    q = df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", path + "-checkpoint")
    # state that times out by the clock would ask for empty batches without end
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        q.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)
