"""Structured Streaming over files that keep arriving: counts per time window, running status, and late rows.

Streams are drained with ``availableNow``: each call takes what has arrived since the last, and the query's
checkpoint in the shared folder lets it go on after any failure.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.scratch import scratch_path


def arriving(spark: SparkSession, where: str, schema, kind: str = "parquet") -> DataFrame:
    """A stream of the files of a folder; a single file is watched for in its folder by name."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    stream = spark.readStream.schema(schema).format(kind)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isFile():
        return stream.option("pathGlobFilter", path.getName()).load(path.getParent().toString())
    return stream.load(where)


def drained(stream: DataFrame, mode: str = "append", where: str | None = None) -> DataFrame:
    """Run a stream over all that is there and return its result as a stored table."""
    spark = stream.sparkSession
    base = where or scratch_path(spark, "stream")

    def replace(batch: DataFrame, number: int) -> None:
        # a batch that is tried again writes over itself
        batch.write.mode("overwrite").parquet(f"{base}/out/b{0 if mode == 'complete' else number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(replace).start().awaitTermination()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/out")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{base}/out/*")


def window_counts(events: DataFrame, time: str, key: str, value: str, width: str, late: str = "1 day") -> DataFrame:
    """Rows and sums per tumbling window and key; rows later than ``late`` behind the newest are left out."""
    t = events.withColumn("at", F.col(time).cast("timestamp")).withWatermark("at", late)
    return t.groupBy(F.window("at", width).alias("w"), F.col(key)).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("since"), key, "n", "total")


def status_counts(rows: DataFrame, status: str) -> DataFrame:
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def first_deliveries(rows: DataFrame, key: str) -> DataFrame:
    """Each key once, as it first arrives (state grows with the keys)."""
    return rows.dropDuplicates([key])


def pipeline(read: Callable[[], DataFrame], *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    out = read()
    for step in steps:
        out = step(out)
    return out
