"""Where intermediate tables go, and how tables are found.

Intermediate tables are written below ``spark.checkpoint.dir``, the folder that all executors of a
cluster share, so that a lost executor costs a task and never the data.  Only where the setting is
absent and the master is local (tests, a laptop) a local folder is made for it; a cluster without
the setting is refused, since each worker would write to a disk of its own.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 << 20
HOT_SHARES = 4  # a key with more than 1 / (HOT_SHARES * partitions) of the rows is hot, so there are at most HOT_SHARES * partitions of them

_local: str | None = None
_written: list[str] = []


@atexit.register
def _clear() -> None:
    """Remove this process's intermediate tables where the shared folder is a mounted path."""
    for path in _written:
        if path.startswith(("/", "file:/")):
            shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{checkpoint_dir(spark)}/stridelake-{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a local one only where none is set."""
    global _local
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
    if _local is None:
        _local = tempfile.mkdtemp(prefix="stridelake-")
        atexit.register(shutil.rmtree, _local, ignore_errors=True)
    return "file://" + _local


def ensure_checkpoint(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table of the shared folder and return the table: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables whose readers have all been stored themselves."""
    for t in tables:
        remove(t.sparkSession, t.stored_path)
        if t.stored_path in _written:
            _written.remove(t.stored_path)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a stored table, from the file system that holds it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by the layout ``<dir>/<name>.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def _width(name: Column, kind: T.DataType) -> Column:
    """Bytes of a value in memory, about."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.ArrayType, T.MapType, T.StructType, T.StringType, T.BinaryType)):
        return F.coalesce(F.size(name), F.lit(0)) * 8 + 16
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.length(F.to_json(F.struct(name))), F.lit(0)) * 2 + 16
    return F.lit(8)


def fits(stored_table: DataFrame, limit: int | None = None) -> bool:
    """Whether a stored table of unique keys takes at most ``limit`` bytes in memory: its files are looked at first, then its rows and their width.

    Files below a five-hundredth of the limit need no count: unique keys take about a byte of file at least, so there are too few rows.
    """
    limit = BROADCAST_BYTES if limit is None else limit
    size = size_of(stored_table.sparkSession, stored_table.stored_path) if limit > 0 else limit + 1
    if size > limit or size <= limit // 500:
        return size <= limit
    width = F.lit(16)
    for field in stored_table.schema:
        width = width + _width(F.col(f"`{field.name}`"), field.dataType)
    return (stored_table.agg(F.sum(width.cast("bigint"))).first()[0] or 0) <= limit


def sized(stored_table: DataFrame, limit: int | None = None) -> DataFrame:
    """A stored table marked for broadcast if it ``fits``, else as it is (the join then shuffles)."""
    return F.broadcast(stored_table) if fits(stored_table, limit) else stored_table


def lookup(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined with a stored table whose ``key`` is unique.

    The table is handed out where it fits.  Else keys that hold more than a small share of the rows of ``left``
    (a bounded number of keys) meet their rows of the table by broadcast, and only the others are shuffled.
    ``how`` is inner, left, left_semi or left_anti.
    """
    if fits(right):
        return left.join(F.broadcast(right), key, how)
    spark = left.sparkSession
    counts = stored(left.groupBy(key).agg(F.count(F.lit(1)).alias("its_rows")), "key-counts")
    total = counts.agg(F.sum("its_rows")).first()[0] or 0
    hot = [r[0] for r in counts.where(F.col(key).isNotNull() & (F.col("its_rows") * HOT_SHARES * partitions(spark) > total)).select(key).collect()]
    discard(counts)
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    few = right.where(F.col(key).isin(hot))
    return left.where(is_hot).join(F.broadcast(few), key, how).unionByName(left.where(~is_hot).join(right.where(~F.col(key).isin(hot)), key, how))
