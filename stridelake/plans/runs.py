"""Whole runs: a dataset build that only ends in an acceptance marker if its gates hold, and an evaluation table."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.operators import features, metrics, quality
from stridelake.scratch import remove


class SourceAdapter(Protocol):
    """Where a source's tables come from: whoever brings a new source implements these four."""

    def topology(self, spark: SparkSession) -> DataFrame: ...

    def clips(self, spark: SparkSession) -> DataFrame: ...

    def motion(self, spark: SparkSession) -> DataFrame: ...

    def listed(self, spark: SparkSession) -> DataFrame: ...


class ParquetAdapter:
    """Tables laid out as ``<folder>/<name>.parquet``."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/{name}.parquet")

    def topology(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "topology").where("object_type is not null").dropDuplicates(["object_type"])

    def clips(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "clip").dropDuplicates(["motion_id"])

    def motion(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "motion").where("object_type is not null and f is not null").distinct()

    def listed(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "object_index")


def build(spark: SparkSession, adapter: SourceAdapter, out: str, threshold: float = 22.53, sampled: bool = False, source_world: DataFrame | None = None) -> DataFrame:
    """Quarantine bad clips, write features partitioned by source, statistics of train clips, splits and the gate report.

    ``_ACCEPTED`` of an earlier run is removed first, and written last, only where something is left and gates A, B, C and E all hold for
    what is left; a sampled run never passes.  Gate B is waived without ``source_world``.  The report (gate, n_failed) is returned.
    """
    remove(spark, f"{out}/_ACCEPTED")
    motion, clips, topology = adapter.motion(spark), adapter.clips(spark), adapter.topology(spark)
    scan = quality.value_scan(motion, threshold)
    scan.write.mode("overwrite").parquet(f"{out}/value_scan")
    scan = spark.read.parquet(f"{out}/value_scan")
    bad = scan.where(F.size("reasons") > 0)
    kept, headers = quality.quarantine(motion, bad), quality.quarantine(clips, bad)
    # rows of a source spread over its partitions' files by clip, so that a heavy source is not one task
    kept.repartition("object_type", F.pmod(F.xxhash64("motion_id"), F.lit(16))).write.mode("overwrite").partitionBy("object_type").parquet(f"{out}/motion")
    headers.write.mode("overwrite").parquet(f"{out}/clip")
    train = headers.where("lower(trim(split)) = 'train'").select("motion_id")
    features.group_statistics(kept.join(train, "motion_id", "left_semi")).write.mode("overwrite").parquet(f"{out}/statistics")
    written = spark.read.schema(kept.schema).parquet(f"{out}/motion") if kept.limit(1).count() else kept
    left = topology.join(written.select("object_type").distinct(), "object_type", "left_semi")
    quality.acceptance(written, headers.join(written.select("motion_id").distinct(), "motion_id", "left_semi"), left, adapter.listed(spark), source_world).coalesce(1).write.mode("overwrite").json(f"{out}/report")
    report = spark.read.schema("gate string, n_failed bigint").json(f"{out}/report")
    if not sampled and written.limit(1).count() and not report.where("n_failed > 0").count():
        spark.range(1).coalesce(1).write.mode("overwrite").json(f"{out}/_ACCEPTED")
    return report


def evaluate(generated: DataFrame, truth: DataFrame, window: int = 15, threshold: float = 0.35, by: Iterable[str] = ("loc",)) -> DataFrame:
    """character, metric, mean, std of coverage, local and global diversity, and of the distances between and within clips, with the FINAL rows."""
    rows = None

    def named(metric: str, values: DataFrame, value) -> DataFrame:
        return values.select(F.col("object_type").alias("character"), F.lit(metric).alias("metric"), value.alias("value"))

    for kind in by:
        parts = [
            named(f"local_diversity_{kind}", metrics.local_diversity(generated, truth, window, kind), F.col("cost")),
            named(f"global_diversity_{kind}", metrics.global_diversity(generated, truth, 2 * window, kind), F.col("cost")),
            named(f"coverage_{kind}", metrics.coverage(generated, truth, window, threshold, kind), 100 * F.col("coverage")),
        ]
        for p in parts:
            rows = p if rows is None else rows.unionByName(p)
    rows = rows.unionByName(spread_metrics(generated, truth, window))
    return quality.means_of_means(rows, "character", "metric", "value")


def spread_metrics(generated: DataFrame, truth: DataFrame, window: int = 15, draws: int = 10) -> DataFrame:
    """character, metric, value: distances between neighbouring generated clips (inter), between two windows of one (intra), the same within the
    truth, and how far the intra distances are from the truth's mean."""
    inter, intra, held = metrics.inter_diversity(generated), metrics.intra_diversity(generated, window, 1), metrics.intra_diversity(truth, window, draws)
    gap = intra.join(held.groupBy("object_type").agg(F.avg("cost").alias("usual")), "object_type").withColumn("cost", F.abs(F.col("cost") - F.col("usual"))).drop("usual")
    out = None
    for name, values in (("inter_diversity", inter), ("intra_diversity", intra), ("truth_intra_diversity", held), ("intra_difference", gap)):
        part = values.select(F.col("object_type").alias("character"), F.lit(name).alias("metric"), F.col("cost").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out
