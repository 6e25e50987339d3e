"""How query modules register a query with its SQL, and the views that several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.scratch import lookup, table


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracle: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable:
        def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
            self.queries[f.__name__] = f
            if sql is not None:
                self.oracle[f.__name__] = sql
            return f

        return register


def finite_motion(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Distinct motion rows whose keys are known and whose 13 readings are all finite; of the clips in the stored table ``of`` (motion_id) alone, if there is one."""
    m = table(spark, sf_dir, "motion").select("object_type", "motion_id", "frame", "joint", "f").where("object_type is not null and f is not null and size(f) = 13")
    if of is not None:
        m = lookup(m, of, "motion_id", "left_semi").select(m.columns)
    # one exchange by clip serves the removal of repeated rows and all that follows by clip
    return m.where(F.forall("f", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).repartition("object_type", "motion_id").distinct()


FINITE = "m AS (SELECT DISTINCT object_type, motion_id, frame, joint, CAST(f AS DOUBLE[]) AS f FROM motion WHERE object_type IS NOT NULL AND len(f) = 13 AND len(list_filter(f, lambda x: isfinite(x))) = 13)"


def first_topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One skeleton per object_type: its first version."""
    t = table(spark, sf_dir, "topology").where("object_type is not null")
    keep = [c for c in t.columns if c != "object_type"]
    first = t.groupBy("object_type").agg(F.min_by(F.struct(*keep), F.struct("version", "added_at", "topology_id")).alias("r"))
    return first.select("object_type", "r.*")


TOPOLOGY = "topo AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY object_type ORDER BY version, added_at, topology_id) AS rn FROM topology WHERE object_type IS NOT NULL) WHERE rn = 1)"


def first_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each clip by its first delivery."""
    c = table(spark, sf_dir, "clip").where("motion_id is not null")
    keep = [x for x in c.columns if x != "motion_id"]
    return c.groupBy("motion_id").agg(F.min_by(F.struct(*keep), F.struct("ingested_at", "object_type", "split")).alias("r")).select("motion_id", "r.*")


CLIP = "c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY motion_id ORDER BY ingested_at, object_type NULLS FIRST, split NULLS FIRST) AS rn FROM clip WHERE motion_id IS NOT NULL) WHERE rn = 1)"
