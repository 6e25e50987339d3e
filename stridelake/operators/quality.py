"""Data-quality gates, value scans, repair and dataset summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.functions import rotations as R
from stridelake.operators import features as X
from stridelake.operators import skeleton as S
from stridelake.scratch import partitions, sized, stored

CEILING = 25.0
EPS = 1e-6
SPREAD = 1e-4
MEAN_BONE = 0.2092142857142857


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def value_scan(motion: DataFrame, threshold: float) -> DataFrame:
    """Per clip: rows, non-finite readings, largest finite size, and the reasons that make it bad (an empty list: good)."""
    rows = motion.where("f is not null").select("object_type", "motion_id", "frame", F.size(F.filter("f", lambda x: ~_finite(x))).alias("odd"), F.array_max(F.transform(F.filter("f", _finite), lambda x: F.abs(x.cast("double")))).alias("top"))
    per = rows.groupBy("object_type", "motion_id").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("frame").alias("n_frames"), F.sum("odd").alias("nonfinite"), F.max("top").alias("max_abs"))
    why = F.array_compact(F.array(F.when(F.col("nonfinite") > 0, F.lit("nonfinite")), F.when(F.col("max_abs").isNull() | (F.col("max_abs") > threshold), F.lit(f"abs_gt_{threshold:g}"))))
    return per.withColumn("reasons", why)


def quarantine(table: DataFrame, bad: DataFrame, key: str = "motion_id") -> DataFrame:
    """A table without the rows of bad clips: every manifest is brought into step by the same anti join."""
    return table.join(bad.select(F.col("motion_id").alias(key)).distinct(), key, "left_anti")


def gate_a(motion: DataFrame, clips: DataFrame, topology: DataFrame) -> DataFrame:
    """Integrity of each clip: the list of broken rules, empty where it passes.

    Rules: finite, size at most CEILING, as many frames as the source has less one, contacts 0 or 1 and none off the declared feet
    (no declaration: not judged; an empty one: no feet), rotation vectors neither short nor parallel, and children of one joint agree.
    """
    feet = topology.select("object_type", F.col("foot_joint_idx").alias("feet"), F.lit(True).alias("known"))
    rows = motion.where("f is not null").join(feet, "object_type", "left")
    d = R.parts("f", 3, 6)
    contact = F.get("f", F.lit(12)).cast("double")
    a, b, c = R.norm(d[:3]), R.norm(d[3:]), R.norm(R.cross(d[:3], d[3:]))
    rows = rows.select(
        "object_type", "motion_id", "frame", F.size(F.filter("f", lambda x: ~_finite(x))).alias("odd"), F.array_max(F.transform(F.filter("f", _finite), lambda x: F.abs(x.cast("double")))).alias("top"),
        (~F.round(contact, 6).isin(0.0, 1.0)).alias("fuzzy"), (F.col("known") & F.col("feet").isNotNull() & ~F.array_contains("feet", F.col("joint")) & (F.abs(contact) > EPS)).alias("afloat"),
        (F.least(a, b) < EPS).alias("short"), (c < EPS).alias("parallel"),
    )
    yes = lambda k: F.max(F.coalesce(F.col(k), F.lit(False)))
    per = rows.groupBy("object_type", "motion_id").agg(F.countDistinct("frame").alias("n_frames"), F.sum("odd").alias("odd"), F.max("top").alias("top"), *(yes(k).alias(k) for k in ("fuzzy", "afloat", "short", "parallel")))
    spread = X.child_spread(motion.where("f is not null and size(f) = 13"), S.joints(topology)).select("motion_id", F.col("object_type").alias("o"), "spread")
    per = per.join(clips.select("motion_id", "source_frames"), "motion_id", "left").join(spread, (F.col("o") == F.col("object_type")) & (spread["motion_id"] == per["motion_id"]), "left").select(per["object_type"], per["motion_id"], "n_frames", "odd", "top", "fuzzy", "afloat", "short", "parallel", "source_frames", "spread")
    issues = [
        F.when(F.col("odd") > 0, "nonfinite"), F.when(F.col("top") > CEILING, "size"), F.when(F.col("source_frames").isNotNull() & (F.col("n_frames") != F.col("source_frames") - 1), "frames"),
        F.when(F.col("fuzzy"), "contact"), F.when(F.col("afloat"), "contact off feet"), F.when(F.col("short"), "rotation length").when(F.col("parallel"), "rotation parallel"), F.when(F.col("spread") > SPREAD, "children differ"),
    ]
    return per.select("object_type", "motion_id", F.array_compact(F.array(*issues)).alias("issues"))


def gate_b(world: DataFrame, source_world: DataFrame | None, tolerance: float = 1e-4) -> DataFrame:
    """Mean distance of recovered positions from the source's own (s0..s2); without a source the gate is waived."""
    if source_world is None:
        return world.select("motion_id").distinct().select("motion_id", F.lit(True).alias("passed"), F.lit(True).alias("waived"), F.lit(None).cast("double").alias("mean_l2"))
    both = world.join(source_world, ["motion_id", "frame", "joint"])
    gap = R.minus(R.names("w", 3), R.names("s", 3))
    return both.groupBy("motion_id").agg(F.avg(R.norm(gap)).alias("mean_l2")).select("motion_id", (F.col("mean_l2") <= tolerance).alias("passed"), F.lit(False).alias("waived"), "mean_l2")


def gate_c(motion: DataFrame, topology: DataFrame, clean: float = 1e-4, of_box: float = 0.005) -> DataFrame:
    """Per clip the mean distance of positions by rotation and by position, against a fixed bound, or a share of the body's box where twists are inferred."""
    mode = topology.select("object_type", (F.col("gate_c_mode") == "inferred_twist").alias("inferred"))
    out = X.kinematic_errors(motion, topology).where("mean_l2 is not null").join(mode, "object_type", "left")
    fk = F.when(F.col("inferred"), F.col("mean_l2") / F.col("diagonal") <= of_box).otherwise(F.col("mean_l2") <= clean)
    return out.select(*X.CLIP, "mean_l2", "diagonal", (F.coalesce(fk, F.lit(False)) & (F.coalesce("spread", F.lit(0.0)) <= SPREAD)).alias("passed"))


def error_report(motion: DataFrame, topology: DataFrame) -> DataFrame:
    """Per source: mean, 95th percentile (linear) and largest distance of positions by rotation and by position."""
    by_rotation = X.forward_kinematics(motion, topology).join(X.world_positions(motion).select(*X.KEYS, "w0", "w1", "w2"), X.KEYS)
    gap = stored(by_rotation.select("object_type", R.norm(R.minus((F.col("x"), F.col("y"), F.col("z")), R.names("w", 3))).alias("e")), "gaps")
    p95 = exact_percentile(gap, "object_type", "e", 0.95).withColumnRenamed("value", "p95")
    return gap.groupBy("object_type").agg(F.avg("e").alias("mean"), F.max("e").alias("largest")).join(p95, "object_type").select("object_type", "mean", "p95", "largest")


def exact_percentile(values: DataFrame, group: str, value: str, share: float, accuracy: int = 10_000) -> DataFrame:
    """(group, value): the exact percentile with linear interpolation; ``values`` is a stored table and is read twice.

    A bounded summary brackets it first; then only the values inside the bracket (some ten-thousandths of a group, distinct ones with
    their number) are gathered, and those below are counted.
    """
    room = 4.0 / accuracy
    ends = values.groupBy(group).agg(F.count(value).alias("n"), *(F.percentile_approx(value, min(max(s, 0.0), 1.0), accuracy).alias(k) for k, s in (("low", share - room), ("high", share + room))))
    # in a small group, of no more values than the summary has points, ranks are too coarse for a bracket, and all values are inside
    small = F.col("n") <= accuracy
    ends = ends.where("n > 0").withColumns({"low": F.when(small, float("-inf")).otherwise(F.col("low")), "high": F.when(small, float("inf")).otherwise(F.col("high"))})
    ends = stored(ends, "percentile-ends")
    met = values.where(F.col(value).isNotNull()).join(sized(ends), group)
    first, last = F.floor((F.col("n") - 1) * share), F.ceil((F.col("n") - 1) * share)
    below = met.groupBy(group).agg(F.count_if(F.col(value) < F.col("low")).alias("below"))
    inside = met.where((F.col(value) >= F.col("low")) & (F.col(value) <= F.col("high"))).groupBy(group, value).agg(F.count(F.lit(1)).alias("k"))
    up_to = F.sum("k").over(W.partitionBy(group).orderBy(value))
    ranked = inside.withColumn("upto", up_to).join(below, group).join(ends, group).withColumn("upto", F.col("upto") + F.col("below"))
    pick = lambda rank: F.min(F.when(F.col("upto") > rank, F.col(value)))
    part = F.first((F.col("n") - 1) * share - first)
    return ranked.groupBy(group).agg((pick(first) * (1 - part) + pick(last) * part).alias("value"))


def gate_e(clips: DataFrame, topology: DataFrame, listed: DataFrame) -> DataFrame:
    """Layout contract as one row per broken rule and subject: rule, subject."""
    split = F.lower(F.trim("split"))
    known = topology.select("object_type").distinct()
    factor = S.scale_factors(topology, MEAN_BONE)
    ratio = factor.select("object_type", (1 / F.col("factor")).alias("ratio")).join(topology.select("object_type", (F.col("scale_ref_joint_idx").isNotNull() & (F.size("scale_ref_joint_idx") > 0)).alias("declared")), "object_type")
    off_scale = ratio.where(F.when(F.col("declared"), ~F.col("ratio").between(0.98, 1.02)).otherwise(~F.col("ratio").between(0.3, 3.0)))
    rules = [
        S.validate(topology).where(F.size("issues") > 0).select(F.lit("skeleton").alias("rule"), F.col("object_type").alias("subject")),
        off_scale.select(F.lit("scale").alias("rule"), F.col("object_type").alias("subject")),
        clips.join(known, "object_type", "left_anti").select(F.lit("no skeleton").alias("rule"), F.col("motion_id").alias("subject")),
        clips.where(F.coalesce(~split.isin("train", "val", "test"), F.lit(True))).select(F.lit("no split").alias("rule"), F.col("motion_id").alias("subject")),
        topology.join(listed.select(F.col("object_name").alias("object_type")).distinct(), "object_type", "left_anti").select(F.lit("not listed").alias("rule"), F.col("object_type").alias("subject")),
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out.distinct()


def split_coverage(clips: DataFrame, motion: DataFrame) -> DataFrame:
    """Clips per state: how many splits a clip is in (0, 1, more), and whether it has motion rows."""
    have = motion.select("motion_id").distinct().withColumn("has_motion", F.lit(True))
    inn = clips.where("split is not null and trim(split) <> ''").select("motion_id", F.lower(F.trim("split")).alias("s")).groupBy("motion_id").agg(F.countDistinct("s").alias("n_splits"))
    all_ids = clips.select("motion_id").union(have.select("motion_id")).distinct()
    out = all_ids.join(inn, "motion_id", "left").join(have, "motion_id", "left")
    return out.groupBy(F.coalesce("n_splits", F.lit(0)).alias("n_splits"), F.coalesce("has_motion", F.lit(False)).alias("has_motion")).agg(F.count(F.lit(1)).alias("n_clips"))


def clip_issues(clips: DataFrame) -> DataFrame:
    """Clips that break header rules: unsafe name, no frames, no joints, unknown split, captions missing or empty, source frames not frames + 1."""
    split = F.lower(F.trim("split"))
    issues = [
        F.when(~F.col("motion_id").rlike(r"^[A-Za-z0-9._-]+$"), "name"), F.when(F.coalesce(F.col("n_frames") < 1, F.lit(True)), "frames"), F.when(F.coalesce(F.col("n_joints") < 1, F.lit(True)), "joints"),
        F.when(F.coalesce(~split.isin("train", "val", "test"), F.lit(True)), "split"), F.when(F.col("captions").isNull(), "captions missing").when(F.size("captions") == 0, "captions empty"),
        F.when(F.coalesce(F.col("source_frames") != F.col("n_frames") + 1, F.lit(False)), "source frames"),
    ]
    return clips.select("motion_id", F.array_compact(F.array(*issues)).alias("issues"))


def length_label(length: Column, width: int) -> Column:
    low = F.floor(length / width) * width
    return F.concat(low.cast("string"), F.lit("-"), (low + width - 1).cast("string"))


def length_histogram(clips: DataFrame, width: int = 20) -> DataFrame:
    return clips.where("n_frames is not null").groupBy(length_label(F.col("n_frames"), width).alias("bin")).agg(F.count(F.lit(1)).alias("n_clips"), F.sum("n_frames").alias("n_frames"))


def source_summary(clips: DataFrame) -> DataFrame:
    """Per source: clips, shortest and longest, frames, joints, minutes at 12.5 frames a second as reported and at 20 as recorded."""
    return clips.groupBy("object_type").agg(
        F.count(F.lit(1)).alias("n_clips"), F.min("n_frames").alias("shortest"), F.max("n_frames").alias("longest"), F.sum("n_frames").alias("n_frames"), F.max("n_joints").alias("n_joints"),
        F.round(F.sum("n_frames") / 12.5 / 60, 6).alias("minutes_reported"), F.round(F.sum("n_frames") / 20.0 / 60, 6).alias("minutes"),
    )


def index_claims(listed: DataFrame, clips: DataFrame) -> DataFrame:
    """Listed objects against what is there: claimed and counted clips and frames, on either side alone too."""
    claim = listed.where("object_name is not null").groupBy("object_name").agg(F.max("motions").alias("claimed_clips"), F.max("frames").alias("claimed_frames"))
    there = clips.where("object_type is not null").groupBy("object_type").agg(F.count(F.lit(1)).alias("n_clips"), F.sum("n_frames").alias("n_frames"))
    return claim.join(there, F.col("object_name") == F.col("object_type"), "full_outer").select(F.coalesce("object_name", "object_type").alias("object_name"), "claimed_clips", "claimed_frames", "n_clips", "n_frames")


def means_of_means(values: DataFrame, character: str, metric: str, value: str) -> DataFrame:
    """Mean and population deviation per character and metric, and the row FINAL with mean and deviation of the characters' means."""
    per = values.groupBy(F.col(character).alias("character"), F.col(metric).alias("metric")).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    final = per.groupBy("metric").agg(F.avg("mean").alias("m"), F.stddev_pop("mean").alias("std")).select(F.lit("FINAL").alias("character"), "metric", F.col("m").alias("mean"), "std")
    return per.unionByName(final)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Rows with ``place`` (from 0 in ``order``) and ``places`` of their group.

    Rows are range-partitioned by group and order, so a large group spreads over many tasks; each numbers its own part, and what comes before a
    part is summed up from one row per group and partition.
    """
    parts = rows.repartitionByRange(partitions(rows.sparkSession), group, *order).withColumn("its_part", F.spark_partition_id())
    parts = stored(parts, "parts")
    own = F.row_number().over(W.partitionBy(group, "its_part").orderBy(*order)) - 1
    of_group = W.partitionBy(group)
    sizes = parts.groupBy(group, "its_part").agg(F.count(F.lit(1)).alias("k"))
    sizes = sizes.select(F.col(group).alias("of"), F.col("its_part").alias("of_part"), F.coalesce(F.sum("k").over(of_group.orderBy("its_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("k").over(of_group).alias("places"))
    met = parts.withColumn("place", own).join(sized(stored(sizes, "part-sizes")), F.col(group).eqNullSafe(F.col("of")) & (F.col("its_part") == F.col("of_part")))
    return met.withColumn("place", F.col("place") + F.col("before")).drop("of", "of_part", "its_part", "before")


def segment_numbers(rows: DataFrame, source: str, order: str) -> DataFrame:
    """Place of each segment within its source from 0, and how many there are."""
    out = numbered(rows, source, [order])
    return out.withColumns({"segment_index": F.col("place").cast("int"), "segment_count": F.col("places")}).drop("place", "places")


def pages(rows: DataFrame, group: str, order: list[str], size: int = 90) -> DataFrame:
    """Page of each row within its group, and the pages there are."""
    out = numbered(rows, group, order)
    return out.withColumns({"page": F.floor(F.col("place") / size).cast("int"), "n_pages": F.ceil(F.col("places") / size).cast("int")}).drop("place", "places")


def acceptance(motion: DataFrame, clips: DataFrame, topology: DataFrame, listed: DataFrame, source_world: DataFrame | None = None) -> DataFrame:
    """gate, n_failed: failures of gates A (clips with issues), B (clips off their source; none where it is waived), C (clips off by rotation, or not judged for want of a usable skeleton or whole frame), E (broken layout rules)."""
    good = motion.where(F.forall("f", _finite) & (F.size("f") == 13))
    judged = gate_c(good, topology)
    c = motion.select(*X.CLIP).distinct().join(judged.where("passed").select(*X.CLIP), X.CLIP, "left_anti")
    b = gate_b(X.world_positions(good), source_world).where("not passed")
    gates = {"A": gate_a(motion, clips, topology).where(F.size("issues") > 0), "B": b, "C": c, "E": gate_e(clips, topology, listed)}
    out = None
    for name, failed in gates.items():
        row = failed.agg(F.count(F.lit(1)).alias("n_failed")).select(F.lit(name).alias("gate"), "n_failed")
        out = row if out is None else out.unionByName(row)
    return out
