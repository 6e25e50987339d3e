"""Sampling, augmentation, batching, skinning weights and projection.

Draws are decided by hashes of row keys and a seed, so they are the same on any cluster and after any failure.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.functions import rotations as R


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from a key: 32 bits of its MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 8), 16, 10).cast("double")
    return (bits + 0.5) / 4294967296.0


def balanced_weights(clips: DataFrame, group: str, key: str) -> DataFrame:
    """Weight of each clip when every group weighs the same: 1 / groups / clips of the group."""
    n = clips.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    groups = n.count()
    return clips.join(n, group).select(group, key, (1.0 / F.lit(float(max(groups, 1))) / F.col("n")).alias("weight"))


def weighted_order(weighted: DataFrame, key: str, weight: str, seed: int) -> DataFrame:
    """Sampling without replacement: rows in the order in which a weighted draw takes them (``place`` rises)."""
    return weighted.withColumn("draw", -F.log(uniform(F.col(key), seed)) / F.col(weight))


def weighted_sample(weighted: DataFrame, key: str, weight: str, n: int, seed: int) -> DataFrame:
    return weighted_order(weighted, key, weight, seed).orderBy("draw", key).limit(n)


def stratified_pilot(rows: DataFrame, group: list[str], key: str, n: int, seed: int) -> DataFrame:
    """n rows, one of each group in turn until they are used up; within a group in hashed order."""
    w = W.partitionBy(*group).orderBy(uniform(F.col(key), seed), key)
    # no row beyond the n-th of its group can be among the first n, so each task hands on at most n of a group
    return rows.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= n).orderBy("turn", *group, key).limit(n)


def step_weights(losses: DataFrame, step: str, loss: str, order: str, history: int = 10, uniform_share: float = 0.001) -> DataFrame:
    """Importance of each step: root mean square of its last losses, blended with equal weights; 1 for all while some step has too few."""
    w = W.partitionBy(step)
    kept = losses.withColumn("k", F.row_number().over(w.orderBy(F.desc(order)))).where(F.col("k") <= history)
    per = kept.groupBy(step).agg(F.sqrt(F.avg(F.col(loss) ** 2)).alias("w"), F.count(F.lit(1)).alias("n"))
    whole = W.partitionBy()  # one row per step of a schedule: a bounded table
    ready = F.min("n").over(whole) >= history
    n = F.count(F.lit(1)).over(whole)
    p = F.when(ready, F.col("w") / F.sum("w").over(whole) * (1 - uniform_share) + uniform_share / n).otherwise(1.0 / n)
    return per.select(step, p.alias("p"), (1 / (n * p)).alias("weight"))


def long_enough(clips: DataFrame, length: int) -> DataFrame:
    """Clips of at least ``length`` frames with their place by length."""
    return clips.where(F.col("n_frames") >= length)


def quartile_means(losses: DataFrame, step: str, loss: str, steps: int) -> DataFrame:
    return losses.groupBy(F.floor(F.col(step) * 4 / steps).cast("int").alias("quartile")).agg(F.avg(loss).alias("mean"), F.count(F.lit(1)).alias("n"))


def weighted_mean(parts: DataFrame, key: str, value: str, count: str) -> DataFrame:
    return parts.groupBy(key).agg((F.sum(F.col(value) * F.col(count)) / F.sum(count)).alias("mean"), F.sum(count).alias("n"))


def interval_means(rows: DataFrame, group: list[str], order: str, value: str, size: int) -> DataFrame:
    """Means of runs of ``size`` values in order; the last run may be shorter."""
    w = W.partitionBy(*group).orderBy(order)
    return rows.withColumn("run", F.floor((F.row_number().over(w) - 1) / size).cast("int")).groupBy(*group, "run").agg(F.avg(value).alias("mean"))


def average_quaternions(rows: DataFrame, group: list[str], q: list[str]) -> DataFrame:
    """Mean rotation of each group: the main direction of the summed outer products, its largest component positive.  Only ten sums per group are gathered."""
    sums = rows.groupBy(*group).agg(*(F.sum(F.col(q[i]) * F.col(q[j])).alias(f"s{i}{j}") for i in range(4) for j in range(i, 4)))
    schema = sums.select(*group).schema.add("w", "double").add("x", "double").add("y", "double").add("z", "double")

    def solve(batches):
        for p in batches:
            m = np.zeros((len(p), 4, 4))
            for i in range(4):
                for j in range(i, 4):
                    m[:, i, j] = m[:, j, i] = p[f"s{i}{j}"]
            v = np.linalg.eigh(m)[1][:, :, -1] if len(p) else np.zeros((0, 4))
            lead = np.abs(v).argmax(axis=1)
            v = v * np.sign(v[np.arange(len(v)), lead])[:, None]
            yield pd.concat([p[group].reset_index(drop=True), pd.DataFrame(v, columns=list("wxyz"))], axis=1)

    return sums.mapInPandas(solve, schema)


def without_joints(motion: DataFrame, joints: DataFrame, feet: DataFrame, rate: float, seed: int) -> DataFrame:
    """Motion without some end joints that are no feet, a share ``rate`` of them by hash per clip; the joints left are numbered anew."""
    inner = joints.select("object_type", F.col("parent").alias("joint")).where("joint >= 0").distinct()
    free = joints.where("parent >= 0").select("object_type", "joint").join(inner, ["object_type", "joint"], "left_anti").join(feet.select("object_type", F.explode("foot_joint_idx").alias("joint")), ["object_type", "joint"], "left_anti")
    clips = motion.select("object_type", "motion_id", "joint").distinct()
    gone = clips.join(free, ["object_type", "joint"]).where(uniform(F.concat_ws("|", "motion_id", F.col("joint").cast("string")), seed) < rate)
    left = clips.join(gone, ["object_type", "motion_id", "joint"], "left_anti").withColumn("new_joint", F.row_number().over(W.partitionBy("object_type", "motion_id").orderBy("joint")) - 1)
    return motion.join(left, ["object_type", "motion_id", "joint"])


def with_midpoint(motion: DataFrame, joints: DataFrame, child: int) -> DataFrame:
    """Motion with a joint put in the middle of the bone above ``child``: it takes the child's number and old parent, the child and all after it move up by one and the child hangs on it.

    Positions and displacements are means of both ends, rotation and contact are the child's.
    """
    parent = joints.where(F.col("joint") == child).select("object_type", F.col("parent").alias("p"))
    rows = motion.join(parent, "object_type", "left")
    moved = rows.select("object_type", "motion_id", "frame", (F.col("joint") + F.when(F.col("p").isNotNull() & (F.col("joint") >= child), 1).otherwise(0)).alias("joint"), "f")
    low = rows.where((F.col("joint") == child) & (F.col("p") >= 0)).select("object_type", "motion_id", "frame", "p", F.col("f").alias("g"))
    high = motion.select("object_type", "motion_id", "frame", F.col("joint").alias("p"), "f")
    middle = F.transform(F.arrays_zip("f", "g"), lambda x, i: F.when((i < 3) | ((i >= 9) & (i < 12)), ((x["f"] + x["g"]) / 2).cast("float")).otherwise(x["g"]))
    new = low.join(high, ["object_type", "motion_id", "frame", "p"]).select("object_type", "motion_id", "frame", F.lit(child).alias("joint"), middle.alias("f"))
    return moved.unionByName(new)


def batches(clips: DataFrame, size: int, seed: int) -> DataFrame:
    """Shuffled clips in full batches; an incomplete last one is left out.  Places are counted per hash range, so no task sorts all clips."""
    ranges = 64
    u = uniform(F.col("motion_id"), seed)
    rows = clips.withColumn("range", F.floor(u * ranges).cast("int")).withColumn("u", u)
    sizes = rows.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # 64 rows
    total = F.sum("n").over(W.partitionBy())
    before = before.withColumn("full", F.floor(total / size) * size)
    placed = rows.join(F.broadcast(before.select("range", "before", "full")), "range").withColumn("place", F.row_number().over(W.partitionBy("range").orderBy("u", "motion_id")) - 1 + F.col("before"))
    return placed.where(F.col("place") < F.col("full")).select("motion_id", F.floor(F.col("place") / size).alias("batch"), (F.col("place") % size).alias("slot"))


def padded_grid(values: DataFrame, group: list[str], place: str, value: str, longest: int, fill: float) -> DataFrame:
    """Every group's values at places 0 to ``longest`` - 1, ``fill`` where it has none, with a flag for real ones."""
    grid = values.select(*group).distinct().withColumn(place, F.explode(F.sequence(F.lit(0), F.lit(longest - 1))))
    return grid.join(values.select(*group, place, value), [*group, place], "left").select(*group, place, F.coalesce(value, F.lit(fill)).alias(value), F.col(value).isNotNull().alias("real"))


def inpaint_mask(length: Column, frame: Column, joint: Column, since: float, until: float, free_joints: list[int]) -> Column:
    """True where the given motion is kept: outside the open span of frames, and joints that are not free."""
    inside = (frame >= F.floor(length * since)) & (frame < F.floor(length * until))
    return ~inside & ~joint.isin(free_joints) if free_joints else ~inside


def top_weights(weights: DataFrame, group: list[str], joint: str, weight: str, n: int = 4) -> DataFrame:
    """The n largest weights of each vertex, scaled to add up to 1."""
    w = W.partitionBy(*group)
    kept = weights.withColumn("k", F.row_number().over(w.orderBy(F.desc(weight), joint))).where(F.col("k") <= n)
    return kept.withColumn(weight, F.col(weight) / F.sum(weight).over(w)).drop("k")


def skinned(vertices: DataFrame, weights: DataFrame, transforms: DataFrame) -> DataFrame:
    """Linear blend skinning: vertices (object_type, vertex, x, y, z), weights (object_type, vertex, joint, weight), transforms (object_type, joint, r0..r8, t0..t2)."""
    rows = vertices.join(weights, ["object_type", "vertex"]).join(transforms, ["object_type", "joint"])
    v = (F.col("x"), F.col("y"), F.col("z"))
    at = [sum((F.col(f"r{3 * i + k}") * v[k] for k in range(3)), F.col(f"t{i}")) for i in range(3)]
    return rows.groupBy("object_type", "vertex").agg(*(F.sum(F.col("weight") * at[i]).alias(c) for i, c in enumerate("xyz")))


def view(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Oblique projection."""
    return x - 0.36 * z, y - 0.22 * z


def fitted_pixels(points: DataFrame, group: list[str], size: int, pad: float = 0.1) -> DataFrame:
    """u, v of each point as pixels of a square picture per group, all of the group inside the padding and in proportion."""
    box = points.groupBy(*group).agg(*(f(c).alias(f"{n}_{c}") for c in ("u", "v") for n, f in (("lo", F.min), ("hi", F.max))))
    span = F.greatest(F.col("hi_u") - F.col("lo_u"), F.col("hi_v") - F.col("lo_v"), F.lit(1e-6))
    k = F.lit(size * (1 - 2 * pad)) / span
    px = F.lit(size / 2) + (F.col("u") - (F.col("lo_u") + F.col("hi_u")) / 2) * k
    py = F.lit(size / 2) - (F.col("v") - (F.col("lo_v") + F.col("hi_v")) / 2) * k
    return points.join(box, group).withColumns({"px": px, "py": py})


def weighted_rotation(rows: DataFrame, group: list[str], q: tuple, weight) -> DataFrame:
    """Per group the rotation whose log is the weighted mean of the logs: q0..q3."""
    logs = R.quat_log(q)
    total = rows.groupBy(*group).agg(*((F.sum(x * weight) / F.sum(weight)).alias(f"l{i}") for i, x in enumerate(logs)))
    return total.select(*group, *R.aliased("q", R.quat_exp(R.names("l", 3))))


def smoothed(rows: DataFrame, group: list[str], order: str, value: str, rate: float = 0.99) -> DataFrame:
    """Per group the last value of a running average that keeps ``rate`` of itself at each step and begins with the first value."""
    held = rows.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(order, F.col(value).cast("double").alias("v")))).alias("s"))
    return held.select(*group, F.aggregate("s", F.lit(None).cast("double"), lambda a, x: F.coalesce(a * rate + x["v"] * (1 - rate), x["v"])).alias("average"))
