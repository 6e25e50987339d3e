"""Per-frame motion features: statistics, normalisation, trajectories, contacts, slices, and forward kinematics.

Input rows are (object_type, motion_id, frame, joint, f) with 13 finite readings.  Windows run over single clips,
which are bounded, so no source is ever one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.functions import rotations as R
from stridelake.scratch import sized, stored

CLIP = ["object_type", "motion_id"]
KEYS = [*CLIP, "frame", "joint"]


def _series():
    return W.partitionBy(*CLIP, "joint").orderBy("frame")


def _frames():
    return W.partitionBy(*CLIP).orderBy("frame")


def block_of(channel: Column) -> Column:
    """0 position, 1 rotation, 2 displacement, 3 contact."""
    return F.when(channel < 3, 0).when(channel < 9, 1).when(channel < 12, 2).otherwise(3)


def group_statistics(motion: DataFrame, floor: float = 0.0) -> DataFrame:
    """Mean and population deviation per source, joint and channel; deviations are then evened out.

    The root's position, rotation and displacement deviations become the mean of their block; those of all other joints
    share one mean per block; contact deviations that are not 0 become their mean, and 0 becomes 1.  ``floor`` bounds
    all but the contact channel from below.
    """
    rows = motion.select("object_type", "joint", F.posexplode("f").alias("channel", "x"))
    raw = rows.groupBy("object_type", "joint", "channel").agg(F.avg(F.col("x").cast("double")).alias("mean"), F.stddev_pop(F.col("x").cast("double")).alias("sd"))
    raw = raw.withColumns({"block": block_of(F.col("channel")), "root": F.col("joint") == 0})
    # variances of near-constant channels are noise below 1e-12
    raw = raw.withColumn("sd", F.when(F.col("sd") < 1e-12, 0.0).otherwise(F.col("sd")))
    within = W.partitionBy("object_type", "block", "root")
    contact = W.partitionBy("object_type", "block")
    even = F.when(F.col("block") < 3, F.avg("sd").over(within)).when(F.col("sd") == 0, 1.0).otherwise(F.avg(F.when(F.col("sd") != 0, F.col("sd"))).over(contact))
    floored = F.when(F.col("block") < 3, F.greatest(even, F.lit(floor))).otherwise(even)
    return raw.select("object_type", "joint", "channel", "mean", floored.alias("std"))


def z_normalize(motion: DataFrame, stats: DataFrame) -> DataFrame:
    """(x - mean) / (std + 1e-6) per row and channel, missing or undefined as 0: (keys, z, s, f)."""
    s = stored(stats.groupBy("object_type", "joint").agg(F.array_sort(F.collect_list(F.struct("channel", "mean", "std"))).alias("s")), "statistics")
    z = F.zip_with("f", "s", lambda x, q: F.nanvl(F.coalesce((x.cast("double") - q["mean"]) / (q["std"] + 1e-6), F.lit(0.0)), F.lit(0.0)))
    return motion.join(sized(s), ["object_type", "joint"]).select(*KEYS, z.alias("z"), "s", "f")


def z_restore(normalized: DataFrame) -> DataFrame:
    """The inverse, with the same 1e-6."""
    return normalized.select(*KEYS, F.zip_with("z", "s", lambda z, q: z * (q["std"] + 1e-6) + q["mean"]).alias("f"))


def root_trajectory(motion: DataFrame) -> DataFrame:
    """Per frame the root's facing matrix (r0..r8) and world position: displacements of the frame before, turned back by this frame's facing, summed up; height as stored."""
    root = motion.where("joint = 0").select(*CLIP, "frame", *R.aliased("g", R.parts("f", 3, 6)), F.get("f", F.lit(1)).cast("double").alias("y"), *(F.coalesce(F.lag(F.get("f", F.lit(c))).over(_frames()), F.lit(0.0)).cast("double").alias(f"d{c}") for c in (9, 11)))
    root = root.select(*CLIP, "frame", "y", "d9", "d11", *R.aliased("r", R.sixd_matrix(R.names("g", 6))))
    step = R.matrix_apply(R.matrix_transpose(R.names("r", 9)), (F.col("d9"), F.lit(0.0), F.col("d11")))
    running = _frames().rowsBetween(W.unboundedPreceding, 0)
    return root.select(*CLIP, "frame", *R.names("r", 9), F.sum(step[0]).over(running).alias("x"), "y", F.sum(step[2]).over(running).alias("z"))


def yaw_trajectory(angular: DataFrame) -> DataFrame:
    """The older form: (clip, frame, yaw_step, dx, dz, y) with turns per frame; angle and position are both summed with one frame's delay."""
    running = _frames().rowsBetween(W.unboundedPreceding, 0)
    late = lambda c: F.coalesce(F.lag(c).over(_frames()), F.lit(0.0))
    a = angular.select(*CLIP, "frame", "y", late("yaw_step").alias("w"), late("dx").alias("dx"), late("dz").alias("dz"))
    a = a.withColumn("angle", F.sum("w").over(running))
    q = R.quat_conjugate((F.cos("angle"), F.lit(0.0), F.sin("angle"), F.lit(0.0)))
    step = R.quat_rotate(q, (F.col("dx"), F.lit(0.0), F.col("dz")))
    return a.select(*CLIP, "frame", "angle", "y", step[0].alias("sx"), step[2].alias("sz")).select(*CLIP, "frame", "angle", F.sum("sx").over(running).alias("x"), "y", F.sum("sz").over(running).alias("z"))


def world_positions(motion: DataFrame) -> DataFrame:
    """Root-relative positions back in the world: turned by the inverse facing, moved to the root."""
    place = root_trajectory(motion)
    rows = motion.select(*KEYS, *R.aliased("p", R.parts("f", 0, 3))).join(place, [*CLIP, "frame"])
    v = R.matrix_apply(R.matrix_transpose(R.names("r", 9)), R.names("p", 3))
    root = F.col("joint") == 0
    return rows.select(*KEYS, *(F.when(root, F.col(k)).otherwise(v[i] + (F.col(k) if k != "y" else 0.0)).alias(f"w{i}") for i, k in enumerate("xyz")), *R.names("r", 9))


def relative_positions(world: DataFrame) -> DataFrame:
    """World positions (w0..w2, with the facing r0..r8) relative to the root's ground point and facing +Z."""
    root = world.where("joint = 0").select(*CLIP, "frame", F.col("w0").alias("x0"), F.col("w2").alias("z0"))
    rows = world.join(root, [*CLIP, "frame"])
    v = R.matrix_apply(R.names("r", 9), (F.col("w0") - F.col("x0"), F.col("w1"), F.col("w2") - F.col("z0")))
    return rows.select(*KEYS, *R.aliased("p", v))


def local_velocity(world: DataFrame) -> DataFrame:
    """Displacement to the next frame, turned by the next frame's facing; the last frame of a run has none."""
    ahead = [F.lead(f"w{i}").over(_series()).alias(f"n{i}") for i in range(3)] + [F.lead(f"r{i}").over(_series()).alias(f"q{i}") for i in range(9)]
    rows = world.select(*KEYS, "w0", "w1", "w2", *ahead, F.lead("frame").over(_series()).alias("next"))
    rows = rows.where(F.col("next") == F.col("frame") + 1)
    return rows.select(*KEYS, *R.aliased("v", R.matrix_apply(R.names("q", 9), R.minus(R.names("n", 3), R.names("w", 3)))))


def foot_contacts(world: DataFrame, feet: DataFrame, speed: float, height: float = 0.3, relative_ground: bool = True) -> DataFrame:
    """1 where a foot joint moves at most ``speed`` (squared, per frame) to the next frame and is then at most ``height`` above the clip's ground; 0 for every other joint."""
    rows = world.join(feet.select("object_type", F.explode("foot_joint_idx").alias("joint"), F.lit(True).alias("foot")), ["object_type", "joint"], "left")
    ground = F.min(F.when(F.col("foot"), F.col("w1"))).over(W.partitionBy(*CLIP)) if relative_ground else F.lit(0.0)
    rows = rows.select(*KEYS, "foot", "w0", "w1", "w2", ground.alias("ground"), *(F.lead(f"w{i}").over(_series()).alias(f"n{i}") for i in range(3)), F.lead("frame").over(_series()).alias("next")).where("next = frame + 1")
    moved = R.minus(R.names("n", 3), R.names("w", 3))
    touching = F.col("foot") & (R.dot(moved, moved) <= speed) & (F.abs(F.col("n1") - F.col("ground")) <= height)
    return rows.select(*KEYS, F.coalesce(touching, F.lit(False)).cast("int").alias("contact"))


def foot_sliding(world: DataFrame, motion: DataFrame, other: DataFrame) -> DataFrame:
    """Per clip: squared difference of the joint velocities of two sets of positions on contact frames, over 1 + the number of contacts."""
    step = lambda k: [(F.lead(f"{k}{i}").over(_series()) - F.col(f"{k}{i}")).alias(f"s{k}{i}") for i in range(3)]
    both = world.select(*KEYS, "w0", "w1", "w2").join(other.select(*KEYS, "o0", "o1", "o2"), KEYS).join(motion.select(*KEYS, F.get("f", F.lit(12)).alias("contact")), KEYS)
    rows = both.select(*KEYS, "contact", *step("w"), *step("o"), F.lead("frame").over(_series()).alias("next")).where("next = frame + 1 and contact = 1")
    d = R.minus(R.names("sw", 3), R.names("so", 3))
    return rows.groupBy(*CLIP).agg((F.sum(R.dot(d, d)) / (1 + F.count(F.lit(1)))).alias("loss"), F.count(F.lit(1)).alias("contacts"))


def excursion(motion: DataFrame) -> DataFrame:
    """Per clip the root's summed rotation change, and its rank within the source (largest first, then by name)."""
    rows = motion.where("joint = 0").select(*CLIP, "frame", F.slice("f", 4, 6).alias("d"), F.lag(F.slice("f", 4, 6)).over(_frames()).alias("before"))
    change = F.aggregate(F.zip_with("d", "before", lambda a, b: F.abs(a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, x: s + x)
    total = rows.groupBy(*CLIP).agg(F.sum(F.coalesce(change, F.lit(0.0))).alias("excursion"))
    return total.withColumn("place", F.row_number().over(W.partitionBy("object_type").orderBy(F.round("excursion", 9).desc(), "motion_id")))


def clip_slices(clips: DataFrame, longest: int = 240, step: int = 200) -> DataFrame:
    """Segments of each clip (motion_id, n_frames): while more than ``longest`` remain, ``step`` frames are cut off; ``longest`` <= 0 cuts nothing."""
    full = F.when(F.lit(longest) <= 0, 0).otherwise(F.greatest(F.lit(0), F.ceil((F.col("n_frames") - longest) / F.lit(float(step))))).cast("int")
    parts = clips.where("n_frames > 0").select("motion_id", "n_frames", full.alias("n_full")).select("*", F.explode(F.sequence(F.lit(0), F.col("n_full"))).alias("segment"))
    begin = F.col("segment") * step
    return parts.select("motion_id", "segment", begin.alias("first_frame"), F.when(F.col("segment") == F.col("n_full"), F.col("n_frames") - begin).otherwise(step).alias("length"))


def even_frames(clips: DataFrame, count: int) -> DataFrame:
    """At most ``count`` frames spread evenly over each clip, both ends included, halves rounded to even; all frames of shorter clips."""
    at = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.bround(i * (F.col("n_frames") - 1) / F.lit(float(count - 1))).cast("int"))
    chosen = F.when(F.col("n_frames") <= count, F.sequence(F.lit(0), F.col("n_frames") - 1)).otherwise(F.array_distinct(at))
    return clips.where("n_frames > 0").select("motion_id", F.posexplode(chosen).alias("place", "frame"))


def crop_or_pad(motion: DataFrame, length: int) -> DataFrame:
    """``length`` frames per clip and joint: the middle of longer clips, zeros behind shorter ones; by frame order, not number."""
    ranked = motion.withColumn("k", F.row_number().over(_series()) - 1).withColumn("n", F.count(F.lit(1)).over(W.partitionBy(*CLIP, "joint")))
    start = F.floor(F.greatest(F.col("n") - length, F.lit(0)) / 2)
    kept = ranked.withColumn("place", (F.col("k") - start).cast("int")).where(f"place between 0 and {length - 1}")
    heads = ranked.select(*CLIP, "joint", "n").distinct().where(F.col("n") < length)
    pad = heads.select(*CLIP, "joint", F.explode(F.sequence(F.col("n").cast("int"), F.lit(length - 1))).alias("place"), F.array_repeat(F.lit(0.0).cast("float"), 13).alias("f"), F.lit(False).alias("real"))
    return kept.select(*CLIP, "joint", "place", "f", F.lit(True).alias("real")).unionByName(pad)


def attention_spans(clips: DataFrame, window: int, longest: int) -> DataFrame:
    """Frames each frame may look at: ``window`` // 2 back, one more ahead, inside the clip, and always frame 0."""
    m = window // 2
    rows = clips.select("motion_id", F.least("n_frames", F.lit(longest)).alias("n")).where("n > 0").select("motion_id", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("frame"))
    low, high = F.greatest(F.col("frame") - m, F.lit(0)), F.least(F.col("frame") + m + 1, F.col("n") - 1)
    return rows.select("motion_id", "frame", low.alias("first"), high.alias("last"), (high - low + 1 + (low > 0).cast("int")).alias("n_seen"))


def grounded(world: DataFrame) -> DataFrame:
    """Positions with the root's ground point of each frame at the origin and the clip's lowest point at height 0."""
    root = world.where("joint = 0").select(*CLIP, "frame", F.col("w0").alias("x0"), F.col("w2").alias("z0"))
    low = F.min("w1").over(W.partitionBy(*CLIP))
    return world.withColumn("low", low).join(root, [*CLIP, "frame"]).select(*KEYS, (F.col("w0") - F.col("x0")).alias("g0"), (F.col("w1") - F.col("low")).alias("g1"), (F.col("w2") - F.col("z0")).alias("g2"))


def box_diagonal(world: DataFrame) -> DataFrame:
    """Per clip the mean diagonal of the frames' bounding boxes."""
    per = world.groupBy(*CLIP, "frame").agg(*((F.max(f"w{i}") - F.min(f"w{i}")).alias(f"e{i}") for i in range(3)))
    return per.groupBy(*CLIP).agg((F.avg(R.norm(R.names("e", 3))) + 1e-8).alias("diagonal"))


def child_spread(motion: DataFrame, joints: DataFrame) -> DataFrame:
    """Per clip the largest difference between the 6D rotations that children of one joint carry, against the first child."""
    rows = motion.join(joints.where("parent >= 0").select("object_type", "joint", "parent"), ["object_type", "joint"]).select(*CLIP, "frame", "joint", "parent", F.slice("f", 4, 6).alias("d"))
    first = F.first("d").over(W.partitionBy(*CLIP, "frame", "parent").orderBy("joint"))
    gap = F.array_max(F.zip_with("d", first, lambda a, b: F.abs(a.cast("double") - b.cast("double"))))
    return rows.select(*CLIP, gap.alias("gap")).groupBy(*CLIP).agg(F.max("gap").alias("spread"))


def frozen(motion: DataFrame, still: list[int]) -> DataFrame:
    """The listed joints keep the readings of their first frame."""
    first = F.first("f").over(_series())
    return motion.select(*KEYS, F.when(F.col("joint").isin(still), first).otherwise(F.col("f")).alias("f"))


def resampled_rotations(motion: DataFrame, size: int) -> DataFrame:
    """Each series of 6D rotations (channels 3-8) at ``size`` even places between its first and last frame, by slerp."""
    m = motion.select(*KEYS, *R.aliased("g", R.parts("f", 3, 6)))
    m = m.select(*KEYS, *R.aliased("m", R.sixd_matrix(R.names("g", 6))))
    m = m.select(*KEYS, *R.aliased("a", R.matrix_quat(R.names("m", 9))), (F.row_number().over(_series()) - 1).alias("k"), F.count(F.lit(1)).over(W.partitionBy(*CLIP, "joint")).alias("n"))
    pair = m.select(*CLIP, "joint", "k", "n", *R.names("a", 4), *(F.coalesce(F.lead(f"a{i}").over(W.partitionBy(*CLIP, "joint").orderBy("k")), F.col(f"a{i}")).alias(f"b{i}") for i in range(4)))
    # place i lies at i / size * (n - 1): each pair of frames makes the places between them
    low = F.ceil(F.col("k") * size / (F.col("n") - 1)).cast("int")
    high = (F.ceil((F.col("k") + 1) * size / (F.col("n") - 1)) - 1).cast("int")
    spans = pair.where("n > 1 and k < n - 1").select("*", low.alias("lo"), F.least(high, F.lit(size - 1)).alias("hi")).where("lo <= hi")
    grid = spans.select("*", F.explode(F.sequence("lo", "hi")).alias("place")).withColumn("t", F.col("place") / F.lit(float(size)) * (F.col("n") - 1) - F.col("k"))
    q = grid.select(*CLIP, "joint", "place", *R.aliased("q", R.quat_slerp(R.names("a", 4), R.names("b", 4), F.col("t"))))
    return q.select(*CLIP, "joint", "place", *R.aliased("d", R.matrix_6d(R.quat_matrix(R.names("q", 4)))))


FK = "object_type string, motion_id string, frame int, joint int, x double, y double, z double"


def with_skeletons(rows: DataFrame, skeletons: DataFrame) -> DataFrame:
    """Rows of clips with the skeleton of their object_type on one row of each clip (null on all others), joined behind the exchange by clip."""
    found = stored(skeletons.select(F.col("object_type").alias("of"), F.struct(*(c for c in skeletons.columns if c != "object_type")).alias("skeleton")), "skeletons")
    first = F.row_number().over(W.partitionBy(*CLIP).orderBy("frame", "joint")) == 1
    marked = rows.repartition(*CLIP).withColumn("of", F.when(first, F.col("object_type")))
    return marked.join(sized(found), "of", "left").drop("of")


def skeleton_of(table: pa.Table) -> dict | None:
    """The skeleton that ``with_skeletons`` put on one of the rows; None where the clip has none."""
    column = table.column("skeleton").combine_chunks().drop_null()
    return column[0].as_py() if len(column) else None


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-8)


def _grid(table: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Frames, readings (frames x joints x 13), and which of them are there, of one clip."""
    frame, joint = table.column("frame").to_numpy(), table.column("joint").to_numpy()
    f = table.column("f").combine_chunks().flatten().to_numpy().astype(float).reshape(-1, 13)
    frames, at = np.unique(frame, return_inverse=True)
    ok = joint < n
    have = np.zeros((len(frames), n), bool)
    have[at[ok], joint[ok]] = True
    grid = np.zeros((len(frames), n, 13))
    grid[at[ok], joint[ok]] = f[ok]
    return frames, grid, have


def _turns(d: np.ndarray) -> np.ndarray:
    x = _unit(d[..., :3])
    z = _unit(np.cross(x, d[..., 3:]))
    return np.stack([x, np.cross(z, x), z], axis=-1)


def _root_path(turn: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """World positions of the root, from its matrices and readings in successive frames."""
    step = np.zeros((len(grid), 3))
    step[1:, [0, 2]] = grid[:-1][:, [9, 11]]
    root = np.cumsum(np.einsum("tji,tj->ti", turn, step), axis=0)
    root[:, 1] = grid[:, 1]
    return root


def _posed(skeleton: dict, grid: np.ndarray) -> np.ndarray:
    """World positions by rotations: all frames at once, joint by joint."""
    parents, offsets = np.array(skeleton["parents"]), np.array(skeleton["offsets"], float)
    n, frames = len(parents), grid
    turn = _turns(grid[..., 3:9])
    root = _root_path(turn[:, 0], grid[:, 0])
    own = np.tile(np.eye(3), (len(frames), n, 1, 1))
    for j in range(1, n):
        own[:, parents[j]] = turn[:, j]  # a joint's rotation is carried by its children: the last one counts
    spin, place = own.copy(), np.zeros((len(frames), n, 3))
    place[:, 0] = root
    for j in range(1, n):
        p = parents[j]
        spin[:, j] = spin[:, p] @ own[:, j]
        place[:, j] = place[:, p] + spin[:, p] @ offsets[j]
    return place


def _kinematics(key: tuple, table: pa.Table) -> pa.Table:
    """World positions of one clip by its rotations, whole frames only."""
    skeleton = skeleton_of(table)
    if skeleton is None:
        return pa.Table.from_pylist([], pa.schema([("object_type", pa.string()), ("motion_id", pa.string()), ("frame", pa.int32()), ("joint", pa.int32()), ("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64())]))
    n = len(skeleton["parents"])
    frames, grid, have = _grid(table, n)
    whole = have.all(axis=1)
    frames, place = frames[whole], _posed(skeleton, grid[whole])
    t, k = np.meshgrid(frames, np.arange(n), indexing="ij")
    flat = place.reshape(-1, 3)
    names = [pa.array([x.as_py()] * flat.shape[0], pa.string()) for x in key]
    return pa.table([*names, pa.array(t.ravel(), pa.int32()), pa.array(k.ravel(), pa.int32()), *(pa.array(flat[:, i]) for i in range(3))], names=["object_type", "motion_id", "frame", "joint", "x", "y", "z"])


ERRORS = "object_type string, motion_id string, mean_l2 double, diagonal double, spread double"


def _errors(key: tuple, table: pa.Table) -> pa.Table:
    """Of one clip: mean distance of positions by rotation and by position, mean box of the latter, and the largest difference between children of one joint."""
    skeleton = skeleton_of(table)
    out = {"object_type": [key[0].as_py()], "motion_id": [key[1].as_py()], "mean_l2": [None], "diagonal": [None], "spread": [None]}
    if skeleton is not None:
        parents = np.array(skeleton["parents"])
        frames, grid, have = _grid(table, len(parents))
        rooted = have[:, 0]
        turn = np.zeros((len(frames), 3, 3))
        turn[rooted] = _turns(grid[rooted, 0, 3:9])
        root = np.zeros((len(frames), 3))
        root[rooted] = _root_path(turn[rooted], grid[rooted, 0])
        world = np.einsum("tji,tkj->tki", turn, grid[..., :3]) + (root * [1, 0, 1])[:, None]
        world[:, 0] = root
        whole = have.all(axis=1)
        if whole.any():
            world = world[whole]
            out["mean_l2"] = [float(np.linalg.norm(_posed(skeleton, grid[whole]) - world, axis=-1).mean())]
            out["diagonal"] = [float(np.linalg.norm(world.max(axis=1) - world.min(axis=1), axis=-1).mean() + 1e-8)]
        gaps = []
        for p in np.unique(parents[parents >= 0]):
            children = np.flatnonzero(parents == p)
            held = have[:, children]
            d = grid[:, children, 3:9]
            first = d[np.arange(len(d)), held.argmax(axis=1)]
            gap = np.abs(d - first[:, None]).max(axis=-1)[held]
            gaps.append(gap.max() if len(gap) else -1.0)
        if gaps and max(gaps) >= 0:
            out["spread"] = [float(max(gaps))]
    return pa.table({k: pa.array(v, pa.string() if i < 2 else pa.float64()) for i, (k, v) in enumerate(out.items())})


def kinematic_errors(motion: DataFrame, topology: DataFrame) -> DataFrame:
    """Per clip mean_l2, diagonal and spread, in one pass behind one exchange; null mean_l2 where no frame is whole or the skeleton is not usable."""
    usable = topology.where(F.forall(F.transform("parents", lambda p, i: p < i), lambda b: b)).select("object_type", "parents", "offsets")
    return with_skeletons(motion, usable).groupBy(*CLIP).applyInArrow(_errors, ERRORS)


def forward_kinematics(motion: DataFrame, topology: DataFrame) -> DataFrame:
    """World positions from rotations and offsets, for skeletons whose parents come before their joints; frames that lack a joint are left out."""
    usable = topology.where(F.forall(F.transform("parents", lambda p, i: p < i), lambda b: b)).select("object_type", "parents", "offsets")
    return with_skeletons(motion, usable).groupBy(*CLIP).applyInArrow(_kinematics, FK)
