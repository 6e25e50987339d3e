"""From raw animation to the 13-channel features and back: canonical orientation, place and size; encoding; decoding.

A clip is bounded by its frames and joints, and each is one Arrow group with all frames handled at once; nothing is done
per source.  Rotations are relative to the rest pose of the skeleton's offsets.

Clips whose skeleton is unusable, or that have fewer than two whole frames, come out as one row with ``error`` set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.operators import skeleton as S
from stridelake.operators.features import skeleton_of, with_skeletons
from stridelake.sources.bvh import multiply

MEAN_BONE = 0.2092142857142857
CONTACT_HEIGHT = 0.3
CONTACT_SPEED = 0.002
ROLLS = (-90.0, 90.0)

FEATURES = "object_type string, motion_id string, frame int, joint int, f array<float>, error string"


def matrices(q: np.ndarray) -> np.ndarray:
    w, x, y, z = np.moveaxis(q / np.maximum(np.linalg.norm(q, axis=-1, keepdims=True), 1e-12), -1, 0)
    rows = [[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]]
    return np.moveaxis(np.array(rows), (0, 1), (-2, -1))


def place(parents: list[int], offsets: np.ndarray, root: np.ndarray, local: np.ndarray) -> np.ndarray:
    """World positions (frames, joints, 3) for local rotation matrices."""
    spin, spots = [local[:, 0]], [root]
    for j in range(1, len(parents)):
        p = parents[j]
        spots.append(spots[p] + np.einsum("tik,k->ti", spin[p], offsets[j]))
        spin.append(spin[p] @ local[:, j])
    return np.stack(spots, axis=1)


def _unit(v: np.ndarray, fallback: tuple[float, float, float]) -> np.ndarray:
    n = np.linalg.norm(v, axis=-1, keepdims=True)
    return np.where(n > 1e-8, v / np.maximum(n, 1e-8), np.array(fallback))


def forward(world: np.ndarray, face: list[int]) -> np.ndarray:
    """Level facing direction of each frame: from tail to head (two joints), or across hips and shoulders by up (four: right and left hip, right and left shoulder)."""
    if len(face) == 2:
        ahead = world[:, face[1]] - world[:, face[0]]
    else:
        across = world[:, face[0]] - world[:, face[1]] + world[:, face[2]] - world[:, face[3]]
        ahead = np.cross(np.array([0.0, 1.0, 0.0]), _unit(across, (1.0, 0.0, 0.0)))
    ahead[:, 1] = 0
    return _unit(ahead, (0.0, 0.0, 1.0))


def yaw(direction: np.ndarray) -> np.ndarray:
    """Matrices of the turn about Y that takes each direction to +Z."""
    angle = -np.arctan2(direction[:, 0], direction[:, 2])
    c, s, o = np.cos(angle), np.sin(angle), np.zeros(len(angle))
    return np.moveaxis(np.array([[c, o, s], [o, o + 1, o], [-s, o, c]]), 2, 0)


def canonical_frame(parents: list[int], offsets: np.ndarray, root: np.ndarray, local: np.ndarray, face: list[int], scale: float, ground: list[int]) -> tuple[float, np.ndarray, float]:
    """What ``canonical`` takes away from a clip: the angle of its first facing, its first place on the ground, and its lowest height, in the scaled skeleton's units."""
    offsets, root = offsets * scale, root * scale
    ahead = forward(place(parents, offsets, root, local)[:1], face)[0]
    turn = yaw(ahead[None])[0]
    root, local = root @ turn.T, np.concatenate([turn @ local[:, :1], local[:, 1:]], axis=1)
    origin = root[0] * [1, 0, 1]
    low = place(parents, offsets, root - origin, local)[:, ground or slice(None), 1].min()
    return float(-np.arctan2(ahead[0], ahead[2])), origin, float(low)


def canonical(parents: list[int], offsets: np.ndarray, root: np.ndarray, local: np.ndarray, face: list[int], scale: float, ground: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, root path and rotations of a clip that faces +Z in its first frame, starts over the origin, has the given scale and stands on the ground."""
    offsets, root = offsets * scale, root * scale
    turn = yaw(forward(place(parents, offsets, root, local)[:1], face))[0]
    root, local = root @ turn.T, np.concatenate([turn @ local[:, :1], local[:, 1:]], axis=1)
    root = root - root[0] * [1, 0, 1]
    world = place(parents, offsets, root, local)
    root = root - [0, world[:, ground or slice(None), 1].min(), 0]
    return offsets, root, local


def encode(parents: list[int], offsets: np.ndarray, root: np.ndarray, local: np.ndarray, face: list[int], feet: list[int], speed: float = CONTACT_SPEED) -> np.ndarray:
    """(frames - 1, joints, 13): positions and displacements as seen from the root's facing, the parent's rotation as 6D, and contacts."""
    world = place(parents, offsets, root, local)
    facing = yaw(forward(world, face))
    seen = np.einsum("tik,tjk->tji", facing, world - world[:, :1] * [1, 0, 1])
    carried = np.concatenate([facing[:, None], local[:, [parents[j] for j in range(1, len(parents))]]], axis=1)
    moved = np.einsum("tik,tjk->tji", facing[1:], world[1:] - world[:-1])
    contact = np.zeros((len(world) - 1, len(parents), 1))
    if feet:
        height = world[1:, feet, 1] - world[:, feet, 1].min()
        contact[:, feet, 0] = (((world[1:, feet] - world[:-1, feet]) ** 2).sum(-1) <= speed) & (np.abs(height) <= CONTACT_HEIGHT)
    out = np.concatenate([seen[:-1], carried[:-1, ..., 0], carried[:-1, ..., 1], moved, contact], axis=-1)
    return out


def rebased(rest: np.ndarray, q: np.ndarray, parents: list[int]) -> np.ndarray:
    """Rotations relative to a rest pose: each joint's quaternion seen through the rest rotations of its ancestors (rest: joints x 4, q: frames x joints x 4)."""
    turned = lambda x: x * np.array([1.0, -1.0, -1.0, -1.0])
    total = rest.copy()
    out = q.copy()
    out[:, 0] = multiply(q[:, 0], np.broadcast_to(turned(rest[0]), q[:, 0].shape))
    for j in range(1, len(parents)):
        above = total[parents[j]]
        total[j] = multiply(above, rest[j])
        wide = lambda x: np.broadcast_to(x, q[:, j].shape)  # noqa: B023, E731
        out[:, j] = multiply(multiply(multiply(wide(above), q[:, j]), wide(turned(rest[j]))), wide(turned(above)))
    return out


def unbased(rest: np.ndarray, q: np.ndarray, parents: list[int]) -> np.ndarray:
    """The inverse of ``rebased``."""
    turned = lambda x: x * np.array([1.0, -1.0, -1.0, -1.0])
    total = rest.copy()
    out = q.copy()
    out[:, 0] = multiply(q[:, 0], np.broadcast_to(rest[0], q[:, 0].shape))
    for j in range(1, len(parents)):
        above = total[parents[j]]
        total[j] = multiply(above, rest[j])
        wide = lambda x: np.broadcast_to(x, q[:, j].shape)  # noqa: B023, E731
        out[:, j] = multiply(multiply(multiply(wide(turned(above)), q[:, j]), wide(above)), wide(rest[j]))
    return out


def aligned_rest(rotations: np.ndarray, align: np.ndarray) -> np.ndarray:
    """Rotations (frames x joints x 4) for offsets turned by ``align``: the root is turned back, all others are conjugated."""
    a = np.broadcast_to(align, rotations.shape)
    back = a * np.array([1.0, -1.0, -1.0, -1.0])
    out = multiply(multiply(a, rotations), back)
    out[:, 0] = multiply(rotations[:, 0], back[:, 0])
    return out


def rest_roll(topology: DataFrame, feet: str = "toe|foot|hoof|ashi|paw|pad", core: str = "hips|hub|spine|chest|neck") -> DataFrame:
    """Per skeleton the roll about Z, -90 or 90 degrees, that lifts the core joints highest above the feet; -90 where they are equal or either is missing."""
    pos = S.rest_positions(topology).join(S.joints(topology).select("object_type", "joint", F.lower("name").alias("name")), ["object_type", "joint"])
    # a roll by +90 degrees takes x to y, one by -90 takes -x to y
    mean = pos.groupBy("object_type").agg(F.avg(F.when(F.col("name").rlike(core), F.col("x"))).alias("core"), F.avg(F.when(F.col("name").rlike(feet), F.col("x"))).alias("feet"))
    gain = F.col("core") - F.col("feet")
    return mean.select("object_type", F.when(gain > 1e-8, F.lit(ROLLS[1])).otherwise(F.lit(ROLLS[0])).alias("roll"), F.abs(gain).alias("score"))


def _clip(face_of: str, speed: float):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        names = [key[0].as_py(), key[1].as_py()]

        def failed(why: str) -> pa.Table:
            return pa.table({"object_type": [names[0]], "motion_id": [names[1]], "frame": pa.array([None], pa.int32()), "joint": pa.array([None], pa.int32()), "f": pa.array([None], pa.list_(pa.float32())), "error": [why]})

        skeleton = skeleton_of(t)
        if skeleton is None:
            return failed("skeleton")
        parents, offsets = skeleton["parents"], np.array(skeleton["offsets"], float)
        feet, face = skeleton["foot_joint_idx"] or [], skeleton[face_of]
        n = len(parents)
        if not n or parents[0] != -1 or any(p >= j or p < 0 for j, p in enumerate(parents) if j):
            return failed("skeleton")
        frame, joint = t.column("frame").to_numpy(), t.column("joint").to_numpy()
        frames, at = np.unique(frame, return_inverse=True)
        have = np.zeros((len(frames), n), bool)
        inside = joint < n
        have[at[inside], joint[inside]] = True
        q, root = np.zeros((len(frames), n, 4)), np.zeros((len(frames), 3))
        q[at[inside], joint[inside]] = t.column("q").combine_chunks().flatten().to_numpy().reshape(-1, 4)[inside]
        first = joint == 0
        root[at[first]] = t.column("pos").combine_chunks().flatten().to_numpy().reshape(-1, 3)[first]
        whole = have.all(axis=1)
        q, root, frames = q[whole], root[whole], frames[whole]
        if len(frames) < 2:
            return failed("frames")
        used = skeleton["scale_ref_joint_idx"] or list(range(1, n))
        bones = np.linalg.norm(offsets[used], axis=-1)
        bones = bones[bones > 1e-8]
        scale = MEAN_BONE / bones.mean() if len(bones) else 1.0
        offsets, root, local = canonical(parents, offsets, root, matrices(q), face, scale, feet)
        x = encode(parents, offsets, root, local, face, feet, speed).astype(np.float32)
        if not np.isfinite(x).all():
            return failed("not finite")
        tt, jj = np.meshgrid(np.arange(len(x)), np.arange(n), indexing="ij")
        f = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, 13), pa.int32()), pa.array(x.ravel()))
        k = tt.size
        return pa.table({"object_type": pa.array([names[0]] * k, pa.string()), "motion_id": pa.array([names[1]] * k, pa.string()), "frame": pa.array(tt.ravel(), pa.int32()), "joint": pa.array(jj.ravel(), pa.int32()), "f": f, "error": pa.nulls(k, pa.string())})

    return run


def encoded(raw: DataFrame, topology: DataFrame, face: str = "face", speed: float = CONTACT_SPEED) -> DataFrame:
    """raw: object_type, motion_id, frame, joint, q (w first), pos.  topology: parents, offsets, foot_joint_idx, scale_ref_joint_idx and the joints that tell the facing.  Features of each clip in canonical form."""
    t = topology.select("object_type", "parents", "offsets", "foot_joint_idx", "scale_ref_joint_idx", face)
    rows = raw.select("object_type", "motion_id", "frame", "joint", F.col("q").cast("array<double>").alias("q"), F.col("pos").cast("array<double>").alias("pos"))
    return with_skeletons(rows.join(t.select("object_type"), "object_type", "left_semi"), t).groupBy("object_type", "motion_id").applyInArrow(_clip(face, speed), FEATURES)


def scaled_topology(topology: DataFrame) -> DataFrame:
    """Skeletons at the size that ``encoded`` gives its clips."""
    factor = S.scale_factors(topology, MEAN_BONE).select("object_type", "factor")
    k = F.coalesce("factor", F.lit(1.0))
    return topology.join(factor, "object_type", "left").withColumn("offsets", F.transform("offsets", lambda o: F.transform(o, lambda x: x * k))).drop("factor")


PARAMETERS = "object_type string, motion_id string, scale double, angle double, x double, z double, low double"


def bone_scale(offsets: np.ndarray, used: list[int]) -> float:
    """The factor that gives the used bones the mean length of all skeletons."""
    bones = np.linalg.norm(offsets[used or list(range(1, len(offsets)))], axis=-1)
    bones = bones[bones > 1e-8]
    return MEAN_BONE / bones.mean() if len(bones) else 1.0


def _raw_clip(t: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Root path and rotations of the whole frames."""
    frame, joint = t.column("frame").to_numpy(), t.column("joint").to_numpy()
    frames, at = np.unique(frame, return_inverse=True)
    inside = joint < n
    have = np.zeros((len(frames), n), bool)
    have[at[inside], joint[inside]] = True
    q, root = np.zeros((len(frames), n, 4)), np.zeros((len(frames), 3))
    q[at[inside], joint[inside]] = t.column("q").combine_chunks().flatten().to_numpy().reshape(-1, 4)[inside]
    root[at[joint == 0]] = t.column("pos").combine_chunks().flatten().to_numpy().reshape(-1, 3)[joint == 0]
    whole = have.all(axis=1)
    return root[whole], q[whole]


def _frame_of(face_of: str):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        skeleton = skeleton_of(t)
        out = dict.fromkeys(("scale", "angle", "x", "z", "low"))
        if skeleton is not None:
            offsets = np.array(skeleton["offsets"], float)
            root, q = _raw_clip(t, len(offsets))
            if len(root) >= 2:
                scale = bone_scale(offsets, skeleton["scale_ref_joint_idx"])
                angle, origin, low = canonical_frame(skeleton["parents"], offsets, root, matrices(q), skeleton[face_of], scale, skeleton["foot_joint_idx"] or [])
                out = {"scale": scale, "angle": angle, "x": origin[0], "z": origin[2], "low": low}
        return pa.table({"object_type": pa.array([key[0].as_py()]), "motion_id": pa.array([key[1].as_py()])} | {k: pa.array([v], pa.float64()) for k, v in out.items()})

    return run


def clip_parameters(raw: DataFrame, topology: DataFrame, face: str = "face") -> DataFrame:
    """Per clip of ``encoded``'s input what its canonical form leaves out: scale, first facing, first place and lowest height.  With them ``decoded`` gives the raw animation back."""
    t = topology.select("object_type", "parents", "offsets", "foot_joint_idx", "scale_ref_joint_idx", face)
    rows = raw.select("object_type", "motion_id", "frame", "joint", F.col("q").cast("array<double>").alias("q"), F.col("pos").cast("array<double>").alias("pos"))
    return with_skeletons(rows.join(t.select("object_type"), "object_type", "left_semi"), t).groupBy("object_type", "motion_id").applyInArrow(_frame_of(face), PARAMETERS).where("scale is not null")


RAW = "object_type string, motion_id string, frame int, joint int, m array<double>, x double, y double, z double"


def _decode(key: tuple, t: pa.Table) -> pa.Table:
    skeleton = skeleton_of(t)
    parents = np.array(skeleton["parents"]) if skeleton else np.zeros(0, int)
    n = len(parents)
    frame, joint = t.column("frame").to_numpy(), t.column("joint").to_numpy()
    frames, at = np.unique(frame, return_inverse=True)
    f = np.zeros((len(frames), max(n, 1), 13))
    inside = joint < n
    f[at[inside], joint[inside]] = t.column("f").combine_chunks().flatten().to_numpy().astype(float).reshape(-1, 13)[inside]
    scale, angle, x0, z0, low = (t.column(k)[0].as_py() for k in ("scale", "angle", "x", "z", "low"))
    first = f[..., 3:6] / np.maximum(np.linalg.norm(f[..., 3:6], axis=-1, keepdims=True), 1e-8)
    third = np.cross(first, f[..., 6:9])
    third /= np.maximum(np.linalg.norm(third, axis=-1, keepdims=True), 1e-8)
    turn = np.stack([first, np.cross(third, first), third], axis=-1)
    local = np.tile(np.eye(3), (len(frames), max(n, 1), 1, 1))  # joints without a child keep the rest pose
    for j in range(n - 1, 0, -1):
        local[:, parents[j]] = turn[:, j]  # the first child counts
    step = np.zeros((len(frames), 3))
    step[1:, [0, 2]] = f[:-1, 0][:, [9, 11]]
    root = np.cumsum(np.einsum("tji,tj->ti", turn[:, 0], step), axis=0)
    root[:, 1] = f[:, 0, 1]
    c, s = np.cos(angle), np.sin(angle)
    faced = np.array([[c, 0, s], [0, 1, 0], [-s, 0, c]])
    root = (root + [x0, low, z0]) @ faced / scale
    local[:, 0] = faced.T @ local[:, 0]
    tt, jj = np.meshgrid(frames, np.arange(n), indexing="ij")
    k = tt.size
    spots = np.repeat(root[:, None], n, axis=1).reshape(-1, 3)
    m = pa.ListArray.from_arrays(pa.array(np.arange(0, 9 * k + 1, 9), pa.int32()), pa.array(local[:, :n].reshape(-1)))
    return pa.table({"object_type": pa.array([key[0].as_py()] * k, pa.string()), "motion_id": pa.array([key[1].as_py()] * k, pa.string()), "frame": pa.array(tt.ravel(), pa.int32()), "joint": pa.array(jj.ravel(), pa.int32()), "m": m} | {a: pa.array(spots[:, i], pa.float64()) for i, a in enumerate("xyz")})


def decoded(features: DataFrame, topology: DataFrame, parameters: DataFrame) -> DataFrame:
    """The inverse of ``encoded``: per frame and joint the joint's own rotation (m, row by row) and the root's raw place.  Joints that no child carries come out at rest."""
    rows = features.select("object_type", "motion_id", "frame", "joint", "f").join(parameters, ["object_type", "motion_id"])
    return with_skeletons(rows, topology.select("object_type", "parents")).groupBy("object_type", "motion_id").applyInArrow(_decode, RAW)


def transferred(source: tuple, source_rest: tuple, target_rest: tuple) -> tuple:
    """A pose (3 x 3, as columns) carried from one rest pose to another: source, source_rest undone, target_rest."""
    from stridelake.functions import rotations as R

    return R.matrix_multiply(R.matrix_multiply(source, R.matrix_transpose(source_rest)), target_rest)


def expanded(small: DataFrame, mapping: DataFrame, rest: DataFrame) -> DataFrame:
    """Features of a reduced rig on the full one: joints of the mapping (object_type, small_joint, joint) take their readings, others those of the rest pose (object_type, joint, f).

    Children of one joint all carry its rotation, so a joint that is not mapped takes channels 3-8 of a mapped sibling (rest: parent), where there is one.
    """
    clips = small.select("object_type", "motion_id", "frame").distinct()
    full = clips.join(rest.withColumnRenamed("f", "rest_f"), "object_type")
    taken = small.withColumnRenamed("joint", "small_joint").join(mapping, ["object_type", "small_joint"]).select("object_type", "motion_id", "frame", "joint", "f")
    met = full.join(taken, ["object_type", "motion_id", "frame", "joint"], "left")
    from pyspark.sql import Window as W

    sibling = F.min_by("f", F.when(F.col("f").isNotNull(), F.col("joint"))).over(W.partitionBy("object_type", "motion_id", "frame", "parent"))
    turned = F.concat(F.slice("rest_f", 1, 3), F.slice(sibling, 4, 6), F.slice("rest_f", 10, 4))
    return met.select("object_type", "motion_id", "frame", "joint", F.coalesce("f", turned, "rest_f").alias("f"))
