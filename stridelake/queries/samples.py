"""Sampling, batching, skinning and projection over the tables; round trips through files; streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions import rotations as R

from stridelake.operators import features as X
from stridelake.operators import sampling as P
from stridelake.operators import skeleton as S
from stridelake.queries.base import CLIP, FINITE, TOPOLOGY, Registry, finite_motion, first_clip, first_topology
from stridelake.queries.features import _WORLD
from stridelake.scratch import scratch_path, table
from stridelake.sources import bvh, files
from stridelake.streaming import progress

query = Registry()


def _u(key: str, seed: int) -> str:
    return f"((CAST('0x' || left(md5('{seed}:' || {key}), 8) AS BIGINT) + 0.5) / 4294967296.0)"


@query(
    f"""WITH {FINITE}, g AS (SELECT object_type, joint, frame + 1.0 AS w, f[4] AS a0, f[5] AS a1, f[6] AS a2, f[7] AS a3, sqrt(f[4]**2 + f[5]**2 + f[6]**2 + f[7]**2) AS n FROM m WHERE sqrt(f[4]**2 + f[5]**2 + f[6]**2 + f[7]**2) > 1e-3),
u AS (SELECT object_type, joint, w, CASE WHEN a0 < 0 THEN -1 ELSE 1 END * a0/n AS p0, CASE WHEN a0 < 0 THEN -1 ELSE 1 END * a1/n AS p1, CASE WHEN a0 < 0 THEN -1 ELSE 1 END * a2/n AS p2, CASE WHEN a0 < 0 THEN -1 ELSE 1 END * a3/n AS p3 FROM g),
l AS (SELECT *, atan2(sqrt(p1*p1 + p2*p2 + p3*p3), p0)/(sqrt(p1*p1 + p2*p2 + p3*p3) + 1e-10) AS k FROM u), s AS (SELECT object_type, joint, sum(p1*k*w)/sum(w) AS l1, sum(p2*k*w)/sum(w) AS l2, sum(p3*k*w)/sum(w) AS l3 FROM l GROUP BY ALL), z AS (SELECT *, sqrt(l1*l1 + l2*l2 + l3*l3) AS r FROM s)
SELECT object_type, joint, round(cos(r), 5) + 0.0 AS q0, round(sin(r)*l1/r, 5) + 0.0 AS q1, round(sin(r)*l2/r, 5) + 0.0 AS q2, round(sin(r)*l3/r, 5) + 0.0 AS q3 FROM z WHERE r > 1e-9"""
)
def sm_weighted_rotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source and joint the mean of channels 3-6 as quaternions through their logs, later frames counting more; means without a turn are left out."""
    m = finite_motion(spark, sf_dir).select("object_type", "joint", (F.col("frame") + 1.0).alias("w"), *R.aliased("a", R.parts("f", 3, 4))).where(R.norm(R.names("a", 4)) > 1e-3)
    out = P.weighted_rotation(m, ["object_type", "joint"], R.names("a", 4), F.col("w"))
    return out.where(R.norm(R.names("q", 4)[1:]) > 1e-9).select("object_type", "joint", *((F.round(f"q{i}", 5) + 0.0).alias(f"q{i}") for i in range(4)))


@query(
    f"""WITH {FINITE}, r AS (SELECT object_type, motion_id, frame, f[2] AS v, row_number() OVER w AS k, count(*) OVER (PARTITION BY object_type, motion_id) AS n FROM m WHERE joint = 0 WINDOW w AS (PARTITION BY object_type, motion_id ORDER BY frame, f[2]))
SELECT object_type, motion_id, round(sum(v * CASE WHEN k = 1 THEN 0.9**(n - 1) ELSE 0.1 * 0.9**(n - k) END), 5) + 0.0 AS average FROM r GROUP BY ALL"""
)
def sm_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running average of each clip's root height at its end."""
    m = finite_motion(spark, sf_dir).where("joint = 0").select("object_type", "motion_id", "frame", F.get("f", F.lit(1)).alias("v"))
    return P.smoothed(m, ["object_type", "motion_id"], "frame", "v", 0.9).withColumn("average", F.round("average", 5) + 0.0)


@query(f"WITH {CLIP}, n AS (SELECT object_type, count(*) AS n FROM c WHERE object_type IS NOT NULL GROUP BY 1) SELECT c.object_type, motion_id, round(1.0 / (SELECT count(*) FROM n) / n.n, 9) AS weight, round(-ln({_u('motion_id', 7)}) / (1.0 / (SELECT count(*) FROM n) / n.n), 4) AS draw FROM c JOIN n ON n.object_type = c.object_type")
def sm_balanced_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clip's balanced weight and its place value in a weighted draw without replacement."""
    w = P.balanced_weights(first_clip(spark, sf_dir).where("object_type is not null"), "object_type", "motion_id")
    return P.weighted_order(w, "motion_id", "weight", 7).select("object_type", "motion_id", F.round("weight", 9).alias("weight"), F.round("draw", 4).alias("draw"))


@query(f"WITH {CLIP}, n AS (SELECT object_type, count(*) AS n FROM c WHERE object_type IS NOT NULL GROUP BY 1), w AS (SELECT motion_id, -ln({_u('motion_id', 7)}) * n.n AS d FROM c JOIN n ON n.object_type = c.object_type) SELECT motion_id FROM w ORDER BY d, motion_id LIMIT 100")
def sm_balanced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = P.balanced_weights(first_clip(spark, sf_dir).where("object_type is not null"), "object_type", "motion_id")
    return P.weighted_sample(w, "motion_id", "weight", 100, 7).select("motion_id")


@query(f"WITH {CLIP}, r AS (SELECT motion_id, source_group, coalesce(lower(trim(split)), '') AS s, row_number() OVER (PARTITION BY source_group, coalesce(lower(trim(split)), '') ORDER BY {_u('motion_id', 3)}, motion_id) AS turn FROM c) SELECT motion_id, source_group, s, CAST(turn AS INTEGER) AS turn FROM r ORDER BY turn, source_group NULLS FIRST, s, motion_id LIMIT 80")
def sm_stratified_pilot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = first_clip(spark, sf_dir).select("motion_id", "source_group", F.coalesce(F.lower(F.trim("split")), F.lit("")).alias("s"))
    return P.stratified_pilot(rows, ["source_group", "s"], "motion_id", 80, 3)


_LOSS = f"WITH {FINITE}, l AS (SELECT (frame + joint) % 20 AS step, abs(f[2]) AS loss, motion_id || '|' || lpad(CAST(frame AS VARCHAR), 6, '0') || '|' || lpad(CAST(joint AS VARCHAR), 4, '0') AS o FROM m)"


def _losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("|", "motion_id", F.lpad(F.col("frame").cast("string"), 6, "0"), F.lpad(F.col("joint").cast("string"), 4, "0"))
    return finite_motion(spark, sf_dir).select(F.pmod(F.col("frame") + F.col("joint"), F.lit(20)).alias("step"), F.abs(F.get("f", F.lit(1)).cast("double")).alias("loss"), key.alias("o"))


@query(_LOSS + ", k AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY o DESC) AS k FROM l), p AS (SELECT step, sqrt(avg(loss**2)) AS w FROM k WHERE k <= 10 GROUP BY 1), q AS (SELECT step, w / sum(w) OVER () * 0.999 + 0.001 / count(*) OVER () AS p, count(*) OVER () AS n FROM p) SELECT step, round(p, 6) AS p, round(1 / (n * p), 6) AS weight FROM q")
def sm_step_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.step_weights(_losses(spark, sf_dir), "step", "loss", "o").withColumns({c: F.round(c, 6) for c in ("p", "weight")})


@query(_LOSS + " SELECT CAST(floor(step * 4 / 20.0) AS INTEGER) AS quartile, round(avg(loss), 6) AS mean, count(*) AS n FROM l GROUP BY 1")
def sm_quartile_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.quartile_means(_losses(spark, sf_dir), "step", "loss", 20).withColumn("mean", F.round("mean", 6))


@query(_LOSS + ", r AS (SELECT step, loss, (row_number() OVER (PARTITION BY step ORDER BY o) - 1) // 50 AS run FROM l) SELECT step, CAST(run AS INTEGER) AS run, round(avg(loss), 6) AS mean FROM r GROUP BY ALL")
def sm_interval_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.interval_means(_losses(spark, sf_dir), ["step"], "o", "loss", 50).withColumn("mean", F.round("mean", 6))


@query(_LOSS + ", p AS (SELECT step, substr(o, 1, 1) AS part, avg(loss) AS v, count(*) AS n FROM l GROUP BY ALL) SELECT step, round(sum(v * n) / sum(n), 6) AS mean, CAST(sum(n) AS BIGINT) AS n FROM p GROUP BY 1")
def sm_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of parts put together by their counts."""
    parts = _losses(spark, sf_dir).groupBy("step", F.substring("o", 1, 1).alias("part")).agg(F.avg("loss").alias("v"), F.count(F.lit(1)).alias("n"))
    return P.weighted_mean(parts, "step", "v", "n").withColumn("mean", F.round("mean", 6))


@query()
def sm_average_quaternions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean root facing of every clip."""
    m = finite_motion(spark, sf_dir).where("joint = 0").select("motion_id", *R.aliased("g", R.parts("f", 3, 6)))
    m = m.select("motion_id", *R.aliased("m", R.sixd_matrix(R.names("g", 6)))).select("motion_id", *R.aliased("q", R.matrix_quat(R.names("m", 9))))
    return P.average_quaternions(m, ["motion_id"], [f"q{i}" for i in range(4)]).withColumns({c: F.round(c, 4) for c in "wxyz"})


_JOINTS = "j AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS joint, unnest(parents) AS parent FROM topo)"


@query(
    f"""WITH {FINITE}, {TOPOLOGY}, {_JOINTS}, ft AS (SELECT object_type, unnest(foot_joint_idx) AS joint FROM topo), fr AS (SELECT object_type, joint FROM j WHERE parent >= 0 AND NOT EXISTS (SELECT 1 FROM j k WHERE k.object_type = j.object_type AND k.parent = j.joint) AND NOT EXISTS (SELECT 1 FROM ft WHERE ft.object_type = j.object_type AND ft.joint = j.joint)),
cl AS (SELECT DISTINCT object_type, motion_id, joint FROM m), l AS (SELECT cl.* FROM cl WHERE NOT (EXISTS (SELECT 1 FROM fr WHERE fr.object_type = cl.object_type AND fr.joint = cl.joint) AND {_u("motion_id || '|' || joint", 5)} < 0.3)),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY object_type, motion_id ORDER BY joint) - 1 AS INTEGER) AS new_joint FROM l) SELECT object_type, motion_id, joint, new_joint, count(*) AS n_rows FROM m JOIN n USING (object_type, motion_id, joint) GROUP BY ALL"""
)
def sm_without_joints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joints left, and their new numbers, when three tenths of the free end joints go."""
    t = first_topology(spark, sf_dir)
    out = P.without_joints(finite_motion(spark, sf_dir), S.joints(t), t, 0.3, 5)
    return out.groupBy("object_type", "motion_id", "joint", "new_joint").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"""WITH {FINITE}, {TOPOLOGY}, {_JOINTS}, p AS (SELECT object_type, parent AS p FROM j WHERE joint = 2), r AS (SELECT m.*, p.p FROM m LEFT JOIN p ON p.object_type = m.object_type),
a AS (SELECT object_type, motion_id, frame, joint + CASE WHEN p IS NOT NULL AND joint >= 2 THEN 1 ELSE 0 END AS joint, list_sum(f) AS total FROM r UNION ALL
SELECT lo.object_type, lo.motion_id, lo.frame, 2, (lo.f[1]+hi.f[1])/2 + (lo.f[2]+hi.f[2])/2 + (lo.f[3]+hi.f[3])/2 + lo.f[4]+lo.f[5]+lo.f[6]+lo.f[7]+lo.f[8]+lo.f[9] + (lo.f[10]+hi.f[10])/2 + (lo.f[11]+hi.f[11])/2 + (lo.f[12]+hi.f[12])/2 + lo.f[13] FROM r lo JOIN m hi ON hi.object_type = lo.object_type AND hi.motion_id = lo.motion_id AND hi.frame = lo.frame AND hi.joint = lo.p WHERE lo.joint = 2)
SELECT object_type, motion_id, CAST(joint AS INTEGER) AS joint, count(*) AS n, round(sum(total), 2) + 0.0 AS total FROM a GROUP BY ALL"""
)
def sm_with_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Motion with a joint in the middle of the bone above joint 2, summed per clip and joint."""
    out = P.with_midpoint(finite_motion(spark, sf_dir), S.joints(first_topology(spark, sf_dir)), 2)
    total = F.aggregate("f", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return out.groupBy("object_type", "motion_id", "joint").agg(F.count(F.lit(1)).alias("n"), (F.round(F.sum(total), 2) + 0.0).alias("total"))


@query(f"WITH {CLIP}, r AS (SELECT motion_id, row_number() OVER (ORDER BY {_u('motion_id', 11)}, motion_id) - 1 AS place, count(*) OVER () AS n FROM c WHERE n_frames >= 20) SELECT motion_id, place // 16 AS batch, place % 16 AS slot FROM r WHERE place < n // 16 * 16")
def sm_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips of at least 20 frames in shuffled full batches of 16."""
    return P.batches(P.long_enough(first_clip(spark, sf_dir), 20).select("motion_id"), 16, 11)


@query(f"WITH {TOPOLOGY}, g AS (SELECT object_type, parents, CAST(unnest(range(8)) AS INTEGER) AS joint FROM topo) SELECT object_type, joint, coalesce(CAST(parents[joint + 1] AS DOUBLE), -9) AS parent, joint < len(parents) AS real FROM g")
def sm_padded_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent arrays padded to eight joints."""
    j = S.joints(first_topology(spark, sf_dir)).select("object_type", "joint", F.col("parent").cast("double").alias("parent"))
    return P.padded_grid(j, ["object_type"], "joint", "parent", 8, -9.0)


@query(f"WITH {FINITE}, n AS (SELECT *, count(*) OVER (PARTITION BY object_type, motion_id, joint) AS n FROM m) SELECT object_type, motion_id, sum(CASE WHEN NOT (frame >= floor(n * 0.25) AND frame < floor(n * 0.75)) AND joint NOT IN (2, 3) THEN 1 ELSE 0 END)::BIGINT AS kept, count(*) AS n_rows FROM n GROUP BY ALL")
def sm_inpaint_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that in-painting keeps when the middle half of the frames and joints 2 and 3 are open."""
    from pyspark.sql import Window as W

    m = finite_motion(spark, sf_dir).withColumn("n", F.count(F.lit(1)).over(W.partitionBy(*X.CLIP, "joint")))
    keep = P.inpaint_mask(F.col("n"), F.col("frame"), F.col("joint"), 0.25, 0.75, [2, 3])
    return m.groupBy(*X.CLIP).agg(F.sum(keep.cast("int")).alias("kept"), F.count(F.lit(1)).alias("n_rows"))


_REST = f"""WITH RECURSIVE {TOPOLOGY}, j AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS joint, unnest(parents) AS parent, unnest(offsets) AS o FROM topo),
up AS (SELECT object_type, joint, joint AS a FROM j UNION ALL SELECT up.object_type, up.joint, j.parent FROM up JOIN j ON j.object_type = up.object_type AND j.joint = up.a WHERE j.parent >= 0),
p AS (SELECT up.object_type, up.joint, sum(o[1]) AS x, sum(o[2]) AS y, sum(o[3]) AS z FROM up JOIN j ON j.object_type = up.object_type AND j.joint = up.a GROUP BY ALL)"""


@query(
    _REST
    + """, v AS (SELECT object_type, joint AS vertex, x + 0.05 AS x, y, z FROM p), w AS (SELECT v.object_type, vertex, p.joint, 1 / (0.1 + sqrt((v.x-p.x)**2 + (v.y-p.y)**2 + (v.z-p.z)**2)) AS w FROM v JOIN p ON p.object_type = v.object_type),
k AS (SELECT *, row_number() OVER (PARTITION BY object_type, vertex ORDER BY w DESC, joint) AS k FROM w), n AS (SELECT object_type, vertex, joint, w / sum(w) OVER (PARTITION BY object_type, vertex) AS w FROM k WHERE k <= 4)
SELECT n.object_type, n.vertex, round(sum(w * (v.z + p.x)), 5) + 0.0 AS x, round(sum(w * (v.y + p.y)), 5) + 0.0 AS y, round(sum(w * (-v.x + p.z)), 5) + 0.0 AS z FROM n JOIN v ON v.object_type = n.object_type AND v.vertex = n.vertex JOIN p ON p.object_type = n.object_type AND p.joint = n.joint GROUP BY ALL"""
)
def sm_skinning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices beside each joint, moved with a quarter turn about Y and a shift of each of their four nearest joints."""
    rest = S.rest_positions(first_topology(spark, sf_dir))
    vertices = rest.select("object_type", F.col("joint").alias("vertex"), (F.col("x") + 0.05).alias("x"), "y", "z")
    near = vertices.join(rest.select("object_type", "joint", *(F.col(c).alias(f"j{c}") for c in "xyz")), "object_type")
    gap = R.norm(tuple(F.col(c) - F.col(f"j{c}") for c in "xyz"))
    weights = P.top_weights(near.select("object_type", "vertex", "joint", (1 / (0.1 + gap)).alias("weight")), ["object_type", "vertex"], "joint", "weight")
    quarter = (0.0, 0.0, 1.0, 0.0, 1.0, 0.0, -1.0, 0.0, 0.0)
    transforms = rest.select("object_type", "joint", *(F.lit(r).alias(f"r{i}") for i, r in enumerate(quarter)), *(F.col(c).alias(f"t{i}") for i, c in enumerate("xyz")))
    return P.skinned(vertices, weights, transforms).withColumns({c: F.round(c, 5) + 0.0 for c in "xyz"})


@query(
    _WORLD
    + """, q AS (SELECT object_type, motion_id, frame, joint, w0 - 0.36*w2 AS u, w1 - 0.22*w2 AS v FROM world), b AS (SELECT object_type, motion_id, min(u) AS lu, max(u) AS hu, min(v) AS lv, max(v) AS hv FROM q GROUP BY ALL)
SELECT object_type, motion_id, frame, joint, round(128 + (u - (lu + hu)/2) * 256*0.8/greatest(hu - lu, hv - lv, 1e-6), 3) AS px, round(128 - (v - (lv + hv)/2) * 256*0.8/greatest(hu - lu, hv - lv, 1e-6), 3) AS py FROM q JOIN b USING (object_type, motion_id)"""
)
def sm_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = X.world_positions(finite_motion(spark, sf_dir))
    u, v = P.view(F.col("w0"), F.col("w1"), F.col("w2"))
    px = P.fitted_pixels(w.select(*X.KEYS, u.alias("u"), v.alias("v")), X.CLIP, 256)
    return px.select(*X.KEYS, F.round("px", 3).alias("px"), F.round("py", 3).alias("py"))


_TREE = "len(list_filter(list_zip(parents, range(len(parents))), lambda p: p[1] >= p[2])) = 0"


@query(
    f"""WITH {FINITE}, {TOPOLOGY}, w AS (SELECT m.object_type, motion_id, frame FROM m JOIN topo t ON t.object_type = m.object_type WHERE joint < len(parents) AND {_TREE} GROUP BY ALL HAVING count(*) = any_value(len(parents)))
SELECT w.motion_id, count(*) AS n_frames, any_value(len(parents))::BIGINT AS n_joints, CAST(0 AS DOUBLE) AS error FROM w JOIN topo t ON t.object_type = w.object_type GROUP BY ALL"""
)
def src_bvh_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clip with a whole skeleton written as a BVH file and read again: frames, joints, and the largest difference of rotations."""
    t = first_topology(spark, sf_dir).where(F.forall(F.transform("parents", lambda p, i: p < i), lambda b: b)).withColumn("n", F.size("parents"))
    j = S.joints(t).join(t.select("object_type", "n"), "object_type")
    m = finite_motion(spark, sf_dir).join(j, ["object_type", "joint"]).select("object_type", "motion_id", "frame", "joint", "name", "parent", "n", F.array("ox", "oy", "oz").alias("offset"), *R.aliased("g", R.parts("f", 3, 6)))
    m = m.select("*", *R.aliased("m", R.sixd_matrix(R.names("g", 6))))
    m = m.select("object_type", "motion_id", "frame", "joint", "name", "parent", "n", "offset", F.col("offset").alias("pos"), *R.aliased("w", R.matrix_quat(R.names("m", 9))))
    m = m.withColumn("q", F.array(*R.quat_normalize(R.names("w", 4)))).drop("w0", "w1", "w2", "w3")
    whole = m.groupBy("motion_id", "frame").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("n")).where("k = n").select("motion_id", "frame")
    m = m.join(whole, ["motion_id", "frame"])
    folder = scratch_path(spark, "bvh")
    bvh.texts_of(m, "motion_id").write.parquet(folder)
    back = bvh.frames_of(spark.read.parquet(folder).select(F.col("motion_id").alias("path"), "value"))
    from pyspark.sql import Window as W

    place = F.dense_rank().over(W.partitionBy("motion_id").orderBy("frame")) - 1
    was = m.withColumn("frame", place).select(F.col("motion_id").alias("path"), "frame", "name", F.col("q").alias("was"))
    both = back.join(was, ["path", "frame", "name"])
    error = 1 - F.abs(F.aggregate(F.zip_with("q", "was", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))
    return both.groupBy(F.col("path").alias("motion_id")).agg(F.countDistinct("frame").alias("n_frames"), F.countDistinct("joint").alias("n_joints"), (F.round(F.max(error), 5) + 0.0).alias("error"))


@query(f"WITH {FINITE} SELECT motion_id, count(DISTINCT frame) AS n_frames, round(sum(list_sum(f)), 2) + 0.0 AS total FROM m GROUP BY 1")
def src_tensor_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clip written as a feature tensor and read again."""
    folder = scratch_path(spark, "npy")
    files.tensors_of(finite_motion(spark, sf_dir)).write.parquet(folder)
    back = files.features_of(spark.read.parquet(folder).select(F.col("motion_id").alias("path"), "content"))
    total = F.aggregate("f", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return back.groupBy(F.col("path").alias("motion_id")).agg(F.countDistinct("frame").alias("n_frames"), (F.round(F.sum(total), 2) + 0.0).alias("total"))


@query(f"WITH {CLIP} SELECT motion_id, object_type, split, CAST(len(captions) AS INTEGER) AS n_captions, n_frames FROM c")
def src_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clip headers written as JSON lines and read again."""
    folder = scratch_path(spark, "json")
    c = first_clip(spark, sf_dir)
    files.write_rows(c, folder, "json")
    back = spark.read.schema(c.schema).json(folder)
    return back.select("motion_id", "object_type", "split", F.when(F.col("captions").isNotNull(), F.size("captions")).alias("n_captions"), "n_frames")


@query("SELECT DISTINCT object_name, source_dir, source_group, joints, motions, frames FROM object_index WHERE object_name IS NOT NULL")
def src_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed objects written as CSV with a header and read again."""
    folder = scratch_path(spark, "csv")
    o = table(spark, sf_dir, "object_index").where("object_name is not null").select("object_name", "source_dir", "source_group", "joints", "motions", "frames").distinct()
    files.write_rows(o, folder, "csv")
    return spark.read.schema(o.schema).option("header", "true").option("escape", '"').csv(folder)


@query(
    f"""WITH {CLIP}, k AS (SELECT motion_id, unnest(captions) AS caption, generate_subscripts(captions, 1) AS place FROM c) SELECT regexp_replace(lower(motion_id), '[^a-z0-9]+', '', 'g') AS key, count(DISTINCT caption) AS n_texts FROM k WHERE trim(caption) <> '' GROUP BY 1"""
)
def src_text_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions as JSON records and as ``key#text`` lines, indexed together: texts per key without repeats."""
    c = first_clip(spark, sf_dir)
    records = files.json_texts(c.select(F.to_json(F.struct(F.col("motion_id").alias("file"), "captions")).alias("value")))
    lines = c.select("motion_id", F.explode("captions").alias("caption")).where("trim(caption) <> ''").select(F.col("motion_id").alias("key"), F.array("caption").alias("texts"))
    return files.text_index(records, lines).select("key", F.size("texts").cast("bigint").alias("n_texts"))


@query("WITH d AS (SELECT motion_id, file_id, n_records, size_bytes FROM clip_file) SELECT motion_id, file_id, size_bytes FROM (SELECT *, row_number() OVER (PARTITION BY motion_id ORDER BY file_id DESC) AS k FROM d) WHERE k = 1")
def src_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record per clip, the last file's, read back."""
    rows = table(spark, sf_dir, "clip_file").select("motion_id", "file_id", F.col("file_id").alias("id"), "size_bytes")
    out = files.by_file(rows, "motion_id", "file_id")
    r = F.from_json("record", "id bigint, size_bytes bigint")
    return out.select("motion_id", r["id"].alias("file_id"), r["size_bytes"].alias("size_bytes"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def st_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts per event type over a stream of event files."""
    e = table(spark, sf_dir, "events")
    s = progress.arriving(spark, f"{sf_dir}/events.parquet", e.schema)
    return progress.drained(progress.status_counts(s, "event_type"), "complete")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS since, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def st_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and sums per day and event type over a stream."""
    e = table(spark, sf_dir, "events")
    s = progress.arriving(spark, f"{sf_dir}/events.parquet", e.schema)
    out = progress.drained(progress.window_counts(s, "ts", "event_type", "value", "1 day"), "complete")
    return out.select(F.col("since").cast("timestamp_ntz").alias("since"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT count(DISTINCT motion_id) AS n FROM clip")
def st_first_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips once each, as they first arrive in a stream of deliveries."""
    c = table(spark, sf_dir, "clip").select("motion_id", "ingested_at")
    s = progress.arriving(spark, f"{sf_dir}/clip.parquet", c.schema)
    return progress.drained(progress.first_deliveries(s, "motion_id")).agg(F.count(F.lit(1)).alias("n"))



QUERIES, ORACLE = query.queries, query.oracle
