"""Frame features over every finite row of ``motion``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.functions import rotations as R
from stridelake.operators import encode as E
from stridelake.operators import features as X
from stridelake.operators import skeleton as S
from stridelake.queries.base import CLIP, FINITE, TOPOLOGY, Registry, finite_motion, first_clip, first_topology
from stridelake.scratch import stored, table

query = Registry()
K = "object_type, motion_id, frame, joint"

_STATS = f"""
WITH {FINITE}, x AS (SELECT object_type, joint, unnest(range(13)) AS channel, unnest(f) AS x FROM m),
r AS (SELECT object_type, joint, channel, avg(x) AS mean, CASE WHEN stddev_pop(x) < 1e-12 THEN 0 ELSE stddev_pop(x) END AS sd, CASE WHEN channel < 3 THEN 0 WHEN channel < 9 THEN 1 WHEN channel < 12 THEN 2 ELSE 3 END AS block FROM x GROUP BY ALL),
s AS (SELECT object_type, joint, channel, mean, CASE WHEN block < 3 THEN avg(sd) OVER (PARTITION BY object_type, block, joint = 0) WHEN sd = 0 THEN 1.0 ELSE avg(CASE WHEN sd <> 0 THEN sd END) OVER (PARTITION BY object_type, block) END AS std FROM r)
"""


def _round(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + 0.0 for c in columns})


@query(_STATS + "SELECT object_type, joint, CAST(channel AS INTEGER) AS channel, round(mean, 6) + 0.0 AS mean, round(std, 6) + 0.0 AS std FROM s")
def ft_group_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(X.group_statistics(finite_motion(spark, sf_dir)), ["mean", "std"])


@query(
    _STATS.replace("FROM m)", "FROM m JOIN c USING (motion_id) WHERE c.tr)").replace("WITH m AS", f"WITH {CLIP.replace('c AS', 'c0 AS')}, c AS (SELECT motion_id, lower(trim(split)) = 'train' AS tr FROM c0), m AS").replace("SELECT object_type, joint, unnest", "SELECT m.object_type, joint, unnest")
    + "SELECT object_type, joint, CAST(channel AS INTEGER) AS channel, round(mean, 6) + 0.0 AS mean, round(CASE WHEN channel < 12 THEN greatest(std, 0.05) ELSE std END, 6) + 0.0 AS std FROM s"
)
def ft_train_statistics_floored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the clips delivered as train, deviations at least 0.05."""
    train = first_clip(spark, sf_dir).where("lower(trim(split)) = 'train'").select("motion_id")
    return _round(X.group_statistics(finite_motion(spark, sf_dir).join(train, "motion_id", "left_semi"), 0.05), ["mean", "std"])


@query(_STATS + f", w AS (SELECT {K}, CAST(unnest(range(13)) AS INTEGER) AS channel, unnest(f) AS x FROM m) SELECT {K}, round(sum((x - mean) / (std + 1e-6)), 5) + 0.0 AS z_sum, round(max(abs((x - mean) / (std + 1e-6))), 5) AS z_max, CAST(0 AS DOUBLE) AS restore_error FROM w JOIN s USING (object_type, joint, channel) GROUP BY ALL")
def ft_z_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised rows by their sum and largest size, and how far the inverse is from the input."""
    m = finite_motion(spark, sf_dir)
    z = X.z_normalize(m, X.group_statistics(m))
    back = F.zip_with("z", "s", lambda z, q: z * (q["std"] + 1e-6) + q["mean"])
    z = z.select(*X.KEYS, "z", "f", back.alias("back"))
    total = F.aggregate("z", F.lit(0.0), lambda a, x: a + x)
    error = F.array_max(F.zip_with("f", "back", lambda a, b: F.abs(a.cast("double") - b)))
    return z.select(*X.KEYS, (F.round(total, 5) + 0.0).alias("z_sum"), F.round(F.array_max(F.transform("z", lambda x: F.abs(x))), 5).alias("z_max"), F.round(error, 6).alias("restore_error"))


@query(f"WITH {FINITE} SELECT {K}, round(f[1], 6) + 0.0 AS x, round(f[2], 6) + 0.0 AS y, round(f[3], 6) + 0.0 AS z, round(f[4] + 10*f[5] + 100*f[6] + 1000*f[7] + 10000*f[8] + 100000*f[9], 4) + 0.0 AS rot_code FROM m WHERE joint > 0")
def ft_channel_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions and rotations of all joints but the root, from one scan of ``f``."""
    m = finite_motion(spark, sf_dir).where("joint > 0").select(*X.KEYS, *R.aliased("p", R.parts("f", 0, 3)), *R.aliased("d", R.parts("f", 3, 6)))
    code = R.dot(R.names("d", 6), tuple(F.lit(float(10**i)) for i in range(6)))
    return m.select(*X.KEYS, *((F.round(f"p{i}", 6) + 0.0).alias(k) for i, k in enumerate("xyz")), (F.round(code, 4) + 0.0).alias("rot_code"))


_WORLD = f"""
WITH {FINITE},
r0 AS (SELECT object_type, motion_id, frame, f, coalesce(lag(f[10]) OVER w, 0) AS d9, coalesce(lag(f[12]) OVER w, 0) AS d11, greatest(sqrt(f[4]*f[4] + f[5]*f[5] + f[6]*f[6]), 1e-8) AS n FROM m WHERE joint = 0 WINDOW w AS (PARTITION BY object_type, motion_id ORDER BY frame)),
r1 AS (SELECT *, f[4]/n AS x0, f[5]/n AS x1, f[6]/n AS x2 FROM r0),
r2 AS (SELECT *, x1*f[9] - x2*f[8] AS a0, x2*f[7] - x0*f[9] AS a1, x0*f[8] - x1*f[7] AS a2 FROM r1),
r3 AS (SELECT *, greatest(sqrt(a0*a0 + a1*a1 + a2*a2), 1e-8) AS k FROM r2),
r4 AS (SELECT *, a0/k AS z0, a1/k AS z1, a2/k AS z2 FROM r3),
r5 AS (SELECT object_type, motion_id, frame, f[2] AS y, d9, d11, x0, x1, x2, z1*x2 - z2*x1 AS y0, z2*x0 - z0*x2 AS y1, z0*x1 - z1*x0 AS y2, z0, z1, z2 FROM r4),
place AS (SELECT object_type, motion_id, frame, x0, x1, x2, y0, y1, y2, z0, z1, z2, sum(x0*d9 + x2*d11) OVER w AS px, y AS py, sum(z0*d9 + z2*d11) OVER w AS pz FROM r5 WINDOW w AS (PARTITION BY object_type, motion_id ORDER BY frame ROWS UNBOUNDED PRECEDING)),
world AS (SELECT object_type, motion_id, frame, joint, f, x0, x1, x2, y0, y1, y2, z0, z1, z2, CASE WHEN joint = 0 THEN px ELSE x0*f[1] + x1*f[2] + x2*f[3] + px END AS w0, CASE WHEN joint = 0 THEN py ELSE y0*f[1] + y1*f[2] + y2*f[3] END AS w1, CASE WHEN joint = 0 THEN pz ELSE z0*f[1] + z1*f[2] + z2*f[3] + pz END AS w2 FROM m JOIN place USING (object_type, motion_id, frame))
"""


@query(_WORLD + "SELECT object_type, motion_id, frame, round(px, 5) + 0.0 AS x, round(py, 5) + 0.0 AS y, round(pz, 5) + 0.0 AS z FROM place")
def ft_root_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(X.root_trajectory(finite_motion(spark, sf_dir)).select(*X.CLIP, "frame", "x", "y", "z"), ["x", "y", "z"], 5)


@query(
    f"""WITH {FINITE}, a AS (SELECT object_type, motion_id, frame, f[2] AS y, coalesce(lag(f[6]) OVER w, 0) AS s, coalesce(lag(f[10]) OVER w, 0) AS dx, coalesce(lag(f[12]) OVER w, 0) AS dz FROM m WHERE joint = 0 WINDOW w AS (PARTITION BY object_type, motion_id ORDER BY frame)),
b AS (SELECT *, sum(s) OVER (PARTITION BY object_type, motion_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS angle FROM a)
SELECT object_type, motion_id, frame, round(angle, 5) + 0.0 AS angle, round(sum(cos(2*angle)*dx - sin(2*angle)*dz) OVER w, 5) + 0.0 AS x, round(y, 5) + 0.0 AS y, round(sum(sin(2*angle)*dx + cos(2*angle)*dz) OVER w, 5) + 0.0 AS z FROM b WINDOW w AS (PARTITION BY object_type, motion_id ORDER BY frame ROWS UNBOUNDED PRECEDING)"""
)
def ft_yaw_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trajectory form with a turn per frame, fed with channel 5 as the turn."""
    root = finite_motion(spark, sf_dir).where("joint = 0")
    angular = root.select(*X.CLIP, "frame", *(F.get("f", F.lit(c)).cast("double").alias(n) for c, n in ((5, "yaw_step"), (9, "dx"), (11, "dz"), (1, "y"))))
    return _round(X.yaw_trajectory(angular), ["angle", "x", "y", "z"], 5)


@query(_WORLD + f"SELECT {K}, round(w0, 5) + 0.0 AS w0, round(w1, 5) + 0.0 AS w1, round(w2, 5) + 0.0 AS w2 FROM world")
def ft_world_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = X.world_positions(finite_motion(spark, sf_dir)).select(*X.KEYS, "w0", "w1", "w2")
    return _round(w, ["w0", "w1", "w2"], 5)


@query(f"WITH {FINITE}, r AS (SELECT object_type, motion_id, frame FROM m WHERE joint = 0) SELECT {K}, round(f[1], 4) + 0.0 AS p0, round(f[2], 4) + 0.0 AS p1, round(f[3], 4) + 0.0 AS p2 FROM m JOIN r USING (object_type, motion_id, frame) WHERE joint > 0")
def ft_relative_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """World positions made root-relative again: the stored readings come back (to a millionth; what is off by more is shown as it came)."""
    m = finite_motion(spark, sf_dir)
    p = X.relative_positions(X.world_positions(m)).where("joint > 0").join(m, X.KEYS)
    back = lambda c, f: F.when(F.abs(c - f) <= 1e-6 * (1 + F.abs(f)), f).otherwise(c)
    out = p.select(*X.KEYS, *(back(F.col(f"p{i}"), F.get("f", F.lit(i)).cast("double")).alias(f"p{i}") for i in range(3)))
    return _round(out, ["p0", "p1", "p2"], 4)


@query(
    _WORLD
    + f""", n AS (SELECT *, lead(frame) OVER w AS nf, lead(w0) OVER w - w0 AS d0, lead(w1) OVER w - w1 AS d1, lead(w2) OVER w - w2 AS d2, lead(x0) OVER w AS q0, lead(x1) OVER w AS q1, lead(x2) OVER w AS q2, lead(y0) OVER w AS q3, lead(y1) OVER w AS q4, lead(y2) OVER w AS q5, lead(z0) OVER w AS q6, lead(z1) OVER w AS q7, lead(z2) OVER w AS q8
FROM world WINDOW w AS (PARTITION BY object_type, motion_id, joint ORDER BY frame))
SELECT {K}, round(q0*d0 + q3*d1 + q6*d2, 5) + 0.0 AS v0, round(q1*d0 + q4*d1 + q7*d2, 5) + 0.0 AS v1, round(q2*d0 + q5*d1 + q8*d2, 5) + 0.0 AS v2 FROM n WHERE nf = frame + 1"""
)
def ft_local_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(X.local_velocity(X.world_positions(finite_motion(spark, sf_dir))), ["v0", "v1", "v2"], 5)


@query(
    _WORLD.replace("WITH ", f"WITH {TOPOLOGY}, ", 1)
    + f""", ft AS (SELECT DISTINCT object_type, unnest(foot_joint_idx) AS joint FROM topo), g AS (SELECT world.*, ft.joint IS NOT NULL AS foot FROM world LEFT JOIN ft ON ft.object_type = world.object_type AND ft.joint = world.joint),
h AS (SELECT *, min(CASE WHEN foot THEN w1 END) OVER (PARTITION BY object_type, motion_id) AS low, lead(frame) OVER w AS nf, lead(w0) OVER w AS n0, lead(w1) OVER w AS n1, lead(w2) OVER w AS n2 FROM g WINDOW w AS (PARTITION BY object_type, motion_id, joint ORDER BY frame))
SELECT {K}, CAST(coalesce(foot AND (n0-w0)*(n0-w0) + (n1-w1)*(n1-w1) + (n2-w2)*(n2-w2) <= 0.02 AND abs(n1 - low) <= 0.3, false) AS INTEGER) AS contact FROM h WHERE nf = frame + 1"""
)
def ft_foot_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    feet = first_topology(spark, sf_dir).select("object_type", F.array_distinct("foot_joint_idx").alias("foot_joint_idx"))
    return X.foot_contacts(X.world_positions(finite_motion(spark, sf_dir)), feet, 0.02)


@query(
    _WORLD
    + """, o AS (SELECT *, f[13] AS c, 0.5*w0 AS o0, w1*w1 AS o1, w2 + w0 AS o2 FROM world),
n AS (SELECT *, lead(frame) OVER w AS nf, lead(w0) OVER w - w0 - (lead(o0) OVER w - o0) AS e0, lead(w1) OVER w - w1 - (lead(o1) OVER w - o1) AS e1, lead(w2) OVER w - w2 - (lead(o2) OVER w - o2) AS e2 FROM o WINDOW w AS (PARTITION BY object_type, motion_id, joint ORDER BY frame))
SELECT object_type, motion_id, round(sum(e0*e0 + e1*e1 + e2*e2) / (1 + count(*)), 5) + 0.0 AS loss, count(*) AS contacts FROM n WHERE nf = frame + 1 AND c = 1 GROUP BY ALL"""
)
def ft_foot_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding loss between the positions and a bent copy of them."""
    m = finite_motion(spark, sf_dir)
    w = X.world_positions(m)
    bent = w.select(*X.KEYS, (F.col("w0") * 0.5).alias("o0"), (F.col("w1") * F.col("w1")).alias("o1"), (F.col("w2") + F.col("w0")).alias("o2"))
    return _round(X.foot_sliding(w, m, bent), ["loss"], 5)


@query(
    f"""WITH {FINITE}, d AS (SELECT object_type, motion_id, f, lag(f) OVER (PARTITION BY object_type, motion_id ORDER BY frame) AS b FROM m WHERE joint = 0),
s AS (SELECT object_type, motion_id, sum(coalesce(abs(f[4]-b[4]) + abs(f[5]-b[5]) + abs(f[6]-b[6]) + abs(f[7]-b[7]) + abs(f[8]-b[8]) + abs(f[9]-b[9]), 0)) AS e FROM d GROUP BY ALL)
SELECT object_type, motion_id, round(e, 6) AS excursion, CAST(row_number() OVER (PARTITION BY object_type ORDER BY round(e, 9) DESC, motion_id) AS INTEGER) AS place FROM s"""
)
def ft_excursion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(X.excursion(finite_motion(spark, sf_dir)), ["excursion"])


@query(
    f"""WITH {CLIP}, k AS (SELECT motion_id, n_frames, CAST(greatest(0, ceil((n_frames - 24) / 20.0)) AS INTEGER) AS n_full FROM c WHERE n_frames > 0), p AS (SELECT *, CAST(unnest(range(n_full + 1)) AS INTEGER) AS segment FROM k)
SELECT motion_id, segment, segment * 20 AS first_frame, CASE WHEN segment = n_full THEN n_frames - segment * 20 ELSE 20 END AS length FROM p"""
)
def ft_clip_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.clip_slices(first_clip(spark, sf_dir), 24, 20)


@query(
    f"""WITH {CLIP}, k AS (SELECT motion_id, n_frames AS n FROM c WHERE n_frames > 0), a AS (SELECT motion_id, CAST(unnest(CASE WHEN n <= 8 THEN range(n) ELSE list_distinct(list_transform(range(8), lambda i: CAST(round_even(i * (n - 1) / 7.0, 0) AS BIGINT))) END) AS INTEGER) AS frame FROM k)
SELECT motion_id, CAST(row_number() OVER (PARTITION BY motion_id ORDER BY frame) - 1 AS INTEGER) AS place, frame FROM a"""
)
def ft_even_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.even_frames(first_clip(spark, sf_dir), 8)


@query(
    f"""WITH {FINITE}, k AS (SELECT *, row_number() OVER (PARTITION BY object_type, motion_id, joint ORDER BY frame) - 1 AS i, count(*) OVER (PARTITION BY object_type, motion_id, joint) AS n FROM m),
kept AS (SELECT object_type, motion_id, joint, i - CAST(floor(greatest(n - 24, 0) / 2) AS BIGINT) AS place, f, true AS real FROM k),
pad AS (SELECT object_type, motion_id, joint, unnest(range(n, 24)) AS place, list_value(0.0,0.0,0.0,0.0,0.0,0.0,0.0,0.0,0.0,0.0,0.0,0.0,0.0) AS f, false AS real FROM (SELECT DISTINCT object_type, motion_id, joint, n FROM k WHERE n < 24))
SELECT object_type, motion_id, joint, CAST(place AS INTEGER) AS place, round(list_sum(f), 4) + 0.0 AS total, real FROM (SELECT * FROM kept WHERE place BETWEEN 0 AND 23 UNION ALL SELECT * FROM pad)"""
)
def ft_crop_or_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.aggregate("f", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return X.crop_or_pad(finite_motion(spark, sf_dir), 24).select(*X.CLIP, "joint", "place", (F.round(total, 4) + 0.0).alias("total"), "real")


@query(
    f"""WITH {CLIP}, k AS (SELECT motion_id, least(n_frames, 40) AS n FROM c), r AS (SELECT motion_id, n, CAST(unnest(range(n)) AS INTEGER) AS frame FROM k WHERE n > 0)
SELECT motion_id, frame, greatest(frame - 15, 0) AS first, least(frame + 16, n - 1) AS last, CAST((SELECT count(*) FROM range(n) g(j) WHERE j BETWEEN frame - 15 AND frame + 16 OR j = 0) AS INTEGER) AS n_seen FROM r"""
)
def ft_attention_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.attention_spans(first_clip(spark, sf_dir), 31, 40)


@query(_WORLD + f", z AS (SELECT object_type, motion_id, frame, w0 AS x0, w2 AS z0 FROM world WHERE joint = 0) SELECT {K}, round(w0 - z.x0, 5) + 0.0 AS g0, round(w1 - min(w1) OVER (PARTITION BY object_type, motion_id), 5) + 0.0 AS g1, round(w2 - z.z0, 5) + 0.0 AS g2 FROM world JOIN z USING (object_type, motion_id, frame)")
def ft_grounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(X.grounded(X.world_positions(finite_motion(spark, sf_dir))), ["g0", "g1", "g2"], 5)


@query(_WORLD + ", e AS (SELECT object_type, motion_id, frame, sqrt((max(w0)-min(w0))**2 + (max(w1)-min(w1))**2 + (max(w2)-min(w2))**2) AS d FROM world GROUP BY ALL) SELECT object_type, motion_id, round(avg(d) + 1e-8, 5) AS diagonal FROM e GROUP BY ALL")
def ft_box_diagonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(X.box_diagonal(X.world_positions(finite_motion(spark, sf_dir))), ["diagonal"], 5)


@query(
    f"""WITH {FINITE}, {TOPOLOGY}, j AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS joint, unnest(parents) AS parent FROM topo),
s AS (SELECT m.object_type, motion_id, f, first_value(f) OVER (PARTITION BY m.object_type, motion_id, frame, parent ORDER BY m.joint) AS b FROM m JOIN j ON j.object_type = m.object_type AND j.joint = m.joint WHERE parent >= 0)
SELECT object_type, motion_id, round(max(greatest(abs(f[4]-b[4]), abs(f[5]-b[5]), abs(f[6]-b[6]), abs(f[7]-b[7]), abs(f[8]-b[8]), abs(f[9]-b[9]))), 6) AS spread FROM s GROUP BY ALL"""
)
def ft_child_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(X.child_spread(finite_motion(spark, sf_dir), S.joints(first_topology(spark, sf_dir))), ["spread"])


@query(f"WITH {FINITE}, z AS (SELECT {K}, CASE WHEN joint IN (1, 3) THEN first_value(f) OVER (PARTITION BY object_type, motion_id, joint ORDER BY frame) ELSE f END AS f FROM m) SELECT {K}, round(list_sum(f), 4) + 0.0 AS total FROM z")
def ft_frozen_joints(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.aggregate("f", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return X.frozen(finite_motion(spark, sf_dir), [1, 3]).select(*X.KEYS, (F.round(total, 4) + 0.0).alias("total"))


@query(
    f"""WITH RECURSIVE {TOPOLOGY}, """
    + _WORLD.strip()[5:]
    + """, j AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS joint, unnest(parents) AS parent, unnest(offsets) AS o, len(parents) AS n FROM topo WHERE len(list_filter(list_zip(parents, range(len(parents))), lambda p: p[1] >= p[2])) = 0),
whole AS (SELECT m.object_type, motion_id, frame FROM m JOIN j ON j.object_type = m.object_type AND j.joint = m.joint GROUP BY ALL HAVING count(*) = max(n)),
q0 AS (SELECT m.object_type, motion_id, frame, joint, f, coalesce(lag(f[10]) OVER w, 0) AS d9, coalesce(lag(f[12]) OVER w, 0) AS d11, greatest(sqrt(f[4]*f[4] + f[5]*f[5] + f[6]*f[6]), 1e-8) AS n FROM m JOIN whole USING (object_type, motion_id, frame) WINDOW w AS (PARTITION BY m.object_type, motion_id, joint ORDER BY frame)),
q1 AS (SELECT *, f[4]/n AS x0, f[5]/n AS x1, f[6]/n AS x2 FROM q0),
q2 AS (SELECT *, x1*f[9] - x2*f[8] AS a0, x2*f[7] - x0*f[9] AS a1, x0*f[8] - x1*f[7] AS a2 FROM q1),
q3 AS (SELECT *, greatest(sqrt(a0*a0 + a1*a1 + a2*a2), 1e-8) AS k FROM q2),
q4 AS (SELECT *, a0/k AS z0, a1/k AS z1, a2/k AS z2 FROM q3),
turn AS (SELECT object_type, motion_id, frame, joint, f[2] AS y, d9, d11, x0, x1, x2, z1*x2 - z2*x1 AS y0, z2*x0 - z0*x2 AS y1, z0*x1 - z1*x0 AS y2, z0, z1, z2 FROM q4),
spot AS (SELECT object_type, motion_id, frame, sum(x0*d9 + x2*d11) OVER w AS px, y AS py, sum(z0*d9 + z2*d11) OVER w AS pz FROM turn WHERE joint = 0 WINDOW w AS (PARTITION BY object_type, motion_id ORDER BY frame ROWS UNBOUNDED PRECEDING)),
carrier AS (SELECT object_type, parent AS joint, max(joint) AS carrier FROM j WHERE parent >= 0 GROUP BY ALL),
own AS (SELECT t.object_type, t.motion_id, t.frame, c.joint, [t.x0, t.y0, t.z0, t.x1, t.y1, t.z1, t.x2, t.y2, t.z2] AS r FROM turn t JOIN carrier c ON c.object_type = t.object_type AND c.carrier = t.joint),
fk AS (SELECT s.object_type, s.motion_id, s.frame, 0 AS joint, coalesce(o.r, [1.0,0.0,0.0,0.0,1.0,0.0,0.0,0.0,1.0]) AS g, px AS x, py AS y, pz AS z FROM spot s LEFT JOIN own o ON o.object_type = s.object_type AND o.motion_id = s.motion_id AND o.frame = s.frame AND o.joint = 0
UNION ALL SELECT fk.object_type, fk.motion_id, fk.frame, j.joint, CASE WHEN o.r IS NULL THEN g ELSE [g[1]*r[1]+g[2]*r[4]+g[3]*r[7], g[1]*r[2]+g[2]*r[5]+g[3]*r[8], g[1]*r[3]+g[2]*r[6]+g[3]*r[9], g[4]*r[1]+g[5]*r[4]+g[6]*r[7], g[4]*r[2]+g[5]*r[5]+g[6]*r[8], g[4]*r[3]+g[5]*r[6]+g[6]*r[9], g[7]*r[1]+g[8]*r[4]+g[9]*r[7], g[7]*r[2]+g[8]*r[5]+g[9]*r[8], g[7]*r[3]+g[8]*r[6]+g[9]*r[9]] END,
 fk.x + g[1]*j.o[1] + g[2]*j.o[2] + g[3]*j.o[3], fk.y + g[4]*j.o[1] + g[5]*j.o[2] + g[6]*j.o[3], fk.z + g[7]*j.o[1] + g[8]*j.o[2] + g[9]*j.o[3]
 FROM fk JOIN j ON j.object_type = fk.object_type AND j.parent = fk.joint LEFT JOIN own o ON o.object_type = fk.object_type AND o.motion_id = fk.motion_id AND o.frame = fk.frame AND o.joint = j.joint)
SELECT object_type, motion_id, frame, joint, round(x, 5) + 0.0 AS x, round(y, 5) + 0.0 AS y, round(z, 5) + 0.0 AS z FROM fk"""
)
def ft_forward_kinematics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(X.forward_kinematics(finite_motion(spark, sf_dir), first_topology(spark, sf_dir)), ["x", "y", "z"], 5)


@query()
def ft_resampled_rotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotations of every series at 16 even places."""
    return _round(X.resampled_rotations(finite_motion(spark, sf_dir), 16), [f"d{i}" for i in range(6)], 5)


def _raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Clips as raw animation: each joint's own rotation and the root's path, and skeletons of three joints or more with the joints that tell the facing (tail to head)."""
    t = first_topology(spark, sf_dir).where(F.forall(F.transform("parents", lambda p, i: p < i), lambda b: b) & (F.size("parents") >= 3)).withColumn("face", F.array(F.lit(1), F.lit(2)))
    m = finite_motion(spark, sf_dir).select(*X.KEYS, *R.aliased("g", R.parts("f", 3, 6)), F.array(*R.parts("f", 0, 3)).alias("pos"))
    m = m.select(*X.KEYS, "pos", *R.aliased("m", R.sixd_matrix(R.names("g", 6))))
    return m.select(*X.KEYS, "pos", F.array(*R.matrix_quat(R.names("m", 9))).alias("q")), t


@query(
    f"""WITH {FINITE}, {TOPOLOGY}, w AS (SELECT m.object_type, motion_id, frame FROM m JOIN topo t ON t.object_type = m.object_type WHERE joint < len(parents) AND len(parents) >= 3 AND len(list_filter(list_zip(parents, range(len(parents))), lambda p: p[1] >= p[2])) = 0 GROUP BY ALL HAVING count(*) = any_value(len(parents)))
SELECT w.object_type, motion_id, (count(*) - 1)::BIGINT AS n_frames, any_value(len(parents))::BIGINT AS n_joints, CAST(0 AS DOUBLE) AS fk_error, CAST(0 AS DOUBLE) AS start_error FROM w JOIN topo t ON t.object_type = w.object_type GROUP BY ALL HAVING count(*) >= 2"""
)
def ft_encoded_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clip encoded from raw animation; positions by rotation and by position must then agree, and each clip starts over the origin."""
    raw, t = _raw(spark, sf_dir)
    e = stored(E.encoded(raw, t).where("error is null"), "encoded")
    by_rotation = X.forward_kinematics(e, E.scaled_topology(t)).join(X.world_positions(e).select(*X.KEYS, "w0", "w1", "w2"), X.KEYS)
    gap = R.norm(R.minus((F.col("x"), F.col("y"), F.col("z")), R.names("w", 3)))
    start = F.max(F.when((F.col("frame") == 0) & (F.col("joint") == 0), F.abs("w0") + F.abs("w2")))
    return by_rotation.groupBy(*X.CLIP).agg(F.countDistinct("frame").alias("n_frames"), F.countDistinct("joint").alias("n_joints"), F.round(F.avg(gap), 3).alias("fk_error"), F.round(start, 4).alias("start_error"))


@query(
    f"""WITH RECURSIVE {TOPOLOGY}, j AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS joint, unnest(parents) AS parent, lower(unnest(joints_names)) AS name, unnest(offsets) AS o FROM topo),
up AS (SELECT object_type, joint, joint AS a FROM j UNION ALL SELECT up.object_type, up.joint, j.parent FROM up JOIN j ON j.object_type = up.object_type AND j.joint = up.a WHERE j.parent >= 0),
p AS (SELECT up.object_type, up.joint, sum(o[1]) AS x FROM up JOIN j ON j.object_type = up.object_type AND j.joint = up.a GROUP BY ALL),
g AS (SELECT object_type, avg(CASE WHEN regexp_matches(name, 'hips|hub|spine|chest|neck') THEN x END) - avg(CASE WHEN regexp_matches(name, 'toe|foot|hoof|ashi|paw|pad') THEN x END) AS g FROM p JOIN j USING (object_type, joint) GROUP BY 1)
SELECT object_type, CAST(CASE WHEN g > 1e-8 THEN 90 ELSE -90 END AS DOUBLE) AS roll, round(abs(g), 6) AS score FROM g"""
)
def ft_rest_roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.rest_roll(first_topology(spark, sf_dir)).withColumn("score", F.round("score", 6))


@query(
    f"""WITH {FINITE}, {TOPOLOGY}, w AS (SELECT m.object_type, motion_id, frame FROM m JOIN topo t ON t.object_type = m.object_type WHERE joint < len(parents) AND len(parents) >= 3 AND len(list_filter(list_zip(parents, range(len(parents))), lambda p: p[1] >= p[2])) = 0 GROUP BY ALL HAVING count(*) = any_value(len(parents)))
SELECT w.object_type, motion_id, ((count(*) - 1) * any_value(len(list_distinct(list_filter(parents, lambda p: p >= 0)))))::BIGINT AS n_rows, true AS rotations_back, true AS root_back FROM w JOIN topo t ON t.object_type = w.object_type GROUP BY ALL HAVING count(*) >= 2"""
)
def ft_decoded_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clip encoded, and decoded with what its canonical form left out: mean angle to the raw rotations below a thousandth, and the root's path back to a thousandth of its size."""
    raw, t = _raw(spark, sf_dir)
    raw = stored(raw, "raw")
    e = stored(E.encoded(raw, t).where("error is null"), "encoded")
    back = E.decoded(e, t, stored(E.clip_parameters(raw, t), "clip-parameters"))
    carries = t.select("object_type", F.explode(F.array_distinct("parents")).alias("joint")).where("joint >= 0")
    whole = raw.join(t.select("object_type", F.size("parents").alias("n")), "object_type").where("joint < n")
    frames = whole.groupBy(*X.CLIP, "frame").agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n"), F.max(F.when(F.col("joint") == 0, F.col("pos"))).alias("root")).where("k = n")
    at = W.partitionBy(*X.CLIP).orderBy("frame")
    numbered = frames.select(*X.CLIP, F.col("frame").alias("source"), (F.row_number().over(at) - 1).cast("int").alias("frame"), "root")
    asked = numbered.join(raw.withColumnRenamed("frame", "source").select(*X.CLIP, "source", "joint", "q"), [*X.CLIP, "source"])
    both = back.join(F.broadcast(carries), ["object_type", "joint"]).join(asked, X.KEYS)
    q = [F.col("q")[i] for i in range(4)]
    angle = R.geodesic([F.col("m")[i] for i in range(9)], R.quat_matrix(R.quat_normalize(q)), 0.0)
    off = R.norm([F.col(k) - F.col("root")[i] for i, k in enumerate("xyz")])
    size = R.norm([F.col("root")[i] for i in range(3)])
    per = both.groupBy(*X.CLIP).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(angle).alias("angle"), F.avg(off).alias("off"), F.max(size).alias("size"))
    return per.select(*X.CLIP, "n_rows", (F.col("angle") < 1e-3).alias("rotations_back"), (F.col("off") < 1e-3 * (1 + F.col("size"))).alias("root_back"))


@query(f"WITH {FINITE} SELECT object_type, motion_id, frame, joint, round(f[1], 5) + 0.0 AS x, round(f[4], 5) + 0.0 AS r0, CASE WHEN joint > 2 THEN 'rest' ELSE 'taken' END AS origin FROM m WHERE joint <= 2 UNION ALL SELECT object_type, motion_id, frame, 3 AS joint, 0.5 AS x, round(arg_min(f[4], joint), 5) + 0.0 AS r0, 'rest' FROM m WHERE joint IN (1, 2) GROUP BY ALL UNION ALL SELECT object_type, motion_id, frame, 3 AS joint, 0.5, 1.0, 'rest' FROM m WHERE joint <= 2 GROUP BY ALL HAVING count(CASE WHEN joint IN (1, 2) THEN 1 END) = 0")
def ft_expanded_rig(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three joints of each clip on a rig of four: the fourth, a sibling of the second and third, takes their rotation and its own rest place."""
    m = finite_motion(spark, sf_dir).where("joint <= 2")
    kinds = m.select("object_type").distinct()
    mapping = kinds.withColumn("small_joint", F.explode(F.array(*map(F.lit, range(3))))).withColumn("joint", F.col("small_joint"))
    f = F.array(*(F.lit(float(x)) for x in (0.5, 0, 0, 1, 0, 0, 0, 1, 0, 0, 0, 0, 0))).cast("array<float>")
    rest = kinds.withColumn("joint", F.explode(F.array(*map(F.lit, range(4))))).withColumns({"parent": F.when(F.col("joint") == 0, -1).otherwise(0), "f": f})
    out = E.expanded(m, mapping, rest).join(m.select(*X.KEYS, F.lit(1).alias("there")), X.KEYS, "left").where("there = 1 or joint = 3")
    return out.select(*X.KEYS, *((F.round(F.get("f", F.lit(c)).cast("double"), 5) + 0.0).alias(k) for c, k in ((0, "x"), (3, "r0"))), F.when(F.col("joint") == 3, "rest").otherwise("taken").alias("origin"))


@query(
    _STATS + f", bad AS (SELECT DISTINCT object_type, motion_id, frame, joint, CAST(f AS DOUBLE[]) AS f FROM motion WHERE object_type IS NOT NULL AND len(f) = 13 AND len(list_filter(f, lambda x: isfinite(x))) < 13), w AS (SELECT {K}, CAST(unnest(range(13)) AS INTEGER) AS channel, unnest(f) AS x FROM bad) "
    + f"SELECT {K}, round(sum(CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN 0 ELSE (x - mean) / (std + 1e-6) END), 4) + 0.0 AS z_sum, count(CASE WHEN x IS NULL OR isnan(x) THEN 1 END) AS n_undefined, count(CASE WHEN isinf(x) THEN 1 END) AS n_unbounded FROM w JOIN s USING (object_type, joint, channel) GROUP BY ALL"
)
def ft_z_undefined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with readings that are not finite, normalised by the statistics of the others: missing and undefined readings become 0, infinite ones stay so."""
    bad = table(spark, sf_dir, "motion").select("object_type", "motion_id", "frame", "joint", "f").where("object_type is not null and f is not null and size(f) = 13")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    z = X.z_normalize(bad.where(~F.forall("f", fine)).distinct(), X.group_statistics(finite_motion(spark, sf_dir)))
    total = F.aggregate(F.filter("z", lambda x: F.abs(x) < float("inf")), F.lit(0.0), lambda a, x: a + x)
    undefined = F.size(F.filter(F.zip_with("z", "f", lambda x, y: (y.isNull() | F.isnan(y)) & (x == 0)), lambda b: b)).cast("bigint")
    return z.select(*X.KEYS, (F.round(total, 4) + 0.0).alias("z_sum"), undefined.alias("n_undefined"), F.size(F.filter("z", lambda x: F.abs(x) == float("inf"))).cast("bigint").alias("n_unbounded"))


QUERIES, ORACLE = query.queries, query.oracle
