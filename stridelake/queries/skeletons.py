"""Skeleton operators over the first version of every skeleton in ``topology``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.operators import skeleton as S
from stridelake.queries.base import TOPOLOGY, Registry, first_topology

query = Registry()

_JOINTS = f"""
WITH RECURSIVE {TOPOLOGY},
j AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS joint, unnest(parents) AS parent, unnest(joints_names) AS name, unnest(offsets) AS o FROM topo),
up AS (SELECT object_type, joint, joint AS ancestor, 0 AS hops FROM j UNION ALL SELECT up.object_type, up.joint, j.parent, up.hops + 1 FROM up JOIN j ON j.object_type = up.object_type AND j.joint = up.ancestor WHERE j.parent >= 0)
"""


@query(_JOINTS + "SELECT object_type, joint, ancestor, hops FROM up")
def sk_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.closure(first_topology(spark, sf_dir))


@query(
    _JOINTS
    + """, h AS (SELECT a.object_type, a.joint AS i, b.joint AS j, min(a.hops + b.hops) AS hops FROM up a JOIN up b ON a.object_type = b.object_type AND a.ancestor = b.ancestor GROUP BY ALL)
SELECT h.object_type, h.i, h.j, CAST(CASE WHEN h.i = h.j THEN CASE WHEN EXISTS (SELECT 1 FROM j k WHERE k.object_type = h.object_type AND k.parent = h.i) THEN 0 ELSE 5 END
 WHEN b.parent = h.i THEN 2 WHEN a.parent = h.j THEN 1 WHEN a.parent = b.parent THEN 3 ELSE 4 END AS INTEGER) AS relation, CAST(least(h.hops, 5) AS INTEGER) AS hops
FROM h JOIN j a ON a.object_type = h.object_type AND a.joint = h.i JOIN j b ON b.object_type = h.object_type AND b.joint = h.j"""
)
def sk_edge_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.edge_relations(first_topology(spark, sf_dir))


@query(
    _JOINTS
    + """SELECT j.object_type, j.joint, coalesce((SELECT string_agg(joint, ',' ORDER BY joint) FROM up WHERE up.object_type = j.object_type AND up.ancestor = j.joint AND hops = 1), '') AS children,
coalesce((SELECT string_agg(joint, ',' ORDER BY joint) FROM up WHERE up.object_type = j.object_type AND up.ancestor = j.joint AND hops > 0), '') AS descendants,
coalesce((SELECT string_agg(ancestor, ',' ORDER BY ancestor) FROM up WHERE up.object_type = j.object_type AND up.joint = j.joint AND hops > 0), '') AS ancestors FROM j"""
)
def sk_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.family(first_topology(spark, sf_dir)).select("object_type", "joint", *(F.array_join(c, ",").alias(c) for c in ("children", "descendants", "ancestors")))


@query(_JOINTS + "SELECT object_type, joint AS end_joint, string_agg(ancestor, ',' ORDER BY hops DESC) AS chain FROM up WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.object_type = up.object_type AND j.parent = up.joint) GROUP BY ALL")
def sk_root_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.root_chains(first_topology(spark, sf_dir)).select("object_type", "end_joint", F.array_join("chain", ",").alias("chain"))


@query(
    _JOINTS
    + """, k AS (SELECT object_type, parent, max(joint) AS main FROM j WHERE parent >= 0 GROUP BY ALL),
st AS (SELECT object_type, joint AS beg, joint AS first FROM j WHERE parent = -1 UNION ALL SELECT j.object_type, j.parent, j.joint FROM j JOIN k ON k.object_type = j.object_type AND k.parent = j.parent WHERE j.joint <> k.main),
w AS (SELECT object_type, beg, first, first AS node, 1 AS n FROM st UNION ALL SELECT w.object_type, w.beg, w.first, k.main, n + 1 FROM w JOIN k ON k.object_type = w.object_type AND k.parent = w.node)
SELECT object_type, CASE WHEN beg = first THEN '' ELSE beg || ',' END || string_agg(node, ',' ORDER BY n) AS chain FROM w GROUP BY object_type, beg, first"""
)
def sk_kinematic_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.kinematic_chains(first_topology(spark, sf_dir)).select("object_type", F.array_join("chain", ",").alias("chain"))


@query(
    _JOINTS
    + """, p AS (SELECT object_type, joint, max(hops) AS level, string_agg(lpad(CAST(ancestor AS VARCHAR), 4, '0'), '.' ORDER BY hops DESC) AS path FROM up GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY object_type ORDER BY level, path) - 1 AS INTEGER) AS new_joint FROM p)
SELECT r.object_type, r.joint, r.new_joint, r.level, coalesce(q.new_joint, -1) AS new_parent FROM r JOIN j USING (object_type, joint) LEFT JOIN r q ON q.object_type = r.object_type AND q.joint = j.parent"""
)
def sk_level_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.level_order(first_topology(spark, sf_dir))


_REST = "SELECT up.object_type, up.joint, sum(o[1]) AS x, sum(o[2]) AS y, sum(o[3]) AS z FROM up JOIN j ON j.object_type = up.object_type AND j.joint = up.ancestor GROUP BY ALL"


@query(_JOINTS + f"SELECT object_type, joint, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(z, 6) + 0.0 AS z FROM ({_REST})")
def sk_rest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.rest_positions(first_topology(spark, sf_dir)).select("object_type", "joint", *((F.round(c, 6) + 0.0).alias(c) for c in "xyz"))


@query(_JOINTS + "SELECT object_type, joint, round(o[1], 6) + 0.0 AS ox, round(o[2], 6) + 0.0 AS oy, round(o[3], 6) + 0.0 AS oz FROM j")
def sk_offsets_from_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = first_topology(spark, sf_dir)
    return S.offsets_of(S.rest_positions(t), t).select("object_type", "joint", *((F.round(c, 6) + 0.0).alias(c) for c in ("ox", "oy", "oz")))


@query(_JOINTS + "SELECT object_type, joint, parent, round(sqrt(o[1]*o[1] + o[2]*o[2] + o[3]*o[3]), 6) AS length FROM j WHERE parent >= 0")
def sk_bone_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.bone_lengths(first_topology(spark, sf_dir)).withColumn("length", F.round("length", 6))


@query(
    _JOINTS
    + """, b AS (SELECT object_type, joint, sqrt(o[1]*o[1] + o[2]*o[2] + o[3]*o[3]) AS length FROM j WHERE parent >= 0)
SELECT b.object_type, count(*) AS n_bones, round(0.2092142857142857 / avg(length), 6) AS factor FROM b JOIN topo t ON t.object_type = b.object_type
WHERE length > 1e-8 AND (t.scale_ref_joint_idx IS NULL OR len(t.scale_ref_joint_idx) = 0 OR list_contains(t.scale_ref_joint_idx, joint)) GROUP BY b.object_type"""
)
def sk_scale_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scale_factors(first_topology(spark, sf_dir), 0.2092142857142857).withColumn("factor", F.round("factor", 6))


@query(
    _JOINTS
    + """, b AS (SELECT object_type, joint, sqrt(o[1]*o[1] + o[2]*o[2] + o[3]*o[3]) AS length FROM j WHERE parent >= 0),
c AS (SELECT u.object_type, u.joint, u.ancestor, coalesce((SELECT sum(length) FROM up v JOIN b ON b.object_type = v.object_type AND b.joint = v.ancestor WHERE v.object_type = u.object_type AND v.joint = u.joint AND v.hops < u.hops), 0) AS up FROM up u)
SELECT a.object_type, a.joint AS i, d.joint AS j, round(min(a.up + d.up), 6) AS length FROM c a JOIN c d ON a.object_type = d.object_type AND a.ancestor = d.ancestor AND a.joint < d.joint GROUP BY ALL"""
)
def sk_tree_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.tree_distances(first_topology(spark, sf_dir)).withColumn("length", F.round("length", 6))


@query(
    _JOINTS
    + """, gone AS (SELECT DISTINCT up.object_type, up.joint FROM up JOIN j ON j.object_type = up.object_type AND j.joint = up.ancestor WHERE j.name LIKE 'neck%' OR j.name LIKE 'fore%'),
l AS (SELECT *, CAST(row_number() OVER (PARTITION BY object_type ORDER BY joint) - 1 AS INTEGER) AS new_joint FROM j WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.object_type = j.object_type AND g.joint = j.joint))
SELECT l.object_type, l.joint, l.name, l.new_joint, coalesce(p.new_joint, -1) AS new_parent FROM l LEFT JOIN l p ON p.object_type = l.object_type AND p.joint = l.parent"""
)
def sk_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skeletons without neck and foreleg branches."""
    return S.prune(first_topology(spark, sf_dir), F.col("name").rlike("^(neck|fore)"))


@query(_JOINTS + "SELECT object_type, parent AS node, joint AS edge, CAST(1 AS INTEGER) AS sign FROM j WHERE parent >= 0 UNION ALL SELECT object_type, joint, joint, CAST(-1 AS INTEGER) FROM j WHERE parent >= 0")
def sk_incidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidence of joints and bones: 1 where a bone begins, -1 where it ends."""
    edges = S.joints(first_topology(spark, sf_dir)).where("parent >= 0")
    both = F.array(F.struct(F.col("parent").alias("node"), F.lit(1).alias("sign")), F.struct(F.col("joint").alias("node"), F.lit(-1).alias("sign")))
    return edges.select("object_type", F.col("joint").alias("edge"), F.explode(both).alias("e")).select("object_type", "e.node", "edge", "e.sign")


@query(
    f"""WITH RECURSIVE {TOPOLOGY}, j AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS joint, unnest(parents) AS parent FROM topo),
r AS (SELECT object_type, joint FROM j WHERE joint = 0 UNION ALL SELECT j.object_type, j.joint FROM r JOIN j ON j.object_type = r.object_type AND j.parent = r.joint),
n AS (SELECT object_type, count(DISTINCT joint) AS reached FROM r GROUP BY ALL)
SELECT object_type, array_to_string(list_filter([CASE WHEN len(list_filter(parents, lambda x: x = -1)) <> 1 THEN 'no single root' END, CASE WHEN parents[1] <> -1 THEN 'root not first' END,
CASE WHEN len(list_filter(parents, lambda x: x < -1 OR x >= len(parents))) > 0 THEN 'parent out of range' END, CASE WHEN EXISTS (SELECT 1 FROM j WHERE j.object_type = topo.object_type AND j.parent = j.joint) THEN 'own parent' END,
CASE WHEN EXISTS (SELECT 1 FROM j WHERE j.object_type = topo.object_type AND j.parent > j.joint) THEN 'parent after joint' END, CASE WHEN coalesce(reached, 0) <> len(parents) THEN 'not connected' END, CASE WHEN n_joints <> len(parents) THEN 'joint count' END,
CASE WHEN len(offsets) <> len(parents) OR len(list_filter(offsets, lambda o: len(o) <> 3)) > 0 THEN 'offsets shape' END, CASE WHEN len(joints_names) <> len(parents) OR len(list_distinct(joints_names)) <> len(parents) THEN 'names' END,
CASE WHEN foot_joint_idx IS NOT NULL AND (len(list_filter(foot_joint_idx, lambda x: x IS NULL OR x < 0 OR x >= len(parents))) > 0 OR len(list_distinct(foot_joint_idx)) < len(foot_joint_idx)) THEN 'feet' END,
CASE WHEN scale_ref_joint_idx IS NOT NULL AND (len(list_filter(scale_ref_joint_idx, lambda x: x IS NULL OR x < 0 OR x >= len(parents))) > 0 OR len(list_distinct(scale_ref_joint_idx)) < len(scale_ref_joint_idx)) THEN 'scale joints' END], lambda x: x IS NOT NULL), ';') AS issues
FROM topo LEFT JOIN n USING (object_type)"""
)
def sk_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.validate(first_topology(spark, sf_dir)).select("object_type", F.array_join("issues", ";").alias("issues"))


@query(
    _JOINTS + f""", p AS ({_REST}), e AS (SELECT object_type, least(joint, parent) AS i, greatest(joint, parent) AS j, 'bone' AS kind FROM j WHERE parent >= 0 UNION ALL SELECT a.object_type, a.joint, b.joint, 'sibling' FROM j a JOIN j b ON a.object_type = b.object_type AND a.parent = b.parent AND a.joint < b.joint WHERE a.parent >= 0)
SELECT e.object_type, e.i, e.j, kind, round(sqrt((a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2), 6) AS length FROM e JOIN p a ON a.object_type = e.object_type AND a.joint = e.i JOIN p b ON b.object_type = e.object_type AND b.joint = e.j"""
)
def sk_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.constraints(first_topology(spark, sf_dir)).withColumn("length", F.round("length", 6))


@query(
    _JOINTS + """, n AS (SELECT object_type, joint FROM j WHERE regexp_matches(lower(name), 'pad|tip')), b AS (SELECT DISTINCT up.object_type, up.joint FROM up JOIN n ON n.object_type = up.object_type AND n.joint = up.ancestor)
SELECT object_type, joint, true AS named FROM b UNION ALL SELECT object_type, joint, false FROM j WHERE object_type NOT IN (SELECT object_type FROM n)"""
)
def sk_feet_with_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.feet_with_below(first_topology(spark, sf_dir), "pad|tip")


QUERIES, ORACLE = query.queries, query.oracle
