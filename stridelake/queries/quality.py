"""Quality gates and summaries over clips, motion and skeletons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.operators import features as X
from stridelake.operators import quality as Q
from stridelake.queries.base import CLIP, FINITE, TOPOLOGY, Registry, finite_motion, first_clip, first_topology
from stridelake.queries.features import _WORLD
from stridelake.queries.features import ORACLE as FEATURE_SQL
from stridelake.queries.skeletons import ORACLE as SKELETON_SQL
from stridelake.scratch import table

query = Registry()

_ROWS = "r AS (SELECT DISTINCT object_type, motion_id, frame, joint, f FROM motion WHERE object_type IS NOT NULL AND f IS NOT NULL)"


def _motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "motion").where("object_type is not null and f is not null").select("object_type", "motion_id", "frame", "joint", "f").distinct()


_SCAN = f"""{_ROWS}, v AS (SELECT object_type, motion_id, frame, len(list_filter(f, lambda x: NOT isfinite(x))) AS odd, list_max(list_transform(list_filter(f, lambda x: isfinite(x)), lambda x: abs(CAST(x AS DOUBLE)))) AS top FROM r),
sc AS (SELECT object_type, motion_id, count(*) AS n_rows, count(DISTINCT frame) AS n_frames, CAST(sum(odd) AS BIGINT) AS nonfinite, max(top) AS max_abs FROM v GROUP BY ALL),
scan AS (SELECT *, array_to_string(list_filter([CASE WHEN nonfinite > 0 THEN 'nonfinite' END, CASE WHEN max_abs IS NULL OR max_abs > 22.53 THEN 'abs_gt_22.53' END], lambda x: x IS NOT NULL), ';') AS reasons FROM sc)"""


@query(f"WITH {_SCAN} SELECT object_type, motion_id, n_rows, n_frames, nonfinite, round(max_abs, 5) AS max_abs, reasons FROM scan")
def qa_value_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.value_scan(_motion(spark, sf_dir), 22.53).select("object_type", "motion_id", "n_rows", "n_frames", "nonfinite", F.round("max_abs", 5).alias("max_abs"), F.array_join("reasons", ";").alias("reasons"))


@query(f"WITH {_SCAN}, {CLIP} SELECT c.motion_id, c.object_type, c.n_frames FROM c WHERE motion_id NOT IN (SELECT motion_id FROM scan WHERE reasons <> '')")
def qa_quarantine_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = Q.value_scan(_motion(spark, sf_dir), 22.53).where(F.size("reasons") > 0)
    return Q.quarantine(first_clip(spark, sf_dir), bad).select("motion_id", "object_type", "n_frames")


@query(f"WITH {_SCAN} SELECT file_id, motion_id, path FROM clip_file WHERE motion_id NOT IN (SELECT motion_id FROM scan WHERE reasons <> '')")
def qa_quarantine_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = Q.value_scan(_motion(spark, sf_dir), 22.53).where(F.size("reasons") > 0)
    return Q.quarantine(table(spark, sf_dir, "clip_file"), bad).select("file_id", "motion_id", "path")


@query(
    f"WITH {_SCAN}, m AS (SELECT r.object_type, r.motion_id, frame, joint, CAST(f AS DOUBLE[]) AS f FROM r JOIN scan USING (object_type, motion_id) WHERE reasons = ''), "
    + FEATURE_SQL["ft_group_statistics"].split("x AS (", 1)[1].join(["x AS (", ""]).replace("r AS (SELECT object_type, joint, channel, avg", "rr AS (SELECT object_type, joint, channel, avg").replace("END AS std FROM r)", "END AS std FROM rr)").replace("round(std, 6)", "round(CASE WHEN channel < 12 THEN greatest(std, 1e-6) ELSE std END, 6)")
)
def qa_repaired_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics without the quarantined clips."""
    m = _motion(spark, sf_dir)
    bad = Q.value_scan(m, 22.53).where(F.size("reasons") > 0)
    s = X.group_statistics(Q.quarantine(m, bad), 1e-6)
    return s.withColumns({c: F.round(c, 6) + 0.0 for c in ("mean", "std")})


@query(
    f"""WITH {_ROWS}, {TOPOLOGY}, {CLIP}, g AS (SELECT r.*, topo.object_type IS NOT NULL AS known, foot_joint_idx AS feet FROM r LEFT JOIN topo ON topo.object_type = r.object_type),
v AS (SELECT object_type, motion_id, frame, len(list_filter(f, lambda x: NOT isfinite(x))) AS odd, list_max(list_transform(list_filter(f, lambda x: isfinite(x)), lambda x: abs(CAST(x AS DOUBLE)))) AS top,
 round(CAST(f[13] AS DOUBLE), 6) NOT IN (0, 1) AS fuzzy, coalesce(known AND feet IS NOT NULL AND NOT list_contains(feet, joint) AND abs(f[13]) > 1e-6, false) AS afloat, CAST(f AS DOUBLE[]) AS d FROM g),
w AS (SELECT *, least(sqrt(d[4]**2 + d[5]**2 + d[6]**2), sqrt(d[7]**2 + d[8]**2 + d[9]**2)) < 1e-6 AS short, sqrt((d[5]*d[9]-d[6]*d[8])**2 + (d[6]*d[7]-d[4]*d[9])**2 + (d[4]*d[8]-d[5]*d[7])**2) < 1e-6 AS par FROM v),
p AS (SELECT object_type, motion_id, count(DISTINCT frame) AS n_frames, sum(odd) AS odd, max(top) AS top, bool_or(fuzzy) AS fuzzy, bool_or(afloat) AS afloat, bool_or(short) AS short, bool_or(par) AS par FROM w GROUP BY ALL),
j AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS joint, unnest(parents) AS parent FROM topo),
b AS (SELECT r.object_type, motion_id, f, first_value(f) OVER (PARTITION BY r.object_type, motion_id, frame, parent ORDER BY r.joint) AS b FROM r JOIN j ON j.object_type = r.object_type AND j.joint = r.joint WHERE parent >= 0),
sp AS (SELECT object_type, motion_id, bool_or(NOT (greatest(abs(f[4]-b[4]), abs(f[5]-b[5]), abs(f[6]-b[6]), abs(f[7]-b[7]), abs(f[8]-b[8]), abs(f[9]-b[9])) <= 1e-4)) AS differ FROM b GROUP BY ALL)
SELECT p.object_type, p.motion_id, array_to_string(list_filter([CASE WHEN odd > 0 THEN 'nonfinite' END, CASE WHEN top > 25 THEN 'size' END, CASE WHEN c.source_frames IS NOT NULL AND p.n_frames <> c.source_frames - 1 THEN 'frames' END, CASE WHEN fuzzy THEN 'contact' END, CASE WHEN afloat THEN 'contact off feet' END,
 CASE WHEN short THEN 'rotation length' WHEN par THEN 'rotation parallel' END, CASE WHEN differ THEN 'children differ' END], lambda x: x IS NOT NULL), ';') AS issues FROM p LEFT JOIN c ON c.motion_id = p.motion_id LEFT JOIN sp ON sp.object_type = p.object_type AND sp.motion_id = p.motion_id"""
)
def qa_gate_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.gate_a(_motion(spark, sf_dir), first_clip(spark, sf_dir), first_topology(spark, sf_dir)).select("object_type", "motion_id", F.array_join("issues", ";").alias("issues"))


@query(_WORLD + "SELECT motion_id, avg(CASE WHEN joint = 2 THEN 0.001 ELSE 0 END) <= 1e-4 AS passed, false AS waived, round(avg(CASE WHEN joint = 2 THEN 0.001 ELSE 0 END), 6) AS mean_l2 FROM world GROUP BY motion_id")
def qa_gate_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate B against the same positions with joint 2 moved by a thousandth."""
    w = X.world_positions(finite_motion(spark, sf_dir))
    source = w.select("motion_id", "frame", "joint", (F.col("w0") + F.when(F.col("joint") == 2, 0.001).otherwise(0.0)).alias("s0"), F.col("w1").alias("s1"), F.col("w2").alias("s2"))
    return Q.gate_b(w.select("motion_id", "frame", "joint", "w0", "w1", "w2"), source).withColumn("mean_l2", F.round("mean_l2", 6))


_FK = FEATURE_SQL["ft_forward_kinematics"].rsplit("\nSELECT ", 1)[0]


@query(
    _FK
    + """, duo AS (SELECT fk.object_type, fk.motion_id, fk.frame, fk.x, fk.y, fk.z, w0, w1, w2 FROM fk JOIN world w ON w.object_type = fk.object_type AND w.motion_id = fk.motion_id AND w.frame = fk.frame AND w.joint = fk.joint),
e AS (SELECT object_type, motion_id, avg(sqrt((x-w0)**2 + (y-w1)**2 + (z-w2)**2)) AS mean_l2 FROM duo GROUP BY ALL),
bx AS (SELECT object_type, motion_id, frame, sqrt((max(w0)-min(w0))**2 + (max(w1)-min(w1))**2 + (max(w2)-min(w2))**2) AS d FROM duo GROUP BY ALL), bd AS (SELECT object_type, motion_id, avg(d) + 1e-8 AS diagonal FROM bx GROUP BY ALL)
SELECT object_type, motion_id, round(mean_l2, 5) AS mean_l2, round(diagonal, 5) AS diagonal FROM e JOIN bd USING (object_type, motion_id)"""
)
def qa_gate_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Q.gate_c(finite_motion(spark, sf_dir), first_topology(spark, sf_dir))
    return out.select("object_type", "motion_id", F.round("mean_l2", 5).alias("mean_l2"), F.round("diagonal", 5).alias("diagonal"))


def _failures(gate: str, sql: str, where: str) -> str:
    return f"SELECT '{gate}' AS gate, count(*) AS n_failed FROM ({sql}) WHERE {where}"


@query(query.oracle["qa_gate_c"].rsplit("\ne AS (", 1)[0] + " g AS (SELECT object_type, sqrt((x-w0)**2 + (y-w1)**2 + (z-w2)**2) AS e FROM duo) SELECT object_type, round(avg(e), 5) AS mean, round(quantile_cont(e, 0.95), 5) AS p95, round(max(e), 5) AS largest FROM g GROUP BY object_type")
def qa_position_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Q.error_report(finite_motion(spark, sf_dir), first_topology(spark, sf_dir))
    return out.withColumns({k: F.round(k, 5) for k in ("mean", "p95", "largest")})


@query(
    SKELETON_SQL["sk_validate"].replace("WITH RECURSIVE ", f"WITH RECURSIVE {CLIP}, ", 1).rsplit("\nSELECT object_type, array_to_string", 1)[0]
    + ", v AS (SELECT object_type, array_to_string" + SKELETON_SQL["sk_validate"].rsplit("\nSELECT object_type, array_to_string", 1)[1]
    + """), b AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS joint, unnest(parents) AS parent, unnest(offsets) AS o, scale_ref_joint_idx AS s FROM topo),
f AS (SELECT object_type, any_value(coalesce(len(s), 0) > 0) AS declared, avg(sqrt(o[1]**2 + o[2]**2 + o[3]**2)) / 0.2092142857142857 AS ratio FROM b WHERE parent >= 0 AND sqrt(o[1]**2 + o[2]**2 + o[3]**2) > 1e-8 AND (coalesce(len(s), 0) = 0 OR list_contains(s, joint)) GROUP BY object_type)
SELECT 'skeleton' AS rule, object_type AS subject FROM v WHERE issues <> '' UNION SELECT 'scale', object_type FROM f WHERE CASE WHEN declared THEN ratio NOT BETWEEN 0.98 AND 1.02 ELSE ratio NOT BETWEEN 0.3 AND 3.0 END
UNION SELECT 'no skeleton', motion_id FROM c WHERE object_type IS NULL OR object_type NOT IN (SELECT object_type FROM topo) UNION SELECT 'no split', motion_id FROM c WHERE coalesce(lower(trim(split)) NOT IN ('train', 'val', 'test'), true)
UNION SELECT 'not listed', object_type FROM topo WHERE object_type NOT IN (SELECT object_name FROM object_index)"""
)
def qa_gate_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.gate_e(first_clip(spark, sf_dir), first_topology(spark, sf_dir), table(spark, sf_dir, "object_index"))


@query(
    """WITH h AS (SELECT DISTINCT motion_id FROM motion), i AS (SELECT motion_id, count(DISTINCT lower(trim(split))) AS n FROM clip WHERE split IS NOT NULL AND trim(split) <> '' GROUP BY 1), a AS (SELECT motion_id FROM clip UNION SELECT motion_id FROM h)
SELECT coalesce(i.n, 0) AS n_splits, h.motion_id IS NOT NULL AS has_motion, count(*) AS n_clips FROM a LEFT JOIN i USING (motion_id) LEFT JOIN h ON h.motion_id = a.motion_id GROUP BY ALL"""
)
def qa_split_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.split_coverage(table(spark, sf_dir, "clip"), table(spark, sf_dir, "motion"))


@query(
    f"""WITH {CLIP} SELECT motion_id, array_to_string(list_filter([CASE WHEN NOT regexp_matches(motion_id, '^[A-Za-z0-9._-]+$') THEN 'name' END, CASE WHEN coalesce(n_frames < 1, true) THEN 'frames' END, CASE WHEN coalesce(n_joints < 1, true) THEN 'joints' END,
CASE WHEN coalesce(lower(trim(split)) NOT IN ('train', 'val', 'test'), true) THEN 'split' END, CASE WHEN captions IS NULL THEN 'captions missing' WHEN len(captions) = 0 THEN 'captions empty' END, CASE WHEN source_frames <> n_frames + 1 THEN 'source frames' END], lambda x: x IS NOT NULL), ';') AS issues FROM c"""
)
def qa_clip_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.clip_issues(first_clip(spark, sf_dir)).select("motion_id", F.array_join("issues", ";").alias("issues"))


@query(f"WITH {CLIP} SELECT CAST(n_frames // 20 * 20 AS VARCHAR) || '-' || CAST(n_frames // 20 * 20 + 19 AS VARCHAR) AS bin, count(*) AS n_clips, CAST(sum(n_frames) AS BIGINT) AS n_frames FROM c WHERE n_frames IS NOT NULL GROUP BY 1")
def qa_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.length_histogram(first_clip(spark, sf_dir), 20)


@query(f"WITH {CLIP} SELECT object_type, count(*) AS n_clips, min(n_frames) AS shortest, max(n_frames) AS longest, CAST(sum(n_frames) AS BIGINT) AS n_frames, max(n_joints) AS n_joints, round(sum(n_frames) / 12.5 / 60, 6) AS minutes_reported, round(sum(n_frames) / 20.0 / 60, 6) AS minutes FROM c GROUP BY object_type")
def qa_source_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.source_summary(first_clip(spark, sf_dir))


@query(f"WITH {CLIP}, a AS (SELECT object_name, max(motions) AS m, max(frames) AS fr FROM object_index WHERE object_name IS NOT NULL GROUP BY 1), b AS (SELECT object_type, count(*) AS n, CAST(sum(n_frames) AS BIGINT) AS k FROM c WHERE object_type IS NOT NULL GROUP BY 1) SELECT coalesce(object_name, object_type) AS object_name, m AS claimed_clips, fr AS claimed_frames, n AS n_clips, k AS n_frames FROM a FULL JOIN b ON object_name = object_type")
def qa_index_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.index_claims(table(spark, sf_dir, "object_index"), first_clip(spark, sf_dir))


@query(
    f"""WITH {FINITE}, v AS (SELECT object_type, 'height' AS metric, f[2] AS v FROM m WHERE joint = 0 UNION ALL SELECT object_type, 'contact', f[13] FROM m), p AS (SELECT object_type, metric, avg(v) AS a, stddev_pop(v) AS s FROM v GROUP BY ALL)
SELECT object_type AS character, metric, round(a, 6) + 0.0 AS mean, round(s, 6) + 0.0 AS std FROM p UNION ALL SELECT 'FINAL', metric, round(avg(a), 6) + 0.0, round(stddev_pop(a), 6) + 0.0 FROM p GROUP BY metric"""
)
def qa_means_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = finite_motion(spark, sf_dir)
    height = m.where("joint = 0").select("object_type", F.lit("height").alias("metric"), F.get("f", F.lit(1)).cast("double").alias("v"))
    contact = m.select("object_type", F.lit("contact").alias("metric"), F.get("f", F.lit(12)).cast("double").alias("v"))
    return Q.means_of_means(height.unionByName(contact), "object_type", "metric", "v").withColumns({c: F.round(c, 6) + 0.0 for c in ("mean", "std")})


@query("SELECT file_id, motion_id, CAST(row_number() OVER (PARTITION BY motion_id ORDER BY file_id) - 1 AS INTEGER) AS segment_index, count(*) OVER (PARTITION BY motion_id) AS segment_count FROM clip_file")
def qa_segment_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.segment_numbers(table(spark, sf_dir, "clip_file").select("file_id", "motion_id"), "motion_id", "file_id")


@query(f"WITH {CLIP}, k AS (SELECT *, coalesce(object_type, '') AS o FROM c) SELECT motion_id, o, CAST((row_number() OVER (PARTITION BY o ORDER BY motion_id) - 1) // 30 AS INTEGER) AS page, CAST(ceil(count(*) OVER (PARTITION BY o) / 30.0) AS INTEGER) AS n_pages FROM k")
def qa_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.pages(first_clip(spark, sf_dir).select("motion_id", F.coalesce("object_type", F.lit("")).alias("o")), "o", ["motion_id"], 30)


def qa_build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of the gates that a build is accepted by, over whole tables; gate C of all clips with finite readings."""
    return Q.acceptance(_motion(spark, sf_dir), first_clip(spark, sf_dir), first_topology(spark, sf_dir), table(spark, sf_dir, "object_index"))


query.queries["qa_build_report"] = qa_build_report
_JUDGED = query.oracle["qa_gate_c"].rsplit("SELECT object_type, motion_id, round(mean_l2", 1)[0] + """, sp AS (SELECT m.object_type, m.motion_id, m.frame, t.parent, m.joint, m.f, first_value(m.f) OVER (PARTITION BY m.object_type, m.motion_id, m.frame, t.parent ORDER BY m.joint) AS g FROM m JOIN (SELECT object_type, unnest(range(len(parents))) AS joint, unnest(parents) AS parent FROM topo) t USING (object_type, joint) WHERE t.parent >= 0),
sd AS (SELECT object_type, motion_id, max(greatest(abs(f[4]-g[4]), abs(f[5]-g[5]), abs(f[6]-g[6]), abs(f[7]-g[7]), abs(f[8]-g[8]), abs(f[9]-g[9]))) AS spread FROM sp GROUP BY ALL),
ok AS (SELECT object_type, motion_id FROM e JOIN bd USING (object_type, motion_id) JOIN topo USING (object_type) LEFT JOIN sd USING (object_type, motion_id) WHERE CASE WHEN gate_c_mode = 'inferred_twist' THEN mean_l2/diagonal <= 0.005 ELSE mean_l2 <= 1e-4 END AND coalesce(spread, 0) <= 1e-4)
SELECT DISTINCT object_type, motion_id FROM (SELECT object_type, motion_id FROM motion WHERE object_type IS NOT NULL AND f IS NOT NULL) a ANTI JOIN ok USING (object_type, motion_id)"""
query.oracle["qa_build_report"] = " UNION ALL ".join([_failures("A", query.oracle["qa_gate_a"], "issues <> ''"), "SELECT 'B', 0", _failures("C", _JUDGED, "true"), _failures("E", query.oracle["qa_gate_e"], "true")])
QUERIES, ORACLE = query.queries, query.oracle
