"""Queries of the general data-upkeep problems over the project's tables, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.operators import archive, hotkeys, orphans, spikes
from stridelake.scratch import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spikes.implausible_readings(table(spark, sf_dir, "motion"))


def p1_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spikes.source_report(table(spark, sf_dir, "motion"))


def p1_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cases the forest's scores alone bring to the top, per source."""
    return spikes.score_report(table(spark, sf_dir, "motion"))


_P1_VIEWS = """
WITH r AS (SELECT DISTINCT object_type o, motion_id m, frame, joint, f FROM motion WHERE object_type IS NOT NULL AND f IS NOT NULL),
v AS (SELECT o, m, frame, joint, unnest(range(13)) c, CAST(unnest(f) AS DOUBLE) x FROM r),
w AS (SELECT * FROM v WHERE c IN (0, 1, 2, 9, 10, 11) AND (joint > 0 OR c IN (1, 9, 11)) AND isfinite(x)),
md AS (SELECT o, joint, c, median(x) med FROM w GROUP BY ALL),
mm AS (SELECT o, joint, c, any_value(med) med, median(abs(x - med)) mad FROM w JOIN md USING (o, joint, c) GROUP BY ALL),
n AS (SELECT *, lag(frame) OVER s pf, lag(x) OVER s px, lead(frame) OVER s nf, lead(x) OVER s nx FROM w WINDOW s AS (PARTITION BY o, m, joint, c ORDER BY frame)),
d AS (SELECT *, CASE WHEN pf = frame - 1 THEN x - px END d1, CASE WHEN nf = frame + 1 THEN x - nx END d2 FROM n),
st AS (SELECT o, joint, c, median(abs(d1)) step FROM d WHERE d1 <> 0 GROUP BY ALL),
ru AS (SELECT *, sum(CASE WHEN d1 = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY o, m, joint, c ORDER BY frame) g FROM d),
rl AS (SELECT *, count(*) OVER (PARTITION BY o, m, joint, c, g) k FROM ru)
"""

def _references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    clip, topology, listed = (table(spark, sf_dir, t) for t in ("clip", "topology", "object_index"))
    first = clip.groupBy("motion_id").agg(F.min_by(F.struct("object_type", "ingested_at"), F.struct(F.col("ingested_at").isNull(), "ingested_at", "object_type")).alias("r"))
    clips = first.select(F.lit("clip").alias("src_table"), F.col("motion_id").alias("rec_id"), F.col("r.object_type").alias("key"), F.col("r.ingested_at").alias("at"))
    skeletons = topology.select(F.lit("topology").alias("src_table"), F.col("topology_id").cast("string").alias("rec_id"), F.col("object_type").alias("key"), F.col("added_at").alias("at")).distinct()
    in_force = topology.select(F.col("object_type").alias("key"), F.col("added_at").alias("start"), F.col("deleted_at").alias("end"))
    known = listed.select(F.col("object_name").alias("key"), F.col("added_at").alias("start"), F.col("removed_at").alias("end"))
    return clips, skeletons, in_force, known


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips, skeletons, in_force, known = _references(spark, sf_dir)
    return orphans.orphan_references(clips, in_force).unionByName(orphans.orphan_references(skeletons, known))


def p3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips, skeletons, in_force, known = _references(spark, sf_dir)
    missed = orphans.orphan_references(clips, in_force).unionByName(orphans.orphan_references(skeletons, known))
    return orphans.orphan_counts(missed, clips.unionByName(skeletons))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.idle_files(archive.pack(table(spark, sf_dir, "clip_file")))


def p4_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file read back from its container, with its place and whether the bytes are those that went in."""
    files = table(spark, sf_dir, "clip_file").select("file_id", F.col("payload").alias("original")).where("file_id is not null")
    back = archive.unpack(archive.pack(table(spark, sf_dir, "clip_file")))
    return back.join(files, "file_id").select("file_id", "path", "length", (F.col("intact") & F.col("payload").eqNullSafe(F.col("original"))).alias("intact"))


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.consolidate(archive.pack(table(spark, sf_dir, "clip_file")))


def p4_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per clip what the consolidated containers hold, read back from them: records, their bytes, and whether all checksums hold."""
    back = archive.unpack(archive.consolidated_containers(archive.pack(table(spark, sf_dir, "clip_file"))))
    lines = F.size(F.split("payload", "\n")) - 1
    return back.groupBy("motion_id").agg(F.sum(lines).alias("n_records"), F.sum("length").alias("n_bytes"), F.min("intact").alias("intact"))


def p4_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidated containers over all: records, bytes, containers larger than the target, and containers beyond those the bytes need (one part filled per task)."""
    blocks = archive.consolidated_containers(archive.pack(table(spark, sf_dir, "clip_file")))
    lines = F.size(F.split(F.col("data").cast("string"), "\n")) - 1
    tasks = F.count_distinct(F.substring_index("block_id", "-", 1))
    full = F.count(F.lit(1)) - tasks <= F.floor(F.sum(F.octet_length("data")) / (archive.BLOCK_BYTES * 0.9))
    return blocks.agg(F.sum(lines).cast("bigint").alias("n_records"), F.sum(F.octet_length("data")).cast("bigint").alias("n_bytes"), F.count_if(F.octet_length("data") > archive.BLOCK_BYTES).alias("n_over"), full.alias("well_filled"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotkeys.heavy_keys(table(spark, sf_dir, "clip"), "object_type", "motion_id").select(F.col("key").alias("object_type"))


def p5_motion_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, root heights and contacts per object_type of ``motion``, null object_type included."""
    totals = hotkeys.per_key_totals(table(spark, sf_dir, "motion"), "object_type", {"height": "CASE WHEN joint = 0 THEN f[1] END", "contact": "CASE WHEN f[12] IN (0, 1) THEN f[12] END"}, keep_null=True)
    return totals.select(F.col("key").alias("object_type"), "n_rows", "height_n", F.round("height_sum", 3).alias("height_sum"), "contact_n", F.col("contact_sum").cast("bigint").alias("contacts"))


def p5_clip_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct clips and their frames per object_type of ``clip``."""
    once = table(spark, sf_dir, "clip").groupBy("object_type", "motion_id").agg(F.max("n_frames").alias("n_frames"))
    totals = hotkeys.per_key_totals(once, "object_type", {"frames": "n_frames"}, keep_null=True)
    return totals.select(F.col("key").alias("object_type"), F.col("n_rows").alias("n_clips"), F.col("frames_sum").cast("bigint").alias("n_frames"))


QUERIES = {f.__name__: f for f in (p1_found, p1_sources, p1_scores, p3_found, p3_counts, p4_found, p4_index, p4_records, p4_containers, p4_blocks, p5_found, p5_motion_totals, p5_clip_totals)}

_P3_VIEWS = """
WITH c AS (SELECT 'clip' AS src_table, motion_id AS rec_id, arg_min(object_type, ingested_at) AS k, min(ingested_at) AS t FROM (SELECT motion_id, coalesce(object_type, '~~') AS object_type, ingested_at FROM clip) GROUP BY motion_id),
refs AS (SELECT src_table, rec_id, k, t FROM c WHERE k <> '~~' UNION ALL
  SELECT DISTINCT 'topology', CAST(topology_id AS VARCHAR), object_type, added_at FROM topology WHERE object_type IS NOT NULL),
par AS (SELECT DISTINCT 'clip' AS src_table, object_type AS k, added_at AS a, deleted_at AS b FROM topology WHERE object_type IS NOT NULL UNION ALL
  SELECT DISTINCT 'topology', object_name, added_at, removed_at FROM object_index),
orphan AS (SELECT DISTINCT src_table, rec_id, strftime(t, '%Y-%m') AS period FROM refs r WHERE NOT EXISTS (SELECT 1 FROM par p WHERE p.src_table = r.src_table AND p.k = r.k AND p.a <= r.t AND (p.b IS NULL OR r.t < p.b)))
"""

_P4_LINES = r"""
WITH l AS (SELECT file_id, motion_id, unnest(regexp_split_to_array(coalesce(payload, ''), '\r\n|\r|\n')) AS line, generate_subscripts(regexp_split_to_array(coalesce(payload, ''), '\r\n|\r|\n'), 1) AS pos FROM clip_file),
rec AS (SELECT file_id, motion_id, pos, coalesce(nullif(ltrim(trim(split_part(line, ',', 1)), '0'), ''), '0') AS digits, TRY_CAST(trim(split_part(line, ',', 1)) AS BIGINT) AS frame, line, TRY_CAST(trim(split_part(line, ',', 2)) AS DOUBLE) AS height, TRY_CAST(trim(split_part(line, ',', 3)) AS INTEGER) AS contacts FROM l WHERE regexp_matches(trim(split_part(line, ',', 1)), '^[0-9]+$'))
"""

_P1_CASES = """, cases AS (
SELECT o, m AS motion_id, frame, joint, CAST(c AS INTEGER) AS channel FROM v WHERE NOT isfinite(x) OR (c BETWEEN 3 AND 8 AND abs(x) > 1.01) OR (c = 12 AND x NOT IN (0, 1))
UNION
SELECT o, m, frame, joint, CAST(c AS INTEGER) FROM rl LEFT JOIN mm USING (o, joint, c) LEFT JOIN st USING (o, joint, c)
WHERE abs(x - med) > 10 * mad OR k >= 10 OR (((d1 > 0 AND d2 > 0) OR (d1 < 0 AND d2 < 0)) AND abs(d1) > 5 * step AND abs(d2) > 5 * step))
"""

ORACLE = {
    "p1_found": _P1_VIEWS + _P1_CASES + "SELECT DISTINCT motion_id, frame, joint, channel FROM cases",
    "p1_sources": _P1_VIEWS + _P1_CASES + "SELECT o AS object_type, readings, coalesce(n, 0) AS cases FROM (SELECT o, count(x) AS readings FROM v GROUP BY o) LEFT JOIN (SELECT o, count(*) AS n FROM cases GROUP BY o) USING (o)",
    "p3_found": _P3_VIEWS + "SELECT * FROM orphan",
    "p3_counts": _P3_VIEWS
    + """, n AS (SELECT src_table, strftime(t, '%Y-%m') AS period, count(*) AS n_refs FROM (SELECT DISTINCT src_table, rec_id, t FROM refs) GROUP BY ALL),
o AS (SELECT src_table, period, count(*) AS n_orphans FROM orphan GROUP BY ALL)
SELECT n.src_table, n.period, n.n_refs, coalesce(o.n_orphans, 0) AS n_orphans FROM n LEFT JOIN o USING (src_table, period)""",
    "p4_found": _P4_LINES
    + """, s AS (SELECT file_id, motion_id, list_sort(list_distinct(list(digits))) AS fs FROM rec GROUP BY ALL)
SELECT DISTINCT file_id FROM clip_file WHERE file_id NOT IN (SELECT file_id FROM rec)
UNION SELECT DISTINCT a.file_id FROM s a JOIN s b ON a.motion_id = b.motion_id AND a.file_id <> b.file_id AND list_has_all(b.fs, a.fs) AND (len(b.fs) > len(a.fs) OR b.file_id < a.file_id)""",
    "p4_index": "SELECT file_id, path, CAST(octet_length(encode(payload)) AS BIGINT) AS length, true AS intact FROM clip_file",
    "p4_records": _P4_LINES + "SELECT motion_id, frame, height, contacts, file_id FROM (SELECT *, row_number() OVER (PARTITION BY motion_id, digits ORDER BY file_id, pos) AS k FROM rec) WHERE k = 1",
    "p4_containers": _P4_LINES + "SELECT motion_id, count(*) AS n_records, CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) AS n_bytes, true AS intact FROM (SELECT *, row_number() OVER (PARTITION BY motion_id, digits ORDER BY file_id, pos) AS k FROM rec) WHERE k = 1 GROUP BY motion_id",
    "p4_blocks": _P4_LINES + "SELECT count(*) AS n_records, CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) AS n_bytes, 0 AS n_over, true AS well_filled FROM (SELECT *, row_number() OVER (PARTITION BY motion_id, digits ORDER BY file_id, pos) AS k FROM rec) WHERE k = 1",
    "p5_found": "SELECT object_type FROM clip WHERE object_type IS NOT NULL GROUP BY object_type HAVING count(DISTINCT motion_id) * 20 >= (SELECT count(DISTINCT motion_id) FROM clip)",
    "p5_motion_totals": """SELECT object_type, count(*) AS n_rows, count(CASE WHEN joint = 0 AND isfinite(f[2]) THEN 1 END) AS height_n, round(coalesce(sum(CASE WHEN joint = 0 AND isfinite(f[2]) THEN CAST(f[2] AS DOUBLE) END), 0), 3) AS height_sum,
count(CASE WHEN f[13] IN (0, 1) THEN 1 END) AS contact_n, CAST(coalesce(sum(CASE WHEN f[13] IN (0, 1) THEN f[13] END), 0) AS BIGINT) AS contacts FROM motion GROUP BY object_type""",
    "p5_clip_totals": "SELECT object_type, count(*) AS n_clips, CAST(sum(n) AS BIGINT) AS n_frames FROM (SELECT object_type, motion_id, max(n_frames) AS n FROM clip GROUP BY ALL) GROUP BY object_type",
}
