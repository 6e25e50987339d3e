"""Manifest joins, names and captions over clips, files, skeletons and listed objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions import captions as C
from stridelake.functions import strings as T
from stridelake.operators import manifest as M
from stridelake.operators import skeleton as S
from stridelake.queries.base import CLIP, TOPOLOGY, Registry, first_clip, first_topology
from stridelake.scratch import table

query = Registry()


@query(
    f"""WITH {CLIP}, k AS (SELECT DISTINCT object_name FROM object_index WHERE object_name IS NOT NULL), h AS (SELECT motion_id, arg_max(object_name, length(object_name)) AS found FROM c JOIN k ON starts_with(motion_id, object_name || '_') GROUP BY 1)
SELECT motion_id, coalesce(found, regexp_replace(motion_id, '_[^_]*$', '')) AS object_name, found IS NOT NULL AS by_key FROM c LEFT JOIN h USING (motion_id)"""
)
def mf_longest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.longest_prefix(first_clip(spark, sf_dir).select("motion_id"), "motion_id", table(spark, sf_dir, "object_index"), "object_name")


@query(
    f"""WITH {CLIP}, n AS (SELECT motion_id, coalesce(object_type, '') AS pre, regexp_replace(motion_id, '_[0-9]+$', '') AS base, regexp_matches(motion_id, '_[0-9]+$') AS counted FROM c),
k AS (SELECT s, min(p) AS p FROM (SELECT 'canter' AS s, 1 AS p UNION ALL SELECT 'walk', 2 UNION ALL SELECT 'climb_ledge', 3 UNION ALL SELECT 'hide', 4 UNION ALL SELECT 'slow', 5 UNION ALL SELECT 'e', 6) GROUP BY s),
h AS (SELECT motion_id, CAST(CASE WHEN counted AND starts_with(motion_id, pre || '_') AND substr(base, length(pre) + 2) = s THEN 1 WHEN counted AND ends_with(base, s) THEN 2 WHEN contains(motion_id, s) THEN 3 END AS INTEGER) AS tier, s, p FROM n CROSS JOIN k)
SELECT n.motion_id, b.tier, b.s AS stem FROM n LEFT JOIN (SELECT motion_id, arg_min(tier, (tier, p, s)) AS tier, arg_min(s, (tier, p, s)) AS s FROM h WHERE tier IS NOT NULL GROUP BY 1) b USING (motion_id)"""
)
def mf_tiered_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clip names against a list of action stems: equal, at the end, anywhere."""
    stems = spark.createDataFrame([(s, i + 1) for i, s in enumerate(("canter", "walk", "climb_ledge", "hide", "slow", "e"))], "s string, p int")
    return M.tiered_match(first_clip(spark, sf_dir).select("motion_id", F.coalesce("object_type", F.lit("")).alias("pre")), "motion_id", "pre", stems, "s", "p")


@query(
    f"""WITH {CLIP}, i AS (SELECT regexp_replace(lower(object_name), '[^a-z0-9]+', '', 'g') AS k, min(source_group) AS text FROM object_index WHERE source_group IS NOT NULL AND regexp_replace(lower(object_name), '[^a-z0-9]+', '', 'g') <> '' GROUP BY 1),
a AS (SELECT motion_id, 0 AS place, regexp_replace(motion_id, '_[0-9]+$', '') AS cand FROM c UNION ALL SELECT motion_id, 1, object_type FROM c UNION ALL SELECT motion_id, 2, split_part(object_type, '_', 1) FROM c),
h AS (SELECT motion_id, arg_min(cand, place) AS cand, arg_min(text, place) AS text FROM a JOIN i ON i.k = regexp_replace(lower(cand), '[^a-z0-9]+', '', 'g') GROUP BY 1)
SELECT c.motion_id, h.cand AS match_key, h.text, CASE WHEN h.cand IS NULL THEN 'missing_text' ELSE 'matched' END AS status FROM c LEFT JOIN h USING (motion_id)"""
)
def mf_candidate_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = [T.without_counter(F.col("motion_id")), F.col("object_type"), F.substring_index("object_type", "_", 1)]
    return M.candidate_match(first_clip(spark, sf_dir), "motion_id", candidates, table(spark, sf_dir, "object_index"), "object_name", "source_group")


_STATUS = f"""
WITH {CLIP}, n AS (SELECT motion_id, count(*) AS n FROM clip_file GROUP BY 1), r AS (SELECT DISTINCT object_type FROM topology),
s AS (SELECT c.motion_id, c.object_type, coalesce(n.n, 0) AS n_processed, CASE WHEN coalesce(n, 0) = 1 THEN 'matched' WHEN coalesce(n, 0) = 0 THEN 'missing_processed' ELSE 'duplicate_processed' END AS st, r.object_type IS NOT NULL AS raw FROM c LEFT JOIN n USING (motion_id) LEFT JOIN r ON r.object_type = c.object_type),
a AS (SELECT motion_id, object_type, n_processed, CASE WHEN raw THEN st WHEN n_processed = 1 THEN 'missing_raw' ELSE st || '+missing_raw' END AS status FROM s)
"""


@query(_STATUS + "SELECT * FROM a")
def mf_alignment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = first_clip(spark, sf_dir).select("motion_id", "object_type")
    return M.alignment_status(clips, table(spark, sf_dir, "topology"), "object_type", table(spark, sf_dir, "clip_file"), "motion_id")


@query(_STATUS + "SELECT status, object_type, count(*) AS n FROM a GROUP BY ALL ORDER BY n DESC, status, object_type NULLS FIRST LIMIT 20")
def mf_top_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty most frequent status and source pairs."""
    return mf_alignment_status(spark, sf_dir).groupBy("status", "object_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "status", "object_type").limit(20)


@query(
    f"""WITH {CLIP}, t AS (SELECT DISTINCT object_type AS target FROM c WHERE object_type IS NOT NULL AND object_type NOT IN (SELECT object_type FROM topology WHERE object_type IS NOT NULL)), s AS (SELECT DISTINCT object_type AS source FROM topology WHERE object_type IS NOT NULL),
p AS (SELECT target, source, lower(split_part(target, '_', 1)) = lower(split_part(source, '_', 1)) AS same, CASE WHEN contains(target, '_') THEN substr(target, instr(target, '_') + 1) ELSE '' END AS tk, CASE WHEN contains(source, '_') THEN substr(source, instr(source, '_') + 1) ELSE '' END AS ck FROM t CROSS JOIN s),
q AS (SELECT target, source, (target <> source)::INT AS e, (tk <> ck)::INT AS k, (lower(regexp_replace(tk, '[^A-Za-z]', '', 'g')) <> lower(regexp_replace(ck, '[^A-Za-z]', '', 'g')))::INT AS f FROM p WHERE same)
SELECT target, arg_min(source, (e, k, f, source)) AS source, CAST(arg_min(e, (e, k, f, source)) AS INTEGER) AS differs, count(*) AS n_candidates FROM q GROUP BY target"""
)
def mf_best_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object types without a skeleton, with the skeleton of the same animal that fits best."""
    known = table(spark, sf_dir, "topology").where("object_type is not null").select("object_type").distinct()
    lost = first_clip(spark, sf_dir).where("object_type is not null").select("object_type").distinct().join(known, "object_type", "left_anti")
    kind = F.when(F.contains("object_type", F.lit("_")), F.regexp_replace("object_type", "^[^_]*_", "")).otherwise("")
    return M.best_alias(lost, known, "object_type", F.lower(F.substring_index("object_type", "_", 1)), kind)


@query(
    f"""WITH {TOPOLOGY}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY object_type ORDER BY version DESC, added_at DESC, topology_id DESC) AS rk FROM topology WHERE object_type IS NOT NULL) WHERE rk = 1),
a AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS j, unnest(parents) AS p, unnest(joints_names) AS name FROM topo), b AS (SELECT object_type, CAST(unnest(range(len(parents))) AS INTEGER) AS fj, unnest(parents) AS fp, unnest(joints_names) AS name FROM l),
m AS (SELECT a.object_type, a.name, j, p, fj, fp FROM a LEFT JOIN b ON b.object_type = a.object_type AND b.name = a.name)
SELECT m.object_type, m.name, m.j, m.fj, CASE WHEN m.fj IS NULL THEN 'missing' WHEN coalesce(q.fj, -1) = m.fp THEN 'same bone' ELSE 'other bone' END AS state FROM m LEFT JOIN m q ON q.object_type = m.object_type AND q.j = m.p"""
)
def mf_name_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joints of each skeleton's first version found by name in its last."""
    t = table(spark, sf_dir, "topology").where("object_type is not null")
    keep = [c for c in t.columns if c != "object_type"]
    last = t.groupBy("object_type").agg(F.max_by(F.struct(*keep), F.struct("version", "added_at", "topology_id")).alias("r")).select("object_type", "r.*")
    return M.name_mapping(S.joints(first_topology(spark, sf_dir)), S.joints(last))


@query("SELECT object_name AS object_type, 'not reported' AS side FROM (SELECT DISTINCT object_name FROM object_index WHERE object_name IS NOT NULL) WHERE object_name NOT IN (SELECT object_type FROM topology WHERE object_type IS NOT NULL) UNION ALL SELECT object_type, 'not expected' FROM (SELECT DISTINCT object_type FROM topology WHERE object_type IS NOT NULL) WHERE object_type NOT IN (SELECT object_name FROM object_index WHERE object_name IS NOT NULL)")
def mf_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.both_ways(table(spark, sf_dir, "object_index").select(F.col("object_name").alias("object_type")), table(spark, sf_dir, "topology"), "object_type")


@query(f"WITH {CLIP} SELECT motion_id, object_type FROM c WHERE lower(trim(object_type)) IN (SELECT lower(object_name) FROM object_index)")
def mf_semi_by_lower_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "object_index").select(F.lower("object_name").alias("k"))
    return first_clip(spark, sf_dir).withColumn("k", F.lower(F.trim("object_type"))).join(names, "k", "left_semi").select("motion_id", "object_type")


@query("WITH d AS (SELECT file_id, payload FROM clip_file WHERE payload IS NOT NULL), p AS (SELECT file_id, payload, CAST(unnest(range(greatest(CAST(ceil(octet_length(encode(payload)) / 64.0) AS BIGINT), 1))) AS INTEGER) AS part FROM d) SELECT file_id, sha256(payload) AS whole, part, sha256(substr(payload, part * 64 + 1, 64)) AS checksum FROM p")
def mf_part_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.part_checksums(table(spark, sf_dir, "clip_file"), 64)


@query(f"WITH {CLIP}, r AS (SELECT object_type, motion_id, CAST(CASE WHEN regexp_matches(lower(motion_id), 'rest_pose|tpos') THEN 0 WHEN contains(lower(motion_id), 'idle') THEN 1 ELSE 2 END AS INTEGER) AS choice FROM c WHERE object_type IS NOT NULL) SELECT object_type, arg_min(motion_id, (choice, motion_id)) AS motion_id, min(choice) AS choice FROM r GROUP BY 1")
def mf_rest_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.rest_clip(first_clip(spark, sf_dir))


@query(
    r"""WITH n AS (SELECT file_id, path, regexp_replace(path, '^.*/([^/]+)/([^/]+)$', '\1.\2') AS name FROM clip_file), k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY file_id) AS k FROM n),
a AS (SELECT file_id, name, CASE WHEN contains(path, '.tmp.') THEN 'skip' WHEN k > 1 THEN 'copy' ELSE 'link' END AS action FROM k) SELECT file_id, action, CASE action WHEN 'skip' THEN NULL WHEN 'copy' THEN 'pool/' || file_id || '_' || name ELSE 'pool/' || name END AS target FROM a"""
)
def mf_copy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.copy_plan(table(spark, sf_dir, "clip_file"), "pool")


@query("WITH f AS (SELECT motion_id, count(*) AS files, sum(size_bytes) AS bytes FROM clip_file GROUP BY 1) SELECT motion_id, files, CAST(bytes AS BIGINT) AS bytes FROM f WHERE files < 2 OR motion_id NOT IN (SELECT motion_id FROM motion)")
def mf_incomplete_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips that still need work: fewer than two files, or no motion rows."""
    per = table(spark, sf_dir, "clip_file").groupBy("motion_id").agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes"))
    done = per.where("files >= 2").join(table(spark, sf_dir, "motion").select("motion_id").distinct(), "motion_id", "left_semi")
    return per.join(done.select("motion_id"), "motion_id", "left_anti")


@query(
    f"""WITH {CLIP}, k AS (SELECT motion_id, object_type, regexp_replace(motion_id, '_[0-9]+$', '') AS base FROM c), a AS (SELECT *, CASE WHEN object_type IS NOT NULL AND starts_with(lower(base), lower(object_type) || '_') THEN substr(base, length(object_type) + 2) ELSE base END AS action FROM k)
SELECT motion_id, regexp_replace(lower(motion_id), '[^a-z0-9]+', '', 'g') AS norm, action, replace(lower(action), '_', ' ') AS spoken, CASE WHEN lower(left(action, 1)) IN ('a', 'e', 'i', 'o', 'u') THEN 'an' ELSE 'a' END AS article,
CASE WHEN regexp_matches(lower(action), 'fight|attack') THEN 'fight' WHEN regexp_matches(lower(action), 'climb|hang') THEN 'climb' WHEN regexp_matches(lower(action), 'swim|dive') THEN 'swim' WHEN contains(lower(action), 'run') THEN 'run' WHEN contains(lower(action), 'walk') THEN 'walk'
WHEN contains(lower(action), 'turn') THEN 'turn' WHEN contains(lower(action), 'jump') THEN 'jump' WHEN regexp_matches(lower(action), 'drink|eat|graze') THEN 'food' WHEN regexp_matches(lower(action), 'rest|sleep|idle') THEN 'rest' ELSE 'other' END AS class, left(md5(motion_id), 10) AS digest FROM a"""
)
def mf_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, actions and classes from clip names."""
    c = first_clip(spark, sf_dir).select("motion_id", "object_type", T.without_counter(F.col("motion_id")).alias("base"))
    c = c.withColumn("action", F.coalesce(T.short_action(F.col("base"), F.col("object_type")), F.col("base")))
    a = F.col("action")
    return c.select("motion_id", T.norm_key(F.col("motion_id")).alias("norm"), "action", T.spaced_action(a).alias("spoken"), T.article(a).alias("article"), T.action_class(a).alias("class"), F.substring(F.md5("motion_id"), 1, 10).alias("digest"))


@query(
    f"""WITH {TOPOLOGY}, j AS (SELECT DISTINCT unnest(joints_names) AS name FROM topo), w AS (SELECT name, list_filter(list_transform(string_split(name, '_'), lambda p: CASE lower(regexp_replace(p, '[_0-9]', '', 'g')) WHEN 'l' THEN 'left' WHEN 'r' THEN 'right' ELSE lower(regexp_replace(p, '[_0-9]', '', 'g')) END), lambda p: length(p) > 1) AS w FROM j)
SELECT name, array_to_string(w, ' ') AS words, CAST(list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 65), lambda i: (instr('0123456789abcdef', substr(sha256(array_to_string(w, ' ')), i, 1)) - 1)::BIGINT)), lambda a, d: (a * 16 + d) % 1024) AS BIGINT) AS code FROM w"""
)
def mf_joint_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint names as words, and each phrase hashed to 1,024 codes."""
    names = S.joints(first_topology(spark, sf_dir)).select("name").distinct()
    return names.select("name", T.joint_words(F.col("name")).alias("words")).select("name", "words", T.hash_word(F.col("words"), 1024).alias("code"))


_CAPTIONS = f"WITH {CLIP}, k AS (SELECT motion_id, object_type, CAST(unnest(range(len(captions))) AS INTEGER) AS place, unnest(captions) AS caption FROM c)"


@query(
    _CAPTIONS + r""", t AS (SELECT *, trim(regexp_replace(caption, '\s+', ' ', 'g')) AS t FROM k) SELECT motion_id, place, CASE WHEN trim(caption) = '' OR caption IS NULL THEN NULL ELSE upper(left(t, 1)) || substr(t, 2) || CASE WHEN regexp_matches(t, '[.!?]$') THEN '' ELSE '.' END END AS sentence FROM t"""
)
def mf_clean_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = first_clip(spark, sf_dir).select("motion_id", F.posexplode("captions").alias("place", "caption"))
    return c.select("motion_id", "place", T.clean_sentence(F.col("caption")).alias("sentence"))


@query(_CAPTIONS + r""" SELECT motion_id, count(DISTINCT regexp_replace(lower(caption), '[^a-z0-9]+', '', 'g')) AS n_distinct, string_agg(caption, '|' ORDER BY place) AS all_captions FROM (SELECT *, row_number() OVER (PARTITION BY motion_id, regexp_replace(lower(caption), '[^a-z0-9]+', '', 'g') ORDER BY place) AS rn FROM k WHERE caption IS NOT NULL AND trim(caption) <> '') WHERE rn = 1 GROUP BY motion_id""")
def mf_distinct_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions of a clip without repeats by letters and digits, in their order."""
    c = first_clip(spark, sf_dir).select("motion_id", F.posexplode("captions").alias("place", "caption")).where("caption is not null and trim(caption) <> ''")
    c = c.withColumn("k", F.regexp_replace(F.lower("caption"), "[^a-z0-9]+", "")).groupBy("motion_id", "k").agg(F.min(F.struct("place", "caption")).alias("f"))
    return c.groupBy("motion_id").agg(F.count(F.lit(1)).alias("n_distinct"), F.array_join(F.transform(F.array_sort(F.collect_list("f")), lambda x: x["caption"]), "|").alias("all_captions"))


@query(
    _CAPTIONS + r""", r AS (SELECT motion_id, unnest(list_filter([CASE WHEN trim(caption) = '' THEN 'empty' END, CASE WHEN length(trim(caption)) <> length(caption) THEN 'padded' END, CASE WHEN NOT contains(lower(caption), lower(split_part(object_type, '_', 1))) THEN 'other subject' END, CASE WHEN regexp_matches(caption, '[_@#]|__') THEN 'raw text' END,
CASE WHEN len(regexp_split_to_array(trim(caption), '\s+')) < 3 THEN 'short' END], lambda x: x IS NOT NULL)) AS reason FROM k WHERE caption IS NOT NULL) SELECT reason, count(*) AS n FROM r GROUP BY reason"""
)
def mf_caption_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each reason to reject a caption applies."""
    c = first_clip(spark, sf_dir).select("object_type", F.explode("captions").alias("caption")).where("caption is not null")
    return c.select(F.explode(T.caption_reasons(F.col("caption"), F.col("object_type"))).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    r"""WITH d AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), p AS (SELECT doc_id, string_split(line, ' | ') AS p FROM d) SELECT trim(p[1]) AS species, count(*) AS n, CAST(sum(TRY_CAST(trim(p[2]) AS INTEGER)) AS BIGINT) AS total FROM p WHERE len(p) = 3 GROUP BY 1"""
)
def mf_field_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-field lines of all texts, by their first field."""
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line")).select(F.split("line", r" \| ").alias("p")).where("size(p) = 3")
    return lines.groupBy(F.trim(F.col("p")[0]).alias("species")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.trim(F.col("p")[1]).try_cast("int")).alias("total"))


_ACTIONS = f"""WITH {CLIP}, k AS (SELECT motion_id, object_type, regexp_replace(motion_id, '_[0-9]+$', '') AS base FROM c WHERE object_type IS NOT NULL AND trim(object_type) <> ''), a AS (SELECT motion_id, object_type, CASE WHEN starts_with(lower(base), lower(object_type) || '_') THEN substr(base, length(object_type) + 2) ELSE base END AS action FROM k),
w AS (SELECT *, lower(trim(regexp_replace(replace(action, '_', ' '), '\\s+', ' ', 'g'))) AS words, string_split(lower(object_type), '_') AS p FROM a),
s AS (SELECT *, CASE WHEN len(p) > 1 AND p[-1] IN ('male', 'female', 'juvenile') THEN p[-1] || ' ' || array_to_string(p[1:len(p) - 1], ' ') ELSE array_to_string(p, ' ') END AS animal FROM w),
v AS (SELECT *, coalesce(map_extract(MAP {{{', '.join(f"'{k}': '{x}'" for k, x in C.PREDICATES.items())}}}, split_part(words, ' ', 1))[1], 'performs ' || words) AS does, CASE WHEN left(animal, 1) IN ('a', 'e', 'i', 'o', 'u') THEN 'an' ELSE 'a' END AS art FROM s)
"""


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = first_clip(spark, sf_dir).where("object_type is not null and trim(object_type) <> ''").select("motion_id", "object_type", T.without_counter(F.col("motion_id")).alias("base"))
    return c.select("motion_id", "object_type", T.short_action(F.col("base"), F.col("object_type")).alias("action"))


@query(_ACTIONS + "SELECT motion_id, regexp_replace(upper(left(art, 1)) || substr(art, 2) || ' ' || animal || ' ' || does || '.', ' +', ' ', 'g') AS draft FROM v WHERE NOT contains(lower(action), 'turn') AND NOT contains(action, '_to_')")
def mf_draft_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drafted captions of clips whose action neither turns nor goes from one state to another."""
    a = _actions(spark, sf_dir).where("not contains(lower(action), 'turn') and not contains(action, '_to_')")
    return C.with_draft(a, "object_type", "action").select("motion_id", "draft")


@query(_ACTIONS + "SELECT motion_id, regexp_replace('The ' || animal || ' ' || does || '.|' || upper(left(art, 1)) || substr(art, 2) || ' ' || animal || ' ' || does || '.|In this clip the ' || animal || ' ' || does || '.', ' +', ' ', 'g') AS forms FROM v")
def mf_paraphrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.with_paraphrases(_actions(spark, sf_dir), "object_type", "action", 3).select("motion_id", F.array_join("paraphrases", "|").alias("forms"))


@query(_CAPTIONS + r" SELECT motion_id, place, coalesce(caption IS NULL OR trim(caption) = '' OR NOT contains(lower(caption), lower(split_part(object_type, '_', 1))) OR regexp_matches(caption, '[_@#]|__'), false) AS rejected FROM k")
def mf_caption_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which captions a review rejects."""
    c = first_clip(spark, sf_dir).select("motion_id", "object_type", F.posexplode("captions").alias("place", "caption"))
    return c.select("motion_id", "place", C.review(F.col("caption"), F.col("object_type"))["rejected"].alias("rejected"))


QUERIES, ORACLE = query.queries, query.oracle
