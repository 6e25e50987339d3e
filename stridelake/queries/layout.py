"""Queries on paths, manifests and batch conditions over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions import strings as T
from stridelake.operators import conditions as C
from stridelake.operators import layout as L
from stridelake.operators import skeleton as S
from stridelake.queries.base import CLIP, FINITE, TOPOLOGY, Registry, finite_motion, first_clip, first_topology
from stridelake.scratch import table

query = Registry()
LONGEST = 8
_NAME = "regexp_replace(path, '^.*[/\\\\]', '')"
_STEM = f"regexp_replace({_NAME}, '\\.[^.]*$', '')"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "clip_file").select("file_id", "motion_id", "path", "size_bytes")


@query(f"WITH {TOPOLOGY}, g AS (SELECT object_type, n_joints, unnest(range(9)) AS i FROM topo), h AS (SELECT *, unnest(range(9)) AS j FROM g) SELECT object_type, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CASE WHEN i <= n_joints AND j <= n_joints THEN 1 ELSE 0 END AS mask FROM h")
def ct_pair_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.pair_mask(first_topology(spark, sf_dir).select("object_type", "n_joints"), LONGEST).drop("n_joints")


_CELLS = "c AS (SELECT object_type, unnest(range(len(parents))) AS i, unnest(parents) AS j FROM topo)"


@query(f"WITH {TOPOLOGY}, {_CELLS}, g AS (SELECT object_type, unnest(range(8)) AS i FROM topo), h AS (SELECT *, unnest(range(8)) AS j FROM g) SELECT h.object_type, CAST(h.i AS INTEGER) AS i, CAST(h.j AS INTEGER) AS j, CASE WHEN c.i IS NULL THEN 0 ELSE 1 END AS value FROM h LEFT JOIN c USING (object_type, i, j)")
def ct_padded_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parent relation of every skeleton on a grid of eight joints."""
    t = first_topology(spark, sf_dir)
    cells = S.joints(t).where("parent >= 0").select("object_type", F.col("joint").alias("i"), F.col("parent").alias("j"), F.lit(1).alias("value"))
    return C.padded_relation(cells, t.select("object_type"), LONGEST)


@query(
    f"""WITH {TOPOLOGY}, {FINITE}, x AS (SELECT object_type, joint, unnest(range(13)) AS channel, unnest(f) AS x FROM m), s AS (SELECT object_type, joint, channel, avg(x) AS mean, stddev_pop(x) AS std FROM x GROUP BY ALL),
g AS (SELECT object_type, unnest(range(8)) AS joint FROM topo), h AS (SELECT *, unnest(range(13)) AS channel FROM g)
SELECT h.object_type, CAST(h.joint AS INTEGER) AS joint, CAST(h.channel AS INTEGER) AS channel, round(coalesce(mean, 0), 5) + 0.0 AS mean, round(coalesce(std, 1), 5) + 0.0 AS std FROM h LEFT JOIN s USING (object_type, joint, channel)"""
)
def ct_padded_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = finite_motion(spark, sf_dir).select("object_type", "joint", F.posexplode("f").alias("channel", "x"))
    stats = rows.groupBy("object_type", "joint", "channel").agg(F.avg(F.col("x").cast("double")).alias("mean"), F.stddev_pop(F.col("x").cast("double")).alias("std"))
    out = C.padded_statistics(stats, first_topology(spark, sf_dir).select("object_type"), LONGEST)
    return out.withColumns({k: F.round(k, 5) + 0.0 for k in ("mean", "std")})


@query(
    f"""WITH {CLIP}, d AS (SELECT motion_id, CAST('0x' || substr(md5(motion_id || '|0'), 1, 8) AS BIGINT) % CASE WHEN object_type LIKE 'Thorn%' THEN 2 ELSE 3 END AS w, CAST('0x' || substr(md5(motion_id || '|0|share'), 1, 8) AS BIGINT) % 3 AS s FROM c WHERE object_type IS NOT NULL)
SELECT motion_id, CASE w WHEN 0 THEN 'none' WHEN 1 THEN 'remove' ELSE 'add' END AS way, CASE WHEN w = 1 THEN (s + 1) / 10.0 END AS share FROM d"""
)
def ct_augmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The augmentation drawn for each clip; some object_types are never given joints."""
    c = first_clip(spark, sf_dir).where("object_type is not null")
    return c.select("motion_id", C.augmentation(F.col("motion_id"), F.startswith("object_type", F.lit("Thorn"))).alias("a")).select("motion_id", "a.way", F.col("a.share").cast("double").alias("share"))


@query(
    f"""WITH {CLIP}, k AS (SELECT motion_id, n_frames AS length, n_joints, floor((row_number() OVER (ORDER BY motion_id) - 1) / 16) AS batch FROM c WHERE n_frames > 0 AND n_joints IS NOT NULL)
SELECT CAST(batch AS BIGINT) AS batch, string_agg(motion_id, ',' ORDER BY -length, motion_id) AS motion_ids, string_agg(length, ',' ORDER BY -length, motion_id) AS lengths, max(length) AS longest, max(n_joints) AS most_joints, CAST(sum(length) AS BIGINT) AS n_set FROM k GROUP BY batch"""
)
def ct_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of sixteen clips by name, each with its clips by length, and the number of places its masks set."""
    from stridelake.operators.hotkeys import dictionary

    clips = first_clip(spark, sf_dir).where("n_frames > 0 and n_joints is not null").select("motion_id", F.col("n_frames").alias("length"), "n_joints")
    numbered = clips.join(dictionary(clips, "motion_id").withColumnRenamed("key", "motion_id"), "motion_id").withColumn("batch", F.floor(F.col("id") / 16)).drop("id")
    out = C.collated(numbered, "batch", 16)
    n_set = F.aggregate("masks", F.lit(0).cast("bigint"), lambda a, m: a + F.aggregate(m, F.lit(0).cast("bigint"), lambda b, x: b + x))
    return out.select("batch", F.array_join("motion_ids", ",").alias("motion_ids"), F.array_join(F.col("lengths").cast("array<string>"), ",").alias("lengths"), "longest", "most_joints", n_set.alias("n_set"))


@query(f"WITH {CLIP} SELECT motion_id, CASE WHEN object_type IS NULL THEN -1 ELSE CAST(('0x' || substr(sha256(object_type), 61, 4))::BIGINT % 1024 AS BIGINT) END AS token, CASE WHEN object_type IS NULL THEN 0 ELSE 1 END AS mask, 1 AS null_size, 0 AS null_mask FROM c")
def ct_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each clip's object_type as one hashed token or the pad, and what is left of a condition made void."""
    token, mask = C.token_or_pad(F.col("object_type"), 1024, -1)
    value, void = C.nullified(F.array(token))
    return first_clip(spark, sf_dir).select("motion_id", token.cast("bigint").alias("token"), mask.alias("mask"), F.size(value).alias("null_size"), void[0].alias("null_mask"))


@query(f"SELECT file_id, 'pool/motions/' || {_NAME} AS motion, 'pool/bvhs/' || {_STEM} || '.bvh' AS skeleton, 'pool/animations/' || {_STEM} || '_from_ric.mp4' AS preview FROM clip_file")
def mf_pooled_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.pooled_paths(_files(spark, sf_dir), "path", "pool").select("file_id", "motion", "skeleton", "preview")


@query(
    r"""WITH n AS (SELECT motion_id, motion_id || CASE WHEN strlen(motion_id) % 4 = 0 THEN '_keypoints.json.txt' WHEN strlen(motion_id) % 4 = 1 THEN '_Keypoints.txt' WHEN strlen(motion_id) % 4 = 2 THEN '.json.txt' ELSE '.cap' END AS name FROM (SELECT DISTINCT motion_id FROM clip WHERE motion_id IS NOT NULL)) SELECT name, motion_id AS source_key FROM n"""
)
def mf_source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.octet_length("motion_id") % 4
    name = F.concat("motion_id", F.when(k == 0, "_keypoints.json.txt").when(k == 1, "_Keypoints.txt").when(k == 2, ".json.txt").otherwise(".cap"))
    return table(spark, sf_dir, "clip").select("motion_id").where("motion_id is not null").distinct().select(name.alias("name")).select("name", L.source_key(F.col("name")).alias("source_key"))


@query(
    f"""WITH {CLIP}, l AS (SELECT motion_id, object_type AS o, unnest(captions) AS cap, generate_subscripts(captions, 1) AS place FROM c), b AS (SELECT motion_id, o, place, trim(regexp_replace(cap, '\\s+', ' ', 'g')) AS cap FROM l WHERE trim(cap) <> ''),
f AS (SELECT motion_id, cap, min(place) AS place FROM b WHERE NOT contains(cap, '#') AND trim(cap) <> '' GROUP BY ALL)
SELECT motion_id AS source_key, string_agg(cap, '|' ORDER BY place) AS captions, CASE WHEN any_value(o) IS NULL OR trim(any_value(o)) = '' THEN '' ELSE trim(any_value(o)) END AS animals FROM f JOIN (SELECT motion_id, object_type AS o FROM c) USING (motion_id) GROUP BY motion_id"""
)
def mf_caption_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions written as lines of animal, sex, caption and tags and read again, one file per clip, by its key; captions with a field mark are left out."""
    c = first_clip(spark, sf_dir).select("motion_id", F.coalesce("object_type", F.lit("")).alias("o"), F.posexplode("captions").alias("place", "caption")).where("caption is not null and not contains(caption, '#')")
    lines = c.select(F.concat("motion_id", F.lit(".txt")).alias("path"), "place", F.concat_ws("#", "o", F.lit("any"), "caption", F.lit("")).alias("line"))
    records = L.last_by_key(L.caption_records(lines, "path", "place", "line"), F.col("source_key"), "path")
    return records.select("source_key", F.array_join("captions", "|").alias("captions"), F.array_join("animals", "|").alias("animals"))


@query(f"SELECT {_STEM} AS stem, max(path) AS path FROM clip_file GROUP BY 1")
def mf_stem_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.stem_index(_files(spark, sf_dir), "path")


@query(f"WITH {CLIP}, p AS (SELECT motion_id, object_type, motion_id || '.npy' AS path FROM c WHERE starts_with(motion_id, object_type || '_')) SELECT regexp_replace(substr(motion_id, length(object_type) + 2), '_[0-9]+$', '') AS raw_stem, array_to_string(list_sort(list_distinct(list(path))), ',') AS paths FROM p GROUP BY 1")
def mf_processed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = first_clip(spark, sf_dir).select("object_type", F.concat("motion_id", F.lit(".npy")).alias("path"))
    return L.processed_index(c, "path", "object_type").select("raw_stem", F.array_join("paths", ",").alias("paths"))


@query("WITH r AS (SELECT regexp_extract(path, '^([^/]+)/(.*)$', 1) AS root, regexp_extract(path, '^([^/]+)/(.*)$', 2) AS rest FROM clip_file) SELECT root, CASE WHEN bool_or(starts_with(rest, 'motions/')) THEN 'pooled' ELSE 'per_object' END AS kind, count(*) AS n_files FROM r WHERE root <> '' GROUP BY root")
def mf_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.layout_kind(_files(spark, sf_dir), "path")


@query(f"WITH k AS (SELECT motion_id, path, TRY_CAST(nullif(regexp_extract({_STEM}, '([0-9]+)$', 1), '') AS BIGINT) AS number FROM clip_file) SELECT motion_id, max_by(path, (number, path)) AS path, max(number) AS number FROM k WHERE number IS NOT NULL GROUP BY motion_id")
def mf_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.newest(_files(spark, sf_dir), "path", ["motion_id"])


@query(f"WITH {CLIP} SELECT motion_id, 'wanted' AS list FROM c WHERE object_type IN (SELECT object_name FROM object_index WHERE source_group = 'vendor_a') UNION ALL SELECT motion_id, 'rest' FROM c WHERE object_type IS NULL OR object_type NOT IN (SELECT object_name FROM object_index WHERE source_group = 'vendor_a' AND object_name IS NOT NULL)")
def mf_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips of the listed objects; and, with an empty list, all clips but those of excluded objects."""
    c = first_clip(spark, sf_dir).select("motion_id", "object_type")
    names = table(spark, sf_dir, "object_index").where("source_group = 'vendor_a' and object_name is not null").select("object_name")
    wanted = L.chosen(c, "object_type", names).select("motion_id", F.lit("wanted").alias("list"))
    return wanted.unionByName(L.chosen(c, "object_type", names.limit(0), names).select("motion_id", F.lit("rest").alias("list")))


@query(f"WITH {CLIP}, g AS (SELECT motion_id, object_type, nullif(regexp_extract(motion_id, '^(.*?)_[a-z]', 1), '') AS guess FROM c) SELECT motion_id, CASE WHEN object_type IS NOT NULL THEN object_type ELSE guess END AS owner, CASE WHEN object_type IS NOT NULL THEN 'manifest' WHEN guess IS NOT NULL THEN 'guess' ELSE 'none' END AS origin FROM g")
def mf_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owner of each clip: what its header says, else a guess from its name."""
    c = first_clip(spark, sf_dir).select("motion_id", "object_type")
    manifest = c.where("object_type is not null").select("motion_id", F.col("object_type").alias("owner"))
    return L.mapped(c.select("motion_id"), "motion_id", manifest, F.nullif(F.regexp_extract("motion_id", "^(.*?)_[a-z]", 1), F.lit("")))


@query(
    f"""WITH {CLIP}, r AS (SELECT object_type AS owner, motion_id, source_group AS grp, CASE WHEN regexp_matches(lower(motion_id), 'walk|run|turn|swimbase|idle') THEN 0 ELSE 1 END AS first FROM c WHERE object_type IS NOT NULL),
a AS (SELECT motion_id, min(path) AS asset FROM clip_file WHERE size_bytes > 300 GROUP BY 1), o AS (SELECT source_group AS grp, min(source_dir) AS spare FROM object_index WHERE object_name LIKE 'B%' AND source_group IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source_dir) = 1),
j AS (SELECT owner, r.motion_id, first, coalesce(asset, spare) AS asset, CASE WHEN asset IS NOT NULL THEN 'listed' ELSE 'inferred' END AS origin FROM r LEFT JOIN a USING (motion_id) LEFT JOIN o USING (grp) WHERE coalesce(asset, spare) IS NOT NULL)
SELECT owner, arg_min(motion_id, (first, motion_id)) AS motion_id, arg_min(asset, (first, motion_id)) AS asset, arg_min(origin, (first, motion_id)) AS origin FROM j GROUP BY owner"""
)
def mf_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per object_type the first clip, preferred actions first, that has a file of its own or whose group has a single source folder."""
    rows = first_clip(spark, sf_dir).where("object_type is not null").select(F.col("object_type").alias("owner"), "motion_id", F.col("source_group").alias("group"))
    assets = table(spark, sf_dir, "clip_file").where("size_bytes > 300").groupBy("motion_id").agg(F.min("path").alias("asset"))
    spare = table(spark, sf_dir, "object_index").where("object_name like 'B%'").select(F.col("source_group").alias("group"), F.col("source_dir").alias("asset"))
    return L.resolved(rows, ["motion_id"], assets, spare, [L.prefer_actions(F.col("motion_id")), F.col("motion_id")]).select("owner", "motion_id", "asset", "origin")


@query(f"WITH {CLIP} SELECT motion_id, regexp_matches(lower(motion_id), 'eat|drink|trough|graze|swimtreadwater|enrichment|idle|jumpin|jumpout') AS high_risk, CAST(CASE WHEN regexp_matches(lower(motion_id), 'walk|run|turn|swimbase|idle') THEN 0 ELSE 1 END AS INTEGER) AS priority FROM c")
def mf_action_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = first_clip(spark, sf_dir)
    return c.select("motion_id", L.any_token(F.col("motion_id"), L.HIGH_RISK).alias("high_risk"), L.prefer_actions(F.col("motion_id")).alias("priority"))


@query(f"WITH {CLIP} (SELECT motion_id, 'selected' AS list FROM c WHERE starts_with(motion_id, 'B') AND regexp_matches(motion_id, '(?i)WALK|graze') ORDER BY motion_id LIMIT 7) UNION ALL (SELECT motion_id, 'page' FROM c ORDER BY motion_id LIMIT 5 OFFSET 10) UNION ALL (SELECT motion_id, 'largest' FROM c WHERE n_frames IS NOT NULL ORDER BY n_frames DESC, motion_id LIMIT 6)")
def mf_selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selection by prefix and pattern, a page, and the largest as a sample: the limits are what these do."""
    c = first_clip(spark, sf_dir)
    parts = (("selected", L.selected(c, "motion_id", "B", "WALK|graze", 7)), ("page", L.page(c, "motion_id", 10, 5)), ("largest", L.largest_sample(c.where("n_frames is not null"), "n_frames", "motion_id", 6).where("sampled")))
    out = None
    for name, rows in parts:
        rows = rows.select("motion_id", F.lit(name).alias("list"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    f"""WITH {TOPOLOGY}, j AS (SELECT object_type, unnest(range(len(parents))) AS joint, lower(unnest(joints_names)) AS name, unnest(offsets) AS o FROM topo),
s AS (SELECT object_type, array_to_string(list_sort(list(joint)), ',') AS scale FROM j WHERE joint > 0 AND sqrt(o[1]**2 + o[2]**2 + o[3]**2) > 1e-8 AND regexp_matches(name, 'spine2|spine3|chest_joint|neck1|neck2|head_joint|frontlegupr_joint|frontleglwr_joint|frontfoot_joint|rearlegupr_joint|rearleglwr_joint|rearfoot_joint') AND NOT regexp_matches(name, 'end_site|twist|srb|breath') GROUP BY 1),
g AS (SELECT object_type, array_to_string(list_sort(list(joint)), ',') AS ground FROM j WHERE regexp_matches(name, 'toe|foot|hoof|ashi') GROUP BY 1)
SELECT object_type, CASE WHEN object_type LIKE 'B%' THEN coalesce(scale, '') END AS scale, CASE WHEN object_type LIKE 'B%' THEN coalesce(ground, '') END AS ground FROM (SELECT DISTINCT object_type FROM j) LEFT JOIN s USING (object_type) LEFT JOIN g USING (object_type)"""
)
def sk_declared_joints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.declared_joints(S.joints(first_topology(spark, sf_dir)), "B")
    return out.select("object_type", *(F.array_join(F.col(k).cast("array<string>"), ",").alias(k) for k in ("scale", "ground")))


@query(f"WITH {TOPOLOGY}, j AS (SELECT object_type, unnest(range(len(parents))) AS joint, unnest(joints_names) AS name FROM topo), a AS (SELECT *, CASE WHEN starts_with(name, 'spine_') THEN substr(name, 7) ELSE name END AS b FROM j) SELECT object_type, CAST(joint AS INTEGER) AS joint, CASE WHEN starts_with(b, 'fore_') THEN substr(b, 6) ELSE b END AS name FROM a")
def sk_bare_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.joints(first_topology(spark, sf_dir)).select("object_type", "joint", L.without_prefixes(F.col("name"), ["spine_", "fore_"]).alias("name"))


@query("WITH u AS (SELECT object_type AS owner, 0 AS part FROM clip UNION ALL SELECT object_type, 1 FROM topology UNION ALL SELECT object_name, 2 FROM object_index) SELECT owner, count(*) AS n_rows, count(DISTINCT part) AS n_parts FROM u GROUP BY owner")
def mf_manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [table(spark, sf_dir, "clip"), table(spark, sf_dir, "topology"), table(spark, sf_dir, "object_index").withColumnRenamed("object_name", "object_type")]
    return L.manifest_totals(parts, "object_type")


@query("WITH p AS (SELECT object_type, motion_id, CAST(f[1] AS DOUBLE) AS x, CAST(f[2] AS DOUBLE) AS y, CAST(f[3] AS DOUBLE) AS z FROM motion WHERE f IS NOT NULL AND object_type IS NOT NULL), k AS (SELECT *, coalesce(isfinite(x) AND isfinite(y) AND isfinite(z), false) AS fine FROM p) SELECT object_type, motion_id, count(*) AS n_points, bool_and(fine) AS finite, " + ", ".join(f"{'round(' if n == 'avg' else ''}{n}(CASE WHEN fine THEN {c} END){', 6) + 0.0' if n == 'avg' else ''} AS {'mean' if n == 'avg' else n}_{c}" for c in "xyz" for n in ("min", "max", "avg")) + " FROM k GROUP BY ALL")
def qa_vertex_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "motion").where("f is not null and object_type is not null").select("object_type", "motion_id", *(F.get("f", F.lit(i)).cast("double").alias(c) for i, c in enumerate("xyz")))
    return L.vertex_summary(points, ["object_type", "motion_id"], ("x", "y", "z")).withColumns({f"mean_{c}": F.round(f"mean_{c}", 6) + 0.0 for c in "xyz"})


@query(f"WITH {CLIP}, r AS (SELECT CASE WHEN source_frames IS NULL THEN 'unknown' WHEN source_frames = n_frames + 1 THEN 'pass' ELSE 'off' END AS status, CAST(abs(source_frames - n_frames) AS BIGINT) AS error FROM c) SELECT status, count(*) AS n_rows, max(error) AS max_error, (SELECT min(error) FROM r WHERE status = 'pass') AS least_passing, (SELECT max(error) FROM r WHERE status = 'pass') AS most_passing FROM r GROUP BY status")
def qa_audit_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips by whether their frames agree with the source's."""
    status = F.when(F.col("source_frames").isNull(), "unknown").when(F.col("source_frames") == F.col("n_frames") + 1, "pass").otherwise("off")
    rows = first_clip(spark, sf_dir).select(status.alias("status"), F.abs(F.col("source_frames") - F.col("n_frames")).cast("bigint").alias("error"))
    return L.audit_totals(rows, "status", "error")


@query(
    f"""WITH {CLIP}, s AS (SELECT motion_id, regexp_replace(motion_id, '_[0-9]+$', '') AS base FROM c), k AS (SELECT motion_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(motion_id), '[@.]+', '_', 'g'), '[^A-Za-z0-9_-]+', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g')) AS safe FROM s)
SELECT motion_id, CASE WHEN safe = '' THEN 'unnamed' ELSE safe END AS safe, trim(string_split(motion_id || ' # note # more', '#')[1]) AS said, regexp_matches(trim(split_part(motion_id, '_', -1)), '^[0-9]+$') AS numeric_end, regexp_matches(trim(coalesce(CAST(n_frames AS VARCHAR), '') || '.5'), '^[-+]?[0-9]+\\.[0-9]+$') AS float_text,
'00007_' || motion_id || '_' || left(md5('in/' || motion_id || '.npy'), 10) || '.jpg' AS preview, CAST(len(list_filter(range(64), lambda i: i < n_frames)) AS INTEGER) AS n_mask FROM k JOIN (SELECT motion_id, n_frames FROM c) USING (motion_id)"""
)
def mf_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names made safe, captions before a mark, texts that are numbers, preview names, and length masks by their number of set places."""
    c = first_clip(spark, sf_dir)
    mask = F.size(F.filter(T.length_mask(F.coalesce("n_frames", F.lit(0)), 64), lambda x: x))
    numeric = T.is_number_text(F.element_at(F.split("motion_id", "_"), -1))
    return c.select(
        "motion_id", T.safe_name(F.col("motion_id")).alias("safe"), T.before_hash(F.concat("motion_id", F.lit(" # note # more"))).alias("said"), numeric.alias("numeric_end"), T.is_float_text(F.concat(F.coalesce(F.col("n_frames").cast("string"), F.lit("")), F.lit(".5"))).alias("float_text"),
        T.preview_name(F.lit(7), F.concat(F.lit("in/"), "motion_id", F.lit(".npy"))).alias("preview"), mask.alias("n_mask"),
    )


@query(
    f"""WITH {CLIP}, s AS (SELECT motion_id, object_type AS o, lower(object_type) || '__animationmotionextracted' || coalesce(source_group, 'x') || '_' || 'maniset' || '__' || regexp_replace(motion_id, '_[0-9]+$', '') AS stem FROM c WHERE object_type IS NOT NULL AND regexp_matches(object_type, '^[A-Za-z_]+$'))
SELECT motion_id, stem, array_to_string(list_transform(string_split(split_part(stem, '__', 1), '_'), lambda p: upper(left(p, 1)) || substr(p, 2)), '_') AS object_key, split_part(stem, '__', 1) AS animal, regexp_replace(motion_id, '_[0-9]+$', '') AS action, stem AS from_caption_file, o AS owner FROM s"""
)
def mf_raw_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stems of raw files in three parts: found again from a caption file's name, taken apart, and as the key of their object."""
    c = first_clip(spark, sf_dir).where("object_type rlike '^[A-Za-z_]+$'")
    group = F.concat(F.lit("animationmotionextracted"), F.coalesce("source_group", F.lit("x")))
    base = T.without_counter(F.col("motion_id"))
    rows = c.select("motion_id", F.concat(F.lower("object_type"), F.lit("__"), group, F.lit("_maniset__"), base).alias("stem"), F.concat(F.lower("object_type"), F.lit("__"), group, F.lit(".maniset_"), base, F.lit("_keypoints.json.txt")).alias("file"), F.concat("object_type", F.lit("_"), base, F.lit("_3")).alias("key"), F.concat(F.lit("in/"), base, F.lit(".fbx")).alias("source"))
    parts = T.stem_parts(F.col("stem"))
    return rows.select("motion_id", "stem", T.object_key(F.col("stem")).alias("object_key"), parts["animal"].alias("animal"), parts["action"].alias("action"), T.raw_stem_of_caption_file(F.col("file")).alias("from_caption_file"), L.owner_of(F.col("key"), F.col("source")).alias("owner"))


QUERIES, ORACLE = query.queries, query.oracle
