"""Joining and aligning manifests: prefix, suffix and candidate-key matches, statuses, best matches, and plans.

Prefix, suffix and substring conditions become equality joins on generated pieces of the longer side's names, so
no join compares every pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.functions import strings as T


def longest_prefix(names: DataFrame, name: str, known: DataFrame, key: str) -> DataFrame:
    """Each name with the longest known key it begins with (followed by ``_``); else what stands before its last ``_``."""
    parts = F.split(F.col(name), "_")
    # a name can begin with a key only where one of its underscores ends it
    begins = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "_"))
    pieces = names.select(name, F.explode(begins).alias("piece")).where(F.col("piece") != F.col(name))
    hit = pieces.join(known.select(F.col(key).alias("piece")).distinct(), "piece", "left_semi").groupBy(name).agg(F.max_by("piece", F.length("piece")).alias("found"))
    fallback = F.regexp_replace(F.col(name), "_[^_]*$", "")
    return names.join(hit, name, "left").select(name, F.coalesce("found", fallback).alias("object_name"), F.col("found").isNotNull().alias("by_key"))


def tiered_match(names: DataFrame, name: str, prefix: str, stems: DataFrame, stem: str, place: str) -> DataFrame:
    """Each name with the stem it belongs to: 1 the name without ``prefix`` and counter, 2 a stem that ends the name without its counter, 3 a stem anywhere in it; within a tier the first stem by ``place``."""
    keys = stems.select(F.col(stem).alias("s"), F.col(place).alias("p")).where("s is not null and s <> ''").groupBy("s").agg(F.min("p").alias("p"))
    base = F.regexp_replace(F.col(name), "_[0-9]+$", "")
    rows = names.select(name, F.col(prefix).alias("pre"), base.alias("base"), F.col(name).rlike("_[0-9]+$").alias("counted"))
    direct = F.when(F.col("counted") & F.startswith(F.col(name), F.concat(F.col("pre"), F.lit("_"))), F.expr(f"substring(base, length(pre) + 2)"))  # noqa: F541
    one = rows.select(name, direct.alias("s")).join(keys, "s").select(name, F.lit(1).alias("tier"), "s", "p")
    left = rows.join(one.select(name), name, "left_anti")
    ends = left.where("counted").select(name, F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("base"), F.lit(1))), lambda i: F.expr("base").substr(i, F.length("base")))).alias("s"))
    two = ends.join(keys, "s").select(name, F.lit(2).alias("tier"), "s", "p")
    left = left.join(two.select(name).distinct(), name, "left_anti")
    # a stem can only be where its first two letters are, and as long as stems with those letters are
    heads = keys.groupBy(F.substring("s", 1, 2).alias("head")).agg(F.collect_set(F.length("s")).alias("lengths"))
    starts = left.select(name, F.explode(F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1)))).alias("i"))
    starts = starts.withColumn("head", F.explode(F.array_distinct(F.array(F.col(name).substr(F.col("i"), F.lit(1)), F.col(name).substr(F.col("i"), F.lit(2))))))
    inside = starts.join(heads, "head").select(name, F.explode(F.transform(F.filter("lengths", lambda n: F.col("i") + n - 1 <= F.length(name)), lambda n: F.col(name).substr(F.col("i"), n))).alias("s")).distinct()
    three = inside.join(keys, "s").select(name, F.lit(3).alias("tier"), "s", "p")
    best = one.unionByName(two).unionByName(three).groupBy(name).agg(F.min_by(F.struct("tier", "s"), F.struct("tier", "p", "s")).alias("b"))
    return names.select(name).join(best, name, "left").select(name, F.col("b.tier").alias("tier"), F.col("b.s").alias("stem"))


def candidate_match(rows: DataFrame, key: str, candidates: list[Column], texts: DataFrame, text_key: str, text: str) -> DataFrame:
    """Each row with the text of the first of its candidate keys that has one; keys compare by letters and digits."""
    index = texts.select(T.norm_key(F.col(text_key)).alias("k"), F.col(text).alias("text")).where("k <> '' and text is not null").groupBy("k").agg(F.min("text").alias("text"))
    asked = rows.select(key, F.posexplode(F.array_compact(F.array(*candidates))).alias("place", "candidate")).withColumn("k", T.norm_key(F.col("candidate")))
    hit = asked.join(index, "k").groupBy(key).agg(F.min_by(F.struct("candidate", "text"), "place").alias("m"))
    return rows.select(key).join(hit, key, "left").select(key, F.col("m.candidate").alias("match_key"), F.col("m.text").alias("text"), F.when(F.col("m").isNull(), "missing_text").otherwise("matched").alias("status"))


def alignment_status(rows: DataFrame, raw: DataFrame, raw_key: str, processed: DataFrame, key: str) -> DataFrame:
    """Rows against raw sources and processed files: matched (one file), missing or duplicate, with ``missing_raw`` where the source is unknown."""
    n = processed.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_processed"))
    have = raw.select(F.col(raw_key)).where(F.col(raw_key).isNotNull()).distinct().withColumn("raw", F.lit(True))
    out = rows.join(n, key, "left").join(have, raw_key, "left").withColumn("n_processed", F.coalesce("n_processed", F.lit(0).cast("bigint")))
    status = F.when(F.col("n_processed") == 1, "matched").when(F.col("n_processed") == 0, "missing_processed").otherwise("duplicate_processed")
    full = F.when(F.col("raw").isNotNull(), status).when(F.col("n_processed") == 1, "missing_raw").otherwise(F.concat(status, F.lit("+missing_raw")))
    return out.select(key, raw_key, "n_processed", full.alias("status"))


def best_alias(targets: DataFrame, candidates: DataFrame, name: str, animal: Column, kind: Column) -> DataFrame:
    """For each target the candidate of the same animal that fits best: same name, same kind, same family of kinds, then by name."""
    family = lambda k: F.lower(F.regexp_replace(k, "[^A-Za-z]", ""))
    t = targets.select(F.col(name).alias("target"), animal.alias("animal"), kind.alias("tk"))
    c = candidates.select(F.col(name).alias("source"), animal.alias("animal"), kind.alias("ck"))
    score = F.struct((F.col("target") != F.col("source")).cast("int").alias("exact"), (F.col("tk") != F.col("ck")).cast("int").alias("kind"), (family(F.col("tk")) != family(F.col("ck"))).cast("int").alias("family"), F.col("source"))
    return t.join(c, "animal").groupBy("target").agg(F.min(score).alias("s"), F.count(F.lit(1)).alias("n_candidates")).select("target", "s.source", F.col("s.exact").alias("differs"), "n_candidates")


def name_mapping(small: DataFrame, full: DataFrame) -> DataFrame:
    """Joints of a small skeleton found by name in a full one (object_type, joint, parent, name): full joint, and whether the bone to the parent is the same one."""
    a = small.select("object_type", "name", F.col("joint").alias("j"), F.col("parent").alias("p"))
    b = full.select("object_type", "name", F.col("joint").alias("fj"), F.col("parent").alias("fp"))
    m = a.join(b, ["object_type", "name"], "left")
    parent = m.select("object_type", F.col("j").alias("p"), F.col("fj").alias("mapped_parent"))
    out = m.join(parent, ["object_type", "p"], "left")
    return out.select("object_type", "name", "j", "fj", F.when(F.col("fj").isNull(), "missing").when(F.coalesce(F.col("mapped_parent"), F.lit(-1)) == F.col("fp"), "same bone").otherwise("other bone").alias("state"))


def both_ways(expected: DataFrame, reported: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: (key, side)."""
    a, b = (x.select(key).where(F.col(key).isNotNull()).distinct() for x in (expected, reported))
    return a.join(b, key, "left_anti").withColumn("side", F.lit("not reported")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("not expected")))


def part_checksums(files: DataFrame, part_bytes: int) -> DataFrame:
    """SHA-256 of each file and of its parts of a fixed number of bytes."""
    data = files.select("file_id", F.encode("payload", "UTF-8").alias("d"), F.sha2(F.encode("payload", "UTF-8"), 256).alias("whole")).where("d is not null")
    n = F.greatest(F.ceil(F.octet_length("d") / part_bytes), F.lit(1)).cast("int")
    parts = data.select("file_id", "whole", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.sha2(F.col("d").substr(i * part_bytes + 1, F.lit(part_bytes)), 256))).alias("part", "checksum"))
    return parts


def rest_clip(clips: DataFrame) -> DataFrame:
    """One clip per source to take the rest pose from: a name with ``rest`` or ``tpos`` first, then idling ones, then the first by name."""
    low = F.lower("motion_id")
    rank = F.when(low.rlike("rest_pose|tpos"), 0).when(low.rlike("idle"), 1).otherwise(2)
    best = F.min(F.struct(rank.alias("choice"), "motion_id"))
    return clips.where("object_type is not null").groupBy("object_type").agg(best.alias("b")).select("object_type", "b.motion_id", "b.choice")


def copy_plan(files: DataFrame, root: str) -> DataFrame:
    """Where each file would go in one pooled folder, and how: skip temporary ones, copy clashing ones under their id, link the rest."""
    name = F.regexp_replace("path", r"^.*/([^/]+)/([^/]+)$", "$1.$2")
    w = W.partitionBy("name")
    rows = files.select("file_id", "path", name.alias("name")).withColumn("n", F.count(F.lit(1)).over(w)).withColumn("k", F.row_number().over(w.orderBy("file_id")))
    how = F.when(F.col("path").rlike(r"\.tmp\."), "skip").when(F.col("k") > 1, "copy").otherwise("link")
    target = F.concat(F.lit(root + "/"), F.when(how == "copy", F.concat(F.col("file_id").cast("string"), F.lit("_"), F.col("name"))).otherwise(F.col("name")))
    return rows.select("file_id", how.alias("action"), F.when(how != "skip", target).alias("target"))
