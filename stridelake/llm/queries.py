"""Queries of the training-data problems over the project's tables, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import leakage, packing, splits, truncation
from stridelake.scratch import table

SPLIT_NAMES = {"train": "train", "training": "train", "val": "val", "valid": "val", "validation": "val", "test": "test", "testing": "test"}


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct clips by their first delivery, with the delivered split under its common name."""
    clip = table(spark, sf_dir, "clip")
    name = F.lower(F.regexp_replace("split", r"^\s+|\s+$", ""))
    common = F.create_map(*[F.lit(x) for kv in SPLIT_NAMES.items() for x in kv])[name]
    first = clip.groupBy("motion_id").agg(F.min_by(F.struct("object_type", "split", "source_group", "n_frames"), F.struct(F.col("ingested_at").isNull(), "ingested_at", "object_type", "split")).alias("r"))
    return first.where("motion_id is not null").select("motion_id", "r.*").withColumn("delivered", common).withColumn("length", F.least(F.floor(F.col("n_frames") / 16), F.lit(4)))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.out_of_home(_clips(spark, sf_dir), "motion_id", "object_type", "delivered", ["source_group", "length"]).select(F.col("record").alias("motion_id"))


def p2_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct clip with its component and its split, near 80/10/10 and stratified by source group and length."""
    return splits.split_records(_clips(spark, sf_dir), "motion_id", ["object_type"], ["source_group", "length"]).select(F.col("record").alias("motion_id"), "component", "split")


def p2_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per object_type: its distinct clips, the splits they were assigned to, and whether the whole assignment is within one point of 80/10/10."""
    placed = splits.split_records(_clips(spark, sf_dir), "motion_id", ["object_type"], ["source_group", "length"])
    shares = placed.groupBy().agg(*(F.avg((F.col("split") == s).cast("int")).alias(s) for s in splits.TARGETS))
    near = [F.abs(F.col(s) - share) <= 0.01 for s, share in splits.TARGETS.items()]
    near = shares.select((near[0] & near[1] & near[2]).alias("near"))
    kept = placed.join(_clips(spark, sf_dir).select(F.col("motion_id").alias("record"), "object_type"), "record").groupBy("object_type")
    return kept.agg(F.count(F.lit(1)).alias("n_clips"), F.count_distinct(F.when(F.col("object_type").isNotNull(), F.col("split"))).alias("n_splits")).join(F.broadcast(near))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents")).where("n_pieces > 1").select("doc_id").distinct()


def p6_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"))


def p6_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per text what its containers hold of it: tokens, pieces, and whether no container of it is over-full or holds two texts at one place."""
    places = packing.pack_texts(table(spark, sf_dir, "documents"))
    fill = places.groupBy("container_id").agg((F.sum("n_tokens") <= packing.CAPACITY).alias("fits"), (F.sum("n_tokens") == F.max(F.col("at") + F.col("n_tokens"))).alias("apart"))
    return places.join(fill, "container_id").groupBy("doc_id", "version").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_pieces"), F.min(F.col("fits") & F.col("apart")).alias("in_place")).drop("version")


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per tier: containers, tokens and the share of space that stays unused."""
    fill = packing.container_fill(packing.pack_texts(table(spark, sf_dir, "documents")))
    return fill.groupBy("tier").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n_tokens").alias("n_tokens"), F.round(1 - F.sum("n_tokens") / (F.lit(packing.CAPACITY) * F.count(F.lit(1))), 6).alias("unused"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


def p7_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.near_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(table(spark, sf_dir, "documents"))


def p8_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.source_shares(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_assigned, p2_kept, p6_found, p6_places, p6_texts, p6_fill, p7_found, p7_near, p8_found, p8_sources)}

ORACLE = {
    "p2_found": r"""
WITH c AS (SELECT motion_id, arg_min(coalesce(object_type, '~~'), ingested_at) AS o, arg_min(coalesce(split, '~~'), ingested_at) AS s FROM clip GROUP BY motion_id),
n AS (SELECT motion_id, o, CASE lower(regexp_replace(s, '^\s+|\s+$', '', 'g')) WHEN 'train' THEN 'train' WHEN 'training' THEN 'train' WHEN 'val' THEN 'val' WHEN 'valid' THEN 'val' WHEN 'validation' THEN 'val' WHEN 'test' THEN 'test' WHEN 'testing' THEN 'test' END AS s FROM c WHERE o <> '~~'),
k AS (SELECT o, s, count(*) AS n FROM n WHERE s IS NOT NULL GROUP BY ALL),
h AS (SELECT o, arg_max(s, n) AS home FROM k GROUP BY o)
SELECT motion_id FROM n JOIN h USING (o) WHERE s <> home""",
    "p2_kept": """
WITH c AS (SELECT motion_id, arg_min(coalesce(object_type, '~~'), ingested_at) AS o FROM clip WHERE motion_id IS NOT NULL GROUP BY motion_id)
SELECT nullif(o, '~~') AS object_type, count(*) AS n_clips, CASE WHEN o = '~~' THEN 0 ELSE 1 END AS n_splits, true AS near FROM c GROUP BY o""",
    "p6_texts": "SELECT doc_id, octet_length(encode(text)) + 1 AS n_tokens, CAST(ceil((octet_length(encode(text)) + 1) / 4096) AS BIGINT) AS n_pieces, true AS in_place FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)",
    "p6_found": "SELECT DISTINCT doc_id FROM documents WHERE octet_length(encode(text)) + 1 > 4096",
}
