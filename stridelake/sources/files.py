"""Feature tensors, caption texts, manifests and logs: readers and writers."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = "path string, frame int, joint int, f array<float>, error string"
CAPTIONS = "path string, line_no int, species string, gender string, caption string, tokens string, f_tag string, to_tag string, parse_status string"


def features_of(files: DataFrame) -> DataFrame:
    """files: path, content (.npy bytes of a [frames, joints, 13] tensor).  One row per frame and joint, or one with the error; nothing is unpickled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                error, x = None, np.zeros((0, 0, 13), np.float32)
                try:
                    x = np.load(io.BytesIO(content), allow_pickle=False)
                    if x.ndim != 3 or x.shape[2] != 13:
                        error, x = f"shape {x.shape}", np.zeros((0, 0, 13), np.float32)
                except (ValueError, OSError, EOFError) as wrong:
                    error = f"{type(wrong).__name__}: {wrong}"
                t, j = np.meshgrid(np.arange(x.shape[0]), np.arange(x.shape[1]), indexing="ij")
                if error:
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([None], pa.int32()), pa.array([None], pa.int32()), pa.array([None], pa.list_(pa.float32())), pa.array([error])], names=["path", "frame", "joint", "f", "error"])
                    continue
                flat = pa.array(x.astype(np.float32).ravel())
                f = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, 13), pa.int32()), flat)
                n = t.size
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(t.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), f, pa.nulls(n, pa.string())], names=["path", "frame", "joint", "f", "error"])

    return files.select("path", "content").mapInArrow(run, FEATURES)


def read_features(spark: SparkSession, where: str) -> DataFrame:
    return features_of(spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").option("recursiveFileLookup", "true").load(where))


def tensors_of(motion: DataFrame) -> DataFrame:
    """(motion_id, content): the .npy bytes of each clip, frames and joints in order; joints that a frame lacks are 0."""

    def run(k: tuple, t: pa.Table) -> pa.Table:
        frame, joint = t.column("frame").to_numpy(), t.column("joint").to_numpy()
        _, at = np.unique(frame, return_inverse=True)
        x = np.zeros((at.max() + 1, joint.max() + 1, 13), np.float32)
        x[at, joint] = np.array(t.column("f").to_pylist(), np.float32)
        out = io.BytesIO()
        np.save(out, x, allow_pickle=False)
        return pa.table({"motion_id": pa.array([k[0].as_py()], pa.string()), "content": pa.array([out.getvalue()], pa.binary())})

    return motion.select("motion_id", "frame", "joint", "f").groupBy("motion_id").applyInArrow(run, "motion_id string, content binary")


def caption_lines(files: DataFrame) -> DataFrame:
    """files: path, value (whole text), lines ``species#gender#caption#tokens#from#to``; fewer than three fields are marked, later ones have defaults."""
    lines = files.select("path", F.posexplode(F.split("value", "\r\n|\r|\n")).alias("at", "line")).where(F.trim("line") != "")
    p = F.split(F.trim("line"), "#")
    field = lambda i, default: F.coalesce(F.trim(F.get(p, F.lit(i))), F.lit(default))
    ok = F.size(p) >= 3
    names = [("species", 0, None), ("gender", 1, None), ("caption", 2, None), ("tokens", 3, ""), ("f_tag", 4, "0.0"), ("to_tag", 5, "0.0")]
    return lines.select("path", (F.col("at") + 1).alias("line_no"), *(F.when(ok, field(i, d)).alias(n) for n, i, d in names), F.when(ok, "ok").otherwise("bad_text_line").alias("parse_status"))


KEY_NAMES = ("id", "motion_id", "motion", "motion_name", "file", "file_name", "name")  # fixed values: names a record's key may have
TEXT_NAMES = ("texts", "captions", "caption", "text", "description")  # and its texts


def json_texts(lines: DataFrame, fallback: Column | None = None) -> DataFrame:
    """lines: value (one JSON record each).  key and texts by the first name that holds one; a list of texts or a single one."""
    v = F.col("value")
    at = lambda n: F.nullif(F.get_json_object(v, f"$.{n}"), F.lit(""))
    key = F.coalesce(*(at(n) for n in KEY_NAMES), fallback if fallback is not None else F.lit(None))
    text = F.coalesce(*(F.nullif(at(n), F.lit("[]")) for n in TEXT_NAMES))
    many = F.when(F.startswith(text, F.lit("[")), F.from_json(text, "array<string>")).otherwise(F.array(text))
    return lines.select(key.alias("key"), F.filter(many, lambda x: F.trim(x) != "").alias("texts")).where("key is not null")


def text_index(*sources: DataFrame) -> DataFrame:
    """key, texts of several sources together: keys by letters and digits, texts without repeats in the order of sources."""
    from stridelake.functions.strings import norm_key

    rows = None
    for i, s in enumerate(sources):
        part = s.select(norm_key(F.col("key")).alias("key"), F.lit(i).alias("source"), F.posexplode("texts").alias("place", "text"))
        rows = part if rows is None else rows.unionByName(part)
    first = rows.where("key <> '' and trim(text) <> ''").groupBy("key", "text").agg(F.min(F.struct("source", "place")).alias("o"))
    return first.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "text"))), lambda x: x["text"]).alias("texts"))


def frames_in_metadata(value: Column) -> Column:
    """Number behind ``total frames:``, first hit, 0 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(value, r"total frames:\s*(\d+)", 1), F.lit("")).cast("int"), F.lit(0))


def by_file(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One JSON text per key, of equal keys the last by ``order``: key, record."""
    record = F.to_json(F.struct(*[c for c in rows.columns if c not in (key, order)]))
    return rows.groupBy(key).agg(F.max_by(record, order).alias("record"))


def with_summary(rows: DataFrame, status: str) -> DataFrame:
    """Counts per status beside the total, as a table to write next to the rows."""
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("n")).unionByName(rows.agg(F.lit("total").alias(status), F.count(F.lit(1)).alias("n")))


def write_rows(rows: DataFrame, where: str, kind: str) -> None:
    """json, csv (with a header; nested columns as JSON) or parquet."""
    if kind == "csv":
        flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in rows.dtypes]
        rows.select(*flat).write.option("header", "true").option("escape", '"').csv(where)
    elif kind == "json":
        rows.write.option("ignoreNullFields", "false").json(where)
    else:
        rows.write.parquet(where)


def log_rows(pairs: dict[str, float], step: int) -> str:
    """One progress record as a JSON line."""
    return json.dumps({"step": step, **{k: float(v) for k, v in pairs.items()}}, ensure_ascii=False, sort_keys=True)
