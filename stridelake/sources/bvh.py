"""Animation files in BVH text: read to joints and frames, written from them.

The reader takes whole files (one row per file) and parses in Arrow batches; it is also a Spark data source
(``spark.dataSource.register(BvhDataSource)``, then ``spark.read.format("bvh").load(folder)``), one task per file.
End sites become joints named ``<parent>_end_site``, or as a ``#name:`` comment says, unless their offset is zero.
A zero-offset only child of the root that repeats it is merged into the root.  Angles are degrees about moving
axes in the order of the file's channels.  A file that cannot be parsed yields one row with ``error`` set; none is dropped.
"""

from __future__ import annotations

import glob as globbing
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FRAMES = "path string, frame int, joint int, name string, parent int, offset array<double>, pos array<double>, q array<double>, frame_time double, error string"


@dataclass
class Animation:
    names: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    offsets: list[list[float]] = field(default_factory=list)
    positions: np.ndarray | None = None  # frames x joints x 3
    rotations: np.ndarray | None = None  # frames x joints x 4, w first
    frame_time: float = 1 / 24


def _turn(axis: str, degrees: np.ndarray) -> np.ndarray:
    half = np.radians(degrees) / 2
    q = np.zeros((*degrees.shape, 4))
    q[..., 0] = np.cos(half)
    q[..., 1 + "XYZ".index(axis)] = np.sin(half)
    return q


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w, v = a[..., :1], a[..., 1:]
    x, u = b[..., :1], b[..., 1:]
    return np.concatenate([w * x - (v * u).sum(-1, keepdims=True), w * u + x * v + np.cross(v, u)], axis=-1)


def parse(text: str) -> Animation:
    out = Animation()
    channels: list[list[str]] = []
    stack: list[int] = []
    pending: tuple[str, bool] | None = None
    lines = iter(text.splitlines())
    for line in lines:
        words, _, note = line.strip().partition("#")
        words = words.split()
        if not words or words[0] == "HIERARCHY":
            continue
        if words[0] == "MOTION":
            break
        if words[0] in ("ROOT", "JOINT"):
            pending = (" ".join(words[1:]), False)
        elif words[0] == "End":
            label = note.partition("name:")[2].strip()
            pending = (label or f"{out.names[stack[-1]]}_end_site", True)
        elif words[0] == "{":
            name, end = pending or ("", False)
            out.names.append(name)
            out.parents.append(stack[-1] if stack else -1)
            out.offsets.append([0.0, 0.0, 0.0])
            channels.append([])
            stack.append(len(out.names) - 1)
            if end:
                channels[-1] = ["end"]
        elif words[0] == "}":
            at = stack.pop()
            if channels[at] == ["end"] and not any(out.offsets[at]):
                for column in (out.names, out.parents, out.offsets, channels):
                    del column[at]
        elif words[0] == "OFFSET":
            out.offsets[stack[-1]] = [float(x) for x in words[1:4]]
        elif words[0] == "CHANNELS":
            if int(words[1]) not in (3, 6):
                raise ValueError(f"{words[1]} channels are not supported")
            channels[stack[-1]] = words[2 : 2 + int(words[1])]
    count, values = 0, []
    for line in lines:
        words = line.split()
        if not words:
            continue
        if words[0] == "Frames:":
            count = int(words[1])
        elif words[0] == "Frame":
            out.frame_time = float(words[-1])
        else:
            values.append([float(x) for x in words])
    data = np.array(values, float).reshape(len(values), -1)
    if len(data) != count:
        raise ValueError(f"{count} frames announced, {len(data)} found")
    n = len(out.names)
    out.positions = np.tile(np.array(out.offsets, float).reshape(n, 3), (count, 1, 1))
    out.rotations = np.zeros((count, n, 4))
    out.rotations[..., 0] = 1
    at = 0
    for j, names in enumerate(channels):
        if names == ["end"]:
            continue
        for name in names:
            column = data[:, at]
            at += 1
            if name.endswith("position"):
                out.positions[:, j, "XYZ".index(name[0])] = column
            else:
                out.rotations[:, j] = multiply(out.rotations[:, j], _turn(name[0], column))
    if at != data.shape[1] and count:
        raise ValueError(f"{at} channels announced, {data.shape[1]} values a frame")
    return _without_twin_root(out)


def _without_twin_root(a: Animation) -> Animation:
    """Joint 1 at no distance from the root, its only child, becomes part of it."""
    if len(a.names) < 2 or any(a.offsets[1]) or a.parents.count(0) != 1:
        return a
    a.rotations[:, 1] = multiply(a.rotations[:, 0], a.rotations[:, 1])
    a.positions[:, 1] = a.positions[:, 0]
    keep = [j for j in range(len(a.names)) if j != 0]
    parents = [-1 if p == 0 else p - 1 for p in (a.parents[j] for j in keep)]
    return Animation([a.names[0], *[a.names[j] for j in keep[1:]]], parents, [a.offsets[0], *[a.offsets[j] for j in keep[1:]]], a.positions[:, keep], a.rotations[:, keep], a.frame_time)


def promoted_root(text: str) -> str:
    """The text without a wrapping root that has no channels and one child, which becomes the root."""
    lines = text.splitlines()
    heads = [i for i, x in enumerate(lines) if x.split()[:1] in (["ROOT"], ["JOINT"], ["MOTION"])]
    first, second = heads[0], heads[1]
    own = [x.split()[0] for x in lines[first:second] if x.split()]
    if "CHANNELS" in own and "0" not in [x.split()[1] for x in lines[first:second] if x.split()[:1] == ["CHANNELS"]] or not lines[second].split()[0] == "JOINT":
        return text
    motion = next(i for i, x in enumerate(lines) if x.strip() == "MOTION")
    depth, children = 0, 0
    for x in lines[first:motion]:
        depth += x.count("{") - x.count("}")
        children += depth == 1 and x.split()[:1] == ["JOINT"]
    if children != 1:
        return text
    last = max(i for i in range(first, motion) if lines[i].strip() == "}")
    body = [x[1:] if x.startswith("\t") else x.removeprefix("  ") for x in lines[second:last]]
    body[0] = body[0].replace("JOINT", "ROOT", 1)
    return "\n".join([*lines[:first], *body, *lines[motion:]]) + "\n"


def _angles(q: np.ndarray, order: str) -> np.ndarray:
    """Degrees about moving axes in ``order``."""
    w, x, y, z = np.moveaxis(q / np.linalg.norm(q, axis=-1, keepdims=True), -1, 0)
    m = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])
    i, j, k = ("XYZ".index(c) for c in order)
    s = 1.0 if (j - i) % 3 == 1 else -1.0
    pole = np.abs(m[i, k]) > 1 - 1e-9  # the first and third axis coincide: the third turn is taken as none
    first = np.where(pole, np.arctan2(s * m[k, j], m[j, j]), np.arctan2(-s * m[j, k], m[k, k]))
    third = np.where(pole, 0.0, np.arctan2(-s * m[i, j], m[i, i]))
    return np.degrees(np.stack([first, np.arcsin(np.clip(s * m[i, k], -1, 1)), third], axis=-1))


def render(a: Animation, order: str = "ZXY", positions: bool = False) -> str:
    """BVH text: six channels on the root, three elsewhere (six with ``positions``), end sites for joints named as such."""
    lines = ["HIERARCHY"]
    children: dict[int, list[int]] = {}
    for j, p in enumerate(a.parents):
        children.setdefault(p, []).append(j)
    end = {j for j in range(len(a.names)) if a.names[j].endswith("_end_site") and j not in children}
    visited: list[int] = []

    def joint(j: int, depth: int) -> None:
        tab = "\t" * depth
        if j in end:
            lines.extend([f"{tab}End Site #name: {a.names[j]}", tab + "{", f"{tab}\tOFFSET " + " ".join(f"{x:.9g}" for x in a.offsets[j]), tab + "}"])
            return
        visited.append(j)
        moving = [f"{c}position" for c in "XYZ"] if positions or a.parents[j] < 0 else []
        names = moving + [f"{c}rotation" for c in order]
        lines.extend([f"{tab}{'ROOT' if a.parents[j] < 0 else 'JOINT'} {a.names[j]}", tab + "{", f"{tab}\tOFFSET " + " ".join(f"{x:.9g}" for x in a.offsets[j]), f"{tab}\tCHANNELS {len(names)} " + " ".join(names)])
        for c in children.get(j, []):
            joint(c, depth + 1)
        lines.append(tab + "}")

    joint(0, 0)
    lines += ["MOTION", f"Frames: {len(a.rotations)}", f"Frame Time: {a.frame_time:.7f}"]
    angles = _angles(a.rotations, order)
    for t in range(len(a.rotations)):
        row: list[float] = []
        for j in visited:
            if positions or a.parents[j] < 0:
                row += a.positions[t, j].tolist()
            row += angles[t, j].tolist()
        lines.append(" ".join(f"{x:.9g}" for x in row))
    return "\n".join(lines) + "\n"


def _rows(path: str, text: str) -> Iterator[tuple]:
    try:
        a = parse(text)
    except (ValueError, IndexError, KeyError) as wrong:
        yield (path, None, None, None, None, None, None, None, None, f"{type(wrong).__name__}: {wrong}")
        return
    for t in range(len(a.rotations)):
        for j, name in enumerate(a.names):
            yield (path, t, j, name, a.parents[j], a.offsets[j], a.positions[t, j].tolist(), a.rotations[t, j].tolist(), a.frame_time, None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    listed = pa.list_(pa.float64())
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), listed, listed, listed, pa.float64(), pa.string()]
    names = ["path", "frame", "joint", "name", "parent", "offset", "pos", "q", "frame_time", "error"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def frames_of(files: DataFrame) -> DataFrame:
    """files: path, value (whole text).  One row per frame and joint, or one with the error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, text in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist()):
                yield _batch(list(_rows(path, text or "")))

    return files.select("path", "value").mapInArrow(run, FRAMES)


def read(spark: SparkSession, where: str) -> DataFrame:
    return frames_of(spark.read.text(where, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value"))


def texts_of(frames: DataFrame, key: str, order: str = "ZXY") -> DataFrame:
    """(key, value): one BVH text per clip, from rows (key, frame, joint, name, parent, offset, pos, q)."""

    def run(k: tuple, t: pa.Table) -> pa.Table:
        p = t.to_pandas().sort_values(["frame", "joint"])
        first = p[p["frame"] == p["frame"].min()]
        n, shape = len(first), p["frame"].nunique()
        a = Animation(first["name"].tolist(), first["parent"].tolist(), [list(x) for x in first["offset"]], np.array(p["pos"].tolist()).reshape(shape, n, 3), np.array(p["q"].tolist()).reshape(shape, n, 4))
        return pa.table({key: pa.array([k[0].as_py()], pa.string()), "value": [render(a, order)]})

    return frames.groupBy(key).applyInArrow(run, f"{key} string, value string")


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, where: str) -> None:
        self.where = where

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in sorted(globbing.glob(f"{self.where}/**/*.bvh", recursive=True))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.path, encoding="utf-8", errors="replace") as f:
            yield from _rows(partition.path, f.read())


class BvhDataSource(DataSource):
    """``spark.read.format("bvh").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "bvh"

    def schema(self) -> str:
        return FRAMES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])
