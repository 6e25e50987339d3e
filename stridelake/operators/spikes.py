"""Implausible readings of per-joint motion channels, measured against their source.

A source is an ``object_type`` exactly as written.  The operator runs in these passes:

1. *Pack.*  ``mapInArrow`` turns runs of input rows into compressed fragments keyed by (source, bucket).
   Sources of more than ``BUCKET_ROWS`` rows are split by a hash of the series (clip and joint) into buckets of about
   that size, so that one source with a third of all rows spreads over many tasks.  Only the fragments are shuffled, once.
2. *Summarise.*  Each (source, bucket) sorts its series, drops repeated rows, writes blocks of about
   ``BLOCK`` readings rows and condenses every joint and channel to points of equal rank.  Summaries are merged
   in groups of at most ``FAN_IN``, in as many levels as it takes.
3. *Refine.*  Where points stand for more than one value, they only bracket the medians, with a proven rank error; the
   blocks are read again, values below the brackets are counted and those inside handed on, which gives the medians exactly.
4. *Score.*  Per source an isolation forest is grown on a bounded hash sample.  Each block meets its source's forest: every
   reading gets the four features and a score, and the candidates of forest and physical limits pass an exact check of the rules.

The forest is one over all four features (level, difference, seasonal, run length) of a reading, scaled by its joint
and channel.  Each source draws ``CUTS`` cuts per feature at random, one in each equal part of the range of its sample (on a logarithmic scale,
widened to twice the feature's limit), and every node of a tree picks a feature and one of the cuts within its range at
random; as ranges are those of the node and not of its sample, readings beyond all of the sample part early.  A leaf is then a box of cells between cuts, so the mean path of all trees is one table and scoring a reading is
four binary searches and a look-up.  The threshold for candidates is the lowest score the forest gives any cell
that reaches beyond a rule's limit, so no reading that breaks a limit can be missed, and the exact check only removes.
The rules define the cases; the scores rank all readings (``scored_readings``, ``score_report``).

Defined results: null ``object_type``, ``motion_id``, ``frame``, ``joint`` or ``f`` puts a row outside;
a null or absent element of ``f`` is no reading; repeated rows count once; two different rows of one
frame and joint are both judged and break the run of neighbours between them; an empty table gives
no rows; further columns are ignored.  The readings of one clip and joint stay together in one task.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.scratch import lookup, stored

CHANNELS = 13
LEVEL_CHANNELS = (0, 1, 2, 9, 10, 11)
ROOT_LEVEL_CHANNELS = (1, 9, 11)
BLOCK = 8192
BATCH_ROWS = 60_000
BUCKET_ROWS = 200_000
EXACT_VALUES = 8_192
SUMMARY_POINTS = 4_096
FAN_IN = 64
SAMPLE_READINGS = 1_024
TREES = 24
TREE_SAMPLE = 64
TREE_DEPTH = 10
CUTS = 15
SEASON = 20
FEATURES = ("level", "difference", "seasonal", "run")
LIMITS = (10.0, 5.0, np.inf, 10.0)  # the rules' limits; the seasonal feature has no rule
SEASONAL_RANGE = 20.0
LARGEST = 1e6
SCORE_BINS = 1_000
NO_READING = np.uint32(0x7FC0DEAD)  # a NaN of its own marks an absent element

FRAGMENT = "object_type string, bucket int, motion_ids array<string>, part binary"
BLOCK_SCHEMA = "kind string, object_type string, bucket int, joint int, motion_ids array<string>, part binary"
MODEL = "object_type string, model binary"
STATS = "object_type string, joint int, stats binary"
SUMMARY = "object_type string, joint int, share int, part binary"
BRACKETS = "object_type string, joint int, exact boolean, stats binary"


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        head = f"{name};{a.dtype.str};{','.join(map(str, a.shape))}".encode()
        out.write(len(head).to_bytes(4, "little") + a.nbytes.to_bytes(8, "little") + head + a.tobytes())
    return out.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    out, at = {}, 0
    while at < len(data):
        n, size = int.from_bytes(data[at : at + 4], "little"), int.from_bytes(data[at + 4 : at + 12], "little")
        name, kind, shape = data[at + 12 : at + 12 + n].decode().split(";")
        at += 12 + n
        dims = tuple(int(x) for x in shape.split(",") if x)
        out[name] = np.frombuffer(data, np.dtype(kind), size // np.dtype(kind).itemsize, at).reshape(dims)
        at += size
    return out


def _readings(column: pa.Array) -> np.ndarray:
    """``f`` as an (n, 13) float32 matrix; absent elements carry NO_READING."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float32, copy=True)
    if flat.null_count:
        values.view(np.uint32)[np.asarray(flat.is_null())] = NO_READING
    if len(lengths) and (lengths == CHANNELS).all():
        return values.reshape(-1, CHANNELS)
    out = np.empty((len(lengths), CHANNELS), np.float32)
    out.view(np.uint32)[:] = NO_READING
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    for i, (s, n) in enumerate(zip(starts, lengths)):
        out[i, : min(n, CHANNELS)] = values[s : s + min(n, CHANNELS)]
    return out


def _split_bytes(f: np.ndarray) -> bytes:
    """Readings by channel and by byte of their value, a form that compresses well."""
    return np.ascontiguousarray(np.ascontiguousarray(f).view(np.uint8).reshape(*f.shape, 4).transpose(0, 2, 1)).tobytes()


def _joined_bytes(data: bytes | memoryview, n: int) -> np.ndarray:
    """(13, n) readings."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(CHANNELS, 4, n).transpose(0, 2, 1)).view(np.float32).reshape(CHANNELS, n)


def _fragments(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(held).combine_chunks()
    source = t.column("object_type").combine_chunks().dictionary_encode()
    clip = t.column("motion_id").combine_chunks().dictionary_encode()
    sources, clips = source.dictionary.to_pylist(), clip.dictionary.to_pylist()
    s, m = source.indices.to_numpy(), clip.indices.to_numpy()
    frame, joint, split = (t.column(k).to_numpy() for k in ("frame", "joint", "split"))
    f = _readings(t.column("f").combine_chunks())
    mixed = np.array([zlib.crc32(x.encode()) for x in clips], dtype=np.int64)
    b = (mixed[m] + joint.astype(np.int64) * 2_654_435_761) % 4_294_967_291 % split
    order = np.lexsort((frame, joint, m, b, s))
    s, m, b, frame, joint, f = s[order], m[order], b[order], frame[order], joint[order], f[order]
    bits = f.view(np.uint32)
    same = (s[1:] == s[:-1]) & (m[1:] == m[:-1]) & (frame[1:] == frame[:-1]) & (joint[1:] == joint[:-1])
    same &= (bits[1:] == bits[:-1]).all(axis=1)
    keep = np.concatenate([[True], ~same])
    s, m, b, frame, joint, f = s[keep], m[keep], b[keep], frame[keep], joint[keep], f[keep]
    cuts = np.flatnonzero((s[1:] != s[:-1]) | (b[1:] != b[:-1])) + 1
    rows: list[tuple] = []
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(s)]):
        used, local = np.unique(m[lo:hi], return_inverse=True)
        readings = pa.compress(_split_bytes(f[lo:hi].T), codec="zstd", asbytes=True)
        part = _packed(m=local.astype(np.int32), j=joint[lo:hi].astype(np.int32), t=frame[lo:hi].astype(np.int32), f=np.frombuffer(readings, np.uint8))
        rows.append((sources[s[lo]], int(b[lo]), [clips[x] for x in used], part))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.string())), pa.array([r[3] for r in rows], pa.binary())],
        names=["object_type", "bucket", "motion_ids", "part"],
    )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(x.num_rows for x in held) >= BATCH_ROWS:
            yield _fragments(held)
            held = []
    if held:
        yield _fragments(held)


def _level_channels(joint: int) -> tuple[int, ...]:
    return ROOT_LEVEL_CHANNELS if joint == 0 else LEVEL_CHANNELS


def _raw_features(x: np.ndarray, t: np.ndarray, sid: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of one channel: finite flags, change to the frame before (NaN without), one-sided spike height, seasonal residual, run length."""
    n = len(x)
    finite = np.isfinite(x)
    joined = np.zeros(n, bool)
    joined[1:] = (sid[1:] == sid[:-1]) & (t[1:] == t[:-1] + 1) & finite[1:] & finite[:-1]
    change = np.full(n, np.nan)
    at = np.flatnonzero(joined)
    change[at] = x[at] - x[at - 1]
    ahead = np.full(n, np.nan)
    ahead[:-1] = -change[1:]
    with np.errstate(invalid="ignore"):
        spike = np.where((change > 0) & (ahead > 0) | (change < 0) & (ahead < 0), np.minimum(np.abs(change), np.abs(ahead)), 0.0)
    starts = ~(joined & (change == 0))
    run_id = np.cumsum(starts) - 1
    run = np.bincount(run_id, minlength=run_id[-1] + 1 if n else 0)[run_id] if n else np.zeros(0, int)
    phase = sid.astype(np.int64) * SEASON + np.mod(t, SEASON)
    clean = np.where(finite, x, 0.0)
    size = int(phase.max()) + 1 if n else 0
    total, count = np.bincount(phase, clean, size), np.bincount(phase, finite.astype(float), size)
    expected = np.divide(total, count, out=np.zeros(size), where=count > 0)
    seasonal = np.where(finite & (count[phase] > 1), np.abs(x - expected[phase]), 0.0)
    return finite, change, spike, seasonal, run


def _condense(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values with weights (none: each counts once): all of them up to EXACT_VALUES, else points of equal rank, each for the values around it."""
    values = np.sort(values)
    if len(values) <= EXACT_VALUES:
        return values, np.ones(0)
    at = ((np.arange(SUMMARY_POINTS) + 0.5) * len(values) / SUMMARY_POINTS).astype(np.int64)
    return values[at], np.full(SUMMARY_POINTS, len(values) / SUMMARY_POINTS)


def _condense_again(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    if len(values) <= EXACT_VALUES:
        return values, np.ones(0) if (weights == 1).all() else weights
    c = np.cumsum(weights)
    at = np.searchsorted(c, (np.arange(SUMMARY_POINTS) + 0.5) * c[-1] / SUMMARY_POINTS)
    return values[np.minimum(at, len(values) - 1)], np.full(SUMMARY_POINTS, c[-1] / SUMMARY_POINTS)


def _weighted(parts: list[dict[str, np.ndarray]], values: str, weights: str) -> tuple[np.ndarray, np.ndarray]:
    pairs = [(p[values].astype(np.float64), p[weights].astype(np.float64)) for p in parts]
    return np.concatenate([v for v, _ in pairs]), np.concatenate([w if len(w) else np.ones(len(v)) for v, w in pairs])


def _median(values: np.ndarray, counts: np.ndarray | None = None, below: int = 0, total: int | None = None) -> float:
    """The exact median of ``total`` values of which ``below`` smaller ones are left out, and larger ones may be."""
    n = total if total is not None else len(values) if counts is None else int(counts.sum())
    if not n:
        return np.nan
    order = np.argsort(values, kind="stable")
    v = values[order]
    if counts is None:
        pick = [v[k] for k in ((n - 1) // 2 - below, n // 2 - below)]
    else:
        c = np.cumsum(counts[order])
        ranks = ((n - 1) // 2 - below, n // 2 - below)
        if ranks[0] < 0 or ranks[1] >= c[-1]:
            raise AssertionError("a median lies outside its bracket")
        pick = [v[np.searchsorted(c, k, "right")] for k in ranks]
    return float((pick[0] + pick[1]) / 2)


def _bracket(values: np.ndarray, weights: np.ndarray, slack: float) -> tuple[float, float]:
    """Values between which the median lies, if ranks are wrong by at most ``slack``."""
    order = np.argsort(values, kind="stable")
    v, c = values[order], np.cumsum(weights[order])
    low, high = c[-1] / 2 - slack - 1, c[-1] / 2 + slack + 1
    return float(v[np.searchsorted(c, low)]) if low > 0 else -np.inf, float(v[np.searchsorted(c, high)]) if high < c[-1] else np.inf


def _build(key: tuple, table: pa.Table) -> pa.Table:
    """All fragments of one (source, bucket): blocks of whole series, and one summary per joint."""
    source, bucket = key[0].as_py(), key[1].as_py()
    clips: dict[str, int] = {}
    parts = []
    for ids, part in zip(table.column("motion_ids").to_pylist(), table.column("part").to_pylist()):
        a = _unpacked(part)
        local = np.array([clips.setdefault(x, len(clips)) for x in ids], np.int64)
        n = len(a["t"])
        parts.append((local[a["m"]], a["j"], a["t"], _joined_bytes(pa.decompress(a["f"], n * CHANNELS * 4, codec="zstd", asbytes=True), n)))
    names = sorted(clips)
    rank = np.empty(len(names), np.int64)
    rank[[clips[x] for x in names]] = np.arange(len(names))
    m, j, t = (np.concatenate([p[i] for p in parts]) for i in range(3))
    f = np.concatenate([p[3] for p in parts], axis=1)
    del parts
    m = rank[m]
    order = np.lexsort((t, m, j))
    repeated = (j[order][1:] == j[order][:-1]) & (m[order][1:] == m[order][:-1]) & (t[order][1:] == t[order][:-1])
    if repeated.any():  # only then is the wide key needed to bring equal rows together
        bits = f.view(np.uint32)
        order = np.lexsort((*bits, t, m, j))
        jo, mo, to, bo = j[order], m[order], t[order], bits[:, order]
        copy = (jo[1:] == jo[:-1]) & (mo[1:] == mo[:-1]) & (to[1:] == to[:-1]) & (bo[:, 1:] == bo[:, :-1]).all(axis=0)
        order = order[np.concatenate([[True], ~copy])]
    j, m, t, f = j[order], m[order], t[order], f[:, order]
    rows: list[tuple] = []
    cuts = np.flatnonzero(j[1:] != j[:-1]) + 1
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(j)]):
        joint, mm, tt, ff = int(j[lo]), m[lo:hi], t[lo:hi], f[:, lo:hi]
        rows.append(("stat", joint, [], _summary(joint, [names[x] for x in np.unique(mm)], mm, tt, ff)))
        series = np.r_[0, np.flatnonzero(mm[1:] != mm[:-1]) + 1]
        ends, start = np.r_[series[1:], len(mm)], 0
        for e, nxt in zip(ends, np.r_[ends[1:], -1]):
            if nxt < 0 or nxt - start > BLOCK:
                used, local = np.unique(mm[start:e], return_inverse=True)
                part = _packed(m=local.astype(np.int32), t=tt[start:e], f=np.frombuffer(_split_bytes(ff[:, start:e]), np.uint8))
                rows.append(("block", joint, [names[x] for x in used], part))
                start = e
    return pa.table(
        {"kind": pa.array([r[0] for r in rows], pa.string()), "object_type": pa.array([source] * len(rows), pa.string()), "bucket": pa.array([bucket] * len(rows), pa.int32()), "joint": pa.array([r[1] for r in rows], pa.int32()), "motion_ids": pa.array([r[2] for r in rows], pa.list_(pa.string())), "part": pa.array([r[3] for r in rows], pa.binary())}
    )


def _steps(change: np.ndarray) -> np.ndarray:
    steps = np.abs(change[np.isfinite(change)])
    return steps[steps > 0]


def _summary(joint: int, names: list[str], m: np.ndarray, t: np.ndarray, f: np.ndarray) -> bytes:
    arrays: dict[str, np.ndarray] = {}
    sid = np.unique(m, return_inverse=True)[1]
    salt = np.array([zlib.crc32(f"{x}|{joint}".encode()) for x in names], np.uint64)[sid]
    for c in _level_channels(joint):
        x = f[c].astype(np.float64)
        finite, change, spike, seasonal, run = _raw_features(x, t, sid)
        v, w = _condense(x[finite])
        steps = _steps(change)
        sv, sw = _condense(steps)
        mixed = (salt ^ (t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(c * 0x85EBCA6B)) * np.uint64(0xC2B2AE3D27D4EB4F)
        draw = np.flatnonzero(finite)
        if len(draw) > SAMPLE_READINGS:
            draw = draw[np.argpartition(mixed[draw], SAMPLE_READINGS)[:SAMPLE_READINGS]]
        arrays |= {f"v{c}": v.astype(np.float32), f"w{c}": w, f"s{c}": sv, f"sw{c}": sw, f"h{c}": mixed[draw], f"x{c}": np.stack([x[draw], spike[draw], seasonal[draw], run[draw]], axis=1).astype(np.float32), f"n{c}": np.array([finite.sum(), len(steps), 1], np.int64)}
    return _packed(**arrays)


def _combine(joint: int, parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Several summaries as one."""
    if len(parts) == 1:
        return parts[0]
    arrays: dict[str, np.ndarray] = {}
    for c in _level_channels(joint):
        v, w = _condense_again(*_weighted(parts, f"v{c}", f"w{c}"))
        sv, sw = _condense_again(*_weighted(parts, f"s{c}", f"sw{c}"))
        h, x = (np.concatenate([p[f"{k}{c}"] for p in parts]) for k in "hx")
        first = np.argsort(h, kind="stable")[:SAMPLE_READINGS]
        arrays |= {f"v{c}": v.astype(np.float32), f"w{c}": w, f"s{c}": sv, f"sw{c}": sw, f"h{c}": h[first], f"x{c}": x[first], f"n{c}": np.sum([p[f"n{c}"] for p in parts], axis=0)}
    return arrays


def _merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    joint = int(key[1])
    part = _packed(**_combine(joint, [_unpacked(x) for x in pdf["part"]]))
    return pd.DataFrame({"object_type": [key[0]], "joint": pd.array([joint], "int32"), "share": pd.array([key[2]], "int32"), "part": [part]})


def _bracketed(levels: int):
    """Of one source and joint: medians, deviations and steps per channel where the summary holds every value, else brackets for them; and the sample of features."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        joint = int(key[1])
        s = _combine(joint, [_unpacked(x) for x in pdf["part"]])
        scale, zone = np.full((3, CHANNELS), np.nan), np.full((CHANNELS, 7), np.nan)
        hashes, samples, tags = [], [], []
        exact = True
        for c in _level_channels(joint):
            n, n_steps, n_parts = (int(k) for k in s[f"n{c}"])
            v, w = s[f"v{c}"].astype(np.float64), s[f"w{c}"]
            if not len(w):
                scale[0, c] = _median(v)
                scale[1, c] = _median(np.abs(v - scale[0, c]))
            else:
                exact = False
                slack = (levels + 2) * (2 * n / SUMMARY_POINTS + n_parts)
                low, high = _bracket(v, w, slack)
                order = np.argsort(v, kind="stable")
                mid = float(v[order][np.searchsorted(np.cumsum(w[order]), w.sum() / 2)])
                shift = max(high - mid, mid - low)
                near, far = _bracket(np.abs(v - mid), w, 2 * slack)
                zone[c, :5] = low, high, mid, near - 2 * shift, far + 2 * shift
            sv, sw = s[f"s{c}"], s[f"sw{c}"]
            if not len(sw):
                scale[2, c] = _median(sv)
            else:
                exact = False
                zone[c, 5:] = _bracket(sv, sw, (levels + 2) * (2 * n_steps / SUMMARY_POINTS + n_parts))
            hashes.append(s[f"h{c}"])
            samples.append(s[f"x{c}"])
            tags.append(np.full(len(s[f"h{c}"]), c, np.int32))
        out = _packed(scale=scale, zone=zone, n=np.array([s[f"n{c}"][:2] for c in _level_channels(joint)]).reshape(-1, 2), h=np.concatenate(hashes), x=np.concatenate(samples), c=np.concatenate(tags))
        return pd.DataFrame({"object_type": [key[0]], "joint": pd.array([joint], "int32"), "exact": [exact], "stats": [out]})

    return run


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_counts=True)


def _zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block: how many values lie below the brackets of its source and joint, and those inside with their counts."""
    for batch in batches:
        rows = []
        for source, bucket, joint, part, blob in zip(*(batch.column(k).to_pylist() for k in ("object_type", "bucket", "joint", "part", "stats"))):
            a, zone = _unpacked(part), _unpacked(blob)["zone"]
            m, t = a["m"], a["t"]
            f = _joined_bytes(a["f"], len(t))
            arrays: dict[str, np.ndarray] = {}
            for c in _level_channels(joint):
                low, high, mid, near, far, step_low, step_high = zone[c]
                x = f[c].astype(np.float64)
                if not np.isnan(mid):
                    v = x[np.isfinite(x)]
                    away = np.abs(v - mid)
                    arrays |= dict(zip((f"v{c}", f"vn{c}"), _counted(v[(v >= low) & (v <= high)]))) | dict(zip((f"d{c}", f"dn{c}"), _counted(v[(away >= near) & (away <= far)])))
                else:
                    v = away = x[:0]
                s = _steps(_raw_features(x, t, m)[1]) if not np.isnan(step_low) else x[:0]
                arrays |= dict(zip((f"s{c}", f"sn{c}"), _counted(s[(s >= step_low) & (s <= step_high)])))
                arrays[f"b{c}"] = np.array([(v < low).sum(), (away < near).sum(), (s < step_low).sum()], np.int64)
            rows.append((source, joint, bucket, _packed(**arrays)))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())], names=["object_type", "joint", "share", "part"])


def _add_zones(joint: int, parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    out: dict[str, np.ndarray] = {}
    for c in _level_channels(joint):
        out[f"b{c}"] = np.sum([p[f"b{c}"] for p in parts], axis=0)
        for k in "vds":
            held = [p for p in parts if f"{k}{c}" in p]
            if held:
                used, at = np.unique(np.concatenate([p[f"{k}{c}"] for p in held]), return_inverse=True)
                out |= {f"{k}{c}": used, f"{k}n{c}": np.bincount(at, np.concatenate([p[f"{k}n{c}"] for p in held]), len(used)).astype(np.int64)}
    return out


def _merge_zones(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    joint = int(key[1])
    part = _packed(**_add_zones(joint, [_unpacked(x) for x in pdf["part"]]))
    return pd.DataFrame({"object_type": [key[0]], "joint": pd.array([joint], "int32"), "share": pd.array([key[2]], "int32"), "part": [part]})


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact medians, deviations and steps from the brackets and what lies in them."""
    for batch in batches:
        out = []
        for joint, blob, part in zip(*(batch.column(k).to_pylist() for k in ("joint", "stats", "part"))):
            s, z = _unpacked(blob), _unpacked(part)
            scale = s["scale"].copy()
            for i, c in enumerate(_level_channels(joint)):
                n, n_steps = (int(k) for k in s["n"][i])
                below = z[f"b{c}"]
                if not np.isnan(s["zone"][c, 2]):
                    scale[0, c] = _median(z[f"v{c}"], z[f"vn{c}"], int(below[0]), n)
                    scale[1, c] = _median(np.abs(z[f"d{c}"] - scale[0, c]), z[f"dn{c}"], int(below[1]), n)
                if not np.isnan(s["zone"][c, 5]):
                    scale[2, c] = _median(z[f"s{c}"], z[f"sn{c}"], int(below[2]), n_steps)
            out.append(_packed(**(s | {"scale": scale})))
        yield pa.RecordBatch.from_arrays([batch.column("object_type"), batch.column("joint"), pa.array(out, pa.binary())], names=["object_type", "joint", "stats"])


def _scaled(x, spike, seasonal, run, med, mad, step) -> np.ndarray:
    """(4, n) level, difference, seasonal and run-length features in units of the source's joint and channel; a unit of 0 makes any deviation LARGEST."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.stack([np.abs(x - med) / mad, spike / step, seasonal / mad, np.asarray(run, float)])
    np.nan_to_num(out, copy=False, nan=0.0, posinf=LARGEST)
    return np.minimum(out, LARGEST, out=out)


def _average_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a tree of n points."""
    return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def _grow(codes: np.ndarray, rng: np.random.Generator, boxes: list[tuple]) -> None:
    """One tree over (n, 4) cells; its leaves are added as boxes of cells with their path."""

    def node(idx: np.ndarray, low: tuple, high: tuple, depth: int) -> None:
        free = [i for i in range(4) if high[i] - low[i] > 1]
        if depth == TREE_DEPTH or len(idx) <= 1 or not free:
            boxes.append((*low, *high, depth + _average_path(len(idx))))
            return
        i = int(rng.choice(free))
        cut = int(rng.integers(low[i] + 1, high[i]))
        right = codes[idx, i] >= cut
        node(idx[~right], low, (*high[:i], cut, *high[i + 1 :]), depth + 1)
        node(idx[right], (*low[:i], cut, *low[i + 1 :]), high, depth + 1)

    node(np.arange(len(codes)), (0,) * 4, (CUTS + 1,) * 4, 0)


def _fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The forest of one source, from at most SAMPLE_READINGS readings of each joint and channel, drawn by hash."""
    parts = [_unpacked(x) for x in pdf["stats"]]
    x = np.concatenate([_scaled(*p["x"].astype(np.float64).T, *p["scale"][:, p["c"]]).T for p in parts])
    x = np.log1p(x[np.argsort(np.concatenate([p["h"] for p in parts]), kind="stable")])
    rng = np.random.default_rng(zlib.crc32(key[0].encode()))
    wide = np.log1p([2 * k if np.isfinite(k) else SEASONAL_RANGE for k in LIMITS])
    top = np.maximum(x.max(axis=0), wide) if len(x) else wide
    cuts = (top * (np.arange(CUTS)[:, None] + rng.random((CUTS, 4))) / CUTS).T  # one in each of CUTS equal parts of the range
    codes = np.stack([np.searchsorted(cuts[i], x[:, i], "left") for i in range(4)], axis=1)
    boxes: list[tuple] = []
    for _ in range(TREES):
        _grow(codes[rng.choice(len(codes), min(TREE_SAMPLE, len(codes)), replace=False)] if len(codes) else np.zeros((1, 4), int), rng, boxes)
    grid = np.array(boxes)
    out = _packed(joints=pdf["joint"].to_numpy(np.int32), scales=np.stack([p["scale"] for p in parts]), cuts=np.expm1(cuts), boxes=grid[:, :8].astype(np.uint8), paths=grid[:, 8].astype(np.float32))
    return pd.DataFrame({"object_type": [key[0]], "model": [out]})


class _Forest:
    """A source's model, ready for scoring: the score of every cell, and the lowest score of a cell beyond a limit."""

    def __init__(self, blob: bytes) -> None:
        a = _unpacked(blob)
        self.scale = dict(zip(a["joints"].tolist(), a["scales"]))
        self.cuts = a["cuts"]
        corners = np.zeros((CUTS + 2,) * 4)
        low, high = a["boxes"][:, :4].astype(int), a["boxes"][:, 4:].astype(int)
        for corner in np.ndindex(2, 2, 2, 2):  # boxes as differences at their corners, summed up along each axis
            at = np.where(np.array(corner, bool), high, low)
            np.add.at(corners, tuple(at.T), a["paths"] * (-1) ** sum(corner))
        for axis in range(4):
            np.cumsum(corners, axis=axis, out=corners)
        table = np.exp2(-corners[(slice(CUTS + 1),) * 4] / TREES / _average_path(TREE_SAMPLE))
        self.threshold = min(float(table.take(range(int(np.searchsorted(self.cuts[i], k, "left")), CUTS + 1), axis=i).min()) for i, k in enumerate(LIMITS) if np.isfinite(k))
        self.table = table.ravel()

    def score(self, features: np.ndarray) -> np.ndarray:
        cell = np.zeros(features.shape[1], np.int64)
        for i in range(4):
            cell = cell * (CUTS + 1) + np.searchsorted(self.cuts[i], features[i], "left")
        return self.table[cell]


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per block and channel: source, joint, channel, clip names, clip and frame of each row, which are readings, cases, and scores (NaN where not judged by the forest)."""
    models: dict[str, _Forest] = {}
    for batch in batches:
        for source, joint, names, part, blob in zip(*(batch.column(k).to_pylist() for k in ("object_type", "joint", "motion_ids", "part", "model"))):
            if source not in models:
                if len(models) >= 64:
                    models.clear()
                models[source] = _Forest(blob)
            a = _unpacked(part)
            f = _joined_bytes(a["f"], len(a["t"]))
            present = f.view(np.uint32) != NO_READING
            for c in range(CHANNELS):
                case, score = _channel_cases(c, joint, f[c].astype(np.float64), present[c], a["t"], a["m"], models[source])
                yield source, joint, c, names, a["m"], a["t"], present[c], case, score


def _channel_cases(c: int, joint: int, x: np.ndarray, present: np.ndarray, t: np.ndarray, m: np.ndarray, forest: _Forest) -> tuple[np.ndarray, np.ndarray | None]:
    with np.errstate(invalid="ignore"):
        case = present & ~np.isfinite(x)
        if 3 <= c <= 8:
            case |= present & (np.abs(x) > 1.01)
        if c == 12:
            case |= present & (x != 0) & (x != 1)
    if c not in _level_channels(joint):
        return case, None
    med, mad, step = forest.scale[joint][:, c]
    finite, change, spike, seasonal, run = _raw_features(x, t, m)
    score = forest.score(_scaled(x, spike, seasonal, run, med, mad, step))
    at = np.flatnonzero(finite & (score >= forest.threshold))
    exact = (np.abs(x[at] - med) > LIMITS[0] * mad) | (spike[at] > LIMITS[1] * step) | (run[at] >= LIMITS[3])
    case[at[exact]] = True
    return case, np.where(finite, score, np.nan)


def _places(names: list[str], m: np.ndarray, t: np.ndarray, joint: int, c: int, at: np.ndarray) -> dict[str, pa.Array]:
    n = len(at)
    return {"motion_id": pa.array([names[k] for k in m[at]], pa.string()), "frame": pa.array(t[at], pa.int32()), "joint": pa.array(np.full(n, joint), pa.int32()), "channel": pa.array(np.full(n, c), pa.int32())}


def _gathered(tables: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for t in tables:
        held.append(pa.table(t))
        rows += held[-1].num_rows
        if rows > 100_000:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def _cases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _gathered(_places(names, m, t, joint, c, np.flatnonzero(case)) for _, joint, c, names, m, t, _, case, _ in _scored(batches) if case.any())


def _all_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for source, joint, c, names, m, t, present, case, score in _scored(batches):
            at = np.flatnonzero(present)
            value = np.where(case[at], 1.0, 0.0) if score is None else np.where(np.isnan(score[at]), 1.0, score[at])
            yield {"object_type": pa.array([source] * len(at), pa.string())} | _places(names, m, t, joint, c, at) | {"score": pa.array(value, pa.float64()), "is_case": pa.array(case[at])}

    yield from _gathered(rows())


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: readings and cases."""

    def rows() -> Iterator[dict]:
        for source, _, _, _, m, t, present, case, _ in _scored(batches):
            at = np.flatnonzero(case)
            cases = len(np.unique(m[at].astype(np.int64) << 32 | t[at].astype(np.int64) & 0xFFFFFFFF))
            yield {"object_type": pa.array([source], pa.string()), "readings": pa.array([int(present.sum())], pa.int64()), "cases": pa.array([cases], pa.int64())}

    yield from _gathered(rows())


def _score_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: how many readings and cases have each score, in steps of 1 / SCORE_BINS."""

    def rows() -> Iterator[dict]:
        for source, _, _, _, _, _, _, case, score in _scored(batches):
            if score is not None:
                judged = ~np.isnan(score)
                place = np.round(score[judged] * SCORE_BINS).astype(np.int64)
                n, cases = np.bincount(place, minlength=SCORE_BINS + 1), np.bincount(place, case[judged], SCORE_BINS + 1)
                at = np.flatnonzero(n)
                yield {"object_type": pa.array([source] * len(at), pa.string()), "place": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64()), "k": pa.array(cases[at].astype(np.int64), pa.int64())}

    yield from _gathered(rows())


def _prepared(motion: DataFrame) -> DataFrame:
    """Blocks joined with the model of their source, ready for scoring."""
    rows = motion.select(*(F.col(f"`{c}`").cast(k).alias(c) for c, k in (("object_type", "string"), ("motion_id", "string"), ("frame", "int"), ("joint", "int"), ("f", "array<float>"))))
    sizes = motion.select(F.col("`object_type`").cast("string").alias("object_type")).where("object_type is not null").groupBy("object_type").agg(F.count(F.lit(1)).alias("n"))
    splits = stored(sizes.where(F.col("n") > BUCKET_ROWS).select("object_type", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("split")), "spike-splits")
    most = splits.agg(F.max("split")).first()[0] or 1
    rows = rows.where("object_type is not null and motion_id is not null and frame is not null and joint is not null and f is not null")
    rows = rows.withColumn("split", F.lit(1)) if most == 1 else lookup(rows, splits, "object_type", "left").withColumn("split", F.coalesce("split", F.lit(1)))
    fragments = rows.mapInArrow(_pack, FRAGMENT)
    built = stored(fragments.groupBy("object_type", "bucket").applyInArrow(_build, BLOCK_SCHEMA), "spikes", ["kind"])
    blocks = built.where("kind = 'block'").select("object_type", "bucket", "joint", "motion_ids", "part")

    def merged(parts: DataFrame, merge) -> tuple[DataFrame, int]:
        """Parts of one source and joint merged until a group has at most FAN_IN of them; and in how many levels."""
        n, levels = most, 0
        while n > FAN_IN:
            parts = parts.withColumn("share", F.floor(F.col("share") / FAN_IN).cast("int")).groupBy("object_type", "joint", "share").applyInPandas(merge, SUMMARY)
            n, levels = -(-n // FAN_IN), levels + 1
        return parts, levels

    summaries, levels = merged(built.where("kind = 'stat'").select("object_type", "joint", F.col("bucket").alias("share"), "part"), _merge)
    stats = stored(summaries.groupBy("object_type", "joint").applyInPandas(_bracketed(levels), BRACKETS), "spike-brackets")
    known, asked = stats.where("exact").select("object_type", "joint", "stats"), stats.where("not exact")
    if asked.limit(1).count():
        key = F.concat_ws("|", F.col("joint").cast("string"), "object_type").alias("series")
        zones = stored(asked.select(key, "stats"), "spike-zones")
        inside = lookup(blocks.select("object_type", "bucket", "joint", "part", key), zones, "series").mapInArrow(_zones, SUMMARY)
        # the blocks of a bucket are added up first
        inside = inside.groupBy("object_type", "joint", "share").applyInPandas(_merge_zones, SUMMARY)
        inside, _ = merged(inside, _merge_zones)
        inside = inside.withColumn("share", F.lit(0)).groupBy("object_type", "joint", "share").applyInPandas(_merge_zones, SUMMARY)
        settled = asked.select("object_type", "joint", "stats").join(inside.select("object_type", "joint", "part"), ["object_type", "joint"]).select("object_type", "joint", "stats", "part")
        known = known.unionByName(settled.mapInArrow(_settled, STATS))
    models = stored(known.groupBy("object_type").applyInPandas(_fit, MODEL), "spike-models")
    return lookup(blocks, models, "object_type")


def implausible_readings(motion: DataFrame) -> DataFrame:
    """Every reading that is a spike, stuck or impossible: (motion_id, frame, joint, channel), each once."""
    return _prepared(motion).mapInArrow(_cases, "motion_id string, frame int, joint int, channel int").distinct()


def scored_readings(motion: DataFrame) -> DataFrame:
    """Every reading with its anomaly score; channels that only have physical limits score 1 beyond them, else 0, and so do readings that are not finite."""
    return _prepared(motion).mapInArrow(_all_scores, "object_type string, motion_id string, frame int, joint int, channel int, score double, is_case boolean")


def source_report(motion: DataFrame) -> DataFrame:
    """Per source: readings, and cases by clip, frame, joint and channel."""
    per_block = _prepared(motion).mapInArrow(_tallies, "object_type string, readings bigint, cases bigint")
    return per_block.groupBy("object_type").agg(F.sum("readings").alias("readings"), F.sum("cases").alias("cases"))


def score_report(motion: DataFrame) -> DataFrame:
    """How well the forest alone ranks, per source: readings it scored, the cases among them, and how many of the cases are among as many readings of highest score (ties in proportion)."""
    counts = _prepared(motion).mapInArrow(_score_counts, "object_type string, place int, n bigint, k bigint").groupBy("object_type", "place").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    down = W.partitionBy("object_type").orderBy(F.desc("place")).rowsBetween(W.unboundedPreceding, -1)  # at most SCORE_BINS rows
    ranked = counts.withColumns({"before": F.coalesce(F.sum("n").over(down), F.lit(0)), "cases": F.sum("k").over(W.partitionBy("object_type"))})
    taken = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("cases") - F.col("before")) / F.col("n")))
    return ranked.groupBy("object_type").agg(F.sum("n").alias("readings"), F.first("cases").alias("cases"), F.round(F.sum(F.col("k") * taken), 3).alias("cases_on_top"))
