"""References to records that do not exist, or do not exist yet, at the time the reference came in.

Parents are cut into ranges of (key, start); each range is one row of sorted arrays (keys, and the merged
intervals in which each key was in force).  A key with more versions than a range holds goes on in the next ranges;
what is in force at the beginning of a range comes with it.  References are routed to the range of their key and
time, and every batch of them is probed by binary search against that range's arrays.  Ranges that many references hit,
as when one key has a third of them, are split by a hash of the record into shares of bounded size, each
of which meets its own copy of the (bounded) range.

The edges of the ranges are handed to the routing tasks up to ``MAX_EDGES``; beyond, every so many-th edge is, and the
edges between two of those are met by key, in shares as above.

Defined results: a null key is no reference; a null record id puts a record outside; a reference without
a time is judged by whether the key was in force at any time, and its period is null; a parent without
a start is never in force, one without an end still is; an interval that ends before it begins is empty;
an empty parent table makes every reference an orphan; each record is reported once; keys compare byte
by byte.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.scratch import discard, lookup, stored

RANGE_ROWS = 65_536
SHARE_ROWS = 500_000
MAX_EDGES = 65_536

_RANGE = "range_id int, first_key string, first_start bigint, last_key string, last_end bigint, keys array<string>, key_at array<int>, starts array<bigint>, ends array<bigint>"
_REF = "src_table string, rec_id string, key string, at bigint"
_OPEN = np.iinfo(np.int64).max


def _micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def _merged(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Disjoint intervals of each code, in order."""
    order = np.lexsort((end, start, code))
    code, start, end = code[order], start[order], end[order]
    reach = pd.Series(end).groupby(code).cummax().to_numpy() if len(end) else end
    opens = np.ones(len(code), bool)
    opens[1:] = (code[1:] != code[:-1]) | (start[1:] > reach[:-1])
    last = np.append(np.flatnonzero(opens)[1:] - 1, len(code) - 1) if len(code) else np.zeros(0, int)
    return code[opens], start[opens], reach[last]


def _range_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition of parents as a row of sorted arrays with disjoint intervals."""
    from pyspark import TaskContext

    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held).combine_chunks()
    keys = t.column("key").combine_chunks().dictionary_encode()
    words = np.array([x.encode() for x in keys.dictionary.to_pylist()], dtype=object)
    by_word = np.argsort(words, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[by_word] = np.arange(len(words))
    words = words[by_word]
    code, start, end = _merged(rank[keys.indices.to_numpy()], t.column("start").to_numpy(), t.column("end").to_numpy())
    yield pa.RecordBatch.from_pydict(
        {
            "range_id": pa.array([TaskContext.get().partitionId()], pa.int32()), "first_key": [words[0].decode()], "first_start": pa.array([start[0]], pa.int64()), "last_key": [words[-1].decode()], "last_end": pa.array([end[code == code[-1]].max()], pa.int64()),
            "keys": pa.array([[w.decode() for w in words]], pa.list_(pa.string())), "key_at": pa.array([code], pa.list_(pa.int32())), "starts": pa.array([start], pa.list_(pa.int64())), "ends": pa.array([end], pa.list_(pa.int64())),
        }
    )


def _places(refs: pa.Table | pa.RecordBatch, keys: list[bytes], starts: np.ndarray) -> np.ndarray:
    """For each reference the last of the sorted edges at or before its (key, time); -1 before the first."""
    column = refs.column("key")
    asked = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).dictionary_encode()
    idx = asked.indices.to_numpy()
    names = [k.encode() for k in asked.dictionary.to_pylist()]
    low = np.array([bisect.bisect_left(keys, k) for k in names], np.int64)
    high = np.array([bisect.bisect_right(keys, k) for k in names], np.int64)
    out = (low - 1)[idx] if len(names) else np.zeros(0, np.int64)
    when = pc.fill_null(refs.column("at"), _OPEN).to_numpy()
    for k in np.flatnonzero(high > low):  # only keys at which a range begins
        mine = np.flatnonzero(idx == k)
        out[mine] = low[k] - 1 + np.searchsorted(starts[low[k] : high[k]], when[mine], "right")
    return out


def _route(edges: list[tuple[bytes, int, int]]):
    keys, starts, ids = [e[0] for e in edges], np.array([e[1] for e in edges], np.int64), np.array([e[2] for e in edges], np.int32)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.maximum(_places(batch, keys, starts), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids[at], pa.int32())], names=[*batch.schema.names, "range_id"])

    return route


def _route_within(refs: pa.Table, edges: pa.Table) -> pa.Table:
    """References of one wide range to the ranges in it."""
    rows = sorted(zip((k.encode() for k in edges.column("first_key").to_pylist()), edges.column("first_start").to_pylist(), edges.column("inner_id").to_pylist()))
    at = np.maximum(_places(refs, [r[0] for r in rows], np.array([r[1] for r in rows], np.int64)), 0)
    ids = np.array([r[2] for r in rows], np.int32)
    return refs.select(["src_table", "rec_id", "key", "at"]).append_column("range_id", pa.array(ids[at] if refs.num_rows else [], pa.int32()))


def _in_shares(routed: DataFrame, ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``share``: ranges that many references hit are copied, and their references spread over the copies."""
    load = routed.groupBy("range_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARE_ROWS)
    shares = stored(load.select("range_id", F.ceil(F.col("n") / SHARE_ROWS).cast("int").alias("shares")), "shares")
    if shares.limit(1).count() == 0:
        return routed.withColumn("share", F.lit(0)), ranges.withColumn("share", F.lit(0))
    of = F.coalesce("shares", F.lit(1))
    return (
        lookup(routed, shares, "range_id", "left").withColumn("share", F.pmod(F.xxhash64("rec_id"), of).cast("int")).drop("shares"),
        ranges.join(shares, "range_id", "left").withColumn("share", F.explode(F.sequence(F.lit(0), of - 1))).drop("shares"),
    )


def _probe(refs: pa.Table, parents: pa.Table) -> pa.Table:
    """Binary search of one batch of references in one range's arrays; misses only."""
    n = refs.num_rows
    missing = np.ones(n, bool)
    if parents.num_rows and n:
        p = parents.to_pylist()[0]
        words = np.array([x.encode() for x in p["keys"]], dtype=object)
        code, start, end = (np.array(p[k], np.int64) for k in ("key_at", "starts", "ends"))
        if p["carry"] is not None and p["carry"] > p["first_start"]:
            code, start, end = _merged(np.append(code, 0), np.append(start, p["first_start"]), np.append(end, p["carry"]))
        asked = refs.column("key").combine_chunks().dictionary_encode()
        names = [x.encode() for x in asked.dictionary.to_pylist()]
        at = np.searchsorted(words, np.array(names, dtype=object)) if names else np.zeros(0, np.int64)
        known = np.array([i < len(words) and words[i] == k for i, k in zip(at, names)], bool)
        idx = asked.indices.to_numpy()
        k = np.where(known[idx], at[idx], -1)
        timed = ~np.asarray(refs.column("at").is_null())
        when = pc.fill_null(refs.column("at"), 0).to_numpy()
        clock = np.unique(start)  # (key, time) in one number: the key's place times the clock's ticks
        ticks = len(clock) + 1
        line = code * ticks + np.searchsorted(clock, start) + 1
        hit = np.searchsorted(line, k * ticks + np.searchsorted(clock, when, "right"), "right") - 1
        safe = np.maximum(hit, 0)
        in_force = (hit >= 0) & (code[safe] == k) & (when < end[safe])
        missing = ~np.where(timed, in_force, k >= 0)
    return refs.filter(pa.array(missing)).select(["src_table", "rec_id", "at"])


def _ranges(parents: DataFrame) -> tuple[DataFrame, int]:
    """The stored ranges, each with the end (``carry``) of what earlier ranges hold of its first key, and their number."""
    p = parents.select(F.col("key").cast("string").alias("key"), _micros(F.col("start")).alias("start"), F.coalesce(_micros(F.col("end")), F.lit(_OPEN)).alias("end"))
    p = stored(p.where("key is not null and start is not null and end > start").groupBy("key", "start").agg(F.max("end").alias("end")), "parents")
    n = max(1, -(-p.count() // RANGE_ROWS))
    packed = stored((p.repartitionByRange(n, "key", "start") if n > 1 else p.coalesce(1)).mapInArrow(_range_rows, _RANGE), "parent-ranges")
    discard(p)
    if n == 1:
        return packed.withColumn("carry", F.lit(None).cast("bigint")), n
    ends = packed.select(F.col("last_key").alias("k"), "range_id", F.col("last_end").alias("end"), F.lit(False).alias("asks"))
    begins = packed.select(F.col("first_key").alias("k"), "range_id", F.lit(None).cast("bigint").alias("end"), F.lit(True).alias("asks"))
    before = W.partitionBy("k").orderBy("range_id").rangeBetween(W.unboundedPreceding, -1)  # one row per range
    carry = ends.unionByName(begins).withColumn("carry", F.max("end").over(before)).where("asks").select("range_id", "carry")
    return packed.join(carry, "range_id"), n


def orphan_references(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """refs: src_table, rec_id, key, at (timestamp); parents: key, start, end (timestamps).  Orphans as (src_table, rec_id, period), each once."""
    ranges, n = _ranges(parents)
    r = refs.select("src_table", F.col("rec_id").cast("string").alias("rec_id"), F.col("key").cast("string").alias("key"), _micros(F.col("at")).alias("at")).where("key is not null and rec_id is not null")
    step = -(-n // MAX_EDGES)
    edges = ranges.select("first_key", "first_start", "range_id")
    wide = edges.withColumn("wide", F.floor(F.col("range_id") / step).cast("int"))
    firsts = wide.groupBy("wide").agg(F.min_by(F.struct("first_key", "first_start"), "range_id").alias("e")).select("e.*", "wide") if step > 1 else edges
    handed = sorted((x[0].encode(), x[1], x[2]) for x in firsts.collect())  # at most MAX_EDGES
    if not handed:
        missed = r.select("src_table", "rec_id", "at")
    else:
        routed = stored(r.mapInArrow(_route(handed), f"{_REF}, range_id int"), "routed")
        if step > 1:
            left, right = _in_shares(routed, wide.select("first_key", "first_start", F.col("range_id").alias("inner_id"), F.col("wide").alias("range_id")))
            within = left.groupBy("range_id", "share").cogroup(right.groupBy("range_id", "share")).applyInArrow(_route_within, f"{_REF}, range_id int")
            routed = stored(within, "routed-within")
        left, right = _in_shares(routed, ranges)
        missed = left.groupBy("range_id", "share").cogroup(right.groupBy("range_id", "share")).applyInArrow(_probe, "src_table string, rec_id string, at bigint")
    return missed.select("src_table", "rec_id", F.date_format(F.timestamp_micros("at"), "yyyy-MM").alias("period")).distinct()


def orphan_counts(orphans: DataFrame, refs: DataFrame) -> DataFrame:
    """Per table and month: records that refer, and those whose reference did not hold."""
    asked = refs.where("key is not null and rec_id is not null").select("src_table", F.col("rec_id").cast("string").alias("rec_id"), F.date_format(F.col("at").cast("timestamp"), "yyyy-MM").alias("period")).distinct().groupBy("src_table", "period").agg(F.count(F.lit(1)).alias("n_refs"))
    missed = orphans.groupBy("src_table", "period").agg(F.count(F.lit(1)).alias("n_orphans"))
    same = (asked["src_table"] == missed["src_table"]) & asked["period"].eqNullSafe(missed["period"])
    return asked.join(missed, same, "left").select(asked["src_table"], asked["period"], "n_refs", F.coalesce("n_orphans", F.lit(0).cast("bigint")).alias("n_orphans"))
