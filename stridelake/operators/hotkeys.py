"""Per-key results that do not depend on how records spread over keys.

Keys are dictionary-encoded to dense numbers; every input split, whatever its keys, adds its rows into
dense accumulator arrays with ``numpy.bincount`` and hands on array blocks; the blocks of one range of
numbers are summed.  A task's work follows the size of its split alone, and what is shuffled is at most
(splits x keys) numbers, so a key with a third of all rows costs no more than any other.  A task holds the sums
of ``HELD_KEYS`` keys and hands them on when there are more.

The dictionary is handed to the tasks while it takes less than ``DICTIONARY_BYTES`` in memory; beyond that bound each
split encodes its keys by a dictionary of its own, and its sums, not its rows, meet the numbers in a join.

Defined results: a null key is a key of its own when ``keep_null`` is set, else outside; null, NaN or infinite
measures add nothing; an empty table gives no rows; repeated rows count as often as they occur
(callers drop repeats first where a record counts once).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.scratch import fits, partitions, stored

BLOCK_KEYS = 1024
DICTIONARY_BYTES = 16 << 20
HELD_KEYS = 500_000


def dictionary(df: DataFrame, key: str) -> DataFrame:
    """The distinct non-null keys with dense numbers from 0, in key order."""
    keys = stored(df.select(F.col(f"`{key}`").cast("string").alias("key")).where("key is not null").distinct(), "keys")
    parts = keys.repartitionByRange(partitions(df.sparkSession), "key").sortWithinPartitions("key").select("key", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    parts = stored(parts, "keys-ordered")
    sizes = {r[0]: r[1] for r in parts.groupBy("part").count().collect()}  # one number per partition
    before, total = {}, 0
    for p in sorted(sizes):
        before[p] = total
        total += sizes[p]
    if not before:
        return parts.select("key", F.lit(0).cast("bigint").alias("id"))
    start = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    low = F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    return parts.select("key", (low + start[F.col("part")]).cast("bigint").alias("id"))


class _Sums:
    """Dense accumulators over local numbers: row counts, and per measure the number and sum of its finite values."""

    def __init__(self, measures: list[str]) -> None:
        self.measures = measures
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, ids: np.ndarray, batch: pa.RecordBatch) -> None:
        used, local = np.unique(ids, return_inverse=True)
        grid = np.empty((1 + 2 * len(self.measures), len(used)))
        grid[0] = np.bincount(local, minlength=len(used))
        for i, name in enumerate(self.measures):
            x = pc.fill_null(batch.column(name), float("nan")).to_numpy(zero_copy_only=False)
            fit = np.isfinite(x)
            grid[1 + 2 * i] = np.bincount(local, fit, len(used))
            grid[2 + 2 * i] = np.bincount(local, np.where(fit, x, 0.0), len(used))
        self.held.append((used, grid))
        self.rows += len(used)
        if self.rows > HELD_KEYS and len(self.held) > 1:
            self._fold()

    def _fold(self) -> None:
        if len(self.held) > 1:
            used, local = np.unique(np.concatenate([u for u, _ in self.held]), return_inverse=True)
            grids = np.concatenate([g for _, g in self.held], axis=1)
            order = np.argsort(local, kind="stable")
            self.held = [(used, np.add.reduceat(grids[:, order], np.searchsorted(local[order], np.arange(len(used))), axis=1))]
        self.rows = sum(len(u) for u, _ in self.held)

    @property
    def full(self) -> bool:
        return self.rows > HELD_KEYS

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self._fold()
        out = self.held[0] if self.held else (np.zeros(0, np.int64), np.zeros((1 + 2 * len(self.measures), 0)))
        self.held, self.rows = [], 0
        return out


def _blocks(ids: np.ndarray, grid: np.ndarray) -> pa.RecordBatch:
    """Sorted numbers and their sums, cut at the borders of blocks of ``BLOCK_KEYS`` numbers."""
    block = ids // BLOCK_KEYS
    cuts = np.r_[0, np.flatnonzero(block[1:] != block[:-1]) + 1, len(ids)] if len(ids) else np.zeros(1, np.int64)
    spans = list(zip(cuts[:-1], cuts[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array([int(block[lo]) for lo, _ in spans], pa.int64()), pa.array([ids[lo:hi] % BLOCK_KEYS for lo, hi in spans], pa.list_(pa.int32())), pa.array([grid[:, lo:hi].ravel() for lo, hi in spans], pa.list_(pa.float64()))],
        names=["block", "at", "sums"],
    )


PARTIAL = "block bigint, at array<int>, sums array<double>"


def _accumulate(codes: dict[str, int], measures: list[str]):
    """Rows of a split whose keys' numbers are at hand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(measures)
        for batch in batches:
            if batch.num_rows:
                keys = batch.column("key").dictionary_encode()
                sums.add(np.array([codes[k] for k in keys.dictionary.to_pylist()], np.int64)[keys.indices.to_numpy()], batch)
                if sums.full:
                    yield _blocks(*sums.take())
        yield _blocks(*sums.take())

    return run


def _accumulate_local(measures: list[str]):
    """Rows of a split under numbers of its own, handed on with their keys: each key at most once until ``HELD_KEYS`` are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, codes = _Sums(measures), {}

        def emit() -> pa.RecordBatch:
            ids, grid = sums.take()
            names = list(codes)
            codes.clear()
            return pa.RecordBatch.from_arrays([pa.array([names[i] for i in ids], pa.string()), pa.array(list(grid.T), pa.list_(pa.float64()))], names=["key", "sums"])

        for batch in batches:
            if batch.num_rows:
                keys = batch.column("key").dictionary_encode()
                sums.add(np.array([codes.setdefault(k, len(codes)) for k in keys.dictionary.to_pylist()], np.int64)[keys.indices.to_numpy()], batch)
                if sums.full:
                    yield emit()
        yield emit()

    return run


def _numbered(width: int):
    """Sums by number into array blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("id").to_numpy()
                order = np.argsort(ids, kind="stable")
                used, first = np.unique(ids[order], return_index=True)
                grid = batch.column("sums").flatten().to_numpy().reshape(-1, width)[order]
                yield _blocks(used, np.add.reduceat(grid, first, axis=0).T)

    return run


def _dense(table: pa.Table) -> np.ndarray:
    """The sum of the array blocks of one range of numbers, as a dense array."""
    total = None
    for at, sums in zip(table.column("at").to_numpy(zero_copy_only=False), table.column("sums").to_numpy(zero_copy_only=False)):
        grid = np.asarray(sums).reshape(-1, len(at))
        total = np.zeros((len(grid), BLOCK_KEYS)) if total is None else total
        total[:, at] += grid
    return total


def _add_blocks(key: tuple, table: pa.Table) -> pa.Table:
    grid = _dense(table)
    at = np.flatnonzero(grid[0])
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "at": pa.array([at], pa.list_(pa.int32())), "sums": pa.array([grid[:, at].ravel()], pa.list_(pa.float64()))})


def _reduce(key: tuple, table: pa.Table) -> pa.Table:
    grid = _dense(table)
    at = np.flatnonzero(grid[0])
    return pa.table({"id": pa.array(key[0].as_py() * BLOCK_KEYS + at, pa.int64()), "sums": pa.array(list(grid[:, at].T), pa.list_(pa.float64()))})


def per_key_totals(df: DataFrame, key: str, measures: dict[str, str] | None = None, keep_null: bool = False) -> DataFrame:
    """Rows per key, and for each measure (name: SQL expression) the number and sum of its finite values: ``key, n_rows, <name>_n, <name>_sum``."""
    measures = measures or {}
    k = F.concat(F.lit("="), F.col(f"`{key}`").cast("string"))  # so that no key can be taken for the null key "-"
    rows = df.select((F.coalesce(k, F.lit("-")) if keep_null else k).alias("key"), *(F.expr(e).cast("double").alias(m) for m, e in measures.items())).where("key is not null")
    names = stored(dictionary(rows, "key"), "dictionary")
    if fits(names, DICTIONARY_BYTES):
        partial = rows.mapInArrow(_accumulate({r[0]: r[1] for r in names.collect()}, list(measures)), PARTIAL)
    else:
        # summed within each split first, so that no key has more rows in the join than there are splits
        local = rows.mapInArrow(_accumulate_local(list(measures)), "key string, sums array<double>")
        partial = local.join(names, "key").select("id", "sums").mapInArrow(_numbered(1 + 2 * len(measures)), PARTIAL)
    # blocks of one range may come from every split: they are summed in two steps, a share of them first
    shared = partial.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(32)))
    first = shared.groupBy("block", "share").applyInArrow(_add_blocks, PARTIAL)
    out = first.groupBy("block").applyInArrow(_reduce, "id bigint, sums array<double>").join(names, "id")
    columns = [F.col("sums")[0].cast("bigint").alias("n_rows")]
    for i, m in enumerate(measures):
        columns += [F.col("sums")[1 + 2 * i].cast("bigint").alias(f"{m}_n"), F.col("sums")[2 + 2 * i].alias(f"{m}_sum")]
    return out.select(F.when(F.col("key") != "-", F.substring("key", 2, 2**31 - 1)).alias("key"), *columns)


def heavy_keys(df: DataFrame, key: str, record: str, share: float = 0.05) -> DataFrame:
    """Non-null keys that hold at least ``share`` of all distinct records; a record counts once per key."""
    once = df.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{record}`").cast("string").alias("record")).where("record is not null").distinct()
    once = stored(once, "key-records")
    total = once.select("record").distinct().count()
    parts = round(share * 1_000_000)  # whole numbers: a key that holds exactly the share is in
    return per_key_totals(once, "key").where(F.col("n_rows") * F.lit(1_000_000) >= F.lit(parts * total)).select("key", "n_rows")
