"""Filling containers of a fixed capacity with texts, none divided unless it is longer than a container.

Texts are routed by length to context tiers (capacity, a half, a quarter, an eighth).  Each shard of texts is
packed tier by tier, the longest first: a container opens with the longest text left in the tier, and its gap is
filled with the longest text that still fits, from the same or a shorter tier, until none does.  A lookup of the
next shorter non-empty length makes each placement near constant time.  Containers are then dealt in
snake order to step groups, so that every group has about the same number of tokens and longest text.

Only (id, length) pairs reach the packer; lengths are taken in the JVM.  A shard holds about ``SHARD_TOKENS``
tokens, chosen by a hash of the id, so no task or driver sees all texts, and each shard leaves at most one
container partly filled for want of texts.

Tokens are those of ByT5: one per UTF-8 byte and an end token.  Defined results: a null text is not placed; an empty
or blank one is (its end token needs a place); rows repeated with the same id and text are placed once; the same
id with different texts is placed for each, told apart by ``version``; a text longer than a container is cut into
pieces of the full capacity and a rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.scratch import stored

CAPACITY = 4096
TIERS = 4
STEP_CONTAINERS = 8
SHARD_TOKENS = 64_000_000

PLACES = "doc_id bigint, version bigint, piece int, n_pieces int, container_id string, tier int, step_group string, place int, at int, n_tokens int"


def token_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct texts with their ByT5 length."""
    t = F.col(f"`{text}`")
    return documents.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.xxhash64(t).alias("version"), (F.octet_length(t) + 1).cast("bigint").alias("tokens")).where("doc_id is not null and tokens is not null").distinct()


def fill(sizes: np.ndarray, capacity: int, tiers: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For items of 1..capacity tokens: container of each, its start there, and the tier of each container (0 the longest)."""
    n = len(sizes)
    order = np.argsort(sizes, kind="stable")
    left = np.bincount(sizes, minlength=capacity + 1).tolist()
    ends = np.cumsum(left).tolist()  # the items left of size s are order[ends[s] - left[s] : ends[s]]
    parent = list(range(capacity + 1))  # leads, with compressed paths, to the longest non-empty length up to here

    def longest(limit: int) -> int:
        root = limit
        while True:
            if parent[root] != root:
                root = parent[root]
            elif root and not left[root]:
                parent[root] = root - 1
            else:
                break
        while limit != root:
            parent[limit], limit = root, parent[limit]
        return root

    container, start, kinds = np.empty(n, np.int64), np.empty(n, np.int64), []
    for tier in range(tiers):
        floor = capacity >> (tier + 1) if tier < tiers - 1 else 0
        while (size := longest(capacity >> tier)) > floor:
            room, at = capacity, 0
            while size:
                item = order[ends[size] - left[size]]
                left[size] -= 1
                container[item], start[item] = len(kinds), at
                at += size
                room -= size
                size = longest(room) if room else 0
            kinds.append(tier)
    return container, start, np.array(kinds, np.int64)


def _pack_shard(capacity: int, tiers: int, step: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        ids, versions, tokens = (table.column(k).to_numpy() for k in ("doc_id", "version", "tokens"))
        order = np.lexsort((versions, ids))
        ids, versions, tokens = ids[order], versions[order], tokens[order]
        n_pieces = -(-tokens // capacity)
        whole = np.repeat(np.arange(len(ids)), n_pieces)
        piece = np.arange(len(whole)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        sizes = np.minimum(capacity, tokens[whole] - piece * capacity)
        container, start, kind = fill(sizes, capacity, tiers)
        filled = np.bincount(container, sizes, len(kind)).astype(np.int64)
        groups = max(1, -(-len(kind) // step))
        rank = np.empty(len(kind), np.int64)
        rank[np.lexsort((np.arange(len(kind)), -filled, kind))] = np.arange(len(kind))
        lap, turn = rank // groups, rank % groups
        group = np.where(lap % 2 == 0, turn, groups - 1 - turn)
        by_place = np.lexsort((start, container))
        place = np.empty(len(whole), np.int64)
        firsts = np.r_[True, container[by_place][1:] != container[by_place][:-1]] if len(whole) else np.zeros(0, bool)
        place[by_place] = np.arange(len(whole)) - np.maximum.accumulate(np.where(firsts, np.arange(len(whole)), 0))
        return pa.table(
            {
                "doc_id": pa.array(ids[whole], pa.int64()), "version": pa.array(versions[whole], pa.int64()), "piece": pa.array(piece, pa.int32()), "n_pieces": pa.array(n_pieces[whole], pa.int32()),
                "container_id": pa.array([f"{shard:06d}-{c:08d}" for c in container]), "tier": pa.array(capacity >> kind[container], pa.int32()), "step_group": pa.array([f"{shard:06d}-{g:07d}" for g in group[container]]),
                "place": pa.array(place, pa.int32()), "at": pa.array(start, pa.int32()), "n_tokens": pa.array(sizes, pa.int32()),
            }
        )

    return run


def pack_texts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tiers: int = TIERS, step: int = STEP_CONTAINERS) -> DataFrame:
    """One row per text, or per piece of a text longer than a container: where it lies."""
    counts = stored(token_counts(documents, doc_id, text), "tokens")
    total = counts.agg(F.sum("tokens")).first()[0] or 0
    shards = max(1, -(-total // SHARD_TOKENS))
    # a text longer than a container only leaves its rest to be packed, so a very long one weighs little
    return counts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "version"), F.lit(shards))).groupBy("shard").applyInArrow(_pack_shard(capacity, tiers, step), PLACES)


def container_fill(places: DataFrame) -> DataFrame:
    """Per container: tier, step group, texts, tokens."""
    return places.groupBy("container_id").agg(F.first("tier").alias("tier"), F.first("step_group").alias("step_group"), F.count(F.lit(1)).alias("n_texts"), F.sum("n_tokens").alias("n_tokens"))
