"""Train, validation and test splits that keep related records together.

Records that share a value of any key column form a component.  Components carry a label vector (how many
of their records have each label).  Placement is iterative stratification over components: the label with
the fewest outstanding records comes first, its components go, largest first, to the split that still needs
most of that label.

Components above a thousandth of all records (at most a thousand of them) are placed first, in one task, by all labels they have; of
labels that are spread over these components alike, count by count, the first by name stands for all, as the others find every one of
their components placed.  What is left of each such label's need is worked out label by label, where it lies, and goes to the
components that follow.  All others are placed in shards, each by itself.  A
component goes to the shard of its rarest label, and only components whose rarest label fills more than a part of a shard are
spread by hash; so a rare label is seen whole in one place.  What the splits still need of a label is shared out to the
shards in whole records, rounded by a draw from the hash of label and shard, so that labels in many shards keep their
shares as well.

Defined results: a record without any key value is a component of its own; repeated rows of a record count once
(its keys and labels are united); a null record id is outside; a null label counts as the label "" of its
column; ties go to the larger total need, then to the split named first; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.scratch import discard, lookup, stored

TARGETS = {"train": 0.8, "val": 0.1, "test": 0.1}
HEAVY = 1000
SHARD_COMPONENTS = 50_000


def components(records: DataFrame, record: str, keys: list[str]) -> DataFrame:
    """(record, component): connected through shared values of ``keys``; equal values of different columns are different."""
    named = [F.when(F.col(f"`{k}`").isNotNull(), F.concat(F.lit(f"{i}:"), F.col(f"`{k}`").cast("string"))) for i, k in enumerate(keys)]
    own = F.concat(F.lit("r:"), F.col(f"`{record}`").cast("string"))
    rows = records.select(F.col(f"`{record}`").cast("string").alias("record"), F.array_compact(F.array(*named)).alias("nodes"), own.alias("own")).where("record is not null")
    if len(keys) == 1:
        # one key column: a record may still bring two values by repeated rows, which then join
        multi = rows.select("record", F.explode("nodes").alias("node")).distinct().groupBy("record").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        if not multi:
            return rows.groupBy("record").agg(F.max(F.get("nodes", F.lit(0))).alias("node")).select("record", F.coalesce("node", F.concat(F.lit("r:"), F.col("record"))).alias("component"))
    held = stored(rows.select("record", F.explode("nodes").alias("node")).distinct(), "record-nodes")
    first = held.groupBy("record").agg(F.min("node").alias("first"))
    edges = held.join(first, "record").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    edges = stored(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(held.select("node").distinct().withColumn("label", F.col("node")), "labels")
    while True:
        near = lookup(edges.withColumnRenamed("b", "node"), labels, "node").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"], "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("low"))
        step = stored(step, "step")
        jump = stored(step.select(F.col("node").alias("low"), F.col("low").alias("far")), "jump")
        following = lookup(step, jump, "low").select("node", F.least("low", "far").alias("label"), (F.least("low", "far") != F.col("label")).alias("moved"))
        following = stored(following, "labels")
        discard(labels, step, jump)
        labels = following
        if not following.where("moved").limit(1).count():
            break
        labels = stored(following.select("node", "label"), "labels")
        discard(following)
    of_record = held.join(labels.select("node", "label"), "node").groupBy("record").agg(F.min("label").alias("label"))
    return rows.select("record").distinct().join(of_record, "record", "left").select("record", F.coalesce("label", F.concat(F.lit("r:"), F.col("record"))).alias("component"))


def label_counts(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members (record, component), labels (record, label): component, label, k records that have it."""
    return members.join(labels.distinct(), "record").groupBy("component", "label").agg(F.count(F.lit(1)).alias("k"))


def _vectors(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """component, n, label vector (a map of label to count) and, where ``wanted`` is known, what the splits want of a label (a map), of the components in ``sizes``."""
    vector = F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "k")))).alias("vector")
    wants = F.map_from_entries(F.collect_list(F.when(F.col("wanted").isNotNull(), F.struct("label", "wanted")))).alias("wants")
    empty = {"vector": "map<string,bigint>", "wants": "map<string,array<double>>"}
    return sizes.join(counts.groupBy("component").agg(vector, wants), "component", "left").withColumns({k: F.coalesce(k, F.create_map().cast(kind)) for k, kind in empty.items()})


def _place(pdf: pd.DataFrame, need: dict[str, np.ndarray], total_need: np.ndarray, names: list[str]) -> list[str]:
    """The greedy pass over one set of components; ``need`` holds, per label, what each split still wants, and is used up."""
    vectors = [dict(v) for v in pdf["vector"]]
    sizes = pdf["n"].to_numpy()
    order = np.lexsort((pdf["component"].to_numpy(), -sizes))
    placed: list[str | None] = [None] * len(pdf)
    having: dict[str, list[int]] = {}
    outstanding: dict[str, int] = {}
    for i in order:
        for label, k in vectors[i].items():
            having.setdefault(label, []).append(i)
            outstanding[label] = outstanding.get(label, 0) + k

    def put(i: int, wanted: np.ndarray) -> None:
        wanted = np.minimum(wanted, total_need)  # a split that is full by records takes no more for one label's sake
        best = np.flatnonzero(wanted == wanted.max())
        s = int(best[np.argmax(total_need[best])])
        placed[i] = names[s]
        total_need[s] -= sizes[i]
        for label, k in vectors[i].items():
            outstanding[label] -= k
            if outstanding[label]:
                heapq.heappush(queue, (outstanding[label], label))
            need.setdefault(label, np.zeros(len(names)))[s] -= k

    queue = [(k, label) for label, k in outstanding.items()]
    heapq.heapify(queue)
    while queue:
        k, label = heapq.heappop(queue)
        if outstanding[label] == k:  # else it has fewer by now, and stands in the queue with that
            for i in having[label]:
                if placed[i] is None:
                    put(i, need.setdefault(label, np.zeros(len(names))))
    for i in order:
        if placed[i] is None:
            put(i, total_need)
    return placed


def _shared_out(label: str, shard: int, part: int, wanted: np.ndarray, mine: int) -> np.ndarray:
    """``mine`` records of a label by the shares of ``wanted``, in whole records; the rounding is right on average: drawn by hash, or
    for the parts a label was spread in, evenly from part to part."""
    cumulated = np.cumsum(wanted / max(wanted.sum(), 1e-9)) * mine
    cumulated[-1] = mine
    draw = zlib.crc32(f"{shard}|{label}".encode()) / 2**32 if part < 0 else (zlib.crc32(label.encode()) / 2**32 + part * 0.6180339887498949) % 1
    return np.diff(np.floor(np.r_[0.0, cumulated] + draw))


def assign_splits(counts: DataFrame, sizes: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """counts (component, label, k), sizes (component, n): (component, split), near the target shares by records."""
    targets = targets or TARGETS
    names, shares = list(targets), np.array(list(targets.values())) / sum(targets.values())
    counts, sizes = stored(counts, "label-counts"), stored(sizes, "component-sizes")
    whole = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, n_components = whole[0] or 0, whole[1]
    tally = stored(counts.groupBy("label").agg(F.sum("k").alias("total")), "label-totals")
    share = lambda s: F.lit(float(shares[names.index(s)])) * F.col("total")
    heavy = stored(sizes.where(F.col("n") * HEAVY > total), "heavy-components")
    light = sizes.where(F.col("n") * HEAVY <= total)
    steered = stored(counts.join(F.broadcast(heavy.select("component")), "component"), "heavy-counts")
    profiles = steered.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("component", "k"))).alias("profile"))
    kept = stored(profiles.groupBy("profile").agg(F.min("label").alias("label")).select("label"), "heavy-labels")
    needs = stored(lookup(tally, kept, "label", "left_semi").select("label", F.array(*(share(s) for s in names)).alias("wanted")), "heavy-needs")

    def place_heavy(pdf: pd.DataFrame) -> pd.DataFrame:
        need = {label: np.array(v) for wants in pdf["wants"] for label, v in dict(wants).items()}
        return pd.DataFrame({"component": pdf["component"], "split": _place(pdf, need, shares * total, names)})

    first = stored(_vectors(lookup(steered, needs, "label"), heavy).withColumn("all", F.lit(0)).groupBy("all").applyInPandas(place_heavy, "component string, split string"), "heavy-splits")
    used = steered.join(F.broadcast(first), "component").groupBy("label").agg(*(F.sum(F.when(F.col("split") == s, F.col("k")).otherwise(0)).alias(f"used {i}") for i, s in enumerate(names)))
    rest = lookup(tally, stored(used, "labels-used"), "label").select("label", F.array(*(F.greatest(share(s) - F.col(f"used {i}"), F.lit(0.0)) for i, s in enumerate(names))).alias("wanted"))
    rest = stored(rest, "labels-left")
    used_all = {r[0]: r[1] for r in heavy.join(first, "component").groupBy("split").agg(F.sum("n")).collect()}
    rest_all = np.maximum(shares * total - np.array([used_all.get(s, 0) for s in names]), 0)
    shards = max(1, -(-(n_components - heavy.count()) // SHARD_COMPONENTS))

    def place_light(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        mine: dict[tuple[str, int], int] = {}
        for v, rare, part in zip(pdf["vector"], pdf["rare"], pdf["part"]):
            for label, k in dict(v).items():
                of = (label, int(part) if label == rare else -1)
                mine[of] = mine.get(of, 0) + k
        rest = {label: np.array(v) for wants in pdf["wants"] for label, v in dict(wants).items()}
        need: dict[str, np.ndarray] = {}
        for (label, part), k in mine.items():
            v = rest[label] if label in rest and rest[label].sum() > 0 else shares
            need[label] = need.get(label, 0) + (v / v.sum() * k if shards == 1 else _shared_out(label, int(key[0]), part, v, k))
        left = rest_all if rest_all.sum() > 0 else shares
        return pd.DataFrame({"component": pdf["component"], "split": _place(pdf, need, left / left.sum() * pdf["n"].sum(), names)})

    light = _vectors(lookup(counts, rest, "label", "left"), light)
    if shards == 1:
        light = light.withColumns({"rare": F.lit(""), "part": F.lit(0).cast("bigint"), "shard": F.lit(0).cast("bigint")})
    else:
        part = max(1, SHARD_COMPONENTS // 8)
        rarest = lookup(counts, tally, "label").groupBy("component").agg(F.min(F.struct("total", "label")).alias("r"))
        spread = F.pmod(F.xxhash64("component"), F.ceil(F.coalesce("r.total", F.lit(1)) / part))
        light = light.join(rarest, "component", "left").withColumns({"rare": F.coalesce("r.label", F.lit("")), "part": spread}).drop("r")
        light = light.withColumn("shard", F.pmod(F.xxhash64("rare", "part"), F.lit(shards)))
    second = light.groupBy("shard").applyInPandas(place_light, "component string, split string")
    return first.unionByName(second)


def _marks(records: DataFrame, record: str, labels: list[str]) -> DataFrame:
    marks = [F.concat(F.lit(f"{name}="), F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))) for name in labels]
    return records.select(F.col(f"`{record}`").cast("string").alias("record"), F.explode(F.array(*marks)).alias("label")).where("record is not null")


def split_records(records: DataFrame, record: str, keys: list[str], labels: list[str], targets: dict[str, float] | None = None) -> DataFrame:
    """(record, component, split) for every distinct record."""
    members = stored(components(records, record, keys), "members")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    placed = stored(assign_splits(label_counts(members, _marks(records, record, labels)), sizes, targets), "splits")
    return lookup(members, placed, "component").select("record", "component", "split")


def out_of_home(records: DataFrame, record: str, key: str, label: str, labels: list[str] | None = None) -> DataFrame:
    """Records whose (non-null) label is not the one most records of their component have: (record,).

    All records are placed by ``split_records`` (stratified by ``labels``, by default the label itself) and judged within the
    components of that placement; a record without a key is a component of its own and never out of it.
    """
    placed = stored(split_records(records, record, [key], labels or [label]), "placed")
    delivered = records.select(F.col(f"`{record}`").cast("string").alias("record"), F.col(f"`{label}`").alias("label")).where("label is not null").distinct()
    counts = label_counts(placed, delivered)
    home = stored(counts.groupBy("component").agg(F.min_by("label", F.struct(-F.col("k"), "label")).alias("home")), "homes")
    return lookup(placed.join(delivered, "record"), home, "component").where("label <> home").select("record").distinct()
