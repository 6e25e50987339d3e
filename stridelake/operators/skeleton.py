"""Skeleton trees: closure, relations, chains, orders, pruning and rest poses.

A skeleton is one row with its parent array (-1 at the root), so its size is bounded by its joints: the closure of each
is made in one Arrow pass without a shuffle, and everything else is joins and aggregates over closure rows.
Forests, cycles and parents out of range do not crash: joints that never reach a root get no closure row above the break
and are reported by ``validate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

CLOSURE = "object_type string, joint int, ancestor int, hops int"
MAX_HOPS = 5


def joints(topology: DataFrame) -> DataFrame:
    """One row per joint: object_type, joint, parent, name, ox, oy, oz."""
    rows = topology.select("object_type", F.posexplode("parents").alias("joint", "parent"), "joints_names", "offsets")
    at = lambda k: F.get(F.get("offsets", F.col("joint")), F.lit(k))
    return rows.select("object_type", "joint", "parent", F.get("joints_names", F.col("joint")).alias("name"), at(0).alias("ox"), at(1).alias("oy"), at(2).alias("oz"))


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: tuple[list, list, list, list] = ([], [], [], [])
        for name, parents in zip(batch.column("object_type").to_pylist(), batch.column("parents").to_pylist()):
            for j in range(len(parents or [])):
                at, hops = j, 0
                while at is not None and 0 <= at < len(parents) and hops <= len(parents):
                    for column, x in zip(out, (name, j, at, hops)):
                        column.append(x)
                    at, hops = parents[at], hops + 1
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *(pa.array(x, pa.int32()) for x in out[1:])], names=["object_type", "joint", "ancestor", "hops"])


def closure(topology: DataFrame) -> DataFrame:
    """Every joint with each of its ancestors, itself included, and the number of bones between."""
    return topology.select("object_type", "parents").mapInArrow(_close, CLOSURE)


def edge_relations(topology: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """For every two joints i, j of a skeleton: what j is to i, and the bones between them up to ``max_hops``.

    0 itself, 1 parent, 2 child, 3 sibling, 4 none, 5 itself and an end joint; the child test comes before the parent test.
    """
    up = closure(topology)
    depth = up.groupBy("object_type", "joint").agg(F.max("hops").alias("depth"))
    node = joints(topology).select("object_type", "joint", "parent").join(depth, ["object_type", "joint"])
    a = node.select("object_type", F.col("joint").alias("i"), F.col("parent").alias("pi"), F.col("depth").alias("di"))
    b = node.select("object_type", F.col("joint").alias("j"), F.col("parent").alias("pj"), F.col("depth").alias("dj"))
    pairs = a.join(b, "object_type")  # within one skeleton: joints squared, bounded by the skeleton
    ui = up.select("object_type", F.col("joint").alias("i"), "ancestor", F.col("hops").alias("hi"))
    uj = up.select("object_type", F.col("joint").alias("j"), "ancestor", F.col("hops").alias("hj"))
    near = ui.join(uj, ["object_type", "ancestor"]).groupBy("object_type", "i", "j").agg(F.min(F.col("hi") + F.col("hj")).alias("hops"))
    ends = node.select("object_type", F.col("parent").alias("i")).where("i >= 0").distinct().withColumn("inner", F.lit(True))
    kind = (
        F.when((F.col("i") == F.col("j")) & F.col("inner").isNull(), 5).when(F.col("i") == F.col("j"), 0).when(F.col("pj") == F.col("i"), 2)
        .when(F.col("j") == F.col("pi"), 1).when(F.col("pj") == F.col("pi"), 3).otherwise(4)
    )
    out = pairs.join(near, ["object_type", "i", "j"], "left").join(ends, ["object_type", "i"], "left")
    return out.select("object_type", "i", "j", kind.alias("relation"), F.least(F.col("hops"), F.lit(max_hops)).alias("hops"))


def family(topology: DataFrame) -> DataFrame:
    """Per joint: sorted children, descendants and ancestors (both without itself)."""
    up = closure(topology).where("hops > 0")
    down = up.groupBy("object_type", F.col("ancestor").alias("joint")).agg(F.array_sort(F.collect_list("joint")).alias("descendants"), F.array_sort(F.collect_list(F.when(F.col("hops") == 1, F.col("joint")))).alias("children"))
    above = up.groupBy("object_type", "joint").agg(F.array_sort(F.collect_list("ancestor")).alias("ancestors"))
    empty = F.array().cast("array<int>")
    out = joints(topology).select("object_type", "joint").join(down, ["object_type", "joint"], "left").join(above, ["object_type", "joint"], "left")
    return out.select("object_type", "joint", *(F.coalesce(c, empty).alias(c) for c in ("children", "descendants", "ancestors")))


def root_chains(topology: DataFrame) -> DataFrame:
    """The path from the root to each end joint."""
    up = closure(topology)
    inner = joints(topology).select("object_type", F.col("parent").alias("joint")).distinct()
    paths = up.join(inner, ["object_type", "joint"], "left_anti")
    return paths.groupBy("object_type", F.col("joint").alias("end_joint")).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("hops")).alias("k"), "ancestor"))), lambda x: x["ancestor"]).alias("chain"))


def _chains(policy: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, numbers, chains = [], [], []
            for name, parents in zip(batch.column("object_type").to_pylist(), batch.column("parents").to_pylist()):
                children: dict[int, list[int]] = {}
                for j, p in enumerate(parents or []):
                    children.setdefault(p, []).append(j)
                todo = [[r] for r in children.get(-1, [])[::-1]]
                made = []
                while todo:
                    chain = todo.pop()
                    while below := children.get(chain[-1]):
                        go_on = max(below) if policy == "h_first" else min(below)
                        todo += [[chain[-1], c] for c in sorted(below, reverse=True) if c != go_on]
                        chain.append(go_on)
                    made.append(chain)
                names += [name] * len(made)
                numbers += range(len(made))
                chains += made
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int32()), pa.array(chains, pa.list_(pa.int32()))], names=["object_type", "number", "chain"])

    return run


def kinematic_chains(topology: DataFrame, policy: str = "h_first") -> DataFrame:
    """Chains that cover every bone once: a chain goes on with the highest (``h_first``) or lowest child; each other child starts a chain at the branching joint."""
    return topology.select("object_type", "parents").mapInArrow(_chains(policy), "object_type string, number int, chain array<int>")


def level_order(topology: DataFrame) -> DataFrame:
    """Breadth-first order with children by number: old joint, new joint, new parent."""
    up = closure(topology)
    path = up.groupBy("object_type", "joint").agg(F.max("hops").alias("level"), F.transform(F.array_sort(F.collect_list(F.struct((-F.col("hops")).alias("k"), "ancestor"))), lambda x: x["ancestor"]).alias("path"))
    # among joints of one level, breadth-first order is the order of their paths
    ranked = path.withColumn("new_joint", F.row_number().over(W.partitionBy("object_type").orderBy("level", "path")) - 1)
    old = joints(topology).select("object_type", "joint", "parent")
    new_parent = ranked.select("object_type", F.col("joint").alias("parent"), F.col("new_joint").alias("new_parent"))
    return ranked.select("object_type", "joint", "new_joint", "level").join(old, ["object_type", "joint"]).join(new_parent, ["object_type", "parent"], "left").select("object_type", "joint", "new_joint", "level", F.coalesce("new_parent", F.lit(-1)).alias("new_parent"))


def rest_positions(topology: DataFrame) -> DataFrame:
    """Rest-pose positions: the sum of the offsets from the joint up to its root."""
    up = closure(topology)
    own = joints(topology).select("object_type", F.col("joint").alias("ancestor"), "ox", "oy", "oz")
    return up.join(own, ["object_type", "ancestor"]).groupBy("object_type", "joint").agg(F.sum("ox").alias("x"), F.sum("oy").alias("y"), F.sum("oz").alias("z"))


def offsets_of(positions: DataFrame, topology: DataFrame) -> DataFrame:
    """Offsets from rest-pose positions."""
    own = positions.join(joints(topology).select("object_type", "joint", "parent"), ["object_type", "joint"])
    above = positions.select("object_type", F.col("joint").alias("parent"), *(F.col(c).alias(f"p{c}") for c in "xyz"))
    return own.join(above, ["object_type", "parent"], "left").select("object_type", "joint", *((F.col(c) - F.coalesce(f"p{c}", F.lit(0.0))).alias(f"o{c}") for c in "xyz"))


def bone_lengths(topology: DataFrame) -> DataFrame:
    """Length of the bone that ends at each joint but the root."""
    return joints(topology).where("parent >= 0").select("object_type", "joint", "parent", F.sqrt(F.col("ox") ** 2 + F.col("oy") ** 2 + F.col("oz") ** 2).alias("length"))


def scale_factors(topology: DataFrame, mean_length: float, eps: float = 1e-8) -> DataFrame:
    """What brings a skeleton's mean bone length (of its declared scale joints, if any) to ``mean_length``."""
    declared = topology.select("object_type", F.col("scale_ref_joint_idx").alias("used"))
    rows = bone_lengths(topology).join(declared, "object_type").where((F.col("used").isNull() | (F.size("used") == 0) | F.array_contains("used", F.col("joint"))) & (F.col("length") > eps))
    return rows.groupBy("object_type").agg(F.count(F.lit(1)).alias("n_bones"), (F.lit(mean_length) / F.avg("length")).alias("factor"))


def tree_distances(topology: DataFrame) -> DataFrame:
    """Length of the way along bones between any two joints of a skeleton."""
    up = closure(topology)
    own = bone_lengths(topology).select("object_type", F.col("joint").alias("ancestor"), "length")
    # length from the joint up to each ancestor: the bones of the joints strictly below it
    w = W.partitionBy("object_type", "joint").orderBy("hops").rowsBetween(W.unboundedPreceding, -1)
    climbed = up.join(own, ["object_type", "ancestor"], "left").withColumn("up", F.coalesce(F.sum("length").over(w), F.lit(0.0)))
    i = climbed.select("object_type", F.col("joint").alias("i"), "ancestor", F.col("up").alias("ui"))
    j = climbed.select("object_type", F.col("joint").alias("j"), "ancestor", F.col("up").alias("uj"))
    return i.join(j, ["object_type", "ancestor"]).where("i < j").groupBy("object_type", "i", "j").agg(F.min(F.col("ui") + F.col("uj")).alias("length"))


def prune(topology: DataFrame, helper: Column) -> DataFrame:
    """Joints left when those whose name meets ``helper`` go with all their descendants; numbered anew, parents too."""
    j = joints(topology)
    gone = closure(topology).join(j.where(helper).select("object_type", F.col("joint").alias("ancestor")), ["object_type", "ancestor"], "left_semi").select("object_type", "joint").distinct()
    left = j.join(gone, ["object_type", "joint"], "left_anti").withColumn("new_joint", F.row_number().over(W.partitionBy("object_type").orderBy("joint")) - 1)
    new_parent = left.select("object_type", F.col("joint").alias("parent"), F.col("new_joint").alias("new_parent"))
    return left.join(new_parent, ["object_type", "parent"], "left").select("object_type", "joint", "name", "new_joint", F.coalesce("new_parent", F.lit(-1)).alias("new_parent"))


def index_list_state(listed: Column, n_joints: Column) -> Column:
    """none (null), empty, valid, or what is wrong: null, repeated, or out of range."""
    return (
        F.when(listed.isNull(), "none").when(F.size(listed) == 0, "empty").when(F.exists(listed, lambda x: x.isNull()), "error:null")
        .when(F.exists(listed, lambda x: (x < 0) | (x >= n_joints)), "error:range").when(F.size(F.array_distinct(listed)) < F.size(listed), "error:repeated").otherwise("valid")
    )


def validate(topology: DataFrame) -> DataFrame:
    """Per skeleton the list of broken rules, in a fixed order; an empty list means it is sound."""
    reach = closure(topology).groupBy("object_type").agg(F.countDistinct(F.when(F.col("ancestor") == 0, F.col("joint"))).alias("reached"))
    p, n = F.col("parents"), F.size("parents")
    rules = {
        "no single root": F.size(F.filter(p, lambda x: x == -1)) != 1,
        "root not first": F.get(p, F.lit(0)) != -1,
        "parent out of range": F.exists(p, lambda x: (x < -1) | (x >= n)),
        "own parent": F.exists(F.transform(p, lambda x, i: x == i), lambda b: b),
        "parent after joint": F.exists(F.transform(p, lambda x, i: x > i), lambda b: b),
        "not connected": F.coalesce(F.col("reached"), F.lit(0)) != n,
        "joint count": F.col("n_joints") != n,
        "offsets shape": (F.size("offsets") != n) | F.exists("offsets", lambda o: F.size(o) != 3),
        "offsets not finite": F.exists("offsets", lambda o: F.exists(o, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))),
        "names": (F.size("joints_names") != n) | (F.size(F.array_distinct("joints_names")) != n),
        "feet": F.startswith(index_list_state(F.col("foot_joint_idx"), n), F.lit("error")),
        "scale joints": F.startswith(index_list_state(F.col("scale_ref_joint_idx"), n), F.lit("error")),
    }
    issues = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules.items()]))
    return topology.join(reach, "object_type", "left").select("object_type", issues.alias("issues"))


def constraints(topology: DataFrame) -> DataFrame:
    """Pairs of joints that keep their distance at rest: each joint and its parent, and children of one joint: (object_type, i, j, kind, length), i below j."""
    pos = rest_positions(topology).select("object_type", "joint", "x", "y", "z")
    child = joints(topology).where("parent >= 0").select("object_type", "joint", "parent")
    edges = child.select("object_type", F.least("joint", "parent").alias("i"), F.greatest("joint", "parent").alias("j"), F.lit("bone").alias("kind"))
    # the children of a joint are few: skeletons are bounded by their joints
    other = child.select("object_type", "parent", F.col("joint").alias("j"))
    siblings = child.withColumnRenamed("joint", "i").join(other, ["object_type", "parent"]).where("i < j").select("object_type", "i", "j", F.lit("sibling").alias("kind"))
    at = lambda k: pos.select("object_type", F.col("joint").alias(k), *(F.col(c).alias(f"{k}_{c}") for c in "xyz"))
    met = edges.unionByName(siblings).join(at("i"), ["object_type", "i"]).join(at("j"), ["object_type", "j"])
    return met.select("object_type", "i", "j", "kind", F.sqrt(sum((F.col(f"i_{c}") - F.col(f"j_{c}")) ** 2 for c in "xyz")).alias("length"))


def feet_with_below(topology: DataFrame, tokens: str = "toe|foot|hoof|ashi") -> DataFrame:
    """Per skeleton the joints named as feet and all joints below them; every joint, unnamed, where a skeleton has none: (object_type, joint, named)."""
    named = joints(topology).where(F.lower("name").rlike(tokens)).select("object_type", F.col("joint").alias("ancestor"))
    below = closure(topology).join(named, ["object_type", "ancestor"], "left_semi").select("object_type", "joint").distinct()
    without = topology.select("object_type").join(named.select("object_type").distinct(), "object_type", "left_anti")
    every = joints(topology).join(without, "object_type", "left_semi").select("object_type", "joint", F.lit(False).alias("named"))
    return below.withColumn("named", F.lit(True)).unionByName(every)
