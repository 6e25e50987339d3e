import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.operators import features as X
from stridelake.operators import manifest as M
from stridelake.operators import metrics
from stridelake.operators import sampling as P
from stridelake.operators import skeleton as S
from stridelake.sources import bvh, files

TREES = {"a": [-1, 0, 1, 1, 0, 4], "b": [-1], "c": [-1, 0, 0, 0], "two roots": [-1, -1, 0], "cycle": [-1, 2, 1], "far": [-1, 9]}


@pytest.fixture(scope="module")
def topology(spark):
    rows = [(k, len(p), p, [[0.0, 1.0, float(i)] for i in range(len(p))], [f"j{i}" for i in range(len(p))], [1] if len(p) > 1 else None, None) for k, p in TREES.items()]
    return spark.createDataFrame(rows, "object_type string, n_joints int, parents array<int>, offsets array<array<double>>, joints_names array<string>, foot_joint_idx array<int>, scale_ref_joint_idx array<int>")


def test_relations(topology):
    got = {(r["i"], r["j"]): (r["relation"], r["hops"]) for r in S.edge_relations(topology.where("object_type = 'a'")).collect()}
    assert got[0, 0] == (0, 0) and got[2, 2] == (5, 0) and got[0, 1] == (2, 1) and got[1, 0] == (1, 1) and got[2, 3] == (3, 2) and got[2, 5] == (4, 4)
    assert len(got) == 36


def test_chains_and_orders(topology):
    t = topology.where("object_type = 'a'")
    assert [r["chain"] for r in S.kinematic_chains(t).orderBy("number").collect()] == [[0, 4, 5], [0, 1, 3], [1, 2]]
    assert [r["chain"] for r in S.kinematic_chains(t, "l_first").orderBy("number").collect()] == [[0, 1, 2], [1, 3], [0, 4, 5]]
    assert sorted(tuple(r["chain"]) for r in S.root_chains(t).collect()) == [(0, 1, 2), (0, 1, 3), (0, 4, 5)]
    assert [r["joint"] for r in S.level_order(t).orderBy("new_joint").collect()] == [0, 1, 4, 2, 3, 5]


def test_validation(topology):
    got = {r["object_type"]: r["issues"] for r in S.validate(topology).collect()}
    assert got["a"] == got["c"] == got["b"] == []
    assert "no single root" in got["two roots"] and "not connected" in got["cycle"] and "parent out of range" in got["far"]


def test_rest_and_distances(topology):
    t = topology.where("object_type = 'a'")
    z = {r["joint"]: r["z"] for r in S.rest_positions(t).collect()}
    assert z == {0: 0, 1: 1, 2: 3, 3: 4, 4: 4, 5: 9}
    assert S.tree_distances(t).where("i = 2 and j = 5").first()["length"] == pytest.approx(sum(np.hypot(1, k) for k in (2, 1, 4, 5)))
    left = S.prune(t, F.col("name") == "j1").orderBy("joint").collect()
    assert [(r["joint"], r["new_joint"], r["new_parent"]) for r in left] == [(0, 0, -1), (4, 1, 0), (5, 2, 1)]


def test_kinematics_agree_with_positions(spark):
    """Positions made from rotations come back from both decoders."""
    rng = np.random.default_rng(2)
    parents, offsets = [-1, 0, 1, 1], rng.normal(size=(4, 3))
    offsets[0] = 0
    t = 12
    q = rng.normal(size=(t, 4, 4))
    q /= np.linalg.norm(q, axis=-1, keepdims=True)
    yaw = rng.uniform(-3, 3, t)
    root_q = np.c_[np.cos(yaw / 2), np.zeros(t), np.sin(yaw / 2), np.zeros(t)]

    def mat(p):
        w, x, y, z = np.moveaxis(p, -1, 0)
        return np.moveaxis(np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]]), (0, 1), (-2, -1))

    local, facing = mat(q), mat(root_q)
    root = np.cumsum(rng.normal(size=(t, 3)) * 0.1, axis=0)
    root[0] = [0, root[0, 1], 0]
    spin, place = [local[:, 0]], [root]
    for j in range(1, 4):
        p = parents[j]
        place.append(place[p] + np.einsum("tij,j->ti", spin[p], offsets[j]))
        spin.append(spin[p] @ local[:, j])
    place = np.stack(place, axis=1)
    rel = place - root[:, None] * [1, 0, 1]
    f = np.zeros((t, 4, 13), np.float64)
    f[..., :3] = np.einsum("tij,tkj->tki", facing, rel)
    carried = np.stack([facing] + [local[:, parents[j]] for j in range(1, 4)], axis=1)
    f[..., 3:6], f[..., 6:9] = carried[..., :, 0], carried[..., :, 1]
    step = np.einsum("tij,tj->ti", facing[1:], np.diff(root, axis=0))
    f[:-1, 0, 9], f[:-1, 0, 11] = step[:, 0], step[:, 2]
    rows = [("o", "m", i, j, [float(x) for x in f[i, j]]) for i in range(t) for j in range(4)]
    motion = spark.createDataFrame(rows, "object_type string, motion_id string, frame int, joint int, f array<double>")
    topology = spark.createDataFrame([("o", parents, offsets.tolist())], "object_type string, parents array<int>, offsets array<array<double>>")
    for out, names in ((X.world_positions(motion), "w0 w1 w2"), (X.forward_kinematics(motion, topology), "x y z")):
        got = np.array([[r[n] for n in names.split()] for r in out.orderBy("frame", "joint").collect()]).reshape(t, 4, 3)
        assert np.allclose(got, place, atol=1e-6)


def brute_cover(cost, shortest):
    n, m = cost.shape
    best = np.full(n + 1, np.inf)
    best[0] = 0
    for i in range(shortest, n + 1):
        for k in range(m):
            for c in range(i - shortest + 1):
                if k + i - c <= m:
                    best[i] = min(best[i], best[c] + sum(cost[c + s, k + s] for s in range(i - c)))
    return best[n] / n


def test_covers_and_windows():
    rng = np.random.default_rng(7)
    for n, m, s in ((12, 15, 3), (9, 5, 4), (7, 20, 7), (5, 4, 5)):
        cost = rng.uniform(size=(n, m))
        value, label = metrics.patched_cost(cost, s)
        want = brute_cover(cost, s)
        assert value == pytest.approx(want) or np.isinf(value) and np.isinf(want)
        if np.isfinite(value):
            assert cost[np.arange(n), label].mean() == pytest.approx(value)
        low = metrics.window_costs(cost, s)
        assert np.allclose(low, [min((np.mean([cost[i + t, k + t] for t in range(s)]) for k in range(m - s + 1)), default=np.inf) for i in range(n - s)])


def test_bvh_round_trip(spark, tmp_path):
    text = "HIERARCHY\nROOT hip\n{\n OFFSET 0 0 0\n CHANNELS 6 Xposition Yposition Zposition Zrotation Xrotation Yrotation\n JOINT leg\n {\n  OFFSET 0 -1 0\n  CHANNELS 3 Zrotation Xrotation Yrotation\n  End Site\n  {\n   OFFSET 0 -1 0\n  }\n }\n JOINT arm\n {\n  OFFSET 1 0 0\n  CHANNELS 3 Zrotation Xrotation Yrotation\n  End Site\n  {\n   OFFSET 0 0 0\n  }\n }\n}\nMOTION\nFrames: 2\nFrame Time: 0.05\n" + "1 2 3 10 20 30 40 50 60 5 6 7\n" * 2
    a = bvh.parse(text)
    assert a.names == ["hip", "leg", "leg_end_site", "arm"] and a.parents == [-1, 0, 1, 0] and a.rotations.shape == (2, 4, 4)
    b = bvh.parse(bvh.render(a))
    assert b.names == a.names and np.allclose(np.abs((a.rotations * b.rotations).sum(-1)), 1) and np.allclose(a.positions[:, 0], b.positions[:, 0])
    wrapped = text.replace("ROOT hip\n{", "ROOT wrap\n{\n OFFSET 0 0 0\n CHANNELS 0\n JOINT hip\n {", 1).replace("}\nMOTION", " }\n}\nMOTION")
    assert bvh.parse(bvh.promoted_root(wrapped)).names == a.names and bvh.promoted_root(text) == text
    (tmp_path / "good.bvh").write_text(text)
    (tmp_path / "bad.bvh").write_text(text.replace("Frames: 2", "Frames: 3"))
    spark.dataSource.register(bvh.BvhDataSource)
    for df in (bvh.read(spark, str(tmp_path)), spark.read.format("bvh").load(str(tmp_path))):
        assert df.where("error is null").count() == 8 and df.where("error is not null").count() == 1


def test_twin_root_is_merged():
    text = "HIERARCHY\nROOT a\n{\nOFFSET 0 0 0\nCHANNELS 6 Xposition Yposition Zposition Zrotation Xrotation Yrotation\nJOINT b\n{\nOFFSET 0 0 0\nCHANNELS 3 Zrotation Xrotation Yrotation\nJOINT c\n{\nOFFSET 0 1 0\nCHANNELS 3 Zrotation Xrotation Yrotation\n}\n}\n}\nMOTION\nFrames: 1\nFrame Time: 0.05\n0 1 0 0 0 90 0 0 90 0 0 0\n"
    a = bvh.parse(text)
    assert a.names == ["a", "c"] and a.parents == [-1, 0] and np.allclose(np.abs(a.rotations[0, 0]), [0, 0, 1, 0])


def test_tensor_and_caption_files(spark, tmp_path):
    np.save(tmp_path / "x.npy", np.arange(26, dtype=np.float32).reshape(1, 2, 13))
    np.save(tmp_path / "y.npy", np.zeros((2, 2)))
    (tmp_path / "z.npy").write_bytes(b"junk")
    got = files.read_features(spark, str(tmp_path))
    assert got.where("error is null").count() == 2 and got.where("error is not null").count() == 2
    assert got.where("joint = 1 and error is null").first()["f"][0] == 13
    text = spark.createDataFrame([("p", "Wolf#male#Runs.#tok\n\nbad#line\nOwl#f# Sits #t#1#2")], "path string, value string")
    rows = files.caption_lines(text).orderBy("line_no").collect()
    assert [(r["line_no"], r["caption"], r["f_tag"], r["parse_status"]) for r in rows] == [(1, "Runs.", "0.0", "ok"), (3, None, None, "bad_text_line"), (4, "Sits", "1", "ok")]
    lines = spark.createDataFrame([('{"id": "A-1", "caption": "x"}',), ('{"file": "a1", "texts": ["y", " ", "x"]}',), ('{"text": "lost"}',)], "value string")
    assert {r["key"]: r["texts"] for r in files.text_index(files.json_texts(lines)).collect()} == {"a1": ["x", "y"]}
    assert spark.range(1).select(files.frames_in_metadata(F.lit("a\ntotal frames: 12\ntotal frames: 3"))).first()[0] == 12


def test_manifest_matches(spark):
    names = spark.createDataFrame([("Wolf_Red_run_01", "Wolf"), ("Wolfish_run_02", "Wolfish"), ("Odd_thing", "Odd")], "name string, pre string")
    known = spark.createDataFrame([("Wolf",), ("Wolf_Red",)], "k string")
    assert {r["name"]: r["object_name"] for r in M.longest_prefix(names, "name", known, "k").collect()} == {"Wolf_Red_run_01": "Wolf_Red", "Wolfish_run_02": "Wolfish_run", "Odd_thing": "Odd"}
    stems = spark.createDataFrame([("Red_run", 2), ("run", 1), ("thing", 3)], "s string, p int")
    got = {r["name"]: (r["tier"], r["stem"]) for r in M.tiered_match(names, "name", "pre", stems, "s", "p").collect()}
    assert got == {"Wolf_Red_run_01": (1, "Red_run"), "Wolfish_run_02": (1, "run"), "Odd_thing": (3, "thing")}


def test_sampling(spark):
    clips = spark.createDataFrame([("a" if i < 90 else "b", f"m{i}") for i in range(100)], "g string, motion_id string")
    w = P.balanced_weights(clips, "g", "motion_id")
    assert w.agg(F.sum("weight")).first()[0] == pytest.approx(1)
    drawn = P.weighted_sample(w, "motion_id", "weight", 10, 1).groupBy("g").count().collect()
    assert {r["g"] for r in drawn} == {"a", "b"}
    b = P.batches(clips, 16, 3).collect()
    assert len(b) == 96 and len({(r["batch"], r["slot"]) for r in b}) == 96
