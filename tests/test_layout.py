from pyspark.sql import functions as F

from stridelake.operators import conditions as C
from stridelake.operators import layout as L


def test_caption_records_of_odd_lines(spark):
    lines = [("a/x_keypoints.txt", 0, "wolf#male#walks  slowly#x/y#0"), ("a/x_keypoints.txt", 1, "  runs "), ("a/x_keypoints.txt", 2, "runs"), ("a/x_keypoints.txt", 3, ""), ("a/x_keypoints.txt", 4, None), ("a/none.txt", 0, "wolf#male# #t"), ("a/w.txt", 0, "one#two")]
    got = {r["path"]: r for r in L.caption_records(spark.createDataFrame(lines, "path string, place int, line string"), "path", "place", "line").collect()}
    assert set(got) == {"a/x_keypoints.txt", "a/w.txt"}
    r = got["a/x_keypoints.txt"]
    assert (r["source_key"], r["captions"], r["animals"], r["sexes"], r["tagged"]) == ("x", ["walks slowly", "runs"], ["wolf"], ["male"], ["x/y"])
    assert got["a/w.txt"]["captions"] == ["one#two"]


def test_last_file_of_a_key_counts(spark):
    rows = spark.createDataFrame([("A-b", "1"), ("a_B", "2"), (None, "3")], "k string, path string")
    assert {(r["norm"], r["path"]) for r in L.last_by_key(rows, F.col("k"), "path").collect()} == {("ab", "2"), (None, "3")}


def test_manifest_beats_the_guess(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    manifest = spark.createDataFrame([("a", "x"), ("b", None)], "k string, owner string")
    got = {r["k"]: (r["owner"], r["origin"]) for r in L.mapped(rows, "k", manifest, F.when(F.col("k") != "c", "guess")).collect()}
    assert got == {"a": ("x", "manifest"), "b": (None, "manifest"), "c": (None, "none")}


def test_a_fallback_counts_only_where_it_is_the_only_one(spark):
    rows = spark.createDataFrame([("o", "m1", "g"), ("o", "m2", "g"), ("p", "m3", "h"), ("q", "m4", None)], "owner string, motion_id string, group string")
    assets = spark.createDataFrame([("m2", "own")], "motion_id string, asset string")
    spare = spark.createDataFrame([("g", "s"), ("g", "s"), ("h", "s"), ("h", "t")], "group string, asset string")
    got = [(r["owner"], r["motion_id"], r["asset"], r["origin"]) for r in L.resolved(rows, ["motion_id"], assets, spare, [F.col("motion_id")]).collect()]
    assert got == [("o", "m1", "s", "inferred")]


def test_an_empty_list_is_no_filter(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    lists = lambda *x: spark.createDataFrame([(v,) for v in x], "name string")
    assert [r[0] for r in L.chosen(rows, "k", lists(" b ", "")).collect()] == ["b"]
    assert {r[0] for r in L.chosen(rows, "k", lists("", None), lists("a")).collect()} == {"b", None}
    assert L.chosen(rows.limit(0), "k", lists("b")).count() == 0


def test_padding(spark):
    sizes = spark.createDataFrame([("o", 2)], "object_type string, n_joints int")
    assert C.pair_mask(sizes, 3).where("mask = 1").count() == 9 and C.pair_mask(sizes, 3).count() == 16
    stats = spark.createDataFrame([("o", 0, 0, 5.0, 2.0)], "object_type string, joint int, channel int, mean double, std double")
    grid = C.padded_statistics(stats, sizes, 2, 2)
    assert grid.count() == 4 and sorted((r["mean"], r["std"]) for r in grid.collect()) == [(0.0, 1.0)] * 3 + [(5.0, 2.0)]
    assert C.pair_mask(sizes.limit(0), 3).count() == 0


def test_vertices_that_are_not_finite(spark):
    points = spark.createDataFrame([("a", 1.0, 2.0, 3.0), ("a", float("nan"), 9.0, 9.0), ("b", None, 0.0, 0.0)], "k string, x double, y double, z double")
    got = {r["k"]: r for r in L.vertex_summary(points, ["k"], ("x", "y", "z")).collect()}
    assert (got["a"]["n_points"], got["a"]["finite"], got["a"]["max_y"]) == (2, False, 2.0) and got["b"]["min_x"] is None
