import os

from stridelake.plans import runs


def test_build_quarantines_and_reports(spark, tmp_path):
    adapter = runs.ParquetAdapter("/root/testdata/sf0.001")
    report = runs.build(spark, adapter, str(tmp_path))
    bad = spark.read.parquet(f"{tmp_path}/value_scan").where("size(reasons) > 0").select("motion_id")
    left = spark.read.parquet(f"{tmp_path}/motion").select("motion_id").distinct()
    assert left.count() and left.join(bad, "motion_id").count() == 0
    assert spark.read.parquet(f"{tmp_path}/statistics").count() > 0
    assert {r["gate"] for r in report.collect()} == {"A", "B", "C", "E"}
    assert os.path.exists(tmp_path / "_ACCEPTED") == (report.where("n_failed > 0").count() == 0)


class Sound:
    """One skeleton and one clip that pass every gate; ``bend`` moves a joint away from where its rotations put it."""

    def __init__(self, bend):
        self.bend = bend

    def topology(self, spark):
        s = "topology_id bigint, object_type string, version int, n_joints int, parents array<int>, offsets array<array<double>>, joints_names array<string>, foot_joint_idx array<int>, gate_c_mode string, scale_ref_joint_idx array<int>"
        d = 0.2092142857142857
        return spark.createDataFrame([(1, "wolf", 1, 3, [-1, 0, 1], [[0.0, 0.0, 0.0], [0.0, d, 0.0], [d, 0.0, 0.0]], ["hips", "spine", "head"], [], "clean", [])], s)

    def clips(self, spark):
        return spark.createDataFrame([("wolf_1", "wolf", "train", 7)], "motion_id string, object_type string, split string, source_frames int")

    def motion(self, spark):
        d, turn = 0.2092142857142857, [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]
        place = [[0.0, 1.0, 0.0], [0.0, 1.0 + d, 0.0], [d + self.bend, 1.0 + d, 0.0]]
        rows = [("wolf", "wolf_1", t, j, place[j] + turn + [0.0] * 4) for t in range(6) for j in range(3)]
        return spark.createDataFrame(rows, "object_type string, motion_id string, frame int, joint int, f array<float>")

    def listed(self, spark):
        return spark.createDataFrame([("wolf",)], "object_name string")


def test_acceptance_needs_every_gate(spark, tmp_path):
    out = str(tmp_path / "run")
    assert {r["gate"]: r["n_failed"] for r in runs.build(spark, Sound(0.0), out).collect()} == {"A": 0, "B": 0, "C": 0, "E": 0}
    assert os.path.exists(f"{out}/_ACCEPTED")
    assert {r["gate"]: r["n_failed"] for r in runs.build(spark, Sound(0.05), out).collect()} == {"A": 0, "B": 0, "C": 1, "E": 0}
    assert not os.path.exists(f"{out}/_ACCEPTED")  # the marker of the run before is gone


def test_evaluation_of_a_set_against_itself(spark):
    m = runs.ParquetAdapter("/root/testdata/sf0.001").motion(spark)
    one = m.groupBy("object_type").agg({"motion_id": "count"}).orderBy("count(motion_id)", ascending=False).first()[0]
    m = m.where(m["object_type"] == one)
    got = {(r["character"], r["metric"]): r["mean"] for r in runs.evaluate(m, m, 4).collect()}
    assert got["FINAL", "coverage_loc"] == 100 and abs(got["FINAL", "local_diversity_loc"]) < 1e-9 and abs(got["FINAL", "global_diversity_loc"]) < 1e-9
