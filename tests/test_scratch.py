import pytest
from pyspark.sql import functions as F

from stridelake import scratch


def test_size_is_measured_uncompressed(spark):
    t = scratch.stored(spark.range(200_000).select("id", F.lit("x" * 50).alias("k")), "t")
    assert 1 << 12 < scratch.size_of(spark, t.stored_path) < 1 << 20
    assert not scratch.fits(t, 1 << 20) and scratch.fits(t, 1 << 25)
    scratch.discard(t)
    with pytest.raises(Exception):
        scratch.size_of(spark, t.stored_path)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_with_hot_keys(spark, monkeypatch, how):
    left = spark.createDataFrame([(None if i % 7 == 0 else "hot" if i % 3 else f"k{i % 40}", i) for i in range(600)], "k string, i int")
    right = scratch.stored(spark.createDataFrame([("hot", 1), *((f"k{i}", i) for i in range(30))], "k string, v int"), "r")
    want = sorted(map(str, left.join(right, "k", how).collect()))
    for limit in (1 << 20, 0):
        monkeypatch.setattr(scratch, "BROADCAST_BYTES", limit)
        assert sorted(map(str, scratch.lookup(left, right, "k", how).collect())) == want


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(ValueError):
        scratch.checkpoint_dir(Session())
