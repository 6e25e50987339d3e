import random
from collections import Counter

from stridelake.llm import splits

SCHEMA = "id string, author string, source string, label string, component string, record string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "r", 1) for r in rows], SCHEMA)


def union_find(rows):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, a, s, _ in rows:
        if i is None:
            continue
        root(("r", i))
        for kind, k in (("a", a), ("s", s)):
            if k is not None:
                up[root((kind, k))] = root(("r", i))
    return {i: root(("r", i)) for i, *_ in rows if i is not None}


def test_components_of_several_keys(spark):
    rnd = random.Random(4)
    rows = [(f"r{i}", rnd.choice([None, f"a{rnd.randrange(120)}"]), rnd.choice([None, f"s{rnd.randrange(150)}"]), "x") for i in range(200)]
    rows += rows[:20] + [(None, "a1", "s1", "x")]
    got = {r["record"]: r["component"] for r in splits.components(frame(spark, rows), "id", ["author", "source"]).collect()}
    want = union_find(rows)
    assert set(got) == set(want)
    assert len(set(zip(got.values(), (want[k] for k in got)))) == len(set(got.values())) == len(set(want.values()))


def test_splits_keep_components_and_shares(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(f"r{i}", rnd.choice(["hot", f"a{rnd.randrange(200)}", f"a{rnd.randrange(200)}"]) if i % 50 else None, None, rnd.choice(["u", "v", None])) for i in range(3000)]
    for heavy, shard in ((1000, 50_000), (20, 60)):  # also with most components in shards of their own
        monkeypatch.setattr(splits, "HEAVY", heavy)
        monkeypatch.setattr(splits, "SHARD_COMPONENTS", shard)
        got = splits.split_records(frame(spark, rows + rows[:100]), "id", ["author"], ["label"], {"train": 0.6, "val": 0.2, "test": 0.2}).collect()
        assert len(got) == 3000
        assert all(len({r["split"] for r in got if r["component"] == c}) == 1 for c in {r["component"] for r in got})
        n = Counter(r["split"] for r in got)
        assert abs(n["train"] - 1800) < 60 and abs(n["val"] - 600) < 60 and abs(n["test"] - 600) < 60
        label = {r[0]: r[3] for r in rows}
        share = Counter(label[r["record"]] for r in got if r["split"] == "test")
        assert abs(share["u"] / n["test"] - 1 / 3) < 0.06


def test_rare_labels_over_many_shards(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(f"r{i}", f"a{i}", None, f"rare{i % 60}" if i < 6000 else rnd.choice("uv")) for i in range(20_000)]  # 60 labels of 100 records
    for shard, near in ((20, 8), (1000, 2)):  # a thousand shards, smaller than a label; and shards that hold whole labels
        monkeypatch.setattr(splits, "SHARD_COMPONENTS", shard)
        got = {r["record"]: r["split"] for r in splits.split_records(frame(spark, rows), "id", ["author"], ["label", "source"]).collect()}
        off = []
        for k in range(60):
            n = Counter(got[f"r{i}"] for i in range(k, 6000, 60))
            off.append(max(abs(n["train"] - 80), abs(n["val"] - 10), abs(n["test"] - 10)))
        assert max(off) <= near and sum(off) / 60 <= near / 2, off
        n = Counter(got.values())
        assert abs(n["train"] - 16_000) < 300 and abs(n["val"] - 2_000) < 200


def test_out_of_home(spark):
    rows = [("r1", "a", None, "train"), ("r2", "a", None, "train"), ("r3", "a", None, "val"), ("r4", "a", None, None), ("r5", None, None, "val"), ("r6", "b", None, "test"), ("r3", "a", None, "val"), ("r7", "c", None, None)]
    assert [r[0] for r in splits.out_of_home(frame(spark, rows), "id", "author", "label").collect()] == ["r3"]


def test_empty(spark):
    df = frame(spark, [])
    assert splits.split_records(df, "id", ["author"], ["label"]).count() == 0
    assert splits.split_records(df, "id", ["author", "source"], ["label"]).count() == 0
    assert splits.out_of_home(df, "id", "author", "label").count() == 0
