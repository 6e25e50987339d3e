import numpy as np

from stridelake.llm import packing


def test_fill_is_tight_and_whole():
    rng = np.random.default_rng(1)
    sizes = np.r_[rng.integers(1, 4097, 500), rng.integers(1, 300, 9000)]
    container, start, kinds = packing.fill(sizes, 4096, 4)
    filled = np.bincount(container, sizes)
    assert filled.max() <= 4096 and len(filled) == len(kinds)
    assert len(kinds) <= -(-sizes.sum() // 4096) + 1
    order = np.lexsort((start, container))
    c, s, n = container[order], start[order], sizes[order]
    same = c[1:] == c[:-1]
    assert (s[1:][same] == (s + n)[:-1][same]).all() and (s[1:][~same] == 0).all()


def test_fill_edges():
    for sizes in ([], [4096], [1], [4096, 4096, 1], [2048, 2048], [1] * 4097):
        container, _, kinds = packing.fill(np.array(sizes, np.int64), 4096, 4)
        assert len(kinds) == -(-sum(sizes) // 4096)
        assert len(container) == len(sizes)


SCHEMA = "doc_id bigint, text string, version string, tokens int, shard int"


def test_pack_texts(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, " "), (4, "a" * 4095), (5, "a" * 4096), (6, "é" * 10_000), (7, "x"), (7, "x"), (7, "yy"), (None, "z")] + [(i, "t" * (i % 900)) for i in range(10, 400)]
    df = spark.createDataFrame([(*r, "v", 1, 1) for r in rows], SCHEMA)
    for shard in (64_000_000, 20_000):
        monkeypatch.setattr(packing, "SHARD_TOKENS", shard)
        got = packing.pack_texts(df).collect()
        tokens = {}
        for r in got:
            tokens.setdefault((r["doc_id"], r["version"]), []).append(r)
        assert {k[0] for k in tokens} == {r[0] for r in rows if r[0] and r[1] is not None} and len([k for k in tokens if k[0] == 7]) == 2
        size = {k: sum(x["n_tokens"] for x in v) for k, v in tokens.items()}
        assert {k[0]: v for k, v in size.items() if k[0] < 7} == {2: 1, 3: 2, 4: 4096, 5: 4097, 6: 20001}
        assert all(len(v) == 1 for k, v in tokens.items() if size[k] <= 4096)
        assert sorted(x["piece"] for k, v in tokens.items() if k[0] == 6 for x in v) == [0, 1, 2, 3, 4]
        fill = {}
        for r in got:
            fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
        assert max(fill.values()) <= 4096
        assert len({(r["container_id"], r["place"]) for r in got}) == len(got)
    assert packing.pack_texts(df.limit(0)).count() == 0


def test_step_groups_are_balanced(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, "t" * int(n)) for i, n in enumerate(rng.integers(1, 3000, 3000))], "doc_id bigint, text string")
    groups = {}
    for r in packing.container_fill(packing.pack_texts(df)).collect():
        groups.setdefault(r["step_group"], []).append(r["n_tokens"])
    means = [np.mean(v) for v in groups.values()]
    assert max(map(len, groups.values())) <= packing.STEP_CONTAINERS
    assert np.median(means) - min(means) < 500
