import datetime as dt
import random

from stridelake.operators import archive, hotkeys, orphans

T = dt.datetime


def day(n):
    return None if n is None else T(2021, 1, 1) + dt.timedelta(days=n)


def test_orphans_match_brute_force(spark, monkeypatch):
    rnd = random.Random(3)
    parents = [(rnd.choice("abcdeé ") + str(rnd.randrange(40)), rnd.choice([None, *range(100)]), rnd.choice([None, *range(120)]), "z") for _ in range(300)]
    parents += parents[:40]
    refs = [(rnd.choice(["t", "u"]), f"r{i}", rnd.choice([None, "hot", "a1", rnd.choice("abcdefé ") + str(rnd.randrange(45))]), rnd.choice([None, *range(130)]), 1) for i in range(900)]
    refs += refs[:50] + [("t", None, "a1", 3, 1)]

    def held(key, at):
        mine = [(s, e) for k, s, e, _ in parents if k == key and s is not None and (e is None or e > s)]
        return bool(mine) if at is None else any(s <= at and (e is None or at < e) for s, e in mine)

    expected = {(t, r, None if at is None else day(at).strftime("%Y-%m")) for t, r, k, at, _ in refs if k is not None and r is not None and not held(k, at)}
    r = spark.createDataFrame([(t, i, k, day(at), x) for t, i, k, at, x in refs], "src_table string, rec_id string, key string, at timestamp, range_id int")
    p = spark.createDataFrame([(k, day(s), day(e), x) for k, s, e, x in parents], "key string, start timestamp, end timestamp, share string")
    monkeypatch.setattr(orphans, "SHARE_ROWS", 100)
    for rows, edges in ((65_536, 65_536), (20, 65_536), (20, 3), (2, 5)):
        monkeypatch.setattr(orphans, "RANGE_ROWS", rows)
        monkeypatch.setattr(orphans, "MAX_EDGES", edges)
        got = [tuple(x) for x in orphans.orphan_references(r, p).collect()]
        assert len(got) == len(set(got)) and set(got) == expected
    counts = orphans.orphan_counts(orphans.orphan_references(r, p), r).collect()
    assert sum(c["n_orphans"] for c in counts) == len(expected)
    assert sum(c["n_refs"] for c in counts) == len({(t, i) for t, i, k, *_ in refs if k is not None and i is not None})


def test_one_parent_key_over_many_ranges(spark, monkeypatch):
    rnd = random.Random(6)
    parents = [("hot", a, a + rnd.randrange(1, 5), "") for a in range(0, 400, 7)] + [("hot", 20, 95, ""), ("a", 0, 9, ""), ("z", 5, None, "")]
    refs = [("t", f"{k}{t}", k, t) for k in ("hot", "a", "z", "b") for t in [None, *range(0, 410)]]
    held = lambda k, t: any(p == k and (t is None or s <= t and (e is None or t < e)) for p, s, e, _ in parents)
    r = spark.createDataFrame([(*x[:3], day(x[3])) for x in refs], "src_table string, rec_id string, key string, at timestamp")
    p = spark.createDataFrame([(k, day(s), day(e)) for k, s, e, _ in parents], "key string, start timestamp, end timestamp")
    for rows in (65_536, 4):
        monkeypatch.setattr(orphans, "RANGE_ROWS", rows)
        assert {x[1] for x in orphans.orphan_references(r, p).collect()} == {i for _, i, k, t in refs if not held(k, t)}


def test_orphans_of_empty_tables(spark):
    r = spark.createDataFrame([("t", "1", "k", day(1))], "src_table string, rec_id string, key string, at timestamp")
    p = spark.createDataFrame([], "key string, start timestamp, end timestamp")
    assert [tuple(x) for x in orphans.orphan_references(r, p).collect()] == [("t", "1", "2021-01")]
    assert orphans.orphan_references(r.limit(0), p).count() == 0
    assert orphans.orphan_references(r.limit(0), spark.createDataFrame([("k", day(0), None)], p.schema)).count() == 0


FILES = "file_id bigint, motion_id string, path string, payload string, block_id string, data int"


def files(spark, rows):
    return spark.createDataFrame([(*r, "b", 0) for r in rows], FILES)


ROWS = [
    (1, "m", "p/1", "0,1.0,2\n1,1.5,3"),
    (2, "m", "p/2", "frame,height,contacts\r\n1,1.5,3\r\n\r\n0,1.0,2\r\n"),  # the same records as 1
    (3, "m", "p/3", "1,1.5,3\n"),  # inside 1
    (4, "m", "p/4", "1,1.5,3\n2,9,1"),
    (5, "m", "p/5", None),
    (6, "m", "p/6", ""),
    (7, "m", "p/7", "frame,height,contacts\n\n"),
    (8, None, None, "0,1.0,2"),
    (9, None, "p/9", "0,7,7"),  # the same record of the nameless clip
    (10, "n", "p/é", "0,ä,\n0,5,5\n3"),
    (None, "n", "p/x", "0,1,1"),
]


def test_containers_are_lossless(spark):
    df = files(spark, ROWS + ROWS[:4])
    for block in (8, 1 << 20):
        blocks = archive.pack(df, block)
        back = {r["file_id"]: r for r in archive.unpack(blocks).collect()}
        assert {k: (r["motion_id"], r["path"], r["payload"]) for k, r in back.items()} == {r[0]: r[1:] for r in ROWS}
        assert all(r["intact"] for r in back.values())
        assert archive.index(blocks).count() == len(back)
    assert blocks.count() == 1
    broken = blocks.withColumn("data", blocks["data"].substr(2, 10_000))
    assert not all(r["intact"] for r in archive.unpack(broken).collect())


def test_idle_files_and_records(spark):
    blocks = archive.pack(files(spark, ROWS + ROWS[:4]))
    assert sorted(r[0] for r in archive.idle_files(blocks).collect()) == [2, 3, 5, 6, 7, 9]
    got = sorted((r["motion_id"] or "", r["frame"], r["height"], r["contacts"], r["file_id"]) for r in archive.consolidate(blocks).collect())
    assert got == [("", 0, 1.0, 2, 8), ("m", 0, 1.0, 2, 1), ("m", 1, 1.5, 3, 1), ("m", 2, 9.0, 1, 4), ("n", 0, None, None, 10), ("n", 3, None, None, 10)]
    for size in (8, 1 << 20):  # also with a clip in several members
        packed = archive.consolidated_containers(blocks, size)
        again = archive.consolidate(packed)
        assert sorted((r["motion_id"] or "", r["frame"]) for r in again.collect()) == [x[:2] for x in got]
        assert all(r["intact"] for r in archive.unpack(packed).collect())


def test_consolidated_lines_are_byte_identical(spark):
    rows = [(1, "m", "p/1", "frame,height\n 7,0.123456,1,extra , field\r\n1234567890123,0.2,2\r007,9,9"), (2, "m", "p/2", "12345678901,1e-3,\n1234567890123,5,5"), (None, "m", "p/3", "99999999999999999999,ü\n7,0,0"), (None, "q", "p/4", "5"), (None, "q", "p/4", "5")]
    blocks = archive.pack(files(spark, rows))
    assert [r[0] for r in archive.idle_files(blocks).collect()] == []
    back = {}
    for r in archive.unpack(archive.consolidated_containers(blocks)).collect():
        back.setdefault(r["motion_id"], []).extend(r["payload"].split("\n")[:-1])
    assert back == {"m": [" 7,0.123456,1,extra , field", "12345678901,1e-3,", "1234567890123,0.2,2", "99999999999999999999,ü"], "q": ["5"]}
    frames = {r["frame"] for r in archive.consolidate(blocks).collect()}
    assert frames == {7, 12345678901, 1234567890123, None, 5}


def test_many_sets_with_one_record_in_common(spark):
    rows = [(i, "m", f"p{i}", "\n".join(f"{x},1,1" for x in range(60) if x != i % 60 or x == 0)) for i in range(120)]  # 1..59 lack one record each, twice; 0 and 60 hold all
    assert {r[0] for r in archive.idle_files(archive.pack(files(spark, rows))).collect()} == set(range(1, 120))


def test_idle_files_match_brute_force(spark):
    rnd = random.Random(8)
    rows = [(i, f"c{rnd.randrange(4)}", f"p{i}", "\n".join(f"{x},1,1" for x in rnd.sample(range(9), rnd.randrange(0, 5)))) for i in range(150)]
    sets = {r[0]: (r[1], frozenset(x.split(",")[0] for x in r[3].split("\n") if x)) for r in rows}
    idle = {i for i, (c, s) in sets.items() if not s or any(c == d and i != k and s <= u and (len(u) > len(s) or k < i) for k, (d, u) in sets.items())}
    assert {r[0] for r in archive.idle_files(archive.pack(files(spark, rows))).collect()} == idle


def test_no_files(spark):
    blocks = archive.pack(files(spark, []))
    assert blocks.count() == archive.idle_files(blocks).count() == archive.consolidate(blocks).count() == 0


KEYS = "k string, v double, key string, record string, sums int"


def test_totals_per_key(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, "hot", "hot", "hot", "\u0000", "-", "", f"k{rnd.randrange(3000)}"]), rnd.choice([None, float("nan"), float("inf"), 1.5, 2.0]), "a", f"r{i % 3500}", 1) for i in range(6000)]
    df = spark.createDataFrame(rows, KEYS)
    want = {}
    for k, v, *_ in rows:
        n, c, s = want.get(k, (0, 0, 0.0))
        ok = v is not None and v == v and v != float("inf")
        want[k] = (n + 1, c + ok, s + (v if ok else 0.0))
    for limit, held in ((1 << 20, 500_000), (0, 500_000), (1 << 20, 100), (0, 100)):
        monkeypatch.setattr(hotkeys, "DICTIONARY_BYTES", limit)
        monkeypatch.setattr(hotkeys, "HELD_KEYS", held)
        got = {r["key"]: (r["n_rows"], r["x_n"], r["x_sum"]) for r in hotkeys.per_key_totals(df, "k", {"x": "v"}, keep_null=True).collect()}
        assert got == want
    assert None not in {r["key"] for r in hotkeys.per_key_totals(df, "k").collect()}
    records = {(k, r) for k, _, _, r, _ in rows if k is not None}
    every = {r for _, _, _, r, _ in rows}
    heavy = {k for k in want if k is not None and sum(1 for a, _ in records if a == k) * 20 >= len(every)}
    assert {r["key"] for r in hotkeys.heavy_keys(df, "k", "record").collect()} == heavy


def test_share_is_reached_exactly_and_empty(spark):
    rows = [("a" if i < 5 else f"x{i}", 1.0, "", f"r{i}", 0) for i in range(100)]
    assert [r["key"] for r in hotkeys.heavy_keys(spark.createDataFrame(rows, KEYS), "k", "record").collect()] == ["a"]
    assert hotkeys.heavy_keys(spark.createDataFrame([], KEYS), "k", "record").count() == 0
