import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.operators import spikes

SCHEMA = "object_type string, motion_id string, frame int, joint int, f array<float>, bucket string, kind int, part string"


def brute(rows):
    """The rules, row by row, in plain Python."""
    seen, readings = set(), {}
    for o, m, t, j, f, *_ in rows:
        if None in (o, m, t, j, f):
            continue
        key = (o, m, t, j, tuple(f))
        if repr(key) in seen:
            continue
        seen.add(repr(key))
        for c, x in enumerate(f[:13]):
            if x is not None:
                readings[(o, m, j, c, t)] = float(np.float32(x))
    found = set()
    judged = {k: x for k, x in readings.items() if k[3] in ((1, 9, 11) if k[2] == 0 else (0, 1, 2, 9, 10, 11)) and math.isfinite(x)}
    groups, steps = {}, {}
    for (o, m, j, c, t), x in judged.items():
        groups.setdefault((o, j, c), []).append(x)
        after = judged.get((o, m, j, c, t + 1))
        if after is not None and after != x:
            steps.setdefault((o, j, c), []).append(abs(after - x))
    for (o, m, j, c, t), x in readings.items():
        bad = not math.isfinite(x) or 3 <= c <= 8 and abs(x) > 1.01 or c == 12 and x not in (0, 1)
        if (o, m, j, c, t) in judged:
            g = groups[(o, j, c)]
            med = np.median(g)
            bad |= abs(x - med) > 10 * np.median(np.abs(np.array(g) - med))
            before, after = (judged.get((o, m, j, c, t + d)) for d in (-1, 1))
            if before is not None and after is not None and (o, j, c) in steps:
                step = np.median(steps[(o, j, c)])
                bad |= (x > max(before, after) or x < min(before, after)) and min(abs(x - before), abs(x - after)) > 5 * step
            lo = hi = t
            while judged.get((o, m, j, c, lo - 1)) == x:
                lo -= 1
            while judged.get((o, m, j, c, hi + 1)) == x:
                hi += 1
            bad |= hi - lo >= 9
        if bad:
            found.add((m, t, j, c))
    return found


def clip(rng, o, m, frames=30, joints=2):
    for t, j in itertools.product(range(frames), range(joints)):
        f = [float(x) for x in rng.normal(size=3)] + [float(x) for x in rng.uniform(-1, 1, 6)] + [float(x) for x in rng.normal(size=3)] + [0.0]
        if j == 0:
            f[0] = f[2] = f[10] = 0.0
        yield [o, m, t, j, f, "x", 1, "y"]


def test_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [r for o, n in (("wolf", 9), ("Wolf", 3), ("crab", 2)) for k in range(n) for r in clip(rng, o, f"{o}{k}")]
    rows[7][4][4] = 1.5
    rows[9][4][2] = float("nan")
    rows[13][4][1] = float("inf")
    rows[100][4][9] = 400.0
    rows[151][4][12] = 0.5
    rows[31][4][5] = None
    rows[41][4] = rows[41][4][:7]
    for r in rows[301:331:2]:
        r[4][1] = 0.25
    for r in rows[501:561:2]:
        r[3] = 3
    rows = [r for i, r in enumerate(rows) if i % 37] + rows[200:240]
    rows += [[None, "wolf0", 1, 1, [0.0] * 13, "x", 1, "y"], ["wolf", None, 1, 1, [0.0] * 13, "x", 1, "y"], ["wolf", "w", 1, 1, None, None, None, None], ["wolf", "w", None, 1, [0.0] * 13, "x", 1, "y"]]
    rng.shuffle(rows)
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in spikes.implausible_readings(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)


def test_still_source_and_repeats(spark):
    rows = [("still", "s", t, 1, [1.0] * 3 + [0.5] * 6 + [0.0] * 4) for t in range(9)]
    df = spark.createDataFrame(rows * 3, "object_type string, motion_id string, frame int, joint int, f array<float>")
    assert spikes.implausible_readings(df).count() == 0
    longer = spark.createDataFrame([*rows, (*rows[0][:2], 9, *rows[0][3:])], df.schema)
    assert spikes.implausible_readings(longer).groupBy("channel").count().where("count = 10").count() == 6


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert spikes.implausible_readings(df).collect() == []
    assert spikes.source_report(df).collect() == []


@pytest.mark.parametrize("bucket, exact, points, fan_in", [(200_000, 8_192, 4_096, 64), (100, 64, 64, 64), (40, 16, 16, 2), (60, 8, 8, 3)])
def test_medians_stay_exact_in_buckets_and_summaries(spark, monkeypatch, bucket, exact, points, fan_in):
    rng = np.random.default_rng(6)
    rows = [tuple(r) for k in range(40) for r in clip(rng, "hot", f"h{k}", frames=12)]
    rows += [tuple(r) for k in range(3) for r in clip(rng, "cold", f"c{k}", frames=12)]
    rows += [("coarse", f"g{k}", t, 1, [round(float(x) * 2) / 2 for x in rng.normal(size=12)] + [0.0], "x", 1, "y") for k in range(20) for t in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name, value in (("BUCKET_ROWS", bucket), ("EXACT_VALUES", exact), ("SUMMARY_POINTS", points), ("FAN_IN", fan_in)):
        monkeypatch.setattr(spikes, name, value)
    made = {r["object_type"]: spikes._unpacked(r["model"]) for r in spikes._prepared(df).select("object_type", "model").distinct().collect()}
    for o, model in made.items():
        for joint, scale in zip(model["joints"], model["scales"]):
            for c in spikes._level_channels(joint):
                series = {}
                for r in rows:
                    if r[0] == o and r[3] == joint:
                        series.setdefault(r[1], {})[r[2]] = float(np.float32(r[4][c]))
                x = np.array([v for s in series.values() for v in s.values()])
                steps = np.array([abs(s[t + 1] - s[t]) for s in series.values() for t in s if t + 1 in s])
                want = (np.median(x), np.median(np.abs(x - np.median(x))), np.median(steps[steps > 0]) if (steps > 0).any() else np.nan)
                np.testing.assert_array_equal(scale[:, c], want)
    assert {tuple(r) for r in spikes.implausible_readings(df).collect()} == brute(rows)
    built = spikes._prepared(df)
    assert built.select(F.explode("motion_ids")).distinct().count() == 63
    if bucket < 200_000:
        assert built.where("object_type = 'hot'").select("bucket").distinct().count() > 5


def test_scores_rank_planted_readings_first(spark):
    rng = np.random.default_rng(7)
    rows = [r for k in range(30) for r in clip(rng, "wolf", f"w{k}", frames=40)]
    for r in rows[500:2400:100]:
        r[4][1] = 60.0 + float(rng.normal())
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA)
    report = spikes.score_report(df).collect()[0]
    assert report["cases"] >= 19 and report["cases_on_top"] >= 0.8 * report["cases"]
    scores = spikes.scored_readings(df)
    assert scores.count() == len(rows) * 13
    top = {(r["motion_id"], r["frame"]) for r in scores.where("channel = 1").orderBy(F.desc("score")).limit(19).collect()}
    assert len(top & {(r[1], r[2]) for r in rows[500:2400:100]}) >= 16


def test_forest_reaches_every_cell():
    rng = np.random.default_rng(2)
    boxes = []
    spikes._grow(rng.integers(0, spikes.CUTS + 1, (64, 4)), rng, boxes)
    cells = np.zeros((spikes.CUTS + 1,) * 4, int)
    for b in boxes:
        cells[tuple(slice(lo, hi) for lo, hi in zip(b[:4], b[4:8]))] += 1
    assert (cells == 1).all()
