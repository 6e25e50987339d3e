import random

import numpy as np
import pandas as pd

from stridelake.llm import splits

NAMES, SHARES = list(splits.TARGETS), np.array(list(splits.TARGETS.values()))


def by_hand(counts, sizes):
    """Large components, then the others, each by all labels, in one piece."""
    total = sum(sizes.values())
    of = {c: {label: k for (d, label), k in counts.items() if d == c} for c in sizes}
    totals = {}
    for (_, label), k in counts.items():
        totals[label] = totals.get(label, 0) + k
    frame = lambda cs: pd.DataFrame({"component": cs, "n": [sizes[c] for c in cs], "vector": [of[c] for c in cs]})
    heavy = [c for c in sizes if sizes[c] * splits.HEAVY > total]
    light = [c for c in sizes if sizes[c] * splits.HEAVY <= total]
    got = dict(zip(heavy, splits._place(frame(heavy), {k: SHARES * v for k, v in totals.items()}, SHARES * total, NAMES)))
    need = {}
    for label, v in totals.items():
        left = np.maximum(SHARES * v - [sum(of[c].get(label, 0) for c in heavy if got[c] == s) for s in NAMES], 0)
        left = left if left.sum() > 0 else SHARES
        need[label] = left / left.sum() * sum(of[c].get(label, 0) for c in light)
    left = np.maximum(SHARES * total - [sum(sizes[c] for c in heavy if got[c] == s) for s in NAMES], 0)
    return got | dict(zip(light, splits._place(frame(light), need, left / left.sum() * sum(sizes[c] for c in light), NAMES)))


def test_labels_of_few_records_steer_large_components_and_what_follows(spark):
    rnd = random.Random(6)
    sizes = {f"h{i:02d}": 60 + i % 7 for i in range(80)} | {f"l{i:03d}": 1 + i % 3 for i in range(200)}
    counts = {(c, rnd.choice(["u", "v"])): n for c, n in sizes.items()}
    for k in range(30):  # each fewer than a thousandth of the records; partly in large components, partly in small ones
        for c in [*rnd.sample(sorted(c for c in sizes if c[0] == "h"), 3), *rnd.sample(sorted(c for c in sizes if c[0] == "l"), 1)]:
            counts[c, f"rare{k:02d}"] = 1
    for twin in ("rare00", "rare01"):  # spread alike over the large ones
        counts |= {(c, f"{twin}x"): n for (c, label), n in list(counts.items()) if label == twin and c[0] == "h"}
    assert max(sum(n for (_, x), n in counts.items() if x == label) for _, label in counts if label[0] == "r") * 1000 < sum(sizes.values())
    c = spark.createDataFrame([(*k, n) for k, n in counts.items()], "component string, label string, k bigint")
    s = spark.createDataFrame(list(sizes.items()), "component string, n bigint")
    assert {r[0]: r[1] for r in splits.assign_splits(c, s).collect()} == by_hand(counts, sizes)
