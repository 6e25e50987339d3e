import random

from stridelake.operators import quality


def test_places_over_many_partitions(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["hot", "hot", "hot", "a", "b", None]), i) for i in range(4000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int")
    want, seen = {}, {}
    for g, i in sorted(rows, key=lambda r: r[1]):
        want[g, i] = seen.get(g, 0)
        seen[g] = want[g, i] + 1
    got = quality.numbered(df, "g", ["i"]).collect()
    assert len(got) == 4000 and all(r["place"] == want[r["g"], r["i"]] and r["places"] == seen[r["g"]] for r in got)
    assert quality.numbered(df.limit(0), "g", ["i"]).count() == 0
