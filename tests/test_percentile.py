import numpy as np
import pytest

from stridelake.operators import quality
from stridelake.scratch import stored


@pytest.mark.parametrize("accuracy", [10_000, 100])
def test_exact_percentile(spark, accuracy):
    rng = np.random.default_rng(3)
    groups = {"one": [2.5], "few": rng.normal(size=422), "ties": np.round(rng.normal(size=3000)), "many": rng.normal(size=20_011), "none": [None, None]}
    rows = [(g, None if x is None else float(x)) for g, v in groups.items() for x in v] + [("few", None)]
    df = stored(spark.createDataFrame(rows, "g string, e double").repartition(3), "values")
    got = {r["g"]: r["value"] for r in quality.exact_percentile(df, "g", "e", 0.95, accuracy).collect()}
    assert set(got) == {"one", "few", "ties", "many"}
    for g, v in got.items():
        assert abs(v - np.quantile(np.array(groups[g], float), 0.95)) < 1e-12, g
