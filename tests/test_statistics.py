import random
import statistics

import pytest
from pyspark.sql import functions as F

from fallowlens.functions import stats


@pytest.mark.parametrize("ddof", [0, 1])
def test_gathered_statistics_of_groups_of_all_sizes(spark, monkeypatch, ddof):
    monkeypatch.setattr(stats, "VALUES_AT_ONCE", 50)
    draw = random.Random(5)
    value = lambda: None if draw.random() < 0.2 else draw.randint(-5, 5) / 8
    groups = [[[value(), value()] for _ in range(n)] for n in (0, 1, 2, 3, 4, 5, 9, 300, 2, 1, 0)]
    groups += [[[None, 1.0]], [[None, None], [0.25, None]], [[float("inf"), -0.0], [1.0, 0.0]]]
    df = spark.createDataFrame(list(enumerate(groups)), "k int, rows array<array<double>>").coalesce(1)
    names = [("m0", "a0", "s0"), ("m1", "a1", "s1")]
    got = stats.gathered_stats(df, "rows", names, ddof)
    # no expression is interpreted value by value
    assert "lambda" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == ["k", "m0", "a0", "s0", "m1", "a1", "s1"]
    for r in got.collect():
        for i in range(2):
            v = [x[i] for x in groups[r["k"]] if x[i] is not None]
            median, mean, std = r[f"m{i}"], r[f"a{i}"], r[f"s{i}"]
            assert median == (statistics.median(v) if v else None)
            assert mean == (pytest.approx(sum(v) / len(v), rel=1e-13) if v else None)
            if len(v) <= ddof:
                assert std is None
            elif float("inf") not in v:
                assert std == pytest.approx((sum((x - mean) ** 2 for x in v) / (len(v) - ddof)) ** 0.5, rel=1e-12)


def test_statistics_read_each_group_once(spark):
    rows = F.array(F.array(F.col("id") * 0.5, F.lit(1.0)))
    df = spark.range(5).select("id", rows.alias("rows"))
    plan = stats.gathered_stats(df, "rows", [("m", "a", "s"), ("n", "b", "t")], 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("pythonUDF0#") >= 1 and "pythonUDF1#" not in plan
