import math
import random

import pytest

from fallowlens.operators.quantiles import grouped_quantiles


def interpolated(values, p):
    s = sorted(v for v in values if v is not None)
    if not s:
        return None
    at = p * (len(s) - 1)
    lo, hi = math.floor(at), math.ceil(at)
    return s[lo] + (s[hi] - s[lo]) * (at - lo)


def groups():
    rng = random.Random(11)
    # one group holds most rows and is larger than the sketch accuracy
    yield "hot", [rng.lognormvariate(0, 3) for _ in range(60000)]
    yield "ties", [rng.choice([0.25, 0.5]) for _ in range(25000)]
    yield "outliers", [rng.random() for _ in range(15000)] + [1e12, -1e12]
    for n in range(1, 8):
        yield f"small{n}", [rng.random() for _ in range(n)] + [None]
    yield "empty", [None, None]
    yield None, [3.0, 1.0]


def test_equals_sorted_values_for_every_group_size(spark):
    data = dict(groups())
    rows = [(k, v, None if v is None else -v) for k, vs in data.items() for v in vs]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double, w double").repartition(7)
    probs = {"lo": 0.0, "q25": 0.25, "mid": 0.5, "q75": 0.75, "q999": 0.999, "hi": 1.0}
    got = {
        r["k"]: r
        for r in grouped_quantiles(df, ["k"], {"v": probs, "w": {"wmid": 0.5}}).collect()
    }
    assert set(got) == set(data)
    for k, values in data.items():
        for name, p in probs.items():
            want = interpolated(values, p)
            assert got[k][name] == (None if want is None else pytest.approx(want)), (k, name)
        want = interpolated(values, 0.5)
        assert got[k]["wmid"] == (None if want is None else pytest.approx(-want))


def test_limits_of_gathering_give_the_same_rows(spark):
    rng = random.Random(3)
    data = {**dict(groups()), **{f"n{n}": [rng.random() for _ in range(n)] for n in (9_999, 10_000, 10_001)}}
    rows = [(k, v, None if v is None else -v) for k, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double, w double").repartition(7)
    probs = {"lo": 0.0, "mid": 0.5, "q75": 0.75, "hi": 1.0}
    want = {k: [interpolated(vs, p) for p in probs.values()] for k, vs in data.items()}
    # no group, those of up to 10,000 rows, all groups
    for gathered in (0, 20_000, 10**6):
        got = grouped_quantiles(df, ["k"], {"v": probs, "w": {"wmid": 0.5}}, gathered).collect()
        assert len(got) == len(data)
        for r in got:
            assert [r[n] for n in probs] == [w if w is None else pytest.approx(w) for w in want[r["k"]]], (gathered, r["k"])
            assert r["wmid"] == (None if r["mid"] is None else pytest.approx(-r["mid"]))


def test_small_groups_are_neither_sketched_nor_counted_by_value(spark, tmp_path):
    spark.range(3000).selectExpr("id % 50 as k", "id * 0.5 as v").write.parquet(str(tmp_path / "v"))
    found = grouped_quantiles(spark.read.parquet(str(tmp_path / "v")), ["k"], {"v": {"mid": 0.5}})
    assert {r["k"]: r["mid"] for r in found.collect()} == {k: 0.5 * (k + 50 * 29.5) for k in range(50)}
    ran = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "collect_list" in ran and "percentile_approx" not in ran and "Generate" not in ran


def test_rows_of_a_large_group_meet_in_no_task(spark, tmp_path):
    spark.range(0, 40_000, 1, 4).selectExpr("id % 2 as k", "id * 0.5 as v").write.parquet(str(tmp_path / "v"))
    found = grouped_quantiles(spark.read.parquet(str(tmp_path / "v")), ["k"], {"v": {"mid": 0.5}}, gathered=1000)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        assert {r["k"]: r["mid"] for r in found.collect()} == {0: 9999.5, 1: 10000.0}
    finally:
        spark.conf.set(limit, before)
    ran = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # rows that are still to be counted by value were not shuffled before
    counted = ran[ran.index("Generate inline") :].split("Generate")[1]
    assert "BroadcastHashJoin" in counted.split("Exchange")[0]
