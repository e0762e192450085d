import pytest

from fallowlens.operators import survey as s
from fallowlens.plans.seeds import prepare_seeds
from fallowlens.plans.training import training_errors, training_table

COORDS = "seq long, POINT_ID string, GPS_LAT double, GPS_LONG double"


@pytest.fixture(scope="module")
def coords(spark):
    rows = [
        (1, "123.0", None, 9.0),
        (2, "123.0", 45.0, 9.0),
        (3, "123", 46.0, 10.0),
        (4, "NE", 1.0, 1.0),
        (5, "ne", 1.0, 1.0),
        (6, "nan", 1.0, 1.0),
        (7, None, 1.0, 1.0),
        (8, "10", 47.0, 11.0),
        (9, "7.0.0", 48.0, 12.0),
        (10, "20", 49.0, None),
    ]
    return spark.createDataFrame(rows, COORDS).repartition(4)


def test_ids_are_cleaned(coords):
    assert sorted(r["POINT_ID"] for r in s.clean_ids(coords).collect()) == [
        "10", "123", "123", "123", "20", "7.0",
    ]


def test_lookup_keeps_the_first_complete_row(coords):
    got = {r["POINT_ID"]: (r["GPS_LAT"], r["GPS_LONG"]) for r in s.coord_lookup(s.clean_ids(coords)).collect()}
    assert got == {"123": (45.0, 9.0), "10": (47.0, 11.0), "7.0": (48.0, 12.0)}


def test_join_keeps_unmatched_rows(spark, coords):
    values = spark.createDataFrame([("123", 1.0), ("10", 2.0), ("99", 3.0), ("98", 4.0)], "Point_ID string, OC double")
    joined = prepare_seeds(values, coords)
    assert set(joined.columns) == {"POINT_ID", "OC", "lat", "lon", "seed_id"}
    assert s.missing_coordinates(joined).first().asDict() == {"n_rows": 4, "n_missing": 2}
    assert [r[0] for r in s.unmatched_head(joined, 1).collect()] == ["98"]
    assert s.id_counts(coords).first().asDict() == {"n_rows": 10, "n_valid": 6, "n_lookup": 3}


def test_latitude_range_skips_texts(spark):
    df = spark.createDataFrame([("45.5",), ("n/a",), ("46",)], "GPS_LAT string")
    assert tuple(s.latitude_range(df).first()) == (45.5, 46.0)


def test_describe(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None), (2.0, 7.0), (5.0, 7.0)], "a double, b double")
    got = {r["column"]: r for r in s.describe(df, ["a", "b"]).collect()}
    a = got["a"]
    assert (a["count"], a["unique"], a["top"], a["freq"]) == (4, 3, 2.0, 2)
    assert (a["min"], a["q25"], a["q50"], a["q75"], a["max"]) == (1.0, 1.75, 2.0, 2.75, 5.0)
    assert a["mean"] == 2.5 and a["std"] == pytest.approx(1.7320508)
    assert got["b"]["count"] == 3 and got["b"]["top"] == 7.0


def test_training_table_is_one_to_one(spark):
    features = spark.createDataFrame([("a", 1.0, 1.0, 0.1), ("b", 1.0, 1.0, 0.2), ("c", 1.0, 1.0, 0.3)],
                                     "seed_id string, lat double, lon double, v double")
    lab = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 3.0), ("d", 4.0)], "seed_id string, OC double")
    assert [tuple(r) for r in training_table(features, lab).select("seed_id", "v", "OC").collect()] == [("a", 0.1, 1.0)]
    assert [tuple(r) for r in training_errors(features, lab).collect()] == [("b", "survey", 2)]


def test_texts_are_described(spark):
    from fallowlens.operators.survey import describe_texts

    df = spark.createDataFrame([("b", None, 2), ("a", None, 2), ("b", None, 1), ("a", None, None), (None, None, 3)], "x string, y string, z int")
    got = {r["column"]: tuple(r)[1:] for r in describe_texts(df, ["x", "y", "z"]).collect()}
    assert got == {"x": (4, 2, "a", 2), "y": (0, 0, None, None), "z": (4, 3, "2", 2)}
    assert describe_texts(df.limit(0), ["x"]).isEmpty()
