import pytest
from pyspark.sql import functions as F

from fallowlens.functions.indices import add_indices, clean_bands
from fallowlens.operators.bare_soil import bare_soil_only, flag_bare_soil
from fallowlens.schemas import BANDS, INDICES

GOLDEN = [
    # B02 B03 B04 B08 B11 B12 -> NDVI NDMI NDWI NBR MSAVI EVI
    ((0.05, 0.07, 0.10, 0.14, 0.25, 0.20), (0.166667, -0.282051, -0.333333, -0.176471, 0.065892, 0.073260)),
    ((0.05, 0.07, 0.10, 0.40, 0.25, 0.20), (0.6, 0.230769, -0.702128, 0.333333, 0.441742, 0.461538)),
    ((0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (None, None, None, None, 0.0, 0.0)),
    ((0.05, 0.07, -0.10, 0.50, 0.25, 0.20), (1.5, 0.333333, -0.754386, 0.428571, 1.0, 2.857143)),
    ((0.05, 0.07, None, 0.14, 0.25, 0.20), (None, -0.282051, -0.333333, -0.176471, None, None)),
]


def bands(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{b} double" for b in BANDS))


@pytest.mark.parametrize("values,expected", GOLDEN)
def test_golden_values(spark, values, expected):
    row = add_indices(bands(spark, [values])).first()
    for name, want in zip(INDICES, expected):
        if want is None:
            assert row[name] is None, name
        else:
            assert row[name] == pytest.approx(want, abs=5e-7), name


def test_nan_bands_become_null(spark):
    nan = float("nan")
    row = add_indices(clean_bands(bands(spark, [(nan, 0.07, nan, 0.14, 0.25, 0.2)]))).first()
    assert row["B04"] is None and row["NDVI"] is None and row["MSAVI"] is None and row["EVI"] is None
    assert row["NDMI"] is not None


def test_float_bands_are_widened_before_arithmetic(spark):
    df = bands(spark, [(0.05, 0.07, 0.10, 0.14, 0.25, 0.20)])
    floats = df.select(*[F.col(b).cast("float").alias(b) for b in BANDS])
    types = dict(add_indices(floats).dtypes)
    assert all(types[i] == "double" for i in INDICES)


def test_missing_band_is_rejected(spark):
    with pytest.raises(ValueError, match="B12"):
        add_indices(bands(spark, [(0.1,) * 6]).drop("B12"))


def test_flag_is_strict_and_false_when_missing(spark):
    rows = [
        (0.05, 0.07, 0.375, 0.625, 0.25, 0.20),  # NDVI exactly 0.25
        (0.05, 0.07, 0.375, 0.624, 0.25, 0.20),
        (0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
        (0.05, 0.07, 0.40, 0.10, 0.25, 0.20),  # negative NDVI counts as bare
    ]
    df = flag_bare_soil(add_indices(bands(spark, rows)), 0.25)
    assert [r["is_baresoil"] for r in df.collect()] == [False, True, False, True]
    assert bare_soil_only(df).count() == 2
