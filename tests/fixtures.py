"""Hand-computed fixture: two dates on a 2 x 2 grid (FIXTURES.md §3)."""

from rastercube.schema import OBSERVATION

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

# (date, row, col, red, nir) before the validity mask
RAW = [
    ("2024-01-05", 0, 0, 1000.0, 3000.0),
    ("2024-01-05", 0, 10, 2000.0, 2000.0),
    ("2024-01-05", 10, 0, 3000.0, 1000.0),
    ("2024-01-05", 10, 10, 0.0, 500.0),
    ("2024-03-05", 0, 0, 1000.0, 1000.0),
    ("2024-03-05", 0, 10, 0.0, 0.0),
    ("2024-03-05", 10, 0, 1000.0, 4000.0),
    ("2024-03-05", 10, 10, 500.0, 0.0),
]

RAW_SCHEMA = "date string, row int, col int, red float, nir float"


def raw_df(spark):
    return spark.createDataFrame(RAW, RAW_SCHEMA)


def obs_df(spark):
    from rastercube.operators.bands import mask_valid, with_ndvi

    return with_ndvi(mask_valid(raw_df(spark))).select(*[f.name for f in OBSERVATION.fields])
