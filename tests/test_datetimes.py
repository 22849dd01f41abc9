"""Layouts by the first value, against pandas' own inference on the same values."""

import datetime as dt
import warnings

import pandas as pd
import pytest

from basketry.operators.datetimes import coerce_datetimes, infer_layouts, layout_of

COLUMNS = [
    ("2024/01/15", "2024-01-15", "2024/1/5"), ("15/01/2024", "01/02/2024", "13/13/2024", "2024-01-01"), ("01/02/2024", "13/01/2024", "1/2/2024"),
    ("1/2/2024", "01/02/2024", "10/12/2024"), ("2024-01-15 10:00", "2024-01-15", "2024-01-15 10:00:30", "2024-01-15 11:59"),
    ("2024-01-15", "2024-01-15 10:00:00", "2024-1-5"), ("2024-01-15 10:00:00", "2024-01-15 10:00:00.5", "2024-01-15"),
    ("2024-01-15 10:00:00.123", "2024-01-15 10:00:00", "2024-01-15 10:00:00.123456", "2024-01-15 10:00:00.1"),
    ("Jan 5, 2024", "5 Jan 2024", "Feb 29, 2024"), ("15-01-2024", "15.01.2024", "16-02-2024"), ("20240115", "20240116", "2024-01-15"), (None, "", "2024/01/15", "2024/02/30"),
    ("2024-01", "2024-02-03", "2024-12"), ("01/15/2024 10:30", "01/16/2024 10:30:00"), ("01/15/2024 10:30 PM", "01/16/2024 09:30 AM"),
    ("2024-01-15T10:00:00", "2024-01-15 10:00:00", "2024-01-16T00:00:00"), ("15 January 2024", "16 February 2024", "16 Feb 2024"),
    ("15/1/24", "16/1/24", "16/1/99", "16/1/68"), ("2024-01-15T10:00:00.000Z", "2024-01-15T10:00:00Z"), ("2024-01-15T10:00:00Z", "2024-01-15T12:30:00Z", "2024-01-15"),
]


@pytest.mark.parametrize("values", COLUMNS, ids=lambda v: str(v[0] or v[2]))
def test_columns_like_pandas(spark, values):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = pd.to_datetime(pd.Series([v or None for v in values], dtype=object), errors="coerce")
    want = [None if pd.isna(x) else pd.Timestamp(x).tz_localize(None).to_pydatetime() for x in want]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "_seq int, d string").repartition(2)
    assert [r.d for r in coerce_datetimes(df, ["d"]).orderBy("_seq").collect()] == want


def test_zones_are_read_as_utc(spark):
    df = spark.createDataFrame([(1, "2024-01-15 10:00:00+02:00"), (2, "2024-01-15 10:00:00-05:30"), (3, "2024-01-15 10:00:00")], "_seq int, d string")
    got = [r.d for r in coerce_datetimes(df, ["d"]).orderBy("_seq").collect()]
    assert got == [dt.datetime(2024, 1, 15, 8), dt.datetime(2024, 1, 15, 15, 30), None]


def test_a_first_value_that_is_no_date_decides_nothing(spark):
    df = spark.createDataFrame([(1, "junk", "x"), (2, "2024-01-15", None), (3, "2024-01-15 10:00:00", "y")], "_seq int, d string, e string")
    assert infer_layouts(df, ["d", "e", "missing"]) == {"d": None, "e": None}
    assert [r.d for r in coerce_datetimes(df, ["d"]).orderBy("_seq").collect()] == [None, dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15, 10)]
    assert coerce_datetimes(df.limit(0), ["d"]).count() == 0


def test_iso_values_beside_the_layout(spark):
    df = spark.createDataFrame([(1, "15/01/2024"), (2, "2024-01-16"), (3, "17.01.2024")], "_seq int, d string")
    got = [r.d for r in coerce_datetimes(df, ["d"], iso_too=True).orderBy("_seq").collect()]
    assert got == [dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16), None]


def test_a_slash_dated_file_keeps_its_months(spark, tmp_path):
    from basketry.plans.clean import clean_reviews
    from basketry.schemas import COERCED, SCHEMAS
    from basketry.sources.csv import read_csv

    (tmp_path / "r.csv").write_text("review_id,product_id,customer_id,rating,comment,helpful_votes,created_at\n1,1,1,4,x,1,15/01/2024\n2,1,1,5,y,0,16/02/2024\n")
    rows = clean_reviews(read_csv(spark, str(tmp_path / "r.csv"), SCHEMAS["reviews"], coerced=COERCED["reviews"])).orderBy("review_id").collect()
    assert [r.created_at for r in rows] == [dt.datetime(2024, 1, 15), dt.datetime(2024, 2, 16)]


@pytest.mark.parametrize("text", [None, "", "x", "2024-13-01", "13/13/2024", "2024-01-15 junk", "99", "10:00", "1705312800", "2024/01-15", "5 Foo 2024", "2024-01 10:00"])
def test_no_layout(text):
    assert layout_of(text) is None
