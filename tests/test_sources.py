"""CSV source rules, sinks, profiles and round trips."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from basketry.errors import SourceError
from basketry.operators.profile import profile
from basketry.sources.csv import ingest_csv, read_csv
from basketry.sources.sinks import write_csv, write_parquet, written_size


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_read_three_columns(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "t.csv"), "id,name,price\n1,a,1.5\n2,b,2.5\n3,c,3.5\n")
    df = read_csv(spark, p, T.StructType([T.StructField("id", T.LongType()),
                                          T.StructField("price", T.DoubleType())]))
    assert df.count() == 3
    assert dict(df.dtypes)["id"] == "bigint" and dict(df.dtypes)["name"] == "string"
    assert [r["price"] for r in df.orderBy("id").collect()] == [1.5, 2.5, 3.5]


def test_missing_cells_profile(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "t.csv"), "a,b,c\n1,,x\n,2,\n3,4,z\n")
    prof = profile(read_csv(spark, p, with_seq=False)).collect()[0]
    assert prof["rows"] == 3 and prof["columns"] == 3 and prof["missing_values"] == 3
    assert prof["missing_percentage"] == round(3 / 9 * 100, 2)


def test_null_tokens_and_separator(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "t.csv"), "a;b\nNA;x\nnull;n/a\n7;\"q;q\"\n")
    out = [r.asDict() for r in read_csv(spark, p, sep=";", with_seq=False).collect()]
    assert out == [{"a": None, "b": "x"}, {"a": None, "b": None}, {"a": "7", "b": "q;q"}]


def test_quotes_and_newlines(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "t.csv"), 'a,b\n1,"he said ""hi"""\n2,"two\nlines"\n')
    out = [r["b"] for r in read_csv(spark, p, with_seq=False).collect()]
    assert out == ['he said "hi"', "two\nlines"]


def test_short_row_padded_long_row_raises(spark, tmp_dir):
    short = _write(os.path.join(tmp_dir, "short.csv"), "a,b,c\n1,2,3\n4,5\n")
    out = [r.asDict() for r in read_csv(spark, short, with_seq=False).collect()]
    assert out[1] == {"a": "4", "b": "5", "c": None}
    long = _write(os.path.join(tmp_dir, "long.csv"), "a,b\n1,2\n3,4,5\n")
    with pytest.raises(SourceError):
        read_csv(spark, long)
    rows, bad = read_csv(spark, long, malformed="quarantine")
    assert rows.count() == 1 and bad.count() == 1


def test_empty_file_raises(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "empty.csv"), "")
    with pytest.raises(SourceError):
        read_csv(spark, p)


def test_encoding_alias_and_wrong_encoding(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "l1.csv"), "name\nañejo\n", encoding="latin-1")
    assert read_csv(spark, p, encoding="latin-1", with_seq=False).collect()[0]["name"] == "añejo"
    with pytest.raises(SourceError):
        read_csv(spark, p, encoding="utf-8")


def test_scan_order_keep_last(spark, tmp_dir):
    from basketry.plans.clean import clean_reviews
    p = _write(os.path.join(tmp_dir, "r.csv"),
               "review_id,product_id,customer_id,rating,helpful_votes,created_at\n"
               "1,10,100,5,1,2024-01-01\n1,10,100,2,3,2024-01-02\n2,11,101,4,,2024-01-03\n")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in
                           ["review_id", "product_id", "customer_id", "rating", "helpful_votes"]])
    out = sorted(clean_reviews(read_csv(spark, p, schema)).collect(), key=lambda r: r["review_id"])
    assert [(r["review_id"], r["rating"], r["helpful_votes"]) for r in out] == [(1, 2, 3), (2, 4, 0)]


def test_csv_and_parquet_round_trip(spark, tmp_dir):
    import datetime as dt
    df = spark.createDataFrame(
        [(1, 1.5, "x", True, dt.datetime(2024, 1, 2, 3, 4, 5, 600)), (2, None, None, False, None)],
        "id long, amount double, s string, flag boolean, ts timestamp_ntz")
    prof = write_csv(df, os.path.join(tmp_dir, "rt.csv"))
    assert prof["rows"] == 2 and prof["missing_values"] == 3
    back = read_csv(spark, os.path.join(tmp_dir, "rt.csv"), df.schema, with_seq=False)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    write_parquet(df, os.path.join(tmp_dir, "rt.parquet"))
    assert sorted(map(tuple, spark.read.parquet(os.path.join(tmp_dir, "rt.parquet")).collect())) == \
        sorted(map(tuple, df.collect()))
    size = written_size(spark, os.path.join(tmp_dir, "rt.parquet")).collect()[0]
    assert size["files"] >= 1 and size["file_size_mb"] >= 0


def test_csv_text_like_pandas(spark, tmp_dir):
    df = spark.createDataFrame([(48705233.797266, 120.0)], "a double, b double")
    write_csv(df, os.path.join(tmp_dir, "f.csv"), single_file=True)
    part = [f for f in os.listdir(os.path.join(tmp_dir, "f.csv")) if f.startswith("part-")][0]
    text = open(os.path.join(tmp_dir, "f.csv", part)).read()
    assert text == "a,b\n48705233.797266,120.0\n"


def test_ingest_once_validates_on_write(spark, tmp_dir):
    good = _write(os.path.join(tmp_dir, "g.csv"), "a,b\n1,2\n3,4\n")
    out = ingest_csv(spark, good, os.path.join(tmp_dir, "g.parquet"),
                     T.StructType([T.StructField("a", T.LongType())]))
    assert out.count() == 2 and dict(out.dtypes)["a"] == "bigint"
    long = _write(os.path.join(tmp_dir, "l.csv"), "a,b\n1,2\n3,4,5\n")
    with pytest.raises(SourceError):
        ingest_csv(spark, long, os.path.join(tmp_dir, "l.parquet"))
