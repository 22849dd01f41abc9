"""Records of delimited files read in many splits, against pandas on the same bytes."""

import io
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.errors import SourceError
from basketry.sources import records as R
from basketry.sources.csv import ingest_csv, read_csv


@pytest.fixture
def small_splits(spark):
    """Files are cut every few kilobytes."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4001")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def put(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(str(folder), name)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


def fields_of(spark, path, **options):
    found = R.read_records(spark, path, **options)
    rows = found.rows.select("_seq", R.fields(F.col("record"), options.get("sep", ",")).alias("f")).orderBy("_seq").collect()
    assert [r["_seq"] for r in rows] == list(range(len(rows)))
    return found.names, [tuple(r["f"]) for r in rows]


def by_pandas(data, width, sep=","):
    frame = pd.read_csv(io.BytesIO(data), sep=sep, header=None, skiprows=0, dtype=str, keep_default_na=False, names=range(width))
    return [tuple(r) for r in frame.itertuples(index=False)][1:]


def rows_of(rng, n, sep=","):
    cells = ["x", f"a{sep}b", "l1\nl2", "l1\n\n \nl3", 'say "hi"', '"', "", "  pad ", "\n", f'"{sep}"\n"']
    out = ["id,t,u".replace(",", sep)]
    for k in range(n):
        quoted = '"' + rng.choice(cells).replace('"', '""') + '"' + rng.choice(["", "", " tail", 'x"y'])
        plain = rng.choice(["p", '5" pipe', 'x"y"z', "", " "])
        out.append(sep.join([str(k), quoted, plain]))
        out += rng.choice([[], [], [""], ["   "]])
    return "\n".join(out) + rng.choice(["", "\n"])


@pytest.mark.parametrize("seed,sep,most", [(1, ",", 20_000), (2, ";", 20_000), (3, "|", 0)])
def test_random_files_in_many_splits(spark, tmp_path, small_splits, monkeypatch, seed, sep, most):
    monkeypatch.setattr(R, "MANY_SPLITS", most)  # 0: the starts of splits are a table
    data = rows_of(random.Random(seed), 900, sep).encode()
    path = put(tmp_path, "r.csv", data)
    names, got = fields_of(spark, path, sep=sep)
    assert names == ["id", "t", "u"] and got == by_pandas(data, 3, sep)
    scan = spark.read.option("lineSep", "\n").text(path)
    assert scan.select(F.col("_metadata.file_block_start")).distinct().count() > 3


def test_a_record_longer_than_a_split(spark, tmp_path, small_splits):
    long = "\n".join(f"line {k}, with a comma" for k in range(1500))
    data = f'id,t\n1,"{long}"\n2,"b"\n3,"{long}\n"\n4,d\n'.encode()
    names, got = fields_of(spark, put(tmp_path, "l.csv", data))
    assert got == [("1", long), ("2", "b"), ("3", long + "\n"), ("4", "d")]


def test_windows_line_ends_and_a_byte_order_mark(spark, tmp_path):
    data = '﻿id,t\r\n1,"a\r\nb"\r\n2,c\r\n \r\n3,"d"\r\n'.encode()
    assert fields_of(spark, put(tmp_path, "w.csv", data)) == (["id", "t"], [("1", "a\r\nb"), ("2", "c"), ("3", "d")])


@pytest.mark.parametrize("most", [20_000, 0])
def test_rows_are_numbered_over_files(spark, tmp_path, small_splits, monkeypatch, most):
    monkeypatch.setattr(R, "MANY_SPLITS", most)
    for k in (10, 9, 1):
        put(tmp_path / "d", f"part_{k}.csv", "id,t\n" + "".join(f'{k},"{j}\n."\n' for j in range(500)))
    _, got = fields_of(spark, str(tmp_path / "d"))
    assert got == [(str(k), f"{j}\n.") for k in (1, 9, 10) for j in range(500)]


def test_header_rules(spark, tmp_path):
    for header in ("a,a,b,,a.1", "a,a.1,a", "a,a,a.1,a.1,a", ",,x", '"two\nlines",b', "a.b,c`d,é"):
        names = list(pd.read_csv(io.StringIO(header + "\n")).columns)
        path = put(tmp_path, f"{abs(hash(header))}.csv", f"\n  \n{header}\n{','.join('1' * len(names))}\n")
        got = read_csv(spark, path, with_seq=False, infer_types=True)
        assert got.columns == names and [tuple(r) for r in got.collect()] == [(1,) * len(names)]
    put(tmp_path / "two", "a.csv", "x,y\n1,2\n")
    put(tmp_path / "two", "b.csv", "x,z\n1,2\n")
    with pytest.raises(SourceError, match="header"):
        read_csv(spark, str(tmp_path / "two"))


def test_bytes_are_checked_before_decoding(spark, tmp_path):
    good = put(tmp_path, "g.csv", "a,b\n1,� é\n")
    assert [tuple(r) for r in read_csv(spark, good, with_seq=False).collect()] == [("1", "� é")]
    for name, data, encoding in (("u.csv", b"a,b\n1,\xff\n2,x\n", "utf-8"), ("s.csv", b"a,b\n1,\xed\xa0\x80\n", "utf-8"),
                                 ("c.csv", b"a,b\n1,\x81\n", "cp1252"), ("t.csv", b"a,b\n1,\xe9\n", "ascii")):
        path = put(tmp_path, name, data)
        for read in (lambda: read_csv(spark, path, encoding=encoding), lambda: ingest_csv(spark, path, str(tmp_path / "out"), encoding=encoding)):
            with pytest.raises(SourceError, match="1 rows are not valid") as e:
                read()
            assert e.value.problem == "encoding"
    for encoding in ("latin-1", "cp1252", "shift_jis", "euc-jp"):
        text = "日本,1" if "j" in encoding else "añ«é»,1"
        path = put(tmp_path, f"{encoding}.csv", f"t,n\n{text}\n".encode(encoding))
        assert [tuple(r) for r in read_csv(spark, path, encoding=encoding, with_seq=False).collect()] == [tuple(text.split(","))]
    with pytest.raises(SourceError, match="single bytes"):
        read_csv(spark, good, encoding="utf-16")


def test_a_quote_that_stays_open_is_refused(spark, tmp_path):
    with pytest.raises(SourceError, match="never closed"):
        read_csv(spark, put(tmp_path, "o.csv", 'a,b\n1,"x\n2,y\n'))
    for data in ("", "\n \n"):
        with pytest.raises(SourceError, match="no columns"):
            read_csv(spark, put(tmp_path, "e.csv", data))
    assert read_csv(spark, put(tmp_path, "h.csv", "a,b\n")).count() == 0


def test_inferred_types_follow_the_values(spark, tmp_path):
    columns = {"whole": ["1", "007", ""], "part": ["1", "1.5", "inf"], "flag": ["True", "false", "NA"], "flag_or_one": ["True", "1", ""],
               "text": ["1", "x", ""], "none": ["", "NA", "null"], "beyond": ["99999999999999999999", "1", "2"], "spaced": [" 1", "2 ", "3"],
               "exponent": ["1e3", "2", ""]}
    body = "\n".join(",".join(c[k] for c in columns.values()) for k in range(3))
    path = put(tmp_path, "t.csv", ",".join(columns) + "\n" + body + "\n")
    want = {"whole": "bigint", "part": "double", "flag": "boolean", "flag_or_one": "string", "text": "string", "none": "double",
            "beyond": "string", "spaced": "bigint", "exponent": "double"}
    assert dict(read_csv(spark, path, infer_types=True, with_seq=False).dtypes) == want
    declared = T.StructType([T.StructField("whole", T.StringType())])
    back = ingest_csv(spark, path, str(tmp_path / "out"), declared, infer_types=True, with_seq=False)
    assert dict(back.dtypes) == {**want, "whole": "string"}
    assert [r.whole for r in back.collect()] == ["1", "007", None]
    frame = pd.read_csv(path)
    kinds = {"bigint": "if", "double": "f", "boolean": "bO", "string": "O"}
    assert all(frame[c].dtype.kind in kinds[k] for c, k in want.items())
