"""Delimited files with line breaks in cells, cut into splits at any byte."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.sources import readers, records

PIECES = ["a", "line\nbreak", 'said "x"', "comma, here", "", " ", "\n\n", "back\\slash", '"', "é€", "\r\nend", "x" * 30, ",\n,", 'tail"\n']


def text_of(rows):
    """As the writer writes them: quotes where needed, escape `\\`."""
    out = []
    for row in rows:
        out.append(",".join('"' + c.replace("\\", "\\\\").replace('"', '\\"') + '"' if any(x in c for x in ',"\n\r\\') or c == "" else c for c in row))
    return "\n".join(out) + "\n"


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


@pytest.mark.parametrize("size", [64, 257, 5000])
def test_any_split_gives_the_same_records(spark, tmp_path, small_splits, size):
    draws = random.Random(size)
    rows = [(str(i), *(draws.choice(PIECES) for _ in range(3))) for i in range(300)]
    (tmp_path / "a.csv").write_bytes(text_of([("id", "x\ny", "b", "c"), *rows]).encode())
    (tmp_path / "b.csv").write_bytes(text_of([("id", "x\ny", "b", "c"), ("z", "1", "2", "3")]).encode())
    small_splits(size)
    df = readers.read_delimited(spark, str(tmp_path), multiline=True)
    assert df.columns == ["id", "x\ny", "b", "c"]
    got = {r[0]: tuple(r) for r in df.collect()}
    # as in Spark's reader, an empty cell is null, in quotes or not
    assert got == {r[0]: tuple(c or None for c in r) for r in [*rows, ("z", "1", "2", "3")]}
    assert records.lines(spark, str(tmp_path), {}).rdd.getNumPartitions() > 1
    # the same cells as Spark's own reader, which takes one task per file
    own = spark.read.options(header="true", multiLine="true", escape="\\").csv(str(tmp_path))
    assert sorted(map(tuple, own.collect()), key=str) == sorted(got.values(), key=str)


def test_cells_over_many_splits(spark, tmp_path, small_splits):
    rows = [("1", "\n".join("part" for _ in range(200)), "x"), ("2", "a", "b\nc"), ("3", "\n" * 90, "end")]
    (tmp_path / "a.csv").write_text(text_of(rows))
    small_splits(50)
    df = readers.read_delimited(spark, str(tmp_path), header=False, multiline=True)
    assert sorted(map(tuple, df.collect())) == rows
    # a quote that is never closed takes what follows, to the end of its file
    (tmp_path / "b.csv").write_text('9,"open\n10,a,b\n')
    assert {r[0] for r in readers.read_delimited(spark, str(tmp_path), header=False, multiline=True).collect()} == {"1", "2", "3", "9"}


def test_quotes_inside_plain_cells_open_nothing(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('id,size\n1,5" pipe\n2,say "hi\n3,"a ""b"" c"\n4, "x\n5,"whole"\n')
    small_splits(8)
    df = readers.read_delimited(spark, str(tmp_path), multiline=True)
    own = spark.read.options(header="true", multiLine="true", escape="\\").csv(str(tmp_path))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, own.collect()))


def test_odd_rows_charset_and_compression(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.csv.gz", "wb") as out:
        out.write('id;näme\r\n1;"€\r\nx"\r\n2\r\n3;a;b\r\n\r\n'.encode("cp1252"))
    df = readers.read_delimited(spark, str(tmp_path), ";", charset="windows-1252", multiline=True, odd_rows="odd", types={"id": "integer"})
    assert df.columns == ["id", "näme", "odd"]
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "€\r\nx", None), (2, None, "2"), (3, "a", "3;a;b")]


def test_headers_come_from_the_first_bytes(spark, tmp_path, monkeypatch):
    """Long headers are read in growing pieces; files without a row are left out."""
    monkeypatch.setattr(records, "FIRST_BYTES", 4)
    names = [f"col\n{i}" for i in range(50)]
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows([names, range(50)])
    (tmp_path / "a.csv").write_text(out.getvalue())
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_bytes(b"\xef\xbb\xbfcol_x")
    df = readers.read_delimited(spark, str(tmp_path), multiline=True)
    assert set(df.columns) == {*names, "col_x"} and df.count() == 1
    plain = readers.read_delimited(spark, str(tmp_path / "c.csv"))
    assert plain.columns == ["col_x"] and plain.count() == 0
    with pytest.raises(ValueError):
        readers.read_delimited(spark, str(tmp_path / "b.csv"))


def test_no_python_without_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    df = readers.read_delimited(spark, str(tmp_path)).filter(F.col("a") == "1")
    assert "Python" not in df._jdf.queryExecution().toString() and df.count() == 1
