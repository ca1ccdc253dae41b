"""Every registered query against its SQL; whole tables at the smallest scale factor."""

import os

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return oracle.duck(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert oracle.differences(df, con, sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracle_names_are_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_read_binary_writes_few_files(spark, tmp_path):
    """Documents hold many conversations; texts, and bytes of more than one each, come back whole."""
    data = [(c, turn, role) for c in range(250) for turn, role in ((0, f"a{c}"), (2, "é "), (1, "x=y"))]
    spark.createDataFrame(data, "conv_id long, turn int, role string").write.parquet(str(tmp_path / "conversations.parquet"))
    out = entry.QUERIES["read_binary"](spark, str(tmp_path))
    assert len(out.inputFiles()) == 3
    assert sorted(map(tuple, out.collect())) == [(c, f"a{c},x=y,é ", len(f"a{c},x=y,é ".encode()) + 1) for c in range(250)]
