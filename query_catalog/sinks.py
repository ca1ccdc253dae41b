"""Table outputs: every query writes a table and reads it back."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.session import scratch_path
from tallyframe.sources import readers, writers

from .registry import query


def _orders(t):
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0")
def write_replace(t):
    path = scratch_path(t.spark, "replace")
    df = t.customer.select("c_custkey", "c_name", "c_acctbal")
    writers.write_table(df, path)
    # the target is its own input
    writers.write_table(t.spark.read.parquet(path).filter("c_acctbal >= 0").select("c_custkey", "c_name"), path)
    return t.spark.read.parquet(path)


@query("SELECT * FROM customer")
def write_append(t):
    path = scratch_path(t.spark, "append")
    building = F.col("c_mktsegment") == "BUILDING"
    writers.write_table(t.customer.filter(building), path, "append")
    writers.write_table(t.customer.filter(~building), path, "append")
    return t.spark.read.parquet(path)


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders
UNION ALL SELECT o_orderkey + 100000000, 'N', o_totalprice FROM orders WHERE o_orderstatus = 'P'""")
def write_upsert(t):
    path = scratch_path(t.spark, "upsert")
    old = _orders(t)
    changed = old.filter("o_totalprice > 300000").withColumn("o_orderstatus", F.lit("X"))
    added = old.filter("o_orderstatus = 'P'").select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice")
    writers.write_table(old, path)
    writers.write_table(changed.unionByName(added), path, "upsert", ["o_orderkey"])
    return t.spark.read.parquet(path)


GROUP_SQL = """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000
UNION ALL SELECT o_orderkey, 'new', o_totalprice FROM orders WHERE o_totalprice < 50000"""


def _group_change(t):
    old = _orders(t)
    return old.filter("o_orderstatus = 'F' AND o_totalprice > 250000").unionByName(old.filter("o_totalprice < 50000").withColumn("o_orderstatus", F.lit("new")))


@query(GROUP_SQL)
def write_group_replace(t):
    path = scratch_path(t.spark, "group")
    writers.write_table(_orders(t), path)
    writers.write_table(_group_change(t), path, "groupReplace", ["o_orderstatus"])
    return t.spark.read.parquet(path)


@query(GROUP_SQL)
def write_group_replace_partitions(t):
    path = scratch_path(t.spark, "group-partitions")
    writers.write_table(_orders(t), path, partition_by=["o_orderstatus"])
    writers.write_table(_group_change(t), path, "groupReplace", ["o_orderstatus"], partition_by=["o_orderstatus"])
    return t.spark.read.parquet(path)


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
CASE WHEN o_totalprice > 300000 THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders""")
def write_update(t):
    path = scratch_path(t.spark, "update")
    old = _orders(t)
    changed = old.filter("o_totalprice > 300000").select("o_orderkey", F.lit(None).cast("string").alias("o_orderstatus"), F.lit(0.0).alias("o_totalprice"))
    unknown = old.select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), "o_orderstatus", "o_totalprice")
    writers.write_table(old, path)
    writers.write_table(changed.unionByName(unknown), path, "update", ["o_orderkey"])
    return t.spark.read.parquet(path)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def write_file_per_value(t):
    path = scratch_path(t.spark, "by-value")
    df = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    writers.write_delimited(df, path, sorts=[("c_name", "asc")], by="c_mktsegment", delimiter=";")
    return t.spark.read.options(header="true", sep=";").schema("c_custkey bigint, c_name string, c_mktsegment string").csv(path)


@query("SELECT s_suppkey, '\"' || s_name || '\", a;b' AS s_name FROM supplier")
def write_delimited_sorted(t):
    path = scratch_path(t.spark, "sorted")
    df = t.supplier.select("s_suppkey", F.concat(F.lit('"'), "s_name", F.lit('", a;b')).alias("s_name"))
    writers.write_delimited(df, path, sorts=[("s_name", "dsc")], one_file=True, delimiter=";", charset="windows-1252")
    return readers.read_delimited(t.spark, path, ";", charset="windows-1252", types={"s_suppkey": "integer"})


@query("SELECT s_suppkey, s_acctbal, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS place FROM supplier")
def write_delimited_order(t):
    """The order of a sorted output: every row with its place in the file."""
    path = scratch_path(t.spark, "ordered")
    writers.write_delimited(t.supplier.select("s_suppkey", "s_acctbal"), path, sorts=[("s_acctbal", "dsc"), ("s_suppkey", "asc")], one_file=True)
    # one file is read in its order, and numbers of a partition follow it
    lines = t.spark.read.option("header", "true").schema("s_suppkey bigint, s_acctbal double").csv(path).withColumn("line", F.monotonically_increasing_id())
    return lines.select("s_suppkey", "s_acctbal", F.row_number().over(Window.orderBy("line")).cast("bigint").alias("place"))


@query("SELECT n_nationkey, n_name, 'n_regionkey=' || n_regionkey AS folder FROM nation")
def read_subfolders(t):
    """All files below a folder whose name fits a pattern, with the folder that each row's file is in."""
    path = scratch_path(t.spark, "below")
    writers.write_delimited(t.nation.select("n_nationkey", "n_name", "n_regionkey"), path, by="n_regionkey")
    rows = t.spark.read.options(header="true", **readers.file_options(pattern="part-*.csv", subfolders=True)).schema("n_nationkey int, n_name string").csv(path)
    return rows.select("n_nationkey", "n_name", F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder"))


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0")
def read_latest_file(t):
    """Of two files in a folder, the one that was written last."""
    path = scratch_path(t.spark, "latest")
    suppliers = t.supplier.select("s_suppkey", "s_name")
    for rest in (1, 0):
        suppliers.filter(F.col("s_suppkey") % 2 == rest).coalesce(1).write.mode("append").json(path)
    return t.spark.read.schema(suppliers.schema).json(readers.latest_file(t.spark, path, pattern="*.json"))
