"""Pivot, unpivot, split, JSON and XML."""

from pyspark.sql import functions as F

from tallyframe.operators import reshape
from tallyframe.operators import semistructured as semi

from .registry import query


@query("""SELECT ts::DATE AS day, round(sum(value) FILTER (event_type = 'click'), 2) AS click, round(sum(value) FILTER (event_type = 'error'), 2) AS error,
round(sum(value) FILTER (event_type = 'purchase'), 2) AS purchase, round(sum(value) FILTER (event_type = 'signup'), 2) AS signup, round(sum(value) FILTER (event_type = 'view'), 2) AS "view" FROM events GROUP BY 1""")
def pivot(t):
    df = t.events.select(F.col("ts").cast("date").alias("day"), "event_type", "value")
    wide = reshape.pivot(df, "event_type", "value", "SUM", ["click", "error", "purchase", "signup", "view"])
    return wide.select("day", *[F.round(c, 2).alias(c) for c in wide.columns[1:]])


@query("""SELECT user_id, median(value) FILTER (event_type = 'click') AS click, median(value) FILTER (event_type = 'error') AS error,
median(value) FILTER (event_type = 'purchase') AS purchase, median(value) FILTER (event_type = 'signup') AS signup, median(value) FILTER (event_type = 'view') AS "view" FROM events GROUP BY 1""")
def pivot_median_found_values(t):
    return reshape.pivot(t.events.select("user_id", "event_type", "value"), "event_type", "value", "MEDIAN")


@query("""SELECT c_nationkey, min(c_name) FILTER (c_mktsegment = 'BUILDING') AS "BUILDING", min(c_name) FILTER (c_mktsegment = 'MACHINERY') AS "MACHINERY" FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1""")
def pivot_any(t):
    df = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_nationkey", "c_mktsegment", "c_name")
    return reshape.pivot(df, "c_mktsegment", "c_name", "ANY", ["BUILDING", "MACHINERY"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_tax', nullif(l_tax, 0) FROM lineitem""")
def unpivot(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"))
    return reshape.unpivot(df, ["l_quantity", "l_tax"], "measure", "amount")


@query("""SELECT c_custkey, 'c_name' AS "Name", c_name AS "Value" FROM customer UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer""")
def unpivot_keep(t):
    return reshape.unpivot(t.customer.drop("c_acctbal"), ["c_custkey"], mode="keep")


@query("SELECT p_partkey, trim(unnest(string_split(p_name || ' | ' || p_brand || '|', '|'))) AS label FROM part")
def split_rows(t):
    df = t.part.select("p_partkey", F.concat("p_name", F.lit(" | "), "p_brand", F.lit("|")).alias("label"))
    return reshape.split_rows(df, "label", "|")


@query("""SELECT o_orderkey, day, split_part(day, '.', 1) AS "day Split 1", split_part(day, '.', 2) AS "day Split 2", split_part(day, '.', 3) AS "day Split 3",
CAST(NULL AS VARCHAR) AS "day Split 4" FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y.%m.%d') AS day FROM orders) o""")
def split_columns(t):
    return reshape.split_columns(t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy.MM.dd").alias("day")), "day", ".", 4)


@query("""SELECT p_partkey, p_name, split_part(p_name, ' ', 1) AS "p_name Split 1", split_part(p_name, ' ', 2) AS "p_name Split 2" FROM part""")
def split_columns_found_width(t):
    return reshape.split_columns(t.part.select("p_partkey", "p_name"), "p_name", " ")


@query("SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
def json_flatten_found_schema(t):
    return semi.json_flatten(t.events.select("event_id", "props"), "props")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS "who.id", CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS "who.rank",
CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price, CASE WHEN o_orderstatus <> 'P' THEN '["' || o_orderstatus || '","x"]' END AS tags FROM orders""")
def json_flatten_nested(t):
    doc = F.to_json(
        F.struct(
            F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("rank")).alias("who"),
            F.col("o_totalprice").alias("price"),
            F.array("o_orderstatus", F.lit("x")).alias("tags"),
        )
    )
    # every pending order has a broken text
    df = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "{broken").otherwise(doc).alias("body"))
    return semi.json_flatten(df, "body", "who struct<id: bigint, rank: string>, price double, tags array<string>")


@query("""SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'""")
def json_explode(t):
    keys = F.to_json(F.array_sort(F.collect_list(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")))))
    df = t.orders.groupBy("o_custkey").agg(keys.alias("body"))
    return semi.json_explode(df, "body", "o_orderkey", "bigint")


def _order_xml(t):
    line = F.concat(F.lit("<line><no>"), F.col("l_linenumber").cast("string"), F.lit("</no><flag>"), "l_returnflag", F.lit("</flag></line>"))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list(line)), "").alias("body"))
    return lines.select("l_orderkey", F.concat(F.lit("<order><id>"), F.col("l_orderkey").cast("string"), F.lit("</id>"), "body", F.lit("</order>")).alias("xml"))


@query("SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS line_no FROM lineitem")
def xml_select(t):
    return semi.xml_select(_order_xml(t), "xml", "order/line/no", "line_no").select("l_orderkey", "line_no")


@query("SELECT l_orderkey, l_linenumber AS no, l_returnflag AS flag FROM lineitem")
def xml_select_extract(t):
    rows = semi.xml_select(_order_xml(t), "xml", "order/line", "line", "struct<no: int, flag: string>").select("l_orderkey", "line")
    return semi.xml_extract(rows, "line", "struct<no: int, flag: string>")


@query("""SELECT s_suppkey, s_name AS "name", s_nationkey AS "home.nation", s_acctbal AS "home.balance" FROM supplier""")
def xml_extract(t):
    doc = F.to_xml(
        F.struct(F.struct(F.col("s_name").alias("name"), F.struct(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")).alias("home")).alias("wrap")),
        {"rowTag": "supplier"},
    )
    df = t.supplier.select("s_suppkey", doc.alias("xml"))
    return semi.xml_extract(df, "xml", "struct<wrap: struct<name: string, home: struct<nation: int, balance: double>>>", unwrap="wrap")


@query("""SELECT p_partkey, '{"brand":"' || p_brand || '","size":' || p_size || '}' AS body FROM part""")
def xml_to_json(t):
    doc = F.concat(F.lit("<p:part xmlns:p='urn:part'><p:brand>"), "p_brand", F.lit("</p:brand><p:size>"), F.col("p_size").cast("string"), F.lit("</p:size></p:part>"))
    df = t.part.select("p_partkey", semi.strip_namespaces(doc).alias("xml"))
    return semi.xml_to_json(df, "xml", "body", "struct<brand: string, size: int>").drop("xml")
