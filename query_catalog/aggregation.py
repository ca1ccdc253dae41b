"""Grouping, time series, hierarchies, duplicates, top rows and samples."""

from pyspark.sql import functions as F

from tallyframe.operators import aggregate as ag
from tallyframe.operators import dedupe, joins, shape
from tallyframe.operators.aggregate import Agg, summarize
from tallyframe.operators.filters import filter_rules
from tallyframe.operators.hierarchy import hierarchy
from tallyframe.operators.shape import ColumnSpec
from tallyframe.operators.timeseries import time_series
from tallyframe.functions.predicates import Rule

from .registry import query


@query("""SELECT o_custkey, count(*) AS "Lines", round(sum(l_extendedprice), 2) AS "Revenue", round(avg(l_quantity), 6) AS "Average Quantity"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate::DATE >= DATE '1995-01-01' AND l_returnflag <> 'R'
GROUP BY o_custkey ORDER BY "Revenue" DESC, o_custkey LIMIT 100""")
def flagship(t):
    specs = [
        ColumnSpec("Order", "integer", "l_orderkey"),
        ColumnSpec("Amount", "number", "l_extendedprice"),
        ColumnSpec("Quantity", "number", "l_quantity"),
        ColumnSpec("Flag", "string", "l_returnflag"),
        ColumnSpec("Shipped", "date", "l_shipdate"),
    ]
    lines = shape.adapter(t.lineitem, specs)
    lines = filter_rules(lines, [Rule("Shipped", "IS_ON_OR_AFTER", date_operator="EXACT_DATE", date="1995-01-01"), Rule("Flag", "!=", "R")])
    joined = joins.blend(lines, t.orders.select("o_orderkey", "o_custkey"), [joins.On("Order", "eq", "o_orderkey")])
    totals = summarize(joined, ["o_custkey"], [Agg("COUNT", None, "Lines"), Agg("SUM", "Amount", "Revenue"), Agg("AVG", "Quantity", "Average Quantity")])
    rounded = totals.withColumn("Revenue", F.round("Revenue", 2)).withColumn("Average Quantity", F.round("Average Quantity", 6))
    return dedupe.sample_top(rounded, 100, [("Revenue", "dsc"), ("o_custkey", "asc")])


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS s, count(*) AS n, count(DISTINCT l_partkey) AS parts,
min(l_shipdate)::DATE AS first_ship, max(l_quantity) AS max_qty, round(avg(l_discount), 8) AS avg_discount,
round(stddev_samp(l_quantity), 6) AS sd, round(var_samp(l_quantity), 6) AS v FROM lineitem GROUP BY 1, 2""")
def summarize_numbers(t):
    df = summarize(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        [
            Agg("SUM", "l_extendedprice", "s"),
            Agg("COUNT", None, "n"),
            Agg("NUNIQUE", "l_partkey", "parts"),
            Agg("MIN", "l_shipdate", "first_ship"),
            Agg("MAX", "l_quantity", "max_qty"),
            Agg("AVG", "l_discount", "avg_discount"),
            Agg("STDDEV", "l_quantity", "sd"),
            Agg("VAR", "l_quantity", "v"),
        ],
        sorts=[("l_returnflag", "asc"), ("s", "dsc")],
    )
    digits = {"s": 2, "avg_discount": 8, "sd": 6, "v": 6}
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c).cast("date").alias(c) if c == "first_ship" else F.col(c) for c in df.columns])


@query("""WITH m AS (SELECT l_suppkey, mode_value FROM (SELECT l_suppkey, l_quantity AS mode_value, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_quantity) AS r
FROM lineitem GROUP BY l_suppkey, l_quantity) x WHERE r = 1)
SELECT l.l_suppkey, median(l_extendedprice) AS med, any_value(mode_value) AS mode_qty, count(*) AS n FROM lineitem l JOIN m ON l.l_suppkey = m.l_suppkey GROUP BY l.l_suppkey""")
def summarize_median_mode(t):
    return summarize(
        t.lineitem,
        ["l_suppkey"],
        [Agg("MEDIAN", "l_extendedprice", "med"), Agg("MODE", "l_quantity", "mode_qty"), Agg("COUNT", None, "n")],
    )


@query("""SELECT median(l_extendedprice) AS med, (SELECT l_partkey FROM lineitem GROUP BY l_partkey ORDER BY count(*) DESC, l_partkey LIMIT 1) AS mode_part,
count(*) AS n FROM lineitem""")
def summarize_whole_table(t):
    return summarize(t.lineitem, [], [Agg("MEDIAN", "l_extendedprice", "med"), Agg("MODE", "l_partkey", "mode_part"), Agg("COUNT", None, "n")])


@query("""SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_price, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority,
string_agg(DISTINCT o_orderstatus, '/' ORDER BY o_orderstatus) AS statuses, string_agg(CAST(o_orderkey AS VARCHAR), ', ' ORDER BY CAST(o_orderkey AS VARCHAR)) AS order_list FROM orders GROUP BY o_custkey""")
def summarize_text_order(t):
    by_date = (("o_orderdate", "asc"), ("o_orderkey", "asc"))
    latest_first = (("o_orderdate", "dsc"), ("o_orderkey", "dsc"))
    return summarize(
        t.orders,
        ["o_custkey"],
        [
            Agg("FIRST", "o_totalprice", "first_price", sorts=by_date),
            Agg("FIRST", "o_orderpriority", "last_priority", sorts=latest_first),
            Agg("JOIN_STR_DISTINCT", "o_orderstatus", "statuses", delimiter="/"),
            Agg("JOIN_STR", "o_orderkey", "order_list"),
        ],
    )


@query("""WITH e AS (SELECT user_id, CASE event_type WHEN 'view' THEN ' ' WHEN 'click' THEN NULL ELSE event_type END AS kind, value FROM events)
SELECT user_id, count(*) AS n_rows, count(CASE WHEN trim(kind) <> '' THEN kind END) AS n_filled, count(kind) AS n_not_null, count(*) - count(kind) AS n_null,
count(DISTINCT kind) AS n_kinds, count(CASE WHEN value > 50 THEN 1 END) AS n_big FROM e GROUP BY user_id""")
def summarize_counts(t):
    kind = F.when(F.col("event_type") == "view", " ").when(F.col("event_type") != "click", F.col("event_type"))
    df = t.events.select("user_id", kind.alias("kind"), "value")
    counted = summarize(df, ["user_id"], [Agg("COUNT", "user_id", "n_rows"), Agg("COUNT", "kind", "n_filled"), Agg("NUNIQUE", "kind", "n_kinds")])
    more = df.groupBy("user_id").agg(
        ag.count_non_null(F.col("kind")).alias("n_not_null"),
        ag.count_null(F.col("kind")).alias("n_null"),
        ag.count_where(F.col("value") > 50).alias("n_big"),
    )
    return joins.blend(counted, more, [joins.On("user_id", "eq", "user_id")])


@query("""SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total, count(DISTINCT o_custkey) AS customers FROM orders WHERE o_totalprice > 1000 GROUP BY 1""")
def summarize_pushdown(t):
    df = ag.summarize_pushdown(t.orders.filter("o_totalprice > 1000"), ["o_orderstatus"], [Agg("SUM", "o_totalprice", "total"), Agg("NUNIQUE", "o_custkey", "customers")])
    return df.withColumn("total", F.round("total", 2))


def _series_sql(start: str, label: str, offset: str, table: str, date: str, keys: str, aggs: str) -> str:
    return f"""WITH s AS (SELECT *, {start} AS p FROM {table})
SELECT {keys}, {label} AS "Period Name", CAST({offset} AS BIGINT) AS "Period Offset", {aggs} FROM s GROUP BY {keys}, p"""


@query(_series_sql("date_trunc('month', o_orderdate)::DATE", "strftime(p, '%b %Y')", "(year(p) * 12 + month(p)) - (1998 * 12 + 8)", "orders", "o_orderdate",
                   "o_orderstatus", "round(sum(o_totalprice), 2) AS revenue, count(*) AS n"))
def time_series_month(t):
    df = time_series(t.orders, "o_orderdate", [Agg("SUM", "o_totalprice", "revenue"), Agg("COUNT", None, "n")], "month", ["o_orderstatus"], as_of="1998-08-02")
    return df.withColumn("revenue", F.round("revenue", 2))


@query(_series_sql("ts::DATE", "strftime(p, '%Y-%m-%d')", "p - DATE '2024-01-30'", "events", "ts", "event_type", "count(DISTINCT user_id) AS users, max(value) AS top"))
def time_series_day(t):
    return time_series(t.events, "ts", [Agg("NUNIQUE", "user_id", "users"), Agg("MAX", "value", "top")], "day", ["event_type"], as_of="2024-01-30")


@query(_series_sql("date_trunc('week', ts)::DATE", "strftime(p, '%Y-%m-%d')", "(p - DATE '2024-01-29') // 7", "events", "ts", "event_type", "median(value) AS middle"))
def time_series_week(t):
    return time_series(t.events, "ts", [Agg("MEDIAN", "value", "middle")], "week", ["event_type"], as_of="2024-01-30")


@query(_series_sql("date_trunc('quarter', o_orderdate)::DATE", "'Q' || quarter(p) || ' ' || year(p)", "(year(p) * 4 + quarter(p)) - (1998 * 4 + 3)", "orders", "o_orderdate",
                   "o_orderpriority", "min(o_totalprice) AS low"))
def time_series_quarter(t):
    return time_series(t.orders, "o_orderdate", [Agg("MIN", "o_totalprice", "low")], "quarter", ["o_orderpriority"], as_of="1998-08-02")


@query(_series_sql("date_trunc('year', o_orderdate)::DATE", "CAST(year(p) AS VARCHAR)", "year(p) - 1998", "orders", "o_orderdate", "o_orderpriority", "round(avg(o_totalprice), 4) AS mean"))
def time_series_year(t):
    df = time_series(t.orders, "o_orderdate", [Agg("AVG", "o_totalprice", "mean")], "year", ["o_orderpriority"], as_of="1998-08-02")
    return df.withColumn("mean", F.round("mean", 4))


@query(_series_sql("make_date(CAST(year(l_shipdate) // 10 * 10 AS INTEGER), 1, 1)", "CAST(year(p) AS VARCHAR) || 's'", "year(p) // 10 - 199", "lineitem", "l_shipdate", "l_returnflag",
                   "string_agg(DISTINCT l_linestatus, ', ' ORDER BY l_linestatus) AS statuses"))
def time_series_decade(t):
    return time_series(t.lineitem, "l_shipdate", [Agg("JOIN_STR_DISTINCT", "l_linestatus", "statuses")], "decade", ["l_returnflag"], as_of="1998-08-02")


@query("""WITH e AS (SELECT user_id, ts::DATE AS d, value FROM events WHERE event_type = 'purchase'),
span AS (SELECT user_id, min(d) AS a, max(d) AS b FROM e GROUP BY user_id),
grid AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS d FROM span)
SELECT g.user_id, strftime(g.d, '%Y-%m-%d') AS "Period Name", CAST(g.d - DATE '2024-01-30' AS BIGINT) AS "Period Offset",
count(e.d) AS n, round(sum(value), 2) AS total FROM grid g LEFT JOIN e ON g.user_id = e.user_id AND g.d = e.d GROUP BY g.user_id, g.d""")
def time_series_gaps(t):
    df = t.events.filter("event_type = 'purchase'")
    out = time_series(df, "ts", [Agg("COUNT", None, "n"), Agg("SUM", "value", "total")], "day", ["user_id"], as_of="2024-01-30", fill_gaps=True)
    return out.withColumn("total", F.round("total", 2))


@query("""WITH RECURSIVE c AS (SELECT c_custkey AS id, CASE WHEN c_custkey > 0 THEN c_custkey // 10 END AS parent, c_acctbal, c_mktsegment, c_name FROM customer),
chain AS (SELECT id AS start, id, parent, c_acctbal, c_mktsegment, 0 AS depth FROM c
UNION ALL SELECT chain.start, c.id, c.parent, c.c_acctbal, c.c_mktsegment, depth + 1 FROM chain JOIN c ON chain.parent = c.id)
SELECT start AS id, count(*) AS levels, round(sum(c_acctbal), 2) AS total, round(avg(c_acctbal), 6) AS mean, min(c_acctbal) AS low, max(c_acctbal) AS high,
round(stddev_samp(c_acctbal), 4) AS sd, median(c_acctbal) AS med, count(DISTINCT c_mktsegment) AS segments,
string_agg(CAST(id AS VARCHAR), ' > ' ORDER BY depth) AS path FROM chain GROUP BY start""")
def hierarchy_chain(t):
    df = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") > 0, F.floor(F.col("c_custkey") / 10)).alias("parent"),
        "c_acctbal",
        "c_mktsegment",
    )
    aggs = [
        Agg("COUNT", None, "levels"),
        Agg("SUM", "c_acctbal", "total"),
        Agg("AVG", "c_acctbal", "mean"),
        Agg("MIN", "c_acctbal", "low"),
        Agg("MAX", "c_acctbal", "high"),
        Agg("STDDEV", "c_acctbal", "sd"),
        Agg("MEDIAN", "c_acctbal", "med"),
        Agg("NUNIQUE", "c_mktsegment", "segments"),
        Agg("JOIN_STR", "id", "path", delimiter=" > "),
    ]
    out = hierarchy(df, "id", "parent", aggs).drop("parent", "c_acctbal", "c_mktsegment")
    return out.withColumn("total", F.round("total", 2)).withColumn("mean", F.round("mean", 6)).withColumn("sd", F.round("sd", 4))


@query("""SELECT text_key, lang, n_chars, doc_id FROM (SELECT md5(text) AS text_key, lang, n_chars, doc_id,
row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id DESC) AS r FROM documents) x WHERE r = 1""")
def deduplicate(t):
    df = t.documents.select(F.md5("text").alias("text_key"), "lang", "n_chars", "doc_id")
    return dedupe.deduplicate(df, ["text_key"], [("n_chars", "dsc"), ("doc_id", "dsc")])


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def deduplicate_rows(t):
    return dedupe.deduplicate(t.lineitem.select("l_orderkey", "l_linenumber"))


@query("SELECT doc_id, count(*) OVER (PARTITION BY text) > 1 AS \"Is Duplicate\" FROM documents")
def flag_duplicates(t):
    return dedupe.flag_duplicates(t.documents.select("doc_id", "text"), ["text"]).drop("text")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey) AS r
FROM lineitem) x WHERE r > 1""")
def duplicates_only(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return dedupe.duplicates_only(df, ["l_orderkey", "l_linenumber"], [("l_extendedprice", "asc"), ("l_partkey", "asc")])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def sample_top(t):
    return dedupe.sample_top(t.orders.select("o_orderkey", "o_totalprice"), 50, [("o_totalprice", "dsc")])


@query("""SELECT c_custkey, o_orderkey, o_totalprice FROM (SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice,
row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) x WHERE r <= 3""")
def sample_top_per_group(t):
    df = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return dedupe.sample_top(df, 3, [("o_totalprice", "dsc")], ["c_custkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE substr(md5('5|' || o_orderkey), 1, 8) < '40000000'")
def sample_random(t):
    return dedupe.sample_random(t.orders.select("o_orderkey", "o_totalprice"), fraction=0.25, seed=5, by=["o_orderkey"])
