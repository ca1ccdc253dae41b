"""Window calculations: whole-table ones in the split form, partitioned ones, group aggregates."""

from functools import partial

from pyspark.sql import functions as F

from tallyframe.operators.windows import Calc, window, windows

from .registry import query


def _events(t):
    value = F.when(F.col("event_type") != "view", F.col("value"))
    return t.events.select("event_id", "ts", "user_id", "event_type", "value", value.alias("sparse"))


EVENTS = "(SELECT event_id, ts, user_id, event_type, value, CASE WHEN event_type <> 'view' THEN value END AS sparse FROM events)"
BY_TIME = "PARTITION BY user_id ORDER BY ts, event_id"
ORDER = [("ts", "asc"), ("event_id", "asc")]


@query(f"""SELECT event_id, lag(value, 1) OVER ({BY_TIME}) AS prev, lead(value, 2) OVER ({BY_TIME}) AS next2, row_number() OVER ({BY_TIME}) AS rn,
round(sum(value) OVER ({BY_TIME}), 2) AS running FROM {EVENTS}""")
def window_ordered(t):
    df = _events(t)
    step = partial(window, sorts=ORDER, partitions=["user_id"])
    df = step(df, "prev", "LAG", "value")
    df = step(df, "next2", "LEAD", "value", offset=2)
    df = step(df, "rn", "ROW_NUM")
    df = step(df, "running", "CUM_SUM", "value")
    return df.select("event_id", "prev", "next2", "rn", F.round("running", 2).alias("running"))


@query(f"""SELECT event_id, last_value(sparse IGNORE NULLS) OVER ({BY_TIME} ROWS UNBOUNDED PRECEDING) AS down,
first_value(sparse IGNORE NULLS) OVER ({BY_TIME} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS up FROM {EVENTS}""")
def window_fill(t):
    df = window(_events(t), "down", "FILL_DOWN", "sparse", ORDER, ["user_id"])
    df = window(df, "up", "FILL_DOWN", "sparse", ORDER, ["user_id"], back_fill=True)
    return df.select("event_id", "down", "up")


@query("""SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC) AS r,
CAST(ntile(3) OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS tile FROM orders""")
def window_rank_ntile(t):
    df = window(t.orders, "r", "RANK", sorts=[("o_orderpriority", "dsc")], partitions=["o_custkey"])
    df = window(df, "tile", "NTILE", sorts=[("o_totalprice", "asc"), ("o_orderkey", "asc")], partitions=["o_custkey"], ntile=3)
    return df.select("o_orderkey", "r", "tile")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER o AS rn, round(sum(l_quantity) OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING), 2) AS running
FROM lineitem WINDOW o AS (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey)""")
def window_whole_table_sum(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    sorts = [("l_extendedprice", "dsc"), ("l_orderkey", "asc"), ("l_linenumber", "asc"), ("l_partkey", "asc"), ("l_suppkey", "asc")]
    df = windows(df, [Calc("rn", "ROW_NUM"), Calc("running", "CUM_SUM", "l_quantity")], sorts)
    return df.withColumn("running", F.round("running", 2)).drop("l_quantity")


@query(f"""SELECT event_id, lag(value, 3) OVER o AS prev, lead(value, 1) OVER o AS next, CAST(ntile(7) OVER o AS INTEGER) AS tile,
last_value(sparse IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS down FROM {EVENTS} WINDOW o AS (ORDER BY ts, event_id)""")
def window_whole_table_neighbours(t):
    calcs = [Calc("prev", "LAG", "value", offset=3), Calc("next", "LEAD", "value"), Calc("tile", "NTILE", ntile=7), Calc("down", "FILL_DOWN", "sparse")]
    df = windows(_events(t), calcs, ORDER)
    return df.select("event_id", "prev", "next", "tile", "down")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, rank() OVER (ORDER BY l_shipdate DESC, l_quantity) AS r FROM lineitem")
def window_whole_table_rank(t):
    df = window(t.lineitem, "r", "RANK", sorts=[("l_shipdate", "dsc"), ("l_quantity", "asc")])
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "r")


@query(f"""SELECT event_id, round(sum(value) OVER p, 2) AS s, count(*) OVER p AS n, round(avg(value) OVER p, 6) AS a, max(value) OVER p AS hi, min(value) OVER p AS lo,
round(stddev_samp(value) OVER p, 6) AS sd, round(var_samp(value) OVER p, 6) AS v FROM {EVENTS} WINDOW p AS (PARTITION BY user_id)""")
def window_group_numbers(t):
    df = _events(t)
    for out, calc in (("s", "SUM"), ("a", "AVG"), ("hi", "MAX"), ("lo", "MIN"), ("sd", "STDDEV"), ("v", "VAR")):
        df = window(df, out, calc, "value", partitions=["user_id"])
    df = window(df, "n", "COUNT", partitions=["user_id"])
    digits = {"s": 2, "a": 6, "sd": 6, "v": 6}
    return df.select("event_id", "n", "hi", "lo", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query("""WITH g AS (SELECT event_type, median(value) AS med, count(DISTINCT user_id) AS users, arg_min(value, (ts, event_id)) AS first_value,
arg_max(value, (ts, event_id)) AS last_value, string_agg(DISTINCT CAST(user_id % 5 AS VARCHAR), '+' ORDER BY CAST(user_id % 5 AS VARCHAR)) AS marks FROM events GROUP BY event_type),
m AS (SELECT event_type, user_id AS top_user FROM (SELECT event_type, user_id, row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id) AS r FROM events GROUP BY 1, 2) x WHERE r = 1)
SELECT event_id, med, users, first_value, last_value, marks, top_user FROM events JOIN g USING (event_type) JOIN m USING (event_type)""")
def window_group_distinct(t):
    df = t.events.select("event_id", "ts", "user_id", "event_type", "value", (F.col("user_id") % 5).alias("mark"))
    by = ["event_type"]
    df = window(df, "med", "MEDIAN", "value", partitions=by)
    df = window(df, "users", "NUNIQUE", "user_id", partitions=by)
    df = window(df, "first_value", "FIRST", "value", ORDER, by)
    df = window(df, "last_value", "LAST", "value", ORDER, by)
    df = window(df, "marks", "JOIN_STR_DISTINCT", "mark", partitions=by, delimiter="+")
    df = window(df, "top_user", "MODE", "user_id", partitions=by)
    return df.select("event_id", "med", "users", "first_value", "last_value", "marks", "top_user")


@query("""SELECT o_orderkey, string_agg(o_orderstatus, '') OVER (PARTITION BY o_custkey ORDER BY o_orderstatus ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS statuses FROM orders""")
def window_join_text(t):
    df = window(t.orders, "statuses", "JOIN_STR", "o_orderstatus", partitions=["o_custkey"], delimiter="")
    return df.select("o_orderkey", "statuses")


@query("SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER (), 12) AS share FROM orders")
def window_whole_table_share(t):
    df = window(t.orders.select("o_orderkey", "o_totalprice"), "total", "SUM", "o_totalprice")
    return df.select("o_orderkey", F.round(F.col("o_totalprice") / F.col("total"), 12).alias("share"))
