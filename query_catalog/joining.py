"""Joins, stacking and matching."""

from pyspark.sql import functions as F

from tallyframe.operators import fuzzy, joins, sets
from tallyframe.operators.joins import On

from .registry import query


def _orders(t):
    return t.orders.select(F.col("o_orderkey").alias("key"), "o_custkey", "o_totalprice")


def _lines(t):
    return t.lineitem.filter("l_quantity > 25").select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_quantity")


ORDERS = "(SELECT o_orderkey AS key, o_custkey, o_totalprice FROM orders)"
LINES = "(SELECT l_orderkey AS key, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 25)"


@query(f"SELECT a.key, o_custkey, o_totalprice, l_linenumber, l_quantity FROM {ORDERS} a JOIN {LINES} b ON a.key = b.key")
def blend_inner(t):
    return joins.blend(_orders(t), _lines(t), [On("key", "eq", "key")])


@query(f"""SELECT a.key, o_custkey, o_totalprice, b.key AS "key (rhs)", l_linenumber, l_quantity FROM {ORDERS} a LEFT JOIN {LINES} b ON a.key = b.key""")
def blend_left(t):
    return joins.blend(_orders(t), _lines(t), [On("key", "eq", "key")], "left")


@query("""SELECT a.key, b.key AS "key (rhs)", l_linenumber FROM (SELECT o_orderkey AS key FROM orders WHERE o_orderstatus = 'F') a
RIGHT JOIN (SELECT l_orderkey AS key, l_linenumber FROM lineitem) b ON a.key = b.key""")
def blend_right(t):
    left = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("key"))
    right = t.lineitem.select(F.col("l_orderkey").alias("key"), "l_linenumber")
    return joins.blend(left, right, [On("key", "eq", "key")], "right")


@query(f"""SELECT a.key, o_custkey, b.key AS "key (rhs)", l_linenumber FROM (SELECT key, o_custkey FROM {ORDERS} WHERE o_totalprice > 200000) a
FULL JOIN (SELECT key, l_linenumber FROM {LINES}) b ON a.key = b.key""")
def blend_full(t):
    left = _orders(t).filter("o_totalprice > 200000").select("key", "o_custkey")
    return joins.blend(left, _lines(t).select("key", "l_linenumber"), [On("key", "eq", "key")], "full")


@query(f"""SELECT 'left' AS side, key, CAST(NULL AS INTEGER) AS l_linenumber FROM {ORDERS} WHERE o_totalprice > 200000 AND key NOT IN (SELECT key FROM {LINES})
UNION ALL SELECT 'right', key, l_linenumber FROM {LINES} WHERE key NOT IN (SELECT key FROM {ORDERS} WHERE o_totalprice > 200000)""")
def blend_forks(t):
    left = _orders(t).filter("o_totalprice > 200000")
    forks = joins.blend_forks(left, _lines(t), [On("key", "eq", "key")])
    return (
        forks.left_only.select(F.lit("left").alias("side"), "key", F.lit(None).cast("int").alias("l_linenumber"))
        .unionByName(forks.right_only.select(F.lit("right").alias("side"), "key", "l_linenumber"))
    )


@query(f"SELECT key, o_custkey, o_totalprice, key IN (SELECT key FROM {LINES}) AS has_lines FROM {ORDERS}")
def semi_anti(t):
    left, right, on = _orders(t), _lines(t), [On("key", "eq", "key")]
    return (
        joins.semi(left, right, on).withColumn("has_lines", F.lit(True))
        .unionByName(joins.anti(left, right, on).withColumn("has_lines", F.lit(False)))
    )


@query("""SELECT l_orderkey, l_linenumber, o_orderkey, o_totalprice FROM lineitem JOIN orders
ON l_orderkey = o_orderkey AND l_extendedprice <= o_totalprice AND l_shipdate > o_orderdate AND l_linenumber <> 1""")
def blend_theta(t):
    left = t.lineitem.withColumn("one", F.lit(1).cast("bigint"))
    right = t.orders.withColumn("first", F.lit(1).cast("bigint"))
    on = [On("l_orderkey", "eq", "o_orderkey"), On("l_extendedprice", "le", "o_totalprice"), On("l_shipdate", "gt", "o_orderdate"), On("l_linenumber", "ne", "first")]
    return joins.blend(left, right, on).select("l_orderkey", "l_linenumber", "o_orderkey", "o_totalprice")


@query("""SELECT c_custkey, s_suppkey, c_acctbal, s_acctbal FROM customer LEFT JOIN supplier
ON c_custkey = s_suppkey OR c_acctbal = s_acctbal OR (c_nationkey + 100000) = s_nationkey""")
def blend_any_condition(t):
    left = t.customer.withColumn("far", F.col("c_nationkey") + 100000)
    on = [On("c_custkey", "eq", "s_suppkey"), On("c_acctbal", "eq", "s_acctbal"), On("far", "eq", "s_nationkey")]
    return joins.blend(left, t.supplier, on, "left", "or").select("c_custkey", "s_suppkey", "c_acctbal", "s_acctbal")


@query("""SELECT o_orderkey, o_custkey, c_custkey FROM (SELECT o_orderkey, nullif(o_custkey, 7) AS o_custkey FROM orders) o
JOIN (SELECT nullif(c_custkey, 7) AS c_custkey FROM customer) c ON o_custkey IS NOT DISTINCT FROM c_custkey""")
def blend_null_safe(t):
    left = t.orders.select("o_orderkey", F.nullif(F.col("o_custkey"), F.lit(7)).alias("o_custkey"))
    right = t.customer.select(F.nullif(F.col("c_custkey"), F.lit(7)).alias("c_custkey"))
    return joins.blend(left, right, [On("o_custkey", "eq", "c_custkey")], null_safe=True)


@query("""SELECT page_id, word FROM pages JOIN (SELECT DISTINCT word FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) w
UNION ALL SELECT DISTINCT lower(r_name) FROM region) n ON contains(html, word) AND trim(word) <> ''""")
def blend_contains(t):
    from tallyframe.operators.reshape import split_rows

    words = split_rows(t.part.select(F.col("p_name").alias("word")), "word", " ").distinct()
    needles = words.unionByName(t.region.select(F.lower("r_name").alias("word")).distinct())
    return joins.blend(t.pages.select("page_id", "html"), needles, [On("html", "contains", "word")]).select("page_id", "word")


@query("""SELECT word, p_partkey FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part) w
JOIN part ON contains(p_name, word)""")
def blend_is_part_of(t):
    from tallyframe.operators.reshape import split_rows

    words = split_rows(t.part.select(F.col("p_name").alias("word")), "word", " ").distinct()
    return joins.blend(words, t.part.select("p_partkey", "p_name"), [On("word", "is_part_of", "p_name")]).select("word", "p_partkey")


@query("""SELECT o_orderkey, o_custkey, c_name, c_mktsegment, c_custkey IS NOT NULL AS found FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""")
def lookup(t):
    reference = t.customer.filter("c_acctbal > 0")
    return joins.lookup(t.orders.select("o_orderkey", "o_custkey"), reference, [On("o_custkey", "eq", "c_custkey")], ["c_name", "c_mktsegment"], hit="found")


@query(f"SELECT a.key, o_custkey, l_linenumber FROM {ORDERS} a LEFT JOIN {LINES} b ON a.key = b.key")
def join_stack_equivalence(t):
    forks = joins.blend_forks(_orders(t), _lines(t), [On("key", "eq", "key")])
    return sets.stack([forks.matched, forks.left_only], "all").select("key", "o_custkey", "l_linenumber")


@query("""SELECT c_custkey, r_name, c_acctbal * (1 + r_regionkey) AS scenario FROM customer CROSS JOIN region""")
def expand(t):
    df = joins.expand(t.customer.select("c_custkey", "c_acctbal"), t.region)
    return df.select("c_custkey", "r_name", (F.col("c_acctbal") * (1 + F.col("r_regionkey"))).alias("scenario"))


@query("""SELECT s_name, q, coalesce(n, 0) AS n FROM (SELECT DISTINCT s_suppkey, s_name FROM supplier)
CROSS JOIN (SELECT DISTINCT date_trunc('quarter', l_shipdate)::DATE AS q FROM lineitem)
LEFT JOIN (SELECT l_suppkey, date_trunc('quarter', l_shipdate)::DATE AS lq, count(*) AS n FROM lineitem GROUP BY 1, 2) ON l_suppkey = s_suppkey AND lq = q""")
def scaffold(t):
    from tallyframe.functions.dates import time_period
    from tallyframe.operators.aggregate import Agg, summarize

    dated = t.lineitem.select(F.col("l_suppkey"), time_period(F.col("l_shipdate"), "quarter").alias("lq"))
    grid = joins.scaffold(t.supplier.select("s_suppkey", "s_name"), dated.select(F.col("lq").alias("q")))
    counts = summarize(dated, ["l_suppkey", "lq"], [Agg("COUNT", None, "n")])
    joined = joins.blend(grid, counts, [On("s_suppkey", "eq", "l_suppkey"), On("q", "eq", "lq")], "left")
    return joined.select("s_name", "q", F.coalesce("n", F.lit(0)).alias("n"))


@query("""SELECT o_orderkey, unnest(generate_series(1, CAST(1 + o_orderkey % 4 AS BIGINT))) AS copy FROM orders""")
def generate_rows(t):
    df = t.orders.select("o_orderkey")
    return joins.generate_rows(df, F.lit(1).cast("bigint"), 1 + F.col("o_orderkey") % 4, "copy")


@query("""SELECT a.c_custkey, b.s_suppkey FROM customer a JOIN supplier b ON a.c_nationkey = b.s_nationkey AND abs(a.c_acctbal::DECIMAL(38,6) - b.s_acctbal::DECIMAL(38,6)) <= 250""")
def tolerance_join_amount(t):
    df = joins.tolerance_join(t.customer, t.supplier, [("c_nationkey", "s_nationkey")], amount=("c_acctbal", "s_acctbal", 250))
    return df.select("c_custkey", "s_suppkey")


@query("""SELECT a.o_orderkey, b.o_orderkey AS other FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND abs(a.o_orderdate::DATE - b.o_orderdate::DATE) <= 30
AND abs(a.o_totalprice::DECIMAL(38,6) - b.o_totalprice::DECIMAL(38,6)) <= 20000""")
def tolerance_join_date(t):
    right = t.orders.select(F.col("o_orderkey").alias("other"), F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("day"))
    df = joins.tolerance_join(t.orders, right, [("o_custkey", "cust")], ("o_totalprice", "price", 20000), ("o_orderdate", "day", 30))
    return df.select("o_orderkey", "other")


@query("""SELECT event_id, o_orderkey FROM (SELECT event_id, user_id, value * 10000 AS v FROM events) e ASOF LEFT JOIN
(SELECT o_custkey, max(o_orderkey) AS o_orderkey, o_totalprice FROM orders GROUP BY o_custkey, o_totalprice) o ON user_id = o_custkey AND v >= o_totalprice""")
def nearest_backward(t):
    left = t.events.select("event_id", "user_id", (F.col("value") * 10000).alias("v"))
    right = t.orders.groupBy("o_custkey", "o_totalprice").agg(F.max("o_orderkey").alias("o_orderkey"))
    return joins.nearest(left, right, [("user_id", "o_custkey")], ("v", "o_totalprice"), "backward").select("event_id", "o_orderkey")


@query("""WITH o AS (SELECT o_custkey, o_totalprice, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL),
e AS (SELECT event_id, user_id, value * 10000 AS v FROM events)
SELECT event_id, arg_min(o_orderkey, (abs(o_totalprice - v), o_totalprice)) AS o_orderkey FROM e LEFT JOIN o ON user_id = o_custkey GROUP BY event_id""")
def nearest_either(t):
    left = t.events.select("event_id", "user_id", (F.col("value") * 10000).alias("v"))
    right = t.orders.groupBy("o_custkey", "o_totalprice").agg(F.max("o_orderkey").alias("o_orderkey"))
    return joins.nearest(left, right, [("user_id", "o_custkey")], ("v", "o_totalprice")).select("event_id", "o_orderkey")


@query("""WITH l AS (SELECT c_custkey, substr(md5(c_name), 1, 14) AS name FROM customer),
r AS (SELECT c_custkey AS other, CASE c_custkey % 3 WHEN 0 THEN name WHEN 1 THEN substr(name, 1, 5) || substr(name, 7) ELSE substr(name, 1, 3) || 'x' || substr(name, 5) END AS typed FROM l)
SELECT c_custkey, other, round(1 - levenshtein(name, typed) / greatest(length(name), length(typed))::DOUBLE, 6) AS "Confidence Score"
FROM l, r WHERE 1 - levenshtein(name, typed) / greatest(length(name), length(typed))::DOUBLE >= 0.8""")
def fuzzy_match(t):
    name = F.substring(F.md5(F.col("c_name").cast("binary")), 1, 14)
    left = t.customer.select("c_custkey", name.alias("name"))
    k = F.col("c_custkey") % 3
    n = F.col("name")
    typed = (
        F.when(k == 0, n)
        .when(k == 1, F.concat(F.substring(n, 1, 5), F.expr("substring(name, 7)")))
        .otherwise(F.concat(F.substring(n, 1, 3), F.lit("x"), F.expr("substring(name, 5)")))
    )
    right = left.select(F.col("c_custkey").alias("other"), typed.alias("typed"))
    df = fuzzy.fuzzy_match(left, right, "name", "typed", 0.8)
    return df.select("c_custkey", "other", F.round("Confidence Score", 6).alias("Confidence Score"))


@query("""SELECT name, nation, balance FROM (SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier)""")
def stack_match(t):
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), "c_mktsegment")
    b = t.supplier.select(F.col("s_acctbal").alias("Balance"), F.col("s_name").alias("Name"), F.col("s_nationkey").alias("Nation"))
    return sets.stack([a, b], "match")


@query("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def stack_all(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return sets.stack([a, b], "all")


@query("""SELECT c_custkey AS s_suppkey, c_name AS s_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def stack_by_position(t):
    return sets.stack_by_position([t.customer.select("c_custkey", "c_name", "c_acctbal"), t.supplier.select("s_suppkey", "s_name")], "match", master=2)


@query("""SELECT s_suppkey, c_custkey FROM supplier LEFT JOIN (SELECT unnest(r.a) AS s_suppkey, unnest(r.b) AS c_custkey FROM (
SELECT list_reduce(list({a: [s_suppkey], b: [c_custkey]} ORDER BY abs(s_acctbal - c_acctbal), s_acctbal, c_acctbal, s_suppkey, c_custkey),
lambda acc, x: CASE WHEN list_has_any(acc.a, x.a) OR list_has_any(acc.b, x.b) THEN acc ELSE {a: list_concat(acc.a, x.a), b: list_concat(acc.b, x.b)} END) AS r
FROM supplier JOIN customer ON s_nationkey = c_nationkey GROUP BY s_nationkey) g) p USING (s_suppkey)""")
def nearest_once(t):
    """Each supplier with the customer of its nation of the closest balance; every customer is taken once, the closest pair first."""
    suppliers, customers = t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal"), t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return joins.nearest_once(suppliers, customers, [("s_nationkey", "c_nationkey")], ("s_acctbal", "c_acctbal")).select("s_suppkey", "c_custkey")
