"""Queries on ties, limits, repeated keys and files or documents that differ."""

from pyspark.sql import functions as F

from tallyframe.functions.predicates import Rule, flag, rule_column
from tallyframe.operators import cleanse, filters, infer as inf, joins, semistructured as semi
from tallyframe.operators.aggregate import Agg
from tallyframe.operators.hierarchy import hierarchy
from tallyframe.operators.joins import On
from tallyframe.plans import compare, reconcile as rec
from tallyframe.plans.reconcile import Settings, Side
from tallyframe.session import scratch_path
from tallyframe.sources import readers
from tallyframe.types import cast_to

from .jobs import keyword_answer
from .registry import query

C = F.col


@query("""WITH a AS (SELECT o_orderkey, o_custkey, o_orderkey % 2000 AS cents FROM orders)
SELECT x.o_orderkey AS left_key, y.o_orderkey AS right_key FROM a x JOIN a y ON x.o_custkey = y.o_custkey AND abs(x.cents - y.cents) <= 1""")
def tolerance_join_cents(t):
    """Every cent on the grid, so that a bucket that disagrees with its test would lose pairs."""
    cents = (C("o_orderkey") % 2000 / 100).cast("double")
    a = t.orders.select(C("o_orderkey").alias("left_key"), C("o_custkey").alias("c"), cents.alias("a"))
    b = t.orders.select(C("o_orderkey").alias("right_key"), C("o_custkey").alias("d"), cents.alias("b"))
    return joins.tolerance_join(a, b, [("c", "d")], amount=("a", "b", 0.01)).select("left_key", "right_key")


@query("""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY lang, doc_id) <= (SELECT 5) THEN CASE WHEN contains(text, 'the') THEN 'english' ELSE 'other' END END AS "AI Answer" FROM documents""")
def infer_tied_order(t):
    """The order has ties; every row comes out once."""
    df = inf.infer(t.documents.select("doc_id", "lang", "text"), "{{text}}", keyword_answer, row_limit=5, order=[("lang", "asc")])
    return df.select("doc_id", "AI Answer")


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS HUGEINT)) AS cents, list_sort(list(o_orderstatus)) AS s FROM orders GROUP BY 1),
b AS (SELECT o_custkey AS k, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS HUGEINT) + CASE WHEN o_custkey % 5 = 1 THEN 500 ELSE 0 END) AS cents,
list_sort(list(CASE WHEN o_custkey % 3 = 0 AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END)) AS s FROM orders GROUP BY 1)
SELECT CAST(a.k AS VARCHAR) AS k, CASE WHEN a.cents <> b.cents OR a.s <> b.s THEN 'differs' WHEN a.n > 1 THEN 'repeated key' ELSE 'equal' END AS status,
concat_ws(', ', CASE WHEN a.cents <> b.cents THEN 'amount' END, CASE WHEN a.s <> b.s THEN 'state' END) AS differences FROM a JOIN b USING (k)""")
def compare_repeated_keys(t):
    """Several rows a key; a middle text that changes leaves the smallest and the largest one as they were."""
    a = t.orders.select(C("o_custkey").alias("k"), C("o_totalprice").alias("amount"), C("o_orderstatus").alias("state"))
    b = a.select(
        "k",
        (C("amount") + F.when(C("k") % 5 == 1, 5).otherwise(0)).alias("amount"),
        F.when((C("k") % 3 == 0) & (C("state") == "P"), "F").otherwise(C("state")).alias("state"),
    )
    return compare.compare_tables(a, b, ["k"], ["amount"], ["state"]).select("k", "status", "differences")


@query("""SELECT o_orderkey AS a_id, o_orderkey AS b_id, -(o_orderkey % 9) / 1000.0 AS amount_diff FROM orders WHERE o_orderkey % 9 <= 5""")
def reconcile_below_cents(t):
    """Differences of thousandths against a tolerance of five of them."""
    a = t.orders.select(C("o_orderkey").alias("doc"), C("o_orderdate").cast("date").alias("day"), (C("o_totalprice").cast("decimal(18,2)") + F.lit(0.004).cast("decimal(4,3)")).alias("amount"))
    b = a.withColumn("amount", C("amount") + (C("doc") % 9 / 1000).cast("decimal(4,3)"))
    side = Side("doc", "day", "amount", ["doc"])
    pairs = rec.match_lines(a, b, side, side, Settings(amount_tolerance=0.005, date_tolerance=0, materiality=1.0))
    return pairs.select("a_id", "b_id", F.round("amount_diff", 6).alias("amount_diff"))


CODES = "['12d', '3F', 'NaN', 'Infinity', '1e3', ' 7 ', '-.5', '0x1f']"


@query(f"""WITH v AS (SELECT o_orderkey, {CODES}[CAST(o_orderkey % 8 AS BIGINT) + 1] AS code FROM orders)
SELECT o_orderkey, CASE WHEN regexp_full_match(trim(code), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN CAST(trim(code) AS DOUBLE) END AS number,
CASE WHEN regexp_full_match(trim(code), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN CAST(trim(code) AS DOUBLE) END AS cleaned FROM v""")
def numbers_of_codes(t):
    """Codes that end like a Java number are text."""
    codes = F.element_at(F.array(*[F.lit(x) for x in ("12d", "3F", "NaN", "Infinity", "1e3", " 7 ", "-.5", "0x1f")]), (C("o_orderkey") % 8 + 1).cast("int"))
    df = t.orders.select("o_orderkey", codes.alias("code"))
    return df.select("o_orderkey", cast_to(C("code"), "number").alias("number"), cleanse.clean_number(C("code")).alias("cleaned"))


@query("""SELECT p_partkey, s_suppkey FROM part, supplier WHERE p_retailprice >= s_acctbal AND p_retailprice < s_acctbal + (s_suppkey % 7) * 10""")
def blend_interval(t):
    bands = t.supplier.select("s_suppkey", C("s_acctbal").alias("low"), (C("s_acctbal") + C("s_suppkey") % 7 * 10).alias("high"))
    found = joins.blend(t.part.select("p_partkey", "p_retailprice"), bands, [On("p_retailprice", "ge", "low"), On("p_retailprice", "lt", "high")])
    return found.select("p_partkey", "s_suppkey")


@query("""WITH m AS (SELECT p_partkey, s_suppkey FROM part, supplier WHERE p_retailprice >= s_acctbal AND p_retailprice <= s_acctbal + (s_suppkey % 7) * 10)
SELECT p_partkey, s_suppkey FROM m UNION ALL SELECT p_partkey, NULL FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM m)
UNION ALL SELECT NULL, s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM m)""")
def blend_interval_full(t):
    """The interval on the left side, with the rows of either side that have no partner."""
    bands = t.supplier.select("s_suppkey", C("s_acctbal").alias("low"), (C("s_acctbal") + C("s_suppkey") % 7 * 10).alias("high"))
    on = [On("low", "le", "p_retailprice"), On("high", "ge", "p_retailprice")]
    return joins.blend(bands, t.part.select("p_partkey", "p_retailprice"), on, "full").select("p_partkey", "s_suppkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 1 THEN o_orderkey END AS a, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS b FROM orders""")
def xml_extract_mixed(t):
    """Documents with different elements, no schema given."""
    a = F.when(C("o_orderkey") % 3 != 1, F.concat(F.lit("<a>"), C("o_orderkey").cast("string"), F.lit("</a>"))).otherwise("")
    b = F.when(C("o_orderkey") % 3 != 0, F.concat(F.lit("<b>"), "o_orderstatus", F.lit("</b>"))).otherwise("")
    df = t.orders.select("o_orderkey", F.concat(F.lit("<o>"), a, b, F.lit("</o>")).alias("xml"))
    return semi.xml_extract(df, "xml")


@query("""SELECT o_orderkey, o_orderkey % 3 AS kind FROM orders""")
def xml_to_json_mixed(t):
    a = F.when(C("o_orderkey") % 3 != 1, F.lit("<a>1</a>")).otherwise("")
    b = F.when(C("o_orderkey") % 3 != 0, F.lit("<b>x</b>")).otherwise("")
    df = t.orders.select("o_orderkey", F.concat(F.lit("<o>"), a, b, F.lit("<c>0</c></o>")).alias("xml"))
    json = semi.xml_to_json(df, "xml", "json")
    # which elements are there tells the document's kind again
    has = lambda name: F.get_json_object("json", f"$.{name}").isNotNull()
    return json.select("o_orderkey", F.when(has("a") & has("b"), 2).when(has("b"), 1).otherwise(0).cast("bigint").alias("kind"))


@query("""SELECT o_orderkey AS id, o_orderstatus || chr(10) || 'second line' AS note, CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS price FROM orders""")
def read_delimited_by_name(t):
    """Files of one folder with their columns in another order, one column in some files only, and line breaks in quotes."""
    path = scratch_path(t.spark, "by-name")
    note = F.concat("o_orderstatus", F.lit("\nsecond line")).alias("note")
    options = {"header": "true", "quoteAll": "true", "escape": "\\"}
    t.orders.filter("o_orderkey % 2 = 1").select(C("o_orderkey").alias("id"), note, C("o_totalprice").alias("price")).write.options(**options).csv(path)
    t.orders.filter("o_orderkey % 2 = 0").select(note, C("o_orderkey").alias("id")).write.mode("append").options(**options).csv(path)
    return readers.read_delimited(t.spark, path, multiline=True, types={"id": "integer", "price": "number"}).select("id", "note", "price")


@query("""SELECT s_suppkey, r_name, lo FROM supplier, (SELECT r_name, CASE WHEN r_regionkey = 0 THEN '-Infinity'::DOUBLE ELSE r_regionkey * 2500.0 END AS lo,
CASE WHEN r_regionkey = 3 THEN 'Infinity'::DOUBLE ELSE r_regionkey * 2500.0 + 1000 END AS hi FROM region) WHERE s_acctbal >= lo AND s_acctbal < hi""")
def blend_interval_open(t):
    """Limits of which one has no lower and one no upper end."""
    low, high = C("r_regionkey") * 2500.0, C("r_regionkey") * 2500.0 + 1000
    limits = t.region.select(
        "r_name", F.when(C("r_regionkey") == 0, float("-inf")).otherwise(low).alias("lo"), F.when(C("r_regionkey") == 3, float("inf")).otherwise(high).alias("hi")
    )
    return joins.blend(t.supplier, limits, [On("s_acctbal", "ge", "lo"), On("s_acctbal", "lt", "hi")]).select("s_suppkey", "r_name", "lo")


@query("""SELECT s_suppkey, c_custkey FROM supplier, customer WHERE s_acctbal > c_acctbal + 9000 AND s_nationkey < c_nationkey""")
def blend_two_inequalities(t):
    """Two inequalities on different columns."""
    richer = t.customer.select("c_custkey", "c_nationkey", (C("c_acctbal") + 9000).alias("limit"))
    joined = joins.blend(t.supplier, richer, [On("s_acctbal", "gt", "limit"), On("s_nationkey", "lt", "c_nationkey")])
    return joined.select("s_suppkey", "c_custkey")


@query("""SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.value * 600 > o.o_totalprice AND e.user_id > o.o_custkey)""")
def blend_two_inequalities_unmatched(t):
    """Rows that no row of the other table exceeds in both columns."""
    events = t.events.select((C("value") * 600).alias("limit"), "user_id")
    return joins.anti(t.orders.select("o_orderkey", "o_totalprice", "o_custkey"), events, [On("o_totalprice", "lt", "limit"), On("o_custkey", "lt", "user_id")]).select("o_orderkey")


@query("""SELECT o_orderkey AS id, o_orderstatus || chr(10) || 'said "' || o_orderpriority || '"' || chr(10) || 'end' AS note, o_totalprice AS price FROM orders""")
def read_delimited_one_file(t):
    """A single file, cut into many splits wherever its bytes fall, with line breaks and quotes in cells and in a column's name."""
    path = scratch_path(t.spark, "one-file")
    note = F.concat("o_orderstatus", F.lit('\nsaid "'), "o_orderpriority", F.lit('"\nend'))
    rows = t.orders.select(C("o_orderkey").alias("id"), note.alias("the\nnote"), C("o_totalprice").alias("price"))
    rows.coalesce(1).write.options(header="true", quoteAll="true", escape="\\").csv(path)
    df = readers.read_delimited(t.spark, path, multiline=True, types={"id": "integer", "price": "number"})
    return df.select("id", C("the\nnote").alias("note"), "price")


AS_OF = "DATE '1995-03-31'"


@query(f"""SELECT o_orderkey FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders) WHERE d = {AS_OF} - 1 OR d = {AS_OF} + 1 OR d = {AS_OF} - 7
OR d = {AS_OF} - INTERVAL 1 MONTH OR d = {AS_OF} + INTERVAL 1 MONTH OR d = {AS_OF} - INTERVAL 1 YEAR OR d = {AS_OF} + INTERVAL 1 YEAR
OR d < {AS_OF} - INTERVAL 2 YEAR AND d >= {AS_OF} - INTERVAL 30 MONTH OR d > {AS_OF} + INTERVAL 1 YEAR AND d < {AS_OF} + INTERVAL 14 MONTH""")
def filter_named_dates(t):
    """Named and counted relative dates as points, at the end of a long month."""
    named = ["TOMORROW", "THE_LAST_WEEK", "THE_LAST_MONTH", "THE_NEXT_MONTH", "THE_LAST_YEAR", "THE_NEXT_YEAR"]
    rules = [Rule("d", "IS", date_operator="YESTERDAY"), *[Rule("d", "IS", date_operator=n, connector="OR") for n in named]]
    rules += [
        Rule("d", "IS_BEFORE", "2", date_operator="_YEARS_AGO", connector="OR"),
        Rule("d", "IS_ON_OR_AFTER", "30", date_operator="_MONTHS_AGO"),
        Rule("d", "IS_AFTER", "1", date_operator="_YEARS_FROM_NOW", connector="OR"),
        Rule("d", "IS_BEFORE", "14", date_operator="_MONTHS_FROM_NOW"),
    ]
    return filters.filter_rules(t.orders.select("o_orderkey", C("o_orderdate").cast("date").alias("d")), rules, as_of="1995-03-31").select("o_orderkey")


@query("""WITH e AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_name END AS name, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal > 0 END AS rich FROM customer)
SELECT c_custkey, CASE WHEN name IS NOT NULL AND trim(name) <> '' THEN 1 ELSE 0 END AS filled, CASE WHEN rich IS NOT TRUE THEN 1 ELSE 0 END AS not_true, CASE WHEN rich IS FALSE THEN 1 ELSE 0 END AS is_false FROM e
WHERE name IS NOT NULL AND trim(name) <> '' OR coalesce(NOT rich, true)""")
def filter_negated_tests(t):
    k = C("c_custkey")
    df = t.customer.select("c_custkey", F.when(k % 4 == 1, "").when(k % 4 > 1, C("c_name")).alias("name"), F.when(k % 3 > 0, C("c_acctbal") > 0).alias("rich"))
    kept = filters.filter_rules(df, [Rule("name", "NOT IS_EMPTY"), Rule("rich", "IS NOT TRUE", connector="OR")])
    test = lambda name, op: flag(rule_column(df, Rule(name, op)))
    return kept.select("c_custkey", test("name", "NOT IS_EMPTY").alias("filled"), test("rich", "IS NOT TRUE").alias("not_true"), test("rich", "IS FALSE").alias("is_false"))


@query("""WITH RECURSIVE c AS (SELECT c_custkey AS id, CASE WHEN c_custkey > 0 THEN c_custkey // 10 END AS parent, c_acctbal, c_mktsegment FROM customer),
chain AS (SELECT id AS start, id, parent, c_acctbal, c_mktsegment, 0 AS depth FROM c
UNION ALL SELECT chain.start, c.id, c.parent, c.c_acctbal, c.c_mktsegment, depth + 1 FROM chain JOIN c ON chain.parent = c.id),
first AS (SELECT start, c_mktsegment, min(depth) AS d FROM chain GROUP BY 1, 2)
SELECT v.start AS id, v.spread, f.segments FROM (SELECT start, round(var_samp(c_acctbal), 2) AS spread FROM chain GROUP BY 1) v
JOIN (SELECT start, string_agg(c_mktsegment, '/' ORDER BY d) AS segments FROM first GROUP BY 1) f USING (start)""")
def hierarchy_spread(t):
    df = t.customer.select(C("c_custkey").alias("id"), F.when(C("c_custkey") > 0, F.floor(C("c_custkey") / 10)).alias("parent"), "c_acctbal", "c_mktsegment")
    out = hierarchy(df, "id", "parent", [Agg("VAR", "c_acctbal", "spread"), Agg("JOIN_STR_DISTINCT", "c_mktsegment", "segments", delimiter="/")])
    return out.select("id", F.round("spread", 2).alias("spread"), "segments")
