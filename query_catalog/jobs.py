"""Whole jobs: scoring and service steps, profiling, reconciliation, comparison, reports."""

import pandas as pd
from pyspark.sql import functions as F

from tallyframe.functions.dates import time_period
from tallyframe.functions.predicates import Rule
from tallyframe.operators import dedupe, infer as inf, joins
from tallyframe.operators.aggregate import Agg, summarize
from tallyframe.operators.filters import filter_rules, split_filter
from tallyframe.operators.joins import On
from tallyframe.operators.sets import stack
from tallyframe.operators.windows import window
from tallyframe.plans import compare, profile, reconcile as rec, relationships, reports
from tallyframe.plans.reconcile import Settings, Side

from .registry import query

C = F.col


def keyword_answer(prompts: pd.Series) -> pd.Series:
    """A local stand-in for a scoring service."""
    found = prompts.str.contains("the", regex=False)
    return found.map({True: "english", False: "other"})


def keyword_json(prompts: pd.Series) -> pd.Series:
    size = prompts.str.len()
    return '{"size": ' + size.astype(str) + ', "kind": {"long": ' + (size > 500).map({True: "true", False: "false"}) + "}}"


def page_links(pages: pd.DataFrame) -> pd.DataFrame:
    """Links of web pages, one row each."""
    links = pages.assign(link=pages["html"].str.findall(r'href="([^"]*)"')).explode("link")
    return links.dropna(subset=["link"])[["page_id", "link"]]


def echo(url: str, method: str, body: str | None) -> tuple[int, str]:
    """A local stand-in for a web service."""
    if url.endswith("/0"):
        raise ConnectionError("no such customer")
    return 200, '{"verb": "%s", "path": "%s", "size": %d}' % (method, url.split("//")[1], len(body or ""))


@query("SELECT doc_id, CASE WHEN contains('Language of: ' || text || ' (' || source || ')', 'the') THEN 'english' ELSE 'other' END AS \"AI Answer\" FROM documents")
def infer(t):
    df = inf.infer(t.documents, "Language of: {{text}} ({{ source }})", keyword_answer, row_limit=None)
    return df.select("doc_id", "AI Answer")


@query("""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY n_chars DESC, doc_id) <= 1000 THEN CASE WHEN contains(text, 'the') THEN 'english' ELSE 'other' END END AS "AI Answer" FROM documents""")
def infer_default_row_limit(t):
    df = inf.infer(t.documents.select("doc_id", "n_chars", "text"), "{{text}}", keyword_answer, row_limit=1000, order=[("n_chars", "dsc"), ("doc_id", "asc")])
    return df.select("doc_id", "AI Answer")


@query("SELECT doc_id, CAST(length(text) + 2 AS BIGINT) AS size, length(text) + 2 > 500 AS \"kind.long\" FROM documents")
def infer_json(t):
    df = inf.infer_json(t.documents.select("doc_id", "text"), "[{{text}}]", keyword_json, "size bigint, kind struct<long: boolean>", row_limit=None)
    return df.select("doc_id", "size", C("`kind.long`"))


@query("SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS link FROM pages")
def extract_documents(t):
    return inf.extract_documents(t.pages.select("page_id", "html"), page_links, "page_id bigint, link string")


@query("""SELECT c_custkey, 'https://service.invalid/' || c_mktsegment || '/' || c_custkey AS "Request URL", 'POST' AS "Request Method", '{"name": "' || c_name || '"}' AS "Request Body" FROM customer""")
def build_requests(t):
    df = inf.build_requests(t.customer, "https://service.invalid/{{c_mktsegment}}/{{c_custkey}}", "post", '{"name": "{{c_name}}"}')
    return df.select("c_custkey", "Request URL", "Request Method", "Request Body")


@query("""SELECT c_custkey, CASE WHEN c_custkey = 0 THEN NULL ELSE 'GET' END AS verb, CASE WHEN c_custkey = 0 THEN NULL ELSE 'service.invalid/' || c_custkey END AS path,
CAST(CASE WHEN c_custkey = 0 THEN 0 ELSE 200 END AS INTEGER) AS status FROM customer""")
def call_api(t):
    df = inf.call_api(t.customer.select("c_custkey"), "https://service.invalid/{{c_custkey}}", echo, result="JSON", schema="verb string, path string, size int")
    return df.select("c_custkey", "verb", "path", C("Response Status").alias("status"))


def _column_profile(name: str, kind: str, position: int, table: str) -> str:
    return f"""SELECT {position} AS position, '{name}' AS name, '{kind}' AS "dataType",
(SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT trim(CAST({name} AS VARCHAR)) AS v FROM {table} WHERE trim(CAST({name} AS VARCHAR)) <> '' ORDER BY v LIMIT 5) s) AS samples,
count(CASE WHEN trim(CAST({name} AS VARCHAR)) <> '' THEN 1 END) AS "nonEmptyCount", count(DISTINCT CASE WHEN trim(CAST({name} AS VARCHAR)) <> '' THEN trim(CAST({name} AS VARCHAR)) END) AS "distinctCount" FROM {table}"""


PROFILED = """(SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN '0' || c_custkey ELSE ' ' END AS code,
CAST(c_nationkey AS VARCHAR) || '.5' AS rate FROM customer) AS p"""


def _profiled(t):
    code = F.when(C("c_acctbal") >= 0, F.concat(F.lit("0"), C("c_custkey").cast("string"))).otherwise(" ")
    return t.customer.withColumn("code", code).withColumn("rate", F.concat(C("c_nationkey").cast("string"), F.lit(".5")))


@query(" UNION ALL ".join(
    _column_profile(name, kind, i, PROFILED)
    for i, (name, kind) in enumerate(
        [("c_custkey", "integer"), ("c_name", "string"), ("c_nationkey", "integer"), ("c_acctbal", "number"), ("c_mktsegment", "string"), ("code", "integer"), ("rate", "number")]
    )
))
def profile_table(t):
    df = profile.profile_table(_profiled(t))
    return df.withColumn("samples", F.array_join("sampleValues", "|")).drop("sampleValues")


@query("""SELECT * FROM (VALUES ('c_custkey', 'integer'), ('c_name', 'string'), ('c_nationkey', 'integer'), ('c_acctbal', 'number'), ('c_mktsegment', 'string'), ('rate', 'number')) v(name, "dataType")
UNION ALL SELECT 'code', CASE WHEN max(c_acctbal) >= 0 THEN 'integer' ELSE 'string' END FROM customer""")
def infer_types(t):
    found = profile.infer_types(_profiled(t).select([C(c).cast("string").alias(c) for c in _profiled(t).columns]))
    return t.spark.createDataFrame(list(found.items()), "name string, dataType string")


@query("""SELECT name, "dataType", name AS "mappedFrom", false AS required FROM (VALUES ('o_orderkey', 'integer'), ('o_orderdate', 'datetime'), ('o_orderpriority', 'string'), ('o_totalprice', 'number')) v(name, "dataType")
UNION ALL SELECT 'order_date', 'date', 'order_date', false""")
def expected_schema(t):
    text = F.date_format("o_orderdate", "M/d/yyyy")
    df = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice", text.alias("order_date"))
    return profile.expected_schema(profile.profile_table(df, approximate=True), profile.date_candidates(df))


@query("""SELECT 'order_date' AS "column", 'string' AS "observedDataType", 'date' AS "expectedDataType", true AS "needsAdapter", 'text' AS evidence,
count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS "dateCount", count(*) AS "nonEmptyCount" FROM orders HAVING count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) >= 0.6 * count(*)
UNION ALL SELECT 'ship_dt', 'string', 'datetime', true, 'serial', count(*), count(*) FROM orders
UNION ALL SELECT 'o_orderdate', 'datetime', 'datetime', false, 'typed', count(*), count(*) FROM orders""")
def date_candidates(t):
    text = F.when(C("o_orderstatus") == "P", "pending").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    serial = F.datediff(C("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date")).cast("string")
    df = t.orders.select("o_orderkey", "o_orderdate", text.alias("order_date"), F.concat(serial, F.lit(".25")).alias("ship_dt"), text.alias("remark"))
    return profile.date_candidates(df)


@query("""WITH n AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders)
SELECT 'Order No' AS "column", 1.0::DOUBLE AS score, n AS "nonEmptyCount", n AS "distinctCount" FROM n
UNION ALL SELECT 'Customer ID', least(1, round(0.65 * customers / n + 0.6, 3))::DOUBLE, n, customers FROM n""")
def key_candidates(t):
    df = t.orders.select(C("o_orderkey").alias("Order No"), C("o_custkey").alias("Customer ID"), C("o_totalprice").alias("Total Amount"), C("o_orderpriority").alias("Priority"))
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return profile.key_candidates(profile.profile_table(df), rows)


def _related(t):
    customers = t.customer.select(C("c_custkey").alias("Customer ID"), C("c_name").alias("Customer Ref"), "c_mktsegment")
    orders = t.orders.select(C("o_orderkey").alias("Order ID"), C("o_custkey").alias("customer_id"), C("o_custkey").alias("Buyer ID"), "o_totalprice")
    padded = F.lpad(C("c_custkey").cast("string"), 9, "0")
    cards = t.customer.select(padded.alias("Card No"), F.upper(F.replace("c_name", F.lit("#"), F.lit("-"))).alias("Holder Ref"))
    return {"customers": customers, "orders": orders, "cards": cards}


@query("""WITH c AS (SELECT count(*) AS n FROM customer), o AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS keys, count(DISTINCT o_custkey) AS customers FROM orders),
k AS (SELECT count(*) AS shared FROM customer WHERE c_custkey IN (SELECT o_orderkey FROM orders))
SELECT 'customers' AS "leftSource", 'orders' AS "rightSource", 'Customer ID' AS "leftColumn", 'Buyer ID' AS "rightColumn", 'exact' AS "matchStrategy", o.customers AS "overlapCount", 1.0::DOUBLE AS "uniqueRatioLeft",
round(o.customers / o.n, 4)::DOUBLE AS "uniqueRatioRight" FROM o, c
UNION ALL SELECT 'customers', 'orders', 'Customer ID', 'Order ID', 'exact', shared, 1.0, 1.0 FROM k
UNION ALL SELECT 'customers', 'orders', 'Customer ID', 'customer_id', 'exact', o.customers, 1.0, round(o.customers / o.n, 4) FROM o
UNION ALL SELECT 'customers', 'cards', 'Customer Ref', 'Card No', 'trailing_digits', c.n, 1.0, 1.0 FROM c
UNION ALL SELECT 'customers', 'cards', 'Customer Ref', 'Holder Ref', 'alphanumeric', c.n, 1.0, 1.0 FROM c""")
def join_candidates(t):
    found = relationships.join_candidates(_related(t))
    return found.select("leftSource", "rightSource", "leftColumn", "rightColumn", "matchStrategy", "overlapCount", "uniqueRatioLeft", "uniqueRatioRight")


@query("""SELECT 'customers' AS "leftSource", 'orders' AS "rightSource", 'Customer ID' AS "leftColumn", 'customer_id' AS "rightColumn", 'suggested' AS "use" WHERE (SELECT count(DISTINCT o_custkey) FROM orders) >= 0.95 * (SELECT count(*) FROM customer)
UNION ALL SELECT 'customers', 'orders', 'Customer ID', 'Buyer ID', 'suggested' WHERE (SELECT count(DISTINCT o_custkey) FROM orders) >= 0.95 * (SELECT count(*) FROM customer)
UNION ALL SELECT 'customers', 'orders', 'Customer ID', 'Order ID', 'review' FROM customer WHERE c_custkey IN (SELECT o_orderkey FROM orders) HAVING count(*) >= 2
UNION ALL SELECT 'customers', 'cards', 'Customer Ref', 'Card No', 'review'
UNION ALL SELECT 'customers', 'cards', 'Customer Ref', 'Holder Ref', 'suggested'""")
def join_review_split(t):
    split = relationships.review_split(relationships.join_candidates(_related(t)))
    return split.select("leftSource", "rightSource", "leftColumn", "rightColumn", "use")


@query("""SELECT 'Customer Ref' AS "leftColumn", 'Card No' AS "rightColumn", 'Customer Ref Digits' AS "leftJoinField", 'Card No' AS "rightJoinField", count(*) AS "overlapCount" FROM customer""")
def derived_key_hint(t):
    tables = _related(t)
    found = relationships.join_candidates({"customers": tables["customers"].select("Customer Ref"), "cards": tables["cards"].select("Card No")})
    return relationships.derived_key_hints(found).select("leftColumn", "rightColumn", "leftJoinField", "rightJoinField", "overlapCount")


@query("""WITH r AS (SELECT o_orderkey AS row, o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AS head, CASE WHEN o_orderpriority = '5-LOW' THEN 0.75 ELSE 1.0 END AS share FROM orders),
n AS (SELECT row, head, lead(share, 1) OVER w AS a, lead(share, 2) OVER w AS b, lead(share, 3) OVER w AS c FROM r WINDOW w AS (ORDER BY row))
SELECT row, round(CAST(1.4 + 2 + 1.5 + 1.5 * (a + coalesce(b, 0) + coalesce(c, 0)) / (1 + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT) AS DOUBLE), 6) AS score FROM n WHERE head AND a IS NOT NULL""")
def embedded_headers(t):
    head = (C("o_orderstatus") == "P") & (C("o_orderpriority") == "1-URGENT")
    pick = lambda label, value: F.when(head, label).otherwise(value)
    df = t.orders.select(
        C("o_orderkey").alias("row"),
        pick("Order ID", C("o_orderkey").cast("string")).alias("c1"),
        pick("Order Date", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("c2"),
        pick("Status", F.when(C("o_orderpriority") == "5-LOW", " ").otherwise(C("o_orderstatus"))).alias("c3"),
        pick("Total Amount", C("o_totalprice").cast("string")).alias("c4"),
    )
    return profile.embedded_headers(df, "row")


@query("""WITH k AS (SELECT CASE WHEN c_acctbal < 0 THEN ' ' WHEN c_mktsegment = 'BUILDING' THEN lower(c_name) ELSE c_name || ' ' END AS name, '00' || c_nationkey AS code,
CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS segment FROM customer)
SELECT 'blank key' AS trap, 'name' AS "column", count(*) AS rows FROM k WHERE trim(name) = '' UNION ALL SELECT 'untrimmed key', 'name', count(*) FROM k WHERE name <> trim(name)
UNION ALL SELECT 'mixed-case key', 'name', count(*) FROM k WHERE name <> upper(name) UNION ALL SELECT 'leading zeros', 'code', count(*) FROM k
UNION ALL SELECT 'null in not-equal test', 'segment', count(*) FROM k WHERE segment IS NULL
UNION ALL SELECT 'duplicate key', 'name+code', CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM k GROUP BY name, code HAVING count(*) > 1) d""")
def trap_report(t):
    name = F.when(C("c_acctbal") < 0, " ").when(C("c_mktsegment") == "BUILDING", F.lower("c_name")).otherwise(F.concat("c_name", F.lit(" ")))
    df = t.customer.select(
        name.alias("name"),
        F.concat(F.lit("00"), C("c_nationkey").cast("string")).alias("code"),
        F.when(C("c_mktsegment") != "MACHINERY", C("c_mktsegment")).alias("segment"),
    )
    return profile.trap_report(df, ["name", "code"], ["segment"])


# side B: a copy of the orders with some dropped, late, off by a cent or more, and some added
LEDGER_B = """(SELECT CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN o_orderkey + 100000000 ELSE o_orderkey END AS doc,
o_orderdate::DATE + CASE o_orderpriority WHEN '2-HIGH' THEN 3 ELSE 0 END AS day, CAST(round(o_totalprice * 100) AS BIGINT)
+ CASE WHEN o_orderpriority = '3-MEDIUM' THEN CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 500 END ELSE 0 END AS cents
FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'))"""
LEDGER_A = "(SELECT o_orderkey AS doc, o_orderdate::DATE AS day, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderstatus, o_orderpriority FROM orders)"
BUSINESS = "(5 * (({0} - DATE '1970-01-05') // 7) + least(isodow({0}) - 1, 4))"
PAIRS = f"""(SELECT a.doc AS a_doc, b.doc AS b_doc, abs({BUSINESS.format('a.day')} - {BUSINESS.format('b.day')}) AS day_gap, (a.cents - b.cents) / 100 AS amount_diff FROM {LEDGER_A} a JOIN {LEDGER_B} b ON a.doc = b.doc
WHERE abs(a.cents - b.cents) <= 1 AND abs({BUSINESS.format('a.day')} - {BUSINESS.format('b.day')}) <= 3)"""
ITEMS = f"""(SELECT a.doc AS a_id, b.doc AS b_id, a.day AS a_date, b.day AS b_date, a.cents / 100 AS a_amount, b.cents / 100 AS b_amount,
CASE WHEN p.a_doc IS NOT NULL THEN 'Both' WHEN a.doc IS NOT NULL THEN 'Side A' ELSE 'Side B' END AS source
FROM {LEDGER_A} a LEFT JOIN {PAIRS} p ON a.doc = p.a_doc FULL JOIN {LEDGER_B} b ON p.b_doc = b.doc)"""
IN_A, IN_B = "a_date BETWEEN DATE '1992-01-01' AND DATE '1998-06-30'", "b_date BETWEEN DATE '1992-01-01' AND DATE '1998-06-30'"
CLASSIFIED = f"""(SELECT *, CASE WHEN source = 'Both' AND a_date = b_date THEN 'Reconciled'
WHEN source = 'Both' AND (({IN_A}) AND b_date > DATE '1998-06-30' OR ({IN_B}) AND a_date > DATE '1998-06-30') THEN 'Timing - Crosses period'
WHEN source = 'Both' AND ({IN_A}) AND ({IN_B}) THEN 'Timing - Clears in period' WHEN source = 'Both' THEN 'Reconciled'
WHEN coalesce(a_amount, b_amount) < 20000 THEN 'Adjustment needed'
WHEN coalesce(a_amount, b_amount) > 150000 OR aging_days > 90 THEN 'Escalate' ELSE 'Investigate' END AS status
FROM (SELECT *, greatest(DATE '1998-06-30' - coalesce(least(a_date, b_date), a_date, b_date), 0) AS aging_days FROM {ITEMS} i) i)"""
CATEGORIZED = f"""(SELECT *, CASE WHEN status = 'Reconciled' THEN 'Reconciled' WHEN status LIKE 'Timing%' THEN 'Timing' WHEN status = 'Adjustment needed' THEN 'Adjustment' ELSE 'Investigation' END AS category,
CASE WHEN aging_days <= 30 THEN '0-30' WHEN aging_days <= 60 THEN '31-60' WHEN aging_days <= 90 THEN '61-90' ELSE '90+' END AS aging_bucket FROM {CLASSIFIED} c)"""
SETTINGS = Settings(amount_tolerance=0.01, date_tolerance=3, materiality=150_000)


def _ledgers(t):
    a = t.orders.select(C("o_orderkey").alias("doc"), C("o_orderdate").cast("date").alias("day"), C("o_totalprice").alias("amount"), "o_custkey", "o_orderpriority")
    status, priority = C("o_orderstatus"), C("o_orderpriority")
    cents = F.when(priority != "3-MEDIUM", 0).when(status == "F", 1).when(status == "O", -1).otherwise(500)
    b = t.orders.filter(~((status == "P") & (priority == "1-URGENT"))).select(
        F.when((status == "F") & (priority == "5-LOW"), C("o_orderkey") + 100000000).otherwise(C("o_orderkey")).alias("doc"),
        F.date_add(C("o_orderdate").cast("date"), F.when(priority == "2-HIGH", 3).otherwise(0)).alias("day"),
        ((F.round(C("o_totalprice") * 100) + cents) / 100).alias("amount"),
        "o_custkey",
    )
    return a, b


def _side(*keys: str, **more: str) -> Side:
    return Side("doc", "day", "amount", list(keys), **more)


def _items(t):
    a, b = _ledgers(t)
    items = rec.reconcile(a, b, _side("doc", reference="doc", counterparty="o_custkey"), _side("doc", reference="doc", counterparty="o_custkey"), SETTINGS)
    return rec.classify(items, "1992-01-01", "1998-06-30", SETTINGS, supported=F.coalesce("a_amount", "b_amount") < 20000)


@query(f"SELECT a_doc AS a_id, b_doc AS b_id, day_gap, amount_diff FROM {PAIRS} p")
def reconcile_by_document(t):
    a, b = _ledgers(t)
    return rec.match_lines(a, b, _side("doc"), _side("doc"), SETTINGS)


# the closest pair of a customer first, each line once: a fold over the pairs in their order
CANDIDATES = f"""(SELECT o_custkey, {{a: [a.doc], b: [b.doc], gap: [abs({BUSINESS.format('a.day')} - {BUSINESS.format('b.day')})], diff: [a.cents - b.cents]}} AS pair,
abs({BUSINESS.format('a.day')} - {BUSINESS.format('b.day')}) AS gap, abs(a.cents - b.cents) AS diff, {BUSINESS.format('a.day')} AS a_day, a.cents AS a_cents, {BUSINESS.format('b.day')} AS b_day, b.cents AS b_cents, a.doc AS a_doc, b.doc AS b_doc
FROM {LEDGER_A} a JOIN orders o ON o.o_orderkey = a.doc JOIN (SELECT l.*, q.o_custkey AS b_cust FROM {LEDGER_B} l JOIN orders q ON q.o_orderkey = l.doc % 100000000) b ON o.o_custkey = b_cust
WHERE abs(a.cents - b.cents) <= 5000 AND abs({BUSINESS.format('a.day')} - {BUSINESS.format('b.day')}) <= 5)"""
GREEDY = f"""(SELECT list_reduce(list(pair ORDER BY gap, diff, a_day, a_cents, b_day, b_cents, a_doc, b_doc), lambda acc, x: CASE WHEN list_has_any(acc.a, x.a) OR list_has_any(acc.b, x.b) THEN acc
ELSE {{a: list_concat(acc.a, x.a), b: list_concat(acc.b, x.b), gap: list_concat(acc.gap, x.gap), diff: list_concat(acc.diff, x.diff)}} END) AS r FROM {CANDIDATES} c GROUP BY o_custkey)"""


@query(f"SELECT unnest(r.a) AS a_id, unnest(r.b) AS b_id, unnest(r.gap) AS day_gap, unnest(r.diff) / 100 AS amount_diff FROM {GREEDY} g")
def reconcile_by_customer(t):
    a, b = _ledgers(t)
    return rec.match_lines(a, b, _side("o_custkey"), _side("o_custkey"), Settings(amount_tolerance=50, date_tolerance=5, materiality=150_000))


@query("""SELECT o_orderkey AS a_id, o_orderkey AS b_id, CASE WHEN o_orderkey % 3 = 0 THEN 'Adjustment needed' ELSE 'Reconciled' END AS status, o_orderkey % 3 = 0 AS fx_difference,
CASE WHEN o_orderkey % 3 = 0 THEN round(2 * o_totalprice, 2) - round(3 * o_totalprice, 2) ELSE 0 END AS amount_diff FROM orders""")
def reconcile_fx_difference(t):
    """Both companies booked the same amounts in euros, a third of them at different rates."""
    euros = C("o_totalprice").alias("euros")
    at = lambda rate: F.round(C("o_totalprice") * rate, 2).alias("amount")
    base = t.orders.withColumn("currency", F.lit("EUR"))
    common = [C("o_orderkey").alias("doc"), C("o_orderdate").cast("date").alias("day"), "currency", euros]
    a = base.select(*common, at(F.lit(2)))
    b = base.select(*common, at(F.when(C("o_orderkey") % 3 == 0, 3).otherwise(2)))
    side = Side("doc", "day", "amount", ["doc"], currency="currency", foreign="euros")
    exact = Settings(amount_tolerance=0.01, date_tolerance=0, materiality=150_000)
    items = rec.classify(rec.reconcile(a, b, side, side, exact), "1992-01-01", "1998-12-31", exact)
    return items.select("a_id", "b_id", "status", "fx_difference", F.round("amount_diff", 4).alias("amount_diff"))


@query(f"""WITH e AS (SELECT event_id, event_type, {BUSINESS.format('ts::DATE')} AS bd, CAST(round(value * 100) AS BIGINT) // 1000 AS tens FROM events),
a AS (SELECT *, row_number() OVER (PARTITION BY event_type, bd, tens ORDER BY event_id) AS r FROM e),
b AS (SELECT event_id, event_type, bd, tens, row_number() OVER (PARTITION BY event_type, bd, tens ORDER BY event_id) AS r FROM (SELECT event_id, event_type, bd, tens - 1 AS tens FROM e) x)
SELECT a.event_id AS a_id, b.event_id AS b_id FROM a JOIN b USING (event_type, bd, tens, r)""")
def reconcile_repeated_lines(t):
    tens = F.floor(F.round(C("value") * 100) / 1000).cast("double")
    a = t.events.select(C("event_id").alias("doc"), C("ts").alias("day"), tens.alias("amount"), "event_type")
    b = a.withColumn("amount", C("amount") - 1)
    exact = Settings(amount_tolerance=0, date_tolerance=0, materiality=0)
    return rec.match_lines(a, b, _side("event_type"), _side("event_type"), exact).select("a_id", "b_id")


@query(f"SELECT a_id, b_id, source, status, category, CAST(aging_days AS INTEGER) AS aging_days, aging_bucket, coalesce(a_amount, b_amount) > 150000 AS material FROM {CATEGORIZED} c")
def reconcile_classify(t):
    return _items(t).select("a_id", "b_id", "source", "status", "category", "aging_days", "aging_bucket", "material")


@query(f"""SELECT a_id, b_id, CASE WHEN NOT open THEN NULL WHEN amount > 50000 THEN 'Controller review' WHEN amount > 10000 THEN 'Supervisor review' END AS amount_escalation,
CASE WHEN NOT open THEN NULL WHEN aging_days > 90 THEN 'Controller or management review' WHEN aging_days > 60 THEN 'Supervisor follow-up' END AS age_escalation,
CASE WHEN (SELECT sum(abs(coalesce(a_amount, b_amount))) FROM {CATEGORIZED} c WHERE category <> 'Reconciled') > 100000 THEN 'Controller review' END AS total_escalation
FROM (SELECT *, category IN ('Adjustment', 'Investigation') AS open, abs(coalesce(a_amount, b_amount)) AS amount FROM {CATEGORIZED} c) x""")
def reconcile_escalation(t):
    return rec.escalation(_items(t)).select("a_id", "b_id", "amount_escalation", "age_escalation", "total_escalation")


@query(f"""WITH c AS (SELECT *, coalesce(a_amount, 0) AS a, coalesce(b_amount, 0) AS b, category <> 'Investigation' AS ok FROM {CATEGORIZED} x),
s AS (SELECT sum(a) AS a, sum(b) AS b, sum(CASE WHEN source = 'Side B' AND ok THEN b ELSE 0 END) AS to_a, sum(CASE WHEN source = 'Both' THEN a - b WHEN source = 'Side A' AND ok THEN a ELSE 0 END) AS to_b,
count(CASE WHEN source = 'Both' THEN 1 END) AS m, count(CASE WHEN category IN ('Adjustment', 'Investigation') THEN 1 END) AS act,
sum(CASE WHEN category <> 'Reconciled' THEN abs(coalesce(a_amount, b_amount)) ELSE 0 END) AS tot, sum(CASE WHEN source = 'Both' THEN 2 ELSE 1 END) AS n FROM c)
SELECT round(a, 2) AS side_a_balance, round(b, 2) AS side_b_balance, round(a + to_a, 2) AS side_a_adjusted, round(b + to_b, 2) AS side_b_adjusted, round(a + to_a - b - to_b, 2) AS unexplained_difference,
m AS matched_count, round(200 * m / n, 2) AS match_rate, CASE WHEN 200 * m / n >= 95 THEN 'green' WHEN 200 * m / n >= 85 THEN 'amber' ELSE 'red' END AS match_rate_status, act AS items_needing_action, round(tot, 2) AS total_reconciling FROM s""")
def reconcile_summary(t):
    return rec.recon_summary(_items(t))


@query(f"""SELECT row_number() OVER (ORDER BY source, a_id NULLS FIRST, b_id NULLS FIRST) AS "Item #", source AS "Source", a_date AS "Side A Date", b_date AS "Side B Date",
CAST(coalesce(a_id, b_id) AS VARCHAR) AS "Document / Reference #", round(coalesce(a_amount, 0) - coalesce(b_amount, 0), 2) AS "Variance", status AS "Status",
CASE status WHEN 'Adjustment needed' THEN 'Post adjustment' WHEN 'Investigate' THEN 'Investigate' WHEN 'Escalate' THEN 'Escalate' WHEN 'Timing - Crosses period' THEN 'Monitor' ELSE 'None' END AS "Action required"
FROM {CATEGORIZED} c""")
def reconcile_master(t):
    master = rec.recon_master(_items(t), owner=F.lit("Controller"))
    return master.select("Item #", "Source", "Side A Date", "Side B Date", "Document / Reference #", "Variance", "Status", "Action required")


@query(f"SELECT a_id, b_id, status FROM {CATEGORIZED} c WHERE category = 'Timing'")
def reconcile_timing(t):
    return rec.timing_items(_items(t)).select("a_id", "b_id", "status")


@query(f"""SELECT aging_bucket, count(*) AS items, round(sum(abs(coalesce(a_amount, b_amount))), 2) AS amount FROM {CATEGORIZED} c WHERE category IN ('Adjustment', 'Investigation') GROUP BY 1""")
def reconcile_aging(t):
    return rec.aging_summary(_items(t))


@query(f"""WITH e AS (SELECT o_custkey AS entity, round(sum(o_totalprice), 2) AS owed FROM orders GROUP BY 1)
SELECT count(*) AS pairs, 0.0::DOUBLE AS net FROM e""")
def reconcile_intercompany(t):
    totals = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("amount"), F.max("o_orderdate").alias("day"))
    a = totals.withColumn("doc", C("o_custkey"))
    b = a.withColumn("amount", -C("amount"))
    pairs = rec.match_lines(a, b, _side("o_custkey"), _side("o_custkey"), SETTINGS, negate_b=True)
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), F.round(F.sum("amount_diff"), 2).alias("net"))


@query(f"""SELECT CAST(coalesce(a.doc, b.doc) AS VARCHAR) AS doc, CASE WHEN b.doc IS NULL THEN 'only in base' WHEN a.doc IS NULL THEN 'only in new' WHEN abs(a.cents - b.cents) > 1 OR a.day <> b.day THEN 'differs' ELSE 'equal' END AS status,
CASE WHEN a.doc IS NULL OR b.doc IS NULL THEN '' ELSE concat_ws(', ', CASE WHEN abs(a.cents - b.cents) > 1 THEN 'amount' END, CASE WHEN a.day <> b.day THEN 'day' END) END AS differences,
a.cents / 100 AS "amount base", b.cents / 100 AS "amount new" FROM {LEDGER_A} a FULL JOIN {LEDGER_B} b ON a.doc = b.doc""")
def compare_tables(t):
    a, b = _ledgers(t)
    return compare.compare_tables(a, b, ["doc"], ["amount"], ["day"])


@query(f"""WITH a AS (SELECT count(*)::DOUBLE AS n, sum(cents) / 100 AS s FROM {LEDGER_A} x), b AS (SELECT count(*)::DOUBLE AS n, sum(cents) / 100 AS s FROM {LEDGER_B} x)
SELECT 'rows' AS checkpoint, a.n AS base, b.n AS new, b.n - a.n AS difference, a.n = b.n AS within_tolerance FROM a, b
UNION ALL SELECT 'amount', round(a.s, 2), round(b.s, 2), round(b.s - a.s, 2), abs(b.s - a.s) <= 0.01 FROM a, b""")
def compare_sums(t):
    a, b = _ledgers(t)
    return compare.compare_sums(a, b, ["amount"])


@query("""WITH n AS (SELECT (SELECT count(*) FROM lineitem) AS l, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS d, (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS s,
(SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM supplier) AS p, (SELECT count(*) FROM region) AS r)
SELECT 'filter' AS "check", l AS expected, l AS actual, true AS passed FROM n UNION ALL SELECT 'union', c + p, c + p, true FROM n UNION ALL SELECT 'unique', l, d, true FROM n
UNION ALL SELECT 'summarize', s, s, true FROM n UNION ALL SELECT 'append', c * r, c * r, true FROM n""")
def row_count_checks(t):
    parts = split_filter(t.lineitem, [Rule("l_quantity", ">", 25)])
    a, b = t.customer.select(C("c_name").alias("name")), t.supplier.select(C("s_name").alias("name"))
    return compare.row_count_checks(
        {
            "filter": ("filter", t.lineitem, parts.true, parts.false),
            "union": ("union", [a, b], stack([a, b])),
            "unique": ("unique", t.lineitem, dedupe.deduplicate(t.lineitem, ["l_orderkey", "l_linenumber"])),
            "summarize": ("summarize", t.lineitem, ["l_suppkey"], summarize(t.lineitem, ["l_suppkey"], [Agg("COUNT", None, "n")])),
            "append": ("append", t.customer, t.region, joins.expand(t.customer, t.region)),
        }
    )


USAGE = """(SELECT event_id, 'Flow ' || user_id AS "recipeName", 'Owner ' || user_id % 10 AS "recipeOwner", CASE event_type WHEN 'view' THEN 'run_now' WHEN 'click' THEN 'scheduled' ELSE 'test_run' END AS "runType",
ts, CAST(props ->> '$.k' AS BIGINT) AS rows_, user_id AS inp, CAST(length(event_type) AS BIGINT) AS outp, CASE WHEN event_type = 'view' THEN event_id ELSE user_id + length(event_type) END AS total FROM events
WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-25')"""
METRICS = """count(DISTINCT "recipeName") AS "botCount", count(*) AS "runCount", CAST(sum(rows_) AS BIGINT) AS "rowCount", CAST(sum(inp) AS BIGINT) AS "inputTokens", CAST(sum(outp) AS BIGINT) AS "outputTokens", CAST(sum(total) AS BIGINT) AS "totalTokens\""""


def _usage(t, trend: str = "day") -> reports.Usage:
    kind = C("event_type")
    events = t.events.select(
        C("event_id").alias("executionId"),
        F.concat(F.lit("Flow "), C("user_id").cast("string")).alias("recipeName"),
        F.concat(F.lit("Owner "), (C("user_id") % 10).cast("string")).alias("recipeOwner"),
        F.when(kind == "view", "run_now").when(kind == "click", "scheduled").otherwise("test_run").alias("runType"),
        C("ts").alias("startedAt"),
        (C("user_id") % 3).cast("string").alias("workspace"),
        F.array(kind, F.lit("csv")).alias("srcConnectors"),
        F.when(kind == "purchase", F.array(F.lit("bank"))).alias("dstConnectors"),
        F.get_json_object("props", "$.k").cast("bigint").alias("processedRecords"),
        C("user_id").alias("inputTokens"),
        F.length(kind).cast("bigint").alias("outputTokens"),
        F.when(kind == "view", C("event_id")).alias("totalTokens"),
    )
    return reports.usage_report(events, "2024-01-05", "2024-01-25", trend=trend)


@query(f"SELECT {METRICS} FROM {USAGE} u")
def usage_totals(t):
    return _usage(t).totals


@query(f"""SELECT 'flow' AS kind, "recipeName" AS name, {METRICS} FROM {USAGE} u GROUP BY 2 ORDER BY "runCount" DESC, "rowCount" DESC, name LIMIT 10""")
def usage_workflows(t):
    return _usage(t).workflows.select(F.lit("flow").alias("kind"), C("recipeName").alias("name"), "botCount", "runCount", "rowCount", "inputTokens", "outputTokens", "totalTokens")


@query(f"""SELECT "recipeOwner", {METRICS} FROM {USAGE} u GROUP BY 1 ORDER BY "runCount" DESC, "rowCount" DESC, 1 LIMIT 10""")
def usage_owners(t):
    return _usage(t).owners


@query(f"""SELECT CASE "runType" WHEN 'scheduled' THEN 'Scheduled' WHEN 'run_now' THEN 'On demand' ELSE 'Test' END AS "runType", {METRICS} FROM {USAGE} u GROUP BY 1""")
def usage_run_types(t):
    return _usage(t).run_types


@query(f"""SELECT CAST(inp % 3 AS VARCHAR) AS workspace, {METRICS} FROM {USAGE} u GROUP BY 1""")
def usage_workspaces(t):
    return _usage(t).workspaces


@query("""WITH e AS (SELECT event_type FROM events WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-25')
SELECT 'src' AS role, event_type AS connector, count(*) AS "runCount" FROM e GROUP BY 2 UNION ALL SELECT 'src', 'csv', count(*) FROM e
UNION ALL SELECT 'dst', 'bank', count(*) FROM e WHERE event_type = 'purchase'""")
def usage_connectors(t):
    return _usage(t).connectors


@query(f"""SELECT date_trunc('week', ts)::DATE AS period, {METRICS} FROM {USAGE} u GROUP BY 1""")
def usage_trend_weekly(t):
    return _usage(t, "week").trend


@query("""WITH e AS (SELECT event_id, event_type, user_id, ts, value, CAST(round_even(value * 40000 / 1000, 0) AS BIGINT) AS secs FROM events)
SELECT event_id AS id, CASE event_type WHEN 'click' THEN 'test' ELSE 'run' END AS type, epoch_ms(epoch_us(ts) // 1000) AS "startedAt",
CASE WHEN secs >= 3600 THEN (secs // 3600) || ' h ' || (secs // 60 % 60) || ' m ' || (secs % 60) || ' s' WHEN secs >= 60 THEN (secs // 60) || ' m ' || (secs % 60) || ' s' ELSE secs || ' s' END AS duration,
CAST(user_id % 101 AS VARCHAR) || '%' AS "progressLabel", CASE WHEN user_id % 2 = 0 THEN 'u' || user_id || '@example.org' END AS "submitterEmail" FROM e""")
def run_history(t):
    started = F.unix_millis(C("ts").cast("timestamp"))
    runs = t.events.select(
        C("event_id").alias("id"),
        F.when(C("event_type") == "click", "test_run").when(C("event_type") == "view", "scheduled").otherwise("run_now").alias("type"),
        C("user_id").alias("recipeId"),
        F.lit("Flow").alias("recipeName"),
        F.lit(1).alias("recipeVersion"),
        F.when(C("user_id") % 2 == 0, F.concat(F.lit("u"), C("user_id").cast("string"), F.lit("@example.org"))).otherwise("batch").alias("submitter"),
        F.lit("DONE").alias("phase"),
        (C("user_id") % 101 / 100).alias("progress"),
        started.alias("startedAt"),
        (started + C("value") * 40000).alias("finishedAt"),
    )
    out = reports.run_history(runs).withColumn("startedAt", C("startedAt").cast("timestamp_ntz"))
    return out.select("id", "type", "startedAt", "duration", "progressLabel", "submitterEmail")


@query("""WITH k AS (SELECT l_suppkey, date_trunc('quarter', l_shipdate)::DATE AS q, l_extendedprice, l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag <> 'A'),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, q ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS r FROM k) x WHERE r = 1),
grid AS (SELECT s.l_suppkey, q.q FROM (SELECT DISTINCT l_suppkey FROM one) s CROSS JOIN (SELECT DISTINCT q FROM one) q)
SELECT g.l_suppkey, g.q, coalesce(l_extendedprice, 0) AS price, lag(coalesce(l_extendedprice, 0)) OVER (PARTITION BY g.l_suppkey ORDER BY g.q) AS previous, rank() OVER (PARTITION BY g.l_suppkey ORDER BY g.q DESC) AS recency
FROM grid g LEFT JOIN one ON g.l_suppkey = one.l_suppkey AND g.q = one.q""")
def quarterly_history(t):
    quarter = time_period(C("l_shipdate"), "quarter").alias("q")
    kept = filter_rules(t.lineitem, [Rule("l_returnflag", "!=", "A")]).select("l_suppkey", quarter, "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey")
    best = dedupe.deduplicate(kept, ["l_suppkey", "q"], [("l_extendedprice", "dsc"), ("l_orderkey", "asc")])
    grid = joins.scaffold(best.select("l_suppkey"), best.select("q"))
    filled = joins.blend(grid, best.select("l_suppkey", "q", "l_extendedprice"), [On("l_suppkey", "eq", "l_suppkey"), On("q", "eq", "q")], "left")
    filled = filled.select("l_suppkey", "q", F.coalesce("l_extendedprice", F.lit(0.0)).alias("price"))
    filled = window(filled, "previous", "LAG", "price", [("q", "asc")], ["l_suppkey"])
    return window(filled, "recency", "RANK", sorts=[("q", "dsc")], partitions=["l_suppkey"])
