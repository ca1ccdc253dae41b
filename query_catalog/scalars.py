"""Scalar functions."""

from pyspark.sql import functions as F

from tallyframe.functions import dates as d
from tallyframe.functions import numbers as n
from tallyframe.functions import text as x
from tallyframe.functions.predicates import compare, in_list, not_true
from tallyframe.types import cast_to

from .registry import query

C = F.col


@query("""SELECT l_orderkey, l_linenumber, l_partkey, -l_quantity AS neg, l_partkey % 7 AS m, round(power(l_quantity, 2), 4) AS pw, abs(l_tax - 0.05) AS ab,
round(ln(l_quantity) / ln(2), 6) AS lg, CAST(ceil(l_extendedprice) AS BIGINT) AS ce, CAST(floor(l_extendedprice) AS BIGINT) AS fl, round(l_extendedprice, 0) AS ro,
trunc(l_quantity / 7 - 3) AS down, sign(l_quantity / 7 - 3) * ceil(abs(l_quantity / 7 - 3)) AS up, greatest(l_discount, l_tax) AS g, least(l_discount, l_tax) AS le FROM lineitem""")
def scalar_numbers(t):
    shifted = C("l_quantity") / 7 - 3
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (-C("l_quantity")).alias("neg"),
        (C("l_partkey") % 7).alias("m"),
        F.round(F.pow("l_quantity", F.lit(2)), 4).alias("pw"),
        F.abs(C("l_tax") - 0.05).alias("ab"),
        F.round(n.log_base(F.lit(2.0), C("l_quantity")), 6).alias("lg"),
        F.ceil("l_extendedprice").alias("ce"),
        F.floor("l_extendedprice").alias("fl"),
        F.round("l_extendedprice", 0).alias("ro"),
        n.round_down(shifted).alias("down"),
        n.round_up(shifted).alias("up"),
        F.greatest("l_discount", "l_tax").alias("g"),
        F.least("l_discount", "l_tax").alias("le"),
    )


@query("""SELECT o_orderkey, CASE WHEN o_totalprice <> 100 THEN 1 ELSE 0 END AS ne, o_orderstatus IN ('F', 'O') AS inn, o_orderpriority LIKE '%-H%' AS li, o_orderpriority NOT LIKE '1%' AS nl,
NOT coalesce(nullif(o_orderstatus, 'P') = 'F', false) AS nt, nullif(o_orderstatus, 'P') IS NULL AS isn, coalesce(nullif(o_orderstatus, 'P'), '?') AS co FROM orders""")
def scalar_logic(t):
    status = F.nullif(C("o_orderstatus"), F.lit("P"))
    return t.orders.select(
        "o_orderkey",
        F.when(compare(C("o_totalprice"), "!=", F.lit(100)), 1).otherwise(0).alias("ne"),
        in_list(C("o_orderstatus"), ["F", "O"]).alias("inn"),
        C("o_orderpriority").like("%-H%").alias("li"),
        (~C("o_orderpriority").like("1%")).alias("nl"),
        not_true(status == "F").alias("nt"),
        status.isNull().alias("isn"),
        F.coalesce(status, F.lit("?")).alias("co"),
    )


@query("""SELECT p_partkey, p_name || '/' || p_brand AS joined, contains(p_name, 'ed') AS con, CASE WHEN instr(lower(p_name), 'red') = 0 THEN -1 ELSE instr(lower(p_name), 'red') END AS sea, length(p_name) AS len,
lower(p_type) AS lo, upper(p_name) AS up, reverse(p_name) AS rev, repeat(p_brand, 2) AS rep, replace(p_name, 'e', 'EE') AS repl, left(p_name, 3) AS lef, right(p_name, 4) AS rig, substring(p_name, 2, 3) AS mi,
CASE WHEN length(p_brand) >= 8 THEN p_brand ELSE lpad(p_brand, 8, '*') END AS pl, CASE WHEN length(p_brand) >= 8 THEN p_brand ELSE rpad(p_brand, 8, '*') END AS pr, split_part(p_name, ' ', 2) AS sp,
CASE WHEN instr(p_name, 'i') = 0 THEN -1 ELSE instr(p_name, 'i') END AS pos, levenshtein(p_name, p_brand) AS lev FROM part""")
def scalar_text(t):
    name, brand = C("p_name"), C("p_brand")
    return t.part.select(
        "p_partkey",
        F.concat(name, F.lit("/"), brand).alias("joined"),
        name.contains("ed").alias("con"),
        x.search(name, "RED").alias("sea"),
        F.length(name).alias("len"),
        F.lower("p_type").alias("lo"),
        F.upper(name).alias("up"),
        F.reverse(name).alias("rev"),
        F.repeat(brand, 2).alias("rep"),
        F.replace(name, F.lit("e"), F.lit("EE")).alias("repl"),
        x.left_part(name, 3).alias("lef"),
        x.right_part(name, 4).alias("rig"),
        x.mid(name, 2, 3).alias("mi"),
        x.pad_left(brand, 8, "*").alias("pl"),
        x.pad_right(brand, 8, "*").alias("pr"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("sp"),
        x.str_pos(name, "i").alias("pos"),
        F.levenshtein(name, brand).alias("lev"),
    )


@query("""SELECT page_id, regexp_matches(url, '[0-9]{2}') AS ma, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title, nullif(regexp_extract(url, '[0-9]+'), '') AS digits,
regexp_replace(url, '[aeiou]', '_', 'g') AS masked, CASE WHEN length(regexp_extract(url, '^[^0-9]*')) = length(url) THEN -1 ELSE length(regexp_extract(url, '^[^0-9]*')) + 1 END AS first_digit FROM pages""")
def scalar_regex(t):
    url = C("url")
    return t.pages.select(
        "page_id",
        F.regexp_like(url, F.lit("[0-9]{2}")).alias("ma"),
        F.nullif(x.regex_extract(C("html"), "<title>([^<]*)</title>"), F.lit("")).alias("title"),
        x.regex_extract(url, "[0-9]+").alias("digits"),
        F.regexp_replace(url, "[aeiou]", "_").alias("masked"),
        x.regex_search(url, "[0-9]").alias("first_digit"),
    )


@query("""SELECT doc_id, sha256(text) AS h, md5(base64(encode(text))) AS b64, md5(text) AS back,
md5(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;')) AS esc, md5(text) AS unesc FROM documents""")
def scalar_encode(t):
    text = C("text")
    return t.documents.select(
        "doc_id",
        x.hash_text(text).alias("h"),
        F.md5(x.base64_encode(text)).alias("b64"),
        F.md5(x.base64_decode(x.base64_encode(text))).alias("back"),
        F.md5(x.escape_html(text)).alias("esc"),
        F.md5(x.unescape_html(x.escape_html(text))).alias("unesc"),
    )


@query("""SELECT c_custkey, upper(substr(lower(c_mktsegment), 1, 1)) || substr(lower(c_mktsegment), 2) AS proper,
CASE WHEN c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY' THEN true ELSE false END AS blank FROM customer""")
def scalar_proper_blank(t):
    blank = F.when(C("c_mktsegment") == "BUILDING", "  ").when(C("c_mktsegment") != "MACHINERY", C("c_mktsegment"))
    return t.customer.select("c_custkey", F.initcap("c_mktsegment").alias("proper"), x.is_blank(blank).alias("blank"))


@query("""SELECT event_id, CAST(props ->> '$.k' AS VARCHAR) AS field, '{"k":' || (props ->> '$.k') || '}' AS formatted,
CAST(json_extract('{"k":' || (props ->> '$.k') || ',"t":"' || event_type || '"}', '$.t') ->> '$' AS VARCHAR) AS added FROM events""")
def scalar_json(t):
    props = C("props")
    return t.events.select(
        "event_id",
        x.json_field(props, "k").alias("field"),
        x.json_format(props).alias("formatted"),
        x.json_field(x.json_set(props, "t", C("event_type")), "t").alias("added"),
    )


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS bo, CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE END AS da,
CAST(trunc(o_totalprice) AS BIGINT) AS it, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS nu, strftime(o_orderdate, '%d/%m/%Y') AS tx, CAST(o_custkey AS VARCHAR) AS key_text,
o_orderdate + INTERVAL 90 MINUTE AS dt FROM orders""")
def scalar_casts(t):
    status = C("o_orderstatus")
    flag_text = F.when(status == "F", "yes").when(status == "O", "no").otherwise("maybe")
    date_text = F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("soon")
    number_text = F.when(status == "P", "n/a").otherwise(F.format_string("%.2f", "o_totalprice"))
    stamp = F.date_format(C("o_orderdate").cast("timestamp") + F.expr("INTERVAL 90 MINUTES"), "dd.MM.yyyy HH:mm")
    return t.orders.select(
        "o_orderkey",
        cast_to(flag_text, "boolean").alias("bo"),
        d.to_date(date_text).alias("da"),
        cast_to(F.format_string("%.2f", "o_totalprice"), "integer").alias("it"),
        cast_to(number_text, "number").alias("nu"),
        d.to_text(C("o_orderdate"), "dd/MM/yyyy").alias("tx"),
        d.to_text(C("o_custkey")).alias("key_text"),
        d.to_datetime(stamp, "dd.MM.yyyy HH:mm").cast("timestamp_ntz").alias("dt"),
    )


@query("""SELECT event_id, year(ts) AS y, month(ts) AS mo, day(ts) AS da, quarter(ts) AS q, hour(ts) AS h, minute(ts) AS mi, CAST(second(ts) AS BIGINT) AS s, week(ts) AS w,
isodow(ts) AS dow, dayofyear(ts) AS doy, day(last_day(ts)) AS dim, dayofyear(make_date(year(ts), 12, 31)) AS diy, dayname(ts) AS dn, monthname(ts) AS mn,
ts::DATE + 1 AS nd, ts::DATE - 1 AS pd, make_date(year(ts), month(ts), 1) AS md FROM events""")
def scalar_date_parts(t):
    ts = C("ts")
    return t.events.select(
        "event_id",
        F.year(ts).alias("y"),
        F.month(ts).alias("mo"),
        F.day(ts).alias("da"),
        F.quarter(ts).alias("q"),
        F.hour(ts).alias("h"),
        F.minute(ts).alias("mi"),
        F.second(ts).cast("bigint").alias("s"),
        F.weekofyear(ts).alias("w"),
        d.day_of_week(ts).alias("dow"),
        F.dayofyear(ts).alias("doy"),
        d.days_in_month(ts).alias("dim"),
        d.days_in_year(ts).alias("diy"),
        d.day_name(ts).alias("dn"),
        d.month_name(ts).alias("mn"),
        d.next_day(ts).alias("nd"),
        d.previous_day(ts).alias("pd"),
        F.make_date(F.year(ts), F.month(ts), F.lit(1)).alias("md"),
    )


@query("""SELECT o_orderkey, o_orderdate::DATE + 3 AS d3, o_orderdate::DATE - 14 AS w2, CAST(o_orderdate::DATE + INTERVAL 1 MONTH AS DATE) AS m1, CAST(o_orderdate::DATE + INTERVAL 3 MONTH AS DATE) AS q1,
CAST(o_orderdate::DATE - INTERVAL 1 YEAR AS DATE) AS y1, date_sub('day', o_orderdate::DATE, DATE '1999-06-15') AS dd, date_sub('week', o_orderdate::DATE, DATE '1999-06-15') AS dw,
date_sub('month', o_orderdate::DATE, DATE '1999-06-15') AS dm, date_sub('quarter', o_orderdate::DATE, DATE '1999-06-15') AS dq, date_sub('year', o_orderdate::DATE, DATE '1999-06-15') AS dy FROM orders""")
def scalar_date_arithmetic(t):
    day, end = C("o_orderdate"), F.lit("1999-06-15").cast("date")
    return t.orders.select(
        "o_orderkey",
        d.date_add(day, 3, "day").alias("d3"),
        d.date_add(day, -2, "week").alias("w2"),
        d.date_add(day, 1, "month").alias("m1"),
        d.date_add(day, 1, "quarter").alias("q1"),
        d.date_add(day, -1, "year").alias("y1"),
        *[d.date_diff(end, day, unit).alias("d" + unit[0]) for unit in ("day", "week", "month", "quarter", "year")],
    )


@query("""SELECT o_orderkey, date_trunc('week', o_orderdate)::DATE AS w, date_trunc('quarter', o_orderdate)::DATE AS q, make_date(CAST(year(o_orderdate) // 10 * 10 AS INTEGER), 1, 1) AS de,
CAST(o_orderdate::DATE - DATE '1998-08-02' AS BIGINT) AS od, CAST((date_trunc('week', o_orderdate)::DATE - DATE '1998-07-27') // 7 AS BIGINT) AS ow,
(year(o_orderdate) * 12 + month(o_orderdate)) - (1998 * 12 + 8) AS om, (year(o_orderdate) * 4 + quarter(o_orderdate)) - (1998 * 4 + 3) AS oq, year(o_orderdate) - 1998 AS oy, year(o_orderdate) // 10 - 199 AS oe FROM orders""")
def scalar_periods(t):
    day, as_of = C("o_orderdate"), "1998-08-02"
    offset = lambda unit: d.time_period_offset(day, unit, as_of)
    return t.orders.select(
        "o_orderkey",
        d.time_period(day, "week").alias("w"),
        d.time_period(day, "quarter").alias("q"),
        d.time_period(day, "decade").alias("de"),
        offset("day").alias("od"),
        offset("week").alias("ow"),
        offset("month").alias("om"),
        offset("quarter").alias("oq"),
        offset("year").alias("oy"),
        offset("decade").alias("oe"),
    )


@query("""SELECT o_orderkey, o_orderdate::DATE > make_date(year(o_orderdate), 1, 1) AND timezone('America/New_York', timezone('UTC', o_orderdate)) - o_orderdate = INTERVAL '-4 hours' AS summer FROM orders""")
def scalar_daylight_saving(t):
    return t.orders.select("o_orderkey", d.during_daylight_saving(C("o_orderdate")).alias("summer"))


@query("""SELECT c_custkey, round(2 * 6371.0 * asin(sqrt(pow(sin(radians(c_acctbal / 200 - c_nationkey) / 2), 2)
+ cos(radians(c_nationkey)) * cos(radians(c_acctbal / 200)) * pow(sin(radians(c_custkey % 180 - 7.5) / 2), 2))), 4) AS km FROM customer""")
def scalar_geo_distance(t):
    lat1, lon1 = C("c_nationkey").cast("double"), F.lit(7.5)
    km = n.geo_distance(lat1, lon1, C("c_acctbal") / 200, (C("c_custkey") % 180).cast("double"))
    return t.customer.select("c_custkey", F.round(km, 4).alias("km"))


@query("""SELECT o_orderkey, (o_orderdate::DATE - DATE '1899-12-30') + 0.25::DOUBLE AS serial, o_orderdate::DATE + INTERVAL 6 HOUR AS moment FROM orders""")
def scalar_excel_datetime(t):
    serial = F.datediff(C("o_orderdate").cast("date"), F.lit(d.SERIAL_EPOCH).cast("date")) + F.lit(0.25)
    return t.orders.select("o_orderkey", serial.alias("serial"), d.excel_serial_datetime(serial).cast("timestamp_ntz").alias("moment"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, 5 * ((l_shipdate::DATE - DATE '1970-01-05') // 7) + least(isodow(l_shipdate) - 1, 4) AS bd FROM lineitem""")
def scalar_business_days(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", d.business_day_index(C("l_shipdate")).alias("bd"))


@query("""SELECT o_orderkey, NOT (timezone('America/New_York', timezone('UTC', o_orderdate)) - o_orderdate = INTERVAL '-4 hours') AS winter FROM orders""")
def scalar_standard_time(t):
    return t.orders.select("o_orderkey", d.during_standard(C("o_orderdate")).alias("winter"))


@query("""SELECT o_orderkey, make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), o_orderkey % 24, o_orderkey % 60, (o_orderkey % 50)::DOUBLE) AS moment FROM orders""")
def scalar_datetime(t):
    """A moment from its six parts."""
    key, day = C("o_orderkey"), C("o_orderdate")
    parts = [F.year(day), F.month(day), F.dayofmonth(day), (key % 24).cast("int"), (key % 60).cast("int"), key % 50]
    return t.orders.select("o_orderkey", F.make_timestamp_ntz(*parts).alias("moment"))


# the codes of the five segments, worked out by the rule: first letter, then the classes of the consonants
@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'A351' WHEN 'BUILDING' THEN 'B435' WHEN 'FURNITURE' THEN 'F653'
WHEN 'HOUSEHOLD' THEN 'H243' WHEN 'MACHINERY' THEN 'M256' END AS code FROM customer""")
def scalar_soundex(t):
    return t.customer.select("c_custkey", F.soundex("c_mktsegment").alias("code"))


@query("""SELECT o_orderkey, current_date - o_orderdate::DATE AS days, true AS past, true AS drawn FROM orders""")
def scalar_today_and_random(t):
    """Without a day given, ages count to today; random numbers lie from 0 to below 1."""
    drawn = F.rand(7)
    age = F.datediff(d.as_of_date(None), C("o_orderdate").cast("date")).cast("bigint")
    return t.orders.select("o_orderkey", age.alias("days"), (F.now() > C("o_orderdate")).alias("past"), ((drawn >= 0) & (drawn < 1)).alias("drawn"))
