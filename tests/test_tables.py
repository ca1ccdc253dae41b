"""Designed rows and brute-force checks for joins, groups, windows and jobs."""

import datetime as dt
import random
import statistics
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import dedupe, fuzzy, joins, reshape, semistructured, sets, windows
from tallyframe.operators import infer as inf
from tallyframe.operators.aggregate import Agg, summarize
from tallyframe.operators.hierarchy import hierarchy
from tallyframe.operators.joins import On
from tallyframe.operators.timeseries import time_series
from tallyframe.operators.windows import window
from tallyframe.plans import compare, reconcile as rec, relationships
from tallyframe.plans.reconcile import Settings, Side


def values(df, *columns):
    return sorted([tuple(r) for r in (df.select(*columns) if columns else df).collect()], key=repr)


def test_right_names_and_null_keys(rows):
    left = rows([("1", "N", 5), (None, "S", 6)], "zip string, Region string, amount int")
    right = rows([("1", "N", 9), (None, "S", 8)], "zip string, region string, `amount (rhs)` int")
    out = joins.blend(left, right, [On("zip", "eq", "zip")], "full")
    assert out.columns == ["zip", "Region", "amount", "zip (rhs)", "region (rhs)", "amount (rhs)"]
    assert out.count() == 3
    inner = joins.blend(left, right, [On("zip", "eq", "ZIP"), On("amount", "le", "amount (rhs)")])
    assert inner.columns == ["zip", "Region", "amount", "region (rhs)", "amount (rhs)"] and inner.count() == 1
    assert joins.blend(left, right, [On("zip", "eq", "zip")], null_safe=True).count() == 2
    assert joins.output_names(["X"], ["X", "x"]) == ["X (rhs)", "x (rhs 2)"]


def test_join_of_different_types_raises(rows):
    with pytest.raises(TypeError):
        joins.blend(rows([(1,)], "a int"), rows([("1",)], "b string"), [On("a", "eq", "b")])


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_join_on_any_condition(rows, how):
    random.seed(1)
    l = [(i, random.choice([None, 1, 2, 3]), random.choice(["a", "b", None])) for i in range(25)]
    r = [(i, random.choice([None, 1, 2, 9]), random.choice(["a", "c", None])) for i in range(20)]
    got = values(joins.blend(rows(l, "i int, x int, s string"), rows(r, "j int, y int, u string"), [On("x", "eq", "y"), On("s", "eq", "u")], how, "or"), "i", "j")
    hit = lambda a, b: (a[1] is not None and a[1] == b[1]) or (a[2] is not None and a[2] == b[2])
    want = [(a[0], b[0]) for a in l for b in r if hit(a, b)]
    if how in ("left", "full"):
        want += [(a[0], None) for a in l if not any(hit(a, b) for b in r)]
    if how in ("right", "full"):
        want += [(None, b[0]) for b in r if not any(hit(a, b) for a in l)]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("how", ["inner", "full"])
def test_contains_join(rows, how):
    texts = ["the red fox", "redder than red", "blue", None, "", "über größe 😀 red"]
    parts = ["red", "the red f", "größe 😀", "", None, "e", "blue moon"]
    l, r = rows([(t,) for t in texts], "t string"), rows([(p,) for p in parts], "p string")
    got = values(joins.blend(l, r, [On("t", "contains", "p")], how))
    want = [(t, p) for t in texts for p in parts if t and p and p.strip() and p in t]
    if how == "full":
        found_t, found_p = {w[0] for w in want}, {w[1] for w in want}
        want += [(t, None) for t in texts if t not in found_t]
        want += [(None, p) for p in parts if p not in found_p]
    assert got == sorted(want, key=repr)
    plan = joins.blend(l, r, [On("t", "contains", "p")])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lookup_needs_unique_reference(rows):
    df = rows([(1, "x"), (2, "y")], "k int, v string")
    with pytest.raises(ValueError):
        joins.lookup(df, rows([(1, "a"), (1, "b")], "k int, w string"), [On("k", "eq", "k")])
    out = joins.lookup(df, rows([(1, "a")], "k int, w string"), [On("k", "eq", "k")], hit="found")
    assert values(out) == [(1, "x", "a", True), (2, "y", None, False)]


def test_expand_limits(rows):
    main, small = rows([(1,), (2,)], "a int"), rows([(7,), (8,), (9,)], "b int")
    assert joins.expand(main, small).count() == 6
    assert joins.expand(main, small.filter("b > 99")).count() == 0
    with pytest.raises(ValueError):
        joins.expand(main, small, max_small_rows=2)


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("busy", [100_000, 3])
@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_fuzzy_match_finds_every_pair(rows, monkeypatch, busy, threshold):
    monkeypatch.setattr(fuzzy, "BUSY_PAIRS", busy)
    random.seed(4)
    name = lambda: ("the " if random.random() < 0.4 else "") + "".join(random.choice("abc") for _ in range(random.randint(1, 12)))
    a, b = [name() for _ in range(80)], [name() for _ in range(80)]
    got = {(r.ltext, r.rtext) for r in fuzzy.similar_texts(rows([(x,) for x in a], "a string"), rows([(x,) for x in b], "b string"), threshold).collect()}
    assert got == {(x, y) for x in a for y in b if _distance(x, y) <= int((1 - threshold) * max(len(x), len(y)) + 1e-9)}


@pytest.mark.parametrize("threshold", [0.7, 0.8, 0.9, 1])
def test_fuzzy_match_on_long_texts(rows, threshold):
    """Around the length from which texts are long, and well beyond it."""
    random.seed(int(threshold * 10))
    words = ["".join(random.choice("abcde") for _ in range(random.randint(1, 6))) for _ in range(40)]

    def text(size):
        return " ".join(random.choice(words) for _ in range(99))[:size]

    def changed(t, share):
        out = list(t)
        for _ in range(int(share * len(t))):
            at = random.randrange(len(out))
            out[at : at + random.randint(0, 1)] = random.choice(["", "x", "yz"])
        return "".join(out)

    a = [text(random.choice([30, 36, 39, 40, 41, 44, 60, 120, 160])) for _ in range(26)]
    b = [changed(t, share) for t in a for share in (0, 0.1, 0.22)][:60] + ["", "ab"]
    got = {(r.ltext, r.rtext): r.score for r in fuzzy.similar_texts(rows([(x,) for x in a], "a string"), rows([(x,) for x in b], "b string"), threshold).collect()}
    distances = {(x, y): _distance(x, y) for x in a for y in b if abs(len(x) - len(y)) <= (1 - threshold) * max(len(x), len(y)) + 1}
    want = {p: 1 - d / max(map(len, p)) for p, d in distances.items() if d <= int((1 - threshold) * max(map(len, p)) + 1e-9)}
    assert got == pytest.approx(want) and len(want) >= 20


def test_fuzzy_match_keeps_both_rows(rows):
    out = fuzzy.fuzzy_match(rows([("ACME, Corp.", 1), ("Zeta", 2)], "name string, n int"), rows([("Acme Corp", 9), ("Acme Korp", 8)], "name string, n int"), "name", "name")
    assert out.columns == ["name", "n", "name (rhs)", "n (rhs)", "Confidence Score"]
    assert [(r[1], r[3], round(r[4], 3)) for r in sorted(out.collect(), key=lambda r: r[3])] == [(1, 8, 0.889), (1, 9, 1.0)]


def test_summarize_rules(rows):
    df = rows([("a", 1.0, "x"), ("a", 2.0, " "), ("b", None, None), (None, 4.0, "y")], "k string, v double, t string")
    out = summarize(df, ["k"], [Agg("COUNT", "t", "filled"), Agg("COUNT", "k", "n"), Agg("MEDIAN", "v", "med"), Agg("SUM", "v", "s")])
    assert values(out) == sorted([("a", 1, 2, 1.5, 3.0), ("b", 0, 1, None, None), (None, 1, 1, 4.0, 4.0)], key=repr)
    assert values(summarize(df.filter("k = 'zzz'"), [], [Agg("COUNT", None, "n"), Agg("MEDIAN", "v", "m"), Agg("MODE", "t", "o")])) == [(0, None, None)]
    with pytest.raises(ValueError):
        summarize(df, ["k"], [Agg("SUM", "k", "x")])
    with pytest.raises(ValueError):
        summarize(df, ["k"], [Agg("FIRST", "v", "x")])


def test_median_of_big_uneven_groups(spark):
    random.seed(5)
    data = [("hot", float(random.randint(0, 10**9))) for _ in range(30_000)] + [("tie", 7.0)] * 5000 + [("tie", float(i)) for i in range(4999)] + [("one", 3.0)] + [("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = dict(values(summarize(df, ["k"], [Agg("MEDIAN", "v", "m")])))
    for k in got:
        assert got[k] == statistics.median([v for g, v in data if g == k])


def test_mode_tie_takes_the_smallest(rows):
    df = rows([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert values(summarize(df, [], [Agg("MODE", "v", "m")])) == [("a",)]


def test_mixed_order_of_first(rows):
    df = rows([("ab", 1), ("abc", 2), ("b", 3), (None, 4), ("b", 5)], "t string, n int")
    first = lambda *sorts: summarize(df, [], [Agg("FIRST", "n", "f", sorts=sorts)]).first()[0]
    assert first(("t", "dsc"), ("n", "asc")) == 3
    assert first(("t", "dsc"), ("n", "dsc")) == 5
    assert first(("t", "asc"), ("n", "dsc")) == 4
    below_b = summarize(df.filter("t like 'a%'"), [], [Agg("FIRST", "n", "f", sorts=(("t", "dsc"), ("n", "asc")))])
    assert below_b.first()[0] == 2


CALCS = [
    ("ROW_NUM", {}),
    ("RANK", {}),
    ("NTILE", {"ntile": 3}),
    ("CUM_SUM", {"field": "v"}),
    ("FILL_DOWN", {"field": "v"}),
    ("FILL_DOWN", {"field": "v", "back_fill": True}),
    ("LAG", {"field": "v", "offset": 2}),
    ("LEAD", {"field": "v", "offset": 3}),
]


@pytest.mark.parametrize("calc, extra", CALCS)
@pytest.mark.parametrize("partitions", [[], ["k"]])
def test_split_window_equals_plain(rows, monkeypatch, calc, extra, partitions):
    monkeypatch.setattr(windows, "BLOCK_ROWS", 7)
    random.seed(6)
    data = [(i, "hot" if random.random() < 0.7 else random.choice(["a", None]), random.choice([None, "x", "y", "z"]), random.choice([None, 1, 2, 3])) for i in range(200)]
    df = rows(data, "i int, k string, s string, v bigint").repartition(5)
    sorts = [("s", "dsc")] if calc == "RANK" else [("s", "dsc"), ("i", "asc")]
    plain, split = (window(df, "out", calc, sorts=sorts, partitions=partitions, split=flag, **extra) for flag in (False, True))
    assert values(plain, "i", "out") == values(split, "i", "out")


def test_window_checks(rows):
    df = rows([(1, 2)], "a int, b int")
    for bad in (dict(calc="LAG", field="b"), dict(calc="NTILE", sorts=[("a", "asc")]), dict(calc="ROW_NUM", sorts=[("a", "up")]), dict(calc="NOPE")):
        with pytest.raises(ValueError):
            window(df, "o", **bad)


def test_duplicates(rows):
    df = rows([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k int, v string")
    assert values(dedupe.deduplicate(df, ["k"], [("v", "dsc")])) == [(1, "b"), (2, "e"), (None, "d")]
    assert values(dedupe.duplicates_only(df, ["k"], [("v", "asc")])) == [(1, "a"), (1, "b"), (None, "d")]
    assert values(dedupe.duplicates_only(df, ["k"], [("v", "asc")], split=True)) == [(1, "a"), (1, "b"), (None, "d")]
    assert [r[2] for r in sorted(dedupe.flag_duplicates(df, ["k"]).collect(), key=lambda r: r[1])] == [True, True, True, True, True, False]
    assert dedupe.deduplicate(df).count() == 5
    plan = dedupe.deduplicate(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_top_rows_beyond_the_trim(rows, monkeypatch):
    monkeypatch.setattr(dedupe, "RANK_TRIM", 2)
    df = rows([(i % 2, i) for i in range(20)], "k int, v int")
    assert values(dedupe.sample_top(df, 4, [("v", "dsc")], ["k"])) == sorted([(0, v) for v in (18, 16, 14, 12)] + [(1, v) for v in (19, 17, 15, 13)], key=repr)


def test_hierarchy_depth_cycles_and_orphans(rows):
    chain = [(i, i - 1 if i else None, 1.0) for i in range(300)] + [(1000, 999, 5.0)]
    out = hierarchy(rows(chain, "id int, up int, v double"), "id", "up", [Agg("COUNT", None, "n"), Agg("SUM", "v", "s"), Agg("JOIN_STR", "id", "path", delimiter=">")])
    got = {r["id"]: (r["n"], r["s"]) for r in out.collect()}
    assert got[299] == (300, 300.0) and got[0] == (1, 1.0) and got[1000] == (1, 5.0)
    assert out.filter("id = 3").first()["path"] == "3>2>1>0"
    with pytest.raises(ValueError, match="does not end"):
        hierarchy(rows([(1, 2), (2, 3), (3, 1)], "id int, up int"), "id", "up", [Agg("COUNT", None, "n")])
    with pytest.raises(ValueError, match="not unique"):
        hierarchy(rows([(1, 2), (1, None)], "id int, up int"), "id", "up", [Agg("COUNT", None, "n")])


def test_time_series_labels(rows):
    df = rows([(dt.date(2025, 1, 31), 1), (dt.date(2025, 4, 1), 2), (None, 3)], "d date, v int")
    assert values(time_series(df, "d", [Agg("SUM", "v", "s")], "month", as_of="2025-02-10")) == [("Apr 2025", 2, 2), ("Jan 2025", -1, 1)]
    filled = time_series(df, "d", [Agg("SUM", "v", "s"), Agg("COUNT", None, "n")], "quarter", as_of="2025-02-10", fill_gaps=True)
    assert values(filled) == [("Q1 2025", 0, 1, 1), ("Q2 2025", 1, 2, 1)]
    with pytest.raises(ValueError):
        time_series(df, "v", [Agg("COUNT", None, "n")])


def test_stack_rules(rows):
    a, b = rows([(1, "x")], "k int, v string"), rows([("y", 2.5)], "V string, extra double")
    assert sets.stack([a, b]).columns == ["v"]
    assert values(sets.stack([a, b], "all")) == sorted([(1, "x", None), (None, "y", 2.5)], key=repr)
    with pytest.raises(TypeError):
        sets.stack([a, rows([("1",)], "k string")])
    assert sets.stack_by_position([a, rows([(2, "y", 3)], "p int, q string, r int")], "all").columns == ["k", "v", "r"]
    with pytest.raises(TypeError):
        sets.stack_by_position([a, b])


def test_pivot_and_unpivot(rows):
    df = rows([("a", "Jan", 1), ("a", "Jan", 2), ("b", None, 5)], "k string, m string, v int")
    out = reshape.pivot(df, "m", "v")
    assert out.columns == ["k", "Jan", "null"] and values(out) == [("a", 3, None), ("b", None, 5)]
    with pytest.raises(ValueError):
        reshape.pivot(rows([("a", "k", 1)], "k string, m string, v int"), "m", "v")
    wide = rows([("a", 1, "x")], "k string, n int, t string")
    assert values(reshape.unpivot(wide, ["k"], mode="keep")) == [("a", "n", "1"), ("a", "t", "x")]
    with pytest.raises(ValueError):
        reshape.unpivot(wide, ["n"], name="k")


def test_split(rows):
    df = rows([("a| b |", 1), (None, 2)], "t string, n int")
    assert values(reshape.split_rows(df, "t", "|")) == sorted([("a", 1), ("b", 1), ("", 1), (None, 2)], key=repr)
    assert reshape.split_columns(df, "t", "|").columns == ["t", "n", "t Split 1", "t Split 2", "t Split 3"]


def test_json_and_xml(rows):
    df = rows([(1, '{"a":{"b":1},"c":[1,2]}'), (2, "{bad"), (3, '{"a":{"d":"x"}}')], "i int, j string")
    flat = semistructured.json_flatten(df, "j")
    assert flat.columns == ["i", "a.b", "a.d", "c"]
    assert values(flat) == sorted([(1, 1, None, "[1,2]"), (2, None, None, None), (3, None, "x", None)], key=repr)
    arrays = rows([(1, "[1,{\"x\":2}]"), (2, "[]"), (3, "nope"), (4, None)], "i int, j string")
    assert values(semistructured.json_explode(arrays, "j")) == [(1, "1"), (1, '{"x":2}')]
    xml = rows([(1, "<o><l><n>1</n></l><l><n>2</n></l></o>"), (2, "<o/>")], "i int, x string")
    assert values(semistructured.xml_select(xml, "x", "o/l/n")) == [(1, "1"), (1, "2")]
    assert semistructured.xml_select(xml, "x", "o/wrong").count() == 0
    parts = semistructured.xml_select(xml, "x", "o/l", "l", "struct<n: int>")
    assert values(semistructured.xml_extract(parts, "l", "struct<n: int>")) == [(1, 1), (1, 2)]
    assert values(semistructured.xml_extract(xml.filter("i = 1"), "x", keep_input=True), "l")[0][0].startswith("[{")


def test_infer_row_limit_and_unknown_field(rows):
    df = rows([(i, f"t{i}") for i in range(10)], "i int, t string")
    upper = lambda s: s.str.upper()
    out = inf.infer(df, "{{t}}!", upper, row_limit=3, order=[("i", "asc")])
    assert [r["AI Answer"] for r in sorted(out.collect())] == ["T0!", "T1!", "T2!"] + [None] * 7
    with pytest.raises(ValueError):
        inf.infer(df, "{{missing}}", upper, row_limit=None)


def test_api_errors_are_data(rows):
    def transport(url, method, body):
        if url.endswith("2"):
            raise OSError("down")
        return 200, body

    out = inf.call_api(rows([(1,), (2,)], "i int"), "http://x/{{i}}", transport, "POST", "n={{i}}")
    assert values(out, "i", "Response Status", "Response Body") == [(1, 200, "n=1"), (2, 0, "down")]


def _greedy(a, b, cents, days):
    """One pair at a time, the closest of all first."""
    index = lambda d: 5 * ((d - dt.date(1970, 1, 5)).days // 7) + min((d - dt.date(1970, 1, 5)).days % 7, 4)
    pairs = []
    for i, k, d, c in a:
        for j, q, e, f in b:
            if k == q and abs(c - f) <= cents and abs(index(d) - index(e)) <= days:
                pairs.append(((abs(index(d) - index(e)), abs(c - f), index(d), c, index(e), f, i, j), i, j))
    used_a, used_b, out = set(), set(), []
    for _, i, j in sorted(pairs):
        if i not in used_a and j not in used_b:
            used_a.add(i)
            used_b.add(j)
            out.append((i, j))
    return sorted(out)


@pytest.mark.parametrize("seed, cents, days", [(1, 1, 3), (2, 3, 2), (3, 0, 4), (4, 2, 0)])
def test_matching_equals_greedy(rows, seed, cents, days):
    random.seed(seed)
    line = lambda i: (i, random.choice("pq"), dt.date(2024, 1, 1) + dt.timedelta(days=random.randint(0, 12)), random.randint(100, 106))
    a, b = [line(i) for i in range(60)], [line(1000 + i) for i in range(50)]
    frames = [rows([(i, k, d, c / 100) for i, k, d, c in side], "id int, key string, day date, amount double") for side in (a, b)]
    side = Side("id", "day", "amount", ["key"])
    pairs = rec.match_lines(*frames, side, side, Settings(cents / 100, days, 0))
    assert sorted((r.a_id, r.b_id) for r in pairs.collect()) == _greedy(a, b, cents, days)


@pytest.mark.parametrize("block", [50_000, 40])
def test_a_chain_of_closer_and_closer_pairs(rows, monkeypatch, block):
    """Every pair waits for the next one; rounds grow with the blocks it runs through, not with its length."""
    monkeypatch.setattr(rec, "BLOCK_PAIRS", block)
    at, a, b = 0, [], []
    for i in range(160):
        (a if i % 2 else b).append((i, "p", dt.date(2024, 1, 1), at))
        at += 1000 - 3 * i
    frames = [rows([(i, k, d, c / 100) for i, k, d, c in side], "id int, key string, day date, amount double") for side in (a, b)]
    side, made, plain = Side("id", "day", "amount", ["key"]), [], rec._neighbours
    cuts = rec.cut_lineage
    monkeypatch.setattr(rec, "cut_lineage", lambda df: made.append(df) or cuts(df))
    pairs = rec.match_lines(*frames, side, side, Settings(10, 0, 0))
    assert sorted((r.a_id, r.b_id) for r in pairs.collect()) == _greedy(a, b, 1000, 0) and plain is rec._neighbours
    assert len(made) <= (4 if block > 1000 else 4 + 2 * 8)


def test_amounts_beyond_64_bits(rows):
    day = dt.date(2024, 1, 1)
    amounts = [Decimal("99999999999999.990001"), Decimal("-99999999999999.99"), Decimal("1.00"), Decimal("12345678901234567.89")]
    a = rows([(i, day, x) for i, x in enumerate(amounts)], "id int, day date, amount decimal(38,6)")
    b = rows([(i + 10, day, x + Decimal("0.000001") * (i % 2)) for i, x in enumerate(amounts)], "id int, day date, amount decimal(38,6)")
    side = Side("id", "day", "amount")
    exact = rec.match_lines(a, b, side, side, Settings(0, 0, 0)).collect()
    assert sorted((r.a_id, r.b_id) for r in exact) == [(0, 10), (2, 12)]
    near = rec.match_lines(a, b, side, side, Settings(0.000001, 2, 0)).collect()
    assert sorted((r.a_id, r.b_id) for r in near) == [(i, i + 10) for i in range(4)]


def test_keys_of_a_reconciliation_type():
    found = rec.matching_keys("intercompany", ["Entity", "Document #", "Currency", "Amount"], ["doc", "ENTITY", "document_number", "amount"])
    assert found == [("Entity", "ENTITY"), ("Document #", "document_number")]


def test_reconcile_edges(rows):
    friday, monday = dt.date(2024, 1, 5), dt.date(2024, 1, 8)
    a = rows([(1, "x", friday, 10.0), (2, None, friday, 5.0), (3, "y", None, 1.0), (4, "z", friday, 60_000.0)], "id int, key string, day date, amount double")
    b = rows([(7, " X", monday, 10.01), (8, None, friday, 5.0)], "id int, key string, day date, amount double")
    side = Side("id", "day", "amount", ["key"])
    settings = Settings(0.01, 1, 10_000)
    items = rec.classify(rec.reconcile(a, b, side, side, settings), "2024-01-01", "2024-01-06", settings)
    got = {(r.a_id, r.b_id): (r.source, r.status) for r in items.collect()}
    assert got == {
        (1, 7): ("Both", "Timing - Crosses period"),
        (2, None): ("Side A", "Investigate"),
        (3, None): ("Side A", "Investigate"),
        (4, None): ("Side A", "Escalate"),
        (None, 8): ("Side B", "Investigate"),
    }
    summary = rec.recon_summary(items).first()
    assert (summary.matched_count, summary.match_rate, summary.match_rate_status) == (1, 33.33, "red")
    assert summary.unexplained_difference == round(5.0 + 1.0 + 60_000.0 - 5.0, 2)
    master = rec.recon_master(items)
    assert len(master.columns) == 18 and sorted(r[0] for r in master.collect()) == [1, 2, 3, 4, 5]
    levels = {r.a_id: (r.amount_escalation, r.total_escalation) for r in rec.escalation(items).collect() if r.a_id}
    assert levels[4] == ("Controller review", None)
    assert rec.proposed_settings("bank").date_tolerance == 5
    with pytest.raises(TypeError):
        Settings()


def test_holidays_shorten_the_gap(rows):
    df = rows([(dt.date(2024, 1, 2), dt.date(2023, 12, 29))], "a date, b date")
    gap = lambda h: rec.business_index(F.col("a"), h) - rec.business_index(F.col("b"), h)
    assert tuple(df.select(gap([]), gap([dt.date(2024, 1, 1)])).first()) == (2, 1)


def test_compare_tables(rows):
    base = rows([("A ", 1.0, "x"), ("b", 2.0, "y"), ("c", 3.0, "z"), ("d", None, "z")], "k string, v double, t string")
    new = rows([("a", 1.01, "x "), ("B", 2.02, "y"), ("e", 9.0, "z"), ("d", 1.0, "q")], "k string, v double, t string")
    got = {r.k: (r.status, r.differences) for r in compare.compare_tables(base, new, ["k"], ["v"], ["t"]).collect()}
    assert got == {"A": ("equal", ""), "B": ("differs", "v"), "C": ("only in base", ""), "E": ("only in new", ""), "D": ("differs", "v, t")}


def test_office_vacancy_example(rows):
    """Worked example: filter 8, quarters 5, buildings 8, grid 40, history 40."""
    quarters = [dt.date(2024, m, 28) for m in (3, 6, 9, 12)] + [dt.date(2025, 3, 28)]
    data = [(f"RM-{b:04d}", "Rome", q, 100.0 * b, "STOCK") for b in range(1, 9) for q in quarters if (b, q) not in ((4, quarters[2]), (3, quarters[4]), (8, quarters[0]))]
    data += [("RM-0001", "Rome", quarters[0], 100.0, "STOCK"), ("MI-1", "Milan", quarters[0], 1.0, "STOCK"), ("RM-9999", "Rome", quarters[0], 1.0, "LEGACY")]
    df = rows(data, "building string, city string, closing date, area double, lineage string")
    from tallyframe.functions.predicates import Rule
    from tallyframe.operators.filters import filter_rules

    kept = filter_rules(df, [Rule("city", "=", "Rome"), Rule("lineage", "!=", "LEGACY")])
    one = dedupe.deduplicate(kept, ["building", "closing"], [("area", "dsc")])
    assert kept.count() - one.count() == 1
    grid = joins.scaffold(one.select("building"), one.select("closing"))
    assert (one.select("closing").distinct().count(), one.select("building").distinct().count(), grid.count()) == (5, 8, 40)
    filled = joins.blend(grid, one.select("building", "closing", "area"), [On("building", "eq", "building"), On("closing", "eq", "closing")], "left")
    history = window(filled.select("building", "closing", F.coalesce("area", F.lit(0.0)).alias("area")), "previous", "LAG", "area", [("closing", "asc")], ["building"])
    assert history.count() == 40 and history.filter("area = 0").count() == 3
    current = history.filter(F.col("closing") == quarters[4])
    dropped = current.filter("building = 'RM-0003'").first()
    assert current.count() == 8 and (dropped.area, dropped.previous) == (0.0, 300.0)


def test_big_groups_are_split_on_their_own(rows, monkeypatch):
    df = rows([("hot" if i % 3 else "cold", i) for i in range(90)], "k string, v int")
    plain = values(window(df, "n", "ROW_NUM", sorts=[("v", "dsc")], partitions=["k"]).withColumn("n", F.col("n").cast("bigint")))
    monkeypatch.setattr(windows, "MAX_GROUP_ROWS", 10)
    assert values(window(df, "n", "ROW_NUM", sorts=[("v", "dsc")], partitions=["k"])) == plain


def test_any_condition_join_has_no_nested_loop(rows):
    left, right = rows([(1, "a")], "x int, s string"), rows([(1, "b")], "y int, u string")
    out = joins.blend_forks(left, right, [On("x", "eq", "y"), On("s", "eq", "u")], "full", "or")
    for df in out:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_nearest_equals_brute_force(rows, direction):
    random.seed(8)
    left = [(i, random.choice(["p", "q", None]), random.choice([None, *range(20)])) for i in range(40)]
    right = [(100 + v, k, v) for k in "pq" for v in random.sample(range(20), 6)]
    out = joins.nearest(rows(left, "i int, k string, v int"), rows(right, "j int, q string, w int"), [("k", "q")], ("v", "w"), direction)
    for row in out.collect():
        fits = [(abs(w - row.v), w, j) for j, q, w in right if row.v is not None and q == row.k and (direction == "nearest" or (w <= row.v if direction == "backward" else w >= row.v))]
        assert row.j == (min(fits)[2] if fits else None)


def test_tolerances_include_their_limit(rows):
    left = rows([(1, 10.0, dt.date(2024, 1, 1)), (2, -0.01, dt.date(2024, 1, 1)), (3, None, None)], "i int, a double, d date")
    right = rows([(7, 10.01, dt.date(2024, 1, 4)), (8, 10.02, dt.date(2024, 1, 1)), (9, 0.0, dt.date(2024, 1, 5))], "j int, b double, e date")
    assert values(joins.tolerance_join(left, right, amount=("a", "b", 0.01)), "i", "j") == [(1, 7), (2, 9)]
    assert values(joins.tolerance_join(left, right, date=("d", "e", 3)), "i", "j") == [(1, 7), (1, 8), (2, 7), (2, 8)]
    assert values(joins.tolerance_join(left, right, amount=("a", "b", 0.01), date=("d", "e", 3)), "i", "j") == [(1, 7)]
    assert joins.tolerance_join(left, right, amount=("a", "b", 0)).count() == 0


def test_tolerance_join_on_every_cent(rows):
    grid = [(c, c / 100) for c in range(-300, 2000)]
    left, right = rows(grid, "i int, a double"), rows(grid, "j int, b double")
    got = values(joins.tolerance_join(left, right, amount=("a", "b", 0.01)), "i", "j")
    assert got == sorted([(i, j) for i, _ in grid for j in (i - 1, i, i + 1) if -300 <= j < 2000], key=repr)


def test_interval_join_against_brute_force(rows):
    draws = np.random.default_rng(2)
    points = [(i, None if i % 17 == 0 else float(np.round(draws.normal(0, 100), 1))) for i in range(200)]
    spans = [(j, float(a), None if j % 13 == 0 else float(a + w)) for j, (a, w) in enumerate(zip(np.round(draws.normal(0, 100, 80), 1), np.round(np.exp(draws.normal(0, 3, 80)) - 1, 1)))]
    left, right = rows(points, "i int, x double"), rows(spans, "j int, lo double, hi double")
    on = [On("x", "ge", "lo"), On("x", "le", "hi")]
    want = sorted([(i, j) for i, x in points for j, lo, hi in spans if x is not None and hi is not None and lo <= x <= hi], key=repr)
    joined = joins.blend(left, right, on)
    assert values(joined, "i", "j") == want
    plan = joined._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    inner, left_only, right_only = joins.blend_forks(left, right, on)
    assert {r[0] for r in values(left_only, "i")} == ({i for i, _ in points} - {i for i, _ in want})
    assert {r[0] for r in values(right_only, "j")} == ({j for j, *_ in spans} - {j for _, j in want})
    assert {r[0] for r in values(joins.semi(left, right, on), "i")} == {i for i, _ in want}
    turned = [On("lo", "le", "x"), On("hi", "ge", "x")]
    assert values(joins.blend(right, left, turned), "i", "j") == want


def test_open_and_wide_intervals(rows):
    """Bounds without end, near the ends of what a double holds, and values that are not a number."""
    inf, nan = float("inf"), float("nan")
    points = [(i, x) for i, x in enumerate([0.0, -5.0, 1e308, -1e308, inf, -inf, nan, None, 1e300, 3.0, 1e-300])]
    spans = [(j, *x) for j, x in enumerate([(0.0, inf), (-inf, 0.0), (-inf, inf), (-1e308, 1e308), (0.0, 1e308), (1e300, 1e300), (2.0, 3.0), (5.0, 1.0), (nan, nan), (0.0, nan), (None, inf), (0.0, 1e-300), (inf, inf)])]
    left, right = rows(points, "i int, x double"), rows(spans, "j int, lo double, hi double")
    # as Spark compares: what is not a number is the largest, and equal to itself
    key = lambda v: (v != v, 0.0 if v != v else v)
    want = sorted([(i, j) for i, x in points for j, lo, hi in spans if None not in (x, lo, hi) and key(lo) <= key(x) <= key(hi)], key=repr)
    on = [On("x", "ge", "lo"), On("x", "le", "hi")]
    assert values(joins.blend(left, right, on), "i", "j") == want
    assert {r[0] for r in values(joins.anti(left, right, on), "i")} == {i for i, _ in points} - {i for i, _ in want}
    dates = rows([(1, dt.date(2024, 1, 5))], "i int, d date")
    times = rows([(7, dt.datetime(2024, 1, 4, 12), dt.datetime(9999, 12, 31)), (8, dt.datetime(2024, 1, 5, 1), dt.datetime(2024, 1, 6))], "j int, lo timestamp, hi timestamp")
    assert values(joins.blend(dates, times, [On("d", "ge", "lo"), On("d", "le", "hi")]), "i", "j") == [(1, 7)]


@pytest.mark.parametrize("ops", [("lt", "gt"), ("le", "ge"), ("gt", "le"), ("ge", "lt"), ("lt", "lt")])
def test_two_inequalities_against_brute_force(rows, monkeypatch, ops):
    """Ties, a value in a third of all rows, nulls and ends of the scale; plans compare no tables row by row."""
    monkeypatch.setattr(joins, "INEQUALITY_ROWS", 20)
    draws = np.random.default_rng(len(ops[0] + ops[1]))
    inf, nan = float("inf"), float("nan")

    def side(n, first):
        a = np.where(draws.random(n) < 0.3, 5.0, np.round(draws.normal(0, 10, n), 1)).tolist()
        b = draws.integers(0, 40, n).tolist()
        for k, odd in enumerate([None, nan, inf, -inf, 1e308]):
            a[k] = odd
        b[7] = None
        return [(first + i, x, y) for i, (x, y) in enumerate(zip(a, b))]

    lrows, rrows = side(260, 0), side(230, 1000)
    left, right = rows(lrows, "i int, a double, b bigint"), rows(rrows, "j int, c double, d bigint")
    key = lambda v: (v != v, 0.0 if v != v else v)
    test = {"lt": lambda x, y: key(x) < key(y), "le": lambda x, y: key(x) <= key(y), "gt": lambda x, y: key(x) > key(y), "ge": lambda x, y: key(x) >= key(y)}
    want = sorted([(i, j) for i, a, b in lrows for j, c, d in rrows if None not in (a, b, c, d) and test[ops[0]](a, c) and test[ops[1]](b, d)], key=repr)
    on = [On("a", ops[0], "c"), On("b", ops[1], "d")]
    joined = joins.blend(left, right, on)
    assert values(joined, "i", "j") == want and len(want) > 1000
    plan = joined._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    _, left_only, right_only = joins.blend_forks(left, right, on)
    assert {r[0] for r in values(left_only, "i")} == {i for i, *_ in lrows} - {i for i, _ in want}
    assert {r[0] for r in values(right_only, "j")} == {j for j, *_ in rrows} - {j for _, j in want}
    assert {r[0] for r in values(joins.semi(left, right, [*on, On("i", "ne", "j")]), "i")} == {i for i, _ in want}


def test_inequalities_with_few_results_make_few_candidates(rows, spark):
    """Rising on the left and falling on the right: copies grow with a logarithm, pairs aren't formed."""
    n = 20_000
    left = spark.range(n).selectExpr("id AS i", "id AS a", "id AS b")
    right = spark.range(n).selectExpr("id AS j", "id AS c", f"{n} - 2 * id AS d")
    sides = joins._Sides(left, right, [On("a", "lt", "c"), On("b", "lt", "d")], False)
    found = sides.dominated(sides.on, sides.left, sides.right)
    want = sum(max(0, (n - x - 1) // 2 - x) if (n - x) % 2 else max(0, (n - x) // 2 - 1 - x) for x in range(n))
    assert found.count() == want
    monotone = joins._Sides(left, right.selectExpr("j", "c", "c - 3 AS d"), [On("a", "gt", "c"), On("b", "lt", "d")], False)
    assert monotone.dominated(monotone.on, monotone.left, monotone.right).count() == 0


def test_rows_without_partner_form_no_pairs(spark, monkeypatch):
    """Nearly every pair of 3,000 and 3,000 rows fits two inequalities; a row's partner is found without them."""
    def pairs(*_):
        raise AssertionError("pairs were formed")

    monkeypatch.setattr(joins._Sides, "dominated", pairs)
    monkeypatch.setattr(joins._Sides, "binned", pairs)
    left = spark.range(3000).selectExpr("id AS i", "id % 50 AS a", "CAST(id AS double) AS b")
    right = spark.range(3000).selectExpr("id AS j", "id % 50 AS c", "id + 0.5BD AS d")
    for on, alone in (
        ([On("a", "le", "c"), On("b", "lt", "d")], []),
        ([On("a", "lt", "c"), On("b", "lt", "d")], [i for i in range(3000) if not any(j % 50 > i % 50 for j in range(i, 3000))]),
        ([On("a", "gt", "c"), On("b", "ge", "d")], [i for i in range(3000) if not any(j % 50 < i % 50 for j in range(i))]),
        ([On("b", "ge", "j"), On("b", "le", "d")], []),
    ):
        assert sorted(r[0] for r in joins.anti(left, right, on).select("i").collect()) == alone
        assert joins.semi(left, right, on).count() == 3000 - len(alone)


@pytest.mark.parametrize("block", [50_000, 12])
@pytest.mark.parametrize("direction", ["nearest", "backward", "forward"])
def test_nearest_once_equals_sequential_greedy(rows, monkeypatch, direction, block):
    monkeypatch.setattr(joins, "NEAREST_BLOCK", block)
    random.seed(len(direction))
    line = lambda i: (i, random.choice("ppq") if i % 19 else None, float(random.randint(0, 120)) if i % 17 else None)
    a, b = [line(i) for i in range(90)], [line(1000 + i) for i in range(70)]
    # a chain in which every next pair is closer
    at = 0.0
    for i in range(30):
        (a if i % 2 else b).append((2000 + i, "c", at))
        at += 200 - 3 * i
    found = sorted(
        (abs(x - y), x, y, i, j) for i, k, x in a for j, q, y in b
        if None not in (k, q, x, y) and k == q and (direction == "nearest" or (y <= x) == (direction == "backward") or x == y)
    )
    pairs, used = {}, set()
    for *_, i, j in found:
        if i not in pairs and j not in used:
            pairs[i] = j
            used.add(j)
    left, right = rows(a, "id int, k string, x double"), rows(b, "id int, q string, y double")
    out = joins.nearest_once(left, right, [("k", "q")], ("x", "y"), direction)
    assert out.columns == ["id", "k", "x", "id (rhs)", "q", "y"] and out.count() == len(a)
    assert {r[0]: r[3] for r in out.collect() if r[3] is not None} == pairs
    assert {tuple(r[:3]) for r in out.collect()} == set(a)


def test_nearest_once_on_dates_without_keys(rows):
    days = lambda *n: [(dt.date(2024, 1, i),) for i in n]
    out = joins.nearest_once(rows(days(5, 5, 9), "d date"), rows(days(6, 20), "e date"), [], ("d", "e"))
    assert values(out, "d", "e") == sorted([(dt.date(2024, 1, 5), dt.date(2024, 1, 6)), (dt.date(2024, 1, 5), None), (dt.date(2024, 1, 9), dt.date(2024, 1, 20))], key=repr)
    assert joins.nearest_once(rows(days(5), "d date"), rows([], "e date"), [], ("d", "e")).collect()[0][1] is None


@pytest.mark.parametrize("sorts", [[("v", "asc")], [("v", "dsc"), ("t", "asc")], [("t", "dsc"), ("v", "asc")]])
def test_split_windows_on_odd_values(rows, sorts):
    """Nulls, what is not a number, ties and texts."""
    random.seed(3)
    data = [(i, random.choice([None, float("nan"), 1.5, -2.0, float(i % 90)]), random.choice([None, "", "a", "B", "é"]), i % 3) for i in range(900)]
    df = rows(data, "i int, v double, t string, k int")
    for partitions in ([], ["k"]):
        for calc, field in (("ROW_NUM", None), ("RANK", None), ("LAG", "i"), ("FILL_DOWN", "t")):
            plain, split = (window(df, "w", calc, field, sorts=sorts, partitions=partitions, split=s) for s in (False, True))
            assert values(plain, "i", "w") == values(split, "i", "w"), (calc, partitions)


def test_forms_of_a_window_agree(rows):
    df = rows([(k % 3, i, float(i % 4)) for i, k in enumerate(range(60))], "k int, i int, v double")
    for calc, field in (("ROW_NUM", None), ("RANK", None), ("NTILE", None), ("LAG", "v"), ("LEAD", "v"), ("CUM_SUM", "v"), ("FILL_DOWN", "v")):
        forms = [window(df, "w", calc, field, sorts=[("v", "asc")], partitions=["k"], ntile=4, split=split) for split in (False, True)]
        assert forms[0].schema["w"].dataType == forms[1].schema["w"].dataType, calc
        assert values(forms[0], "i", "w") == values(forms[1], "i", "w"), calc
    for split in (False, True):
        with pytest.raises(ValueError):
            window(df, "w", "LAG", "v", sorts=[("v", "asc")], partitions=["k"], offset=0, split=split)


def test_split_windows_at_once_write_nothing(spark, rows, monkeypatch, tmp_path):
    """Several calculations, a key of a third of the rows, equal rows; no checkpoint, no range exchange."""
    monkeypatch.setattr(windows, "BLOCK_ROWS", 11)
    random.seed(8)
    data = [(i % 400, random.choice([0.5, 0.5, random.random(), None, float("nan")]), random.choice([None, "x", "yz"]), random.choice([None, 1, 2])) for i in range(1200)]
    rows(data, "i int, v double, s string, n bigint").repartition(7).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    calcs = [windows.Calc("rn", "ROW_NUM"), windows.Calc("run", "CUM_SUM", "n"), windows.Calc("down", "FILL_DOWN", "s"), windows.Calc("up", "FILL_DOWN", "s", back_fill=True),
             windows.Calc("lag", "LAG", "s", offset=2), windows.Calc("lead", "LEAD", "n", offset=3), windows.Calc("tile", "NTILE", ntile=7), windows.Calc("r", "RANK")]
    monkeypatch.setattr(windows, "cut_lineage", lambda df: pytest.fail("checkpoint"))
    for partitions in ([], ["s"]):
        plain, split = (windows.windows(df, calcs, [("v", "dsc"), ("i", "asc")], partitions, split=s) for s in (False, True))
        assert plain.dtypes == split.dtypes
        assert [repr(v) for v in values(plain)] == [repr(v) for v in values(split)]
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "ExistingRDD" not in plan
    assert windows.windows(df.limit(0), calcs[:1], [("i", "asc")], split=False).count() == 0


def test_split_windows_write_what_may_come_out_otherwise(spark, rows):
    """A computed sum of doubles, or random values, can't be cut into the same ranges twice."""
    df = rows([(i % 5, 0.1 * i) for i in range(50)], "k int, v double")
    assert windows._repeatable(df, ["k", "v"])
    summed = df.groupBy("k").agg(F.sum("v").alias("total"))
    assert windows._repeatable(summed, ["k"]) and not windows._repeatable(summed, ["total"])
    assert not windows._repeatable(df.withColumn("r", F.rand()), ["k"]) and not windows._repeatable(df.limit(3), ["k"])
    assert values(window(summed, "n", "ROW_NUM", sorts=[("total", "asc")]), "k", "n") == [(k, k + 1) for k in range(5)]


def test_ranges_are_even(spark):
    df = spark.range(0, 20_000, 1, 8).withColumn("v", F.hash("id").cast("double"))
    sizes = [r["count"] for r in windows._slices(df, [], [("v", "dsc")]).groupBy("__slice").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 3 * 20_000 / len(sizes)


def test_expand_beyond_the_broadcast_limit(rows, monkeypatch):
    main, small = rows([(1,), (2,)], "a int"), rows([(i,) for i in range(7)], "b int")
    want = values(joins.expand(main, small), "a", "b")
    monkeypatch.setattr(joins, "EXPAND_BROADCAST_ROWS", 3)
    beyond = joins.expand(main, small)
    assert values(beyond, "a", "b") == want and beyond.schema == joins.expand(main, small).schema


def test_infer_and_extract_free_every_batch(spark, rows):
    """A batch is gone before the next but one, even where an accessor refers back to it."""
    import weakref

    seen = []

    def kept(values):
        values.str.len()  # the accessor stays on the series, and the series on the accessor
        alive = sum(r() is not None for r in seen)
        seen.append(weakref.ref(values))
        return alive

    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "10")
    try:
        df = rows([(str(i),) for i in range(200)], "t string").coalesce(1)
        scored = inf.infer(df, "{{t}}", lambda s: s.map({}).fillna(str(kept(s)))).collect()
        found = inf.extract_documents(df, lambda d: d.assign(t=str(kept(d["t"]))), "t string").collect()
    finally:
        spark.conf.set(size, before)
    assert len(scored) == len(found) == 200
    assert max(int(r["AI Answer"]) for r in scored) <= 1
    assert max(int(r["t"]) for r in found) <= 1


def test_infer_scores_every_row_once(rows):
    df = rows([(i, i % 2) for i in range(12)], "i int, k int")
    out = inf.infer(df, "{{i}}", lambda s: s, row_limit=5, order=[("k", "asc")])
    assert values(out, "i", "AI Answer") == sorted([(i, str(i) if i % 2 == 0 and i < 10 else None) for i in range(12)], key=repr)
    assert inf.infer(df, "{{i}}", lambda s: s).filter("`AI Answer` IS NULL").count() == 0
    with pytest.raises(ValueError):
        inf.call_api(df, "http://x", lambda *a: (200, ""), method="FETCH")


def test_repeated_keys_are_not_called_equal(rows):
    base = rows([("a", 5.0, "x"), ("a", 7.0, "y"), ("b", 1.0, "a"), ("b", 1.0, "b"), ("b", 1.0, "d"), ("c", 1.0, "z")], "k string, v double, t string")
    new = rows([("a", 6.0, "y"), ("a", 6.0, "x"), ("b", 1.0, "a"), ("b", 1.0, "c"), ("b", 1.0, "d"), ("c", 1.0, "z")], "k string, v double, t string")
    got = {r.k: r.status for r in compare.compare_tables(base, new, ["k"], ["v"], ["t"]).collect()}
    assert got == {"A": "repeated key", "B": "differs", "C": "equal"}
    assert {r.k: r.status for r in compare.compare_tables(base, base, ["k"], [], ["t"]).collect()} == {"A": "equal", "B": "equal", "C": "equal"}


def test_reconcile_below_a_cent(rows):
    day = dt.date(2024, 1, 2)
    a = rows([(1, day, 10.005), (2, day, 20.004)], "i int, d date, v double")
    b = rows([(7, day, 10.0249), (8, day, 20.009)], "i int, d date, v double")
    side = rec.Side("i", "d", "v")
    pairs = lambda tolerance: values(rec.match_lines(a, b, side, side, rec.Settings(tolerance, 0, 1.0)), "a_id", "b_id")
    assert pairs(0.01) == [(2, 8)] and pairs(0.005) == [(2, 8)] and pairs(0.0199) == [(1, 7), (2, 8)] and pairs(0.004) == []


def test_containment_with_one_shared_beginning(rows):
    texts = [f"invoice {i:05d} of the year" for i in range(400)]
    left, right = rows([(t,) for t in texts] + [("short x",), (None,)], "w string"), rows([(f"invoice {i:05d}",) for i in range(0, 400, 2)] + [("x",), (" ",), ("t x",), (None,)], "p string")
    got = joins.contained_pairs(left, right)
    want = {(w, p) for w in [*texts, "short x"] for p in [f"invoice {i:05d}" for i in range(0, 400, 2)] + ["x", "t x"] if p in w}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


@pytest.mark.parametrize("few", [(256, 100_000), (0, 100_000), (0, 0)])
def test_containment_moves_no_text_for_each_piece(rows, monkeypatch, few):
    written, cut = [], joins.cut_lineage
    monkeypatch.setattr(joins, "FEW_PARTS", few[0])
    monkeypatch.setattr(joins, "FEW_PROBES", few[1])
    monkeypatch.setattr(joins, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    texts = [f"order {i:04d} of the year, item {i % 7} of a long list" for i in range(300)]
    parts = [f"order {i:04d}" for i in range(0, 300, 3)] + ["item 3 of", "year", "none of these", " "]
    left, right = rows([(t,) for t in [*texts, texts[0], None]], "t string"), rows([(p,) for p in [*parts, None]], "p string")
    want = sorted((t, p) for t in [*texts, texts[0]] for p in parts if p.strip() and p in t)
    assert sorted(map(tuple, joins.blend(left, right, [On("t", "contains", "p")]).collect())) == want
    forks = joins.blend_forks(right, left, [On("p", "is_part_of", "t")])
    assert sorted(map(tuple, forks.matched.select("t", "p").collect())) == want
    assert {r[0] for r in forks.left_only.collect()} == {"none of these", " ", None} and [r[0] for r in forks.right_only.collect()] == [None]
    assert not any("whole" in columns for columns in written)


@pytest.mark.parametrize("threshold", [0.8, 0.6])
def test_fuzzy_match_broadcasts_no_keys(rows, monkeypatch, threshold):
    """Keys are many times the table they come from, which is what Spark estimates them by."""
    monkeypatch.setattr(fuzzy, "BUSY_PAIRS", 2)
    written, cut = [], fuzzy.cut_lineage
    monkeypatch.setattr(fuzzy, "cut_lineage", lambda df: written.append(df) or cut(df))
    names = ["Acme Corp", "Acme Korp", "Acme Corp of the north and of the south and of the east", "Zeta", "Acme Corp of the north and of the south and of the eats"]
    left, right = rows([(n,) for n in names], "name string"), rows([(n, i) for i, n in enumerate(names)], "typed string, n int")
    out = fuzzy.fuzzy_match(left, right, "name", "typed", threshold)
    assert out.count() == 9
    for df in [*written, out]:
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_join_candidates_deal_values_not_columns(rows, spark, monkeypatch):
    """No shuffle brings all values of a column to one task, and no spellings are broadcast."""
    written, cut = [], relationships.cut_lineage
    monkeypatch.setattr(relationships, "cut_lineage", lambda df: written.append(df) or cut(df))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    left, right = rows([(i, f"C#{i:05d}") for i in range(50)], "`Customer ID` int, `Ref ID` string"), rows([(i % 40, 5) for i in range(60)], "`Customer ID` int, n int")
    assert relationships.join_candidates({"a": left, "b": right}).count() == 1
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in written if "spelling" in df.columns]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        written.clear()
        relationships.join_candidates({"a": left, "b": right})
        plans += [df._jdf.queryExecution().executedPlan().toString() for df in written if "spelling" in df.columns]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(plans) == 2 and not any("SortMergeJoin" in plan for plan in plans)


def test_shuffles_have_partitions_by_input(spark, tmp_path, monkeypatch):
    """Twice the files, twice the partitions a shuffle starts with; a larger number of the session stays."""
    from query_catalog.registry import Tables
    from tallyframe import session

    path = f"{tmp_path}/orders.parquet"
    spark.range(40_000).select(F.rand(1).alias("x")).coalesce(1).write.parquet(path)
    once = sum(p.stat().st_size for p in tmp_path.glob("orders.parquet/*.parquet"))
    monkeypatch.setattr(session, "INPUT_BYTES", once // 50)
    kept = spark.conf.get(session.INITIAL, None)
    try:
        spark.conf.unset(session.INITIAL)
        grouped = Tables(spark, str(tmp_path)).orders.groupBy("x").count()
        first = int(spark.conf.get(session.INITIAL))
        assert 50 <= first <= 52
        assert "hashpartitioning(x#" in (plan := grouped._jdf.queryExecution().executedPlan().toString()) and f", {first})" in plan
        spark.range(40_000).select(F.rand(2).alias("x")).coalesce(1).write.mode("append").parquet(path)
        Tables(spark, str(tmp_path)).orders  # noqa: B018
        assert 2 * 50 <= int(spark.conf.get(session.INITIAL)) <= 2 * 52
        spark.conf.set(session.INITIAL, "1000")
        Tables(spark, str(tmp_path)).orders  # noqa: B018
        assert spark.conf.get(session.INITIAL) == "1000"
    finally:
        spark.conf.set(session.INITIAL, kept) if kept else spark.conf.unset(session.INITIAL)


def test_cells_of_both_sides_take_one_aggregate(rows, monkeypatch):
    """A task that holds the cells of a ledger holds them once."""
    schema = "id long, day date, amount double"
    a = rows([(1, dt.date(2024, 1, 1), 5.0), (2, dt.date(2024, 1, 1), 5.0), (3, dt.date(2024, 1, 2), 7.0)], schema)
    b = rows([(9, dt.date(2024, 1, 1), 5.0), (8, dt.date(2024, 1, 2), 8.0)], schema)
    plans = []
    cut = rec.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return cut(df)

    monkeypatch.setattr(rec, "cut_lineage", seen)
    side = Side("id", "day", "amount", [])
    pairs = rec.match_lines(a, b, side, side, Settings(0, 0, 0))
    assert [tuple(r)[:2] for r in pairs.collect()] == [(1, 9)]
    assert plans[0].count("Aggregate [") == 1


def test_lines_without_a_partner_are_dealt_out(spark):
    """A full join's tasks are never split, and a line that matches nothing has no id of the other side to go by."""
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    kept = spark.conf.get(coalesce)
    line = lambda ids: ids.select("id", F.lit(dt.date(2024, 1, 1)).alias("day"), (F.col("id") * 10.0).alias("amount"))
    side, settings = Side("id", "day", "amount", ["id"]), Settings(0, 0, 1.0)
    try:
        spark.conf.set(coalesce, "false")
        items = rec.reconcile(line(spark.range(4000)), line(spark.range(3900, 4100)), side, side, settings)
        got = items.select("source", "a_id", "b_id", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set(coalesce, kept)
    assert sorted(r.a_id for r in got if r.source == "Side A") == list(range(3900))
    assert sorted((r.a_id, r.b_id) for r in got if r.source == "Both") == [(i, i) for i in range(3900, 4000)]
    assert sorted(r.b_id for r in got if r.source == "Side B") == list(range(4000, 4100))
    alone = Counter(r.task for r in got if r.source == "Side A")
    assert max(alone.values()) < 2 * 3900 / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_split_windows_have_ranges_by_input(spark):
    """The ranges a whole table is numbered in grow with the partitions its input calls for, not only with the session's."""
    from tallyframe import session

    kept, parts = spark.conf.get(session.INITIAL, None), int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("x"))
    try:
        spark.conf.set(session.INITIAL, str(5 * parts))
        wide = windows.RANGES_PER_PARTITION * 5 * parts
        assert 0.8 * wide < windows._slices(df, [], [("x", "asc")]).agg(F.countDistinct("__slice")).first()[0] <= wide
        numbered = window(df, "n", "ROW_NUM", sorts=[("x", "asc")]).collect()
    finally:
        spark.conf.set(session.INITIAL, kept) if kept else spark.conf.unset(session.INITIAL)
    assert len(numbered) == 20_000 and all(r.n == r.x + 1 for r in numbered)


def test_tune_bounds_what_a_task_gets(spark):
    """Spark's own 64 MB a task become 16; a session's other choice stays."""
    from tallyframe.session import ADVISORY, tune

    kept = spark.conf.get(ADVISORY)
    try:
        spark.conf.unset(ADVISORY)
        assert tune(spark).conf.get(ADVISORY) == "16m"
        spark.conf.set(ADVISORY, "8m")
        assert tune(spark).conf.get(ADVISORY) == "8m"
    finally:
        spark.conf.set(ADVISORY, kept)


def test_pairs_of_small_tables_form_in_many_tasks(spark):
    """Two tables of one file each: the join's pairs are dealt over all shuffle partitions."""
    left = spark.range(0, 2000, 1, 1).selectExpr("id AS i", "CAST(id AS double) AS a", "id % 50 AS b")
    right = spark.range(0, 2000, 1, 1).selectExpr("id AS j", "CAST(id AS double) AS c", "c + id % 7 AS hi", "id % 50 AS d")
    found = {
        "tolerance": joins.tolerance_join(left, right, amount=("a", "c", 3)),
        "interval": joins.blend(left, right, [On("a", "ge", "c"), On("a", "le", "hi")]),
        "inequalities": joins.blend(left, right, [On("a", "ge", "c"), On("b", "lt", "d")]),
    }
    for name, df in found.items():
        assert df.select(F.spark_partition_id()).distinct().count() > 1, name


@pytest.mark.parametrize("name", ["read_json_text", "read_xml_text"])
def test_written_documents_hold_many_conversations(spark, monkeypatch, name):
    from query_catalog import QUERIES, columns

    read, seen = getattr(columns.readers, name), []
    monkeypatch.setattr(columns.readers, name, lambda *a, **k: seen.append(read(*a, **k)) or seen[-1])
    rows = QUERIES[name](spark, "/root/testdata/sf0.01")
    assert rows.count() == 536 and rows.select("conv_id").distinct().count() == 100
    assert seen[0].count() == 1
