import hashlib
from collections import defaultdict

import cases
import pytest

from tallyframe.llm import common, exact_dedup


def check(spark, texts, ids):
    groups = defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        groups[(t or "").translate(cases.LOWER)].append(i)
    got = exact_dedup.exact_groups(cases.docs(spark, texts, ids)).collect()
    assert len(got) == len(texts)
    by_sha = defaultdict(list)
    for r in got:
        by_sha[r.text_sha256].append(r)
    assert len(by_sha) == len(groups)
    for text, members in groups.items():
        rows = by_sha[hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in members if i is not None]
        assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(map(repr, members))
        assert {r.keep_id for r in rows} == {max(known, default=None)}
        assert {r.group_size for r in rows} == {len(members)}
        kept = [r for r in rows if r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id


def test_awkward_rows(spark):
    check(spark, cases.AWKWARD, cases.AWKWARD_IDS)


def test_large_groups_take_the_broadcast_way(spark, monkeypatch):
    monkeypatch.setattr(common, "MAX_HOT_GROUPS", 1)
    texts = ["same"] * 1200 + [f"pair {i // 2}" for i in range(100)] + [f"alone {i}" for i in range(100)]
    check(spark, texts, list(range(len(texts))))


@pytest.mark.parametrize("bits", [common.BUCKET_BITS, 1 << 20])
def test_false_hits_change_nothing(spark, monkeypatch, bits):
    """A filter that is far too small sends rows through the shuffle and gives the same rows."""
    monkeypatch.setattr(exact_dedup, "filter_bits", lambda rows: 64 if bits == common.BUCKET_BITS else bits)
    texts = [f"t{i % 150}" for i in range(200)]
    check(spark, texts, list(range(200)))


def test_few_rows_are_suspects(spark):
    rows = spark.range(20000).selectExpr("cast(id AS string) AS key")
    bits = common.filter_bits(20000)
    marked = exact_dedup.repeated_cells(rows, "key", bits)
    from pyspark.sql import functions as F

    hits = common.with_filter_hit(rows, marked, F.col("key"), bits, exact_dedup.HASHES, "hit").filter("hit").count()
    assert hits < 0.03 * 20000


def test_dropping_keeps_columns(spark):
    table = cases.docs(spark, cases.AWKWARD, cases.AWKWARD_IDS)
    out = exact_dedup.drop_exact_copies(table)
    assert out.schema == table.schema
    left = [(t or "").translate(cases.LOWER) for (t,) in out.select("text").collect()]
    assert sorted(left) == sorted({(t or "").translate(cases.LOWER) for t in cases.AWKWARD})
    assert {r.doc_id for r in out.collect() if r.text == "one two three four five six"} == {6}
    assert {r.doc_id for r in out.collect() if r.text in ("one", "One")} == {5}
    assert {r.doc_id for r in out.collect() if r.text == cases.LONG} == {8}


def test_empty(spark):
    assert exact_dedup.exact_groups(cases.empty(spark)).count() == 0
    assert exact_dedup.drop_exact_copies(cases.empty(spark)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (500, 400)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 400: 400, 500: 400}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_rows(spark):
    table = cases.docs(spark, ["t"] * 300, [i % 100 if i else None for i in range(300)])
    gone = spark.createDataFrame([(i,) for i in range(0, 100, 7)] + [(None,)], "k long")
    left = common.without_rows(table, "doc_id", gone)
    assert left.columns == table.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i % 100 for i in range(1, 300) if i % 100 % 7)
