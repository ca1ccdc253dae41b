import hashlib
from collections import defaultdict

import __spark_entry__ as entry
import cases
import numpy as np
import oracle
import pytest

from tallyframe.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"
FOLDER = "/root/testdata/sf0.001"


def brute(rows, least_chars=40, least_docs=5):
    """(kept text, lines, dropped) of each (id, text); a null id is the smallest."""
    rank = lambda i: (i is not None, i or 0)
    key = lambda line: line.strip(BLANK).translate(cases.LOWER)
    holders = defaultdict(list)
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(rank(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(k := key(x)) >= least_chars and len(holders[k]) >= least_docs and max(holders[k]) != rank(i) for x in lines]
        out.append((i, "\n".join(x for x, g in zip(lines, gone, strict=True) if not g), len(lines), sum(gone)))
    return out


def fixture():
    draws = np.random.default_rng(4)
    common = [f"a line number {k} that many documents hold, some of them twice" for k in range(30)]
    common += ["Ünïcode lines äre compared by cöde points, not by bytes", "x" * 40, "y" * 39, "  \t" + "z" * 40 + " \r", "É" * 40, "é" * 40]
    texts = []
    for i in range(120):
        lines = [str(x) for x in draws.choice(common, 6)] + [f"its own line {i} with more than forty characters in it", ""]
        lines = [x.upper() if x.isascii() and draws.random() < 0.2 else "\x0b " + x + "\t" if draws.random() < 0.2 else x for x in lines]
        draws.shuffle(lines)
        texts.append("\n".join(lines))
    ids = [int(x) for x in draws.permutation(120)]
    # in three documents of a group of five, and a hot line in all
    texts = [t + "\nthe very same last line of every document of this table" for t in texts]
    return texts + cases.AWKWARD * 3, ids + cases.AWKWARD_IDS * 3


def got(table, **options):
    return [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_repeated_lines(table, **options).collect()]


@pytest.mark.parametrize("limits", [(2_000_000, 100_000, 100_000), (2_000_000, 100_000, 3), (0, 4, 3), (0, 100_000, 2), (0, 1, 100_000)])
def test_against_brute_force(spark, monkeypatch, limits):
    """With all shards broadcast, many small shards, and most keys sent to the shards."""
    for name, limit in zip(("BROADCAST_KEYS", "HOT_KEYS", "SHARD_KEYS"), limits, strict=True):
        monkeypatch.setattr(line_dedup, name, limit)
    texts, ids = fixture()
    found = sorted(got(cases.docs(spark, texts, ids)), key=repr)
    want = sorted(brute(list(zip(ids, texts, strict=True))), key=repr)
    assert found == want and sum(x[3] for x in want) > 300


def test_columns_and_empty_tables(spark):
    table = cases.docs(spark, cases.AWKWARD, cases.AWKWARD_IDS)
    out = line_dedup.drop_repeated_lines(table, counts=("lines", "gone"))
    assert out.columns == [*table.columns, "lines", "gone"] and out.dtypes[:-2] == table.dtypes
    assert line_dedup.drop_repeated_lines(cases.empty(spark)).count() == 0
    named = spark.createDataFrame([("b", "l" * 50, 1)] * 5 + [("c", "l" * 50, 2)], "key string, shard string, print int")
    kept = line_dedup.drop_repeated_lines(named, "key", "shard").collect()
    assert sorted((r.key, r.shard, r.n_dropped) for r in kept) == [("b", "", 1)] * 5 + [("c", "l" * 50, 0)]


def test_slots_are_minimal_and_perfect():
    draws = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 64, 65, 50_000):
        keys = np.unique(draws.integers(0, 2**64, n, dtype=np.uint64))
        slots = line_dedup.PerfectHash.of(keys).slots(keys)
        assert sorted(slots.tolist()) == list(range(len(keys)))
    built = line_dedup.Shard(*line_dedup.Shard.built(keys, keys + np.uint64(7), np.arange(len(keys)), np.arange(len(keys)) - 5))
    found, keepers = built.probe(keys, keys + np.uint64(7))
    assert found.all() and (keepers == np.arange(len(keys)) - 5).all()
    others = draws.integers(0, 2**64, 10_000, dtype=np.uint64)
    assert not built.probe(others, others + np.uint64(7))[0].any() and not built.probe(keys, keys)[0].any()
    # the levels' bitmaps take a few bits a key
    assert sum(len(x) for x in line_dedup.PerfectHash.of(keys).levels) * 64 < 6 * len(keys)


def test_query(spark):
    name = "op11_perfect_hash_lines"
    assert oracle.differences(entry.queries()[name](spark, FOLDER), oracle.duck(FOLDER), entry.oracle_sql()[name]) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in brute(rows)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in entry.queries()[name](spark, FOLDER).collect()} == want
