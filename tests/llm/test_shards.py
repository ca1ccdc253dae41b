import zlib
from collections import Counter

import cases
import numpy as np
import pytest

from tallyframe.llm import shards


def check(got, texts, ids, count):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True))
    sizes = Counter(r.shard for r in got)
    for s in range(count):
        assert sizes[s] in (len(texts) // count, -(-len(texts) // count))
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))


@pytest.mark.parametrize("groups", [1, 2, 4096])
def test_exact_sizes(spark, monkeypatch, groups):
    monkeypatch.setattr(shards, "MAX_GROUPS", groups)
    monkeypatch.setattr(shards, "BLOCK_ROWS", 7)
    texts = cases.AWKWARD * 9
    ids = cases.AWKWARD_IDS * 9
    table = cases.docs(spark, texts, ids, partitions=5)
    check(shards.shard(table, 4).collect(), texts, ids, 4)


def test_fewer_rows_than_shards_and_none(spark):
    check(shards.shard(cases.docs(spark, ["a", "b"]), 5).collect(), ["a", "b"], [0, 1], 5)
    assert shards.shard(cases.empty(spark), 5).count() == 0


def test_matrix_margins():
    rows = {0: 700, 1: 0, 2: 299, 3: 2}
    blocks = shards.even(1001, 6)
    drawn = shards.matrix(rows, blocks, 1)
    assert {p: int(x.sum()) for p, x in drawn.items()} == rows
    assert (sum(drawn.values()) == blocks).all()


def test_draws_follow_the_hypergeometric_law():
    left = np.array([30, 50, 20])
    first = np.array([shards.draw(np.random.default_rng(i), left, 10) for i in range(4000)])
    assert np.allclose(first.mean(axis=0), 10 * left / 100, atol=0.1)
    variance = 10 * (left / 100) * (1 - left / 100) * (90 / 99)
    assert np.allclose(first.var(axis=0), variance, rtol=0.1)
    large = np.array([600_000_000, 900_000_000])
    assert abs(shards.draw(np.random.default_rng(1), large, 100_000)[0] - 40_000) < 800


def test_places_are_uniform(spark):
    """Over seeds, rows of one partition reach every shard and slot alike."""
    table = spark.range(0, 40, 1, 4).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    places = Counter()
    for seed in range(12):
        for r in shards.shard(table, 4, seed=seed).filter("doc_id < 10").collect():
            places[r.shard] += 1
    assert sum(places.values()) == 120 and min(places.values()) > 12 and max(places.values()) < 50


def test_large_draws_follow_the_same_law(monkeypatch):
    """Beyond NumPy's limit: its numbers where both work, the law's moments where only the other does."""
    monkeypatch.setattr(shards, "LIMIT", 0)
    for good, bad, rows in ((5, 9, 6), (40, 3, 20), (300, 700, 250), (1, 1, 1), (7, 0, 3), (4, 4, 8)):
        found = Counter(shards.hypergeometric(np.random.default_rng([good, i]), good, bad, rows) for i in range(3000))
        wanted = Counter(np.random.default_rng(1).hypergeometric(good, bad, rows, 60_000).tolist())
        assert all(abs(found[k] / 3000 - wanted[k] / 60_000) < 0.04 for k in {*found, *wanted})
    good, bad, rows = 3 * 10**11, 7 * 10**11, 10**9
    large = np.array([shards.hypergeometric(np.random.default_rng(i), good, bad, rows) for i in range(2000)], dtype=float)
    variance = rows * 0.3 * 0.7 * (good + bad - rows) / (good + bad - 1)
    assert abs(large.mean() - 0.3 * rows) < 5 * (variance / 2000) ** 0.5 and abs(large.var() / variance - 1) < 0.15
    left = np.full(96, 10**10)
    taken = shards.draw(np.random.default_rng(3), left, 10**8)
    assert taken.sum() == 10**8 and abs(taken - 10**8 / 96).max() < 6 * (10**8 / 96) ** 0.5
