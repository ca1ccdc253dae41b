from collections import defaultdict

import cases
import numpy as np
import pytest

from tallyframe.llm import jaccard_join
from tallyframe.llm.jaccard_join import Tree, signature
from tallyframe.llm.shingles import shingle_sets, word_hashes


def corpus(seed=3):
    """Groups of near copies of several sizes, a passage that many unrelated texts share, copies and odd texts."""
    draws = np.random.default_rng(seed)
    vocabulary = np.array([f"w{i}" for i in range(4000)])
    texts = []
    for size, length in ((60, 80), (9, 300), (5, 12), (30, 41), (2, 1500), (4, 6)):
        stem = draws.choice(vocabulary, length)
        for _ in range(size):
            copy = stem.copy()
            edits = draws.integers(0, max(2, length // 25))
            copy[draws.integers(0, length, edits)] = draws.choice(vocabulary, edits)
            cut = draws.integers(0, max(1, length // 20))
            texts.append(" ".join(copy[cut:]))
    license_line = " ".join(draws.choice(vocabulary, 30))
    texts += [license_line + " " + " ".join(draws.choice(vocabulary, draws.integers(2, 60))) for _ in range(70)]
    texts += [texts[0].upper(), texts[1], texts[1], "a b c", "A b  c", "a b", "", None]
    return texts


def check(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    groups = cases.similar(texts)
    least = defaultdict(list)
    for g, i in zip(groups, ids, strict=True):
        least[g].append(i)
    want = [(i, len(cases.shingles(t)), i if not cases.shingles(t) else min((x for x in least[g] if x is not None), default=None)) for i, t, g in zip(ids, texts, groups, strict=True)]
    got = jaccard_join.similar_components(cases.docs(spark, texts, ids))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("frequent", [False, True])
def test_every_link_is_found(spark, monkeypatch, frequent):
    """With a low limit for frequent shingles, and small blocks, all ways through the buckets are taken."""
    if frequent:
        monkeypatch.setattr(jaccard_join, "BLOCK", 8)
        monkeypatch.setattr(jaccard_join, "SALTS", 3)
        plain = jaccard_join.Order.level

        def level(self, hashes):
            self.limit = 3
            return plain(self, hashes)

        monkeypatch.setattr(jaccard_join.Order, "level", level)
    check(spark, corpus())


def test_awkward_rows(spark):
    check(spark, cases.AWKWARD, cases.AWKWARD_IDS)


def test_exact_threshold(spark):
    """Eight shared of ten shingles link; one less does not."""
    def text(shared, own, tag):
        return " ".join([f"s{i}" for i in range(shared + 4)] + [f"{tag}{i}" for i in range(own)])

    # sets of 9 with 8 shared: 8 of 10; sets of 9 and 10 with 8 shared: 8 of 11
    check(spark, [text(8, 1, "a"), text(8, 1, "b"), text(8, 2, "c")])


def test_empty_and_dropping(spark):
    assert jaccard_join.similar_components(cases.empty(spark)).count() == 0
    texts = corpus(5)[:75]
    table = cases.docs(spark, texts)
    out = jaccard_join.drop_similar(table)
    groups = cases.similar(texts)
    assert out.schema == table.schema
    assert sorted(r.doc_id for r in out.collect()) == sorted(min(i for i, g in enumerate(groups) if g == k) for k in set(groups))


def test_one_row_of_a_component_stays_whatever_its_ids(spark):
    near = [f"{' '.join(f'w{i}' for i in range(60))} end{k}" for k in range(3)]
    texts = [*near, near[0], near[0], "another text of seven words stands here", "no", "", "", None]
    for ids in ([None] * 10, [7] * 10, [None, 4, 4, 4, 4, 4, None, 4, 4, None]):
        left = jaccard_join.drop_similar(cases.docs(spark, texts, ids)).collect()
        assert sum("end" in (r.text or "") for r in left) == 1 and len(left) == 6
        assert {r.doc_id for r in left if "end" in (r.text or "")} <= {ids[1]}


@pytest.mark.parametrize("limits", [(2048, 1_000_000, 1 << 16), (16, 1_000_000, 64), (2048, 3000, 1 << 16)])
def test_close_texts_leave_a_bucket_as_a_forest(spark, monkeypatch, limits):
    """Texts that are near but seldom similar, with one passage in common: few rows leave the trees."""
    for name, limit in zip(("BLOCK", "BLOCK_SHINGLES", "MAX_WIDTH"), limits, strict=True):
        monkeypatch.setattr(jaccard_join, name, limit)
    draws = np.random.default_rng(8)
    stem = [f"w{i}" for i in range(60)]
    texts = [" ".join(w if i < 14 or draws.random() > 0.02 else f"x{draws.integers(9**9)}" for i, w in enumerate(stem)) for _ in range(150)]
    made = []
    plain = jaccard_join._by_unit

    def pairs(*args):
        made.append(plain(*args))
        return made[-1]

    monkeypatch.setattr(jaccard_join, "_by_unit", pairs)
    check(spark, texts)
    # the second trees hold every class once, for each block and neighbouring level
    assert made[1].count() < 3 * len(texts) * (1 if limits[0] > 16 else 10)


def test_folded_signatures_bound_the_overlap(monkeypatch):
    draws = np.random.default_rng(2)
    sets = [np.unique(draws.choice(400, 90)).astype(np.uint64) for _ in range(12)]
    for width in (1 << 16, 64):
        monkeypatch.setattr(jaccard_join, "MAX_WIDTH", width)
        bits, slack = jaccard_join.exact_signatures(sets)
        for i, x in enumerate(sets):
            for j in range(i):
                real, seen = len(np.intersect1d(x, sets[j])), int(np.bitwise_count(bits[i] & bits[j]).sum())
                assert jaccard_join.overlap(x, sets[j]) == real <= seen + min(slack[i], slack[j])
                assert width == 64 or (real == seen and not slack.any())


def test_tree_loses_no_pair():
    draws = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        stem = draws.integers(0, 2**63, 60, dtype=np.uint64)
        for _ in range(8):
            sets.append(np.unique(np.where(draws.random(60) < draws.random() * 0.15, draws.integers(0, 2**63, 60, dtype=np.uint64), stem)))
    sets.sort(key=len)
    words = [jaccard_join.folded(signature(s), min(len(signature(x)) for x in sets)) for s in sets]
    tree = Tree(np.stack(words), np.array([len(s) for s in sets]))
    assert len(tree.levels) > 1
    found = {(int(i), int(j)) for a, b, _ in tree.pairs() for i, j in zip(a, b, strict=True)}
    linked = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (len(sets[i]) + len(sets[j]))}
    assert len(linked) > 200 and linked <= found
    assert len(found) < 4 * len(linked) + 500  # most other pairs are pruned


def test_hashes_follow_the_words():
    texts = ["", "a", "A b", "É e", " x\ty\x0bz\n", "one two three four five six", "one two three four five", "long " * 300_000, "x"]
    for text, (words, starts, ends) in zip(texts, word_hashes(texts), strict=True):
        raw = text.encode()
        assert [raw[s:e].decode().translate(cases.LOWER) for s, e in zip(starts, ends, strict=True)] == cases.words(text)
        assert len(set(words.tolist())) == len(set(cases.words(text)))
    sizes = [len(s) for s in shingle_sets(texts)]
    assert sizes == [len(cases.shingles(t)) for t in texts]
