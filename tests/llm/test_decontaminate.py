from collections import Counter, defaultdict
from itertools import combinations

import cases
import numpy as np
import pytest
import regex

from tallyframe.llm import decontaminate as d

DRAWS = np.random.default_rng(11)
VOCABULARY = np.array([f"v{i}" for i in range(3000)])


def split(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def stretch(same, least):
    """(first, words, equal) of the stretch of at least so many places with the best balance, none below zero; by trying all."""
    sums = np.concatenate(([0], np.cumsum(np.where(same, 1, -d.COST))))
    found = [(sums[j] - sums[i], -j, i) for j in range(least, len(sums)) for i in range(j - least + 1) if sums[j] >= sums[i]]
    if not found:
        return None
    _, end, start = max(found)
    return start, -end - start, int(np.sum(same[start:-end]))


def brute(docs, items):
    """The best overlap of every document and item by the stated definition, at any offset."""
    best = {}
    for item, y in items:
        y = split(y)
        least = min(d.LEAST_WORDS, len(y))
        places = defaultdict(list)
        for j, w in enumerate(y):
            places[w].append(j)
        for doc, x in docs:
            x = split(x)
            equal_at = Counter(i - j for i, w in enumerate(x) for j in places.get(w, ()))
            for s, count in equal_at.items():
                if 5 * count < 4 * least or (len(y) < d.SPAN and count < len(y)):
                    continue
                low = max(0, -s)
                found = stretch(np.array([x[k + s] == y[k] for k in range(low, min(len(y), len(x) - s))]), least)
                if found:
                    f, n, equal = found
                    best[doc, item] = max(best.get((doc, item), (0,)), (equal, n, -(low + s + f), -(low + f)))
    return best


def fixture():
    items = [(i, " ".join(DRAWS.choice(VOCABULARY, n))) for i, n in enumerate([40, 25, 13, 12, 8, 3, 60])]
    docs = []
    for i, text in items:
        for edits in (0, 1, 2, 4, 10):
            words = text.split()
            for k in DRAWS.choice(len(words), min(edits, len(words)), replace=False):
                words[k] = "other"
            docs.append(" ".join(DRAWS.choice(VOCABULARY, 30)) + ". " + " ".join(words).upper() + "! " + " ".join(DRAWS.choice(VOCABULARY, 30)))
        docs.append(" ".join(text.split()[: len(text.split()) // 2]))
    docs += [" ".join(DRAWS.choice(VOCABULARY, 400)) for _ in range(20)] + cases.AWKWARD
    items += [(90, None), (91, ""), (92, "..."), (93, items[0][1]), (93, items[0][1])]
    return docs, items


@pytest.mark.parametrize("limit", [d.BROADCAST_ROWS, 0])
def test_against_brute_force(spark, monkeypatch, limit):
    """Also with a benchmark that is too large to broadcast."""
    monkeypatch.setattr(d, "BROADCAST_ROWS", limit)
    docs, items = fixture()
    table = cases.docs(spark, docs)
    bench = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, doc_id int, words string")
    got = {(r.doc_id, r.item_id): (r.n_equal, r.n_words, -r.doc_word, -r.item_word) for r in d.overlaps(table, bench).collect()}
    want = brute(list(enumerate(docs)), items)
    assert got == want
    # whole passages with up to two substituted words are found
    caught = Counter(doc // 6 for doc, _ in want if doc < 42 and doc % 6 < 3)
    assert all(caught[k] >= 3 for k in (0, 1, 6))
    clean = d.clean(table, bench)
    assert clean.columns == table.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(docs))) - {doc for doc, _ in want}


def test_a_rows_own_text_decides(spark):
    """Without an id, or with the id of another row."""
    item = " ".join(VOCABULARY[:40])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    texts = [item, f"so {item}", "another text", None, item, "its own text"]
    for ids in ([None] * 6, [3] * 6):
        left = d.clean(cases.docs(spark, texts, ids), bench).collect()
        assert sorted(map(str, (r.text for r in left))) == ["None", "another text", "its own text"]


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, " ".join(VOCABULARY[:40]))], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    docs = cases.docs(spark, [" ".join(VOCABULARY[:40]), None])
    assert d.overlaps(docs, none).count() == 0 and d.overlaps(cases.empty(spark), bench).count() == 0
    assert d.clean(docs, none).count() == 2 and [r.doc_id for r in d.clean(docs, bench).collect()] == [1]


def test_no_python_in_the_plan(spark):
    plan = d.overlaps(cases.docs(spark, ["a b"]), spark.createDataFrame([(1, "x")], "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def defined(x, y):
    """Whether two word lists overlap by the definition: any offset, any stretch of 13 words or a whole shorter item, four in five equal."""
    least = min(d.LEAST_WORDS, len(y))
    for s in range(-len(y) + 1, len(x)):
        low = max(0, -s)
        sums = np.concatenate(([0], np.cumsum([1 if x[k + s] == y[k] else -d.COST for k in range(low, min(len(y), len(x) - s))])))
        if any(sums[j] >= sums[: j - least + 1].min() for j in range(least, len(sums))):
            return True
    return False


def test_short_items_with_substituted_words(spark):
    """Every item of 13 to 25 words with a fifth substituted, wherever; adjacent ones too. One word more is no overlap of the whole."""
    draws = np.random.default_rng(2)
    items, docs = [], []
    for n in range(13, 26):
        item = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        at = draws.integers(0, n - 1)
        for changed in [[0], [n - 1], [n // 2], [at, at + 1], [1, n - 2], *[draws.choice(n, n // 5, replace=False) for _ in range(4)], range(0, n, 4)]:
            docs.append(" ".join(["before", *(f"o{k}" if k in set(changed) else w for k, w in enumerate(item)), "behind"]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in d.overlaps(cases.docs(spark, docs), bench).collect()}
    want = {(i, n) for i, x in enumerate(docs) for n, y in items if f"i{n}w" in x and defined(x.split(), y.split())}
    assert set(got) == want and len(want) > 100
    assert all(5 * r.n_equal >= 4 * r.n_words and r.n_words >= d.LEAST_WORDS for r in got.values())


def test_masks_fit_every_choice_of_substituted_words():
    masks = [sum(1 << p for p in m) for m in d.MASKS]
    for n in range(d.SPAN, 21):
        free = [m << at for m in masks for at in range(n - d.SPAN + 1)]
        for changed in combinations(range(n), n // 5):
            bits = sum(1 << k for k in changed)
            assert any(not m & bits for m in free), (n, changed)
