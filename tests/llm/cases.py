"""Awkward rows and brute-force versions that the tests of this folder share."""

import re
import string

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, row long, size long, kept boolean, cls string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def docs(spark, texts, ids=None, partitions=3):
    """A table of documents with the columns of ``documents`` and others whose names the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", None if n % 5 == 4 else f"src{n % 3}", None, "x", 7, 0, None, "c") for n, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


LONG = "lorem ipsum dolor sit amet " * 8000
AWKWARD = [None, "", " \t\n", "one", "One", "one two three four five six", "one two three four five six", LONG, LONG, "École école", "école école", "a" * 5000, "x y \U0001f600 z", None]
AWKWARD_IDS = [1, 2, 3, 4, 5, 6, 6, None, 8, 9, 10, 2**62, 12, None]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, width=5):
    w = words(text)
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def similar(texts):
    """Component number of every text, by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(texts))]
