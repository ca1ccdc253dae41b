import hashlib
import math
import re
import zlib
from collections import Counter

import __spark_entry__ as entry
import cases
import numpy as np
import pytest

from tallyframe.llm import resample

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, most):
    words = WORD.findall((text or "").translate(cases.LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, most=1, buckets=10_000, least=20, percent=10, seed=2024):
    number = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(number, features(text, most)[1]))
    for text in target:
        t.update(map(number, features(text, most)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for place, (i, text) in enumerate(rows):
        words, found = features(text, most)
        weight = math.floor(sum(gain[number(f)] for f in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words, place])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    rank = {r[5]: k for k, r in enumerate(able[: percent * len(able) // 100], start=1)}
    return [(*r[:4], rank.get(r[5])) for r in out]


def texts():
    draws = np.random.default_rng(13)
    words = np.array([f"w{i}" for i in range(300)] + ["Äpfel", "élan", "a b", "9"])
    lines = [" ".join(draws.choice(words, draws.integers(1, 12))) + draws.choice([".", "", " !"]) for _ in range(60)]
    return ["\n".join(draws.choice(lines, draws.integers(1, 9))).upper() if i % 7 == 0 else "\n".join(draws.choice(lines, draws.integers(1, 9))) for i in range(300)]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_against_brute_force(spark, most):
    every = texts() + cases.AWKWARD * 3
    ids = [*range(300), *cases.AWKWARD_IDS * 3]
    target = [*texts()[:20], "w1 w2\nw3 w4\n\nw5", None, ""]
    # one partition keeps the order of rows that repeat an id
    table = cases.docs(spark, every, ids).repartition(1)
    rows = [(r.doc_id, r.text) for r in table.collect()]
    bench = spark.createDataFrame([(1, t) for t in target], "row long, text string")
    got = [tuple(r) for r in resample.resample(table, bench, most=most, buckets=500, least_words=5, percent=30).collect()]
    want = brute(rows, target, most, 500, 5, 30)
    assert sorted(got, key=repr) == sorted(want, key=repr) and sum(r[4] is not None for r in want) > 60


def test_lines_count_like_whole_texts(spark):
    """Distinct lines times occurrences, and runs over line ends, give the counts of all texts."""
    every = texts()
    table = cases.docs(spark, every)
    for most in (1, 3):
        want = Counter(zlib.crc32(f.encode()) % 700 for t in every for f in features(t, most)[1])
        got = resample.feature_counts(table, "text", most, 700)
        assert {i: int(n) for i, n in enumerate(got) if n} == want
    lines = {bytes(r.raw).decode(): r.times for r in resample.distinct_lines(table).collect()}
    assert lines == Counter(x for t in every for x in t.split("\n") if x) and max(lines.values()) > 5


def test_ranks_over_many_ranges(spark):
    """Ties, also at the last score that is drawn; a third of all rows with one id."""
    every = ["one two three four"] * 400
    ids = [7] * 130 + list(range(100, 370))
    got = resample.resample(cases.docs(spark, every, ids), spark.createDataFrame([("x",)], "text string"), least_words=3, percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 201))
    best = sorted(got, key=lambda r: (r["rank"] is None, r["rank"]))
    keys = [(-r.score, r.doc_id) for r in best[:200]]
    assert keys == sorted(keys) and keys[-1] <= min((-r.score, r.doc_id) for r in best[200:])


def test_query_and_empty_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    bench = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("text").collect()]
    got = entry.queries()["op13_segment_resampling"](spark, FOLDER)
    assert dict(got.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(docs, bench), key=repr)
    none = spark.createDataFrame([], "text string")
    assert resample.resample(cases.empty(spark), none).count() == 0
    assert {r["rank"] for r in resample.resample(cases.docs(spark, ["a b", None]), none).collect()} == {None}
