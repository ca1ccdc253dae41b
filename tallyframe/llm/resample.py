"""Importance resampling towards a target's distribution of hashed word n-grams.

Features are all runs of 1 to ``most`` consecutive words; a feature's bucket is a checksum modulo the
number of buckets. A bucket's gain is how much more frequent it is in the target than in the corpus, a
document's weight the mean gain of its features, and a fixed random number for each id (Gumbel's law)
added to the weight makes the highest scores a weighted draw without replacement.

Corpus counts come from segments: newlines, which separate words, cut texts into lines. The features of
each distinct line are counted once and multiplied by its occurrences; runs over a line's end are added
separately. A line that surely occurs once (a two-pass filter of bounded size over line hashes) is
counted where it is, so only repeated lines are shuffled, and of those each task sends one.

The driver sees counts of buckets and of scores, which are whole numbers in a range that the logarithms
bound. A histogram of the scores gives the lowest score that can be drawn; rows from there on are
range-partitioned by their order and numbered with each range's first rank.

Defined cases: null and empty texts have no features, the weight 0 and can't be drawn; a null id is
hashed as an empty text and comes last among equals; rows that repeat an id are separate documents and
keep their order in the table among equals; with nothing in the target every gain follows from the
formula; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import string
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filter_bits, staged, text_of, with_filter_hit
from .exact_dedup import HASHES, repeated_cells

#: Features a worker remembers.
REMEMBERED = 300_000
# Words are runs of digits, small letters (A-Z are lower-cased) and characters beyond ASCII.
_KEPT = (string.digits + string.ascii_lowercase).encode()
_WORDS = bytes(b if b in _KEPT or b >= 128 else b + 32 if chr(b) in string.ascii_uppercase else 32 for b in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORDS).split()


def runs(words: list[bytes], most: int) -> list[bytes]:
    """All runs of 1 to ``most`` words, joined by a space."""
    out = list(words)
    for n in range(2, most + 1):
        out += map(b" ".join, zip(*[words[i:] for i in range(n)]))
    return out


def border_runs(raw: bytes, most: int) -> list[bytes]:
    """The runs that begin in one line and end in another."""
    words, line = [], []
    for i, part in enumerate(raw.split(b"\n")):
        found = words_of(part)
        words += found
        line += [i] * len(found)
    return [b" ".join(words[i : i + n]) for n in range(2, most + 1) for i in range(len(words) - n + 1) if line[i] != line[i + n - 1]]


class Numbers(dict):
    """A number for each feature that is asked for: its bucket, or what ``values`` has for the bucket."""

    def __init__(self, buckets: int, values: np.ndarray | None = None):
        super().__init__()
        self.buckets, self.values = buckets, None if values is None else values.tolist()

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        self[feature] = found = bucket if self.values is None else self.values[bucket]
        return found

    def of(self, features: list[bytes]) -> Iterator[int]:
        if len(self) > REMEMBERED:
            self.clear()
        return map(self.__getitem__, features)


def bucket_counts(segments: DataFrame, features, buckets: int) -> dict[int, int]:
    """How many features each bucket holds. ``segments`` has raw (bytes) and times; ``features`` lists a segment's."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        numbers, total = Numbers(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for raw, times in zip(batch.column("raw").to_pylist(), batch.column("times").to_pylist(), strict=True):
                found = features(raw)
                total += times * np.bincount(np.fromiter(numbers.of(found), dtype=np.int64, count=len(found)), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    # the driver gets one number for each bucket
    return {r.bucket: r.n for r in segments.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def distinct_lines(texts: DataFrame) -> DataFrame:
    """(raw, times): the distinct lines of column ``text`` and how often each occurs."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    hashed = lines.select("line", F.xxhash64("line").alias("key"))
    keys = staged(hashed.select("key"), "line-hashes")
    bits = filter_bits(keys.count())
    marked = staged(repeated_cells(keys, "key", bits), "repeated-lines")
    probed = with_filter_hit(hashed, marked, F.col("key"), bits, HASHES, "suspect")
    repeated = probed.filter("suspect").groupBy("line").agg(F.count("*").alias("times"))
    once = probed.filter("not suspect").select("line", F.lit(1).cast("long").alias("times"))
    return once.unionByName(repeated).select(F.encode("line", "UTF-8").alias("raw"), "times")


def feature_counts(table: DataFrame, text_column: str, most: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket."""
    texts = table.select(text_of(f"`{text_column}`").alias("text"))
    out = np.zeros(buckets, dtype=np.int64)
    found = bucket_counts(distinct_lines(texts), lambda raw: runs(words_of(raw), most), buckets)
    across = {}
    if most > 1:
        whole = texts.select(F.encode("text", "UTF-8").alias("raw"), F.lit(1).cast("long").alias("times"))
        across = bucket_counts(whole, lambda raw: border_runs(raw, most), buckets)
    for part in (found, across):
        for bucket, n in part.items():
            out[bucket] += n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed frequency in the target over that in the corpus."""
    buckets, total, wanted = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = [(float(t) + 1) * (total + buckets) / ((float(s) + 1) * (wanted + buckets)) for s, t in zip(corpus, target, strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], dtype=np.int64)


def draw_of(name: str, seed: int) -> int:
    """Thousandths of a number of Gumbel's law, the same for a name each time."""
    h = int(hashlib.sha256(f"{seed}:{name}".encode("utf-8", "surrogatepass")).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, most: int, seed: int, id_column: str, text_column: str) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        numbers = Numbers(len(shared.value), shared.value)
        for batch in batches:
            rows = []
            for raw, name in zip(batch.column("raw").to_pylist(), batch.column("name").to_pylist(), strict=True):
                words = words_of(raw)
                features = runs(words, most)
                weight = sum(numbers.of(features)) // len(features) if features else 0
                rows.append((len(words), len(features), weight, weight + draw_of(name, seed)))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 4)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n_words", "n_features", "weight", "score"])

    name = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
    light = docs.select(F.col(f"`{id_column}`").alias("id"), name.alias("name"), F.encode(text_of(f"`{text_column}`"), "UTF-8").alias("raw"))
    return light.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long, score long")


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with their number (from 1) in an order over all of them, column ``rank``."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    kind = ", ".join(f"{c} {t}" for c, t in rows.dtypes)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            place = pa.array(np.arange(seen + 1, seen + 1 + batch.num_rows))
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, own, np.int32)), place], [*batch.schema.names, "range", "place"])

    placed = staged(ranged.mapInArrow(run, f"{kind}, range int, place long"), "ranges")
    # as many rows as ranges
    before, firsts = 0, []
    for r in placed.groupBy("range").count().orderBy("range").collect():
        firsts.append((r["range"], before))
        before += r["count"]
    first = rows.sparkSession.createDataFrame(firsts, "range int, before long")
    return placed.join(F.broadcast(first), "range").withColumn("rank", F.col("before") + F.col("place")).drop("range", "place", "before")


def drawn(rows: DataFrame, count: int, eligible: Column) -> DataFrame:
    """``rows`` (staged: id, row, score) with the rank of the ``count`` highest scores among the eligible, null for others."""
    histogram = rows.filter(eligible).groupBy("score").count().orderBy(F.desc("score")).collect()
    seen, lowest = 0, None
    for r in histogram:
        if seen >= count:
            break
        seen, lowest = seen + r["count"], r["score"]
    none = F.lit(None).cast("long")
    if lowest is None:
        return rows.withColumn("rank", none)
    near = eligible & (F.col("score") >= lowest)
    ranked = numbered(rows.filter(near), [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")])
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= count, F.col("rank")))
    return rows.filter(~near).withColumn("rank", none).unionByName(ranked)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    most: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    least_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """One row per row of ``docs``: its id, n_features, weight, score and rank (null where it isn't drawn)."""
    gain = gains(feature_counts(docs, text_column, most, buckets), feature_counts(target, target_text, most, buckets))
    rows = scored(docs, gain, most, seed, id_column, text_column).withColumn("row", F.monotonically_increasing_id())
    rows = staged(rows, "scores")
    eligible = F.col("n_words") >= least_words
    count = percent * rows.filter(eligible).count() // 100
    out = drawn(rows, count, eligible)
    return out.select(F.col("id").alias(id_column), "n_features", "weight", "score", "rank")
