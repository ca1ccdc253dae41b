"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The matrix says how many rows of each input partition go to each block of each shard; it is drawn
exactly as a uniform permutation would deal them (multivariate hypergeometric, row by row), so its
margins are the partitions' and the blocks' sizes. Every partition then deals its rows in a random
order under its counts, the rows are exchanged by block, and every block is permuted again. Blocks
of a shard follow each other, so a row's slot is its block's first slot plus its place in the block.

The driver sees counts only and draws partitions times blocks numbers, whatever the rows; both are bounded (partitions are numbered
modulo ``MAX_GROUPS``). Row contents, their sizes and equal texts have no influence: a third of all
rows being equal changes nothing. Shard sizes differ by one row at most.

Defined cases: null or empty text has size 8 and the checksum 0; a null id is kept as it is; rows
that repeat are dealt one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Input partitions are counted in at most so many groups.
MAX_GROUPS = 4096
#: Rows of a block that one task orders at the end, as long as the number of blocks allows it.
BLOCK_ROWS = 200_000
MAX_BLOCKS_PER_SHARD = 64
#: Rows up to which NumPy draws hypergeometric numbers.
LIMIT = 1_000_000_000


def even(total: int, parts: int) -> np.ndarray:
    """``total`` in ``parts`` sizes that differ by one at most."""
    return np.array([total // parts + (i < total % parts) for i in range(parts)], dtype=np.int64)


def _stirling_error(n: float) -> float:
    """What Stirling's formula leaves out of log(n!)."""
    if n < 16:
        return math.lgamma(n + 1) - (n + 0.5) * math.log(n or 1) + n - (0.5 * math.log(2 * math.pi) if n else 0)
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * n * n)) / (n * n)) / (n * n)) / n


def _deviance(x: float, mean: float) -> float:
    """x log(x / mean) + mean - x, without cancellation for near numbers."""
    if abs(x - mean) >= 0.1 * (x + mean):
        return x * math.log(x / mean) + mean - x if x else mean
    v = (x - mean) / (x + mean)
    total, term, k = (x - mean) * v, 2 * x * v, 1
    while True:
        term *= v * v
        new = total + term / (2 * k + 1)
        if new == total:
            return total
        total, k = new, k + 1


def _log_binomial(x: int, n: int, p: float) -> float:
    """Logarithm of the probability of x successes in n, by its saddle point: exact for any n."""
    if x in (0, n):
        return n * math.log1p(-p) if x == 0 else n * math.log(p)
    core = _stirling_error(n) - _stirling_error(x) - _stirling_error(n - x) - _deviance(x, n * p) - _deviance(n - x, n * (1 - p))
    return core + 0.5 * math.log(n / (2 * math.pi * x * (n - x)))


def hypergeometric(draws: np.random.Generator, good: int, bad: int, rows: int) -> int:
    """How many of ``rows`` places, taken without replacement, are good; for any numbers."""
    if good + bad < LIMIT:
        return int(draws.hypergeometric(good, bad, rows))
    if rows in (0, good + bad) or not good or not bad:
        return min(good, rows)
    # binomial numbers of both kinds, given that they add up: the second kind's probability decides
    p = rows / (good + bad)
    most = _log_binomial(min(bad, int((bad + 1) * p)), bad, p)
    while True:
        found = int(draws.binomial(good, p))
        rest = rows - found
        if 0 <= rest <= bad and math.log(draws.random()) <= _log_binomial(rest, bad, p) - most:
            return found


def draw(draws: np.random.Generator, left: np.ndarray, rows: int) -> np.ndarray:
    """How many of ``rows`` rows go to each block, dealt without replacement from what is ``left``."""
    if left.sum() < LIMIT:
        return draws.multivariate_hypergeometric(left, rows, method="marginals")
    # halves of the blocks, then halves of these: as many numbers as blocks, whatever the rows
    if len(left) == 1:
        return np.array([rows], dtype=np.int64)
    middle = len(left) // 2
    first = hypergeometric(draws, int(left[:middle].sum()), int(left[middle:].sum()), rows)
    return np.concatenate((draw(draws, left[:middle], first), draw(draws, left[middle:], rows - first)))


def matrix(rows_of: dict[int, int], blocks: np.ndarray, seed: int) -> dict[int, np.ndarray]:
    """For each input group the number of its rows that go to each block."""
    draws, left, out = np.random.default_rng(seed), blocks.copy(), {}
    for group in sorted(rows_of):
        out[group] = draw(draws, left, rows_of[group])
        left = left - out[group]
    return out


def shard(docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text", seed: int = 8) -> DataFrame:
    """One row per row of ``docs``: its id, size, text_crc32, shard and slot.

    ``docs`` must give the same rows in the same partitions each time, as a scan of files does;
    stage anything else first.
    """
    text = F.encode(text_of(text_column), "UTF-8")
    light = docs.select(
        # a nullable integer would become a float on its way through pandas
        F.col(id_column).cast("string").alias("id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
    )
    found = docs.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()  # one number per partition
    rows_of: dict[int, int] = {}
    for p, count in found:
        rows_of[p % MAX_GROUPS] = rows_of.get(p % MAX_GROUPS, 0) + count
    in_partition = dict(map(tuple, found))
    total = sum(rows_of.values())
    per_shard = even(total, shards)
    split = max(1, min(MAX_BLOCKS_PER_SHARD, -(-total // (shards * BLOCK_ROWS))))
    blocks = np.concatenate([even(int(n), split) for n in per_shard])
    first = np.concatenate([np.cumsum(b) - b for b in blocks.reshape(shards, split)])
    drawn = matrix(rows_of, blocks, seed)
    shared = docs.sparkSession.sparkContext.broadcast((drawn, in_partition))

    def share(p: int) -> np.ndarray:
        """A partition's part of its group's counts; the partitions before it come first."""
        drawn, in_partition = shared.value
        left = drawn[p % MAX_GROUPS]
        for member in range(p % MAX_GROUPS, p + 1, MAX_GROUPS):
            own = draw(np.random.default_rng([seed, member]), left, in_partition.get(member, 0))
            left = left - own
        return own

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, left = TaskContext.get().partitionId(), None
        draws = np.random.default_rng([seed, p, 1])
        for batch in batches:
            if len(batch):
                left = share(p) if left is None else left
                take = draw(draws, left, len(batch))
                left = left - take
                yield batch.assign(block=draws.permutation(np.repeat(np.arange(len(take)), take)), key=draws.integers(0, 2**62, len(batch)))

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, seen = -1, 0
        for batch in batches:
            place = batch.groupby("block").cumcount().to_numpy(dtype=np.int64)
            place[batch["block"].to_numpy() == block] += seen
            if len(batch):
                block, seen = int(batch["block"].iloc[-1]), int(place[-1]) + 1
            at = batch["block"].to_numpy()
            yield batch[["id", "size", "crc"]].assign(shard=(at // split).astype(np.int32), slot=first[at] + place)

    dealt = light.mapInPandas(deal, "id string, size long, crc long, block int, key long")
    ordered = dealt.repartition(len(blocks), "block").sortWithinPartitions("block", "key")
    out = ordered.mapInPandas(number, "id string, size long, crc long, shard int, slot long")
    return out.select(F.col("id").cast(dict(docs.dtypes)[id_column]).alias(id_column), "size", F.col("crc").alias("text_crc32"), "shard", "slot")
