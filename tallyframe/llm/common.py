"""Helpers that the operators of this folder share: staged tables, bitmap filters, hot groups, components."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.session import scratch_path

#: Bits that one value of ``bitmap_construct_agg`` holds.
BUCKET_BITS = 32768
#: A filter never grows beyond this (128 MB on each executor); more rows only mean more false hits.
MAX_FILTER_BITS = 2**30
#: Groups with more than one row in so many are joined by broadcast; there can't be more of them than this.
MAX_HOT_GROUPS = 10_000


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read again."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


# --- bitmap filters -----------------------------------------------------------------------------


def filter_bits(rows: int, bits_per_row: int = 16) -> int:
    """Bits of a filter for so many rows: a power of two, bounded."""
    wanted = max(BUCKET_BITS, rows * bits_per_row)
    return min(MAX_FILTER_BITS, 1 << math.ceil(math.log2(wanted)))


def cells(key: Column, bits: int, hashes: int) -> list[Column]:
    """The positions (1 to ``bits``) that a key sets."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) + 1 for i in range(hashes)]


def bitmaps(positions: DataFrame) -> DataFrame:
    """Column ``cell`` as bitmaps: one row for each bucket that has a bit set."""
    return positions.groupBy(F.expr("bitmap_bucket_number(cell)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(cell))").alias("bitmap")
    )


def with_filter_hit(rows: DataFrame, maps: DataFrame, key: Column, bits: int, hashes: int, name: str) -> DataFrame:
    """Add the boolean ``name``: all of the key's bits are set. ``maps`` is broadcast; ``bits`` bounds its size."""
    columns = list(rows.columns)
    hits = []
    for i, cell in enumerate(cells(key, bits, hashes)):
        at, bucket, bitmap = f"__cell{i}", f"__bucket{i}", f"__bitmap{i}"
        side = F.broadcast(maps.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap)))
        rows = rows.withColumn(at, cell)
        rows = rows.join(side, F.expr(f"bitmap_bucket_number(`{at}`)") == F.col(bucket), "left")
        byte = F.expr(f"cast(conv(hex(substring(`{bitmap}`, cast(bitmap_bit_position(`{at}`) div 8 as int) + 1, 1)), 16, 10) as int)")
        bit = F.expr(f"cast(pow(2, bitmap_bit_position(`{at}`) % 8) as int)")
        hits.append(F.col(bitmap).isNotNull() & (F.coalesce(byte, F.lit(0)).bitwiseAND(bit) != 0))
    hit = hits[0]
    for other in hits[1:]:
        hit = hit & other
    return rows.select(*[F.col(f"`{c}`") for c in columns], hit.alias(name))


def possible_rows(rows: DataFrame, key: str, keys: DataFrame, count: int) -> DataFrame:
    """The rows whose ``key`` is, or looks as if it were, among ``keys`` (one column): a superset, without a shuffle."""
    bits = filter_bits(count)
    found = keys.select(F.explode(F.array(*cells(F.col(keys.columns[0]), bits, 2))).alias("cell"))
    maps = staged(bitmaps(found), "id-filter")
    return with_filter_hit(rows, maps, F.col(f"`{key}`"), bits, 2, "__hit").filter("__hit").drop("__hit")


def without_rows(rows: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows whose ``key`` isn't in ``dropped`` (one column, staged).

    A bitmap of the dropped keys is broadcast. Rows that miss it stay where they are; only rows
    that hit it are shuffled for the exact test.
    """
    count = dropped.count()
    if not count:
        return rows
    bits = filter_bits(count)
    name = dropped.columns[0]
    found = dropped.select(F.explode(F.array(*cells(F.col(name), bits, 2))).alias("cell"))
    maps = staged(bitmaps(found), "id-filter")
    probed = with_filter_hit(rows, maps, F.col(f"`{key}`"), bits, 2, "__hit")
    gone = dropped.select(F.col(name).alias("__gone")).distinct()
    doubtful = probed.filter("__hit").join(gone, F.col(f"`{key}`").eqNullSafe(F.col("__gone")), "left_anti")
    return probed.filter("not __hit").unionByName(doubtful).drop("__hit")


# --- hot groups ---------------------------------------------------------------------------------


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of ``rows`` with one row per ``key`` (its group's ``size`` among ``total`` rows).

    Groups of more than ``total / MAX_HOT_GROUPS`` rows are fewer than ``MAX_HOT_GROUPS``, whatever
    the data, so they are broadcast and their rows stay where they are. No other group can make a
    task large. Both sides should be staged: each is read twice.
    """
    hot_size = max(1000, total // MAX_HOT_GROUPS)
    added = [c for c in groups.columns if c != key]
    hot = F.broadcast(groups.filter(F.col(size) > hot_size))
    near = rows.join(hot, key, "left")
    rest = near.filter(F.col(size).isNull()).drop(*added).join(groups.filter(F.col(size) <= hot_size), key, "left")
    return near.filter(F.col(size).isNotNull()).unionByName(rest)


# --- components ---------------------------------------------------------------------------------


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of the nodes in ``links`` (a, b: long); a component is its smallest node.

    Alternating stars: every node hangs its larger neighbours, then its smaller ones, below the
    smallest it knows. The rounds grow with the logarithm of a component's diameter. A hub has one
    row per neighbour in a min aggregate, which is combined in the tasks, and a join that
    adaptive execution splits; neighbours are never gathered in a list.
    """
    edges = staged(links.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").filter("u <> v").distinct(), "edges")
    if edges.isEmpty():
        return edges.selectExpr("u AS node", "v AS component")
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").selectExpr("v AS u", "m AS v").filter("u <> v").distinct()
        large = staged(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("CASE WHEN v = m THEN u ELSE v END AS u", "m AS v").filter("u <> v").distinct()
        edges = staged(small, "small-star")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.selectExpr("u AS node", "v AS component").unionByName(roots)
