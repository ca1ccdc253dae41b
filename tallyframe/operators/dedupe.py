"""Duplicates and top rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..types import ref, resolve
from .keys import attach, check_sorts, sort_columns, with_tiebreak, within_groups
from .windows import window

# Up to this rank Spark trims every task's rows to the leading ones before the shuffle.
RANK_TRIM = 1000
# Up to this many rows a whole-table top list is gathered in one task.
TOP_IN_ONE_TASK = 100_000


def _leading(df: DataFrame, n: int, order: list[tuple[str, str]]) -> DataFrame:
    """First ``n`` rows of a whole table; a long list is cut by row number instead of gathered."""
    if n <= TOP_IN_ONE_TASK:
        return df.orderBy(*sort_columns(order)).limit(n)
    return window(df, "__rn", "ROW_NUM", sorts=order).filter(ref("__rn") <= n).drop("__rn")


def sample_top(df: DataFrame, n: int, sorts: list[tuple[str, str]], group_by: list[str] = ()) -> DataFrame:
    """First ``n`` rows overall or per group; ties are broken by the remaining columns."""
    if n < 0:
        raise ValueError("n must not be negative")
    keys = [resolve(df, k) for k in group_by]
    order = with_tiebreak(df, check_sorts(df, list(sorts)))
    if not keys:
        return _leading(df, n, order)
    if n <= RANK_TRIM:
        by = W.partitionBy(*[ref(k) for k in keys]).orderBy(*sort_columns(within_groups(order, keys)))
        ranked = df.withColumn("__rn", F.row_number().over(by))
    else:
        ranked = window(df, "__rn", "ROW_NUM", sorts=order, partitions=keys)
    return ranked.filter(ref("__rn") <= n).drop("__rn")


def deduplicate(df: DataFrame, keys: list[str] = (), sorts: list[tuple[str, str]] = ()) -> DataFrame:
    """One row per key, the first by ``sorts``; without keys the distinct rows."""
    return sample_top(df, 1, sorts, keys) if keys else df.distinct()


def flag_duplicates(df: DataFrame, keys: list[str] = (), out: str = "Is Duplicate") -> DataFrame:
    """All rows, marked when another row has the same key (all columns if none are named)."""
    keys = [resolve(df, k) for k in (keys or df.columns)]
    repeated = df.groupBy(*[ref(k) for k in keys]).count().filter("count > 1").select(*[ref(k) for k in keys], F.lit(True).alias(out))
    return attach(df, repeated, keys).withColumn(out, F.coalesce(ref(out), F.lit(False)))


def duplicates_only(df: DataFrame, keys: list[str], sorts: list[tuple[str, str]] = (), split: bool | None = None) -> DataFrame:
    """The second and later rows of every key."""
    order = with_tiebreak(df, check_sorts(df, list(sorts)))
    numbered = window(df, "__rn", "ROW_NUM", sorts=order, partitions=list(keys), split=split)
    return numbered.filter(ref("__rn") > 1).drop("__rn")


def sample_random(df: DataFrame, fraction: float | None = None, n: int | None = None, seed: int = 0, by: list[str] = ()) -> DataFrame:
    """A random share of the rows, or ``n`` random rows.

    With ``by`` the share is decided by a hash of those columns, so it is the same on every run
    and on every partitioning.
    """
    if (fraction is None) == (n is None):
        raise ValueError("give either fraction or n")
    if by:
        text = F.concat_ws("|", F.lit(str(seed)), *[ref(resolve(df, c)).cast("string") for c in by])
        draw = F.md5(text)
        if n is not None:
            drawn = df.withColumn("__draw", draw)
            return _leading(drawn, n, [("__draw", "asc"), *with_tiebreak(df, [])]).drop("__draw")
        return df.filter(F.substring(draw, 1, 8) < F.lit(f"{int(fraction * 2**32):08x}")) if fraction < 1 else df
    if n is not None:
        return _leading(df.withColumn("__draw", F.rand(seed)), n, [("__draw", "asc")]).drop("__draw")
    return df.sample(fraction=fraction, seed=seed)
