"""Aggregation by calendar period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import period_name, time_period, time_period_offset
from ..types import column_type, ref, resolve
from .aggregate import Agg, summarize
from .keys import null_safe

NAME, OFFSET = "Period Name", "Period Offset"


def time_series(
    df: DataFrame,
    date_column: str,
    aggs: list[Agg],
    period: str = "day",
    group_by: list[str] = (),
    as_of=None,
    fill_gaps: bool = False,
) -> DataFrame:
    """One row per period and group: keys, period name, offset from the reference day, aggregates.

    ``fill_gaps`` adds the periods without rows between a group's first and last one, with counts
    of 0 and otherwise null aggregates.
    """
    date_column = resolve(df, date_column)
    if column_type(df, date_column) not in ("date", "datetime"):
        raise ValueError(f"{date_column!r} is no date column")
    keys = [resolve(df, k) for k in group_by]
    dated = df.withColumn("__start", time_period(ref(date_column), period)).filter("__start is not null")
    result = summarize(dated, [*keys, "__start"], aggs)
    if fill_gaps:
        result = _fill(result, keys, aggs, period)
    return result.select(
        *[ref(k) for k in keys],
        period_name(ref("__start"), period).alias(NAME),
        time_period_offset(ref("__start"), period, as_of).alias(OFFSET),
        *[ref(a.out) for a in aggs],
    )


def _fill(result: DataFrame, keys: list[str], aggs: list[Agg], period: str) -> DataFrame:
    by = [ref(k) for k in keys]
    span = result.groupBy(*by).agg(F.min("__start").alias("__from"), F.max("__start").alias("__to"))
    step = {
        "day": "interval 1 day",
        "week": "interval 7 days",
        "month": "interval 1 month",
        "quarter": "interval 3 months",
        "year": "interval 12 months",
        "decade": "interval 120 months",
    }[period]
    grid = span.select(
        *[ref(k).alias(f"__key{i}") for i, k in enumerate(keys)],
        F.explode(F.sequence("__from", "__to", F.expr(step))).alias("__day"),
    )
    condition = grid["__day"] == result["__start"]
    if keys:
        condition = condition & null_safe([grid[f"__key{i}"] for i in range(len(keys))], [result[f"`{k}`"] for k in keys])
    counted = {a.out for a in aggs if a.calc in ("COUNT", "NUNIQUE")}
    return grid.join(result, condition, "left").select(
        *[ref(f"__key{i}").alias(k) for i, k in enumerate(keys)],
        ref("__day").alias("__start"),
        *[F.coalesce(ref(a.out), F.lit(0)).alias(a.out) if a.out in counted else ref(a.out) for a in aggs],
    )


