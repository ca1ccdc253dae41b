"""Grouping. Every calculation is a partial aggregate, so hot groups shrink before the shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from ..types import ref, resolve
from .keys import attach, check_sorts, order_key, sort_columns, with_tiebreak

# Names of the calculations, and of those that a source can do itself.
CALCS = ("SUM", "COUNT", "NUNIQUE", "MIN", "MAX", "AVG", "MEDIAN", "MODE", "FIRST", "LAST", "STDDEV", "VAR", "JOIN_STR", "JOIN_STR_DISTINCT")
PUSHDOWN_CALCS = ("SUM", "COUNT", "NUNIQUE", "MIN", "MAX", "AVG")


@dataclass(frozen=True)
class Agg:
    """One aggregate: a calculation over a field (None counts rows) under an output name."""

    calc: str
    field: str | None
    out: str
    delimiter: str = ", "
    sorts: tuple = ()


def _simple(df: DataFrame, agg: Agg) -> Column | None:
    """The aggregate as one expression, or None for those that need their own branch."""
    if agg.calc == "COUNT":
        if agg.field is None:
            return F.count(F.lit(1))
        column = ref(agg.field)
        if isinstance(df.schema[agg.field].dataType, T.StringType):
            return F.count(F.when(F.trim(column) != "", column))
        return F.count(column)
    if agg.field is None:
        raise ValueError(f"{agg.calc} needs a field")
    column = ref(agg.field)
    if agg.calc in ("FIRST", "LAST"):
        if not agg.sorts:
            raise ValueError(f"{agg.calc} needs a sort")
        order = order_key(df, with_tiebreak(df, list(agg.sorts)))
        return F.min_by(column, order) if agg.calc == "FIRST" else F.max_by(column, order)
    if agg.calc == "JOIN_STR":
        return F.array_join(F.sort_array(F.collect_list(column.cast("string"))), agg.delimiter)
    if agg.calc == "JOIN_STR_DISTINCT":
        return F.array_join(F.sort_array(F.collect_set(column.cast("string"))), agg.delimiter)
    plain = {
        "SUM": F.sum,
        "NUNIQUE": F.count_distinct,
        "MIN": F.min,
        "MAX": F.max,
        "AVG": F.avg,
        "STDDEV": F.stddev_samp,
        "VAR": F.var_samp,
    }
    return plain[agg.calc](column) if agg.calc in plain else None


def exact_median(df: DataFrame, keys: list[str], field: str, out: str) -> DataFrame:
    """Exact median per group without holding a group's values in memory.

    An approximate sketch brackets the middle of each group; a second pass counts what lies below
    the bracket and the distinct values inside it (a thousandth of the group or a few ties), and
    only those are ordered, by several tasks where a group is large.
    """
    from .windows import window

    accuracy, margin = 10_000, 0.0005
    values = df.select(*[ref(k) for k in keys], ref(field).cast("double").alias("__v")).filter("__v is not null")
    if not keys:
        values = values.withColumn("__all", F.lit(1))
    by = keys or ["__all"]
    bracket = values.groupBy(*[ref(k) for k in by]).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__v", [0.5 - margin, 0.5 + margin], accuracy).alias("__b"),
    )
    near = attach(values, bracket, by).filter(ref("__v") <= ref("__b")[1])
    inside = F.when(ref("__v") >= ref("__b")[0], ref("__v"))
    counts = (
        near.groupBy(*[ref(k) for k in by], inside.alias("__m"))
        .agg(F.count(F.lit(1)).alias("__c"), F.max("__n").alias("__n"))
    )
    # a running count that is split over tasks for the whole table and for large groups
    ranked = window(cut_lineage(counts), "__upto", "CUM_SUM", "__c", sorts=[("__m", "asc")], partitions=keys)
    low = F.floor((ref("__n") + 1) / 2)
    high = F.floor(ref("__n") / 2) + 1
    return ranked.groupBy(*[ref(k) for k in keys]).agg(
        (
            (F.min(F.when(ref("__upto") >= low, ref("__m"))) + F.min(F.when(ref("__upto") >= high, ref("__m")))) / 2
        ).alias(out)
    )


def most_frequent(df: DataFrame, keys: list[str], field: str, out: str) -> DataFrame:
    """Mode per group; of equally frequent values the smallest wins."""
    by = [ref(k) for k in keys]
    counts = df.filter(ref(field).isNotNull()).groupBy(*by, ref(field).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    return counts.groupBy(*by).agg(F.min_by("__v", F.struct((-ref("__c")).alias("c"), ref("__v").alias("v"))).alias(out))


def summarize(df: DataFrame, group_by: list[str], aggs: list[Agg], sorts: list[tuple[str, str]] = ()) -> DataFrame:
    """Keys and aggregates only; without keys exactly one row."""
    keys = [resolve(df, k) for k in group_by]
    resolved = []
    for agg in aggs:
        if agg.calc not in CALCS:
            raise ValueError(f"unknown calculation {agg.calc!r}")
        field = resolve(df, agg.field) if agg.field else None
        if field in keys:
            if agg.calc != "COUNT":
                raise ValueError(f"{field!r} is a key, it cannot be aggregated too")
            field = None
        resolved.append(Agg(agg.calc, field, agg.out, agg.delimiter, agg.sorts))
    names = [*keys, *[a.out for a in resolved]]
    if len({n.lower() for n in names}) != len(names):
        raise ValueError(f"output names clash: {names}")

    simple = {a.out: _simple(df, a) for a in resolved if a.calc not in ("MEDIAN", "MODE")}
    columns = [column.alias(out) for out, column in simple.items()] or [F.count(F.lit(1)).alias("__rows")]
    result = df.groupBy(*[ref(k) for k in keys]).agg(*columns)
    for agg in resolved:
        if agg.calc == "MEDIAN":
            result = attach(result, exact_median(df, keys, agg.field, agg.out), keys)
        elif agg.calc == "MODE":
            result = attach(result, most_frequent(df, keys, agg.field, agg.out), keys)
    result = result.select(*[ref(n) for n in names])
    return result.orderBy(*sort_columns(check_sorts(result, list(sorts)))) if sorts else result


def summarize_pushdown(df: DataFrame, group_by: list[str], aggs: list[Agg]) -> DataFrame:
    """The subset of calculations a database can run itself.

    Over a catalog table of a JDBC source Spark pushes the grouping; see also
    ``sources.readers.database_options`` for a grouped query run in the database.
    """
    for agg in aggs:
        if agg.calc not in PUSHDOWN_CALCS:
            raise ValueError(f"{agg.calc} cannot be pushed down")
    return summarize(df, group_by, aggs)


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true."""
    return F.count_if(condition)


def count_null(c: Column) -> Column:
    return F.count_if(c.isNull())


def count_non_null(c: Column) -> Column:
    return F.count(c)


def count_distinct(c: Column) -> Column:
    return F.count_distinct(c)
