"""Ordering and per-key joins shared by the grouping operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..types import orderable, ref, resolve

Sort = tuple[str, str]


def check_sorts(df: DataFrame, sorts: list[Sort]) -> list[Sort]:
    out = []
    for name, direction in sorts:
        if direction not in ("asc", "dsc"):
            raise ValueError(f"sort direction must be asc or dsc, not {direction!r}")
        out.append((resolve(df, name), direction))
    return out


def with_tiebreak(df: DataFrame, sorts: list[Sort]) -> list[Sort]:
    """Sorts followed by every other comparable column, so that equal rows alone stay tied."""
    sorts = check_sorts(df, sorts)
    named = {name for name, _ in sorts}
    rest = [c for c in df.columns if c not in named and not c.startswith("__") and orderable(df, c)]
    return sorts + [(c, "asc") for c in rest]


def within_groups(sorts: list[Sort], partitions: list[str]) -> list[Sort]:
    """Sorts without the partition columns, which are constant inside a group."""
    return [(n, d) for n, d in sorts if n not in partitions] or sorts


def sort_columns(sorts: list[Sort]) -> list[Column]:
    """Nulls first when ascending, last when descending."""
    return [ref(n).asc_nulls_first() if d == "asc" else ref(n).desc_nulls_last() for n, d in sorts]


def flipped(sorts: list[Sort]) -> list[Sort]:
    return [(n, "dsc" if d == "asc" else "asc") for n, d in sorts]


def _descending(df: DataFrame, name: str) -> list[Column]:
    """Columns that, ascending, order ``name`` descending with nulls last."""
    column, kind = ref(name), df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # what is not a number is the largest, and negated it would stay so
        return [column.isNull(), ~F.isnan(column), -column]
    if isinstance(kind, T.DecimalType):
        down = -column
    elif isinstance(kind, T.IntegralType):
        down = -column.cast("decimal(20,0)")
    elif isinstance(kind, T.DateType):
        down = -F.unix_date(column)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        down = -F.unix_micros(column.cast("timestamp"))
    elif isinstance(kind, T.BooleanType):
        down = ~column
    elif isinstance(kind, T.StringType):
        # negated code points, closed by 1 so that a prefix comes after the longer text
        points = F.transform(F.split(column, ""), lambda ch: -F.ascii(ch))
        down = F.concat(F.filter(points, lambda p: p != 0), F.array(F.lit(1)))
    else:
        raise ValueError(f"cannot order {name!r} descending")
    return [column.isNull(), down]


def order_key(df: DataFrame, sorts: list[Sort]) -> Column:
    """A struct whose ascending order is the requested order; for ``min_by`` and ``max_by``."""
    parts: list[Column] = []
    for name, direction in sorts:
        parts += [ref(name)] if direction == "asc" else _descending(df, name)
    return F.struct(*[part.alias(f"o{i}") for i, part in enumerate(parts)])


def null_safe(left: list[Column], right: list[Column]) -> Column:
    condition = left[0].eqNullSafe(right[0])
    for a, b in zip(left[1:], right[1:]):
        condition = condition & a.eqNullSafe(b)
    return condition


def attach(df: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Add the value columns of a one-row-per-key table to every row (null keys are a group).

    Without keys the table has one row, added as scalar subqueries. With keys this is a plain left
    join: Spark broadcasts the table when it is small, else sort-merges it, where adaptive
    execution splits a hot key on the big side.
    """
    values = [c for c in per_key.columns if c not in keys]
    if not keys:
        return df.select("*", *[per_key.select(ref(v)).scalar().alias(v) for v in values])
    small = per_key.select(*[ref(k).alias(f"__key{i}") for i, k in enumerate(keys)], *[ref(v) for v in values])
    condition = null_safe([df[f"`{k}`"] for k in keys], [small[f"__key{i}"] for i in range(len(keys))])
    return df.join(small, condition, "left").drop(*[f"__key{i}" for i in range(len(keys))])
