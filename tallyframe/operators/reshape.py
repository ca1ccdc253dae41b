"""Pivot, unpivot and splitting of delimited text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..types import ref, resolve
from .aggregate import Agg, summarize
from .shape import reject_duplicates

PIVOT_LIMIT = 10_000


def pivot(df: DataFrame, pivot_field: str, value_field: str, calc: str = "SUM", values: list | None = None, delimiter: str = ", ", sorts: tuple = (), limit: int = PIVOT_LIMIT) -> DataFrame:
    """One row per combination of all other columns, one column per pivot value.

    Cells are aggregated first (see ``summarize``), so the pivot itself moves one row per cell.
    Without ``values`` one extra pass finds them; more than ``limit``, each a column, raise. ``ANY`` takes the smallest value.
    """
    pivot_field, value_field = resolve(df, pivot_field), resolve(df, value_field)
    keys = [c for c in df.columns if c not in (pivot_field, value_field)]
    if values is None:
        found = df.select(ref(pivot_field)).distinct().limit(limit + 1).collect()
        if len(found) > limit:
            raise ValueError(f"more than {limit} pivot values")
        values = sorted([r[0] for r in found if r[0] is not None], key=lambda v: (str(type(v)), v))
        values += [None] if any(r[0] is None for r in found) else []
    names = ["null" if v is None else str(v) for v in values]
    reject_duplicates([*keys, *names])
    agg = Agg("MIN" if calc == "ANY" else calc, value_field, "__value", delimiter=delimiter, sorts=sorts)
    cells = summarize(df, [*keys, pivot_field], [agg])
    wide = cells.groupBy(*[ref(k) for k in keys]).pivot(pivot_field, values).agg(F.min("__value"))
    return wide.toDF(*keys, *names)


def unpivot(df: DataFrame, fields: list[str], name: str = "Name", value: str = "Value", mode: str = "unpivot") -> DataFrame:
    """Columns to rows: ``unpivot`` melts the listed fields, ``keep`` melts all others.

    Mixed types become text; nulls stay as rows.
    """
    listed = [resolve(df, f) for f in fields]
    if mode not in ("unpivot", "keep"):
        raise ValueError("mode must be unpivot or keep")
    melted = listed if mode == "unpivot" else [c for c in df.columns if c not in listed]
    kept = [c for c in df.columns if c not in melted]
    if not melted:
        raise ValueError("no column to unpivot")
    reject_duplicates([*kept, name, value])
    if len({df.schema[c].dataType for c in melted}) > 1:
        df = df.select(*[ref(c) for c in kept], *[ref(c).cast("string").alias(c) for c in melted])
    return df.unpivot([ref(c) for c in kept], [ref(c) for c in melted], name, value)


def split_rows(df: DataFrame, field: str, separator: str, trim: bool = True, keep: bool = False) -> DataFrame:
    """One row per part of a delimited text; ``keep`` also keeps the text under `<field> Original`."""
    field = resolve(df, field)
    parts = F.explode_outer(F.split(ref(field), re.escape(separator)))
    part = "__part"
    rows = df.withColumn(part, parts)
    value = F.trim(ref(part)) if trim else ref(part)
    columns = [value.alias(c) if c == field else ref(c) for c in df.columns]
    if keep:
        columns.append(ref(field).alias(f"{field} Original"))
    return rows.select(*columns)


def split_columns(df: DataFrame, field: str, separator: str, n: int | None = None, trim: bool = True) -> DataFrame:
    """Parts of a delimited text as columns `<field> Split 1..n`; without ``n`` one pass finds the widest."""
    field = resolve(df, field)
    parts = F.split(ref(field), re.escape(separator))
    if n is None:
        n = df.agg(F.max(F.size(parts))).first()[0] or 1
    names = [f"{field} Split {i}" for i in range(1, n + 1)]
    reject_duplicates([*df.columns, *names])
    take = lambda i: F.get(parts, F.lit(i))
    return df.select("*", *[(F.trim(take(i)) if trim else take(i)).alias(name) for i, name in enumerate(names)])
