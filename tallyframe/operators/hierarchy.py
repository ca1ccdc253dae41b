"""Parent/child chains: aggregates over a row and all its ancestors up to the root.

Pointer doubling: each round a row jumps over twice as many ancestors and merges the partial
aggregate waiting there, so a chain of length n needs log2(n) joins. Partial aggregates are a few
numbers per row; only calculations that need every value (path text, median, distinct) carry the
chain's values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank
from ..session import cut_lineage
from ..types import ref, resolve
from .aggregate import Agg

LIST_CALCS = ("MEDIAN", "NUNIQUE", "JOIN_STR", "JOIN_STR_DISTINCT")
NUMBER_CALCS = ("SUM", "COUNT", "MIN", "MAX", "AVG", "STDDEV", "VAR")


def _add(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


def _start(df: DataFrame, agg: Agg) -> dict[str, Column]:
    """Partial aggregate of the row alone."""
    if agg.calc == "COUNT":
        if agg.field is None:
            return {"n": F.lit(1).cast("bigint")}
        return {"n": F.when(is_blank(ref(agg.field)), 0).otherwise(1).cast("bigint")}
    column = ref(agg.field)
    if agg.calc in LIST_CALCS:
        value = column if agg.calc == "MEDIAN" else column.cast("string")
        return {"l": F.array_compact(F.array(value))}
    if agg.calc in ("MIN", "MAX"):
        return {"m": column}
    if agg.calc == "SUM":
        integral = isinstance(df.schema[agg.field].dataType, T.IntegralType)
        return {"s": column.cast("bigint") if integral else column}
    number = column.cast("double")
    count = column.isNotNull().cast("bigint")
    if agg.calc == "AVG":
        return {"s": number, "n": count}
    zero = F.when(column.isNotNull(), F.lit(0.0))
    return {"n": count, "a": number, "q": zero}


def _merge(agg: Agg, a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Row part ``a`` with ancestor part ``b``."""
    if agg.calc in LIST_CALCS:
        return {"l": F.concat(a["l"], b["l"])}
    if agg.calc == "MIN":
        return {"m": F.least(a["m"], b["m"])}
    if agg.calc == "MAX":
        return {"m": F.greatest(a["m"], b["m"])}
    if agg.calc in ("SUM", "COUNT", "AVG"):
        return {part: _add(a[part], b[part]) for part in a}
    n = a["n"] + b["n"]
    gap = b["a"] - a["a"]
    mean = F.coalesce(a["a"] + gap * b["n"] / n, a["a"], b["a"])
    spread = F.coalesce(a["q"] + b["q"] + gap * gap * a["n"] * b["n"] / n, a["q"], b["q"])
    return {"n": n, "a": mean, "q": spread}


def _finish(agg: Agg, p: dict[str, Column]) -> Column:
    if agg.calc == "COUNT":
        return p["n"]
    if agg.calc == "SUM":
        return p["s"]
    if agg.calc in ("MIN", "MAX"):
        return p["m"]
    if agg.calc == "AVG":
        return F.try_divide(p["s"], p["n"])
    if agg.calc in ("VAR", "STDDEV"):
        variance = F.when(p["n"] > 1, p["q"] / (p["n"] - 1))
        return F.sqrt(variance) if agg.calc == "STDDEV" else variance
    if agg.calc == "NUNIQUE":
        return F.size(F.array_distinct(p["l"])).cast("bigint")
    if agg.calc == "MEDIAN":
        ordered, size = F.array_sort(p["l"]), F.size(p["l"])
        low = F.get(ordered, F.floor((size - 1) / 2).cast("int"))
        return (low + F.get(ordered, F.floor(size / 2).cast("int"))).cast("double") / 2
    values = F.array_distinct(p["l"]) if agg.calc == "JOIN_STR_DISTINCT" else p["l"]
    return F.array_join(values, agg.delimiter)


def hierarchy(df: DataFrame, id_field: str, parent_field: str, aggs: list[Agg]) -> DataFrame:
    """Every row with aggregates over its chain; path texts run from the row up to the root.

    A blank parent is a root, an unknown parent ends the chain, ids must be unique, and a cycle
    raises: a chain has no more rows than the table, which bounds the rounds.
    """
    id_field, parent_field = resolve(df, id_field), resolve(df, parent_field)
    aggs = [Agg(a.calc, resolve(df, a.field) if a.field else None, a.out, a.delimiter) for a in aggs]
    if len({a.out for a in aggs}) != len(aggs):
        raise ValueError("output names must be unique")
    for agg in aggs:
        if agg.calc not in LIST_CALCS + NUMBER_CALCS:
            raise ValueError(f"{agg.calc} is no hierarchy calculation")

    starts = [(f"__p{i}_{part}", column) for i, agg in enumerate(aggs) for part, column in _start(df, agg).items()]
    parts = [name for name, _ in starts]
    state = df.select(
        ref(id_field).alias("__id"),
        F.when(~is_blank(ref(parent_field)), ref(parent_field)).cast(df.schema[id_field].dataType).alias("__up"),
        *[column.alias(name) for name, column in starts],
    )
    state = cut_lineage(state)
    twice = state.groupBy("__id").count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"ids are not unique, for example {[r[0] for r in twice]}")

    for _ in range(math.ceil(math.log2(max(2, state.count()))) + 1):
        climbing = state.filter("__up is not null")
        if climbing.isEmpty():
            break
        above = state.select(
            ref("__id").alias("__above"), ref("__up").alias("__next"), *[ref(p).alias(p + "_above") for p in parts]
        )
        joined = climbing.join(above, ref("__up") == ref("__above"), "left")
        merged = []
        for i, agg in enumerate(aggs):
            own = {p.rsplit("_", 1)[1]: ref(p) for p in parts if p.startswith(f"__p{i}_")}
            top = {part: ref(f"__p{i}_{part}_above") for part in own}
            for part, column in _merge(agg, own, top).items():
                merged.append(F.when(ref("__above").isNull(), own[part]).otherwise(column).alias(f"__p{i}_{part}"))
        climbed = joined.select("__id", ref("__next").alias("__up"), *merged)
        state = cut_lineage(state.filter("__up is null").unionByName(climbed))
    stuck = state.filter("__up is not null").select("__id").limit(5).collect()
    if stuck:
        raise ValueError(f"the parent chain does not end, for example from {[r[0] for r in stuck]}")

    results = []
    for i, agg in enumerate(aggs):
        own = {p.rsplit("_", 1)[1]: ref(p) for p in parts if p.startswith(f"__p{i}_")}
        results.append(_finish(agg, own).alias(agg.out))
    chain = state.select("__id", *results)
    kept = [c for c in df.columns if c not in {a.out for a in aggs}]
    return df.select(*[ref(c) for c in kept]).join(chain, ref(id_field) == ref("__id"), "left").drop("__id")
