"""Stacking tables by name or by position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..types import column_type, ref

NUMERIC = ("integer", "number")


def _check_types(dfs: list[DataFrame], names: list[str]) -> None:
    for name in names:
        kinds = {column_type(df, name) for df in dfs if name.lower() in [c.lower() for c in df.columns]}
        if len(kinds) > 1 and not kinds <= set(NUMERIC) and not kinds <= {"date", "datetime"}:
            raise TypeError(f"column {name!r} has conflicting types {sorted(kinds)}")


def stack(dfs: list[DataFrame], match: str = "match") -> DataFrame:
    """Union of all rows by column name: ``match`` keeps common columns, ``all`` pads with nulls."""
    if match not in ("match", "all"):
        raise ValueError("match must be match or all")
    if match == "match":
        lower = [{c.lower() for c in df.columns} for df in dfs]
        common = [c for c in dfs[0].columns if all(c.lower() in names for names in lower)]
        if not common:
            raise ValueError("the tables share no column")
        _check_types(dfs, common)
        return reduce(DataFrame.unionByName, [df.select(*[ref(c) for c in common]) for df in dfs])
    every = list({c.lower(): c for df in reversed(dfs) for c in df.columns}.values())
    _check_types(dfs, every)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def stack_by_position(dfs: list[DataFrame], match: str = "match", master: int = 1) -> DataFrame:
    """Union of all rows by position under the names of the master table (1-based).

    ``match`` cuts to the narrowest table, ``all`` pads to the widest with nulls.
    """
    if not 1 <= master <= len(dfs):
        raise ValueError("master is 1-based")
    widths = [len(df.columns) for df in dfs]
    width = min(widths) if match == "match" else max(widths)
    names = list(dfs[master - 1].columns[:width])
    widest = max(dfs, key=lambda df: len(df.columns)).columns
    for position in range(len(names), width):
        name = widest[position]
        names.append(name if name.lower() not in [n.lower() for n in names] else f"{name}_{position + 1}")

    def fit(df: DataFrame) -> DataFrame:
        have = df.columns[:width]
        return df.select(
            *[ref(c).alias(n) for c, n in zip(have, names)],
            *[F.lit(None).alias(n) for n in names[len(have):]],
        )

    fitted = [fit(df) for df in dfs]
    for name in names:
        kinds = {column_type(df, name) for df in fitted} - {"void"}
        if len(kinds) > 1 and not kinds <= set(NUMERIC) and not kinds <= {"date", "datetime"}:
            raise TypeError(f"column {name!r} has conflicting types {sorted(kinds)}")
    return reduce(DataFrame.union, fitted)
