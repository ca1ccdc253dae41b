"""Row filters by rules or by a Spark SQL expression, with their true and false branches.

Rules are plain comparisons on columns, so Catalyst pushes them into the scan.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import Rule, rules_column


class Branches(NamedTuple):
    true: DataFrame
    false: DataFrame


def filter_rules(df: DataFrame, rules: list[Rule], as_of=None) -> DataFrame:
    return df.filter(rules_column(df, rules, as_of))


def filter_expr(df: DataFrame, expression: str) -> DataFrame:
    """Keep rows for which a boolean Spark SQL expression is true."""
    return df.filter(F.expr(expression))


def split_where(df: DataFrame, predicate: Column) -> Branches:
    """Rows where the predicate is true, and all others (false or null)."""
    holds = F.coalesce(predicate, F.lit(False))
    return Branches(df.filter(predicate), df.filter(~holds))


def split_filter(df: DataFrame, rules: list[Rule] | str, as_of=None) -> Branches:
    """True and false branch; together they are exactly the input."""
    predicate = F.expr(rules) if isinstance(rules, str) else rules_column(df, rules, as_of)
    return split_where(df, predicate)


def filter_pushdown(df: DataFrame, rules: list[Rule], as_of=None) -> DataFrame:
    """Same as ``filter_rules``: on a Parquet, ORC or JDBC scan Spark runs it in the source."""
    return filter_rules(df, rules, as_of)
