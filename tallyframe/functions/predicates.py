"""Filter rules: a flat list of typed column tests turned into one boolean column."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..types import column_type, ref, resolve
from .dates import as_of_date, date_add, time_period_offset
from .text import is_blank

# The operator vocabulary of filter rules.
COMPARISONS = ("=", "!=", ">", ">=", "<", "<=")
TEXT_TESTS = ("LIKE_CONTAINS", "LIKE_START", "LIKE_END", "NOT LIKE_CONTAINS", "NOT LIKE_START", "NOT LIKE_END")
EMPTY_TESTS = ("IS_EMPTY", "NOT IS_EMPTY", "IS NULL", "IS NOT NULL")
BOOLEAN_TESTS = ("IS TRUE", "IS NOT TRUE", "IS FALSE", "IS NOT FALSE")
DATE_TESTS = {"IS": "=", "IS_NOT": "!=", "IS_BEFORE": "<", "IS_AFTER": ">", "IS_ON_OR_BEFORE": "<=", "IS_ON_OR_AFTER": ">="}
BUCKET_TESTS = {"IS_IN": "=", "IS_NOT_IN": "!="}
# Named relative dates as (offset, period).
NAMED_DATES = {
    "TODAY": (0, "day"),
    "YESTERDAY": (-1, "day"),
    "TOMORROW": (1, "day"),
    "THIS_WEEK": (0, "week"),
    "THE_LAST_WEEK": (-1, "week"),
    "THE_NEXT_WEEK": (1, "week"),
    "THIS_MONTH": (0, "month"),
    "THE_LAST_MONTH": (-1, "month"),
    "THE_NEXT_MONTH": (1, "month"),
    "THIS_YEAR": (0, "year"),
    "THE_LAST_YEAR": (-1, "year"),
    "THE_NEXT_YEAR": (1, "year"),
}
# Counted relative dates as (sign, period).
COUNTED_DATES = {
    "_DAYS_AGO": (-1, "day"),
    "_DAYS_FROM_NOW": (1, "day"),
    "_MONTHS_AGO": (-1, "month"),
    "_MONTHS_FROM_NOW": (1, "month"),
    "_YEARS_AGO": (-1, "year"),
    "_YEARS_FROM_NOW": (1, "year"),
}


@dataclass(frozen=True)
class Rule:
    """One test on one column, joined to the rules before it by ``connector``."""

    name: str
    op: str
    value: object = ""
    data_type: str | None = None
    date_operator: str | None = None
    date: str | dt.date | None = None
    connector: str = "AND"


def compare(left: Column, op: str, right: Column) -> Column:
    """One of the six comparisons under SQL three-valued logic."""
    return {
        "=": lambda: left == right,
        "!=": lambda: left != right,
        ">": lambda: left > right,
        ">=": lambda: left >= right,
        "<": lambda: left < right,
        "<=": lambda: left <= right,
    }[op]()


def _literal(value: object, data_type: str) -> Column:
    if data_type in ("number", "integer"):
        try:
            number = Decimal(str(value).strip())
        except InvalidOperation as exc:
            raise ValueError(f"{value!r} is no number") from exc
        if number == number.to_integral_value() and abs(number) < 2**63:
            return F.lit(int(number))
        return F.lit(float(number))
    if data_type == "boolean":
        text = str(value).strip().lower()
        if text not in ("true", "false"):
            raise ValueError(f"{value!r} is no boolean")
        return F.lit(text == "true")
    return F.lit(str(value))


def _relative_offset(rule: Rule) -> tuple[int, str]:
    if rule.date_operator in NAMED_DATES:
        if str(rule.value) != "":
            raise ValueError(f"{rule.date_operator} takes no value")
        return NAMED_DATES[rule.date_operator]
    if rule.date_operator in COUNTED_DATES:
        sign, period = COUNTED_DATES[rule.date_operator]
        return sign * int(str(rule.value)), period
    raise ValueError(f"unknown date operator {rule.date_operator!r}")


def _date_test(column: Column, rule: Rule, as_of) -> Column:
    if rule.op in BUCKET_TESTS:
        offset, period = _relative_offset(rule)
        return compare(time_period_offset(column, period, as_of), BUCKET_TESTS[rule.op], F.lit(offset))
    if rule.date_operator == "EXACT_DATE":
        if not rule.date:
            raise ValueError("EXACT_DATE needs a date")
        day = F.lit(str(dt.date.fromisoformat(str(rule.date)))).cast("date")
    else:
        offset, period = _relative_offset(rule)
        day = date_add(as_of_date(as_of), offset, period)
    return compare(column.cast("date"), DATE_TESTS[rule.op], day)


def rule_column(df: DataFrame, rule: Rule, as_of=None) -> Column:
    """The boolean column of one rule; a rule that makes no sense raises."""
    name = resolve(df, rule.name)
    column = ref(name)
    data_type = rule.data_type or column_type(df, name)
    if rule.op in EMPTY_TESTS + BOOLEAN_TESTS:
        if str(rule.value) != "":
            raise ValueError(f"{rule.op} takes no value")
        return {
            "IS_EMPTY": lambda: is_blank(column),
            "NOT IS_EMPTY": lambda: ~is_blank(column),
            "IS NULL": lambda: column.isNull(),
            "IS NOT NULL": lambda: column.isNotNull(),
            "IS TRUE": lambda: column.eqNullSafe(F.lit(True)),
            "IS NOT TRUE": lambda: ~column.eqNullSafe(F.lit(True)),
            "IS FALSE": lambda: column.eqNullSafe(F.lit(False)),
            "IS NOT FALSE": lambda: ~column.eqNullSafe(F.lit(False)),
        }[rule.op]()
    if rule.op in DATE_TESTS or rule.op in BUCKET_TESTS:
        if data_type not in ("date", "datetime"):
            raise ValueError(f"{rule.op} needs a date column, {rule.name!r} is {data_type}")
        return _date_test(column, rule, as_of)
    if str(rule.value) == "":
        raise ValueError(f"{rule.op} on {rule.name!r} needs a value")
    if rule.op in TEXT_TESTS:
        value = F.lit(str(rule.value))
        text = column.cast("string")
        base = rule.op.removeprefix("NOT ")
        test = {"LIKE_CONTAINS": F.contains, "LIKE_START": F.startswith, "LIKE_END": F.endswith}[base](text, value)
        return ~test if rule.op.startswith("NOT ") else test
    if rule.op in COMPARISONS:
        if data_type in ("date", "datetime"):
            day = F.lit(str(rule.value)).cast("date" if data_type == "date" else "timestamp")
            return compare(column, rule.op, day)
        return compare(column, rule.op, _literal(rule.value, data_type))
    raise ValueError(f"unknown operator {rule.op!r}")


def rules_column(df: DataFrame, rules: list[Rule], as_of=None) -> Column:
    """All rules as one column: AND binds tighter than OR, the first connector is ignored."""
    if not rules:
        raise ValueError("no filter rules given")
    groups: list[list[Column]] = []
    for position, rule in enumerate(rules):
        if rule.connector not in ("AND", "OR"):
            raise ValueError(f"connector must be AND or OR, not {rule.connector!r}")
        test = rule_column(df, rule, as_of)
        if position == 0 or rule.connector == "OR":
            groups.append([test])
        else:
            groups[-1].append(test)
    clauses = [reduce(lambda a, b: a & b, group) for group in groups]
    return reduce(lambda a, b: a | b, clauses)


def gte_days_ago(column: Column, days: int, as_of=None) -> Column:
    """True when the date is at most ``days`` days before the reference day."""
    return column.cast("date") >= F.date_sub(as_of_date(as_of), days)


def not_true(c: Column) -> Column:
    return ~c.eqNullSafe(F.lit(True))


def in_list(c: Column, values: list) -> Column:
    return c.isin(*values)


def case(branches: list[tuple[Column, object]], default: object = None, logical: str | None = None) -> Column:
    """Ordered (condition, result) pairs; results share one type when ``logical`` names it."""
    from ..types import cast_to

    def as_column(value: object) -> Column:
        column = value if isinstance(value, Column) else F.lit(value)
        return cast_to(column, logical) if logical else column

    out = None
    for condition, value in branches:
        out = F.when(condition, as_column(value)) if out is None else out.when(condition, as_column(value))
    if out is None:
        raise ValueError("case needs at least one branch")
    return out.otherwise(as_column(default))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0, never null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
