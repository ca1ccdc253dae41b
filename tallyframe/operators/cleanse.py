"""Value clean-up right after the source contract."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, key_text
from ..types import column_type, number_text, ref, resolve

# Texts that stand for a missing value.
MISSING_TOKENS = ("", "-", "--", "n/a", "na", "nan", "none", "null", "#n/a")
# Date patterns tried in order; months, days and times may have one digit.
DATE_FORMATS = (
    "yyyy-M-d",
    "yyyy/M/d",
    "M/d/yyyy",
    "M-d-yyyy",
    "d/M/yyyy",
    "d-M-yyyy",
    "yyyy-M-d H:m:s",
    "M/d/yyyy H:m:s",
)


def parse_date(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First pattern that parses wins. Only texts of a pattern's shape are parsed by it, because a
    failed parse is costly."""

    def attempt(fmt: str) -> Column:
        parsed = F.try_to_timestamp(text, F.lit(fmt)).cast("date")
        if re.search("MMM|[^yMdHms\\W]", fmt):
            return parsed
        shape = re.sub("y+|M+|d+|H+|m+|s+", lambda piece: r"\d{4}" if piece[0] == "yyyy" else r"\d{1,2}", fmt)
        return F.when(F.regexp_like(text, F.lit(f"^{shape}$")), parsed)

    return F.coalesce(*[attempt(fmt) for fmt in formats])


def blank_to_null(c: Column) -> Column:
    """Trimmed text; blank becomes null."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def clean_text(c: Column, case: str = "preserve", missing: tuple[str, ...] = MISSING_TOKENS) -> Column:
    """Trim, turn missing tokens into null, set the case."""
    text = F.trim(c.cast("string"))
    kept = F.when(~F.lower(text).isin(*missing), text)
    if case == "proper":
        return F.initcap(kept)
    return key_text(kept, case, trim=False)


def clean_number(c: Column) -> Column:
    """Number without currency sign and thousands separators; (1.0) is negative; else null."""
    text = F.trim(c.cast("string"))
    negative = F.regexp_like(text, F.lit(r"^\(.*\)$"))
    # a minus sign may stand before or after the currency sign
    digits = F.regexp_replace(text, r"[$€£¥,()\s]", "")
    number = number_text(digits)
    return F.when(negative, -number).otherwise(number)


def clean_date(c: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Date of a text in one of the patterns; null when none fits."""
    return parse_date(F.trim(c.cast("string")), formats)


def cleanse(
    df: DataFrame,
    fields: list[str],
    trim: bool = True,
    null_to_blank: bool = False,
    null_to_zero: bool = False,
    case: str | None = None,
) -> DataFrame:
    """One-call clean-up of the given fields."""
    chosen = {resolve(df, name) for name in fields}

    def clean(name: str) -> Column:
        column = ref(name)
        kind = column_type(df, name)
        if kind == "string":
            if trim:
                column = F.trim(column)
            if case:
                column = {"upper": F.upper, "lower": F.lower, "proper": F.initcap}[case](column)
            if null_to_blank:
                column = F.coalesce(column, F.lit(""))
        elif kind in ("integer", "number") and null_to_zero:
            column = F.coalesce(column, F.lit(0).cast(df.schema[name].dataType))
        return column.alias(name)

    return df.select(*[clean(c) if c in chosen else ref(c) for c in df.columns])


def review_flags(
    df: DataFrame,
    ids: list[str] = (),
    keys: list[str] = (),
    dates: dict[str, str] | None = None,
    fallbacks: list[tuple[str, str]] = (),
    out: str = "Review Flag",
) -> DataFrame:
    """One text column listing what is wrong with a row, blank when nothing is.

    ids: must not be blank. keys: together unique. dates: raw text column -> parsed column.
    fallbacks: (primary, fallback) pairs where the fallback was used.
    """
    from .dedupe import flag_duplicates

    tests = [(is_blank(ref(name)), f"missing {name}") for name in ids]
    tests += [(is_blank(ref(p)) & ~is_blank(ref(f)), f"fallback {f}") for p, f in fallbacks]
    tests += [(~is_blank(ref(raw)) & ref(parsed).isNull(), f"invalid date {raw}") for raw, parsed in (dates or {}).items()]
    if keys:
        df = flag_duplicates(df, list(keys), out="__duplicate")
        tests.append((ref("__duplicate"), "duplicate key"))
    found = F.array_compact(F.array(*[F.when(test, F.lit(label)) for test, label in tests]))
    flagged = df.withColumn(out, F.array_join(found, "; "))
    return flagged.drop("__duplicate") if keys else flagged
