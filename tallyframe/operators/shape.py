"""Column shaping: contract at the edge, edits, bulk formatting. No step changes the row count
except promoting a data row to headers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import excel_serial_date, excel_serial_datetime
from ..functions.predicates import case as case_column
from ..functions.predicates import flag as flag_column
from ..functions.text import is_blank, json_field, key_text, replace_literal
from ..types import convert, ref, resolve, spark_type


@dataclass(frozen=True)
class ColumnSpec:
    """One output column of an adapter."""

    name: str
    data_type: str = "string"
    mapped_from: str | None = None
    required: bool = False


def reject_duplicates(names: list[str]) -> None:
    seen: dict[str, str] = {}
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"column {name!r} clashes with {seen[name.lower()]!r}")
        seen[name.lower()] = name


def adapter(df: DataFrame, specs: list[ColumnSpec], passthrough: bool = False) -> DataFrame:
    """Typed contract over a raw table: the specs in order, missing source columns as nulls."""
    present = {name.lower(): name for name in df.columns}
    out, used = [], set()
    for spec in specs:
        source = (spec.mapped_from or spec.name).lower()
        if source in present:
            used.add(source)
            out.append(convert(df, present[source], spec.data_type).alias(spec.name))
        else:
            out.append(F.lit(None).cast(spark_type(spec.data_type)).alias(spec.name))
    names = [spec.name for spec in specs]
    if passthrough:
        rest = [name for name in df.columns if name.lower() not in used]
        out += [ref(name) for name in rest]
        names += rest
    reject_duplicates(names)
    return df.select(*out)


def _in_slot(df: DataFrame, name: str, column: Column, new_name: str | None = None) -> DataFrame:
    target = resolve(df, name)
    names = [new_name if new_name and c == target else c for c in df.columns]
    reject_duplicates(names)
    return df.select(*[column.alias(new_name or target) if c == target else ref(c) for c in df.columns])


def add_column(df: DataFrame, name: str, expression: Column | str) -> DataFrame:
    """New column at the end; a later edit may read it."""
    reject_duplicates([*df.columns, name])
    column = F.expr(expression) if isinstance(expression, str) else expression
    return df.withColumn(name, column)


def add_columns(df: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    """Ordered edits; each may read the columns added before it."""
    for name, expression in columns.items():
        df = add_column(df, name, expression)
    return df


def replace_column(df: DataFrame, name: str, expression: Column | str, new_name: str | None = None) -> DataFrame:
    """Overwrite a column in its slot."""
    return _in_slot(df, name, F.expr(expression) if isinstance(expression, str) else expression, new_name)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    mapping = {resolve(df, old): new for old, new in names.items()}
    out = [mapping.get(c, c) for c in df.columns]
    reject_duplicates(out)
    return df.select(*[ref(c).alias(new) for c, new in zip(df.columns, out)])


def retype(df: DataFrame, types: dict[str, str], fmt: str | None = None) -> DataFrame:
    """Cast columns in place; ``fmt`` is a date pattern for text to date or datetime."""
    wanted = {resolve(df, name): logical for name, logical in types.items()}

    def retyped(name: str) -> Column:
        logical = wanted[name]
        if fmt and logical == "date":
            return F.try_to_date(ref(name), fmt)
        if fmt and logical == "datetime":
            return F.try_to_timestamp(ref(name), F.lit(fmt))
        return convert(df, name, logical)

    return df.select(*[retyped(c).alias(c) if c in wanted else ref(c) for c in df.columns])


def hide(df: DataFrame, names: list[str]) -> DataFrame:
    hidden = {resolve(df, name) for name in names}
    return df.select(*[ref(c) for c in df.columns if c not in hidden])


def order_first(df: DataFrame, names: list[str]) -> DataFrame:
    """Listed columns first, the others after them in their own order."""
    first = [resolve(df, name) for name in names]
    return df.select(*[ref(c) for c in first], *[ref(c) for c in df.columns if c not in first])


def keep_only(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[ref(resolve(df, name)) for name in names])


def arith(a: Column, op: str, b: Column | float) -> Column:
    """add, sub, mul or div of a column with a column or a constant."""
    b = b if isinstance(b, Column) else F.lit(b)
    return {"add": lambda: a + b, "sub": lambda: a - b, "mul": lambda: a * b, "div": lambda: F.try_divide(a, b)}[op]()


def constant(value: object) -> Column:
    return F.lit(value)


case = case_column
flag = flag_column


def default_to(c: Column, value: object) -> Column:
    return F.coalesce(c, F.lit(value))


def json_value(c: Column, path: str) -> Column:
    return json_field(c, path)


def json_number(c: Column, path: str) -> Column:
    return json_field(c, path).try_cast("double")


SERIAL_RANGE = (20000, 60000)


def from_excel_serial(df: DataFrame, name: str, datetime: bool = False) -> DataFrame:
    """Spreadsheet serial numbers in the plausible range become dates; ISO dates stay dates."""
    column = ref(resolve(df, name))
    number = column.cast("string").try_cast("double")
    from_serial = excel_serial_datetime if datetime else excel_serial_date
    target = "timestamp" if datetime else "date"
    return _in_slot(
        df,
        name,
        F.when(number.between(*SERIAL_RANGE), from_serial(number)).otherwise(column.cast("string").try_cast(target)),
    )


def normalize_keys(df: DataFrame, names: list[str], case: str = "upper", trim: bool = True) -> DataFrame:
    """Key columns as trimmed text of one case."""
    keys = {resolve(df, name) for name in names}
    return df.select(*[key_text(ref(c), case, trim).alias(c) if c in keys else ref(c) for c in df.columns])


@dataclass(frozen=True)
class FormatStep:
    """A bulk action on all columns a matcher picks.

    action: hide, rename, change_type or fill; matcher: contain, start_with, end_with or is_empty.
    rename takes params [search, replacement] applied at start_with, end_with or anywhere (replace).
    """

    action: str
    matcher: str
    text: str = ""
    params: tuple = ()
    rename_at: str = "replace"


def _matched(df: DataFrame, step: FormatStep) -> list[str]:
    low = step.text.lower()
    if step.matcher == "is_empty":
        # one pass over the data: a column is empty when it has no non-blank value
        row = df.agg(*[F.max(~is_blank(ref(c))).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
        return [c for i, c in enumerate(df.columns) if not row[f"c{i}"]]
    if not step.text:
        raise ValueError(f"matcher {step.matcher} needs a text")
    tests = {
        "contain": lambda c: low in c.lower(),
        "start_with": lambda c: c.lower().startswith(low),
        "end_with": lambda c: c.lower().endswith(low),
    }
    if step.matcher not in tests:
        raise ValueError(f"unknown matcher {step.matcher!r}")
    return [c for c in df.columns if tests[step.matcher](c)]


def _renamed(name: str, step: FormatStep) -> str:
    find, replacement = step.params
    if step.rename_at == "start_with":
        return replacement + name[len(find):] if name.startswith(find) else name
    if step.rename_at == "end_with":
        return name[: len(name) - len(find)] + replacement if name.endswith(find) else name
    return name.replace(find, replacement)


def format_columns(df: DataFrame, steps: list[FormatStep]) -> DataFrame:
    """Apply bulk formatting steps in order."""
    for step in steps:
        hit = _matched(df, step)
        if step.action == "hide":
            df = hide(df, hit)
        elif step.action == "rename":
            df = rename(df, {c: _renamed(c, step) for c in hit})
        elif step.action == "change_type":
            df = retype(df, {c: step.params[0] for c in hit})
        elif step.action == "fill":
            fill = {c: F.when(is_blank(ref(c)), F.lit(step.params[0]).cast(df.schema[c].dataType)).otherwise(ref(c)) for c in hit}
            df = df.select(*[fill[c].alias(c) if c in fill else ref(c) for c in df.columns])
        else:
            raise ValueError(f"unknown action {step.action!r}")
    return df


def promote_header(df: DataFrame, row: int, order: str) -> DataFrame:
    """Row number ``row`` (1-based by the unique ``order`` column) becomes the header;
    it and the rows above it go away, and so does the order column.

    Only the header row itself reaches the driver.
    """
    from ..sources.readers import unique_headers

    if row < 1:
        raise ValueError("row is 1-based")
    body = [c for c in df.columns if c != order]
    top = df.orderBy(ref(order)).limit(row).orderBy(ref(order).desc()).first()
    if top is None:
        raise ValueError("no such row")
    names = unique_headers([top[c] for c in body])
    rest = df.filter(ref(order) > F.lit(top[order]))
    return rest.select(*[ref(c).alias(n) for c, n in zip(body, names)])


def search_replace(df: DataFrame, rules: list[tuple[str, str]], fields: list[str], case_sensitive: bool = False, whole_word: bool = False) -> DataFrame:
    """Literal find and replace over text fields, the rules in order."""
    chosen = {resolve(df, name) for name in fields}

    def apply(name: str) -> Column:
        out = ref(name)
        for find, replacement in rules:
            out = replace_literal(out, find, replacement, case_sensitive, whole_word)
        return out.alias(name)

    return df.select(*[apply(c) if c in chosen else ref(c) for c in df.columns])


def map_fields(df: DataFrame, names: list[str], formula, suffix: str = "") -> DataFrame:
    """One formula over many columns, in place or under a suffixed name."""
    chosen = [resolve(df, name) for name in names]
    if not suffix:
        return df.select(*[formula(ref(c)).alias(c) if c in chosen else ref(c) for c in df.columns])
    reject_duplicates([*df.columns, *[c + suffix for c in chosen]])
    return df.select("*", *[formula(ref(c)).alias(c + suffix) for c in chosen])


