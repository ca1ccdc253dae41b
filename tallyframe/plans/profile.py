"""Profile of a table: types, fill, distinct values, samples, key and date candidates, data traps.

Counts per column come from one pass; distinct values from one grouping of (column, value) pairs,
which spreads a frequent value over all tasks before it is counted.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank
from ..operators.cleanse import parse_date
from ..operators.shape import SERIAL_RANGE
from ..types import logical_type, number_text, ref

# What column names suggest.
DATE_NAME = r"(?i)(date|dt|timestamp|time)"
KEY_NAME = r"(?i)\b(id|key|code|number|num|no|#|ref|reference|document|doc|vendor|account|item|rct|rtv|profit ctr)\b"
MEASURE_NAME = r"(?i)(date|timestamp|time|amount|total|count|status|meaning|matched|variance|flag|description|text|note|period)"
IDENTIFIER_NAME = r"(?i)(id|#|num|number|row|reference|ref|document|doc)"
HEADER_LABEL = (
    r"(?i)\b(id|type|date|status|source|amount|total|count|vendor|account|reference|ref|document|description|"
    r"population|support|matched|variance|note|class|period|profit|disposition|meaning|groups)\b"
)
SAMPLES = 5
KEY_MINIMUM = 0.55
DATE_SHARE = 0.6


def as_number(c: Column) -> Column:
    """Number of a text with thousands separators, else null."""
    return number_text(F.replace(F.trim(c.cast("string")), F.lit(","), F.lit("")))


def long_form(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(name, value) rows: every non-blank value as trimmed text under its column name."""
    columns = columns or df.columns
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.trim(ref(c).cast("string")).alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("cell")).select("cell.name", "cell.value").filter("value != ''")


def infer_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """Logical type each column's values allow: integer, number or string; typed columns as they are.

    One pass over all values.
    """
    columns = columns or df.columns
    typed = {c: logical_type(df.schema[c].dataType) for c in columns}
    text = [c for c in columns if typed[c] == "string"]
    if text:
        tests = []
        for i, c in enumerate(text):
            number, filled = as_number(ref(c)), ~is_blank(ref(c))
            tests += [
                F.count_if(filled).alias(f"n{i}"),
                F.count_if(filled & number.isNull()).alias(f"t{i}"),
                F.count_if(filled & (number != F.floor(number))).alias(f"f{i}"),
            ]
        row = df.agg(*tests).first()
        for i, c in enumerate(text):
            if row[f"n{i}"] and not row[f"t{i}"]:
                typed[c] = "number" if row[f"f{i}"] else "integer"
    return typed


def profile_table(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: name, dataType, sampleValues, nonEmptyCount, distinctCount.

    Samples are the smallest values as text. ``approximate`` estimates distinct counts in the one
    pass that counts and finds the samples in a few more, so no values are shuffled.
    """
    counts = []
    for i, c in enumerate(df.columns):
        filled, number = ~is_blank(ref(c)), as_number(ref(c))
        value = F.when(filled, F.trim(ref(c).cast("string")))
        counts.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("name"),
                F.lit(logical_type(df.schema[c].dataType)).alias("declared"),
                F.count_if(filled).alias("nonEmptyCount"),
                F.count_if(filled & number.isNull()).alias("texts"),
                F.count_if(filled & (number != F.floor(number))).alias("fractions"),
                (F.approx_count_distinct(value) if approximate else F.lit(None).cast("bigint")).alias("estimate"),
            )
        )
    columns = df.agg(F.array(*counts).alias("columns")).select(F.explode("columns").alias("c")).select("c.*")
    inferred = (
        F.when(F.col("declared") != "string", F.col("declared"))
        .when((F.col("nonEmptyCount") == 0) | (F.col("texts") > 0), "string")
        .when(F.col("fractions") > 0, "number")
        .otherwise("integer")
    )
    if approximate:
        samples = _smallest_values(df)
        distinct = columns.select("name", F.col("estimate").alias("distinctCount"))
    else:
        values = long_form(df).distinct()
        smallest = W.partitionBy("name").orderBy("value")
        samples = (
            values.withColumn("rank", F.row_number().over(smallest))
            .filter(F.col("rank") <= SAMPLES)
            .groupBy("name")
            .agg(F.sort_array(F.collect_list("value")).alias("sampleValues"))
        )
        distinct = values.groupBy("name").agg(F.count(F.lit(1)).alias("distinctCount"))
    return (
        columns.withColumn("dataType", inferred)
        .join(samples, "name", "left")
        .join(distinct, "name", "left")
        .select(
            "position",
            "name",
            "dataType",
            F.coalesce("sampleValues", F.array().cast("array<string>")).alias("sampleValues"),
            "nonEmptyCount",
            F.coalesce("distinctCount", F.lit(0)).alias("distinctCount"),
        )
    )


def _smallest_values(df: DataFrame) -> DataFrame:
    """(name, sampleValues): each pass takes every column's smallest value above the one before."""
    values = {c: F.when(~is_blank(ref(c)), F.trim(ref(c).cast("string"))) for c in df.columns}
    found: dict[str, list[str]] = {c: [] for c in df.columns}
    for _ in range(SAMPLES):
        open_columns = [c for c, known in found.items() if known or not any(found.values())]
        mins = [F.min(F.when(values[c] > F.lit(found[c][-1]), values[c]) if found[c] else values[c]) for c in open_columns]
        row = df.agg(*mins).first() if mins else ()
        for c, value in zip(open_columns, row):
            if value is not None:
                found[c].append(value)
        if all(value is None for value in row):
            break
    return df.sparkSession.createDataFrame([(c, known) for c, known in found.items()], "name string, sampleValues array<string>")


def expected_schema(profile: DataFrame, dates: DataFrame) -> DataFrame:
    """Adapter contract proposed from a profile and its date candidates."""
    found = dates.select(F.col("column").alias("name"), "expectedDataType")
    return profile.join(found, "name", "left").select(
        "name",
        F.coalesce("expectedDataType", "dataType").alias("dataType"),
        F.col("name").alias("mappedFrom"),
        F.lit(False).alias("required"),
    )


def date_candidates(df: DataFrame) -> DataFrame:
    """Columns that hold dates: typed ones, and date-named ones whose values parse or are serials."""
    rows = []
    for c in df.columns:
        declared = logical_type(df.schema[c].dataType)
        filled, number = ~is_blank(ref(c)), as_number(ref(c))
        text = F.trim(ref(c).cast("string"))
        # besides the patterns: ISO dates with a time or without separators
        iso = F.when(F.regexp_like(text, F.lit(r"^\d{4}-\d{2}-\d{2}[T ]")), text.try_cast("date"))
        basic = F.when(F.regexp_like(text, F.lit(r"^\d{8}$")), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))
        is_date = F.coalesce(parse_date(text), iso, basic).isNotNull()
        serial = number.between(*SERIAL_RANGE)
        named = bool(re.search(DATE_NAME, c))
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(declared).alias("declared"),
                F.lit(named).alias("named"),
                F.count_if(filled).alias("filled"),
                (F.count_if(filled & is_date) if named else F.lit(0).cast("bigint")).alias("parsed"),
                (F.count_if(filled & serial) if named else F.lit(0).cast("bigint")).alias("serials"),
                (F.count_if(filled & serial & (number != F.floor(number))) if named else F.lit(0).cast("bigint")).alias("timed"),
            )
        )
    table = df.agg(F.array(*rows).alias("c")).select(F.explode("c").alias("c")).select("c.*").filter("filled > 0")
    typed = F.col("declared").isin("date", "datetime")
    serial = F.col("named") & (F.col("serials") / F.col("filled") >= DATE_SHARE)
    parsed = F.col("named") & (F.col("parsed") / F.col("filled") >= DATE_SHARE)
    return table.filter(typed | serial | parsed).select(
        "column",
        F.col("declared").alias("observedDataType"),
        F.when(typed, F.col("declared")).when(serial & (F.col("timed") > 0), "datetime").otherwise("date").alias("expectedDataType"),
        (~typed).alias("needsAdapter"),
        F.when(typed, "typed").when(serial, "serial").otherwise("text").alias("evidence"),
        F.when(typed, F.col("filled")).when(serial, F.col("serials")).otherwise(F.col("parsed")).alias("dateCount"),
        F.col("filled").alias("nonEmptyCount"),
    )


def key_score(name: Column, non_empty: Column, distinct: Column, rows: Column) -> Column:
    """How much a column looks like an identifier: name, distinctness and fill, at most 1."""
    score = 0.65 * distinct / F.greatest(non_empty, F.lit(1)) + 0.25 * non_empty / F.greatest(rows, F.lit(1)) + 0.35
    looks_like_key = F.regexp_like(name, F.lit(KEY_NAME)) & ~F.regexp_like(name, F.lit(MEASURE_NAME))
    return F.when(looks_like_key & (rows > 0), F.least(F.lit(1.0), score)).otherwise(F.lit(0.0))


def key_candidates(profile: DataFrame, rows: Column | int, limit: int | None = None) -> DataFrame:
    """Likely identifiers of a profiled table, the best first; all of them, or so many as ``limit``."""
    rows = F.lit(rows) if isinstance(rows, int) else rows
    score = F.round(key_score(F.col("name"), F.col("nonEmptyCount"), F.col("distinctCount"), rows), 3)
    found = (
        profile.select(F.col("name").alias("column"), score.alias("score"), "nonEmptyCount", "distinctCount")
        .filter(F.col("score") >= KEY_MINIMUM)
        .orderBy(F.desc("score"), "column")
    )
    return found if limit is None else found.limit(limit)


def embedded_headers(df: DataFrame, order: str) -> DataFrame:
    """Row numbers (column ``order``, consecutive) inside the data that look like another header.

    A row qualifies by its labels; only then are its next three rows looked up for their fill.
    """
    body = [c for c in df.columns if c != order]
    cells = F.array(*[ref(c).cast("string") for c in body])
    filled = F.filter(cells, lambda v: F.trim(v) != "")
    rows = df.select(ref(order).alias("row"), filled.alias("cells"))
    is_text = lambda v: as_number(v).isNull()
    texts = F.filter("cells", is_text)
    labels = F.filter(texts, lambda v: F.regexp_like(v, F.lit(HEADER_LABEL)))
    measured = rows.select(
        "row",
        F.size("cells").alias("n"),
        F.size(texts).alias("n_text"),
        F.size(labels).alias("n_label"),
        F.size(F.array_distinct(F.transform("cells", lambda v: F.lower(F.trim(v))))).alias("n_unique"),
    )
    candidates = measured.filter("n >= 2 AND n_text >= 2 AND n_label >= 2 AND n - n_text <= 1")
    next_rows = candidates.select("*", F.explode(F.array(*[F.col("row") + i for i in (1, 2, 3)])).alias("next"))
    width = len(body)
    density = (
        next_rows.join(rows.select(F.col("row").alias("next"), (F.size("cells") / width).alias("share")), "next")
        .groupBy("row", "n", "n_text", "n_unique")
        .agg(F.avg("share").alias("density"))
    )
    score = 0.35 * F.col("n") + 2.0 * F.col("n_text") / F.col("n") + 1.5 * F.col("n_unique") / F.col("n") + 1.5 * F.col("density")
    return density.select("row", F.round(score, 6).alias("score")).filter("score >= 3.0")


def trap_report(df: DataFrame, keys: list[str] = (), not_equal: list[str] = ()) -> DataFrame:
    """Data that makes later steps go wrong: (trap, column, rows) for every trap that occurs.

    Blank, untrimmed or mixed-case keys, keys whose leading zeros a number type would lose,
    repeated keys, and nulls in columns tested with `!=`.
    """
    tests = []
    for k in keys:
        text = ref(k).cast("string")
        tests += [
            ("blank key", k, F.count_if(is_blank(ref(k)))),
            ("untrimmed key", k, F.count_if(text != F.trim(text))),
            ("leading zeros", k, F.count_if(F.regexp_like(F.trim(text), F.lit(r"^0\d+$")))),
        ]
        if isinstance(df.schema[k].dataType, T.StringType):
            tests.append(("mixed-case key", k, F.count_if(text != F.upper(text)) * F.max(text == F.upper(text)).cast("bigint")))
    tests += [("null in not-equal test", c, F.count_if(ref(c).isNull())) for c in not_equal]
    report = None
    if tests:
        rows = [F.struct(F.lit(trap).alias("trap"), F.lit(c).alias("column"), n.alias("rows")) for trap, c, n in tests]
        report = df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    if keys:
        repeated = (
            df.groupBy(*[ref(k) for k in keys])
            .count()
            .filter("count > 1")
            .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"))
            .select(F.lit("duplicate key").alias("trap"), F.lit("+".join(keys)).alias("column"), "rows")
        )
        report = repeated if report is None else report.unionByName(repeated)
    if report is None:
        raise ValueError("name keys or not-equal columns")
    return report.filter("rows > 0")
