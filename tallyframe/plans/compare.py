"""Comparison of a new table with its baseline, and row-count laws between tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import key_text
from ..operators.keys import null_safe
from ..types import ref, resolve


def compare_tables(base: DataFrame, new: DataFrame, keys: list[str], measures: list[str] = (), texts: list[str] = (), tolerance: float = 0.01) -> DataFrame:
    """One row per key: equal, differs, repeated key, only in base or only in new, with what differs.

    Keys are compared trimmed and without regard to case, texts trimmed, measures within the
    tolerance. Where a key repeats, the row counts, the sums of the measures and the texts, each value as
    often as it occurs, are compared; when these agree but measures are given, the single rows may
    still differ, and the key is reported as ``repeated key``.
    """

    def grouped(df: DataFrame, s: str) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias(f"__n_{s}")]
        for i, m in enumerate(measures):
            aggs.append(F.sum(ref(resolve(df, m)).cast("double")).alias(f"__m{i}_{s}"))
        for i, t in enumerate(texts):
            text = F.trim(ref(resolve(df, t)).cast("string"))
            # sums of two hashes don't depend on the order and count every value as often as it occurs
            sums = [F.sum(F.xxhash64(text, F.lit(seed)).cast("decimal(38,0)")) for seed in (1, 2)]
            aggs.append(F.struct(*sums, F.count(text)).alias(f"__t{i}_{s}"))
        named = [key_text(ref(resolve(df, k))).alias(f"__k{i}_{s}") for i, k in enumerate(keys)]
        return df.groupBy(*named).agg(*aggs)

    a, b = grouped(base, "a"), grouped(new, "b")
    positions = range(len(keys))
    joined = a.join(b, null_safe([a[f"__k{i}_a"] for i in positions], [b[f"__k{i}_b"] for i in positions]), "full")
    gap = lambda i: F.abs(F.col(f"__m{i}_a") - F.col(f"__m{i}_b"))
    # a hair above the tolerance, so that 0.01 in binary fractions still counts as a cent
    limit = tolerance * (1 + 1e-6) + 1e-9
    tests = [("rows", F.col("__n_a") != F.col("__n_b"))]
    tests += [(m, F.coalesce(gap(i) > limit, ~F.col(f"__m{i}_a").eqNullSafe(F.col(f"__m{i}_b")))) for i, m in enumerate(measures)]
    tests += [(t, ~F.col(f"__t{i}_a").eqNullSafe(F.col(f"__t{i}_b"))) for i, t in enumerate(texts)]
    differing = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))
    status = (
        F.when(F.col("__n_b").isNull(), "only in base")
        .when(F.col("__n_a").isNull(), "only in new")
        .when(F.size(differing) > 0, "differs")
        .when((F.col("__n_a") > 1) & F.lit(bool(measures)), "repeated key")
        .otherwise("equal")
    )
    measured = []
    for i, m in enumerate(measures):
        measured += [F.col(f"__m{i}_a").alias(f"{m} base"), F.col(f"__m{i}_b").alias(f"{m} new")]
    return joined.select(
        *[F.when(F.col("__n_a").isNotNull(), F.col(f"__k{i}_a")).otherwise(F.col(f"__k{i}_b")).alias(k) for i, k in enumerate(keys)],
        status.alias("status"),
        F.when(status == "differs", F.array_join(differing, ", ")).otherwise("").alias("differences"),
        *measured,
    )


def compare_sums(base: DataFrame, new: DataFrame, measures: list[str], tolerance: float = 0.01) -> DataFrame:
    """One row per checkpoint figure: row count and measure sums of both tables."""

    def sums(df: DataFrame, s: str) -> DataFrame:
        cells = [F.struct(F.lit("rows").alias("checkpoint"), F.count(F.lit(1)).cast("double").alias(s))]
        cells += [F.struct(F.lit(m).alias("checkpoint"), F.coalesce(F.sum(ref(resolve(df, m)).cast("double")), F.lit(0.0)).alias(s)) for m in measures]
        return df.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")

    joined = sums(base, "base").join(sums(new, "new"), "checkpoint")
    difference = F.col("new") - F.col("base")
    return joined.select(
        "checkpoint",
        F.round("base", 2).alias("base"),
        F.round("new", 2).alias("new"),
        F.round(difference, 2).alias("difference"),
        (F.abs(difference) <= tolerance * (1 + 1e-6) + 1e-9).alias("within_tolerance"),
    )


def _size(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _law(name: str, expected, actual, passes, spark) -> DataFrame:
    row = spark.range(1).select(F.lit(name).alias("check"), expected.alias("expected"), actual.alias("actual"))
    return row.withColumn("passed", passes(F.col("expected"), F.col("actual")))


def row_count_checks(laws: dict[str, tuple]) -> DataFrame:
    """Row-count laws as a table (check, expected, actual, passed).

    Each law is one of
    ``("filter", input, true, false)``: both branches add up to the input;
    ``("union", [parts], whole)``: the parts add up to the whole;
    ``("unique", input, output)``: not more rows than before;
    ``("summarize", input, keys, output)``: one row per distinct key;
    ``("append", left, right, output)``: left times right;
    ``("equal", expected, output)``: the same number of rows.
    """
    if not laws:
        raise ValueError("no laws given")
    out = []
    for name, (kind, *tables) in laws.items():
        last = tables[-1]
        spark = last.sparkSession
        count = lambda df: _size(df).scalar()
        same, at_most = (lambda e, a: e == a), (lambda e, a: a <= e)
        if kind == "filter":
            out.append(_law(name, count(tables[0]), count(tables[1]) + count(tables[2]), same, spark))
        elif kind == "union":
            out.append(_law(name, reduce(lambda x, y: x + y, [count(p) for p in tables[0]]), count(last), same, spark))
        elif kind == "unique":
            out.append(_law(name, count(tables[0]), count(last), at_most, spark))
        elif kind == "summarize":
            keys = [ref(resolve(tables[0], k)) for k in tables[1]]
            out.append(_law(name, count(tables[0].select(*keys).distinct()), count(last), same, spark))
        elif kind == "append":
            out.append(_law(name, count(tables[0]) * count(tables[1]), count(last), same, spark))
        elif kind == "equal":
            out.append(_law(name, count(tables[0]), count(last), same, spark))
        else:
            raise ValueError(f"unknown law {kind!r}")
    return reduce(DataFrame.unionByName, out)
