"""Join discovery over several tables: which column pairs share values, and how safe that is.

All pairs come from one join: each column's distinct values, under three spellings, are joined on
the spelling, so a value counts once per pair of columns however often it occurs.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import key_text, regex_extract
from ..session import by_merge, cut_lineage
from .profile import IDENTIFIER_NAME, KEY_MINIMUM, KEY_NAME, MEASURE_NAME, key_score, long_form



def _spellings() -> dict[str, Column]:
    exact = key_text(F.col("value"))
    return {
        "exact": exact,
        "alphanumeric": F.regexp_replace(exact, "[^A-Z0-9]", ""),
        "trailing_digits": regex_extract(F.col("value"), r"(\d{4,})$"),
    }


def _plain(name: str) -> str:
    return re.sub("[^a-z0-9]", "", name.lower())


def _column_norm(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def _matches(c: Column, pattern: str) -> Column:
    return F.regexp_like(c, F.lit(pattern))


def join_candidates(tables: dict[str, DataFrame]) -> DataFrame:
    """Column pairs of different tables with overlapping values, under their best strategy.

    Compared are likely keys of either table and columns of the same name; what a name rules out is
    not even read. Tables are taken in the given order: the earlier one is the left side.
    """
    cells, sizes = [], []
    for position, (table, df) in enumerate(tables.items()):
        others = {_plain(c) for other, frame in tables.items() if other != table for c in frame.columns}
        columns = [c for c in df.columns if not re.search(MEASURE_NAME, c) and (re.search(KEY_NAME, c) or _plain(c) in others)]
        if not columns:
            continue
        cells.append(long_form(df, columns).select(F.lit(position).alias("t"), "name", "value"))
        sizes.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(position).alias("t"), F.lit(table).alias("table"), "rows"))
    if not cells:
        raise ValueError("no table has a column that looks like a key")
    # values, facts and keys each serve several steps: computed once
    values = cut_lineage(reduce(DataFrame.unionByName, cells).groupBy("t", "name", "value").agg(F.count(F.lit(1)).alias("n")))
    rows = reduce(DataFrame.unionByName, sizes)
    facts = cut_lineage(
        values.groupBy("t", "name")
        .agg(
            F.sum("n").alias("filled"),
            F.count(F.lit(1)).alias("distinct"),
            F.sum(F.when(F.regexp_like("value", F.lit(r"\d{4,}$")) & ~F.regexp_like("value", F.lit(r"^\d+$")), F.col("n")).otherwise(0)).alias("prefixed"),
        )
        .join(rows, "t")
        .withColumn("key_like", F.round(key_score(F.col("name"), F.col("filled"), F.col("distinct"), F.col("rows")), 3) >= KEY_MINIMUM)
        .withColumn("norm", _column_norm(F.col("name")))
        .withColumn("unique_ratio", F.col("distinct") / F.col("filled"))
        .withColumn("prefixed_share", F.col("prefixed") / F.col("filled"))
        .select("t", "table", "name", "key_like", "norm", "unique_ratio", "prefixed_share")
    )
    # a column of no likely key pairs up by its name only
    named_again = F.size(F.collect_set("t").over(W.partitionBy("norm"))) > 1
    eligible = facts.withColumn("again", named_again).filter("key_like OR again").select("t", "name")
    spelled = F.array(*[F.struct(F.lit(s).alias("strategy"), c.alias("spelling")) for s, c in _spellings().items()])
    keys = cut_lineage(
        # a row for each column; joined by a shuffle, all values of a column would meet in one task
        values.join(F.broadcast(eligible), ["t", "name"], "left_semi")
        .select("t", "name", F.explode(spelled).alias("s"))
        .select("t", "name", "s.strategy", "s.spelling")
        .filter("spelling != ''")
        .distinct()
    )
    sizes_by_column = keys.groupBy("t", "name", "strategy").agg(F.count(F.lit(1)).alias("size"))
    # a spelling is held by at most as many columns as the tables have, however often it occurs
    other = keys.select(F.col("t").alias("rt"), F.col("name").alias("rn"), F.col("strategy").alias("rs"), F.col("spelling").alias("rv"))
    shared = by_merge(keys).join(by_merge(other), (F.col("spelling") == F.col("rv")) & (F.col("strategy") == F.col("rs")) & (F.col("t") < F.col("rt")))
    overlaps = shared.groupBy("strategy", F.col("t").alias("lt"), F.col("name").alias("ln"), "rt", "rn").agg(F.count(F.lit(1)).alias("overlap"))

    def side(prefix: str) -> DataFrame:
        named = facts.join(sizes_by_column, ["t", "name"])
        return named.select(*[F.col(c).alias(prefix + c) for c in named.columns])

    l, r = side("l_"), side("r_")
    joined = (
        overlaps.join(l, (F.col("lt") == F.col("l_t")) & (F.col("ln") == F.col("l_name")) & (F.col("strategy") == F.col("l_strategy")))
        .join(r, (F.col("rt") == F.col("r_t")) & (F.col("rn") == F.col("r_name")) & (F.col("strategy") == F.col("r_strategy")))
        .filter(
            (F.col("l_key_like") & F.col("r_key_like"))
            | (F.col("l_norm") == F.col("r_norm"))
        )
        .withColumn("left_ratio", F.round(F.col("overlap") / F.col("l_size"), 4))
        .withColumn("right_ratio", F.round(F.col("overlap") / F.col("r_size"), 4))
        .withColumn("score", F.least("left_ratio", "right_ratio"))
    )
    preference = F.when(F.col("strategy") == "exact", 0).when(F.col("strategy") == "alphanumeric", 1).otherwise(2)
    best = W.partitionBy("lt", "ln", "rt", "rn").orderBy(F.desc("score"), preference)
    chosen = joined.withColumn("__rank", F.row_number().over(best)).filter("__rank = 1")
    exact_score = F.least(F.col("overlap") / F.col("l_size"), F.col("overlap") / F.col("r_size"))
    confidence = F.when(exact_score >= 0.8, "high").when(exact_score >= 0.25, "medium").otherwise("low")
    named_key = _matches(F.col("ln"), KEY_NAME) | _matches(F.col("rn"), KEY_NAME)
    return chosen.withColumn("confidence", confidence).filter((F.col("confidence") != "low") | named_key).select(
        F.col("l_table").alias("leftSource"),
        F.col("r_table").alias("rightSource"),
        F.col("ln").alias("leftColumn"),
        F.col("rn").alias("rightColumn"),
        F.col("strategy").alias("matchStrategy"),
        F.col("overlap").alias("overlapCount"),
        F.col("left_ratio").alias("overlapRatioLeft"),
        F.col("right_ratio").alias("overlapRatioRight"),
        F.round("l_unique_ratio", 4).alias("uniqueRatioLeft"),
        F.round("r_unique_ratio", 4).alias("uniqueRatioRight"),
        "confidence",
        F.col("l_prefixed_share").alias("__left_prefixed"),
        F.col("r_prefixed_share").alias("__right_prefixed"),
    )


def review_split(candidates: DataFrame, limit: int | None = None) -> DataFrame:
    """Candidates with a `use`: ``suggested`` (safe) or ``review``; others are dropped.

    ``limit``: only the best so many of each kind per pair of tables.
    """
    l, r = F.col("leftColumn"), F.col("rightColumn")
    low = F.least("overlapRatioLeft", "overlapRatioRight")
    unique = F.greatest("uniqueRatioLeft", "uniqueRatioRight")
    same = _column_norm(l) == _column_norm(r)
    left_id, right_id = F.regexp_like(l, F.lit(IDENTIFIER_NAME)), F.regexp_like(r, F.lit(IDENTIFIER_NAME))
    safe = (
        (F.col("confidence") == "high")
        & F.col("matchStrategy").isin("exact", "alphanumeric")
        & (F.col("overlapCount") >= 2)
        & (low >= 0.95)
        & (unique >= 0.95)
        & F.when(same, left_id | right_id).otherwise(left_id & right_id)
    )
    review = (
        (F.col("overlapCount") >= 2)
        & (unique >= 0.5)
        & (left_id | right_id | _matches(l, KEY_NAME) | _matches(r, KEY_NAME))
    )
    marked = candidates.withColumn("use", F.when(safe, "suggested").when(review, "review")).filter("use is not null")
    if limit is not None:
        best = W.partitionBy("leftSource", "rightSource", "use").orderBy(low.desc(), F.desc("overlapCount"), "leftColumn", "rightColumn")
        marked = marked.withColumn("__rank", F.row_number().over(best)).filter(F.col("__rank") <= limit).drop("__rank")
    return marked.drop("__left_prefixed", "__right_prefixed")


def derived_key_hints(candidates: DataFrame) -> DataFrame:
    """Pairs that join on trailing digits, and the side(s) whose digits must be cut out first."""
    left, right = F.col("__left_prefixed") >= 0.6, F.col("__right_prefixed") >= 0.6
    field = lambda on, c: F.when(on, F.concat(F.col(c), F.lit(" Digits"))).otherwise(F.col(c))
    return candidates.filter((F.col("matchStrategy") == "trailing_digits") & (left | right)).select(
        "leftSource",
        "rightSource",
        "leftColumn",
        "rightColumn",
        field(left, "leftColumn").alias("leftJoinField"),
        field(right, "rightColumn").alias("rightJoinField"),
        "overlapCount",
        "overlapRatioLeft",
        "overlapRatioRight",
    )


def trailing_digits(c: Column) -> Column:
    """The digits a longer key ends in."""
    return regex_extract(c, "([0-9]+)$")
