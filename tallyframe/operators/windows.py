"""Window calculations over partitions.

Order-free calculations are a grouped aggregate joined back, so a group is combined map-side and
no task ever sees a whole group. Ordered ones use Spark's window for groups of ordinary size. A
table without partition columns, or one whose largest group is big, takes the split form, a prefix
scan in two passes: borders from a sample cut the order into ranges, an aggregate adds up every
range, and each range is then computed on its own with what the earlier ones add up to. Nothing is
written in between, and all calculations on one order share the passes.

A sum of doubles adds in another order in the split form, so its last digits can differ; sums of
decimals and integers are equal in both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, first_partitions
from ..types import ref, resolve
from .aggregate import Agg, summarize
from .keys import Sort, attach, check_sorts, flipped, null_safe, order_key, sort_columns, with_tiebreak, within_groups

ORDERED = ("LEAD", "LAG", "FILL_DOWN", "ROW_NUM", "RANK", "NTILE", "CUM_SUM", "CUM_MAX", "CUM_MIN")
RUNNING = {"CUM_SUM": F.sum, "CUM_MAX": F.max, "CUM_MIN": F.min}
GROUPED = ("SUM", "COUNT", "AVG", "MAX", "MIN", "MEDIAN", "MODE", "NUNIQUE", "STDDEV", "VAR", "FIRST", "LAST", "JOIN_STR", "JOIN_STR_DISTINCT")

# Groups above this many rows are split over tasks.
MAX_GROUP_ROWS = 5_000_000
# Rows per block when neighbours are looked up in the split form.
BLOCK_ROWS = 1_000_000
# Ranges of the split form for each partition a shuffle starts with, and sampled rows for each range.
RANGES_PER_PARTITION = 4
SAMPLE_PER_RANGE = 50


@dataclass(frozen=True)
class Calc:
    """One ordered calculation of ``windows``; the fields are those of ``window``."""

    out: str
    calc: str
    field: str | None = None
    offset: int = 1
    back_fill: bool = False
    ntile: int | None = None


def largest_group(df: DataFrame, partitions: list[str]) -> int:
    """Rows of the biggest group: one pass over the key columns, combined map-side."""
    row = df.groupBy(*[ref(p) for p in partitions]).count().agg(F.max("count")).first()
    return row[0] or 0


def window(
    df: DataFrame,
    out: str,
    calc: str,
    field: str | None = None,
    sorts: list[tuple[str, str]] = (),
    partitions: list[str] = (),
    offset: int = 1,
    back_fill: bool = False,
    ntile: int | None = None,
    delimiter: str = ", ",
    split: bool | None = None,
) -> DataFrame:
    """Add one window column.

    ``split``: force or forbid the split form; None decides by the largest group. Rows tied on the
    sorts are ordered by the remaining columns, so results can be repeated.
    """
    partitions = [resolve(df, p) for p in partitions]
    field = resolve(df, field) if field else None
    sorts = check_sorts(df, sorts)
    if calc in GROUPED:
        agg = Agg(calc, field, out, delimiter=delimiter, sorts=tuple(sorts))
        return attach(df, summarize(df, partitions, [agg]), partitions)
    return windows(df, [Calc(out, calc, field, offset, back_fill, ntile)], sorts, partitions, split)


def windows(df: DataFrame, calcs: list[Calc], sorts: list[tuple[str, str]], partitions: list[str] = (), split: bool | None = None) -> DataFrame:
    """Add several ordered calculations on one order; in the split form they share its passes."""
    partitions = [resolve(df, p) for p in partitions]
    sorts = check_sorts(df, sorts)
    calcs = [_checked(df, c, sorts) for c in calcs]
    if split is None:
        split = not partitions or largest_group(df, partitions) > MAX_GROUP_ROWS
    if not split:
        return df.withColumns({c.out: _plain(df, c, sorts, partitions) for c in calcs})
    order = within_groups(with_tiebreak(df, sorts), partitions)
    near = [c for c in calcs if c.calc in ("LEAD", "LAG")]
    scans = [c for c in calcs if c.calc in ("ROW_NUM", "NTILE", "FILL_DOWN", *RUNNING)]
    if near:
        scans = [*scans, Calc("__rn", "ROW_NUM")]
    out = _scan(df, scans, order, sorts, partitions) if scans else df
    if near:
        out = _neighbours(out, near, partitions)
    for c in calcs:
        if c.calc == "RANK":
            out = attach(out, *_ranks(df, c.out, sorts, partitions))
    return out.select(*[ref(n) for n in dict.fromkeys([*df.columns, *[c.out for c in calcs]])])


def _checked(df: DataFrame, c: Calc, sorts: list[Sort]) -> Calc:
    if c.calc not in ORDERED:
        raise ValueError(f"unknown calculation {c.calc!r}")
    if not sorts:
        raise ValueError(f"{c.calc} needs a sort")
    if c.field is None and c.calc in ("LEAD", "LAG", "FILL_DOWN", *RUNNING):
        raise ValueError(f"{c.calc} needs a field")
    if c.calc in ("LEAD", "LAG") and c.offset < 1:
        raise ValueError("offset must be positive")
    if c.calc == "NTILE" and (c.ntile is None or c.ntile < 1):
        raise ValueError("NTILE needs a positive ntile")
    return Calc(c.out, c.calc, resolve(df, c.field) if c.field else None, c.offset, c.back_fill, c.ntile)


def _plain(df: DataFrame, c: Calc, sorts: list[Sort], partitions: list[str]) -> Column:
    by = W.partitionBy(*[ref(p) for p in partitions])
    order = within_groups(with_tiebreak(df, sorts), partitions)
    ordered = by.orderBy(*sort_columns(order))
    if c.calc == "LEAD":
        return F.lead(ref(c.field), c.offset).over(ordered)
    if c.calc == "LAG":
        return F.lag(ref(c.field), c.offset).over(ordered)
    if c.calc == "ROW_NUM":
        return F.row_number().over(ordered).cast("bigint")
    if c.calc == "RANK":
        return F.rank().over(by.orderBy(*sort_columns(sorts))).cast("bigint")
    if c.calc == "NTILE":
        return F.ntile(c.ntile).over(ordered)
    return _so_far(c, by, order)


def _so_far(c: Calc, by, order: list[Sort]) -> Column:
    """Running sum, extreme or last value. Filling backwards runs along the flipped order: a frame that starts at
    its row and reads to the end of the group is read anew for every row."""
    along = flipped(order) if c.back_fill else order
    frame = by.orderBy(*sort_columns(along)).rowsBetween(W.unboundedPreceding, W.currentRow)
    return RUNNING[c.calc](ref(c.field)).over(frame) if c.calc in RUNNING else F.last(ref(c.field), ignorenulls=True).over(frame)


def _scan(df: DataFrame, calcs: list[Calc], order: list[Sort], sorts: list[Sort], partitions: list[str]) -> DataFrame:
    """Calculations that a range can do alone once it knows what the ranges before it add up to."""
    cuts = _cut_order(df, order, sorts)
    if not _repeatable(df, [*partitions, *[n for n, _ in cuts]]):
        df = cut_lineage(df)
    by = [ref(p) for p in partitions]
    sliced = _slices(df, partitions, cuts)
    parts = {}
    for i, c in enumerate(calcs):
        if c.calc == "FILL_DOWN":
            pick = F.min_by if c.back_fill else F.max_by
            parts[f"__part{i}"] = pick(ref(c.field), F.when(ref(c.field).isNotNull(), order_key(df, order)))
        else:
            parts[f"__part{i}"] = RUNNING[c.calc](ref(c.field)) if c.calc in RUNNING else F.count(F.lit(1))
    carried = _carry(sliced, calcs, parts, partitions)

    within = W.partitionBy(*by, "__slice")
    numbered = F.row_number().over(within.orderBy(*sort_columns(order)))
    local = {f"__local{i}": numbered if c.calc in ("ROW_NUM", "NTILE") else _so_far(c, within, order) for i, c in enumerate(calcs)}
    joined = _with_carry(sliced.withColumns(local), carried, partitions)
    values = {}
    for i, c in enumerate(calcs):
        here, before = ref(f"__local{i}"), ref(f"__before{i}")
        if c.calc == "FILL_DOWN":
            values[c.out] = F.coalesce(here, before)
        elif c.calc == "CUM_SUM":
            values[c.out] = F.coalesce(here + before, here, before)
        elif c.calc in RUNNING:
            values[c.out] = (F.greatest if c.calc == "CUM_MAX" else F.least)(here, before)
        else:
            values[c.out] = (here + F.coalesce(before, F.lit(0))).cast("bigint")
    gone = [f"{name}{i}" for i in range(len(calcs)) for name in ("__local", "__before")]
    result = joined.withColumns(values).drop("__slice", *gone)
    tiles = [c for c in calcs if c.calc == "NTILE"]
    if tiles:
        result = attach(result, df.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows")), partitions)
        result = result.withColumns({c.out: _ntile(ref(c.out), ref("__rows"), c.ntile) for c in tiles}).drop("__rows")
    return result


def _cut_order(df: DataFrame, order: list[Sort], sorts: list[Sort]) -> list[Sort]:
    """The beginning of the order that ranges are cut by: the sorts, and tie-breakers up to the first
    fraction, because sums of fractions can differ in their last digit when computed twice."""
    asked = {n for n, _ in sorts}
    cuts: list[Sort] = []
    for name, direction in order:
        if name not in asked and isinstance(df.schema[name].dataType, T.FractionalType):
            break
        cuts.append((name, direction))
    return cuts


def _repeatable(df: DataFrame, names: list[str]) -> bool:
    """Whether rows fall into the same ranges when ``df`` is computed twice: it has no random values and
    no unordered limits, and the fractions it is ordered by are read, not computed."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if not plan.deterministic() or any(word in plan.toString() for word in ("Limit", "Sample")):
        return False
    fractions = [n for n in names if isinstance(df.schema[n].dataType, (T.DoubleType, T.FloatType))]
    if not fractions:
        return True
    leaves, tops = plan.collectLeaves(), plan.output()
    read = {leaves.apply(i).output().apply(j).exprId().id() for i in range(leaves.size()) for j in range(leaves.apply(i).output().size())}
    top = {tops.apply(i).name(): tops.apply(i).exprId().id() for i in range(tops.size())}
    return all(top.get(n) in read for n in fractions)


def _slices(df: DataFrame, partitions: list[str], cuts: list[Sort]) -> DataFrame:
    """Add every row's range of (partitions, cuts): the number of borders at or below it."""
    ranges = RANGES_PER_PARTITION * first_partitions(df.sparkSession)
    key = order_key(df, [*[(p, "asc") for p in partitions], *cuts])
    bordered = df.withColumn("__borders", _borders(df, key, ranges).scalar())

    def place(key: Column) -> Column:
        def step(at: Column, width: Column) -> Column:
            return F.when(F.get(ref("__borders"), at + width - 1) <= key, at + width).otherwise(at)

        return F.aggregate(F.array(*[F.lit(1 << bit) for bit in reversed(range(ranges.bit_length()))]), F.lit(0), step)

    # the key is a lambda's argument, so that it is computed once and not in every step of the search
    return bordered.withColumn("__slice", F.get(F.transform(F.array(key), place), 0)).drop("__borders")


def _borders(df: DataFrame, key: Column, ranges: int) -> DataFrame:
    """One row: the sorted keys that begin a new range, from a sample by the keys' hashes.

    Sampled keys are counted before they are ordered, so a key of very many rows is one row there.
    """
    one_in = max(1, df.count() // (ranges * SAMPLE_PER_RANGE))
    sampled = df.select(key.alias("k")).filter(F.pmod(F.xxhash64("k"), F.lit(one_in)) == 0)
    counted = sampled.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("k").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    share = F.floor(before * ranges / F.sum("n").over(W.partitionBy()))
    begins = counted.select("k", share.alias("share")).groupBy("share").agg(F.min("k").alias("k")).filter("share > 0")
    return begins.agg(F.sort_array(F.collect_list("k")).alias("borders"))


def _carry(sliced: DataFrame, calcs: list[Calc], parts: dict[str, Column], partitions: list[str]) -> DataFrame:
    """What the other ranges of a group add up to, as far as a range needs it; only for groups that span several ranges.

    Each range border cuts at most one group, so this has at most twice as many rows as there are ranges.
    """
    by = [ref(p) for p in partitions]
    stats = sliced.groupBy(*by, "__slice").agg(*[part.alias(name) for name, part in parts.items()])
    along = W.partitionBy(*by).orderBy("__slice")
    earlier, later = along.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(*by).orderBy(F.desc("__slice")).rowsBetween(W.unboundedPreceding, -1)
    before = {}
    for i, (c, name) in enumerate(zip(calcs, parts, strict=True)):
        if c.calc == "FILL_DOWN":
            before[f"__before{i}"] = F.last(ref(name), ignorenulls=True).over(later if c.back_fill else earlier)
        else:
            before[f"__before{i}"] = RUNNING.get(c.calc, F.sum)(ref(name)).over(earlier)
    return (
        stats.withColumns({**before, "__pieces": F.count(F.lit(1)).over(W.partitionBy(*by))})
        .filter("__pieces > 1")
        .select(*[ref(p).alias(f"__key{i}") for i, p in enumerate(partitions)], ref("__slice").alias("__at"), *before)
    )


def _with_carry(computed: DataFrame, carried: DataFrame, partitions: list[str]) -> DataFrame:
    condition = computed["__slice"] == carried["__at"]
    if partitions:
        keys = [carried[f"__key{i}"] for i in range(len(partitions))]
        condition = condition & null_safe([computed[f"`{p}`"] for p in partitions], keys)
    # at most two rows a range, see _carry
    joined = computed.join(F.broadcast(carried), condition, "left")
    return joined.drop("__at", *[f"__key{i}" for i in range(len(partitions))])


def _ranks(df: DataFrame, out: str, sorts: list[Sort], partitions: list[str]) -> tuple[DataFrame, list[str]]:
    """Rank = rows of smaller sort value + 1, from running counts of the distinct sort values; and its keys."""
    names = list(dict.fromkeys([*partitions, *[n for n, _ in sorts]]))
    counts = df.groupBy(*[ref(n) for n in names]).agg(F.count(F.lit(1)).alias("__n"))
    running = windows(counts, [Calc("__upto", "CUM_SUM", "__n")], sorts, partitions, split=True)
    return running.select(*[ref(n) for n in names], (ref("__upto") - ref("__n") + 1).alias(out)), names


def _neighbours(numbered: DataFrame, calcs: list[Calc], partitions: list[str]) -> DataFrame:
    """Leads and lags on blocks of consecutive row numbers; border rows are copied next door."""
    lag = max([c.offset for c in calcs if c.calc == "LAG"], default=0)
    lead = max([c.offset for c in calcs if c.calc == "LEAD"], default=0)
    block = max(BLOCK_ROWS, lag, lead)
    position = (ref("__rn") - 1) % block
    home = F.floor((ref("__rn") - 1) / block).cast("bigint")

    def place(number: Column, guest: bool) -> Column:
        return F.struct(number.alias("block"), F.lit(guest).alias("guest"))

    places = F.array_compact(
        F.array(place(home, False), F.when(position >= block - lag, place(home + 1, True)), F.when((position < lead) & (home > 0), place(home - 1, True)))
    )
    spread = numbered.withColumn("__place", F.explode(places))
    order = W.partitionBy(*[ref(p) for p in partitions], "__place.block").orderBy("__rn")
    near = {c.out: (F.lag if c.calc == "LAG" else F.lead)(ref(c.field), c.offset).over(order) for c in calcs}
    return spread.withColumns(near).filter(~F.col("__place.guest")).drop("__place", "__rn")


def _ntile(position: Column, rows: Column, tiles: int) -> Column:
    """Tile of a row number: the first ``rows % tiles`` tiles hold one row more."""
    base = F.floor(rows / tiles)
    extra = rows % tiles
    long_rows = extra * (base + 1)
    return F.when(position <= long_rows, F.ceil(position / (base + 1))).otherwise(
        extra + F.ceil((position - long_rows) / F.greatest(base, F.lit(1)))
    ).cast("int")
