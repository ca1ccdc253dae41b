"""Two-table joins with the unmatched rows of each side, naming of clashing columns, text
containment, tolerance and nearest joins.

Joins of tables carry no broadcast hints: Spark broadcasts a side only below its size threshold. A join of
alternatives (OR) becomes one equality join per alternative, each leaving out pairs an earlier one
already gave, because Spark would otherwise compare every pair of rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import by_merge, cut_lineage
from ..types import column_type, orderable, ref, resolve
from .shape import reject_duplicates

EQUALITY, THETA, TEXT = ("eq",), ("ne", "gt", "ge", "lt", "le"), ("contains", "is_part_of")
COMPARABLE = {"integer": "number", "datetime": "date"}
# Characters of the piece of a searched text that is looked up as a key.
PROBE = 8
# Parts that are looked for in every text, and pieces that are sent to every task.
FEW_PARTS, FEW_PROBES = 256, 100_000
# Exponents of the narrowest and the widest bin of an interval join; a longer interval meets every point.
MIN_LEVEL, MAX_LEVEL = -20, 1000
# Bins are numbered up to here; what lies beyond is in the last one.
MOST_BINS = 2.0**62
# Rows of a block of an inequality join, as long as the number of blocks allows it.
INEQUALITY_ROWS, INEQUALITY_BLOCKS = 1000, 4096
# Values of a block of the line on which rows are matched once.
NEAREST_BLOCK = 50_000
# Amounts below this fit in 18 digits with six decimals.
SHORT_AMOUNT = 9e11
# Whole numbers up to here are exact as doubles.
EXACT = 2.0**53
# Rows of a small table that is sent to every task.
EXPAND_BROADCAST_ROWS = 10_000


@dataclass(frozen=True)
class On:
    """One join condition: left column, operator, right column."""

    left: str
    op: str
    right: str


class Forks(NamedTuple):
    matched: DataFrame
    left_only: DataFrame
    right_only: DataFrame


def output_names(left: list[str], right: list[str]) -> list[str]:
    """Names of the right columns after the left ones: ``X (rhs)``, then ``X (rhs 2)`` on a clash."""
    taken = {name.lower() for name in left}
    out = []
    for name in right:
        candidate, n = name, 1
        while candidate.lower() in taken:
            candidate = f"{name} (rhs)" if n == 1 else f"{name} (rhs {n})"
            n += 1
        taken.add(candidate.lower())
        out.append(candidate)
    return out


class _Sides:
    """Both tables under collision-free column names, and conditions over them."""

    def __init__(self, left: DataFrame, right: DataFrame, on: list[On], null_safe: bool):
        if not on:
            raise ValueError("a join needs at least one condition")
        self.left_names, self.right_names = left.columns, right.columns
        self.left = left.toDF(*[f"__l{i}" for i in range(len(left.columns))])
        self.right = right.toDF(*[f"__r{i}" for i in range(len(right.columns))])
        self.null_safe = null_safe
        self.on = []
        for condition in on:
            lname, rname = resolve(left, condition.left), resolve(right, condition.right)
            if condition.op not in EQUALITY + THETA + TEXT:
                raise ValueError(f"unknown join operator {condition.op!r}")
            if condition.op == "eq":
                kinds = [COMPARABLE.get(k, k) for k in (column_type(left, lname), column_type(right, rname))]
                if kinds[0] != kinds[1]:
                    raise TypeError(f"{lname!r} is {kinds[0]} but {rname!r} is {kinds[1]}: cast one of them")
            self.on.append(On(f"__l{left.columns.index(lname)}", condition.op, f"__r{right.columns.index(rname)}"))

    def test(self, condition: On) -> Column:
        l, r = F.col(condition.left), F.col(condition.right)
        if condition.op == "eq":
            return l.eqNullSafe(r) if self.null_safe else l == r
        if condition.op in THETA:
            return {"ne": l != r, "gt": l > r, "ge": l >= r, "lt": l < r, "le": l <= r}[condition.op]
        whole, part = (l, r) if condition.op == "contains" else (r, l)
        return F.contains(whole.cast("string"), part.cast("string")) & (F.trim(part.cast("string")) != "")

    def ordered(self, condition: On) -> bool:
        kinds = ("integer", "number", "date", "datetime")
        return column_type(self.left, condition.left) in kinds and column_type(self.right, condition.right) in kinds

    def interval(self, conditions: list[On]) -> tuple[str, str, str, str] | None:
        """(point side, point, low, high) when one column has to lie between two of the other side."""
        for side, up, down in (("left", ("ge", "gt"), ("le", "lt")), ("right", ("le", "lt"), ("ge", "gt"))):
            for low in conditions:
                for high in conditions:
                    point, other = (low.left, low.right) if side == "left" else (low.right, low.left)
                    same, bound = (high.left, high.right) if side == "left" else (high.right, high.left)
                    if low.op in up and high.op in down and point == same and self.ordered(low) and self.ordered(high):
                        return side, point, other, bound
        return None

    def inequalities(self, conditions: list[On]) -> list[On]:
        """The first two inequalities between ordered columns, if there are two."""
        found = [c for c in conditions if c.op in ("gt", "ge", "lt", "le") and self.ordered(c)]
        return found[:2] if len(found) > 1 else []

    def without_equality(self, conditions: list[On]):
        """The way to join on inequalities alone without comparing all rows, if there is one."""
        if any(c.op not in THETA for c in conditions):
            return None
        return self.binned if self.interval(conditions) else self.dominated if self.inequalities(conditions) else None

    def binned(self, conditions: list[On], left: DataFrame, right: DataFrame) -> DataFrame:
        """Inner join on an interval as an equality join.

        An interval lies in one or two bins of the width that fits its length, a power of two; a
        point looks in its bin of every width that occurs (a few dozen at most). An interval without
        an end, which most points on its other side lie in, is copied to every part of the points.
        """
        side, point, low, high = self.interval(conditions)
        points, intervals = (left, right) if side == "left" else (right, left)
        number = _comparable
        low, high = number(intervals, low), number(intervals, high)
        length = F.when(high >= low, high - low)
        endless = F.isnan(length) | (length >= 2.0 ** (MAX_LEVEL - 1))
        level = F.when(endless, F.lit(MAX_LEVEL)).when(length > 0, F.ceil(F.log2(length)).cast("int") + 1).otherwise(F.lit(MIN_LEVEL))
        intervals = intervals.withColumn("__level", F.when(length.isNotNull(), F.greatest(level, F.lit(MIN_LEVEL)))).filter("__level IS NOT NULL")
        levels = sorted(r[0] for r in intervals.select("__level").distinct().collect())
        # numbers beyond the last bin share it, on both sides
        place = lambda c: F.floor(F.greatest(F.least(c, F.lit(MOST_BINS)), F.lit(-MOST_BINS)))
        width = F.pow(F.lit(2.0), F.when(F.col("__level") < MAX_LEVEL, F.col("__level")).otherwise(0))
        parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        bins = F.when(F.col("__level") < MAX_LEVEL, F.array_distinct(F.array(place(low / width), place(high / width)))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint")))
        intervals = intervals.withColumn("__bin", F.explode(bins))
        at = number(points, point)
        spread = F.pmod(F.xxhash64(*points.columns), F.lit(parts))
        places = [F.struct(F.lit(n).alias("__level"), (place(at / 2.0**n) if n < MAX_LEVEL else spread).alias("__bin")) for n in levels]
        points = points.withColumn("__place", F.explode(F.array(*places) if places else F.array().cast("array<struct<__level:int,__bin:bigint>>"))).select("*", "__place.*").drop("__place")
        left, right = (points, intervals) if side == "left" else (intervals, points)
        left, right = _dealt(left, right, ["__level", "__bin"], ["__level", "__bin"])
        joined = left.join(right, (left["__level"] == right["__level"]) & (left["__bin"] == right["__bin"]) & self.all_of(conditions))
        return joined.drop("__level", "__bin")

    def dominated(self, conditions: list[On], left: DataFrame, right: DataFrame) -> DataFrame:
        """Inner join on two inequalities (and whatever else) as an equality join.

        Both are turned into left < right. The values of each are cut into blocks at quantiles of both
        tables, and every quantile is a block of its own. Along the first, a tree of halves over the
        blocks brings each pair of different blocks together once, in the node where the left row is in
        the lower and the right row in the upper half; rows of one block meet in it. In a node, a left
        row goes to the blocks of the second that right rows of this node are in, its own and those
        above, where every pair fits. So rows are copied with the logarithm of the number of blocks, or
        where they give results; all conditions are tested at the end.
        """
        tests = self.inequalities(conditions)
        lower, upper, blocks, exact = left, right, [], []
        for i, test in enumerate(tests):
            up = test.op in ("lt", "le")
            lower = lower.withColumn(f"__v{i}", _sortable(lower, test.left, up))
            upper = upper.withColumn(f"__v{i}", _sortable(upper, test.right, up))
            exact.append(all(str(dict(df.dtypes)[n]).split("(")[0] != "decimal" for df, n in ((left, test.left), (right, test.right))))
        known = "__v0 IS NOT NULL AND __v1 IS NOT NULL"
        lower, upper = cut_lineage(lower.filter(known)), cut_lineage(upper.filter(known))
        values = lower.select("__v0", "__v1").unionByName(upper.select("__v0", "__v1"))
        count = max(1, min(INEQUALITY_BLOCKS, values.count() // INEQUALITY_ROWS))
        steps = [k / count for k in range(1, count)]
        for i in range(2):
            found = values.approxQuantile(f"__v{i}", steps, 0.25 / count) if steps else []
            blocks.append(sorted(set(found)))
        depth = [(2 * len(b) + 1).bit_length() for b in blocks]
        lower = lower.withColumns({f"__b{i}": _block(F.col(f"__v{i}"), blocks[i]) for i in range(2)})
        upper = upper.withColumns({f"__b{i}": _block(F.col(f"__v{i}"), blocks[i]) for i in range(2)})

        def alone(i: int) -> Column:
            """Whether no two rows of the block can fit: it is one value, and the test is strict."""
            if tests[i].op in ("le", "ge") or not exact[i]:
                return F.lit(False)
            return (F.col(f"__b{i}") % 2 == 1) & (F.abs(F.col(f"__v{i}")) < EXACT)

        def nodes(half: int) -> Column:
            at = F.col("__b0")
            every = [F.when(~alone(0), F.struct(F.lit(0).alias("level"), at.alias("node")))]
            every += [F.when(F.shiftright(at, n - 1).bitwiseAND(F.lit(1)) == half, F.struct(F.lit(n).alias("level"), F.shiftright(at, n).alias("node"))) for n in range(1, depth[0] + 1)]
            return F.explode(F.array_compact(F.array(*every)))

        # a node that holds few blocks has coarser blocks of the second value
        part = F.expr(f"shiftright(__b1, greatest(0, {depth[1]} - __at.level))")
        lower = lower.withColumn("__at", nodes(0)).withColumn("__own", part)
        upper = upper.withColumn("__at", nodes(1)).withColumn("__part", part)
        held = upper.groupBy("__at").agg(F.collect_set("__part").alias("__parts"))
        # as many numbers as blocks for each level of the tree
        lower = lower.join(F.broadcast(held), "__at")
        fine = F.lit(depth[1]) <= F.col("__at.level")
        above = lambda p, own, skip: (p > own) | ((p == own) & ~skip)
        lower = lower.withColumn("__skip", fine & alone(1)).withColumn("__part", F.explode(F.filter("__parts", lambda p: above(p, F.col("__own"), F.col("__skip")))))
        extra = ["__v0", "__v1", "__b0", "__b1"]
        lower, upper = lower.drop(*extra, "__own", "__parts", "__skip"), upper.drop(*extra)
        lower, upper = (df.select("*", F.col("__at.level").alias("__level"), F.col("__at.node").alias("__node")).drop("__at") for df in (lower, upper))
        lower, upper = _dealt(lower, upper, ["__level", "__node", "__part"], ["__level", "__node", "__part"])
        meet = (lower["__level"] == upper["__level"]) & (lower["__node"] == upper["__node"]) & (lower["__part"] == upper["__part"])
        return lower.join(upper, meet & self.all_of(conditions)).drop("__level", "__node", "__part")

    def partnered(self, conditions: list[On], side: str, rows: DataFrame) -> DataFrame:
        """Numbers (``__row``) of the rows of a side that have a partner on the other side.

        Two inequalities form no pairs for that: along the order of the first, the largest (or smallest) second
        value of the other side seen so far tells whether any of its rows fits. More conditions are tested on pairs.
        """
        from .windows import window

        other = self.right if side == "left" else self.left
        if len(conditions) > 2 or len(self.inequalities(conditions)) < 2:
            return self.without_equality(conditions)(conditions, *((rows, other) if side == "left" else (other, rows))).select("__row").distinct()
        turned = {"gt": "lt", "ge": "le", "lt": "gt", "le": "ge"}
        (own0, op0, there0), (own1, op1, there1) = [(c.left, c.op, c.right) if side == "left" else (c.right, turned[c.op], c.left) for c in conditions]
        up = op1 in ("lt", "le")
        asked = rows.select("__row", F.col(own0).alias("__first"), F.col(own1).alias("__own")).filter("__first IS NOT NULL AND __own IS NOT NULL")
        fits = other.select(F.col(there0).alias("__first"), F.col(there1).alias("__there")).filter("__first IS NOT NULL AND __there IS NOT NULL")
        fits = fits.groupBy("__first").agg((F.max if up else F.min)("__there").alias("__there"))
        both = cut_lineage(asked.withColumn("__asks", F.lit(1)).unionByName(fits.withColumn("__asks", F.lit(0)), allowMissingColumns=True))
        # the other side comes first among equals only where an equal value fits; row numbers part many equal ones
        sorts = [("__first", "dsc" if op0 in ("lt", "le") else "asc"), ("__asks", "asc" if op0 in ("le", "ge") else "dsc"), ("__row", "asc")]
        seen = window(both, "__best", "CUM_MAX" if up else "CUM_MIN", "__there", sorts)
        own, best = F.col("__own"), F.col("__best")
        return seen.filter("__asks = 1").filter({"lt": own < best, "le": own <= best, "gt": own > best, "ge": own >= best}[op1]).select("__row")

    def all_of(self, conditions: list[On]) -> Column:
        return reduce(lambda a, b: a & b, [self.test(c) for c in conditions])

    def prepared(self, conditions: list[On], side: str) -> tuple[DataFrame, Column]:
        """The given side and the join condition against the other, with an equality in it.

        Without an ``eq``, a containment test is replaced by a lookup of the matching text pairs.
        """
        frame = self.right if side == "right" else self.left
        condition = self.all_of(conditions)
        text = [c for c in conditions if c.op in TEXT]
        if not text or any(c.op == "eq" for c in conditions):
            return frame, condition
        first = text[0]
        lvalues, rvalues = self.left.select(first.left), self.right.select(first.right)
        plain, hashed = lambda name: F.col(name).cast("string"), lambda name: F.xxhash64(F.col(name).cast("string"))
        if first.op == "contains":
            pairs, lkey, rkey = _contained(lvalues, rvalues).toDF("__lv", "__rv"), hashed, plain
        else:
            pairs, lkey, rkey = _contained(rvalues, lvalues).toDF("__rv", "__lv"), plain, hashed
        if side == "right":
            return frame.join(pairs, rkey(first.right) == F.col("__rv")).drop("__rv"), (lkey(first.left) == F.col("__lv")) & condition
        return frame.join(pairs, lkey(first.left) == F.col("__lv")).drop("__lv"), (rkey(first.right) == F.col("__rv")) & condition

    def inner(self, conditions: list[On]) -> DataFrame:
        if way := self.without_equality(conditions):
            return way(conditions, self.left, self.right)
        right, condition = self.prepared(conditions, "right")
        return self.left.join(right, condition, "inner").drop("__lv")

    def unmatched(self, branches: list[list[On]], side: str) -> DataFrame:
        out = self.left if side == "left" else self.right
        for branch in branches:
            if self.without_equality(branch):
                # fixed row numbers, so that the rows found can be told from the others
                out = cut_lineage(out.withColumn("__row", F.monotonically_increasing_id()))
                out = out.join(self.partnered(branch, side, out), "__row", "left_anti").drop("__row")
                continue
            other, condition = self.prepared(branch, "right" if side == "left" else "left")
            out = out.join(other, condition, "left_anti")
        return out

    def matched(self, branches: list[list[On]]) -> DataFrame:
        parts = []
        for i, branch in enumerate(branches):
            part = self.inner(branch)
            for earlier in branches[:i]:
                part = part.filter(~F.coalesce(self.all_of(earlier), F.lit(False)))
            parts.append(part)
        return reduce(DataFrame.unionByName, parts)


def _branches(sides: _Sides, joiner: str) -> list[list[On]]:
    if joiner == "and":
        return [sides.on]
    if joiner == "or":
        return [[c] for c in sides.on]
    raise ValueError("joiner must be and or or")


def _named(sides: _Sides, joined: DataFrame, drop_keys: bool) -> DataFrame:
    """Left columns, then the right ones; same-named right keys of an inner join are dropped."""
    dropped = set()
    if drop_keys:
        for c in sides.on:
            i, j = int(c.left[3:]), int(c.right[3:])
            if c.op == "eq" and sides.left_names[i].lower() == sides.right_names[j].lower():
                dropped.add(j)
    kept = [j for j in range(len(sides.right_names)) if j not in dropped]
    names = output_names(sides.left_names, [sides.right_names[j] for j in kept])
    return joined.select(
        *[F.col(f"__l{i}").alias(n) for i, n in enumerate(sides.left_names)],
        *[F.col(f"__r{j}").alias(n) for j, n in zip(kept, names)],
    )


def blend(left: DataFrame, right: DataFrame, on: list[On], how: str = "inner", joiner: str = "and", null_safe: bool = False) -> DataFrame:
    """Join on any mix of conditions; null keys never match unless ``null_safe``."""
    if how not in ("inner", "left", "right", "full"):
        raise ValueError("how must be inner, left, right or full")
    sides = _Sides(left, right, on, null_safe)
    branches = _branches(sides, joiner)
    theta = all(c.op in THETA for c in sides.on) and not sides.without_equality(sides.on)
    native = len(branches) == 1 and (any(c.op == "eq" for c in sides.on) or theta)
    if native:
        joined = sides.left.join(sides.right, sides.all_of(sides.on), how)
    else:
        joined = sides.matched(branches)
        if how in ("left", "full"):
            joined = joined.unionByName(sides.unmatched(branches, "left"), allowMissingColumns=True)
        if how in ("right", "full"):
            joined = joined.unionByName(sides.unmatched(branches, "right"), allowMissingColumns=True)
    # alternatives may match on another key, so only a conjunction may drop its keys
    return _named(sides, joined, how == "inner" and joiner == "and" and not null_safe)


def blend_forks(left: DataFrame, right: DataFrame, on: list[On], how: str = "inner", joiner: str = "and", null_safe: bool = False) -> Forks:
    """The join and the rows of either side without a partner (own columns only)."""
    sides = _Sides(left, right, on, null_safe)
    branches = _branches(sides, joiner)
    return Forks(
        blend(left, right, on, how, joiner, null_safe),
        sides.unmatched(branches, "left").toDF(*left.columns),
        sides.unmatched(branches, "right").toDF(*right.columns),
    )


def semi(left: DataFrame, right: DataFrame, on: list[On], null_safe: bool = False) -> DataFrame:
    """Left rows that have a partner."""
    sides = _Sides(left, right, on, null_safe)
    if sides.without_equality(sides.on):
        numbered = cut_lineage(sides.left.withColumn("__row", F.monotonically_increasing_id()))
        found = sides.partnered(sides.on, "left", numbered)
        return numbered.join(found, "__row", "left_semi").drop("__row").toDF(*left.columns)
    other, condition = sides.prepared(sides.on, "right")
    return sides.left.join(other, condition, "left_semi").toDF(*left.columns)


def anti(left: DataFrame, right: DataFrame, on: list[On], null_safe: bool = False) -> DataFrame:
    """Left rows that have no partner."""
    sides = _Sides(left, right, on, null_safe)
    return sides.unmatched(_branches(sides, "and"), "left").toDF(*left.columns)


def contained_pairs(wholes: DataFrame, parts: DataFrame) -> DataFrame:
    """Distinct (whole, part) text pairs where the part occurs in the whole."""
    wholes = wholes.select(F.col(f"`{wholes.columns[0]}`").cast("string").alias("whole")).distinct()
    pairs = _contained(wholes, parts)
    return wholes.join(pairs, (F.xxhash64("whole") == F.col("hash")) & F.contains("whole", "part")).select("whole", "part")


def _contained(wholes: DataFrame, parts: DataFrame) -> DataFrame:
    """Distinct (hash of a whole, part) pairs; texts that share a hash have each other's, so a join on it tests them again.

    Up to ``FEW_PARTS`` parts are looked for in every whole where it is read. Of more, pieces of ``PROBE``
    characters that wholes and parts share are counted, and a part is looked up by the one of its own that
    occurs most rarely; a shorter part by itself. So texts that all begin alike are told apart by what they
    differ in, and candidates grow with the rarest piece's wholes. Wholes are moved as hashes, and
    their text once for each candidate's rows, never once for each piece.
    """
    wholes = wholes.select(F.col(f"`{wholes.columns[0]}`").cast("string").alias("whole")).select(F.xxhash64("whole").alias("hash"), "whole")
    parts = parts.select(F.col(f"`{parts.columns[0]}`").cast("string").alias("part")).filter(F.trim("part") != "").distinct()
    if parts.limit(FEW_PARTS + 1).count() <= FEW_PARTS:
        listed = wholes.withColumn("parts", parts.agg(F.collect_list("part")).scalar())
        return listed.select("hash", F.explode(F.filter("parts", lambda p: F.contains("whole", p))).alias("part")).distinct()
    sized = parts.withColumn("size", F.least(F.length("part"), F.lit(PROBE)))
    # at most PROBE different sizes
    sizes = sorted(r[0] for r in sized.select("size").distinct().collect())

    def pieces(df: DataFrame, text: str, key: str, size: int) -> DataFrame:
        return df.select(key, F.explode(F.array_distinct(_substrings(text, size))).alias("probe"))

    spread = reduce(DataFrame.unionByName, [pieces(wholes, "whole", "hash", n) for n in sizes])
    asked = cut_lineage(reduce(DataFrame.unionByName, [pieces(sized.filter(F.col("size") == n), "part", "part", n) for n in sizes]))

    def with_one_of(probes: DataFrame) -> DataFrame:
        return spread.join(F.broadcast(probes) if probes.count() <= FEW_PROBES else probes, "probe", "left_semi")

    counts = with_one_of(asked.select("probe").distinct()).groupBy("probe").agg(F.count(F.lit(1)).alias("n"))
    # a piece that no whole has rules its part out
    rarest = asked.join(counts, "probe", "left").groupBy("part").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "probe")).alias("r"))
    chosen = cut_lineage(rarest.filter("r.n > 0").select("part", "r.probe"))
    found = with_one_of(chosen.select("probe").distinct()).join(chosen, "probe").select("hash", "part")
    return wholes.join(found, "hash").filter(F.contains("whole", "part")).select("hash", "part").distinct()


def _substrings(name: str, size: int) -> Column:
    """All substrings of one length, in one pass over the text."""
    return F.coalesce(F.regexp_extract_all(name, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)), F.array().cast("array<string>"))


def lookup(df: DataFrame, reference: DataFrame, on: list[On], columns: list[str] | None = None, hit: str | None = None, check_unique: bool = True) -> DataFrame:
    """Keep every row and add the reference's columns; ``hit`` names a found / not found column."""
    keys = [resolve(reference, c.right) for c in on]
    wanted = [resolve(reference, c) for c in columns] if columns else [c for c in reference.columns if c not in keys]
    small = reference.select(*[ref(c) for c in dict.fromkeys([*keys, *wanted])])
    if check_unique:
        # a null key never matches, so it may repeat
        present = small.dropna(subset=keys)
        repeated = present.groupBy(*[ref(k) for k in keys]).count().filter("count > 1").limit(1).collect()
        if repeated:
            raise ValueError(f"reference keys repeat, for example {repeated[0].asDict()}")
    marked = small.withColumn("__hit", F.lit(True))
    joined = blend(df, marked, on, "left")
    names = output_names(df.columns, small.columns)
    added = [ref(n) for source, n in zip(small.columns, names) if source in wanted]
    extra = [F.coalesce(ref("__hit"), F.lit(False)).alias(hit)] if hit else []
    return joined.select(*[ref(c) for c in df.columns], *added, *extra)


def expand(main: DataFrame, small: DataFrame, max_small_rows: int | None = None) -> DataFrame:
    """Every main row with every row of a small table; an empty small table gives no rows.

    All combinations are what this operator is for; a caller's ``max_small_rows`` guards against
    them. The small table is broadcast when it counts ``EXPAND_BROADCAST_ROWS`` rows at most.
    """
    most = max(EXPAND_BROADCAST_ROWS, max_small_rows or 0)
    rows = small.limit(most + 1).count()
    if max_small_rows is not None and rows > max_small_rows:
        raise ValueError(f"the small side has more than {max_small_rows} rows")
    named = small.toDF(*output_names(main.columns, small.columns))
    return main.crossJoin(F.broadcast(named) if rows <= EXPAND_BROADCAST_ROWS else named)


def scaffold(first: DataFrame, second: DataFrame, max_small_rows: int | None = None) -> DataFrame:
    """All combinations of the distinct rows of two key tables, the smaller one second."""
    return expand(first.distinct(), second.distinct(), max_small_rows)


def generate_rows(df: DataFrame, start: Column, stop: Column, out: str, step: Column | None = None) -> DataFrame:
    """One row per value of a sequence, numbers or dates."""
    reject_duplicates([*df.columns, out])
    series = F.sequence(start, stop) if step is None else F.sequence(start, stop, step)
    return df.withColumn(out, F.explode(series))


def tolerance_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]] = (),
    amount: tuple[str, str, float] | None = None,
    date: tuple[str, str, int] | None = None,
) -> DataFrame:
    """Pairs equal on the keys whose amounts and dates lie within a tolerance (calendar days).

    The narrower of the two becomes a bucket; a right row is copied to the neighbouring buckets, so
    that the join is an equality join and gives every pair once.
    """
    if amount is None and date is None:
        raise ValueError("give an amount or a date tolerance")
    on = [On(l, "eq", r) for l, r in keys]
    buckets, residual = [], []
    if amount:
        lname, rname, tolerance = amount
        # whole millionths, so that the bucket and the test agree on every limit
        width = max(1, round(tolerance * 10**6))
        buckets.append(tuple(_bucket(ref(name), width) for name in (resolve(left, lname), resolve(right, rname))))
        # amounts are compared to the sixth decimal, so that 0.01 means a cent
        residual.append(lambda l, r: F.abs(l(lname).cast("decimal(38,6)") - r(rname).cast("decimal(38,6)")) <= F.lit(str(tolerance)).cast("decimal(38,6)"))
    if date:
        ldate, rdate, days = date
        buckets.append(tuple(_whole(F.unix_date(ref(name).cast("date")).cast("bigint"), days + 1) for name in (resolve(left, ldate), resolve(right, rdate))))
        residual.append(lambda l, r: F.abs(F.datediff(l(ldate).cast("date"), r(rdate).cast("date"))) <= days)
    for i, (lbucket, rbucket) in enumerate(buckets):
        left = left.withColumn(f"__b{i}", lbucket)
        right = right.withColumn(f"__b{i}", F.explode(F.array(rbucket - 1, rbucket, rbucket + 1)))
        on.append(On(f"__b{i}", "eq", f"__b{i}"))
    sides = _Sides(left, right, on, False)
    l = lambda name: F.col(f"__l{sides.left_names.index(resolve(left, name))}")
    r = lambda name: F.col(f"__r{sides.right_names.index(resolve(right, name))}")
    condition = reduce(lambda a, b: a & b, [sides.all_of(sides.on), *[test(l, r) for test in residual]])
    dealt = _dealt(sides.left, sides.right, [c.left for c in sides.on], [c.right for c in sides.on])
    joined = _named(sides, dealt[0].join(dealt[1], condition), True)
    return joined.drop(*[f"__b{i}" for i in range(len(buckets))])


def _dealt(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join whose pairs may be many times its rows, over all shuffle partitions.

    Small sides would else be merged into a few tasks, or sent to the one task that reads the other side's
    only file, and these would form all the pairs.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_merge(left.repartition(parts, *lkeys)), by_merge(right.repartition(parts, *rkeys))


def _bucket(amount: Column, width: int) -> Column:
    """Number of the interval of so many millionths that an amount lies in; decimals only where 64 bits don't hold it."""
    exact = amount.cast("decimal(38,6)")
    fits = F.abs(amount.cast("double")) < SHORT_AMOUNT
    short = _whole((F.when(fits, exact).cast("decimal(18,6)") * 10**6).cast("bigint"), width)
    units = (exact * 10**6).cast("decimal(38,0)")
    wide = ((units - F.pmod(units, F.lit(width))) / F.lit(width)).cast("bigint")
    return F.when(fits, short).otherwise(wide)


def _whole(units: Column, width: int) -> Column:
    """Number of the interval of so many units that a whole number lies in."""
    low = units - F.pmod(units, F.lit(width).cast("bigint"))
    return F.call_function("div", low, F.lit(width).cast("bigint"))


def nearest(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], value: tuple[str, str], direction: str = "nearest") -> DataFrame:
    """Every left row with the one right row of its key whose value is closest (earlier on a tie).

    direction: backward (at or before), forward (at or after) or nearest. Both tables are stacked
    and the last seen right row is filled down, so no candidate pairs arise.
    """
    from .windows import window

    if direction not in ("backward", "forward", "nearest"):
        raise ValueError("direction must be backward, forward or nearest")
    lkeys = [resolve(left, l) for l, _ in keys]
    rkeys = [resolve(right, r) for _, r in keys]
    lvalue, rvalue = resolve(left, value[0]), resolve(right, value[1])
    names = output_names(left.columns, right.columns)
    key_columns = [f"__k{i}" for i in range(len(keys))]
    lrows = left.select(
        *[ref(k).alias(a) for k, a in zip(lkeys, key_columns)],
        ref(lvalue).alias("__at"),
        F.struct(*[ref(c).alias(f"c{i}") for i, c in enumerate(left.columns)]).alias("__left"),
    )
    rrows = right.filter(ref(rvalue).isNotNull()).select(
        *[ref(k).alias(a) for k, a in zip(rkeys, key_columns)],
        ref(rvalue).alias("__at"),
        F.struct(*[ref(c).alias(f"c{i}") for i, c in enumerate(right.columns)]).alias("__right"),
    )
    both = lrows.unionByName(rrows, allowMissingColumns=True)
    is_left = ref("__left").isNotNull()
    if direction != "forward":
        # right rows first among equals, so that an equal value counts as at or before
        both = window(both.withColumn("side", is_left.cast("int")), "__past", "FILL_DOWN", "__right", [("__at", "asc"), ("side", "asc")], key_columns)
    if direction != "backward":
        both = window(both.withColumn("side", (~is_left).cast("int")), "__next", "FILL_DOWN", "__right", [("__at", "asc"), ("side", "asc")], key_columns, back_fill=True)
    position = right.columns.index(rvalue)
    rows = both.filter(is_left)
    matchable = reduce(lambda a, b: a & b, [ref(k).isNotNull() for k in key_columns], ref("__at").isNotNull())
    if direction == "backward":
        chosen = ref("__past")
    elif direction == "forward":
        chosen = ref("__next")
    else:
        at = lambda struct: _as_number(left, lvalue, F.col(f"{struct}.c{position}"))
        here = _as_number(left, lvalue, ref("__at"))
        closer = F.coalesce(at("__next") - here < here - at("__past"), ref("__past").isNull())
        chosen = F.when(closer, ref("__next")).otherwise(ref("__past"))
    rows = rows.withColumn("__found", F.when(matchable, chosen))
    return rows.select(
        *[F.col(f"__left.c{i}").alias(c) for i, c in enumerate(left.columns)],
        *[F.col(f"__found.c{i}").alias(n) for i, n in enumerate(names)],
    )


def _comparable(df: DataFrame, name: str) -> Column:
    """A double in the column's order; dates and times share one scale."""
    kind, column = column_type(df, name), F.col(name)
    return (F.unix_micros(column.cast("timestamp")) if kind in ("date", "datetime") else column).cast("double")


def _sortable(df: DataFrame, name: str, up: bool) -> Column:
    """A double in the column's order, or in the opposite one; what is not a number counts as the largest."""
    number = _comparable(df, name)
    number = F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)
    return number if up else -number


def _block(value: Column, bounds: list[float]) -> Column:
    """Number of the block a value lies in: odd numbers are the bounds themselves, even ones what lies between."""
    if not bounds:
        return F.lit(0)
    size = 1 << len(bounds).bit_length()
    # beyond the bounds stands what no value is larger than
    listed = F.expr("array(" + ", ".join([f"double('{b!r}')" for b in bounds] + ["double('NaN')"] * (size - len(bounds))) + ")")
    steps = F.array(*[F.lit(size >> n) for n in range(1, size.bit_length())])
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(listed, at + step - 1) < value, at + step).otherwise(at))
    return below * 2 + F.coalesce(F.get(listed, below) == value, F.lit(False)).cast("int")


def nearest_once(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], value: tuple[str, str], direction: str = "nearest") -> DataFrame:
    """As ``nearest``, but every right row is used once: the closest pair of all matches first.

    Of equally close pairs the one with the earlier left, then the earlier right value comes first; rows
    of one value count in the order of their other columns. Values with their numbers of rows stand on a
    line. Blocks of the line, each in one task, match the closest neighbours as far as nothing outside
    the block can come closer; what is left moves together for the next round.
    """
    from .windows import MAX_GROUP_ROWS, window

    if direction not in ("backward", "forward", "nearest"):
        raise ValueError("direction must be backward, forward or nearest")
    lkeys, rkeys = [resolve(left, l) for l, _ in keys], [resolve(right, r) for _, r in keys]
    lvalue, rvalue = resolve(left, value[0]), resolve(right, value[1])
    spots = [*[f"__k{i}" for i in range(len(keys))], "__at"]
    sides, counts = [], []
    for df, own, at, s in ((left, lkeys, lvalue, "l"), (right, rkeys, rvalue, "r")):
        plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        where = [*[F.col(f"c{df.columns.index(k)}") for k in own], _comparable(plain, f"c{df.columns.index(at)}")]
        rows = plain.withColumns(dict(zip(spots, where)))
        sides.append(cut_lineage(rows))
        other = "r" if s == "l" else "l"
        counts.append(sides[-1].dropna(subset=spots).groupBy(*spots).agg(F.count(F.lit(1)).alias(f"{s}_n"), F.lit(0).cast("bigint").alias(f"{other}_n")))
    cells = counts[0].unionByName(counts[1]).groupBy(*spots).agg(F.sum("l_n").alias("l_n"), F.sum("r_n").alias("r_n"))
    cells = cut_lineage(cells.withColumn("m", F.least("l_n", "r_n")))
    largest = cells.agg(F.max(F.greatest("l_n", "r_n"))).first()[0] or 0
    zero = F.lit(0).cast("bigint")
    # equal values first; of each value one side is left
    link = [*spots[:-1], "l_at", "r_at", "l_from", "r_from", "m"]
    links = [cells.filter("m > 0").withColumns({"l_at": F.col("__at"), "r_at": F.col("__at"), "l_from": zero, "r_from": zero}).select(*link)]
    live = cells.filter("l_n <> r_n").select(*spots, (F.col("l_n") > F.col("r_n")).alias("left"), F.abs(F.col("l_n") - F.col("r_n")).alias("n"), F.col("m").alias("used"))
    live, size = cut_lineage(live), NEAREST_BLOCK
    while live.select("left").distinct().count() == 2:
        order = [F.col(c) for c in spots]
        group = (F.to_json(F.struct(*spots[:-1])) if keys else F.lit("")).alias("group")
        blocks = cut_lineage(live.repartitionByRange(-(-live.count() // size), *order).sortWithinPartitions(*order).select("*", group))
        # a few numbers for each block
        ends = {r.block: r for r in blocks.select("group", F.col("__at").alias("at"), "left").mapInPandas(_block_ends, ", ".join(_ENDS)).collect()}
        kinds = ", ".join(f"`{n}` {t}" for n, t in blocks.dtypes if n != "group")
        done = cut_lineage(blocks.mapInPandas(_settled_block(ends, direction), f"{kinds}, l_at double, r_at double, l_from long, r_from long, m long"))
        found, before = done.filter("m IS NOT NULL").select(*link), live
        live = cut_lineage(done.filter("m IS NULL AND n > 0").select(*live.columns))
        if found.isEmpty():
            if before.count() <= size:  # the whole line was one block
                break
            size *= 2
        links.append(found)
    pairs = cut_lineage(reduce(DataFrame.unionByName, links))

    def numbered(rows: DataFrame) -> DataFrame:
        """Rows with their number among those of their value."""
        sorts = [(c, "asc") for c in rows.columns if c not in spots and orderable(rows, c)][:1] or [("__at", "asc")]
        return window(rows.dropna(subset=spots), "__rn", "ROW_NUM", sorts=sorts, partitions=spots, split=largest > MAX_GROUP_ROWS)

    def whole(rows: DataFrame, s: str) -> Column:
        return F.struct(*[c for c in rows.columns if c.startswith("c")]).alias(f"{s}_row")

    def placed(s: str, rows: DataFrame) -> DataFrame:
        named = numbered(rows).select(*spots[:-1], F.col("__at").alias(f"{s}_at"), "__rn", whole(rows, s))
        slot = F.col("__rn") - 1 - F.col(f"{s}_from")
        return named.join(pairs, [*spots[:-1], f"{s}_at"]).withColumn("slot", slot).filter("slot >= 0 AND slot < m")

    meet = [*spots[:-1], "l_at", "r_at", "slot"]
    both = placed("l", sides[0]).join(placed("r", sides[1]).select(*meet, "r_row"), meet)
    # left rows without a partner: those of a value that no link takes, and those without a value or key
    taken = pairs.groupBy(*spots[:-1], F.col("l_at").alias("__at")).agg(F.sum("m").alias("__taken"))
    alone = numbered(sides[0]).join(taken, spots, "left").filter("__taken IS NULL OR __rn > __taken")
    missing = sides[0].filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spots]))
    every = both.select("l_row", "r_row")
    for rows in (alone, missing):
        every = every.unionByName(rows.select(whole(sides[0], "l"), F.lit(None).cast(both.schema["r_row"].dataType).alias("r_row")))
    names = output_names(left.columns, right.columns)
    return every.select(*[F.col(f"l_row.c{i}").alias(c) for i, c in enumerate(left.columns)], *[F.col(f"r_row.c{i}").alias(n) for i, n in enumerate(names)])


_ENDS = ["block int", "first_group string", "last_group string", "first_left double", "first_right double", "last_left double", "last_right double"]


def _block_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a block's first group the first value of either side, of its last group the last one."""
    first_group = last_group = None
    first, last = {}, {}
    for batch in batches:
        for group, at, left in zip(batch["group"], batch["at"], batch["left"]):
            if first_group is None:
                first_group = group
            if group != last_group:
                last_group, last = group, {}
            if group == first_group:
                first.setdefault(left, at)
            last[left] = at
    if first_group is not None:
        row = (TaskContext.get().partitionId(), first_group, last_group, first.get(True), first.get(False), last.get(True), last.get(False))
        yield pd.DataFrame([row], columns=[c.split()[0] for c in _ENDS])


def _settled_block(ends: dict, direction: str):
    """Function that adds the links of a block which are settled, whatever the blocks beside it hold."""
    order = sorted(ends)

    def outside(group: str, block: int, side: bool, before: bool) -> float:
        """The nearest value of a side of the group in the blocks before or after."""
        place = order.index(block)
        for other in reversed(order[:place]) if before else order[place + 1 :]:
            end = ends[other]
            near, far = (end.last_group, end.first_group) if before else (end.first_group, end.last_group)
            found = getattr(end, f"{'last' if before else 'first'}_{'left' if side else 'right'}")
            if near != group:
                break
            if found is not None:
                return found
            if far != group:
                break
        return -math.inf if before else math.inf

    def line(group: str, block: int, at: list[float], left: list[bool], n: list[int], used: list[int]) -> list[tuple]:
        size = len(at)
        before, after = ({s: outside(group, block, s, back) for s in (True, False)} for back in (True, False))
        previous, following, waits = list(range(-1, size - 1)), list(range(1, size + 1)), [False] * size
        heap: list[tuple] = []

        def push(i: int, j: int) -> None:
            # backward: the right row stands before the left one
            if left[i] != left[j] and (direction == "nearest" or left[j] == (direction == "backward")):
                l, r = (i, j) if left[i] else (j, i)
                heapq.heappush(heap, (at[j] - at[i], at[l], at[r], i, j))

        def earlier(i: int, back: bool, distance: float) -> bool:
            """Whether a partner on the other side of ``i``, out of reach yet, may come before one at this distance."""
            if direction != "nearest" and left[i] != ((direction == "backward") == back):
                return False
            step, j = (previous, previous[i]) if back else (following, following[i])
            while 0 <= j < size and left[j] == left[i]:
                if abs(at[i] - at[j]) > distance:
                    return False
                j = step[j]
            partner = at[j] if 0 <= j < size else (before if back else after)[not left[i]]
            if 0 <= j < size and not waits[j]:
                return False
            # of two equally close partners, the pair with the one before comes first
            return abs(at[i] - partner) <= distance if back else abs(at[i] - partner) < distance

        for i in range(size - 1):
            push(i, i + 1)
        out = []
        while heap:
            distance, l_at, r_at, i, j = heapq.heappop(heap)
            if not n[i] or not n[j] or following[i] != j:
                continue
            if waits[i] or waits[j] or earlier(i, True, distance) or earlier(j, False, distance):
                waits[i] = waits[j] = True
                continue
            m = min(n[i], n[j])
            l, r = (i, j) if left[i] else (j, i)
            out.append((l_at, r_at, used[l], used[r], m, i))
            for k in (i, j):
                n[k], used[k] = n[k] - m, used[k] + m
            a, b = (previous[i] if not n[i] else i), (following[j] if not n[j] else j)
            if a >= 0:
                following[a] = b
            if b < size:
                previous[b] = a
            if a >= 0 and b < size:
                push(a, b)
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [batch for batch in batches if len(batch)]
        if not parts:
            return
        block, number = pd.concat(parts, ignore_index=True), TaskContext.get().partitionId()
        extra = ["l_at", "r_at", "l_from", "r_from", "m"]
        for group, rows in block.groupby("group", sort=False):
            n, used = rows["n"].tolist(), rows["used"].tolist()
            found = line(group, number, rows["__at"].tolist(), rows["left"].tolist(), n, used)
            rows = rows.drop(columns=["group"])
            yield rows.assign(n=n, used=used, **{c: None for c in extra})
            if found:
                linked = rows.iloc[[f[5] for f in found]].reset_index(drop=True)
                yield linked.assign(**{c: [f[k] for f in found] for k, c in enumerate(extra)})

    return run


def _as_number(df: DataFrame, name: str, column: Column) -> Column:
    kind = column_type(df, name)
    if kind == "date":
        return F.unix_date(column)
    if kind == "datetime":
        return F.unix_micros(column.cast("timestamp"))
    return column


