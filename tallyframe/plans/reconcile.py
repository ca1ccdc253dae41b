"""Two-sided reconciliation: one-to-one matching within tolerances, classification, totals.

Lines equal in keys, business day and amount form a cell with a count. Matching runs between cells:
a cell has few neighbours within the tolerances however many lines it holds, so no step pairs up
all lines of a busy key. Closest cells match first, each taking as many lines as both still have;
lines then pair by their number within the cell. Which cells match is settled in blocks of neighbouring
amounts: a block walks through its pairs in their order as far as no pair of another block can come
first. A chain of pairs that wait for each other takes a round for each block it runs through.
"""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import as_of_date, business_day_index
from ..functions.text import key_text
from ..operators.windows import MAX_GROUP_ROWS, window
from ..session import cut_lineage
from ..types import ref, resolve

# Proposals for the settings a user has to confirm, and what each type compares.
TYPES = {
    "bank": {"date_tolerance": 5, "keys": ("document number", "check number", "deposit reference", "vendor")},
    "credit card": {"date_tolerance": 3, "keys": ("merchant", "cardholder", "receipt", "expense report reference")},
    "gl to subledger": {"date_tolerance": 3, "keys": ("document number", "customer", "vendor", "account", "batch")},
    "intercompany": {"date_tolerance": 3, "keys": ("entity", "document number", "currency")},
    "balance sheet": {"date_tolerance": 3, "keys": ("account", "contract", "loan", "asset", "support id", "period")},
}
AMOUNT_PROPOSAL = 0.01
# Amounts and tolerances are compared in whole millionths; up to this amount they fit in 64 bits.
UNITS = 1_000_000
LONG_AMOUNT = 9e12
# Candidate pairs of cells that a block settles.
BLOCK_PAIRS = 50_000
MATERIALITY_PROPOSAL = 10_000.0
SUPERVISOR_AMOUNT, CONTROLLER_AMOUNT, CONTROLLER_TOTAL = 10_000, 50_000, 100_000
SUPERVISOR_DAYS, CONTROLLER_DAYS = 60, 90
GREEN_RATE, AMBER_RATE = 95.0, 85.0


@dataclass(frozen=True)
class Settings:
    """Control settings; none has a default because each decides what counts as matched."""

    amount_tolerance: float
    date_tolerance: int
    materiality: float


@dataclass(frozen=True)
class Side:
    """Column names of one side. ``id`` is unique; ``keys`` pair up with the other side's by position.

    ``currency`` and ``foreign`` (the amount in that currency) find lines that differ by the rate only.
    """

    id: str
    date: str
    amount: str
    keys: list[str] = field(default_factory=list)
    reference: str | None = None
    counterparty: str | None = None
    account: str | None = None
    description: str | None = None
    currency: str | None = None
    foreign: str | None = None


def matching_keys(kind: str, a_columns: list[str], b_columns: list[str]) -> list[tuple[str, str]]:
    """The columns of either side that a reconciliation type matches on, as far as both sides have them.

    Names are compared without case, blanks, ``_``, ``#`` and words such as number.
    """
    plain = lambda name: "".join(w for w in re.split(r"[^a-z]+", name.lower()) if w not in ("", "number", "no", "id"))
    wanted = [plain(k) for k in TYPES[kind]["keys"]]
    sides = [{plain(c): c for c in reversed(columns)} for columns in (a_columns, b_columns)]
    return [(sides[0][k], sides[1][k]) for k in wanted if k in sides[0] and k in sides[1]]


def proposed_settings(kind: str) -> Settings:
    """The usual settings of a reconciliation type, for the user to confirm."""
    return Settings(AMOUNT_PROPOSAL, TYPES[kind]["date_tolerance"], MATERIALITY_PROPOSAL)


def business_index(c: Column, holidays: list[dt.date] = ()) -> Column:
    """Running count of working days; a day off counts as the working day before it."""
    index = business_day_index(c)
    weekdays = [h for h in holidays if h.weekday() < 5]
    if not weekdays:
        return index
    days = F.array(*[F.lit(str(h)).cast("date") for h in weekdays])
    return index - F.size(F.filter(days, lambda h: h <= c.cast("date")))


def _units(c: Column, wide: bool) -> Column:
    """Amount in whole millionths."""
    return (c.cast("decimal(38,6)") * UNITS).cast("decimal(38,0)" if wide else "bigint")


def _wide(df: DataFrame, side: Side) -> bool:
    """Whether an amount needs more than 64 bits."""
    most = df.agg(F.max(F.abs(ref(resolve(df, side.amount)).cast("double")))).first()[0]
    return most is not None and most > LONG_AMOUNT


def _lines(df: DataFrame, side: Side, negate: bool, holidays, wide: bool) -> DataFrame:
    """Key columns k0, k1, ..., business day, units and id of all lines that can match.

    A line without a date or amount, or with a null key, matches nothing.
    """
    units = _units(ref(resolve(df, side.amount)), wide)
    keys = [key_text(ref(resolve(df, k))).alias(f"k{i}") for i, k in enumerate(side.keys)]
    lines = df.select(
        *keys,
        business_index(ref(resolve(df, side.date)), holidays).alias("day"),
        (-units if negate else units).alias("units"),
        ref(resolve(df, side.id)).alias("id"),
    )
    return lines.dropna(subset=[c for c in lines.columns if c != "id"])


def _neighbours(a: DataFrame, b: DataFrame, keys: list[str], units: int, days: int) -> DataFrame:
    """Pairs of cells with lines left that lie within both tolerances."""
    width = units + 1
    shifted = F.explode(F.sequence(F.col("a_day") - days, F.col("a_day") + days)).alias("b_day")
    left = a.select("*", shifted).withColumn("bucket", F.floor(F.col("a_units") / width))
    near = F.floor(F.col("b_units") / width)
    right = b.withColumn("bucket", F.explode(F.array(near - 1, near, near + 1)) if units else near)
    joined = left.join(right, [*keys, "b_day", "bucket"])
    return joined.filter(F.abs(F.col("a_units") - F.col("b_units")) <= units).drop("bucket")


def _link_cells(a: DataFrame, b: DataFrame, keys: list[str], units: int, days: int) -> tuple[DataFrame, int]:
    """How many lines of which cells match: closest cells first, until nothing is left to match.

    Rows: both cells, the first used line number of either cell, the number of lines. Also the size
    of the largest cell.
    """
    link = [*keys, "a_day", "a_units", "b_day", "b_units"]
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    # equal cells first: one row per cell with the lines of either side, in one aggregate for both
    sides = [
        lines.select(*keys, "day", "units", *[(one if s == t else zero).alias(f"{t}_n") for t in ("a", "b")])
        for s, lines in (("a", a), ("b", b))
    ]
    both = sides[0].unionByName(sides[1]).groupBy(*keys, "day", "units").agg(F.sum("a_n").alias("a_n"), F.sum("b_n").alias("b_n"))
    both = cut_lineage(both.withColumn("m", F.least("a_n", "b_n")))
    largest = both.agg(F.max(F.greatest("a_n", "b_n"))).first()[0] or 0
    same = both.filter("m > 0")
    for s in ("a", "b"):
        same = same.withColumn(f"{s}_day", F.col("day")).withColumn(f"{s}_units", F.col("units")).withColumn(f"{s}_from", zero)
    links = [same.select(*link, "a_from", "b_from", "m")]
    if not units and not days:
        return links[0], largest
    rest = [
        both.filter(f"{s}_n > m").select(
            *keys,
            F.col("day").alias(f"{s}_day"),
            F.col("units").alias(f"{s}_units"),
            (F.col(f"{s}_n") - F.col("m")).alias(f"{s}_left"),
            F.col("m").alias(f"{s}_used"),
        )
        for s in ("a", "b")
    ]
    cell = lambda s: F.to_json(F.struct(*keys, f"{s}_day", f"{s}_units"))
    order = [F.abs(F.col("a_day") - F.col("b_day")), F.abs(F.col("a_units") - F.col("b_units")), *[F.col(c) for c in ("a_day", "a_units", "b_day", "b_units")]]
    rank = F.struct(*[c.alias(f"r{i}") for i, c in enumerate(order)])
    by_a, by_b = W.partitionBy(*keys, "a_day", "a_units"), W.partitionBy(*keys, "b_day", "b_units")
    live = cut_lineage(_neighbours(*rest, keys, units, days))
    while count := live.count():
        whole = live.withColumn("b_pairs", F.count(F.lit(1)).over(by_b)).withColumn("b_first", rank == F.min(rank).over(by_b))
        # all pairs of a cell of side A are in one block
        blocks = whole.repartitionByRange(-(-count // BLOCK_PAIRS), *[F.col(c) for c in (*keys, "a_units", "a_day")]).sortWithinPartitions(*order)
        kinds = ", ".join(f"`{n}` {t}" for n, t in live.dtypes)
        named = blocks.withColumns({"a_cell": cell("a"), "b_cell": cell("b")})
        chosen = cut_lineage(named.select(*live.columns, "a_cell", "b_cell", "b_pairs", "b_first").mapInPandas(_settled, f"{kinds}, m long, a_from long, b_from long"))
        links.append(chosen.filter("m > 0").select(*link, "a_from", "b_from", "m"))
        taken = chosen.withColumn("a_take", F.sum("m").over(by_a)).withColumn("b_take", F.sum("m").over(by_b))
        left = taken.filter("a_left > a_take AND b_left > b_take")
        for s in ("a", "b"):
            left = left.withColumns({f"{s}_left": F.col(f"{s}_left") - F.col(f"{s}_take"), f"{s}_used": F.col(f"{s}_used") + F.col(f"{s}_take")})
        live = cut_lineage(left.select(*live.columns))
    return reduce(DataFrame.unionByName, links), largest


def _settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many lines each pair of a block takes, and from which of either cell, as far as the block can tell.

    Pairs come closest first. One that has to wait makes the later ones of its cells wait. A cell of side B
    with pairs in other blocks too takes its very first pair only.
    """
    parts = [batch for batch in batches if len(batch)]
    if not parts:
        return
    block = pd.concat(parts, ignore_index=True)
    here = Counter(block["b_cell"])
    left = {**dict(zip(block["a_cell"], block["a_left"])), **{("b", c): n for c, n in zip(block["b_cell"], block["b_left"])}}
    used = {**dict(zip(block["a_cell"], block["a_used"])), **{("b", c): n for c, n in zip(block["b_cell"], block["b_used"])}}
    waits: set = set()
    found = []
    for a, b, pairs, first in zip(block["a_cell"], block["b_cell"], block["b_pairs"], block["b_first"]):
        key = ("b", b)
        m = start_a = start_b = 0
        if left[a] and left[key]:
            shared = here[b] < pairs
            if a in waits or key in waits or (shared and not first):
                waits |= {a, key}
            else:
                m, start_a, start_b = min(left[a], left[key]), used[a], used[key]
                for c in (a, key):
                    left[c], used[c] = left[c] - m, used[c] + m
                if shared:
                    waits.add(key)
        found.append((m, start_a, start_b))
    out = block.drop(columns=["a_cell", "b_cell", "b_pairs", "b_first"])
    out[["m", "a_from", "b_from"]] = found
    yield out


def match_lines(a: DataFrame, b: DataFrame, a_side: Side, b_side: Side, settings: Settings, negate_b: bool = False, holidays: list[dt.date] = ()) -> DataFrame:
    """One-to-one pairs of line ids: a_id, b_id, day_gap (business days), amount_diff (A - B).

    The closest pair wins: smallest day gap, then smallest amount difference, then earlier and
    smaller ones; equal lines pair in id order. ``negate_b`` compares with B's sign turned.
    """
    if len(a_side.keys) != len(b_side.keys):
        raise ValueError("both sides need the same number of keys")
    keys = [f"k{i}" for i in range(len(a_side.keys))]
    wide = _wide(a, a_side) or _wide(b, b_side)
    sides = [_lines(df, side, neg, holidays, wide) for df, side, neg in ((a, a_side, False), (b, b_side, negate_b))]
    tolerance = round(settings.amount_tolerance * UNITS)
    links, largest = _link_cells(*sides, keys, tolerance, settings.date_tolerance)
    link = [*keys, "a_day", "a_units", "b_day", "b_units"]

    def placed(lines: DataFrame, s: str) -> DataFrame:
        numbered = window(lines, "rn", "ROW_NUM", sorts=[("id", "asc")], partitions=[*keys, "day", "units"], split=largest > MAX_GROUP_ROWS)
        named = numbered.select(*keys, F.col("day").alias(f"{s}_day"), F.col("units").alias(f"{s}_units"), F.col("id").alias(f"{s}_id"), "rn")
        joined = named.join(links, [*keys, f"{s}_day", f"{s}_units"])
        slot = F.col("rn") - 1 - F.col(f"{s}_from")
        return joined.withColumn("slot", slot).filter("slot >= 0 and slot < m").select(*link, "slot", f"{s}_id")

    pairs = placed(sides[0], "a").join(placed(sides[1], "b"), [*link, "slot"])
    return pairs.select(
        "a_id",
        "b_id",
        F.abs(F.col("a_day") - F.col("b_day")).alias("day_gap"),
        ((F.col("a_units") - F.col("b_units")) / UNITS).alias("amount_diff"),
    )


def _described(df: DataFrame, side: Side, s: str, negate: bool) -> DataFrame:
    amount = ref(resolve(df, side.amount)).cast("decimal(38,6)").cast("double")
    text = lambda name: ref(resolve(df, name)).cast("string") if name else F.lit(None).cast("string")
    return df.select(
        ref(resolve(df, side.id)).alias(f"{s}_id"),
        ref(resolve(df, side.date)).cast("date").alias(f"{s}_date"),
        (-amount if negate else amount).alias(f"{s}_amount"),
        text(side.reference).alias(f"{s}_reference"),
        text(side.counterparty).alias(f"{s}_counterparty"),
        text(side.account).alias(f"{s}_account"),
        text(side.description).alias(f"{s}_description"),
    )


def reconcile(a: DataFrame, b: DataFrame, a_side: Side, b_side: Side, settings: Settings, negate_b: bool = False, holidays: list[dt.date] = ()) -> DataFrame:
    """All lines of both sides: matched pairs as one row, the others on their own.

    Columns: source (Both, Side A, Side B), ids, dates, amounts, descriptions of either side, and
    fx_difference: a pair that agrees in its currency, but not in the amount. Such pairs are sought among
    the lines that no amount matches, when both sides name a currency and an amount in it.
    """
    pairs = match_lines(a, b, a_side, b_side, settings, negate_b, holidays).withColumn("fx_difference", F.lit(False))
    if all((a_side.currency, a_side.foreign, b_side.currency, b_side.foreign)):
        pairs = cut_lineage(pairs)
        rest, sides = [], []
        for df, side, name in ((a, a_side, "a_id"), (b, b_side, "b_id")):
            taken = pairs.select(F.col(name).alias("__taken"))
            rest.append(df.join(taken, ref(resolve(df, side.id)) == F.col("__taken"), "left_anti"))
            sides.append(replace(side, amount=side.foreign, keys=[*side.keys, side.currency]))
        pairs = pairs.unionByName(match_lines(*rest, *sides, settings, negate_b, holidays).withColumn("fx_difference", F.lit(True)))
    left = _described(a, a_side, "a", False).withColumn("__in_a", F.lit(True)).join(pairs.select(F.col("a_id").alias("__a"), F.col("b_id").alias("__b"), "day_gap", "amount_diff", "fx_difference"), F.col("a_id").eqNullSafe(F.col("__a")), "left")
    right = _described(b, b_side, "b", negate_b)
    # lines of A without a partner have no id to join by: by that alone one task gets them all, and a full join's are never split
    dealt = left.withColumn("__to", F.when(F.col("__b").isNull(), F.hash("a_id")).otherwise(F.hash("__b")))
    met = (F.col("__b") == F.col("b_id")) & (F.col("__to") == F.col("__from"))
    joined = dealt.join(right.withColumn("__from", F.hash("b_id")), met, "full").drop("__a", "__b", "__to", "__from")
    matched = F.col("day_gap").isNotNull()
    source = F.when(matched, "Both").when(F.col("__in_a"), "Side A").otherwise("Side B")
    # of a pair that differs by the rate, the difference of the amounts themselves
    difference = F.when(F.col("fx_difference"), F.col("a_amount") - F.col("b_amount")).otherwise(F.col("amount_diff"))
    return joined.withColumns({"source": source, "amount_diff": difference, "fx_difference": F.coalesce("fx_difference", F.lit(False))}).drop("__in_a")


def classify(
    items: DataFrame,
    period_start,
    period_end,
    settings: Settings,
    supported: Column | None = None,
    unverified: Column | None = None,
    unauthorized: Column | None = None,
    one_sided_escalates: bool = False,
    as_of=None,
) -> DataFrame:
    """Add category, status, aging and materiality to reconciled items.

    ``supported``, ``unverified`` and ``unauthorized`` are boolean columns with what is known about
    an item. ``as_of`` is the day ages count to, the period end by default.
    """
    off = F.lit(False)
    supported, unverified, unauthorized = (F.coalesce(c, off) if c is not None else off for c in (supported, unverified, unauthorized))
    start, end = as_of_date(period_start), as_of_date(period_end)
    inside = lambda c: (c >= start) & (c <= end)
    a, b = F.col("a_date"), F.col("b_date")
    both = F.col("source") == "Both"
    amount = F.abs(F.coalesce("a_amount", "b_amount"))
    aging = F.greatest(F.datediff(as_of_date(as_of) if as_of else end, F.coalesce(F.least(a, b), a, b)), F.lit(0))
    material = amount > settings.materiality
    crosses = (inside(a) & (b > end)) | (inside(b) & (a > end))
    by_rate = F.col("fx_difference") if "fx_difference" in items.columns else off
    status = (
        F.when(both & by_rate & ~unverified, "Adjustment needed")
        .when(both & (a == b) & ~unverified, "Reconciled")
        .when(both & ~unverified & crosses, "Timing - Crosses period")
        .when(both & ~unverified & inside(a) & inside(b), "Timing - Clears in period")
        .when(both & ~unverified, "Reconciled")
        .when(unauthorized, "Escalate")
        .when(supported & ~unverified, "Adjustment needed")
        .when(both, "Investigate")
        .when(F.lit(one_sided_escalates) | F.coalesce(material, off) | F.coalesce(aging > CONTROLLER_DAYS, off), "Escalate")
        .otherwise("Investigate")
    )
    category = (
        F.when(F.col("status") == "Reconciled", "Reconciled")
        .when(F.col("status").startswith("Timing"), "Timing")
        .when(F.col("status") == "Adjustment needed", "Adjustment")
        .otherwise("Investigation")
    )
    return (
        items.withColumn("status", status)
        .withColumn("category", category)
        .withColumn("aging_days", aging)
        .withColumn("aging_bucket", aging_bucket(F.col("aging_days")))
        .withColumn("material", F.coalesce(material, off))
    )


def aging_bucket(days: Column) -> Column:
    return F.when(days <= 30, "0-30").when(days <= 60, "31-60").when(days <= 90, "61-90").when(days > 90, "90+")


def open_item() -> Column:
    """Items that still need someone's action."""
    return F.col("category").isin("Adjustment", "Investigation")


def escalation(items: DataFrame) -> DataFrame:
    """Who has to look at an open item, by its amount and age, and by the total of all open items."""
    amount = F.abs(F.coalesce("a_amount", "b_amount"))
    reconciling = F.col("category") != "Reconciled"
    total = items.filter(reconciling).agg(F.coalesce(F.sum(amount), F.lit(0.0)).alias("t")).scalar()
    by_amount = F.when(amount > CONTROLLER_AMOUNT, "Controller review").when(amount > SUPERVISOR_AMOUNT, "Supervisor review")
    by_age = F.when(F.col("aging_days") > CONTROLLER_DAYS, "Controller or management review").when(F.col("aging_days") > SUPERVISOR_DAYS, "Supervisor follow-up")
    return (
        items.withColumn("amount_escalation", F.when(open_item(), by_amount))
        .withColumn("age_escalation", F.when(open_item(), by_age))
        .withColumn("total_escalation", F.when(total > CONTROLLER_TOTAL, "Controller review"))
    )


def recon_summary(items: DataFrame) -> DataFrame:
    """One row: balances, adjusted balances, unexplained difference, match figures.

    Explained one-sided items (timing, adjustments) and the variance of matched pairs are carried
    to the other side; what then remains is unexplained.
    """
    both = F.col("source") == "Both"
    a, b = F.coalesce("a_amount", F.lit(0.0)), F.coalesce("b_amount", F.lit(0.0))
    explained = F.col("category").isin("Reconciled", "Timing", "Adjustment")
    to_b = F.when(both, a - b).when(explained & (F.col("source") == "Side A"), a).otherwise(0.0)
    to_a = F.when(explained & (F.col("source") == "Side B"), b).otherwise(0.0)
    amount = F.abs(F.coalesce("a_amount", "b_amount"))
    lines = F.when(both, 2).otherwise(1)
    totals = items.agg(
        F.coalesce(F.sum(a), F.lit(0.0)).alias("side_a_balance"),
        F.coalesce(F.sum(b), F.lit(0.0)).alias("side_b_balance"),
        F.coalesce(F.sum(to_a), F.lit(0.0)).alias("to_a"),
        F.coalesce(F.sum(to_b), F.lit(0.0)).alias("to_b"),
        F.count_if(both).alias("matched_count"),
        F.count_if(open_item()).alias("items_needing_action"),
        F.coalesce(F.sum(F.when(F.col("category") != "Reconciled", amount)), F.lit(0.0)).alias("total_reconciling"),
        F.coalesce(F.sum(lines), F.lit(0)).alias("lines"),
    )
    rate = F.coalesce(F.try_divide(F.lit(200.0) * F.col("matched_count"), F.col("lines")), F.lit(0.0))
    units = lambda c: F.round(c, 2)
    return totals.select(
        units(F.col("side_a_balance")).alias("side_a_balance"),
        units(F.col("side_b_balance")).alias("side_b_balance"),
        units(F.col("side_a_balance") + F.col("to_a")).alias("side_a_adjusted"),
        units(F.col("side_b_balance") + F.col("to_b")).alias("side_b_adjusted"),
        units(F.col("side_a_balance") + F.col("to_a") - F.col("side_b_balance") - F.col("to_b")).alias("unexplained_difference"),
        "matched_count",
        F.round(rate, 2).alias("match_rate"),
        F.when(rate >= GREEN_RATE, "green").when(rate >= AMBER_RATE, "amber").otherwise("red").alias("match_rate_status"),
        "items_needing_action",
        units(F.col("total_reconciling")).alias("total_reconciling"),
    )


def timing_items(items: DataFrame) -> DataFrame:
    """Timing differences and whether they clear in the period."""
    return items.filter("category = 'Timing'")


def aging_summary(items: DataFrame) -> DataFrame:
    """Open items per aging bucket."""
    amount = F.abs(F.coalesce("a_amount", "b_amount"))
    return items.filter(open_item()).groupBy("aging_bucket").agg(F.count(F.lit(1)).alias("items"), F.round(F.sum(amount), 2).alias("amount"))


def recon_master(items: DataFrame, owner: Column | None = None, notes: Column | None = None) -> DataFrame:
    """The item table of a reconciliation, 18 columns, numbered by source and line ids."""
    action = (
        F.when(F.col("status") == "Adjustment needed", "Post adjustment")
        .when(F.col("status") == "Investigate", "Investigate")
        .when(F.col("status") == "Escalate", "Escalate")
        .when(F.col("status") == "Timing - Crosses period", "Monitor")
        .otherwise("None")
    )
    numbered = window(items, "Item #", "ROW_NUM", sorts=[("source", "asc"), ("a_id", "asc"), ("b_id", "asc")])
    either = lambda name: F.coalesce(f"a_{name}", f"b_{name}")
    variance = F.coalesce("a_amount", F.lit(0.0)) - F.coalesce("b_amount", F.lit(0.0))
    return numbered.select(
        F.col("`Item #`"),
        F.col("source").alias("Source"),
        F.col("a_date").alias("Side A Date"),
        F.col("b_date").alias("Side B Date"),
        either("reference").alias("Document / Reference #"),
        either("counterparty").alias("Vendor / Counterparty / Entity"),
        either("account").alias("Account"),
        either("description").alias("Description"),
        F.col("a_amount").alias("Side A Amount"),
        F.col("b_amount").alias("Side B Amount"),
        F.round(variance, 2).alias("Variance"),
        F.col("status").alias("Status"),
        F.col("category").alias("Category"),
        F.col("aging_days").alias("Aging (days)"),
        action.alias("Action required"),
        (owner if owner is not None else F.lit(None).cast("string")).alias("Owner"),
        F.col("material").alias("Materiality flag"),
        (notes if notes is not None else F.lit(None).cast("string")).alias("Notes"),
    )
