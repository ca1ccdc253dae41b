"""Self-join of documents on the Jaccard similarity of their word shingles, by signature trees.

Every link of the defined similarity is found; nothing is capped or sampled:

1. Texts with the same shingle set are one class.
2. A class is posted under the first n - ceil(t n) + 1 of its shingles in one fixed order. Two sets
   of similarity t share one of these. A count-min sketch over all documents puts frequent shingles
   last, so passages that many documents share are posted only where nothing rarer is left.
3. In each bucket (classes posted under one shingle) the classes of one size level are first
   compared with one of them. The links found make components; a bucket whose members are all in
   one component is done, so groups of near copies never turn into all pairs.
4. In each bucket that is left, a signature tree is built: nodes hold the OR of their members' token
   bitmaps, the range of their sizes and the slack of their bitmaps. Dual traversal visits pairs of
   nodes and drops a pair when the largest overlap its members can have is below the smallest
   that a link needs. Of the pairs left between components, a spanning forest leaves the bucket, so it
   never puts out more rows than it has members, however many of its pairs are close.
5. What the forests hold together is a cluster, and a class is in one cluster at most. There the classes
   bring their whole sets, once. A second tree over bitmaps of the shared shingles, one bit each, gives
   exact overlaps; again the links of a spanning forest leave the cluster.

Buckets of frequent shingles are dealt out by (shingle, salt) at first and by pairs of bounded blocks of
neighbouring size levels in the trees, and so are clusters, so no task gathers one.

Defined cases: null text counts as empty; texts without words have no shingles, link with nothing
and are their own component; equal texts link whatever their length; a null id never is a
component's smallest unless all are null; rows that repeat are linked like any equal texts, and
``drop_similar`` leaves exactly one row of a component, whatever its ids; an empty table gives an empty
result; other columns are ignored. Sets count as equal when a 64-bit hash is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, join_groups, possible_rows, staged, text_of, without_rows
from .shingles import set_class, shingle_sets

#: Counters of each of the sketch's two rows, and how many of them travel in one row.
SKETCH = 1 << 20
SKETCH_PART = 1 << 12
#: Buckets of a frequent shingle are dealt out over so many parts.
SALTS = 32
#: Members of a block of a large bucket, and the shingles that they have together at most.
BLOCK = 2048
BLOCK_SHINGLES = 1_000_000
#: Bits of an exact bitmap; more shared shingles fold onto each other and are compared one by one.
MAX_WIDTH = 1 << 16
FAN_OUT = 16
#: Classes a task remembers to have posted.
SEEN = 500_000


class Order:
    """The fixed order of shingles: rare ones by hash, then frequent ones by their sketched count."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        load = counts[0].sum() / SKETCH
        # counters of rare shingles scatter around the load like a Poisson variable
        self.limit = int(load + 5 * load**0.5 + 32)

    def level(self, hashes: np.ndarray) -> np.ndarray:
        found = np.minimum(self.counts[0][_cell(hashes, 0)], self.counts[1][_cell(hashes, 1)]).astype(np.int64)
        return np.where(found > self.limit, found, 0)


def _cell(hashes: np.ndarray, row: int) -> np.ndarray:
    return ((hashes >> np.uint64(8 + 28 * row)) & np.uint64(SKETCH - 1)).astype(np.int64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Token bitmap of at least two bits a token, a power of two wide, as 64-bit words."""
    width = 1 << max(6, (2 * len(hashes) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


def folded(words: np.ndarray, count: int) -> np.ndarray:
    while len(words) > count:
        half = len(words) // 2
        words = words[:half] | words[half:]
    return words


class Tree:
    """Levels of nodes over documents in order of size; the last level is the documents themselves."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, slack: np.ndarray | None = None):
        """``slack``: how many tokens of each set its bitmap may hide (else told by the sizes)."""
        slack = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64) if slack is None else slack
        self.levels = [(bits, sizes, sizes, slack)]
        while len(self.levels[0][1]) > 4 * FAN_OUT:
            bits, low, high, slack = self.levels[0]
            at = np.arange(0, len(low), FAN_OUT)
            self.levels.insert(0, (np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at)))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, largest overlap) with i < j of the documents that may be similar."""
        n = len(self.levels[0][1])
        i, j = np.triu_indices(n)
        yield from self._down(0, i, j)

    def _down(self, depth: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        bits, low, high, slack = self.levels[depth]
        for cut in range(0, len(i), 4096):
            a, b = i[cut : cut + 4096], j[cut : cut + 4096]
            near = (5 * high[a] >= 4 * low[b]) & (5 * high[b] >= 4 * low[a])
            if depth == len(self.levels) - 1:
                near &= a != b
            a, b = a[near], b[near]
            most = np.bitwise_count(bits[a] & bits[b]).sum(axis=1, dtype=np.int64) + np.minimum(slack[a], slack[b])
            # inside one node the overlap can be as large as the sets
            may = (9 * most >= 4 * (low[a] + low[b])) | (a == b)
            a, b, most = a[may], b[may], most[may]
            if depth == len(self.levels) - 1:
                yield a, b, most
                continue
            below = len(self.levels[depth + 1][1])
            for step in range(0, len(a), 64):
                x, y = a[step : step + 64], b[step : step + 64]
                p = (x[:, None] * FAN_OUT + np.arange(FAN_OUT)).repeat(FAN_OUT, axis=1).ravel()
                q = np.tile(y[:, None] * FAN_OUT + np.arange(FAN_OUT), (1, FAN_OUT)).ravel()
                real = (p < below) & (q < below) & (p <= q)
                yield from self._down(depth + 1, p[real], q[real])


# --- passes over the texts ----------------------------------------------------------------------


def _digest(id_column: str, text_column: str) -> Column:
    """A number of 128 bits for an id and a text."""
    return F.md5(F.concat_ws("\n", F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")), F.col(f"`{id_column}`").isNull().cast("string"), text_of(f"`{text_column}`")).cast("binary"))


def _light(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(f"`{id_column}`").cast("string").alias("id"), _digest(id_column, text_column).alias("key"), text_of(f"`{text_column}`").alias("text"))


def _count(light: DataFrame, width: int) -> DataFrame:
    """First pass: (id, key, n, cls) of every document, and each task's part of the sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, SKETCH), dtype=np.uint32)
        held: list[np.ndarray] = []

        def add() -> None:
            every = np.concatenate(held)
            for row in range(2):
                counts[row] += np.bincount(_cell(every, row), minlength=SKETCH).astype(np.uint32)
            held.clear()

        for batch in batches:
            sizes, classes = [], []
            for hashes in shingle_sets(batch["text"].tolist(), width):
                sizes.append(len(hashes))
                classes.append(set_class(hashes))
                held.append(hashes)
                if len(held) >= 2000:
                    add()
            yield pd.DataFrame({"id": batch["id"], "key": batch["key"], "n": sizes, "cls": classes, "part": -1, "counts": None})
        if held:
            add()
        if counts.any():
            parts = counts.reshape(-1, SKETCH_PART)
            yield pd.DataFrame({"id": None, "key": None, "n": 0, "cls": 0, "part": range(len(parts)), "counts": [x.tobytes() for x in parts]})

    return light.mapInPandas(run, "id string, key string, n int, cls long, part int, counts binary")


def _sketch(counted: DataFrame) -> np.ndarray:
    """The tasks' sketches added up; its size is fixed."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch["part"], batch["counts"], strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, dtype=np.uint32).astype(np.uint64)
        yield pd.DataFrame({"part": list(sums), "counts": [x.tobytes() for x in sums.values()]})

    parts = counted.filter("part >= 0").select("part", "counts").repartition("part").mapInPandas(add, "part int, counts binary")
    out = np.zeros((2 * SKETCH // SKETCH_PART, SKETCH_PART), dtype=np.uint64)
    for part, counts in parts.collect():
        out[part] = np.frombuffer(counts, dtype=np.uint64)
    return np.minimum(out, np.uint64(2**32 - 1)).astype(np.uint32).reshape(2, SKETCH)


def _posted(light: DataFrame, width: int, counts: np.ndarray) -> DataFrame:
    """Second pass: (id, cls, n, bits, rare, frequent): bitmap and posting shingles of every class."""
    shared = light.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order, seen = Order(shared.value), set()
        for batch in batches:
            rows = []
            for name, hashes in zip(batch["id"], shingle_sets(batch["text"].tolist(), width), strict=True):
                n = len(hashes)
                if not n or (cls := set_class(hashes)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(cls)
                levels = order.level(hashes)
                first = np.lexsort((hashes, levels))[: n - -(-4 * n // 5) + 1]
                keys, often = hashes[first].view(np.int64), levels[first] > 0
                rows.append((name, cls, n, signature(hashes).tobytes(), keys[~often], keys[often]))
            yield pd.DataFrame(rows, columns=["id", "cls", "n", "bits", "rare", "frequent"])

    return light.mapInPandas(run, "id string, cls long, n int, bits binary, rare array<long>, frequent array<long>")


# --- buckets ------------------------------------------------------------------------------------


def _level(size: str) -> Column:
    """Sizes in one level, or in two neighbouring ones, can be those of similar sets."""
    return F.floor(F.log(size) / F.log(F.lit(1.25))).cast("int")


def _shared(posted: DataFrame) -> DataFrame:
    """Postings of shingles that more than one class has, each with the first class of its size level.

    The first of a level also gets the first of the level below it in the bucket, if that is the next one.
    """
    level = _level("n").alias("level")
    rare = posted.select(F.explode("rare").alias("key"), F.lit(-1).alias("salt"), level, "cls")
    frequent = posted.select(F.explode("frequent").alias("key"), F.pmod("cls", F.lit(SALTS)).cast("int").alias("salt"), level, "cls")
    dealt = rare.unionByName(frequent).repartition("key", "salt").sortWithinPartitions("key", "salt", "level", "cls")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ("key", "salt", "level", "cls")
        # the last row of a batch waits for the next one, which tells whether its bucket goes on
        wait: list[np.ndarray] | None = None
        goes_on, pivot, first_below = False, 0, (0, False)

        def out(rows: list[np.ndarray], pivots: np.ndarray, below: np.ndarray, has_below: np.ndarray, keep: np.ndarray):
            columns = [pa.array(x[keep]) for x in (rows[0], rows[2], rows[3], pivots, rows[1] >= 0)]
            columns.append(pa.array(below[keep], mask=~has_below[keep]))
            return pa.RecordBatch.from_arrays(columns, ["key", "level", "cls", "pivot", "dealt", "below"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            if wait is not None:
                rows = [np.concatenate((w, r)) for w, r in zip(wait, rows, strict=True)]
            same = np.concatenate(([True], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]) | (rows[2][1:] != rows[2][:-1]) | (rows[3][1:] != rows[3][:-1])))
            rows = [r[same] for r in rows]
            key, salt, level, cls = rows
            opens = np.concatenate(([not goes_on], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])))
            leads = opens | np.concatenate(([wait is None], level[1:] != level[:-1]))
            at = np.maximum.accumulate(np.where(leads, np.arange(len(key)), -1))
            pivots = np.where(at >= 0, cls[np.maximum(at, 0)], pivot)
            has_below = np.concatenate(([first_below[1]], leads[1:] & ~opens[1:] & (level[1:] - level[:-1] == 1)))
            below = np.concatenate(([first_below[0]], pivots[:-1]))
            last = len(key) - 1
            alone = opens[:-1] & opens[1:] & (salt[:-1] < 0)
            if last:
                yield out([r[:-1] for r in rows], pivots[:-1], below[:-1], has_below[:-1], ~alone)
            wait, goes_on, pivot = [r[last:] for r in rows], not opens[last], int(pivots[last])
            first_below = int(below[last]), bool(has_below[last])
        if wait is not None:
            keep = np.array([goes_on or wait[1][0] >= 0])
            yield out(wait, np.array([pivot]), np.array([first_below[0]]), np.array([first_below[1]]), keep)

    return dealt.mapInArrow(run, "key long, level int, cls long, pivot long, dealt boolean, below long")


def _stars(shared: DataFrame) -> DataFrame:
    """Pairs to compare first: each class with its level's pivot, pivots of neighbouring levels, and pivots of one bucket's parts with the least of them."""
    own = shared.filter("cls <> pivot").selectExpr("pivot AS a", "cls AS b")
    heads = shared.filter("dealt AND cls = pivot").select("key", "level", "cls")
    least = heads.groupBy("key", "level").agg(F.min("cls").alias("a"), F.count("*").alias("parts")).filter("parts > 1")
    across = heads.join(least, ["key", "level"]).filter("cls <> a").selectExpr("a", "cls AS b")
    beside = shared.filter("below IS NOT NULL").selectExpr("below AS a", "cls AS b")
    return own.unionByName(across).unionByName(beside).distinct()


def _pruned(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The pairs that their bitmaps leave possible."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for na, nb, x, y in zip(batch["na"], batch["nb"], batch["xa"], batch["xb"], strict=True):
                x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                width = min(len(x), len(y))
                x, y = folded(x, width), folded(y, width)
                slack = min(na - int(np.bitwise_count(x).sum()), nb - int(np.bitwise_count(y).sum()))
                keep.append(9 * (slack + int(np.bitwise_count(x & y).sum())) >= 4 * (na + nb))
            yield batch.loc[keep, ["a", "b"]]

    first = bitmaps.selectExpr("cls AS a", "n AS na", "bits AS xa")
    second = bitmaps.selectExpr("cls AS b", "n AS nb", "bits AS xb")
    sized = pairs.join(first, "a").join(second, "b").filter("5 * least(na, nb) >= 4 * greatest(na, nb)")
    return sized.mapInPandas(run, "a long, b long")


Unit = dict[str, np.ndarray]


def _in_order(unit: Unit) -> Unit:
    order = np.lexsort((unit["cls"], unit["n"]))
    return {c: x[order] for c, x in unit.items()}


def _open_pairs(unit: Unit, tree: Tree) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, largest overlap) of the pairs that are this unit's to compare and that its tree leaves possible."""
    at, halves = unit["at"][0], unit["first"][0] != unit["second"][0]
    comp, level, part = unit["comp"], unit["level"], unit["part"]
    for i, j, most in tree.pairs():
        # pairs of the upper level, or of one half of a pair of blocks, have units of their own
        own = (comp[i] != comp[j]) & ((level[i] == at) | (level[j] == at))
        if halves:
            own &= part[i] != part[j]
        if own.any():
            yield i[own], j[own], most[own]


def _may_link(unit: Unit) -> bool:
    return len(unit["comp"]) > 1 and bool((unit["comp"] != unit["comp"][0]).any() and (unit["level"] == unit["at"][0]).any())


def _joining(labels: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]], fits=None) -> list[tuple[int, int]]:
    """The pairs (of those that fit) that join labels as all of them would."""
    out = []
    for i, j in pairs:
        while len(i := i[apart := labels[i] != labels[j]]):
            j = j[apart]
            x, y, i, j = int(i[0]), int(j[0]), i[1:], j[1:]
            if fits is None or fits(x, y):
                out.append((x, y))
                labels[labels == labels[y]] = labels[x]
    return out


def _near_pairs(unit: Unit) -> np.ndarray:
    """(a, b): pairs of different components that hold together all that may be similar, by their bitmaps."""
    ordered = _in_order(unit)
    words = [np.frombuffer(x, dtype="<u8") for x in ordered["bits"]]
    width = min(map(len, words))
    tree = Tree(np.stack([folded(x, width) for x in words]), ordered["n"].astype(np.int64))
    found = _joining(np.arange(len(words)), ((i, j) for i, j, _ in _open_pairs(ordered, tree)))
    return ordered["cls"][np.array(found, dtype=np.int64).reshape(-1, 2)]


def exact_signatures(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps with one bit for each shingle that two of the sets share, and what folding may hide of each set."""
    every, place, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    number = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[place]
    width = 1 << max(6, int((counts > 1).sum() - 1).bit_length())
    width = min(width, MAX_WIDTH)
    bits, slack = np.zeros((len(tokens), width // 64), dtype=np.uint64), np.zeros(len(tokens), dtype=np.int64)
    for row, own in enumerate(np.split(number, np.cumsum([len(x) for x in tokens])[:-1])):
        own = own[own >= 0]
        marks = np.zeros(width, dtype=np.uint8)
        marks[own & (width - 1)] = 1
        bits[row] = np.packbits(marks, bitorder="little").view("<u8")
        slack[row] = len(own) - int(marks.sum())
    return bits, slack


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def _linked_pairs(unit: Unit) -> np.ndarray:
    """(a, b): links that join the unit's components as all of its links would."""
    ordered = _in_order(unit)
    tokens = [np.frombuffer(x, dtype=np.uint64) for x in ordered["tokens"]]
    n = ordered["n"].astype(np.int64)
    bits, slack = exact_signatures(tokens)
    # without folding the overlaps are exact, and every pair that the tree leaves is a link
    fits = None if not slack.any() else lambda x, y: 9 * overlap(tokens[x], tokens[y]) >= 4 * int(n[x] + n[y])
    labels = np.unique(ordered["comp"], return_inverse=True)[1]
    found = _joining(labels, ((i, j) for i, j, _ in _open_pairs(ordered, Tree(bits, n, slack))), fits)
    return ordered["cls"][np.array(found, dtype=np.int64).reshape(-1, 2)]


def _by_unit(members: DataFrame, content: str, pairs) -> DataFrame:
    """(a, b): what ``pairs`` finds in the units, each of which comes together in one task.

    A unit is a pair of blocks of two neighbouring size levels of a bucket, so its size is bounded.
    """
    unit = ["key", "at", "first", "second"]
    names = [*unit, "cls", "n", "comp", "level", "part", content]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: list[Unit] = []

        def found() -> Iterator:
            whole = {c: np.concatenate([h[c] for h in held]) for c in names}
            held.clear()
            if _may_link(whole) and len(out := pairs(whole)):
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            new = np.zeros(batch.num_rows, dtype=bool)
            for c in unit:
                new[1:] |= rows[c][1:] != rows[c][:-1]
            new[0] = bool(held) and any(held[-1][c][-1] != rows[c][0] for c in unit)
            starts = np.flatnonzero(new).tolist()
            for low, high in zip([0, *starts], [*starts, batch.num_rows], strict=True):
                if high > low:
                    held.append({c: x[low:high] for c, x in rows.items()})
                if high < batch.num_rows and held:  # the next row opens another unit
                    yield from found()
        if held:
            yield from found()

    dealt = _units(members).select(*names).repartition(*unit).sortWithinPartitions(*unit)
    return dealt.mapInArrow(run, "a long, b long")


def _units(members: DataFrame) -> DataFrame:
    """One row for each member and unit."""
    own = F.when(F.col("parts").isNotNull(), F.struct(F.col("level").alias("at"), "parts"))
    below = F.when(F.col("parts_below").isNotNull(), F.struct((F.col("level") - 1).alias("at"), F.col("parts_below").alias("parts")))
    units = members.withColumn("unit", F.explode(F.array_compact(F.array(own, below)))).drop("parts", "parts_below")
    units = units.select("*", "unit.at", F.pmod("cls", F.col("unit.parts")).cast("int").alias("part"), F.explode(F.expr("sequence(0, unit.parts - 1)")).alias("other"))
    return units.select("*", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"))


def _members(shared: DataFrame, comps: DataFrame, contents: DataFrame, compared: bool) -> DataFrame:
    """Postings in the units (two neighbouring size levels of a bucket) that span several components.

    Of units with the same members one is kept. ``compared``: two classes of a bucket that wasn't dealt
    out have been, so they need no unit.
    """
    named = shared.join(comps, F.col("cls") == F.col("node"), "left")
    named = named.select("key", "level", "cls", F.coalesce("component", "cls").alias("comp"), "dealt", F.xxhash64("key", "level").alias("place"))
    named = staged(named, "buckets")
    number = lambda c: c.cast("decimal(38,0)")
    by_level = named.groupBy("key", "level").agg(
        F.count("*").alias("size"), F.max("dealt").alias("dealt"), F.min("comp").alias("low"), F.max("comp").alias("high"), F.sum(number(F.xxhash64("cls"))).alias("sum"), F.sum(number(F.xxhash64("cls", F.lit(1)))).alias("sum2")
    )
    by_level = staged(by_level, "bucket-levels")
    above = by_level.select("key", (F.col("level") - 1).alias("level"), *[F.col(c).alias(f"{c}_up") for c in ("size", "dealt", "low", "high", "sum", "sum2")])
    both = by_level.join(above, ["key", "level"], "left")
    plus = lambda c: F.col(c) + F.coalesce(f"{c}_up", F.lit(0))
    enough = (plus("size") > 2) | (F.col("size_up").isNotNull() & F.col("dealt")) if compared else plus("size") > 1
    spans = F.least("low", "low_up") != F.greatest("high", "high_up")
    units = both.filter(enough & spans).select(
        "key", "level", F.col("size"), F.coalesce("size_up", F.lit(0)).alias("size_up"), plus("size").alias("all"), plus("sum").alias("s1"), plus("sum2").alias("s2")
    )
    # the largest key's unit stands for those with the same members on both levels
    kept = units.groupBy("all", "s1", "s2", "size").agg(F.max(F.struct("key", "level", "size_up")).alias("u")).select("u.*", "size", "all")
    # a unit is found by the members of its lower and of its upper level, with the number of its parts
    # members of a level have fewer shingles than the next level begins with
    shingles = F.col("all") * F.pow(F.lit(1.25), F.col("level") + 2)
    parts = F.ceil(F.greatest(F.col("all") / BLOCK, shingles / BLOCK_SHINGLES)).cast("int")
    none = F.lit(None).cast("int")
    lower = kept.select("key", "level", "size", parts.alias("parts"), none.alias("parts_below"))
    upper = kept.filter("size_up > 0").select("key", (F.col("level") + 1).alias("level"), F.col("size_up").alias("size"), none.alias("parts"), parts.alias("parts_below"))
    places = lower.unionByName(upper).groupBy(F.xxhash64("key", "level").alias("place")).agg(
        F.max("size").alias("size"), F.max("parts").alias("parts"), F.max("parts_below").alias("parts_below")
    )
    places = staged(places, "bucket-units")
    found = join_groups(named, places, "place", "size", named.count()).filter("size IS NOT NULL")
    return found.select("key", "level", "cls", "comp", "parts", "parts_below").join(contents, "cls")


# --- the join -----------------------------------------------------------------------------------


def _sets(light: DataFrame, posted: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(cls, tokens): the sorted sets of the given classes, read again from one text of each."""
    ids = staged(posted.select("cls", "id").join(classes, "cls").groupBy("cls").agg(F.min("id").alias("id")), "class-ids")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(shingle_sets(batch["text"].tolist(), width))
            yield pd.DataFrame({"cls": [set_class(x) for x in found], "tokens": [x.tobytes() for x in found]})

    found = possible_rows(light, "id", ids.select("id"), ids.count()).mapInPandas(sets, "cls long, tokens binary")
    # other texts pass the filter of ids by chance, and an id can repeat
    return found.join(ids.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.first("tokens").alias("tokens"))


def _verified(pairs: DataFrame, light: DataFrame, posted: DataFrame, width: int) -> DataFrame:
    """The pairs (a, b) that are links, by their whole sets."""
    pairs = staged(pairs, "pairs")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["tokens"], batch["others"], strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                keep.append(9 * overlap(x, y) >= 4 * (len(x) + len(y)))
            yield batch.loc[keep, ["a", "b"]]

    tokens = _sets(light, posted, pairs.selectExpr("explode(array(a, b)) AS cls").distinct(), width)
    first = tokens.selectExpr("cls AS a", "tokens")
    second = tokens.selectExpr("cls AS b", "tokens AS others")
    return pairs.join(first, "a").join(second, "b").mapInPandas(check, "a long, b long")


def _classed(light: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """The rows' sets (id, key, n, cls), and the component of every class that links with another."""
    counted = staged(_count(light, width), "shingle-counts")
    posted = staged(_posted(light, width, _sketch(counted)), "postings")
    bitmaps = posted.groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    shared = staged(_shared(posted), "shared-postings")
    links = staged(_verified(_pruned(_stars(shared), bitmaps), light, posted, width), "links")
    comps = components(links)
    near = _by_unit(_members(shared, comps, bitmaps, compared=True), "bits", _near_pairs)
    clusters = staged(components(near).selectExpr("component AS key", "node AS cls"), "clusters")
    sizes = clusters.join(bitmaps.select("cls", "n"), "cls")
    levelled = sizes.select("key", _level("n").alias("level"), "cls", F.lit(True).alias("dealt"))
    sets = _sets(light, posted, clusters.select("cls"), width).withColumn("n", (F.octet_length("tokens") / 8).cast("int"))
    more = staged(_by_unit(_members(levelled, comps, sets, compared=False), "tokens", _linked_pairs), "links")
    return counted.filter("part < 0").select("id", "key", "n", "cls"), components(links.unionByName(more))


def similar_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5) -> DataFrame:
    """One row per row of ``docs``: its id, n_shingles and component_id."""
    rows, comps = _classed(_light(docs, id_column, text_column), width)
    rows = rows.withColumn("id", F.col("id").cast(dict(docs.dtypes)[id_column]))
    classes = rows.filter("n > 0").groupBy("cls").agg(F.min("id").alias("low"), F.count("*").alias("size"))
    named = classes.join(comps, F.col("cls") == F.col("node"), "left")
    lowest = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("low").alias("lowest"))
    named = staged(named.filter("size > 1 OR component IS NOT NULL").join(lowest, "component", "left").selectExpr("cls", "size", "coalesce(lowest, low) AS component_id"), "classes")
    out = join_groups(rows.drop("key"), named, "cls", "size", rows.count())
    smallest = F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_column), F.col("n").cast("long").alias("n_shingles"), smallest.alias("component_id"))


def drop_similar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5) -> DataFrame:
    """The rows of ``docs`` with one row of each component: the smallest id, a null id last.

    Rows are told apart by a digest of id and text. Of rows that share both, one is left.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows, comps = _classed(_light(docs, id_column, text_column), width)
    rows = rows.filter("n > 0").withColumn("id", F.col("id").cast(dict(docs.dtypes)[id_column]))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    classes = rows.groupBy("cls").agg(F.min(order).alias("first"), F.count("*").alias("size"))
    named = classes.join(comps, F.col("cls") == F.col("node"), "left").withColumn("component", F.coalesce("component", "cls"))
    first = named.groupBy("component").agg(F.min("first").alias("kept"), F.sum("size").alias("all")).filter("`all` > 1")
    named = staged(named.join(first, "component").select("cls", "size", F.col("kept.key").alias("kept")), "classes")
    grouped = staged(join_groups(rows, named, "cls", "size", rows.count()).filter("size IS NOT NULL").select("key", (F.col("key") == F.col("kept")).alias("stays")), "grouped")
    keyed = docs.select(*columns, _digest(id_column, text_column).alias("__digest"))
    left = without_rows(keyed, "__digest", staged(grouped.filter("NOT stays").select("key").distinct(), "similar"))
    twice = staged(grouped.filter("stays").groupBy("key").count().filter("count > 1").select("key"), "repeated")
    count = twice.count()
    if not count:
        return left.drop("__digest")
    whole = F.struct(*columns)
    one = possible_rows(left, "__digest", twice, count).join(twice, F.col("__digest") == F.col("key")).groupBy("__digest").agg(F.first(whole).alias("row")).select("row.*")
    return without_rows(left, "__digest", twice).drop("__digest").unionByName(one)
