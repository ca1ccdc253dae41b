"""Approximate text join, exact about which pairs reach the threshold.

Similarity is 1 - edit distance / longer length. If two texts are at most `d` edits apart, one of
`d + 1` consecutive segments of the one occurs unchanged, at nearly the same place, in the other;
those segments are the join keys. A segment that very many texts share is refined by the rarest
characters of each text, so no busy key pairs up all its texts. Work is done on distinct texts and
every candidate is verified.

The keys of a text grow with the cube of its length, so pairs with a text of more than ``LONG``
characters are found another way: `d` edits change at most `q d` runs of `q` characters, so two such
texts share one of the `q d + 1` runs of each that are rarest in all texts, at most `d` places apart.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import by_merge, cut_lineage
from ..types import column_type, ref, resolve
from .joins import output_names

# A segment that would give more candidate pairs than this is refined.
BUSY_PAIRS = 100_000
# At lower thresholds too many edits are allowed to be sure of a shared character pair: single
# characters serve instead, down to one half.
PAIR_THRESHOLD = 0.75
# Characters from which on a text is long, and of the longest runs that are compared.
LONG, LONGEST_RUN = 40, 4


def normalized(c: Column) -> Column:
    """Comparison form: lower case, punctuation as spaces, single spaces."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def _edits(length: Column, threshold: float) -> Column:
    """Edits allowed between two texts whose longer one has this length."""
    return F.floor(F.lit(1 - threshold) * length + 1e-9).cast("int")


def _start(i: Column, length: Column, edits: Column) -> Column:
    """Where segment ``i`` of a text begins when it is cut into ``edits + 1`` even segments."""
    return F.floor(i * length / (edits + 1)).cast("int")


def _key(length: Column, edits: Column, i: Column, at: Column, size: Column) -> Column:
    """A hash stands for the segment: two segments that share one only cost a verification."""
    return F.struct(edits.alias("edits"), F.xxhash64(length, i, F.substring(F.col("text"), at + 1, size)).alias("hash"))


def _own_segments(threshold: float) -> Column:
    """Keys of a text's own segments, for every number of edits a partner may be away."""
    n = F.length("text").cast("int")
    most = _edits(F.floor(n / F.lit(threshold) + 1e-9), threshold)

    def cut(edits: Column) -> Column:
        begin = lambda i: _start(i, n, edits)
        return F.transform(F.sequence(F.lit(0), edits), lambda i: _key(n, edits, i, begin(i), begin(i + 1) - begin(i)))

    return F.array_distinct(F.flatten(F.transform(F.sequence(_edits(n, threshold), most), cut)))


def _possible_segments(threshold: float) -> Column:
    """Keys of all pieces of a text that may equal a segment of a similar text.

    A piece may have moved by at most the edits before it and the edits after it.
    """
    n = F.length("text").cast("int")
    shortest = F.greatest(F.ceil(F.lit(threshold) * n - 1e-9).cast("int"), F.lit(1))
    longest = F.floor(n / F.lit(threshold) + 1e-9).cast("int")

    def of_length(length: Column) -> Column:
        edits = _edits(F.greatest(n, length), threshold)

        def of_segment(i: Column) -> Column:
            begin = _start(i, length, edits)
            size = _start(i + 1, length, edits) - begin
            low = F.greatest(F.lit(0), begin - i, begin + n - length - (edits - i))
            high = F.least(n - size, begin + i, begin + n - length + (edits - i))
            places = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
            return F.transform(places, lambda at: _key(length, edits, i, at, size))

        return F.flatten(F.transform(F.sequence(F.lit(0), edits), of_segment))

    return F.array_distinct(F.flatten(F.transform(F.sequence(shortest, longest), of_length)))


def _rare_grams(keyed: DataFrame, other: DataFrame, width: int) -> DataFrame:
    """(key, text, gram): of each text its characters rarest among the texts of that key.

    Two texts ``edits`` apart share one of their ``width * edits + 1`` rarest runs of ``width``
    characters; repeats are numbered. Texts too short for that also get the empty run.
    """
    pieces = F.regexp_extract_all("text", F.lit(f"(?s)(?=(.{{{width}}}))"), F.lit(1))

    def grams(side: DataFrame) -> DataFrame:
        counted = side.select("key", "text", F.explode(pieces).alias("piece")).groupBy("key", "text", "piece").count()
        repeats = F.transform(F.sequence(F.lit(1), F.col("count").cast("int")), lambda i: F.concat("piece", F.lit("#"), i.cast("string")))
        return counted.select("key", "text", F.explode(repeats).alias("gram"))

    own = grams(keyed)
    rarity = own.unionByName(grams(other)).groupBy("key", "gram").agg(F.count(F.lit(1)).alias("n"))
    ordered = by_merge(own).join(by_merge(rarity), ["key", "gram"]).groupBy("key", "text").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("grams"))
    needed = width * F.col("key.edits") + 1
    full = by_merge(keyed).join(by_merge(ordered), ["key", "text"], "left").withColumn("needed", needed)
    empty = F.array().cast("array<string>")
    rare = F.coalesce(F.transform(F.slice("grams", F.lit(1), F.col("needed")), lambda g: g["gram"]), empty)
    short = F.coalesce(F.size("grams"), F.lit(0)) < F.col("needed")
    return full.select("key", "text", F.explode(F.concat(rare, F.when(short, F.array(F.lit(""))).otherwise(empty))).alias("gram"))


def _longest_run(threshold: float, shortest: int) -> int:
    """The longest run of which texts of ``shortest`` characters or more have more than edits can change."""
    per_character = (1 - threshold) / threshold
    return max((q for q in range(2, LONGEST_RUN + 1) if (1 - q * per_character) * shortest >= q), default=1)


def _rare_runs(texts: DataFrame, rarity: DataFrame, runs: DataFrame, width: int, threshold: float) -> DataFrame:
    """(id, n, run, at): of each text its rarest runs with their places, all places of the last run that counts."""
    ordered = by_merge(runs).join(by_merge(rarity), "run").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("often", "run", "at"))).alias("runs"))
    n = F.length("text").cast("int")
    needed = width * _edits(F.floor(n / F.lit(threshold) + 1e-9), threshold) + 1
    full = by_merge(texts).join(by_merge(ordered), "id").select("id", n.alias("n"), "runs", F.get("runs", F.least(needed, F.size("runs")) - 1)["run"].alias("last"), needed.alias("needed"))
    kept = F.filter("runs", lambda r, i: (i < F.col("needed")) | (r["run"] == F.col("last")))
    return full.select("id", "n", F.explode(kept).alias("r")).select("id", "n", "r.run", "r.at")


def _long_pairs(ltexts: DataFrame, rtexts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (ltext, rtext) that may be similar, one of them longer than ``LONG``."""
    shortest = int(threshold * LONG)
    width = _longest_run(threshold, shortest)
    sides = [cut_lineage(texts.filter(F.length("text") >= shortest).withColumn("id", F.monotonically_increasing_id())) for texts in (ltexts, rtexts)]
    pieces = F.regexp_extract_all("text", F.lit(f"(?s)(?=(.{{{width}}}))"), F.lit(1))
    runs = [side.select("id", F.posexplode(pieces).alias("at", "run")) for side in sides]
    rarity = runs[0].unionByName(runs[1]).groupBy("run").agg(F.count(F.lit(1)).alias("often"))
    # lengths of similar texts lie in one class or in neighbouring ones
    step = F.lit(-math.log(threshold - 1e-9)) if threshold < 1 else F.lit(1.0)
    level = F.floor(F.log("n") / step)
    rare = [_rare_runs(side, rarity, own, width, threshold) for side, own in zip(sides, runs)]
    l = rare[0].select(F.col("id").alias("lid"), F.col("n").alias("ln"), "run", F.col("at").alias("lat"), F.explode(F.array(level - 1, level, level + 1)).alias("level"))
    r = rare[1].select(F.col("id").alias("rid"), F.col("n").alias("rn"), "run", F.col("at").alias("rat"), level.alias("level"))
    longer = F.greatest("ln", "rn")
    edits = _edits(longer, threshold)
    near = (F.abs(F.col("lat") - F.col("rat")) <= edits) & (F.abs(F.col("ln") - F.col("rn")) <= edits) & (longer > LONG)
    pairs = by_merge(l).join(by_merge(r), ["run", "level"]).filter(near).select("lid", "rid").distinct()
    named = [side.select(F.col("id").alias(f"{s}id"), F.col("text").alias(f"{s}text")) for s, side in zip("lr", sides)]
    return by_merge(by_merge(pairs).join(by_merge(named[0]), "lid")).join(by_merge(named[1]), "rid").select("ltext", "rtext")


def similar_texts(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Distinct (ltext, rtext, score) pairs with a score of at least ``threshold``."""
    if not 0.5 < threshold <= 1:
        raise ValueError("threshold must be above 0.5 and at most 1")
    every = [df.toDF("text").distinct() for df in (left, right)]
    short = _short_pairs(*[texts.filter(F.length("text") <= LONG) for texts in every], threshold)
    longer = F.greatest(F.length("ltext"), F.length("rtext"))
    edits = _edits(longer, threshold)
    candidates = short.unionByName(_long_pairs(*every, threshold)).filter(F.col("ltext") != F.col("rtext"))
    # the distance is worked out as far as the edits allow, else it is -1
    scored = candidates.withColumn("most", edits).withColumn("d", F.expr("levenshtein(ltext, rtext, most)")).filter("d >= 0")
    ltexts, rtexts = every[0].toDF("ltext"), every[1].toDF("rtext")
    equal = by_merge(ltexts).join(by_merge(rtexts), F.col("ltext") == F.col("rtext")).withColumn("score", F.lit(1.0))
    return scored.select("ltext", "rtext", (1 - F.col("d") / longer).alias("score")).unionByName(equal)


def _short_pairs(ltexts: DataFrame, rtexts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (ltext, rtext) of texts that may be similar, none longer than ``LONG``."""
    width = 2 if threshold >= PAIR_THRESHOLD else 1
    # each side's keys serve several joins: computed once
    lkeys = cut_lineage(ltexts.select("text", F.explode(_possible_segments(threshold)).alias("key")))
    rkeys = cut_lineage(rtexts.select("text", F.explode(_own_segments(threshold)).alias("key")))

    sizes = [keys.groupBy("key").agg(F.count(F.lit(1)).alias(n)) for keys, n in ((lkeys, "ln"), (rkeys, "rn"))]
    busy = cut_lineage(by_merge(sizes[0]).join(by_merge(sizes[1]), "key").filter(F.col("ln") * F.col("rn") > BUSY_PAIRS).select("key"))

    def pairs(l: DataFrame, r: DataFrame, on: list[str]) -> DataFrame:
        return by_merge(l.withColumnRenamed("text", "ltext")).join(by_merge(r.withColumnRenamed("text", "rtext")), on).select("ltext", "rtext")

    if busy.isEmpty():
        found = pairs(lkeys, rkeys, ["key"])
    else:
        busy = by_merge(busy)
        calm = pairs(lkeys.join(busy, "key", "left_anti"), rkeys, ["key"])
        lbusy, rbusy = lkeys.join(busy, "key", "left_semi"), rkeys.join(busy, "key", "left_semi")
        refined = pairs(_rare_grams(lbusy, rbusy, width), _rare_grams(rbusy, lbusy, width), ["key", "gram"])
        found = calm.unionByName(refined)
    return found.distinct()


def fuzzy_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str, threshold: float = 0.8, score: str = "Confidence Score") -> DataFrame:
    """All left and right columns of every pair of rows with similar keys; others are dropped."""
    left_key, right_key = resolve(left, left_key), resolve(right, right_key)
    for df, key in ((left, left_key), (right, right_key)):
        if column_type(df, key) != "string":
            raise TypeError(f"{key!r} is no text column")
    names = output_names(left.columns, right.columns)
    lrows = left.withColumn("__ltext", normalized(ref(left_key)))
    rrows = right.toDF(*names).withColumn("__rtext", normalized(ref(names[right.columns.index(right_key)])))
    texts = [rows.select(c).filter(F.col(c) != "") for rows, c in ((lrows, "__ltext"), (rrows, "__rtext"))]
    pairs = similar_texts(*texts, threshold).toDF("__lt", "__rt", score)
    return (
        by_merge(by_merge(lrows).join(by_merge(pairs), F.col("__ltext") == F.col("__lt")))
        .join(by_merge(rrows), F.col("__rt") == F.col("__rtext"))
        .select(*[ref(c) for c in left.columns], *[ref(c) for c in names], ref(score))
    )
