"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Texts become words (runs of letters and digits, lower-cased), words become hashes. A seed is a window
of ``SPAN`` words under a fixed mask that ignores some positions, so a substituted word at an ignored
position doesn't hide a hit. The masks are chosen together: wherever the substituted words stand, an
overlap has a hit. Window hashes of the documents are joined with those of the benchmark. Around every
hit both texts are laid side by side at the hit's offset. An overlap has ``LEAST_WORDS`` words or more, or
those of a whole shorter item, and four in five of them are equal (of an item shorter than a mask, all).
Of several at one offset, the one with the best balance of equal words (+1) against substituted ones (-4)
is given, of several offsets the one with more equal words.

The benchmark side is broadcast while it has at most ``BROADCAST_ROWS`` windows. Beyond that a bitmap
of its hashes, of bounded size, is broadcast to keep the other windows out of the shuffle. Hits become
distinct (document, item, offset) rows, and only documents with a hit are read again, so a passage in a
third of all documents costs each of them one row.

Defined cases: null and empty texts and items match nothing; ties go to the stretch that ends first at one
offset, then to the earlier place; rows that repeat an id are one document; empty tables give an empty result; other columns, whatever
their names, are ignored, or kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmaps, cells, filter_bits, possible_rows, staged, with_filter_hit, without_rows

SPAN = 12
#: Positions that each mask looks at. For every choice of up to a fifth of 12 to 25 words as substituted, one of the
#: masks fits in somewhere; a longer overlap has a half, and so a part of 13 to 25 words, with four in five equal.
MASKS = (
    (0, 1, 3, 5, 10, 11),
    (0, 4, 6, 7, 8, 11),
    (0, 1, 2, 3, 6, 7),
    (2, 5, 7, 9, 10, 11),
    (1, 2, 3, 4, 8, 9),
    (0, 2, 4, 5, 8, 10),
    (1, 3, 4, 5, 6, 7),
)
LEAST_WORDS = 13
#: A substituted word costs as much as so many equal ones: four in five must be equal.
COST = 4
#: Windows of a benchmark that is broadcast (under 100 MB).
BROADCAST_ROWS = 1_000_000


def word_hashes(text: str) -> Column:
    """Hashes of a text's words in order."""
    return F.expr(rf"transform(array_remove(split(lower(coalesce(cast(`{text}` AS string), '')), '[^\\p{{L}}\\p{{N}}]+'), ''), w -> xxhash64(w))")


def seeds(short: list[int]) -> list[tuple[int, tuple[int, ...]]]:
    """(span, positions) of all seeds; ``short`` has the lengths of items shorter than a span."""
    return [(SPAN, mask) for mask in MASKS] + [(n, tuple(range(n))) for n in short]


def windows(rows: DataFrame, key: str, words: str, span: int, masks: list[tuple[int, ...]]) -> DataFrame:
    """Every window of ``words`` as (key, at, hash): its first word and its hash under each mask.

    Only the places are exploded: compiled in one stage with the hashes, the array of words is read
    where it stands and isn't copied from row to row.
    """
    places = rows.filter(F.size(words) >= span).select(key, words, F.explode(F.sequence(F.lit(0), F.size(words) - span)).alias("at"))
    hashes = [F.xxhash64(F.lit(span * 100 + i), *[F.col(words)[F.col("at") + p] for p in mask]) for i, mask in enumerate(masks)]
    return places.select(key, "at", F.array(*hashes).alias("hashes")).select(key, "at", F.explode("hashes").alias("hash"))


def best_stretch(same: str, least: str) -> Column:
    """(first, words, equal) of the stretch of ``least`` booleans ``same`` or more with the best balance; no words where it is negative."""
    state = "struct(0 AS i, 0L AS bits, 0 AS sum, 0 AS from, 0 AS eq, -1 AS best, 0 AS first, 0 AS words, 0 AS equal)"
    # the last ``least`` booleans are bits; the best stretch up to a place is these alone or continues the best one up to the place before
    seen = f"struct(s.i + 1 AS i, (shiftleft(s.bits, 1) & (shiftleft(1L, {least}) - 1L)) | IF(e, 1L, 0L) AS bits)"
    alone = f"5 * bit_count(t.bits) - {COST} * {least}"
    starts = f"t.i <= {least} OR {alone} >= s.sum + IF(e, 1, -{COST})"
    here = f"""struct(
        IF({starts}, {alone}, s.sum + IF(e, 1, -{COST})) AS sum,
        IF({starts}, t.i - {least}, s.from) AS from,
        IF({starts}, bit_count(t.bits), s.eq + IF(e, 1, 0)) AS eq)"""
    step = f"""(s, e) -> transform(array({seen}), t -> transform(array({here}), u -> struct(
        t.i AS i, t.bits AS bits, u.sum AS sum, u.from AS from, u.eq AS eq,
        IF(t.i >= {least} AND u.sum > s.best, u.sum, s.best) AS best,
        IF(t.i >= {least} AND u.sum > s.best, u.from, s.first) AS first,
        IF(t.i >= {least} AND u.sum > s.best, t.i - u.from, s.words) AS words,
        IF(t.i >= {least} AND u.sum > s.best, u.eq, s.equal) AS equal))[0])[0]"""
    return F.expr(f"aggregate({same}, {state}, {step}, s -> struct(s.first AS first, s.words AS words, s.equal AS equal))")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item that overlap: their ids, the places (in words), and the numbers of words and equal words."""
    items = staged(benchmark.select(F.col(item_column).alias("item"), word_hashes(item_text).alias("item_words")).filter("size(item_words) > 0"), "items")
    # at most SPAN - 1 lengths
    short = sorted(r[0] for r in items.filter(F.size("item_words") < SPAN).select(F.size("item_words")).distinct().collect())
    by_span: dict[int, list[tuple[int, ...]]] = {}
    for span, mask in seeds(short):
        by_span.setdefault(span, []).append(mask)
    rows = docs.select(F.col(id_column).alias("doc"), word_hashes(text_column).alias("words"))
    found, item_windows = None, 0
    for span, masks in by_span.items():
        own = items.filter(F.size("item_words") == span) if span < SPAN else items
        item_side = staged(windows(own, "item", "item_words", span, masks).withColumnRenamed("at", "item_at"), "item-windows")
        doc_side = windows(rows, "doc", "words", span, masks)
        count = item_side.count()
        item_windows += count
        if count <= BROADCAST_ROWS:
            hits = doc_side.join(F.broadcast(item_side), "hash")
        else:
            bits = filter_bits(count)
            maps = staged(bitmaps(item_side.select(F.explode(F.array(*cells(F.col("hash"), bits, 2))).alias("cell"))), "item-filter")
            hits = with_filter_hit(doc_side, maps, F.col("hash"), bits, 2, "__hit").filter("__hit").drop("__hit").join(item_side, "hash")
        hits = hits.select("doc", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        found = hits if found is None else found.unionByName(hits)
    # one row for each document, item and offset; only documents with a hit are read again
    found = staged(found.distinct(), "hits")
    ids = staged(found.select("doc").distinct(), "hit-ids")
    near = possible_rows(docs, id_column, ids, ids.count()).select(F.col(id_column).alias("doc"), word_hashes(text_column).alias("words"))
    # an item has about as many words as windows, so the same bound holds for its words
    laid = found.join(near, "doc").join(F.broadcast(items) if item_windows <= BROADCAST_ROWS else items, "item")
    laid = laid.withColumn("doc_from", F.greatest("shift", F.lit(0))).withColumn("item_from", F.greatest(-F.col("shift"), F.lit(0)))
    reach = F.greatest(F.lit(0), F.least(F.size("words") - F.col("doc_from"), F.size("item_words") - F.col("item_from")))
    laid = laid.withColumn("same", F.zip_with(F.slice("words", F.col("doc_from") + 1, reach), F.slice("item_words", F.col("item_from") + 1, reach), lambda x, y: x == y))
    laid = laid.withColumn("least", F.least(F.lit(LEAST_WORDS), F.size("item_words")))
    # most hits are by chance, and so few equal words are no overlap
    laid = laid.filter("5 * size(filter(same, e -> e)) >= 4 * least")
    found = laid.select("doc", "item", "doc_from", "item_from", best_stretch("same", "least").alias("best"))
    places = found.filter("best.words > 0").select(
        "doc",
        "item",
        (F.col("doc_from") + F.col("best.first")).alias("doc_word"),
        (F.col("item_from") + F.col("best.first")).alias("item_word"),
        F.col("best.words").alias("n_words"),
        F.col("best.equal").alias("n_equal"),
    )
    order = F.struct(F.col("n_equal"), F.col("n_words"), -F.col("doc_word"), -F.col("item_word"))
    best = places.groupBy("doc", "item").agg(F.max(order).alias("b"))
    return best.select(
        F.col("doc").alias(id_column),
        F.col("item").alias(item_column),
        (-F.col("b.col3")).cast("long").alias("doc_word"),
        (-F.col("b.col4")).cast("long").alias("item_word"),
        F.col("b.n_words").cast("long").alias("n_words"),
        F.col("b.n_equal").cast("long").alias("n_equal"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap with no item. A row's own text decides, whatever its id."""
    digest = F.md5(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).cast("binary"))
    keyed = docs.select(*[F.col(f"`{c}`") for c in docs.columns], digest.alias("__digest"))
    found = overlaps(keyed.select("__digest", F.col(f"`{text_column}`").alias("text")), benchmark, "__digest", "text", item_column, item_text)
    return without_rows(keyed, "__digest", staged(found.select("__digest").distinct(), "contaminated")).drop("__digest")
