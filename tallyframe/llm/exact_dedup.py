"""Exact duplicates by a two-pass Bloom filter, in DataFrame functions only.

First pass: every text's hash sets cells of a filter, and a cell that two rows set is marked. The
marked cells become bitmaps of a bounded size. Second pass: a row whose cells aren't all marked has
no equal and passes straight through; only the others are shuffled and grouped by their exact hash.
A false hit costs a shuffled row and changes nothing, so results don't depend on the filter's size.

Defined cases: null text counts as empty, and empty texts are equal to each other. A null id loses
to any other. Of rows with the same text and the same id exactly one is kept. An empty table gives
an empty result. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmaps, cells, filter_bits, join_groups, staged, text_of, with_filter_hit

HASHES = 2


def normalised(text: Column) -> Column:
    """Lower-cases A-Z only. ``lower`` is faster and the same for texts of one byte a character."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def digest(text: str) -> Column:
    return F.unhex(F.sha2(F.encode(normalised(text_of(text)), "UTF-8"), 256))


def repeated_cells(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """First pass: bitmaps of the cells that more than one row sets. Counts are combined in the tasks."""
    set_by = rows.select(F.explode(F.array(*cells(F.col(key), bits, HASHES))).alias("cell"))
    return bitmaps(set_by.groupBy("cell").count().filter("count > 1"))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, keep_id, group_size, kept and text_sha256."""
    rows = staged(docs.select(F.col(id_column).alias("id"), digest(text_column).alias("sha"), F.monotonically_increasing_id().alias("row")), "text-hashes")
    total = rows.count()
    bits = filter_bits(total)
    marked = staged(repeated_cells(rows, "sha", bits), "repeated-cells")
    probed = with_filter_hit(rows, marked, F.col("sha"), bits, HASHES, "suspect")
    suspects = staged(probed.filter("suspect").drop("suspect"), "suspects")
    groups = suspects.groupBy("sha").agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("size"))
    groups = staged(groups.filter("size > 1"), "groups")
    joined = join_groups(suspects, groups, "sha", "size", total)
    grouped = joined.selectExpr("id", "sha", "row", "coalesce(best, struct(id, row)) AS best", "coalesce(size, 1L) AS size")
    alone = probed.filter("not suspect").selectExpr("id", "sha", "row", "struct(id, row) AS best", "1L AS size")
    return alone.unionByName(grouped).select(
        F.col("id").alias(id_column),
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("best.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row per text: the one of the largest id."""
    columns = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    hashed = docs.select(whole.alias("kept_row"), digest(text_column).alias("sha"), F.monotonically_increasing_id().alias("row"))
    hashes = staged(hashed.select("sha"), "text-hashes")
    bits = filter_bits(hashes.count())
    marked = staged(repeated_cells(hashes, "sha", bits), "repeated-cells")
    probed = with_filter_hit(hashed, marked, F.col("sha"), bits, HASHES, "suspect")
    # combined in the tasks, so that of a large group each task sends one row
    best = probed.filter("suspect").groupBy("sha").agg(F.max_by("kept_row", F.struct(F.col(f"kept_row.`{id_column}`"), F.col("row"))).alias("kept_row"))
    return probed.filter("not suspect").select("kept_row").unionByName(best.select("kept_row")).select("kept_row.*")
