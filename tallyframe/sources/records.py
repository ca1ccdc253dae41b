"""Records of delimited text whose quoted cells may hold line breaks, read by many tasks per file.

Any line break may stand inside a cell, so a split of a file can't tell by itself where its first record
begins. Two passes settle that. In the first, every split is walked from both possible states, outside
and inside a cell in quotes, and gives the state it ends in for each. These transitions, one row a
split, are composed along each file in a window. In the second pass every split knows its state and
gives whole records; the pieces of records that reach over splits, at most two a split, are put together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

#: Bytes of a file that are read for its first record; doubled until it is whole.
FIRST_BYTES = 65_536
#: Files whose first bytes are read at the same time.
READERS = 16
CHOOSING = ("pathGlobFilter", "recursiveFileLookup", "modifiedAfter")


class Scanner:
    """Follows cells in quotes over the lines of a file; works on bytes of an encoding that keeps ASCII."""

    def __init__(self, delimiter: str):
        self.delimiter = delimiter.encode()
        self.opening = self.delimiter + b'"'
        # what stands in quotes up to the closing one; an escape takes the next character with it
        self.closed = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)

    def ends_inside(self, line: bytes, inside: bool) -> bool:
        """Whether a cell in quotes is open behind the line, when one was or was not before it."""
        if b'"' not in line:
            return inside
        at = 0
        while True:
            if inside or line.startswith(b'"', at):
                found = self.closed.match(line, at if inside else at + 1)
                if not found:
                    return True
                inside, at = False, line.find(self.delimiter, found.end())
            else:
                at = line.find(self.opening, at)
            if at < 0:
                return False
            at += len(self.delimiter)


def lines(spark: SparkSession, paths: str | list[str], options: dict[str, str]) -> DataFrame:
    """The lines of files with their file and split; order is kept inside a split."""
    chosen = {k: v for k, v in options.items() if k in CHOOSING}
    raw = spark.read.options(**chosen, lineSep="\n").text(paths)
    meta = F.col("_metadata")
    return raw.select(F.xxhash64(meta["file_path"]).alias("file"), meta["file_block_start"].alias("start"), F.col("value").cast("binary").alias("line"))


def _transitions(every: DataFrame, delimiter: str) -> DataFrame:
    """(file, start, outside, inside): the state behind each split for both states before it."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner, split, state = Scanner(delimiter), None, (False, True)

        def out():
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((*split, *state), kinds, strict=True)], ["file", "start", "outside", "inside"])

        for batch in batches:
            for file, start, line in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "line")), strict=True):
                if (file, start) != split:
                    if split:
                        yield out()
                    split, state = (file, start), (False, True)
                if b'"' in line:
                    first = scanner.ends_inside(line, state[0])
                    state = first, first if state[0] == state[1] else scanner.ends_inside(line, state[1])
        if split:
            yield out()

    return every.mapInArrow(run, "file long, start long, outside boolean, inside boolean")


def _open_splits(transitions: DataFrame) -> DataFrame:
    """(file, start) of the splits that begin inside a cell.

    A split whose end doesn't depend on its beginning fixes the state; behind it the state changes
    with every split that swaps the two.
    """
    along = Window.partitionBy("file").orderBy("start")
    fixed = F.when(F.col("outside") == F.col("inside"), F.col("outside"))
    swaps = (F.col("outside") & ~F.col("inside")).cast("int")
    placed = transitions.select("file", "start", fixed.alias("fixed"), swaps.alias("swaps")).withColumn("run", F.count("fixed").over(along))
    within = Window.partitionBy("file", "run").orderBy("start")
    ends = F.pmod(F.coalesce(F.first("fixed").over(within).cast("int"), F.lit(0)) + F.sum("swaps").over(within), F.lit(2))
    return placed.withColumn("ends", ends).withColumn("begins", F.lag("ends", 1, 0).over(along)).filter("begins = 1").select("file", "start")


def _pieces(every: DataFrame, delimiter: str, encoding: str) -> DataFrame:
    """Records and pieces of records of every split, which knows by ``opened`` where it begins.

    ``place`` is 1 for a whole record, 0 for what belongs to a record before and 2 for the beginning of
    one that goes on; ``first`` marks the first of a file.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner, split, held, inside, place, first = Scanner(delimiter), None, [], False, 1, False
        rows: list[tuple] = []

        def close(whole: bool) -> None:
            nonlocal held, place, first
            if held:
                text = b"\n".join(held).decode(encoding, "replace")
                if whole and place == 1:
                    text = text.removesuffix("\r")
                rows.append((*split, place if whole or not place else 2, first, text))
                first = False
            held, place = [], 1

        def out():
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["file", "start", "place", "first", "record"])

        for batch in batches:
            for file, start, line, opened in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "line", "opened")), strict=True):
                if (file, start) != split:
                    close(False)
                    split, inside, first = (file, start), opened, start == 0
                    place = 0 if opened else 1
                # blank lines between records are none
                if held or inside or line.strip(b"\r"):
                    held.append(line)
                    inside = scanner.ends_inside(line, inside)
                    if not inside:
                        close(True)
            yield out()
        close(False)
        yield out()

    return every.mapInArrow(run, "file long, start long, place int, first boolean, record string")


def records(spark: SparkSession, paths: str | list[str], options: dict[str, str], delimiter: str, encoding: str) -> DataFrame:
    """(record, first): the records of files as texts; ``first`` marks the first of a file."""
    every = lines(spark, paths, options)
    opened = cut_lineage(_open_splits(_transitions(every, delimiter)))
    if opened.isEmpty():
        return _pieces(every.withColumn("opened", F.lit(False)), delimiter, encoding).select("record", "first")
    # one row at most for each split of the input
    known = every.join(F.broadcast(opened.withColumn("opened", F.lit(True))), ["file", "start"], "left")
    pieces = _pieces(known.withColumn("opened", F.coalesce("opened", F.lit(False))), delimiter, encoding)
    whole = pieces.filter("place = 1")
    along = Window.partitionBy("file").orderBy("start", "place")
    # every piece that begins a record takes the pieces behind it with it
    parts = pieces.filter("place <> 1").withColumn("number", F.sum((F.col("place") == 2).cast("int")).over(along))
    ordered = F.sort_array(F.collect_list(F.struct("start", "place", "record")))
    joined = F.regexp_replace(F.array_join(F.transform(ordered, lambda p: p["record"]), "\n"), "\r$", "")
    spanning = parts.groupBy("file", "number").agg(joined.alias("record"), F.max("first").alias("first"))
    return whole.select("record", "first").unionByName(spanning.select("record", "first"))


def parsed(rows: DataFrame, record: Column, ddl: str, options: dict[str, str]) -> DataFrame:
    """Cells of ``rows``' records, under the columns of ``ddl``."""
    return rows.select(F.from_csv(record, ddl, options).alias("cells")).select("cells.*")


def first_records(spark: SparkSession, path: str | list[str], options: dict[str, str], delimiter: str, encoding: str) -> list[tuple[str, str]]:
    """(file, first record) of every file that has one; only the beginning of each file is read.

    The driver, which lists the files anyway, asks for their first bytes, ``READERS`` files at a time.
    """
    chosen = {k: v for k, v in options.items() if k in CHOOSING}
    files = sorted(spark.read.options(**chosen).text(path).inputFiles())
    jvm, scanner = spark._jvm, Scanner(delimiter)
    conf = spark._jsc.hadoopConfiguration()

    def first(file: str) -> tuple[str, str | None]:
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        size = FIRST_BYTES
        while True:
            stream = where.getFileSystem(conf).open(where)
            try:
                raw = bytes((stream if codec is None else codec.createInputStream(stream)).readNBytes(size))
            finally:
                stream.close()
            held, inside = [], False
            body = raw.removeprefix(b"\xef\xbb\xbf").split(b"\n")
            for i, line in enumerate(body):
                # the last line may go on beyond the bytes that were read
                if i == len(body) - 1 and len(raw) == size:
                    break
                if held or line.strip(b"\r"):
                    held.append(line)
                    inside = scanner.ends_inside(line, inside)
                    if not inside:
                        return file, b"\n".join(held).decode(encoding, "replace").removesuffix("\r")
            if len(raw) < size:
                return file, b"\n".join(held).decode(encoding, "replace").removesuffix("\r") if held else None
            size *= 2

    with ThreadPool(min(READERS, max(1, len(files)))) as pool:
        return [(file, record) for file, record in pool.imap(first, files) if record is not None]
