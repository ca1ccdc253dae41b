"""Sources: delimited text, tables, documents, JSON and XML text, databases, file patterns."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce
from io import StringIO
from itertools import chain, count
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shape import ColumnSpec, adapter, normalize_keys
from ..types import ref, resolve
from . import records

# Character sets by their common names.
CHARSETS = {"utf-8": "UTF-8", "utf8": "UTF-8", "windows-1252": "windows-1252", "cp1252": "windows-1252"}
TIER_ROWS = 1000


def unique_headers(names: Iterable[object]) -> list[str]:
    """Blank headers become `col_N`, repeated ones `name_2`, `name_3`.

    Names that differ only in case clash. A name given in the file is never taken by a made-up one.
    """
    given = ["" if raw is None else str(raw).strip() for raw in names]
    reserved, out = {name.lower() for name in given if name}, []
    for place, name in enumerate(given, start=1):
        fresh = name and all(name.lower() != other.lower() for other in out)
        if not fresh:
            stem = name or f"col_{place}"
            made_up = chain([] if name else [stem], (f"{stem}_{k}" for k in count(2)))
            name = next(c for c in made_up if c.lower() not in reserved)
            reserved.add(name.lower())
        out.append(name)
    return out


def file_options(pattern: str | None = None, subfolders: bool = False, modified_after: str | None = None) -> dict[str, str]:
    """Reader options that choose files below a folder."""
    options = {}
    if pattern:
        options["pathGlobFilter"] = pattern
    if subfolders:
        options["recursiveFileLookup"] = "true"
    if modified_after:
        options["modifiedAfter"] = modified_after
    return options


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    charset: str = "utf-8",
    header: bool = True,
    types: dict[str, str] | None = None,
    infer: bool = False,
    columns: list[str] | None = None,
    multiline: bool = False,
    odd_rows: str | None = None,
    **files,
) -> DataFrame:
    """Delimited text with quote `"` and escape `\\`.

    Columns are text unless pinned in ``types`` or, with ``infer``, inferred by one extra pass;
    pinned columns keep leading zeros. Every file's columns are taken by the names in its own
    header; one that a file lacks is null there. ``columns`` gives the columns of all files by
    position, which saves looking at the files' first lines.

    ``multiline``: cells in quotes may hold line breaks, also in the header. Such files are split over
    tasks like any others, at the price of two passes over their lines (see ``records``).
    ``odd_rows`` names a column for the raw text of rows with more or fewer cells than the header
    has, else null. Without it, missing cells are null and cells beyond the header are left out.
    """
    encoding = CHARSETS.get(charset.lower())
    if encoding is None:
        raise ValueError(f"charset must be one of {sorted(CHARSETS)}")
    # Spark reads ISO-8859-1; the characters where windows-1252 differs are put right afterwards
    latin = encoding != "UTF-8"
    options = {"sep": delimiter, "quote": '"', "escape": "\\", "encoding": "ISO-8859-1" if latin else encoding, **file_options(**files)}
    code = "latin-1" if latin else "utf-8"

    def load(paths: str | list[str], names: list[str]) -> DataFrame:
        ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*names, *([odd_rows] if odd_rows else [])])
        extra = {"columnNameOfCorruptRecord": odd_rows} if odd_rows else {}
        if multiline:
            rows = records.records(spark, paths, options, delimiter, code)
            cells = {k: options[k] for k in ("sep", "quote", "escape")}
            loaded = records.parsed(rows.filter("NOT first") if header else rows, F.col("record"), ddl, {**cells, **extra})
        else:
            # enforceSchema: header texts may differ from the cleaned names
            loaded = spark.read.options(**options, **extra, header=str(header).lower(), enforceSchema="true").schema(ddl).csv(paths)
        return loaded.select(*[_windows_1252(c) for c in loaded.columns]) if latin else loaded

    if columns is not None:
        df = load(path, columns)
    elif header:
        by_header = _headers(spark, path, options, multiline)
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [load(paths, unique_headers(first)) for first, paths in by_header])
        if odd_rows:  # last, whatever the files
            df = df.select(*[ref(c) for c in df.columns if c != odd_rows], ref(odd_rows))
    else:
        first = next((record for _, record in records.first_records(spark, path, options, delimiter, code)), None)
        if first is None:
            raise ValueError("the file has no rows")
        df = load(path, [f"col_{i + 1}" for i in range(len(_cells(first, delimiter, multiline)))])
    pinned = {resolve(df, name): logical for name, logical in (types or {}).items()}
    if infer:
        from ..plans.profile import infer_types

        pinned = {**infer_types(df, [c for c in df.columns if c not in pinned]), **pinned}
    return adapter(df, [ColumnSpec(c, pinned.get(c, "string")) for c in df.columns])


def _windows_1252(name: str) -> Column:
    """A column read as ISO-8859-1 with windows-1252's own characters."""
    codes = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
    return F.translate(ref(name), "".join(map(chr, codes)), bytes(codes).decode("cp1252")).alias(name)


def _cells(record: str, delimiter: str, multiline: bool) -> list[str]:
    """A record's cells; without line breaks in cells, its first line's."""
    text = record if multiline else record.split("\n", 1)[0].removesuffix("\r")
    return next(csv.reader(StringIO(text, newline=""), delimiter=delimiter, escapechar="\\"))


def _headers(spark: SparkSession, path: str | list[str], options: dict[str, str], multiline: bool) -> list[tuple[list[str], list[str]]]:
    """The different headers of the files at a path, each with its files."""
    latin = options["encoding"] == "ISO-8859-1"
    found: dict[str, list[str]] = {}
    for file, record in records.first_records(spark, path, options, options["sep"], "cp1252" if latin else "utf-8"):
        found.setdefault(record if multiline else record.split("\n", 1)[0], []).append(unquote(file))
    if not found:
        raise ValueError("the files have no rows")
    return [(_cells(record, options["sep"], multiline), files) for record, files in found.items()]


def read_table(spark: SparkSession, dataset: str, fmt: str | None = None) -> DataFrame:
    """A dataset by id: a path with its format (by ending, else Parquet) or a catalog table name."""
    if fmt is None and "/" not in dataset:
        return spark.table(dataset)
    if fmt is None:
        ending = dataset.rstrip("/").rsplit(".", 1)[-1].lower()
        fmt = ending if ending in ("parquet", "orc", "json") else "parquet"
    return spark.read.format(fmt).load(dataset)


def standardized_source(df: DataFrame, specs: list[ColumnSpec], keys: list[str] = (), passthrough: bool = False) -> DataFrame:
    """Typed contract and normalised join keys in one step; key columns are text."""
    wanted = {k.lower() for k in keys}
    typed = [ColumnSpec(s.name, "string", s.mapped_from, s.required) if s.name.lower() in wanted else s for s in specs]
    return normalize_keys(adapter(df, typed, passthrough), list(keys))


def read_binary(spark: SparkSession, path: str, **files) -> DataFrame:
    """Documents as rows of path, time, size and content."""
    return spark.read.format("binaryFile").options(**file_options(**files)).load(path)


def read_text_documents(spark: SparkSession, path: str, out: str = "Content", **files) -> DataFrame:
    """JSON or XML files, each whole file one text row with its path."""
    rows = spark.read.options(wholetext="true", **file_options(**files)).text(path)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias(out))


read_json_text = read_text_documents
read_xml_text = read_text_documents


def latest_file(spark: SparkSession, path: str, **files) -> str:
    """Path of the most recently changed file below a folder."""
    meta = spark.read.format("binaryFile").options(**file_options(**files)).load(path)
    row = meta.select("path", "modificationTime").orderBy(F.desc("modificationTime"), F.desc("path")).first()
    if row is None:
        raise ValueError(f"no file below {path}")
    return row["path"]


def database_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """JDBC options. ``partition`` = (column, lower, upper, reads) reads a table in parallel; a
    ``query`` (with filters or grouping) runs in the database."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size), **extra}
    if query is not None:
        # a derived table, so that it can be read in parallel too
        options["dbtable"] = f"({query}) source"
    else:
        options["dbtable"] = table
    if partition:
        column, lower, upper, reads = partition
        options |= {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(reads)}
    return options


def read_database(spark: SparkSession, url: str, **options) -> DataFrame:
    """Database table or query; filters and column choice are pushed down by Spark."""
    return spark.read.format("jdbc").options(**database_options(url, **options)).load()


def sample_tier(df: DataFrame, tier: str = "1k") -> DataFrame:
    """``max`` reads everything; any other tier at most 1000 input rows."""
    return df if tier == "max" else df.limit(TIER_ROWS)


def field_selection(df: DataFrame, names: list[str]) -> DataFrame:
    """Only these columns; the scan reads no others."""
    return df.select(*[ref(resolve(df, n)) for n in names])


