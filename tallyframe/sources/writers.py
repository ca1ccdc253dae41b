"""Sinks: file tables with replace, append, upsert, group replace and update; delimited output;
one folder per value; databases."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import check_sorts, null_safe, sort_columns
from ..types import ref, resolve

MODES = ("replace", "append", "upsert", "groupReplace", "update")


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    files, Path = _files(spark, path)
    return files.exists(Path(path))


def by_value(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one value together for a partitioned write, without a task per (task, value) file;
    adaptive execution splits a big value and joins small ones."""
    return df.hint("rebalance", *[ref(c) for c in columns])


def _partitioned(df: DataFrame, fmt: str, partition_by: list[str], options: dict[str, str]):
    if not partition_by:
        return df.write.format(fmt).options(**options)
    return by_value(df, partition_by).write.format(fmt).options(**options).partitionBy(*partition_by)


def _swap(df: DataFrame, path: str, fmt: str, partition_by: list[str], options: dict[str, str]) -> None:
    """Write next to the target, then rename, so that the target may be an input of ``df``."""
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:8]
    staging, backup = f"{path.rstrip('/')}__new_{mark}", f"{path.rstrip('/')}__old_{mark}"
    _partitioned(df, fmt, partition_by, options).save(staging)
    files, Path = _files(spark, path)
    had = files.exists(Path(path))
    if had and not files.rename(Path(path), Path(backup)):
        raise OSError(f"cannot move {path}")
    if not files.rename(Path(staging), Path(path)):
        if had:
            files.rename(Path(backup), Path(path))
        raise OSError(f"cannot move {staging}")
    if had:
        files.delete(Path(backup), True)


def check_compatible(new: DataFrame, old: DataFrame) -> None:
    """Raise unless both have the same columns with the same types."""
    have = {f.name.lower(): f.dataType for f in old.schema.fields}
    give = {f.name.lower(): f.dataType for f in new.schema.fields}
    if have != give:
        wrong = sorted(n for n in have.keys() | give.keys() if have.get(n) != give.get(n))
        raise ValueError(f"schema differs from the target in {wrong}")


def check_unique(df: DataFrame, keys: list[str]) -> None:
    twice = df.groupBy(*[ref(k) for k in keys]).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"match keys repeat, for example {twice[0].asDict()}")


def _without(old: DataFrame, new_keys: DataFrame, keys: list[str]) -> DataFrame:
    other = new_keys.select(*[ref(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    condition = null_safe([old[f"`{k}`"] for k in keys], [other[f"__k{i}"] for i in range(len(keys))])
    return old.join(other, condition, "left_anti")


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and old rows whose key is not among them."""
    check_compatible(new, old)
    return new.unionByName(_without(old, new, keys))


def group_replaced(old: DataFrame, new: DataFrame, groups: list[str]) -> DataFrame:
    """New rows, and old rows of groups that the new rows do not touch."""
    check_compatible(new, old)
    return new.unionByName(_without(old, new, groups))


def updated(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows with the new values where a key matches (a new null overwrites); nothing inserted."""
    keys = [resolve(old, k) for k in keys]
    changed = [c for c in old.columns if c not in keys and c.lower() in [n.lower() for n in new.columns]]
    other = new.select(
        *[ref(resolve(new, k)).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[ref(resolve(new, c)).alias(f"__v{i}") for i, c in enumerate(changed)],
        F.lit(True).alias("__hit"),
    )
    condition = null_safe([old[f"`{k}`"] for k in keys], [other[f"__k{i}"] for i in range(len(keys))])
    value = {c: F.when(ref("__hit"), ref(f"__v{i}")).otherwise(ref(c)).alias(c) for i, c in enumerate(changed)}
    return old.join(other, condition, "left").select(*[value.get(c, ref(c)) for c in old.columns])


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "replace",
    match_keys: list[str] = (),
    fmt: str = "parquet",
    partition_by: list[str] = (),
    **options: str,
) -> None:
    """Write a file table.

    replace overwrites, append adds rows of the same schema, upsert replaces or adds by unique
    ``match_keys``, groupReplace replaces all rows of each ``match_keys`` value present in the new
    rows, update changes matching rows only. When groupReplace keys are the partition columns, only
    those partitions are rewritten.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark, partition_by, keys = df.sparkSession, list(partition_by), list(match_keys)
    if mode in ("upsert", "groupReplace", "update") and not keys:
        raise ValueError(f"{mode} needs match keys")
    there = exists(spark, path)
    if mode == "replace":
        _swap(df, path, fmt, partition_by, options)
        return
    if not there:
        if mode == "update":
            raise ValueError("update needs an existing target")
        if mode == "upsert":
            check_unique(df, keys)
        _swap(df, path, fmt, partition_by, options)
        return
    old = spark.read.format(fmt).options(**options).load(path)
    if mode == "append":
        check_compatible(df, old)
        _partitioned(df, fmt, partition_by, options).mode("append").save(path)
        return
    keys = [resolve(df, k) for k in keys]
    if mode == "groupReplace":
        check_compatible(df, old)
        if partition_by and [k.lower() for k in keys] == [p.lower() for p in partition_by]:
            writer = _partitioned(df, fmt, partition_by, options).mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").save(path)
            return
        _swap(group_replaced(old, df, keys), path, fmt, partition_by, options)
        return
    check_unique(df, keys)
    merged = upserted(old, df, keys) if mode == "upsert" else updated(old, df, keys)
    _swap(merged, path, fmt, partition_by, options)


def write_delimited(
    df: DataFrame,
    path: str,
    sorts: list[tuple[str, str]] = (),
    one_file: bool = False,
    by: str | None = None,
    delimiter: str = ",",
    qualifier: str = '"',
    escape: str = "\\",
    charset: str = "UTF-8",
    mode: str = "overwrite",
) -> None:
    """Delimited output with a header.

    ``sorts`` orders the rows over all files (file names follow the order); ``one_file`` is for
    outputs a person opens. ``by`` writes one folder per value of that column.
    """
    if by:
        by = resolve(df, by)
        df = by_value(df, [by]).sortWithinPartitions(ref(by), *sort_columns(check_sorts(df, list(sorts))))
    elif sorts:
        df = df.orderBy(*sort_columns(check_sorts(df, list(sorts))))
    if one_file:
        df = df.coalesce(1)
        if sorts and not by:
            df = df.sortWithinPartitions(*sort_columns(check_sorts(df, list(sorts))))
    writer = df.write.mode(mode).options(header="true", sep=delimiter, quote=qualifier, escape=escape, encoding=charset)
    conf, option = df.sparkSession.conf, "spark.sql.legacy.javaCharsets"
    before = conf.get(option, None)
    if charset.upper() != "UTF-8":
        conf.set(option, "true")
    try:
        (writer.partitionBy(by) if by else writer).csv(path)
    finally:  # other reads and writes of the session keep their setting
        if charset.upper() != "UTF-8":
            conf.unset(option) if before is None else conf.set(option, before)


def write_database(df: DataFrame, url: str, table: str, mode: str = "append", connections: int = 8, batch: int = 10_000, **extra: str) -> None:
    """Write to a database table over at most ``connections`` connections."""
    options = {"url": url, "dbtable": table, "numPartitions": str(connections), "batchsize": str(batch), **extra}
    df.write.format("jdbc").options(**options).mode({"replace": "overwrite"}.get(mode, mode)).save()
