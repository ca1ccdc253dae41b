"""A scheduled run that handles only the files that arrived since the last one.

Row-wise operators (adapter, edits, filters, clean-up) take a streaming DataFrame as it is; the
sinks run per batch, so every write mode is available. Progress is kept at ``state_path``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.writers import write_table


def process_new_files(
    spark: SparkSession,
    folder: str,
    schema: str,
    step: Callable[[DataFrame], DataFrame],
    target: str,
    state_path: str,
    fmt: str = "parquet",
    mode: str = "append",
    match_keys: list[str] = (),
    **options: str,
) -> None:
    """Read new files, apply ``step`` and write in the given mode; returns when all are done.

    With upsert or groupReplace a batch that is repeated after a failure changes nothing twice.
    """
    arrived = spark.readStream.format(fmt).schema(schema).options(**options).load(folder)

    def save(batch: DataFrame, _: int) -> None:
        write_table(step(batch), target, mode, list(match_keys))

    run = arrived.writeStream.foreachBatch(save).option("checkpointLocation", state_path).trigger(availableNow=True).start()
    run.awaitTermination()
