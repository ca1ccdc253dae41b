"""Usage of workflows over a period, and the run history."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import time_period
from ..types import ref

# Labels of run types.
USAGE_LABELS = {"scheduled": "Scheduled", "run_now": "On demand", "test_run": "Test"}
HISTORY_LABELS = {"run_now": "run", "scheduled": "run", "test_run": "test"}


class Usage(NamedTuple):
    totals: DataFrame
    workflows: DataFrame
    owners: DataFrame
    run_types: DataFrame
    workspaces: DataFrame
    connectors: DataFrame
    trend: DataFrame


def _label(c: Column, labels: dict[str, str]) -> Column:
    out = None
    for key, label in labels.items():
        out = F.when(c == key, label) if out is None else out.when(c == key, label)
    return out.otherwise(c)


def with_total_tokens(events: DataFrame) -> DataFrame:
    """`totalTokens` as given, else input plus output tokens."""
    given = ref("totalTokens") if "totalTokens" in events.columns else F.lit(None).cast("bigint")
    parts = F.coalesce("inputTokens", F.lit(0)) + F.coalesce("outputTokens", F.lit(0))
    return events.withColumn("totalTokens", F.coalesce(given, parts))


def _metrics() -> list[Column]:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return [
        F.count_distinct("recipeName").alias("botCount"),
        F.count(F.lit(1)).alias("runCount"),
        total("processedRecords").alias("rowCount"),
        total("inputTokens").alias("inputTokens"),
        total("outputTokens").alias("outputTokens"),
        total("totalTokens").alias("totalTokens"),
    ]


def usage_report(events: DataFrame, start, end, top: int = 10, trend: str = "day") -> Usage:
    """Usage between two days (inclusive): totals and breakdowns. ``trend`` is day or week."""
    day = F.col("startedAt").cast("date")
    inside = with_total_tokens(events).filter((day >= F.lit(str(start)).cast("date")) & (day <= F.lit(str(end)).cast("date")))

    def ranked(key: str) -> DataFrame:
        return inside.groupBy(key).agg(*_metrics()).orderBy(F.desc("runCount"), F.desc("rowCount"), key).limit(top)

    roles = [(role, f"{role}Connectors") for role in ("src", "dst") if f"{role}Connectors" in events.columns]
    connectors = None
    for role, column in roles:
        one = inside.select(F.lit(role).alias("role"), F.explode(column).alias("connector")).groupBy("role", "connector").agg(F.count(F.lit(1)).alias("runCount"))
        connectors = one if connectors is None else connectors.unionByName(one)
    if connectors is None:
        connectors = inside.sparkSession.createDataFrame([], "role string, connector string, runCount bigint")
    workspaces = inside if "workspace" in inside.columns else inside.withColumn("workspace", F.lit(None).cast("string"))
    return Usage(
        inside.agg(*_metrics()),
        ranked("recipeName"),
        ranked("recipeOwner"),
        inside.groupBy(_label(F.col("runType"), USAGE_LABELS).alias("runType")).agg(*_metrics()),
        workspaces.groupBy("workspace").agg(*_metrics()),
        connectors,
        inside.groupBy(time_period(F.col("startedAt"), trend).alias("period")).agg(*_metrics()),
    )


def epoch_time(c: Column) -> Column:
    """Timestamp of an epoch in seconds or milliseconds; null for none."""
    n = c.try_cast("double")
    millis = F.when(n > 10_000_000_000, n).otherwise(n * 1000)
    return F.when(n > 0, F.timestamp_millis(millis.cast("bigint")))


def duration_text(started_ms: Column, finished_ms: Column) -> Column:
    """`1 h 2 m 3 s` between two epochs in milliseconds; null when they make no sense."""
    seconds = F.bround((finished_ms.try_cast("double") - started_ms.try_cast("double")) / 1000, 0).cast("bigint")
    hours, minutes, rest = F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60
    text = (
        F.when(hours > 0, F.concat(hours.cast("string"), F.lit(" h "), minutes.cast("string"), F.lit(" m "), rest.cast("string"), F.lit(" s")))
        .when(minutes > 0, F.concat(minutes.cast("string"), F.lit(" m "), rest.cast("string"), F.lit(" s")))
        .otherwise(F.concat(rest.cast("string"), F.lit(" s")))
    )
    valid = (started_ms.try_cast("double") > 0) & (finished_ms.try_cast("double") > 0) & (finished_ms.try_cast("double") >= started_ms.try_cast("double"))
    return F.when(valid, text)


def run_history(executions: DataFrame, types: list[str] = ("run_now", "scheduled", "test_run")) -> DataFrame:
    """Executions in readable form: run type, times, duration, progress."""
    email = F.when(F.contains(F.col("submitter"), F.lit("@")), F.col("submitter"))
    progress = F.concat(F.bround(F.col("progress") * 100, 0).cast("int").cast("string"), F.lit("%"))
    return executions.filter(F.col("type").isin(*types)).select(
        _label(F.col("type"), HISTORY_LABELS).alias("type"),
        F.col("type").alias("executionType"),
        "id",
        F.col("recipeId").alias("workflowId"),
        F.col("recipeName").alias("workflowName"),
        F.col("recipeVersion").alias("version"),
        "submitter",
        email.alias("submitterEmail"),
        F.col("phase").alias("status"),
        "progress",
        progress.alias("progressLabel"),
        epoch_time(F.col("startedAt")).alias("startedAt"),
        epoch_time(F.col("finishedAt")).alias("finishedAt"),
        duration_text(F.col("startedAt"), F.col("finishedAt")).alias("duration"),
    )
