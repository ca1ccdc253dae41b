"""Row-wise scoring, document extraction and service calls through pluggable functions.

Prompts and requests are built by Spark expressions; only the given function runs in Python, on
Arrow batches, next to the data. Before every batch the garbage collector runs: accessors such as
``Series.str`` refer back to their series, so a batch outlives its last use until then, and the
collector by itself counts objects, not bytes, and hardly ever runs among texts.
"""

from __future__ import annotations

import gc
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..types import ref, resolve
from .semistructured import json_flatten
from .windows import window

PLACEHOLDER = re.compile(r"\{\{\s*(.+?)\s*\}\}")
# Methods of a call, and seconds per rate-limit unit.
METHODS = ("GET", "POST", "PUT", "PATCH", "DELETE")
RATE_UNITS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86400}


def render(df: DataFrame, template: str) -> Column:
    """Text with every ``{{Field}}`` replaced by that column; an unknown field raises."""
    pieces, at = [], 0
    for found in PLACEHOLDER.finditer(template):
        pieces.append(F.lit(template[at:found.start()]))
        pieces.append(F.coalesce(ref(resolve(df, found.group(1))).cast("string"), F.lit("")))
        at = found.end()
    pieces.append(F.lit(template[at:]))
    return F.concat(*pieces)


def infer(
    df: DataFrame,
    template: str,
    scorer: Callable[[pd.Series], pd.Series],
    row_limit: int | None = None,
    order: list[tuple[str, str]] = (),
    out: str = "AI Answer",
) -> DataFrame:
    """One answer per row. With ``row_limit``, only the first rows by ``order`` are scored and the
    others get null; rows tied on ``order`` come in the order of the remaining columns."""

    @F.pandas_udf("string")
    def answer(prompts: pd.Series) -> pd.Series:
        gc.collect()
        return scorer(prompts)

    prompted = df.withColumn("__prompt", render(df, template))
    if row_limit is None:
        return prompted.withColumn(out, answer("__prompt")).drop("__prompt")
    if not order:
        raise ValueError("a row limit needs an order")
    numbered = window(prompted, "__rn", "ROW_NUM", sorts=list(order))
    scored = numbered.filter(ref("__rn") <= row_limit).withColumn(out, answer("__prompt"))
    rest = numbered.filter(ref("__rn") > row_limit).withColumn(out, F.lit(None).cast("string"))
    return scored.unionByName(rest).drop("__prompt", "__rn")


def infer_json(df: DataFrame, template: str, scorer, schema: str, **options) -> DataFrame:
    """Scores whose answer is a JSON object, flattened into declared columns."""
    answered = infer(df, template, scorer, out="__answer", **options)
    return json_flatten(answered, "__answer", schema)


def extract_documents(df: DataFrame, extractor: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """One document row to any number of rows; ``extractor`` maps batches of documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            gc.collect()
            yield extractor(batch)

    return df.mapInPandas(run, schema)


def build_requests(df: DataFrame, url: str, method: str = "GET", body: str | None = None) -> DataFrame:
    """Request table of a service call: every row with its URL, method and body.

    Field values go into the URL as they are, without URL encoding.
    """
    return df.select(
        "*",
        render(df, url).alias("Request URL"),
        F.lit(method.upper()).alias("Request Method"),
        (render(df, body) if body else F.lit(None).cast("string")).alias("Request Body"),
    )


def call_api(
    df: DataFrame,
    url: str,
    transport: Callable[[str, str, str | None], tuple[int, str]],
    method: str = "GET",
    body: str | None = None,
    rate: tuple[int, str] | None = None,
    result: str = "RAW_STRING",
    schema: str | None = None,
    tasks: int = 8,
) -> DataFrame:
    """One call per row; a failure comes back as status and text of that row.

    ``rate`` = (calls, unit) holds for the whole call: the rows are dealt to ``tasks`` tasks, each of
    which keeps to its part of it. ``result`` JSON flattens the answer by ``schema``. Save the
    result before using it twice, for every action calls again.
    """
    if method.upper() not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if result not in ("RAW_STRING", "JSON"):
        raise ValueError("result must be RAW_STRING or JSON")
    pause = tasks * RATE_UNITS[rate[1]] / rate[0] if rate else 0.0
    requests = build_requests(df, url, method, body)
    if rate:
        requests = requests.repartition(tasks)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, texts = [], []
            for target, verb, payload in zip(batch["Request URL"], batch["Request Method"], batch["Request Body"]):
                try:
                    code, text = transport(target, verb, payload)
                except Exception as exc:  # an error is data here
                    code, text = 0, str(exc)
                codes.append(code)
                texts.append(text)
                if pause:
                    time.sleep(pause)
            yield batch.assign(**{"Response Status": codes, "Response Body": texts})

    answered = requests.mapInPandas(run, f"{fields}, `Response Status` int, `Response Body` string")
    if result == "RAW_STRING":
        return answered
    return json_flatten(answered, "Response Body", schema)
