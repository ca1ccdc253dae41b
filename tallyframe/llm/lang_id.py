"""Language identification by word-first backoff.

A word that the model knows is scored by its log frequency in each language. A word it doesn't know
falls back to its character n-grams: the longest length of which the model knows at least one, then
the next shorter, down to single characters. A text's score is the mean over its words; the posterior
of the best language, at a fixed sharpness, is the reported score.

The model is fitted on a bounded sample of labelled rows: of each language the ``sample_rows`` rows
with the lowest hash, so that its size doesn't grow with the corpus and a frequent language
doesn't crowd out a rare one. Word and n-gram counts are Spark aggregations, and each language keeps its
``kept`` most frequent entries of each length. Every row is then predicted from its whole text.

Defined cases: null text, or a text without a letter, gets ``und`` and the score 0; very long texts
are scored by their word counts; ties go to the language that comes first in the alphabet; repeated
rows are predicted alike; without any labelled row everything is ``und``; an empty table gives an
empty result; other columns are ignored, also in prediction.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

UNKNOWN = "und"
#: Labelled rows a language is learned from at most.
SAMPLE_ROWS = 3000
#: Entries that a language keeps of words and of each n-gram length.
KEPT = 12_000
LONGEST_GRAM = 5
#: How sharply a mean log-frequency difference per word becomes a probability.
SHARPNESS = 4.0
#: Unknown words whose scores a worker keeps at most.
CACHED_WORDS = 200_000
_WORDS = re.compile(r"[^\W\d_]+")
WORD_PATTERN = r"\p{L}+"


def sample(labelled: DataFrame, label: str, key: Column, rows: int) -> DataFrame:
    """Of each label the rows with the lowest hash of ``key``.

    First the hash that bounds each label's sample is found, from labels and hashes alone; whole
    rows then pass or don't where they are. There are as many bounds as labels, so they are
    broadcast. Rows that tie with a bound are cut to the number by a last ranking.
    """
    hashed = labelled.withColumn("__hash", F.xxhash64(key))
    # salted first, so that a label in most rows isn't ordered by one task
    light = hashed.select(label, "__hash").withColumn("__task", F.pmod("__hash", F.lit(64)))
    per_task = Window.partitionBy(label, "__task").orderBy("__hash")
    per_label = Window.partitionBy(label).orderBy("__hash")
    least = light.withColumn("__n", F.row_number().over(per_task)).filter(F.col("__n") <= rows)
    least = least.withColumn("__n", F.row_number().over(per_label)).filter(F.col("__n") <= rows)
    bounds = staged(least.groupBy(label).agg(F.max("__hash").alias("__most")), "label-bounds")
    near = hashed.join(F.broadcast(bounds), label).filter("__hash <= __most")
    return near.withColumn("__n", F.row_number().over(per_label)).filter(F.col("__n") <= rows).drop("__hash", "__most", "__n")


class Model:
    """Log frequencies by language: for words, then for n-grams of each length, entries and their rows."""

    def __init__(self, languages: list[str], tables: list[tuple[dict[str, int], np.ndarray]]):
        self.languages, self.tables = languages, tables
        self.seen: dict[str, np.ndarray] = {}

    @classmethod
    def fitted(cls, counts: list[tuple[int, str, str, int]]) -> Model:
        """``counts``: (length, 0 for words; entry; language; count)."""
        languages = sorted({lang for _, _, lang, _ in counts})
        at = {lang: i for i, lang in enumerate(languages)}
        rows: list[dict[str, int]] = [{} for _ in range(LONGEST_GRAM + 1)]
        for length, entry, _, _ in counts:
            rows[length].setdefault(entry, len(rows[length]))
        found = [np.zeros((len(x), len(languages))) for x in rows]
        for length, entry, lang, n in counts:
            found[length][rows[length][entry], at[lang]] = n
        # half a count for what a language hasn't shown keeps the logarithms finite
        logs = [np.log((x + 0.5) / (x.sum(axis=0) + 0.5 * len(x) + 1)).astype(np.float32) for x in found]
        return cls(languages, list(zip(rows, logs, strict=True)))

    def word(self, word: str) -> np.ndarray:
        entries, logs = self.tables[0]
        row = entries.get(word)
        if row is not None:
            return logs[row]
        found = self.seen.get(word)
        if found is None:
            found = self.backoff(word)
            if len(self.seen) >= CACHED_WORDS:
                self.seen.clear()
            self.seen[word] = found
        return found

    def backoff(self, word: str) -> np.ndarray:
        padded = f" {word} "
        for length in range(LONGEST_GRAM, 0, -1):
            entries, logs = self.tables[length]
            known = [row for i in range(len(padded) - length + 1) if (row := entries.get(padded[i : i + length])) is not None]
            if known:
                return logs[known].mean(axis=0)
        return np.zeros(len(self.languages), dtype=np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = Counter(_WORDS.findall(text.lower())) if text else {}
        # numerals such as one half aren't letters
        words = {word: n for word, n in words.items() if word.isalpha() or any(map(str.isalpha, word))}
        if not words or not self.languages:
            return UNKNOWN, 0.0
        counts = np.fromiter(words.values(), dtype=np.float64, count=len(words))
        scores = counts @ np.stack([self.word(word) for word in words]) / counts.sum()
        odds = np.exp(SHARPNESS * (scores - scores.max()))
        best = int(np.argmax(odds))
        return self.languages[best], float(odds[best] / odds.sum())


def fit(labelled: DataFrame, text_column: str, label: str, key: Column, sample_rows: int = SAMPLE_ROWS, kept: int = KEPT) -> Model:
    """Learn from rows with a text and a label."""
    usable = labelled.filter(F.col(text_column).isNotNull() & F.col(label).isNotNull())
    slim = usable.select(F.col(text_column).cast("string").alias("text"), F.col(label).cast("string").alias("lang"), key.alias("key"))
    rows = sample(slim, "lang", F.col("key"), sample_rows)
    words = rows.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD_PATTERN), F.lit(0))).alias("entry"))
    words = staged(words.groupBy("lang", "entry").agg(F.count("*").alias("n")), "word-counts")
    grams = [words.select(F.lit(0).alias("length"), "lang", "entry", "n")]
    for length in range(1, LONGEST_GRAM + 1):
        padded = words.select("lang", "n", F.concat(F.lit(" "), "entry", F.lit(" ")).alias("w"))
        at = F.expr(f"transform(sequence(1, length(w) - {length} + 1), i -> substring(w, i, {length}))")
        found = padded.filter(F.length("w") >= length).select("lang", "n", F.explode(at).alias("entry"))
        grams.append(found.groupBy("lang", "entry").agg(F.sum("n").alias("n")).select(F.lit(length).alias("length"), "lang", "entry", "n"))
    every = grams[0]
    for more in grams[1:]:
        every = every.unionByName(more)
    top = Window.partitionBy("length", "lang").orderBy(F.desc("n"), "entry")
    # at most kept * languages * (LONGEST_GRAM + 1) rows come to the driver, whatever the corpus
    best = every.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= kept)
    return Model.fitted([tuple(r) for r in best.select("length", "entry", "lang", "n").collect()])


def predict(docs: DataFrame, model: Model, text_column: str = "text", columns: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with two columns added, for the predicted language and its score."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.tables))
    local: list[Model] = []

    def run(texts: pd.Series) -> pd.DataFrame:
        if not local:
            local.append(Model(*shared.value))
        return pd.DataFrame([local[0].predict(text) for text in texts], columns=["lang", "score"])

    predicted = F.pandas_udf(run, "lang string, score double")(F.col(f"`{text_column}`").cast("string"))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    out = docs.select(*kept, predicted.alias("__predicted"))
    return out.select(*kept, F.col("__predicted.lang").alias(columns[0]), F.col("__predicted.score").alias(columns[1]))


def held_out(id_column: str) -> Column:
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(3)) == 1


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "lang") -> DataFrame:
    """One row per row of ``docs``: its id, whether it was held out of the training, lang_pred and score."""
    test = F.coalesce(held_out(id_column), F.lit(False))
    model = fit(docs.filter(~test), text_column, label, F.col(id_column))
    slim = docs.select(F.col(id_column), test.alias("held_out"), F.col(text_column).alias("__text"))
    return predict(slim, model, "__text").drop("__text")


def accepted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "lang", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text is in one of the learned languages, by at least that score."""
    test = F.coalesce(held_out(id_column), F.lit(False))
    model = fit(docs.filter(~test), text_column, label, F.col(id_column))
    scored = predict(docs, model, text_column, ("__lang", "__score"))
    return scored.filter((F.col("__lang") != UNKNOWN) & (F.col("__score") >= least)).drop("__lang", "__score")
