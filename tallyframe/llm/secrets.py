"""Secret scan with corpus-wide ownership frequency.

Every text is scanned for candidates: assignments to a secret-like name, access key ids, long runs
of hexadecimal digits, and, as the method's own addition, quoted or assigned high-entropy strings
and private-key headers. A candidate's hash is then counted over the whole corpus by distinct
owners (the first part of a source) and distinct repositories (sources): a value that many owners hold, or
several over many repositories, is a copied example. An owner's own value may lie in many of its
repositories. What is left is live where the value looks like a credential, and else a placeholder:
it holds a filler word, few different characters, or a stretch of the alphabet or the digits.

The counts come from distinct (value, source) pairs, which are combined in the tasks, so a value in
a third of all rows sends one row per source and task. Values reach their documents by
``join_groups``, which broadcasts the bounded number of very frequent ones.

Defined cases: null text counts as empty; a null source is an owner of its own; overlapping spans of
different kinds are all reported; repeated rows are reported one by one; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, staged

# The base kinds in their order, with pattern, group and least length.
BASE = (
    ("assign", re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
KINDS = {kind: i for i, kind in enumerate(("assign", "access", "hex", "quoted", "header"))}
#: Runs of base-64 characters between quotes, judged by their entropy.
QUOTED = re.compile(r"""["']([A-Za-z0-9+/_-]{32,}={0,2})["']""")
HEADER = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
LEAST_ENTROPY = 4.0
#: A value with at least so many owners is a copied example.
EXAMPLE_OWNERS = 3
#: So is one with two owners or more and at least so many repositories.
EXAMPLE_SOURCES = 10
#: Words of values that stand for a secret, and the fewest different characters of a live one.
FILLER = re.compile(r"change_?-?me|example|sample|dummy|placeholder|your[_-]|insert|redacted|replace|todo|foobar|password|passwd|secret|xxx|\.\.\.|\*\*\*", re.IGNORECASE)
LEAST_DIFFERENT = 5
#: Characters in a row, each the next one's predecessor, that make a value a placeholder.
LONGEST_STRETCH = 6
# the hex pattern's failing matches are whole runs, so the shorter form finds the same spans faster
_HEX = re.compile(r"[0-9a-f]{24,}")


def entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def looks_live(value: str) -> bool:
    """Whether a value could be a credential: no filler word, enough different characters, no long stretch like abcdef or 123456."""
    if FILLER.search(value) or len(set(value.lower())) < LEAST_DIFFERENT:
        return False
    stretch = longest = 1
    for a, b in zip(value, value[1:]):
        stretch = stretch + 1 if ord(b) == ord(a) + 1 else 1
        longest = max(longest, stretch)
    return longest < LONGEST_STRETCH


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the base kinds."""
    out = []
    for kind, pattern, group, least in BASE:
        for m in (_HEX if kind == "hex" else pattern).finditer(text):
            if len(value := m[group]) >= least:
                out.append((*m.span(), kind, value))
    return out


def more_spans(text: str) -> list[tuple[int, int, str, str]]:
    out = []
    if '"' in text or "'" in text:
        out += [(*m.span(1), "quoted", m[1]) for m in QUOTED.finditer(text) if entropy(m[1]) >= LEAST_ENTROPY]
    if "-----BEGIN" in text:
        out += [(*m.span(), "header", m[0]) for m in HEADER.finditer(text)]
    return out


def listed(spans: list[tuple[int, int, str, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in sorted(spans, key=lambda s: (s[0], KINDS[s[2]], s[1])))


def find(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """One row per row of ``docs``, with spans and the hashes of its candidates."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                base = base_spans(text)
                every = base + more_spans(text)
                n = Counter(kind for _, _, kind, _ in base)
                values = sorted({value for *_, kind, value in every if kind != "header"})
                candidates = [{"digest": hashlib.sha256(value.encode()).hexdigest()[:32], "looks_live": looks_live(value)} for value in values]
                rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(listed(base).encode()).hexdigest(), listed(every), candidates))
            found = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "candidates"], index=batch.index)
            yield pd.concat([batch[["id", "source", "row"]], found], axis=1)

    light = docs.select(
        F.col(id_column).cast("string").alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        F.col(source_column).cast("string").alias("source"),
        F.monotonically_increasing_id().alias("row"),
    )
    schema = "id string, source string, row long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, candidates array<struct<digest: string, looks_live: boolean>>"
    return light.mapInPandas(run, schema)


def ownership(found: DataFrame) -> DataFrame:
    """digest, n_rows, n_sources, n_owners and verdict (example, live or placeholder) of every candidate value."""
    owner = F.split("source", "/").getItem(0)
    pairs = found.select(F.inline("candidates"), F.coalesce("source", F.lit("\0")).alias("source"), F.coalesce(owner, F.lit("\0")).alias("owner"))
    per_source = pairs.groupBy("digest", "looks_live", "owner", "source").agg(F.count("*").alias("n"))
    per_owner = per_source.groupBy("digest", "looks_live", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("sources"))
    counts = per_owner.groupBy("digest", "looks_live").agg(F.sum("n").alias("n_rows"), F.sum("sources").alias("n_sources"), F.count("*").alias("n_owners"))
    copied = (F.col("n_owners") >= EXAMPLE_OWNERS) | ((F.col("n_owners") > 1) & (F.col("n_sources") >= EXAMPLE_SOURCES))
    verdict = F.when(copied, "example").when(F.col("looks_live"), "live").otherwise("placeholder")
    return counts.select("digest", "n_rows", "n_sources", "n_owners", verdict.alias("verdict"))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """One row per row of ``docs``: counts by kind, spans, and how many of its values look live, are copied or are placeholders."""
    found = staged(find(docs, id_column, text_column, source_column), "secrets")
    values = staged(ownership(found), "secret-values")
    held = found.select("row", F.inline("candidates")).drop("looks_live")
    total = held.count()
    judged = join_groups(held, values.select("digest", "n_rows", "verdict"), "digest", "n_rows", max(1, total))
    verdicts = {"n_live": "live", "n_example": "example", "n_placeholder": "placeholder"}
    per_row = judged.groupBy("row").agg(*[F.count_if(F.col("verdict") == word).alias(name) for name, word in verdicts.items()])
    out = found.join(per_row, "row", "left")
    return out.select(
        F.col("id").cast(dict(docs.dtypes)[id_column]).alias(id_column),
        *("n_assign", "n_access", "n_hex", "base_sha256", "spans"),
        *[F.coalesce(name, F.lit(0)).alias(name) for name in verdicts],
    )
