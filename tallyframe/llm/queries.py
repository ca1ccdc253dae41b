"""The registered queries of this folder; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import tune

from . import decontaminate, exact_dedup, html_text, jaccard_join, lang_id, line_dedup, packing, passages, resample, secrets, shards, token_counts, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(tune(spark), folder)

    QUERIES[build.__name__] = run
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_cost_balanced_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


@query
def op6_bloom_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


ORACLE["op6_bloom_exact_dedup"] = """
WITH n AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""


@query
def op8_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    out = shards.shard(table(spark, folder, "documents"), 24)
    return out.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query
def op10_signature_tree_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, folder, "documents"))


@query
def op3_block_rules_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query
def op9_word_first_language(spark: SparkSession, folder: str) -> DataFrame:
    return lang_id.identify(table(spark, folder, "documents"))


@query
def op5_spaced_seed_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op7_collinear_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"))


@query
def op11_perfect_hash_lines(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE["op11_perfect_hash_lines"] = r"""
WITH lines AS (
    SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), often AS (
    SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (SELECT doc_id, i, line, coalesce(keeper <> doc_id, false) AS gone FROM lines LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op12_sturm_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"), components=4)


@query
def op13_segment_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
