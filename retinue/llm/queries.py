"""One query per operator over the whole of its table, with the SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.llm import (
    alignment,
    embeddings,
    importance,
    language,
    lines,
    mixing,
    probminhash,
    quality,
    suffixes,
    tokenfiles,
    topk,
    urls,
)
from retinue.llm.defaults import bpe_digests, held_out, language_model
from retinue.llm.frames import read
from retinue.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The word pattern of the contracts, as DuckDB's regular expressions write it.
_SQL_WORD = r"[^\x20\x09-\x0D]+"
_SQL_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def query(name: str, sql: str | None = None):
    def record(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return record


@query(
    "op4_mix_sources",
    f"""
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_SQL_WORD}'))::BIGINT AS size
        FROM documents
    ), s AS (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
        FROM d GROUP BY source
    ), w AS (
        SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most
        FROM s
    ), o AS (
        SELECT *, row_number() OVER (ORDER BY most / weight, place) AS filled FROM w
    ), l AS (
        SELECT a.source, a.source_size, a.weight, a.most, a.filled,
            (SELECT sum(source_size) FROM o) - coalesce((SELECT sum(most) FROM o b WHERE b.filled < a.filled), 0)
                AS rest,
            (SELECT sum(weight) FROM o b WHERE b.filled >= a.filled) AS weights
        FROM o a
    ), f AS (
        SELECT * FROM l WHERE most * weights > rest * weight ORDER BY filled LIMIT 1
    ), t AS (
        SELECT l.source, l.source_size,
            CASE WHEN f.filled IS NULL OR l.filled < f.filled THEN l.most::DOUBLE
                 ELSE l.weight::DOUBLE * f.rest::DOUBLE / f.weights::DOUBLE END AS target
        FROM l LEFT JOIN f ON true
    ), r AS (
        SELECT d.doc_id, d.size, t.source_size, t.target,
            CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
            ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE
                / 4503599627370496 AS u
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target,
        (size * (floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT))::BIGINT AS taken
    FROM r
    """,
)
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixing.repeats(read(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", taken)


@query("op5_quality_outliers")
def op5_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(read(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "distance",
    )


@query(
    "op7_line_dedup",
    f"""
    WITH d AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
    ), l AS (
        SELECT doc_id, unnest(range(len(parts))) AS i, unnest(parts) AS line FROM d
    ), k AS (
        SELECT *, translate(trim(line, {_SQL_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            AS key
        FROM l
    ), s AS (
        SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10
        GROUP BY key HAVING count(DISTINCT doc_id) >= 2
    ), m AS (
        SELECT k.doc_id, k.i, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
        FROM k LEFT JOIN s ON k.key = s.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
)
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.drop_repeated_lines(read(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query("op1_token_files")
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    place = new_folder(spark, "tokens")
    manifest = tokenfiles.write_token_files(
        read(spark, folder, "documents"), place, path=public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    found = tokenfiles.read_token_files(spark, place).select(
        "file",
        "doc_id",
        "first",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return found.join(tokenfiles.file_starts(spark, place), "file").select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(read(spark, folder, "documents"))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return language.predict(docs, language_model(docs), doc_id="doc_id").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


@query("op6_probminhash")
def op6_probminhash(spark: SparkSession, folder: str) -> DataFrame:
    return probminhash.near_duplicates(read(spark, folder, "documents"))


# The rules of the contract.
URL_RULES = (
    urls.Rule("allow", "org/"),
    urls.Rule("block", "example.org/es/"),
    urls.Rule("block", "example.org/en/1"),
    urls.Rule("allow", "com/fr/"),
    urls.Rule("block", "com/de/"),
)


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(read(spark, folder, "pages"), URL_RULES, block_words=())


@query("op2_repeated_passages")
def op2_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeated_passages(read(spark, folder, "documents"))


@query("op8_hnsw_vectors")
def op8_hnsw_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(read(spark, folder, "embeddings"))


@query(
    "op11_bit_sliced_top_k",
    """
    WITH v AS (
        SELECT row_number() OVER () AS place, vec_id,
            list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
        FROM embeddings
        WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), s AS (
        SELECT a.place, a.vec_id AS query_id, b.vec_id,
            coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id
    ), r AS (
        SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id NULLS LAST) AS n FROM s
    )
    SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 10
    """,
)
def op11_bit_sliced_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings"))


@query("op12_importance_resampling")
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.importance(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(
        read(spark, folder, "documents"),
        path_a=public_tokenizers.path("byte_bpe_50k.json"),
        path_b=public_tokenizers.path("piece_bpe_32k.model"),
    )


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
