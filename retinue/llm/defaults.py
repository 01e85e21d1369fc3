"""The operators with the settings that the queries and the pipeline share."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm import bpe, language


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the documents, by their id, that no language is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_model(docs: DataFrame) -> language.LanguageModel | None:
    return language.fit(docs.where(~held_out()), path=public_tokenizers.path("piece_bpe_32k.model"))


def bpe_digests(docs: DataFrame, block_bytes: int | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` and digests of the ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, path=path, pattern=public_tokenizers.PATTERN, block_bytes=block_bytes, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("content", 256).alias("decoded_sha256"),
    )
