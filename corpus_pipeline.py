"""From raw documents to token ids: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.llm import language, lines, mixing, probminhash
from retinue.llm.defaults import bpe_digests, language_model
from retinue.llm.frames import read
from retinue.operators.staging import settle

#: Text of one block of the tokenizer: half of its default, as other stages leave executors less memory.
BLOCK_BYTES = 8 << 20
#: Texts whose language is less probable than this are rejected.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that have letters and a language that is more probable than all others together.

    Columns pass unchanged. Null and letterless texts go; repeated rows are judged alike.
    """
    names = {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    judged = language.predict(docs, language_model(docs), **names)
    clear = judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return clear.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the first of them.

    ``text`` becomes the text of the other lines and ``n_chars``, where there is such a
    column, its length. All documents stay, those without a line left with an empty text;
    null texts stay null.
    """
    kept = lines.drop_repeated_lines(docs)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept"))
    changed = {"text": text, "n_chars": F.coalesce(F.char_length(text).cast("bigint"), F.col("row.n_chars"))}
    columns = [
        changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col("row")[c].alias(c)
        for c in docs.columns
    ]
    return kept.select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one with the smallest id.

    Of rows with the same id one stays, the same in every run: the smallest by a hash of its
    text, then by all it holds. Rows without an id all stay.
    """
    classes = settle(probminhash.near_duplicates(docs))
    gone = classes.where("NOT kept").select("doc_id").distinct()
    again = settle(classes.where("kept").groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL"))
    left = docs.join(settle(gone), "doc_id", "left_anti").select(docs.columns)
    if again.isEmpty():
        return left
    once = left.join(again.select("doc_id"), "doc_id", "left_anti")
    several = left.join(again.select("doc_id"), "doc_id", "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    smallest = F.min_by(whole, F.struct(F.xxhash64("text"), "text", F.to_json(whole)))
    twice = several.groupBy("doc_id").agg(smallest.alias("_row")).select("_row.*")
    return once.unionByName(twice).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; rows of a source without words go."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes, one row per row of the mix."""
    return bpe_digests(docs, BLOCK_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokenize),
]

# The language model, the graph of near-duplicates and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
