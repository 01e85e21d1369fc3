"""Line dedup: lines that several documents share stay in one of them only."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm.frames import BLANKS, carried
from retinue.operators.staging import settle


def lowered(text: Column) -> Column:
    """A-Z in lower case. lower() agrees with this on ASCII and is much faster than translate()."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def key_hash(line: Column, min_chars: int) -> Column:
    """128 bits of a lowered line without blanks at its ends; null if shorter than ``min_chars``."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.char_length(bare) >= min_chars, F.unhex(F.md5(bare)))


def drop_repeated_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """Drop lines whose key occurs in ``min_docs`` documents or more, but for the first of these.

    Keys shorter than ``min_chars`` code points stay everywhere. The document with the
    smallest id keeps all its lines of a key. Returns one row per input row: ``doc_id``,
    ``n_lines`` (before), ``n_dropped``, ``kept`` (text of the remaining lines) and ``row``
    (the input row). Null or empty text is one empty line. Rows with the same id are one
    document to the rule and each is reassembled by itself. Rows without an id form one
    document too, which keeps a key only if no other document holds it. One text, however
    long, is a row of a task; its lines spread over tasks once they are exploded. An empty
    table gives an empty result.

    Lines are exploded once into (document, position, 128-bit hash of the key), in a
    written table; their text is never shuffled. A hash that a third of all lines share combines on the map side, first
    to one row per document, then to one row. The join that finds the lines to drop reads
    the repeated hashes from a written table, so that adaptive execution can split it.
    """
    rows = carried(docs, doc_id=doc_id, body=F.coalesce(F.col(text), F.lit(""))).withColumn(
        "body_hash", F.xxhash64("body")
    )
    hashes = F.transform(F.split(lowered(F.col("body")), "\n", -1), lambda line: key_hash(line, min_chars))
    lines = settle(
        rows.select("doc_id", "body_hash", F.posexplode(hashes).alias("position", "hash")).where("hash IS NOT NULL")
    )
    by_document = lines.select("hash", "doc_id").distinct()
    repeated = settle(
        by_document.groupBy("hash")
        .agg(F.count("*").alias("documents"), F.min("doc_id").alias("keeper"))
        .where(F.col("documents") >= min_docs)
        .select("hash", "keeper")
    )
    dropped = (
        lines.join(repeated, "hash")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "body_hash")
        # Rows that repeat both id and text give each position several times.
        .agg(F.collect_set("position").alias("gone"))
    )
    joined = rows.alias("r").join(
        dropped.alias("d"),
        F.col("r.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("r.body_hash") == F.col("d.body_hash")),
        "left",
    )
    pieces = joined.select(
        "r.doc_id", "r.row", "r.body", "d.gone", F.split("r.body", "\n", -1).alias("lines")
    ).withColumn("n_lines", F.size("lines").cast("bigint"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    untouched = F.col("gone").isNull()
    return pieces.withColumn("places", F.when(~untouched, places)).select(
        "doc_id",
        "n_lines",
        F.when(untouched, F.lit(0)).otherwise(F.size("gone")).cast("bigint").alias("n_dropped"),
        F.when(untouched, F.col("body"))
        .otherwise(F.array_join(F.transform("places", lambda i: F.col("lines")[i]), "\n"))
        .alias("kept"),
        "row",
    )
