"""Importance resampling towards a target text, with features hashed from running checksums."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retinue.llm.frames import ROW, carried
from retinue.llm.tasks import pieces, worker_memory
from retinue.operators.staging import settle

#: Text handled at a time inside a task, in bytes.
PIECE_BYTES = 4 << 20
#: Words whose stored sums are handled at a time inside a task.
PIECE_WORDS = 1 << 20

# Fixed value: the polynomial of the usual 32-bit checksum, bits reversed.
_POLYNOMIAL = 0xEDB88320

# Bytes of a word stay, A-Z in lower case; all others become spaces.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


# --- checksums of parts ----------------------------------------------------------------


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Tables that shift a checksum over ``digit * 16**place`` bytes, and the one of a single byte.

    The first has the axes place, digit, byte of the sum, value of that byte: a shift is
    linear over GF(2), so the four bytes of a sum are shifted apart and added.
    """
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(_POLYNOMIAL), one >> 1)

    def apply(tables: np.ndarray, sums: np.ndarray) -> np.ndarray:
        out = np.zeros_like(sums)
        for byte in range(4):
            out ^= tables[byte][(sums >> np.uint32(8 * byte)) & np.uint32(255)]
        return out

    values = np.arange(256, dtype=np.uint32)
    step = np.stack([one, values, values << np.uint32(8), values << np.uint32(16)])
    shifts = np.empty((8, 16, 4, 256), np.uint32)
    for place in range(8):
        shifts[place, 0] = np.stack([values << np.uint32(8 * byte) for byte in range(4)])
        for digit in range(1, 16):
            shifts[place, digit] = apply(step, shifts[place, digit - 1])
        step = apply(step, shifts[place, 15])
    return shifts, one


def _tables() -> tuple[np.ndarray, np.ndarray]:
    memory = worker_memory("importance")
    if "checksum shifts" not in memory:
        memory["checksum shifts"] = _powers()
    return memory["checksum shifts"]


def shifted(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What each checksum becomes when as many bytes as ``lengths`` says follow, without their own part."""
    shifts, _ = _tables()
    sums, lengths = sums.astype(np.uint32), lengths.astype(np.int64)
    place = 0
    while len(lengths) and lengths.max() > 0:
        digit = lengths & 15
        out = np.zeros_like(sums)
        for byte in range(4):
            out ^= shifts[place, digit, byte, (sums >> np.uint32(8 * byte)) & np.uint32(255)]
        sums, lengths, place = out, lengths >> 4, place + 1
    return sums


def after_space(sums: np.ndarray) -> np.ndarray:
    """The checksums once a space follows."""
    _, one = _tables()
    state = ~sums.astype(np.uint32)
    return ~(one[(state ^ np.uint32(0x20)) & np.uint32(255)] ^ (state >> np.uint32(8)))


def scan(text: str | None) -> tuple[list[int], list[int]]:
    """One pass over a text: the length of each word in bytes, and the checksum up to its end.

    The sums run over the words joined by one space.
    """
    words = (text or "").encode().translate(_WORD_BYTES).split()
    if not words:
        return [], []
    joined = accumulate([b" " + word for word in words[1:]], lambda sum_, word: zlib.crc32(word, sum_), initial=zlib.crc32(words[0]))
    return list(map(len, words)), list(joined)


def features(sums: np.ndarray, lengths: np.ndarray, counts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Checksums of all runs of 1 to ``most`` words, and the document each lies in, by length of the run.

    ``counts`` are the documents' words. A run from word i to word j is what remains of the
    sum up to j when the sum before i, shifted over the run, is taken away.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    place = np.arange(len(sums)) - first
    # Byte offsets run on over the documents: only differences inside one are used.
    ends = np.cumsum(lengths + 1)
    starts = ends - 1 - lengths
    before = np.zeros(len(sums), np.uint32)
    before[1:] = after_space(sums[:-1])
    before[place == 0] = 0
    for run in range(1, most + 1):
        if len(sums) < run:
            return
        begin = np.flatnonzero(owner[run - 1 :] == owner[: len(owner) - run + 1])
        last = begin + run - 1
        span = ends[last] - 1 - starts[begin]
        yield sums[last] ^ shifted(before[begin], span), owner[begin]


# --- counts and weights ------------------------------------------------------------------


def running_sums(docs: DataFrame) -> DataFrame:
    """``text`` becomes ``counts``, ``lengths`` and ``sums``: what :func:`scan` finds, as bytes.

    All other columns stay. From here on no text is read again.
    """
    schema = docs.drop("body").schema
    names = schema.fieldNames()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "body", PIECE_BYTES):
            counts, lengths, sums = [], [], []
            for text in piece.column("body"):
                own_lengths, own_sums = scan(text.as_py())
                counts.append(len(own_sums))
                # One byte a word, or four where a word is longer.
                lengths.append(np.array(own_lengths, "u1" if max(own_lengths, default=0) < 256 else "<u4").tobytes())
                sums.append(np.array(own_sums, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    *[piece.column(c) for c in names],
                    pa.array(counts, pa.int64()),
                    pa.array(lengths, pa.binary()),
                    pa.array(sums, pa.binary()),
                ],
                [*names, "counts", "lengths", "sums"],
            )

    for name, kind in (("counts", "long"), ("lengths", "binary"), ("sums", "binary")):
        schema = schema.add(name, kind)
    return docs.mapInArrow(walk, schema)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for piece in pieces(batches, "sums", 4 * PIECE_WORDS):
        counts = piece.column("counts").to_numpy(zero_copy_only=False).astype(np.int64)
        sums = [np.frombuffer(part, "<u4") for part in piece.column("sums").to_pylist()]
        lengths = [
            np.frombuffer(part, "u1" if len(part) == n else "<u4").astype(np.int64)
            for part, n in zip(piece.column("lengths").to_pylist(), counts.tolist(), strict=True)
        ]
        yield piece, counts, np.concatenate(sums), np.concatenate(lengths)


def bucket_counts(sums: DataFrame, most: int, buckets: int) -> np.ndarray:
    """Features in each bucket over a whole table: at most ``buckets`` rows a task and on the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for _, counts, own, lengths in _unpacked(batches):
            for crcs, _ in features(own, lengths, counts, most):
                found += np.bincount(crcs % buckets, minlength=buckets)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], ["bucket", "n"])

    rows = sums.select("counts", "lengths", "sums").mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's smoothed log ratio of target to corpus, in thousandths, floored."""
    buckets, all_docs, all_target = len(docs), int(docs.sum()), int(target.sum())
    return np.array(
        [
            math.floor(
                1000
                * math.log(
                    (float(t + 1) * float(all_docs + buckets)) / (float(s + 1) * float(all_target + buckets))
                )
            )
            for s, t in zip(docs.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def _weighted(sums: DataFrame, gain: np.ndarray, most: int) -> DataFrame:
    schema = sums.drop("counts", "lengths", "sums").schema
    names = schema.fieldNames()
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, counts, own, lengths in _unpacked(batches):
            total = np.zeros(len(counts), np.int64)
            n = np.zeros(len(counts), np.int64)
            for run, (crcs, _) in enumerate(features(own, lengths, counts, most), 1):
                each = np.maximum(counts - run + 1, 0)
                bounds = np.concatenate([[0], np.cumsum(each)])
                so_far = np.concatenate([[0], np.cumsum(gain[crcs % buckets])])
                total += so_far[bounds[1:]] - so_far[bounds[:-1]]
                n += each
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in names], pa.array(counts), pa.array(n), pa.array(weight)],
                [*names, "n_words", "n_features", "weight"],
            )

    for name in ("n_words", "n_features", "weight"):
        schema = schema.add(name, "long")
    return sums.mapInArrow(weigh, schema)


# --- the draw ----------------------------------------------------------------------------


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise in thousandths, from a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def with_draw_rank(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """Add ``rank`` of the drawn rows: of N with enough words, the ``floor(percent * N / 100)`` highest scores.

    ``scored`` is read several times: pass a settled frame. Scores are whole thousandths of a
    logarithm and thus less than 2**18 different numbers, whatever the data: their counts fit
    one task, and give each score the number of rows above it. Rows of one score are few, as
    the noise spreads them, and are ordered by id.
    """
    able = F.col("n_words") >= least_words
    per_score = settle(scored.where(able).groupBy("score").agg(F.count("*").alias("_n")))
    drawn = (per_score.agg(F.sum("_n")).first()[0] or 0) * percent // 100
    above = F.coalesce(
        F.sum("_n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    high = settle(per_score.select("score", above.alias("_above")).where(F.col("_above") < drawn))
    joined = scored.join(high, "score", "left")
    of_score = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"))
    candidate = able & F.col("_above").isNotNull()
    rank = (F.col("_above") + F.row_number().over(of_score)).cast("bigint")
    ranked = joined.where(candidate).select(*scored.columns, rank.alias("rank"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    left = joined.where(~candidate).select(*scored.columns, F.lit(None).cast("bigint").alias("rank"))
    return ranked.unionByName(left)


def importance(
    docs: DataFrame,
    target: DataFrame,
    *,
    most_words: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Weigh documents by their likeness to ``target`` and draw the best by Gumbel noise.

    Returns one row per input row: ``doc_id``, ``n_words``, ``n_features``, ``weight``,
    ``score``, ``rank`` (null if not drawn), and the struct ``row`` of the columns ``carry``.

    A word is a run of letters outside ASCII, a-z, A-Z (lower-cased) and digits. Features are
    all runs of 1 to ``most_words`` words, joined by a space; a feature's bucket is its
    checksum modulo ``buckets``. Each text is read once and leaves running checksums at its
    word ends (four bytes a word, in a written table); both the corpus counts and the weights
    take every feature's checksum from two of them. Counts cover both tables whole. What goes
    to the driver is one number per bucket and per score.

    Null and empty texts have no features and weight 0. A null id hashes as an empty one. Rows
    with equal ids have equal noise; of equal scores the smaller id comes first, null last,
    and equal rows in any order. Empty tables give an empty result or, as a target, only
    smoothed counts. One text, however long, is one row of a task. Columns may have any name.
    """
    kept = docs.select(*[F.col(f"`{c}`") for c in carry]) if carry else None
    rows = carried(docs, doc_id=doc_id, body=text)
    if kept is None:
        rows = rows.drop(ROW)
    else:
        rows = rows.withColumn(ROW, F.struct(*[F.col(ROW)[c].alias(c) for c in carry]))
    sums = settle(running_sums(rows))
    goal = running_sums(target.select(F.col(f"`{text}`").alias("body")))
    gain = gains(bucket_counts(sums, most_words, buckets), bucket_counts(goal, most_words, buckets))
    scored = settle(
        _weighted(sums, gain, most_words).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    )
    return with_draw_rank(scored, least_words, percent)


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, with all their columns."""
    found = importance(docs, target, carry=docs.columns, **options)
    return found.where(F.col("rank").isNotNull()).select(*[F.col(ROW)[c].alias(c) for c in docs.columns])
