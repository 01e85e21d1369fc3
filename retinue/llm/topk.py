"""Exact top-k inner products over a bit-sliced index of quantised vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retinue.llm.tasks import release
from retinue.operators.staging import settle

#: Rows of one block of the index: their bitmaps stay in a processor's cache.
BLOCK_ROWS = 16_384
#: Rows that one task of the search holds.
GROUP_ROWS = 262_144
#: Queries that travel together.
QUERY_ROWS = 512


@dataclass
class Block:
    """Some rows, attribute by attribute and bit by bit.

    An attribute is stored as its distance from its smallest value, so that all bits count
    upwards. ``slices[d, b]`` is the bitmap of bit b of attribute d, ``least[d]`` the value
    taken off.
    """

    least: np.ndarray
    slices: np.ndarray
    rows: int

    @classmethod
    def build(cls, values: np.ndarray) -> Block:
        """``values`` has a row for each vector."""
        rows, dims = values.shape
        least = values.min(axis=0) if rows else np.zeros(dims, np.int64)
        above = (values - least).T
        bits = max(1, int(above.max(initial=0)).bit_length())
        words = -(-rows // 64)
        slices = np.zeros((dims, bits, words), np.uint64)
        for bit in range(bits):
            packed = np.packbits(((above >> bit) & 1).astype(np.uint8), axis=1, bitorder="little")
            slices[:, bit].view(np.uint8)[:, : packed.shape[1]] = packed
        return cls(least, slices, rows)

    def values(self, rows: np.ndarray) -> np.ndarray:
        """The vectors of some rows, put together again from their bits."""
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        bits = (self.slices[:, :, word] >> bit) & np.uint64(1)
        weights = np.int64(1) << np.arange(self.slices.shape[1], dtype=np.int64)
        return (np.einsum("dbr,b->rd", bits.astype(np.int64), weights) + self.least).astype(np.int64)


def digits(weights: np.ndarray) -> list[tuple[int, int, int]]:
    """Attribute, power of two and sign of the few signed digits that make up each weight."""
    out = []
    for attribute, weight in enumerate(weights.tolist()):
        power = 0
        while weight:
            if weight & 1:
                sign = 2 - (weight & 3)  # 1 or -1, so that no two neighbours are both set
                out.append((attribute, power, sign))
                weight -= sign
            weight >>= 1
            power += 1
    return out


def add_slices(block: Block, weights: np.ndarray, low: int) -> tuple[np.ndarray, int]:
    """The weighted sum of all attributes without their lowest ``low`` bits, as bitmaps, and what to add to it.

    A digit adds an attribute's slices at its power of two; a negative one adds their
    complement, and takes the surplus off the constant. Bitmaps of one power are added three
    at a time: a full adder leaves one there and carries one to the next.
    """
    _, bits, words = block.slices.shape
    width = bits - low
    constant = 0
    columns: dict[int, list[tuple[np.ndarray, np.ndarray, int]]] = {}
    found = digits(weights)
    if found:
        attribute, power, sign = np.array(found).T
        constant = -int(sum(((1 << width) - 1) << p for p, s in zip(power.tolist(), sign.tolist()) if s < 0))
        for bit in range(width):
            for p in np.unique(power):
                columns.setdefault(int(p) + bit, []).append((attribute[power == p], sign[power == p], bit + low))
    total: list[np.ndarray] = []
    carried = np.empty((0, words), np.uint64)
    at = 0
    while at <= max(columns, default=-1) or len(carried):
        parts = [carried]
        for attribute, sign, bit in columns.get(at, []):
            taken = block.slices[attribute, bit]
            taken[sign < 0] ^= np.uint64(0xFFFFFFFFFFFFFFFF)
            parts.append(taken)
        maps = np.concatenate(parts)
        carries = []
        while len(maps) >= 3:
            third = len(maps) // 3
            a, b, c = maps[:third], maps[third : 2 * third], maps[2 * third : 3 * third]
            both = a ^ b
            carries.append((a & b) | (both & c))
            maps = np.concatenate([both ^ c, maps[3 * third :]])
        if len(maps) == 2:
            carries.append((maps[:1] & maps[1:]))
            maps = maps[:1] ^ maps[1:]
        total.append(maps[0] if len(maps) else np.zeros(words, np.uint64))
        carried = np.concatenate(carries) if carries else np.empty((0, words), np.uint64)
        at += 1
    return np.array(total).reshape(len(total), words), constant


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_highest(total: np.ndarray, rows: np.ndarray, k: int) -> int:
    """The k-th highest sum among ``rows`` (a bitmap of at least k rows), from the top slice downward."""
    equal, missing, value = rows, k, 0
    for bit in range(len(total) - 1, -1, -1):
        set_ = equal & total[bit]
        n = _count(set_)
        if n >= missing:
            equal, value = set_, value | (1 << bit)
        else:
            equal, missing = equal & ~total[bit], missing - n
    return value


def at_least(total: np.ndarray, rows: np.ndarray, value: int) -> np.ndarray:
    """The rows whose sum is not below ``value``, from the top slice downward."""
    if value <= 0:
        return rows
    if value >= 1 << len(total):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for bit in range(len(total) - 1, -1, -1):
        if value >> bit & 1:
            equal = equal & total[bit]
        else:
            above = above | (equal & total[bit])
            equal = equal & ~total[bit]
    return above | equal


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def search(block: Block, weights: np.ndarray, k: int, least: int | None, low: int, own: np.ndarray):
    """Rows of a block that may be among the k best, and their exact scores.

    ``least`` is a score that k other rows reach already, ``own`` rows to leave out. The
    slices above ``low`` give every row's score up to a known error. The k-th highest such
    sum bounds the k-th best score from below; only rows that could still reach it, those at
    the border and above, are put together again and scored exactly.
    """
    if not block.rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = min(low, block.slices.shape[1] - 1)
    total, constant = add_slices(block, weights, low)
    rows = np.full(block.slices.shape[2], 0xFFFFFFFFFFFFFFFF, np.uint64)
    if block.rows & 63:
        rows[-1] = (1 << (block.rows & 63)) - 1
    for row in own.tolist():
        rows[row >> 6] &= np.uint64(0xFFFFFFFFFFFFFFFF ^ (1 << (row & 63)))
    # score = (sum + constant) * 2**low + offset + what the low bits add
    plain = weights.tolist()
    offset = sum(w * v for w, v in zip(plain, block.least.tolist(), strict=True))
    most = ((1 << low) - 1) * sum(w for w in plain if w > 0)
    fewest = ((1 << low) - 1) * sum(w for w in plain if w < 0)
    bound = least
    if _count(rows) >= k:
        reached = ((kth_highest(total, rows, k) + constant) << low) + offset + fewest
        bound = reached if bound is None else max(bound, reached)
    if bound is not None:
        rows = at_least(total, rows, -((offset + most - bound) >> low) - constant)
    near = _positions(rows)
    if not len(near):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return near, block.values(near) @ weights


# --- the job -------------------------------------------------------------------------------


def quantised(vectors: DataFrame, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id`` and ``q``: whole numbers ``floor(scale * x)`` of the vectors without null or non-finite parts."""
    e = F.col(f"`{embedding}`")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    q = F.transform(e, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    return vectors.where(e.isNotNull() & finite).select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), q.alias("q"))


def _matrix(batch: pa.RecordBatch | pa.Table, dims: int) -> np.ndarray:
    """The vectors of a batch; shorter ones are filled with zeros."""
    out = np.zeros((batch.num_rows, dims), np.int64)
    lists = batch.column("q").combine_chunks() if isinstance(batch, pa.Table) else batch.column("q")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of ``rows`` rows each, the last one of fewer."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while batch.num_rows:
            some = batch.slice(0, rows - n)
            held.append(some)
            n += some.num_rows
            batch = batch.slice(some.num_rows)
            if n == rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


_ROWS = "kind int, place bigint, dims int, ids binary, known binary, body binary, least binary, bits int"


def _row(kind: int, place: int, ids: pa.ChunkedArray, body: np.ndarray, least: np.ndarray, bits: int, dims: int):
    known = np.asarray(ids.is_valid())
    values = [
        [kind], [place], [dims], [ids.fill_null(0).to_numpy().astype("<i8").tobytes()],
        [np.packbits(known).tobytes()], [body.tobytes()], [least.astype("<i8").tobytes()], [bits],
    ]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
    names = ["kind", "place", "dims", "ids", "known", "body", "least", "bits"]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)


def _ids(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.unpackbits(np.frombuffer(row["known"], np.uint8), count=len(ids)).astype(bool)


def index(vectors: DataFrame, groups: int, dims: int) -> DataFrame:
    """One row per block of vectors, dealt evenly to ``groups``: its slices and its ids in order, null last."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, table in enumerate(_runs(batches, BLOCK_ROWS)):
            table = table.sort_by("vec_id")
            block = Block.build(_matrix(table, dims))
            yield _row(0, place, table.column("vec_id"), block.slices, block.least, block.slices.shape[1], dims)
            release()

    dealt = vectors.repartition(groups)
    return dealt.mapInArrow(build, _ROWS).withColumn("group", F.spark_partition_id())


def query_blocks(queries: DataFrame, dims: int) -> DataFrame:
    """Queries side by side, ``QUERY_ROWS`` to a row; ``place`` is different for each row."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, QUERY_ROWS):
            yield _row(1, 0, table.column("vec_id"), _matrix(table, dims), np.empty(0, np.int64), 0, dims)

    return queries.mapInArrow(build, _ROWS).withColumn("place", F.monotonically_increasing_id())


def _blocks_of(rows: list[dict]) -> list[tuple[Block, np.ndarray, np.ndarray]]:
    out = []
    for row in rows:
        ids, known = _ids(row)
        least = np.frombuffer(row["least"], "<i8")
        words = -(-len(ids) // 64)
        slices = np.frombuffer(row["body"], np.uint64).reshape(len(least), row["bits"], words)
        out.append((Block(least, slices, len(ids)), ids, known))
    return out


def _answers(queries: dict, blocks, k: int, low: int) -> pa.RecordBatch:
    """The best rows of a group for each query of a row: at most k a query."""
    query_ids, _ = _ids(queries)
    weights = np.frombuffer(queries["body"], np.int64).reshape(len(query_ids), queries["dims"])
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    for number, (query_id, weight) in enumerate(zip(query_ids.tolist(), weights)):
        best: list[np.ndarray] = [np.empty(0, np.int64)] * 3  # score, whether the id is null, id
        for block, ids, known in blocks:
            least = int(best[0][-1]) if len(best[0]) == k else None
            # Ids are in order, nulls at the end.
            n = int(known.sum())
            start, end = np.searchsorted(ids[:n], [query_id, query_id + 1])
            near, scores = search(block, weight, k, least, low, np.arange(start, end))
            merged = [np.concatenate(p) for p in zip(best, (scores, (~known[near]).astype(np.int64), ids[near]))]
            order = np.lexsort((merged[2], merged[1], -merged[0]))[:k]
            best = [part[order] for part in merged]
        n = len(best[0])
        for column, part in zip(columns, (np.full(n, number), np.full(n, query_id), best[2], best[0], best[1])):
            column.append(part)
    flat = [np.concatenate(c) if c else np.empty(0, np.int64) for c in columns]
    ids = pa.array(flat[2], pa.int64(), mask=flat[4].astype(bool))
    arrays = [pa.array(np.full(len(flat[0]), queries["place"]), pa.int64()), *map(pa.array, flat[:2]), ids, pa.array(flat[3])]
    return pa.RecordBatch.from_arrays(arrays, ["place", "number", "query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame,
    *,
    k: int = 10,
    scale: int = 1024,
    every: int = 100,
    low_bits: int = 4,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of highest whole inner product for each row whose id is divisible by ``every``.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``. Components count as
    ``floor(scale * x)``; ties go to the smaller id. A row is no candidate for a query with
    its own id.

    The rows are dealt evenly to groups, each a task that holds the bit-sliced index of at
    most ``GROUP_ROWS`` rows and is passed all queries, block by block. A block of the index
    adds its slices above the lowest ``low_bits`` for a query, selects from the top slice
    downward, and scores rows at the border exactly. A group returns k rows a query; these
    are ranked by query. Work grows with queries times rows, as an exact search of every row
    must; memory does not grow with either.

    Vectors that are null or hold a null or non-finite part take no part. Shorter vectors
    count as filled with zeros. Rows without an id are candidates, last among equals. Repeated
    rows each count, as queries too. Fewer rows than k give fewer results; an empty table none.
    Scores must fit 62 bits: larger components stop the run. Other columns are not read.
    """
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    rows = settle(quantised(vectors, scale, vec_id, embedding))
    found = rows.agg(
        F.count("*"),
        F.max(F.size("q")),
        F.max(F.greatest(F.abs(F.coalesce(F.array_max("q"), F.lit(0))), F.abs(F.coalesce(F.array_min("q"), F.lit(0))))),
    ).first()
    n, dims, largest = found[0], found[1] or 0, found[2] or 0
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    if dims * int(largest) ** 2 >= 1 << 62:
        raise ValueError("components are too large: scores do not fit 62 bits")
    groups = ceil(n / GROUP_ROWS)
    slices = settle(index(rows, groups, dims))
    asked = settle(query_blocks(rows.where(F.col("vec_id") % every == 0), dims))
    every_group = asked.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, blocks = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != group:
                    group, held, blocks = row["group"], [], None
                if row["kind"] == 0:
                    held.append(row)
                    continue
                if blocks is None:
                    blocks, held = _blocks_of(held), []
                yield _answers(row, blocks, k, low_bits)

    columns = [c for c in slices.columns if c != "group"]
    met = slices.select("group", *columns).unionByName(every_group.select("group", *columns))
    by_group = met.repartitionById(groups, F.col("group")).sortWithinPartitions("group", "kind", "place")
    answers = by_group.mapInArrow(
        answer, "place bigint, number bigint, query_id bigint, vec_id bigint, score bigint"
    )
    best_first = Window.partitionBy("place", "number").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = answers.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
