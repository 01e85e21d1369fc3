"""Passages that documents share, by a sparse suffix array over the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retinue.llm.frames import carried, words_of
from retinue.llm.tasks import list_pieces, spans
from retinue.operators.staging import settle

#: Words that are handled at a time.
PIECE_WORDS = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words, by doubling: few passes for any width."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    power, span = _mix(words.astype(np.uint64) + _STEP), 1
    done, have = None, 0
    while True:
        if width & span:
            n = len(words) - (have + span) + 1
            done = power[:n] if done is None else _mix(done[:n] * np.uint64(5) + power[have : have + n])
            have += span
        if have == width:
            return done
        n = len(power) - span
        power = _mix(power[:n] * np.uint64(3) + power[span : span + n])
        span *= 2


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """For each ``window`` neighbouring hashes the place of the smallest, the leftmost on a tie.

    Equal runs of grams have their minimisers at equal places, wherever they stand.
    """
    # By doubling the reach of (hash, place) pairs.
    value, place, reach = grams, np.arange(len(grams)), 1
    while reach < window:
        step = min(reach, window - reach)
        n = max(0, len(value) - step)
        later = value[step:] < value[:n]
        value, place = np.where(later, value[step:], value[:n]), np.where(later, place[step:], place[:n])
        reach += step
    return place


def retained(
    words: np.ndarray, sizes: np.ndarray, least: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of texts that lie side by side: text number, place, ``key`` and ``before``.

    All texts have ``least`` words or more. Windows over the seam of two texts are left out.
    """
    window = max(1, (least - gram) // 2)
    ahead = least - window + 1
    words = words.astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    heads = window_hashes(words, ahead)
    smallest = minimisers(window_hashes(words, gram), window)
    inside = spans(starts, sizes - gram - window + 2)
    places = np.unique(smallest[inside])
    text = np.searchsorted(starts, places, side="right") - 1
    fits = places + ahead <= (starts + sizes)[text]
    places, text = places[fits], text[fits]
    before = np.zeros(len(places), np.uint64)
    for k in range(1, 5):
        word = np.where(places - k >= starts[text], words[np.maximum(places - k, 0)], 0)
        before = (before << np.uint64(16)) | (word.astype(np.uint64) & np.uint64(0xFFFF))
    return text, places - starts[text], heads[places], before


def suffixes(texts: DataFrame, least: int, gram: int) -> DataFrame:
    """Suffixes at minimisers: ``key`` (hash of their first words), ``before`` and place.

    A run of ``least`` words has a minimiser among its first ``window`` words, so that at
    least ``least - window + 1`` words follow there. That many make the key. ``before``
    holds 16 bits of each of the four words ahead of the place, nearest first: by it,
    suffixes with the same key are sorted like the reversed texts before them.
    """

    def retain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in list_pieces(batches, "words", PIECE_WORDS):
            lists = piece.column("words")
            words = pc.list_flatten(lists).to_numpy().view(np.uint32)
            sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
            text, place, key, before = retained(words, sizes, least, gram)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(before.view(np.int64)),
                    pa.array(piece.column("node").to_numpy()[text]),
                    pa.array(place.astype(np.int32)),
                ],
                ["key", "before", "node", "place"],
            )

    return texts.mapInArrow(retain, "key bigint, before bigint, node bigint, place int")


def neighbours(found: DataFrame) -> DataFrame:
    """Suffixes that follow each other in the sorted array and share their key: ``a``, ``at_a``, ``b``, ``at_b``.

    Sorted in ranges of (key, before, node, place). The first and the last row of each
    range, two rows a task, are compared with those of the next range.
    """
    order = ["key", "before", "node", "place"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, place = (batch.column(c).to_numpy().astype(np.int64) for c in ("key", "node", "place"))
            if last is None:
                first = (key[0], node[0], place[0])
            else:
                key, node, place = (np.insert(c, 0, v) for c, v in zip((key, node, place), last, strict=True))
            last = (key[-1], node[-1], place[-1])
            same = np.flatnonzero((key[1:] == key[:-1]) & ((node[1:] != node[:-1]) | (place[1:] != place[:-1])))
            yield rows_of(node[same], place[same], node[same + 1], place[same + 1], None, None)
        if first is not None:
            ends = np.array([first, last], np.int64)
            yield rows_of(ends[:, 1], ends[:, 2], None, None, ends[:, 0], np.array([0, 1]) + 2 * partition)

    def rows_of(a, at_a, b, at_b, key, end) -> pa.RecordBatch:
        wide = lambda x: pa.nulls(len(a), pa.int64()) if x is None else pa.array(x.astype(np.int64))
        short = lambda x: pa.nulls(len(a), pa.int32()) if x is None else pa.array(x.astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [wide(a), short(at_a), wide(b), short(at_b), wide(key), wide(end)], ["a", "at_a", "b", "at_b", "key", "end"]
        )

    ranged = found.repartitionByRange(*order).sortWithinPartitions(*order)
    compared = settle(
        ranged.mapInArrow(compare, "a bigint, at_a int, b bigint, at_b int, key bigint, end bigint")
    )
    # Two rows for each range, in one task.
    ends = Window.orderBy("end")
    border = (
        compared.where("end IS NOT NULL")
        .select(
            "end",
            F.col("a").alias("b"),
            F.col("at_a").alias("at_b"),
            (F.lag("key").over(ends) == F.col("key")).alias("same"),
            F.lag("a").over(ends).alias("a"),
            F.lag("at_a").over(ends).alias("at_a"),
        )
        .where("same AND end % 2 = 0 AND (a <> b OR at_a <> at_b)")
    )
    columns = ["a", "at_a", "b", "at_b"]
    return compared.where("end IS NULL").select(*columns).unionByName(border.select(*columns))


def windows(pairs: DataFrame, texts: DataFrame, least: int, gram: int) -> DataFrame:
    """Runs of ``least`` words whose minimiser is a suffix with a neighbour: two hashes, ``node`` and ``start``.

    A run that occurs twice has the same key at its minimiser in both places, so all such
    runs are among these.
    """
    window = max(1, (least - gram) // 2)
    salt = np.uint64(0x5BD1E995)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in list_pieces(batches, "words", PIECE_WORDS):
            lists, places = piece.column("words"), piece.column("places")
            words = pc.list_flatten(lists).to_numpy().view(np.uint32).astype(np.uint64)
            sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
            starts = np.cumsum(sizes) - sizes
            marked = np.zeros(len(words), bool)
            marked[pc.list_flatten(places).to_numpy() + np.repeat(starts, pc.list_value_length(places).to_numpy())] = True
            begin = spans(starts, sizes - least + 1)
            begin = begin[marked[minimisers(window_hashes(words, gram), window)[begin]]]
            text = np.searchsorted(starts, begin, side="right") - 1
            # The second hash makes equal pairs of different runs improbable at any size.
            check = window_hashes(words ^ salt, least)[begin] >> np.uint64(33)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(window_hashes(words, least)[begin].view(np.int64)),
                    pa.array(check.astype(np.int32)),
                    pa.array(piece.column("node").to_numpy()[text]),
                    pa.array((begin - starts[text]).astype(np.int32)),
                ],
                ["hash", "check", "node", "start"],
            )

    both = pairs.selectExpr("a AS node", "at_a AS place").unionByName(pairs.selectExpr("b AS node", "at_b AS place"))
    placed = settle(both.groupBy("node").agg(F.collect_set("place").alias("places")))
    met = texts.join(placed, "node").select("node", "words", "places")
    return met.mapInArrow(cut, "hash bigint, check int, node bigint, start int")


def shared(found: DataFrame) -> DataFrame:
    """Of :func:`windows` those that occur twice: ``node``, ``start`` and the two smallest ids, ``lowest`` and ``second``.

    ``second`` is null where one text alone has the run. Sorted in ranges, whatever the
    number of texts that share a run. Runs that may go on in another range, the first and
    the last one of each, take the ids from a joined table with two rows a range; nothing
    of it passes through the driver.
    """
    order = ["hash", "check", "node", "start"]
    schema = "hash bigint, check int, node bigint, start int, lowest bigint, second bigint, n bigint"
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = [*order, "lowest", "second", "n"]

    def rows_of(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        arrays = [columns[c].cast(k) if c in columns else pa.nulls(size, k) for c, k in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[batch.column(c).to_numpy() for c in order] for batch in batches if batch.num_rows]
        if not parts:
            return
        value, check, node, start = (np.concatenate(c) for c in zip(*parts, strict=True))
        heads = np.flatnonzero((value[1:] != value[:-1]) | (check[1:] != check[:-1])) + 1
        heads = np.concatenate([[0], heads])
        sizes = np.diff(np.append(heads, len(value)))
        group = np.repeat(np.arange(len(heads)), sizes)
        lowest = node[heads]
        # The ids of a run are sorted: the first other one is the second smallest.
        at = np.minimum.reduceat(np.where(node != lowest[group], np.arange(len(node)), len(node)), heads)
        alone = at == len(node)
        second = node[np.minimum(at, len(node) - 1)]
        border = (group == 0) | (group == group[-1])
        inner = np.flatnonzero(~border & (sizes[group] > 1))
        own = group[inner]
        yield rows_of(
            node=pa.array(node[inner]),
            start=pa.array(start[inner]),
            lowest=pa.array(lowest[own]),
            second=pa.array(second[own], mask=alone[own]),
        )
        yield rows_of(**{c: pa.array(v[border]) for c, v in zip(order, (value, check, node, start), strict=True)})
        ends = np.unique([0, len(heads) - 1])
        yield rows_of(
            hash=pa.array(value[heads[ends]]),
            check=pa.array(check[heads[ends]]),
            lowest=pa.array(lowest[ends]),
            second=pa.array(second[ends], mask=alone[ends]),
            n=pa.array(sizes[ends]),
        )

    ranged = found.repartitionByRange(*order).sortWithinPartitions(*order)
    compared = settle(ranged.mapInArrow(compare, schema))
    ids = F.array_compact(F.flatten(F.collect_list(F.array("lowest", "second"))))
    ends = (
        compared.where("n IS NOT NULL")
        .groupBy("hash", "check")
        .agg(F.sum("n").alias("n"), F.array_sort(F.array_distinct(ids)).alias("ids"))
        .where("n > 1")
        .select("hash", "check", F.get("ids", F.lit(0)).alias("low"), F.get("ids", F.lit(1)).alias("next"))
    )
    # Rows inside a range have no hash and keep their ids: keys that match nothing spread them.
    # Spark sends ``ends`` to all tasks while it is small, and splits a run of many rows otherwise.
    spread = {
        "hash": F.coalesce("hash", F.xxhash64("node", "start")),
        "check": F.coalesce("check", F.lit(-1)),
    }
    return (
        compared.where("n IS NULL")
        .withColumns(spread)
        .join(settle(ends), ["hash", "check"], "left")
        .select("node", "start", F.coalesce("low", "lowest").alias("lowest"), F.coalesce("next", "second").alias("second"))
        .where("lowest IS NOT NULL")
    )


def united(found: DataFrame, least: int) -> DataFrame:
    """Runs of a text that overlap or touch and have one ``holder`` become one, with the smallest partner.

    The holder is the smallest id that has the run. Runs that different texts hold first
    stay apart, so that each word's first place is known.
    """
    none = np.iinfo(np.int64).max

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            node, start, other, holder = (batch.column(c).to_numpy() for c in ("node", "start", "other", "holder"))
            end = start + least
            other = np.where(other == node, none, other)
            if last is not None:
                columns = (node, start, end, other, holder)
                node, start, end, other, holder = (np.insert(c, 0, v) for c, v in zip(columns, last, strict=True))
            new = (node[1:] != node[:-1]) | (start[1:] > end[:-1]) | (holder[1:] != holder[:-1])
            heads = np.concatenate([[0], np.flatnonzero(new) + 1])
            tails = np.append(heads[1:], len(node)) - 1
            whole = (node[heads], start[heads], end[tails], np.minimum.reduceat(other, heads), holder[heads])
            last = tuple(c[-1] for c in whole)
            yield rows_of(*[c[:-1] for c in whole])
        if last is not None:
            yield rows_of(*[np.array([v]) for v in last])

    def rows_of(node, start, end, other, holder) -> pa.RecordBatch:
        other = np.where(other == none, node, other)
        start, end = start.astype(np.int32), end.astype(np.int32)
        columns = [pa.array(c) for c in (node, start, end, other, holder)]
        return pa.RecordBatch.from_arrays(columns, ["node", "start", "end", "other", "holder"])

    other = F.when(F.col("lowest") < F.col("node"), F.col("lowest")).otherwise(F.coalesce("second", "node"))
    placed = found.select("node", "start", other.alias("other"), F.col("lowest").alias("holder"))
    ordered = placed.repartition("node").sortWithinPartitions("node", "start")
    return ordered.mapInArrow(unite, "node bigint, start int, end int, other bigint, holder bigint")


def repeated_passages(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = 50, gram: int = 10
) -> DataFrame:
    """Runs of ``least`` words or more that a text shares with another place in the corpus.

    Words are compared in lower case. Returns one row per document and run: ``doc_id``,
    ``start`` and ``end`` (words, end excluded), ``n_words``, ``other_id`` (the smallest id
    of the texts that share a part of it; its own id where a run repeats within the text only)
    and ``first`` (no text with a smaller id has any part of it, so that a filter may keep
    the run here). Runs that overlap or touch are one if the same text is the first to hold
    them, and rows of their own otherwise, which may overlap. A filter that drops the rows
    that are not first leaves each run in one text. A copy is a run like any other.

    Null and shorter texts have no rows. Rows without an id are left out. Rows with the
    same id are one document: their texts, in order, one after the other. An empty table
    gives an empty result. One text, however long, is a row of a task, with a number for each
    of its words.

    1. Of all suffixes of all texts, those stay that begin at minimisers: ``gram`` words
       whose hash is the smallest among their neighbours. Equal passages keep equal places.
    2. They are sorted by the hash of their first words, then by the words before, then by
       text, in ranges: a passage that a third of all texts share spreads over many tasks.
    3. Suffixes whose neighbour in that order has the same first words are looked at
       closely: the runs of ``least`` words around them are sorted by their hash, again in
       ranges. Each run that occurs twice is found, with the smallest ids that have it,
       however many texts share it and whatever stands beside it.
    """
    rows = carried(docs, node=F.col(doc_id).cast("bigint"), body=F.col(text)).select("node", "body").dropna()
    again = settle(rows.groupBy("node").agg(F.count("*").alias("rows")).where("rows > 1").select("node"))
    joined = rows.join(again, "node", "left_semi").groupBy("node").agg(F.array_sort(F.collect_list("body")).alias("all"))
    whole = rows.join(again, "node", "left_anti").unionByName(joined.select("node", F.array_join("all", "\n").alias("body")))
    hashed = F.transform(words_of(F.lower("body")), lambda w: F.hash(w))
    texts = whole.select("node", hashed.alias("words")).where(F.size("words") >= least)
    pairs = neighbours(settle(suffixes(texts, least, gram)))
    spans = united(shared(settle(windows(pairs, texts, least, gram))), least)
    return spans.select(
        F.col("node").alias("doc_id"),
        "start",
        "end",
        (F.col("end") - F.col("start")).alias("n_words"),
        F.col("other").alias("other_id"),
        (F.col("holder") == F.col("node")).alias("first"),
    )
