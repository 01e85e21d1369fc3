"""Near-duplicate texts by ProbMinHash of weighted word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm.components import components
from retinue.llm.frames import carried, words_of
from retinue.llm.tasks import list_pieces, worker_memory
from retinue.operators.staging import settle

#: Words whose shingles are handled at a time.
PIECE_WORDS = 1 << 19
#: Texts of one block of an open group, and bytes of their shingles; a task holds two blocks.
BLOCK_TEXTS = 2048
BLOCK_BYTES = 16 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of texts given as word hashes side by side: text number, hash, count.

    A text with fewer than ``width`` words has one shingle of all its words, a text without
    words none. Sorted by text and hash.
    """
    words = words.astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    n = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(sizes)), n)
    first = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
    length = np.minimum(sizes, width)[text]
    value = length.astype(np.uint64)
    for k in range(width):
        inside = k < length
        at = np.where(inside, first + k, 0)
        part = _mix(words[at] + np.uint64(k + 1) * _GOLDEN) if len(words) else value
        value = np.where(inside, _mix(value * np.uint64(3) + part), value)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return text[at], value[at], np.diff(np.append(at, len(text)))


def signatures(text: np.ndarray, value: np.ndarray, count: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """ProbMinHash of each text: for each register the shingle that arrives there first.

    Each shingle is a Poisson process whose rate is its count; its arrivals go to random
    registers. Two texts agree in a register with their probability Jaccard similarity.
    All processes advance one arrival a round; a process ends when its arrival is later
    than every register of its text, which are all taken then.
    """
    taken = np.full((texts, registers), np.inf)
    holder = np.zeros((texts, registers), np.uint64)
    latest = np.full(texts, np.inf)
    text, value, rate = text, value, count.astype(float)
    time = np.zeros(len(text))
    arrival = 0
    while len(text):
        arrival += 1
        bits = _mix(value + np.array(arrival, np.uint64)[None] * _GOLDEN)
        uniform = ((bits >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)
        time = time - np.log(uniform) / rate
        alive = time < latest[text]
        text, value, rate, time, bits = text[alive], value[alive], rate[alive], time[alive], bits[alive]
        register = (_mix(bits + _GOLDEN) % np.uint64(registers)).astype(np.int64)
        place = text * registers + register
        np.minimum.at(taken.reshape(-1), place, time)
        first = taken.reshape(-1)[place] == time
        holder.reshape(-1)[place[first]] = value[first]
        touched = np.unique(text)
        latest[touched] = taken[touched].max(axis=1)
        alive = time < latest[text]
        if not alive.all():
            text, value, rate, time = text[alive], value[alive], rate[alive], time[alive]
    return holder


def band_keys(holder: np.ndarray, bands: int) -> np.ndarray:
    """One key per text and band, from the band's registers and its number."""
    rows = holder.shape[1] // bands
    keys = np.tile(_mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN), (len(holder), 1))
    for k in range(rows):
        keys = _mix(keys * np.uint64(3) + holder[:, k::rows][:, :bands])
    return keys.astype(np.int64)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Exact similarity of two weighted sets, given as sorted distinct elements and weights.

    Sum over shared i of 1 / sum over j of max(x_j / x_i, y_j / y_i). With equal weights it
    is the plain Jaccard similarity. Sorted by y_j / x_j, both parts of the inner sum are
    running sums.
    """
    if not len(a) or not len(b):
        return 0.0
    shared, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    x, y = x.astype(float), y.astype(float)
    own_x, own_y = x[at_a], y[at_b]
    only_x, only_y = x.sum() - own_x.sum(), y.sum() - own_y.sum()
    ratio = own_y / own_x
    order = np.argsort(ratio, kind="stable")
    ratio, own_x, own_y = ratio[order], own_x[order], own_y[order]
    below = only_x + np.cumsum(own_x)
    above = only_y + own_y.sum() - np.cumsum(own_y)
    return float((own_x / (below + above / ratio)).sum())


def _words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``words`` (32-bit hashes of lower-case words) and two hashes of their sequence."""
    rows = carried(docs, doc_id=F.col(doc_id), body=F.lower(F.coalesce(F.col(text), F.lit(""))))
    hashed = rows.select("doc_id", F.transform(words_of(F.col("body")), lambda w: F.hash(w)).alias("words"))
    return hashed.withColumns({"c1": F.xxhash64("words"), "c2": F.xxhash64(F.lit(1), "words")})


def _sized(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    words = batch.column("words")
    return pc.list_flatten(words).to_numpy().view(np.uint32), pc.list_value_length(words).to_numpy().astype(np.int64)


def signed(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``c1``, ``c2`` and the band ``keys`` (none for texts without words)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("probminhash")
        for piece in list_pieces(batches, "words", PIECE_WORDS):
            words, sizes = _sized(piece)
            text, value, count = shingles(words, sizes, width)
            keys = band_keys(signatures(text, value, count, len(sizes), bands * rows), bands)
            full = sizes > 0
            offsets = np.concatenate([[0], np.cumsum(np.where(full, bands, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel()))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("c1"), piece.column("c2"), lists], ["doc_id", "c1", "c2", "keys"]
            )

    return docs.mapInArrow(sign, "doc_id bigint, c1 bigint, c2 bigint, keys array<bigint>")


def profiles(docs: DataFrame, width: int, registers: int) -> DataFrame:
    """``node``, its weighted shingles as binary arrays of hashes and counts, and 8 bits of each register."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("probminhash")
        for piece in list_pieces(batches, "words", PIECE_WORDS):
            words, sizes = _sized(piece)
            text, value, count = shingles(words, sizes, width)
            holder = signatures(text, value, count, len(sizes), registers).astype(np.uint8).view(np.int8)
            offsets = np.arange(0, holder.size + 1, registers, dtype=np.int32)
            cuts = np.searchsorted(text, np.arange(len(sizes) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array([value[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array([count[i:j].astype("<u4").tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(holder.ravel())),
                ],
                ["node", "elements", "weights", "registers"],
            )

    return docs.mapInArrow(profile, "node bigint, elements binary, weights binary, registers array<tinyint>")


def verified(pairs: DataFrame, profile: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose exact similarity reaches the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("ae", "aw", "be", "bw")]
            found = []
            for n in range(batch.num_rows):
                ae, aw, be, bw = (c[n].as_buffer() for c in columns)
                similarity = probability_jaccard(
                    np.frombuffer(ae, np.uint64),
                    np.frombuffer(aw, "<u4"),
                    np.frombuffer(be, np.uint64),
                    np.frombuffer(bw, "<u4"),
                )
                # Sums of fractions may miss an exact limit by a rounding error.
                found.append(similarity >= threshold - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(
                pa.array(found, pa.bool_())
            )

    side = lambda n: profile.select(
        F.col("node").alias(n), F.col("elements").alias(f"{n}e"), F.col("weights").alias(f"{n}w")
    )
    return settle(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(compare, "a bigint, b bigint"))


def _bounds(elements: np.ndarray, weights: np.ndarray, others: np.ndarray, heavy: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """An upper bound of the similarity of one weighted set with several that lie side by side.

    In the inner sum of :func:`probability_jaccard` the shared elements count as the greater
    of the two sums over them, which is at most the sum of the greater ones. With equal
    weights the bound is the similarity itself.
    """
    x, y = weights.astype(float), heavy.astype(float)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    place = np.minimum(np.searchsorted(elements, others), len(elements) - 1)
    shared = elements[place] == others
    owner_, x_, y_ = owner[shared], x[place[shared]], y[shared]
    n = len(starts) - 1
    sum_x, sum_y = np.bincount(owner_, x_, n), np.bincount(owner_, y_, n)
    only_x, only_y = x.sum() - sum_x, np.bincount(owner, y, n) - sum_y
    inner = only_x[owner_] / x_ + only_y[owner_] / y_ + np.maximum(sum_x[owner_] / x_, sum_y[owner_] / y_)
    return np.bincount(owner_, 1 / inner, n)


def _united(rows: pa.Table, threshold: float, agreeing: float | None) -> dict[int, int]:
    """Classes that links between two blocks unite: each class with the smallest of its new one.

    Compared are texts of different classes that share a band and agree in ``agreeing``
    registers or more.
    """
    rows = rows.sort_by("node")
    get = lambda name: rows.column(name).combine_chunks()
    keys, registers = (get(c).flatten().to_numpy().reshape(rows.num_rows, -1) for c in ("keys", "registers"))
    lists = [np.frombuffer(e.as_buffer(), np.uint64) for e in get("elements")]
    heavy = [np.frombuffer(w.as_buffer(), "<u4") for w in get("weights")]
    block, lo, hi = (get(c).to_numpy() for c in ("block", "lo", "hi"))
    names, own = np.unique(get("component").to_numpy(), return_inverse=True)
    root = np.arange(len(names))

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    within = lo[0] == hi[0]
    for a in np.flatnonzero(block == lo[0]).tolist():
        near = own != own[a]
        near &= np.arange(len(own)) > a if within else block == hi[0]
        near[near] = (keys[near] == keys[a]).any(axis=1)
        if agreeing is not None:
            near[near] = (registers[near] == registers[a]).sum(axis=1) >= agreeing
        chosen = np.flatnonzero(near)
        if not len(chosen):
            continue
        starts = np.concatenate([[0], np.cumsum([len(lists[c]) for c in chosen])])
        others, weights = np.concatenate([lists[c] for c in chosen]), np.concatenate([heavy[c] for c in chosen])
        bound = _bounds(lists[a], heavy[a], others, weights, starts)
        for b in chosen[bound >= threshold - 1e-9].tolist():
            low, high = sorted((find(own[a]), find(own[b])))
            if low == high:
                continue
            if probability_jaccard(lists[a], heavy[a], lists[b], heavy[b]) >= threshold - 1e-9:
                root[high] = low
    return {int(names[c]): int(names[find(c)]) for c in range(len(names)) if find(c) != c}


def linked_classes(people: DataFrame, threshold: float, agreeing: float | None) -> DataFrame:
    """Links ``a``, ``b`` between classes whose texts are similar, at most one a class and task.

    ``people`` has the ``group``, ``node``, ``component`` (class), band ``keys``,
    ``registers``, ``elements`` and ``weights`` of texts. A group is dealt to blocks of
    bounded size; a task compares two blocks and returns united classes, never pairs of texts.
    """
    size = F.octet_length("elements") + F.octet_length("weights") + 1024
    per_group = people.groupBy("group").agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    dealt = people.join(per_group.select("group", blocks.alias("blocks")), "group").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    met = dealt.withColumn("other", F.explode(every)).withColumns(
        {"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}
    )

    def compare(rows: pa.Table) -> pa.Table:
        found = _united(rows, threshold, agreeing)
        return pa.table({"a": pa.array(list(found), pa.int64()), "b": pa.array(list(found.values()), pa.int64())})

    columns = ["group", "node", "component", "block", "keys", "registers", "elements", "weights", "lo", "hi"]
    return met.select(*columns).groupBy("group", "lo", "hi").applyInArrow(compare, "a bigint, b bigint")


def _rank(count: str, name: str) -> Column:
    """Orders by count, then by a hash of the name: one number, so that aggregates need no sort."""
    return F.col(count) * F.lit(1 << 20) + F.pmod(F.xxhash64(name), F.lit(1 << 20))


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    bands: int = 32,
    rows: int = 6,
    filtered: bool = True,
) -> DataFrame:
    """Classes of documents linked by a similarity of ``threshold`` or more.

    Similarity is the probability Jaccard of shingles of ``width`` words in lower case,
    weighted by their counts. Returns one row per input row: ``doc_id``, ``class_id`` (the
    smallest id of its class) and ``kept`` (it has that id).

    Null texts and texts without words link with nothing. A text with fewer than ``width``
    words is one shingle. Rows without an id have no class and stay. Rows with the same id
    are one document, in the class of all its texts. An empty table gives an empty result.

    1. Equal word sequences collapse into the one with the smallest id, by an aggregate.
    2. Of the others, those that share all ``rows`` registers of one of ``bands`` bands meet
       in a bucket. At similarity 0.8 a pair misses all 32 buckets with probability 0.00006.
    3. Each bucket compares its members with one leader only, the text that meets most others
       over all its buckets: the one that the others were made from, if it is there.
    4. Buckets whose members are not in one class then are open. Texts that open buckets
       connect form groups, and groups are compared block by block (:func:`linked_classes`):
       texts of different classes that share a band. So no link is lost, and no row is ever
       made for a pair of a group.

    With ``filtered`` texts that agree in so few registers as a pair at the threshold does
    with probability 0.000003 are not compared in step 4; without, all are. One text,
    however long, is a row of a task; ties between leaders go by a hash of the id.
    """
    words = _words(docs, doc_id, text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    table = settle(signed(words, width, bands, rows))
    texts = settle(
        table.where("doc_id IS NOT NULL AND size(keys) > 0")
        .groupBy("c1", "c2")
        .agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("keys").alias("keys"))
    )
    # Texts of one id belong together, whatever they are.
    again = table.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    owned = table.join(settle(again), "doc_id").join(texts, ["c1", "c2"]).select("doc_id", "node")
    same = settle(
        owned.where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct()
    )
    entries = texts.select("node", "copies", F.explode("keys").alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = settle(entries.join(settle(sizes), "key"))
    # A text in the middle of a group falls into the group's largest buckets in most bands.
    middle = shared.groupBy("node").agg(F.sum("members").alias("met"))
    central = settle(shared.join(middle, "node").select("key", "node", "met"))
    leaders = central.groupBy("key").agg(F.max_by("node", _rank("met", "node")).alias("leader"))
    buckets = settle(central.select("key", "node").join(settle(leaders), "key"))
    tried = settle(
        buckets.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    )
    nodes = tried.select(F.col("a").alias("doc_id")).union(tried.select("b")).distinct()
    # The same plan at every size: hashed words are too large to broadcast, ids may become so.
    involved = words.select("doc_id", "words").join(nodes.hint("merge"), "doc_id", "left_semi")
    profile = settle(profiles(involved, width, bands * rows))
    # Registers agree like coins with this chance; 4.5 standard deviations below their mean.
    agreeing = bands * rows * threshold - 4.5 * (bands * rows * threshold * (1 - threshold)) ** 0.5
    links = verified(tried, profile, threshold)
    found = components(links.unionByName(same))
    classed = settle(
        buckets.join(found, "node", "left").select(
            "key", "node", "leader", F.coalesce("component", "node").alias("component")
        )
    )
    several = classed.groupBy("key").agg((F.min("component") < F.max("component")).alias("open"))
    around = settle(classed.join(settle(several.where("open").select("key")), "key"))
    if not around.isEmpty():
        stars = around.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
        groups = components(stars).withColumnRenamed("component", "group")
        people = (
            around.select("node", "component")
            .distinct()
            .join(groups, "node")
            .join(profile, "node")
            .join(texts.select("node", "keys"), "node")
        )
        more = settle(linked_classes(settle(people), threshold, agreeing if filtered else None))
        known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(known.unionByName(more))
    # An id that is nobody's smallest has its class by its texts.
    classes = settle(
        texts.join(found, "node", "left").select("c1", "c2", F.coalesce("component", "node").alias("component"))
    )
    return (
        table.join(classes, ["c1", "c2"], "left")
        .withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
        .select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))
    )
