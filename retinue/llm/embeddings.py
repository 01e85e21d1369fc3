"""Near-duplicate vectors by navigable small-world graphs, one for each shard."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm.components import components
from retinue.llm.frames import carried
from retinue.llm.hnsw import Graph, audit, build, levels
from retinue.llm.tasks import shrink
from retinue.llm.tokenfiles import _store
from retinue.operators.staging import settle
from retinue.session import new_folder

#: How far single precision may be off; pairs are verified in double precision.
SLACK = 1e-4
#: Pairs that are verified at a time.
PAIRS = 1 << 16
#: Tasks in which shards meet, at most.
TASKS = 10_000


def _usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(flat: np.ndarray, dims: int) -> np.ndarray:
    vectors = flat.reshape(-1, dims)
    # Without the largest component, squares of very large or small ones would be lost.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _flat(table: pa.Table) -> np.ndarray:
    return pa.concat_arrays([c.flatten() for c in table.column("vector").chunks]).to_numpy(zero_copy_only=False)


def lowest(first: np.ndarray, second: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Smallest name that each of some nodes reaches by the links between ``first`` and ``second``."""
    label = names.copy()
    while True:
        low = np.minimum(label[first], label[second])
        after = label.copy()
        np.minimum.at(after, first, low)
        np.minimum.at(after, second, low)
        if (after == label).all():
            return label
        label = after


def joined(label: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Labels after linking: each is the smallest node of its class, before and after."""
    a, b = label[first], label[second]
    edges = np.unique(np.stack([a, b])[:, a != b], axis=1)
    return lowest(edges[0], edges[1], np.arange(len(label)))[label]


def _name(dims: int, shard: int) -> str:
    return f"{dims}-{shard}.arrow"


@dataclass
class Shard:
    """A graph with ids, numbers of copies and unit vectors in double precision, all in the graph's order."""

    graph: Graph
    ids: np.ndarray
    copies: np.ndarray
    units: np.ndarray

    @classmethod
    def read(cls, folder: str, dims: int, shard: int) -> Shard:
        store, place = _store(folder)
        with store.open_input_file(f"{place}/{_name(dims, shard)}") as file:
            (row,) = pa.ipc.open_file(file).read_all().to_pylist()
        ids, copies = (np.frombuffer(row[c], "<i8") for c in ("ids", "copies"))
        return cls(Graph.frombytes(row["graph"]), ids, copies, np.frombuffer(row["units"], "<f8").reshape(-1, dims))

    def write(self, folder: str, dims: int, shard: int) -> None:
        """Aside first and then renamed: a task that runs twice leaves the same file."""
        row = {
            "graph": self.graph.tobytes(),
            "ids": self.ids.astype("<i8").tobytes(),
            "copies": self.copies.astype("<i8").tobytes(),
            "units": self.units.astype("<f8").tobytes(),
        }
        store, place = _store(folder)
        store.create_dir(place, recursive=True)
        aside = f"{place}/.{_name(dims, shard)}.{TaskContext.get().taskAttemptId()}"
        table = pa.table({name: pa.array([value], pa.binary()) for name, value in row.items()})
        with store.open_output_stream(aside) as file, pa.ipc.new_file(file, table.schema) as out:
            out.write_table(table)
        store.move(aside, f"{place}/{_name(dims, shard)}")

    def found_in(self, other: Shard, least: float, block_rows: int) -> np.ndarray:
        """A row of bits for each vector: which of the other shard's vectors its search finds."""
        bits = np.zeros((len(self.ids), -(-len(other.ids) // 8)), np.uint8)
        for rows, points in other.graph.finds(self.units.astype(np.float32), least, other.graph.beam):
            starts = np.flatnonzero(np.diff(rows, prepend=-1))
            for own in (starts[i : i + block_rows + 1] for i in range(0, len(starts), block_rows)):
                end = own[block_rows] if len(own) > block_rows else len(rows)
                own = own[:block_rows]
                found = np.zeros((len(own), len(other.ids)), bool)
                found[np.repeat(np.arange(len(own)), np.diff(own, append=end)), points[own[0] : end]] = True
                bits[rows[own]] = np.packbits(found, axis=1)
        return bits


def linked_pairs(
    a: Shard, b: Shard, there: np.ndarray, back: np.ndarray, first: int, end: int, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows ``first`` to ``end`` of ``a`` with rows of ``b`` found from either side, verified in double precision."""
    end = min(end, len(a.ids))
    start = first // 8 * 8
    part = back[:, first // 8 : -(-end // 8)]
    some = np.flatnonzero(part.any(axis=1))
    bits = np.unpackbits(part[some], axis=1)[:, first - start : end - start].astype(bool)
    # Most vectors have no link: only rows that any search found.
    own = np.flatnonzero(there[first:end].any(axis=1) | bits.any(axis=0))
    found = np.unpackbits(there[first + own], axis=1, count=len(b.ids)).astype(bool)
    found[:, some] |= bits[:, own].T
    rows, points = np.nonzero(found)
    rows = first + own[rows]
    good = np.empty(len(rows), bool)
    for i in range(0, len(rows), PAIRS):
        part = slice(i, i + PAIRS)
        good[part] = np.einsum("nd,nd->n", a.units[rows[part]], b.units[points[part]]) >= least
    return rows[good], points[good]


def graphs(nodes: DataFrame, least: float, target: float, n_shards: int, folder: str) -> DataFrame:
    """One audited graph for each ``dims`` and ``shard`` of ``nodes``, a file of ``folder``; returns what there is."""

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        dims, shard = (k.as_py() for k in key)
        table = table.sort_by("node")
        rng = np.random.default_rng([dims, shard])
        units = _units(_flat(table), dims)
        level = levels(1 - rng.random(len(units)), 12)
        order = np.argsort(-level, kind="stable")
        graph = build(units[order].astype(np.float32), level[order])
        audit(graph, least, target, rng)
        ids, copies = (table.column(c).to_numpy()[order] for c in ("node", "copies"))
        Shard(graph, ids, copies, units[order]).write(folder, dims, shard)
        return pa.table({"dims": pa.array([dims], pa.int32()), "shard": pa.array([shard], pa.int32())})

    # Each shard in a task of its own.
    apart = nodes.select("dims", "shard", "node", "copies", "vector").repartitionById(n_shards, F.col("shard"))
    return apart.groupBy("dims", "shard").applyInArrow(grow, "dims int, shard int")


def found_links(shards: DataFrame, folder: str, least: float, block_rows: int) -> DataFrame:
    """All vectors of two shards against each other: ``node``, ``links`` between them, ``low`` (smallest node reached).

    A task opens the files of two shards, or of one against itself. The vectors of each are
    looked up in the graph of the other, and a pair found from either side is one link of
    both. What was found is a bit for each pair, so that memory is bounded by the shards
    however many vectors are alike. A task returns a row for each vector that has a link,
    never a row per pair.
    """
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])

    def meet(dims: int, low: int, high: int) -> pa.RecordBatch:
        a = Shard.read(folder, dims, low)
        b = a if low == high else Shard.read(folder, dims, high)
        there = a.found_in(b, least - SLACK, block_rows)
        back = there if low == high else b.found_in(a, least - SLACK, block_rows)
        ids = a.ids if low == high else np.concatenate([a.ids, b.ids])
        names, place = np.unique(ids, return_inverse=True)
        place_a, place_b = place[: len(a.ids)], place[len(place) - len(b.ids) :]
        links, label = np.zeros(len(names), np.int64), np.arange(len(names))
        for first in range(0, len(a.ids), block_rows):
            rows, points = linked_pairs(a, b, there, back, first, first + block_rows, least)
            if low == high:
                apart = rows != points
                rows, points = rows[apart], points[apart]
            else:
                np.add.at(links, place_b[points], a.copies[rows])
            np.add.at(links, place_a[rows], b.copies[points])
            if len(rows):
                label = joined(label, place_a[rows], place_b[points])
        some = np.flatnonzero(links)
        return pa.record_batch([pa.array(names[some]), pa.array(links[some]), pa.array(names[label[some]])], schema=schema)

    def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            yield meet(row["dims"], row["low_shard"], row["high_shard"])
        shrink()

    low, high = (shards.select("dims", F.col("shard").alias(c)) for c in ("low_shard", "high_shard"))
    both = settle(low.join(high, "dims").where("low_shard <= high_shard").coalesce(1))
    dealt = both.coalesce(1).repartition(min(max(1, both.count()), TASKS))
    return dealt.mapInArrow(meetings, "node bigint, links bigint, low bigint")


def near_vectors(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    least: float = 0.9,
    target: float = 0.99,
    shard_rows: int = 20_000,
    least_shards: int = 8,
    block_rows: int = 256,
) -> DataFrame:
    """Link vectors with a cosine of ``least`` or more, and take connected components.

    Returns one row per input row: ``vec_id``, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable, its own included) and ``kept`` (it has that id).
    Vectors that are null, empty, zero or hold a null or a component that is not finite link
    with nothing, as do rows without an id, and vectors of different lengths. Rows with the
    same id are one node. An empty table gives an empty result.

    Equal vectors collapse first and are counted. The others are dealt to shards of about
    ``shard_rows`` (``least_shards`` at least, for parallel work) by a hash of their id. Each
    shard's graph is audited against brute force over the shard: its beam widens until a
    share ``target`` of the links of the probes is found. Every vector is then looked up in
    every shard, with a beam that widens while all it holds is close, ``block_rows`` vectors
    at a time. Two shards meet in one task, so that a link found from either side counts for
    both. Found pairs are verified in double precision: a pair can be missed, none is linked
    wrongly; see the README for recall.
    """
    rows = carried(vectors, vec_id=F.col(vec_id).cast("bigint"), given=F.col(embedding).cast("array<double>")).drop("row")
    # Adding 0 makes -0 and 0 the same.
    clean = rows.withColumn(
        "vector", F.when(F.col("vec_id").isNotNull() & _usable(F.col("given")), F.transform("given", lambda x: x + 0.0))
    ).select("vec_id", "vector", F.xxhash64("vector").alias("c1"), F.xxhash64(F.lit(1), "vector").alias("c2"))
    table = settle(clean.select("vec_id", "c1", "c2", F.col("vector").isNotNull().alias("usable")))
    nodes = settle(
        clean.where("vector IS NOT NULL")
        .groupBy("c1", "c2")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("dims", F.size("vector"))
    )
    n = nodes.count()
    n_shards = max(least_shards, -(-n // shard_rows))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(n_shards)).cast("int"))
    folder = new_folder(vectors.sparkSession, "graphs")
    shards = settle(graphs(dealt, least, target, n_shards, folder))
    found = settle(found_links(shards, folder, least, block_rows))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")))
    known = settle(
        nodes.select("c1", "c2", "node", "copies")
        .join(linked, "node", "left")
        .join(classes, "node", "left")
        .select(
            "c1",
            "c2",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    usable = table.where("usable").join(known, ["c1", "c2"])
    apart = table.where("NOT usable").select(
        "vec_id", F.lit(0).cast("bigint").alias("links"), F.col("vec_id").alias("component")
    )
    return usable.select("vec_id", "links", "component").unionByName(apart).select(
        "vec_id",
        F.col("links").alias("n_links"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"),
    )
