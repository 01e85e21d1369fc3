"""Graphs and links of vectors against brute force."""

import numpy as np
import pytest

from retinue.llm import embeddings, hnsw
from retinue.llm.queries import QUERIES

TABLE = "vec_id bigint, embedding array<float>, label int, node string, vector int"


def brute(ids, vectors, least=0.9):
    x = np.asarray(vectors, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    component = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in np.argwhere(near):
            low = min(component[ids[a]], component[ids[b]])
            for i in (ids[a], ids[b]):
                if component[i] != low:
                    component[i], changed = low, True
    return {i: (int(near[n].sum()), component[i]) for n, i in enumerate(ids)}


def groups(rng, n, dims, sizes, spread):
    x = rng.normal(size=(n, dims))
    at = 0
    for size in sizes:
        x[at : at + size] = rng.normal(size=dims) + spread * rng.normal(size=(size, dims))
        at += size
    return x[rng.permutation(n)]


def test_graph_finds_what_brute_force_finds():
    rng = np.random.default_rng(3)
    x = groups(rng, 3000, 48, [2, 3, 40, 300, 900], 0.15)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    level = hnsw.levels(1 - rng.random(len(x)), 12)
    order = np.argsort(-level, kind="stable")
    x = x[order]
    graph = hnsw.build(x, level[order])
    hnsw.audit(graph, 0.9, 0.99, rng)
    graph = hnsw.Graph.frombytes(graph.tobytes())
    want = x @ x.T >= 0.9
    rows, ids = graph.within(x, 0.9, graph.beam)
    assert want[rows, ids].mean() > 0.999
    assert len(rows) >= 0.99 * want.sum()
    assert len(set(zip(rows.tolist(), ids.tolist(), strict=True))) == len(rows)


def test_small_graphs_hold_everything():
    for n in (1, 2, 5, 70):
        x = np.eye(80, dtype=np.float32)[:n]
        graph = hnsw.build(x, np.zeros(n, int))
        rows, ids = graph.within(x, 0.9, 80)
        assert sorted(zip(rows.tolist(), ids.tolist(), strict=True)) == [(i, i) for i in range(n)]


class Rounds:
    """Links of a graph that count how often a walk asks for them."""

    def __init__(self, links):
        self.links, self.count = links, 0

    def __len__(self):
        return len(self.links)

    def __getitem__(self, points):
        self.count += 1
        return self.links[points]

    def take(self, points, **kinds):
        self.count += 1
        return self.links.take(points, **kinds)


def dense_graph(rng, n, alike):
    x = groups(rng, n, 24, [alike], 0.1)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    level = hnsw.levels(1 - rng.random(n), 12)
    order = np.argsort(-level, kind="stable")
    return hnsw.build(x[order], level[order])


def test_wide_beams_take_few_rounds():
    graph = dense_graph(np.random.default_rng(5), 1500, 900)
    want = graph.vectors @ graph.vectors.T >= 0.9
    chosen = np.flatnonzero(want.sum(axis=1) > 800)[:8]
    graph.links[0] = rounds = Rounds(graph.links[0])
    rows, ids = graph.within(graph.vectors[chosen], 0.9, 64)
    assert set(zip(rows.tolist(), ids.tolist(), strict=True)) == set(zip(*(w.tolist() for w in np.nonzero(want[chosen])), strict=True))
    # Beams of 64, 256 and 1,024 places hold 900 close points.
    assert rounds.count < 200


def test_queries_of_all_blocks_widen_together(monkeypatch):
    graph = dense_graph(np.random.default_rng(6), 1000, 150)
    links = (graph.vectors @ graph.vectors.T >= 0.9).sum(axis=1)
    dense, lone = graph.vectors[np.argmax(links)], graph.vectors[np.flatnonzero(links == 1)[0]]
    queries = np.repeat(lone[None], 4 * hnsw.QUERIES, axis=0)
    queries[:: hnsw.QUERIES] = dense
    searched, search = [], hnsw.Graph.search
    monkeypatch.setattr(hnsw.Graph, "search", lambda g, q, beam: searched.append((len(q), beam)) or search(g, q, beam))
    rows, _ = graph.within(queries, 0.9, 64)
    assert searched == [(hnsw.QUERIES, 64)] * 4 + [(4, 256)]
    assert (np.bincount(rows) == np.where(np.arange(len(queries)) % hnsw.QUERIES, 1, links.max())).all()


def test_links_and_components_by_brute_force(spark):
    rng = np.random.default_rng(4)
    x = groups(rng, 400, 16, [2, 5, 30, 90], 0.12).astype(np.float32)
    rows = [(i * 3, v.tolist(), 0, None, None) for i, v in enumerate(x)]
    docs = spark.createDataFrame(rows, TABLE).repartition(4)
    got = {
        r.vec_id: (r.n_links, r.component_id)
        for r in embeddings.near_vectors(docs, shard_rows=150, least_shards=2, block_rows=200).collect()
    }
    assert got == brute([r[0] for r in rows], x)


def test_shards_meet_in_tasks_that_open_their_files(spark):
    rng = np.random.default_rng(9)
    rows = []
    for dims, n in ((6, 120), (9, 60), (3, 2)):
        x = groups(rng, n, dims, [8, 15][: n // 50], 0.05).astype(np.float32)
        rows.append(([len(rows) * 1000 + i for i in range(n)], x))
    table = [(i, v.tolist(), 0, None, None) for ids, x in rows for i, v in zip(ids, x, strict=True)]
    docs = spark.createDataFrame(table, TABLE).repartition(5)
    found = embeddings.near_vectors(docs, shard_rows=30, least_shards=3, block_rows=13)
    want = {i: w for ids, x in rows for i, w in brute(ids, x).items()}
    assert {r.vec_id: (r.n_links, r.component_id) for r in found.collect()} == want
    nodes = docs.selectExpr(
        "vec_id AS node", "1L AS copies", "CAST(embedding AS array<double>) AS vector", "size(embedding) AS dims", "0 AS shard"
    )
    shards = embeddings.graphs(nodes, 0.9, 0.99, 1, embeddings.new_folder(spark, "graphs"))
    # No graph is a value of a row.
    assert sorted(map(tuple, shards.collect())) == [(3, 0), (6, 0), (9, 0)]


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]),
        (8, [1.0, None]), (9, [inf, 0.0]), (10, [nan, 1.0]), (None, [1.0, 0.0]), (11, [1.0, 0.0, 0.0]),
        (12, [1e-38, 0.0]), (13, [-1.0, -0.0]), (14, [-1.0, 0.0]), (4, [0.0, 1.0]),
    ]
    docs = spark.createDataFrame([(i, v, None, None, None) for i, v in rows], TABLE)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embeddings.near_vectors(docs).collect())
    assert got == [
        (0, 0, 0, True), (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 1, 4, True), (4, 1, 4, True),
        (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True),
        (11, 0, 11, True), (12, 3, 1, False), (13, 1, 13, True), (14, 1, 13, False),
    ]
    assert embeddings.near_vectors(docs.limit(0)).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_recall_of_the_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    want = brute([r.vec_id for r in rows], [r.embedding for r in rows])
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op8_hnsw_vectors"](spark, folder).collect()}
    assert got.keys() == want.keys()
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)


def test_a_link_found_from_one_side_counts_for_both():
    rng = np.random.default_rng(7)
    shards = []
    for n, first in ((90, 0), (37, 1000)):
        x = groups(rng, n, 8, [10, 20], 0.1)
        x[:5] = np.eye(8)[:5]
        units = x / np.linalg.norm(x, axis=1, keepdims=True)
        graph = hnsw.build(units.astype(np.float32), np.zeros(n, int))
        shards.append(embeddings.Shard(graph, np.arange(first, first + n), np.ones(n, np.int64), units))
    a, b = shards
    there, back = a.found_in(b, 0.9, 32), b.found_in(a, 0.9, 32)
    want = set(zip(*(w.tolist() for w in np.nonzero(a.units @ b.units.T >= 0.9)), strict=True))
    assert len(want) >= 5
    blind = np.zeros_like(there), np.zeros_like(back)
    for found in ((there, back), (there, blind[1]), (blind[0], back)):
        pairs = [embeddings.linked_pairs(a, b, *found, i, i + 13, 0.9) for i in range(0, 90, 13)]
        got = [p for rows, points in pairs for p in zip(rows.tolist(), points.tolist(), strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_classes_grow_block_by_block():
    rng = np.random.default_rng(8)
    first, second = rng.integers(0, 200, (2, 150))
    label = np.arange(200)
    for i in range(0, 150, 7):
        label = embeddings.joined(label, first[i : i + 7], second[i : i + 7])
    assert (label == embeddings.lowest(first, second, np.arange(200))).all()
