"""The bit-sliced index and its search against plain integer products."""

import math

import numpy as np
import pytest

from retinue.llm import topk

TABLE = "vec_id bigint, embedding array<double>, rank string, q string, group int"


def unpacked(total, rows):
    bits = np.unpackbits(total.view(np.uint8), axis=1, bitorder="little")[:, :rows].astype(np.int64)
    return (bits * (1 << np.arange(len(total)))[:, None]).sum(axis=0)


def test_digits_make_up_the_weight_and_no_two_are_neighbours():
    weights = np.array([0, 1, -1, 3, 7, -7, 1023, -1024, 365, -(2**40) + 5])
    found = topk.digits(weights)
    for n, weight in enumerate(weights.tolist()):
        own = [(p, s) for a, p, s in found if a == n]
        assert sum(s << p for p, s in own) == weight
        assert all(b - a > 1 for (a, _), (b, _) in zip(own, own[1:]))


@pytest.mark.parametrize("rows", [1, 63, 64, 65, 500])
@pytest.mark.parametrize("low", [0, 3])
def test_added_slices_are_the_weighted_sum(rows, low):
    rng = np.random.default_rng(rows)
    values = rng.integers(-900, 900, size=(rows, 7))
    block = topk.Block.build(values)
    assert (block.values(np.arange(rows)) == values).all()
    low = min(low, block.slices.shape[1] - 1)
    weights = np.array([0, 5, -17, 1023, -1024, 1, -1])
    total, constant = topk.add_slices(block, weights, low)
    high = (values - block.least) >> low
    assert (unpacked(total, rows) + constant == high @ weights).all()


def test_selection_from_the_top_slice_downward():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 40, size=(300, 1))
    block = topk.Block.build(values)
    total, _ = topk.add_slices(block, np.array([1]), 0)
    rows = np.full(block.slices.shape[2], 2**64 - 1, np.uint64)
    rows[-1] = (1 << (300 & 63)) - 1
    order = sorted((values[:, 0] - block.least[0]).tolist(), reverse=True)
    for k in (1, 2, 10, 299, 300):
        assert topk.kth_highest(total, rows, k) == order[k - 1]
    for least in (-5, 0, 1, 17, 39, 40, 64, 1000):
        found = topk._positions(topk.at_least(total, rows, least))
        assert found.tolist() == np.flatnonzero(values[:, 0] - block.least[0] >= least).tolist()


def brute(rows, k=10, scale=1024, every=100):
    kept = []
    for vec_id, x in rows:
        if x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        kept.append((vec_id, [math.floor(scale * c) for c in x]))
    out = []
    for query_id, q in kept:
        if query_id is None or query_id % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), n is None, n or 0, n) for n, v in kept if n != query_id]
        for rank, (score, _, _, vec_id) in enumerate(sorted(scored)[:k], 1):
            out.append((query_id, rank, vec_id, -score))
    return sorted(out, key=str)


def run(spark, rows, **options):
    data = [(vec_id, x, "a", "b", 1) for vec_id, x in rows]
    return sorted([tuple(r) for r in topk.top_k(spark.createDataFrame(data, TABLE), **options).collect()], key=str)


@pytest.mark.parametrize("low_bits", [0, 4, 9])
def test_top_k_by_brute_force(spark, monkeypatch, low_bits):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 70)
    monkeypatch.setattr(topk, "GROUP_ROWS", 200)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    rng = np.random.default_rng(low_bits)
    x = rng.normal(size=(700, 12))
    x[100:330] = x[99] + 0.01 * rng.normal(size=(230, 12))  # a third of all rows alike
    x[400:450] = x[400]  # copies: ties
    rows = list(zip(rng.permutation(700).tolist(), (x / np.linalg.norm(x, axis=1, keepdims=True)).tolist()))
    assert run(spark, rows, low_bits=low_bits) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, [0.5, -0.25]),
        (100, None),
        (200, [0.1, None]),
        (300, [float("nan"), 0.0]),
        (400, [float("inf"), 0.0]),
        (500, []),
        (600, [-1e-9, 70_000.0]),
        (None, [0.5, -0.25]),
        (7, [0.5, -0.25]),
        (7, [0.5, -0.25]),
        (8, [1.0]),
        (9, [0.0, 0.0, 3.0]),
    ]
    found = run(spark, rows)
    assert found == brute(rows)
    assert {r[0] for r in found} == {0, 500, 600}


def test_repeated_queries_answer_each(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [0.5]), (2, [-0.5])]
    assert run(spark, rows, k=1) == [(0, 1, 1, 512 * 1024)] * 2


def test_empty_tables_and_scores_beyond_62_bits(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []
    assert run(spark, [(100, [1.0])]) == []
    with pytest.raises(ValueError, match="too large"):
        run(spark, [(100, [3e6]), (1, [1.0])])
