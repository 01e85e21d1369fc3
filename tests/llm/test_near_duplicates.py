"""ProbMinHash classes, components and signatures against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from retinue.llm import probminhash
from retinue.llm.components import components

TABLE = "doc_id bigint, text string, words string, class_id string, row int"


def weighted(text, width=5):
    words = (text or "").lower().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def similarity(a, b):
    """The definition, term by term."""
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys())
    return total


def at_most(a, b):
    """Never below the similarity, and quick: each term of it is below both shares of the element."""
    x, y = sum(a.values()), sum(b.values())
    return sum(min(a[k] / x, b[k] / y) for k in a.keys() & b.keys())


def classes(rows, threshold=0.8):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = [(i, weighted(t)) for i, t in rows]
    for n, (i, a) in enumerate(bags):
        for j, b in bags[:n]:
            if a and b and at_most(a, b) >= threshold - 1e-9 and similarity(a, b) >= threshold - 1e-9:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i, _ in rows}


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, hot):
    rng = random.Random(seed)
    prose = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    passage = prose(60)
    texts = [prose(rng.randint(1, 200)) for _ in range(60)]
    texts += [f"{passage} {prose(rng.randint(5, 90))}" for _ in range(30)]
    base = prose(150)
    texts += [edited(rng, base, rng.randint(0, 9)) for _ in range(hot)]
    texts += [base] * 5 + [base.upper()] + [f"{passage}\n{passage}  {passage} x" for _ in range(3)]
    texts += [" ".join(["spam"] * n) for n in (1, 4, 5, 50, 400)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_similarity_is_the_definition():
    rng = random.Random(3)
    for _ in range(200):
        a = {rng.randrange(12): rng.randint(1, 4) for _ in range(rng.randint(0, 8))}
        b = {rng.randrange(12): rng.randint(1, 4) for _ in range(rng.randint(0, 8))}
        x, y = sorted(a.items()), sorted(b.items())
        got = probminhash.probability_jaccard(
            np.array([k for k, _ in x], np.uint64),
            np.array([v for _, v in x]),
            np.array([k for k, _ in y], np.uint64),
            np.array([v for _, v in y]),
        )
        assert got == pytest.approx(similarity(a, b))


def test_registers_agree_as_often_as_texts_are_similar():
    rng = random.Random(5)
    a = {i: rng.randint(1, 5) for i in range(60)}
    b = {i: rng.randint(1, 5) for i in range(15, 75)}
    text = np.repeat([0, 1], 60)
    value = np.array([*a, *b], np.uint64)
    count = np.array([*a.values(), *b.values()])
    holder = probminhash.signatures(text, value, count, 2, 20_000)
    assert (holder[0] == holder[1]).mean() == pytest.approx(similarity(a, b), abs=0.015)


def test_bounds_are_never_below_and_exact_for_equal_weights():
    rng = random.Random(11)
    for heaviest in (1, 1, 5):
        sets = [{rng.randrange(30): rng.randint(1, heaviest) for _ in range(rng.randint(1, 25))} for _ in range(40)]
        arrays = [(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)], "<u4")) for s in sets]
        others = arrays[1:]
        starts = np.concatenate([[0], np.cumsum([len(e) for e, _ in others])])
        bound = probminhash._bounds(
            *arrays[0], np.concatenate([e for e, _ in others]), np.concatenate([w for _, w in others]), starts
        )
        exact = [probminhash.probability_jaccard(*arrays[0], *other) for other in others]
        assert (bound >= np.array(exact) - 1e-12).all()
        if heaviest == 1:
            assert bound == pytest.approx(exact)


@pytest.mark.parametrize(("seed", "hot", "filtered"), [(1, 40, True), (2, 120, True), (2, 120, False)])
def test_classes_by_brute_force(spark, seed, hot, filtered):
    rows = corpus(seed, hot)
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], TABLE).repartition(4)
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(docs, filtered=filtered).collect()}
    assert got == classes(rows)


def test_blocks_find_the_links_the_leader_does_not(spark, monkeypatch):
    """With one register a band, texts of many classes share buckets; groups fill many blocks."""
    monkeypatch.setattr(probminhash, "BLOCK_TEXTS", 40)
    rows = corpus(7, 30)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(docs, bands=60, rows=1).collect()}
    assert got == classes(rows)


def test_a_group_below_the_threshold_makes_a_row_a_text_and_task(spark):
    """Texts that resemble each other, but not enough: nothing is united and no pair leaves a task."""
    rng = random.Random(9)
    base = " ".join(f"w{rng.randrange(400)}" for _ in range(150))
    rows = [(i, edited(rng, base, 7)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(docs).collect()}
    assert got == classes(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One\ttwo"), (6, "one two three"), (None, "one two"),
        (4, "one two"), (7, "a b c d e f g"), (8, "a b c d e f g"), (9, "a b c d e f g " * 50_000),
    ]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], TABLE)
    got = sorted(((r.doc_id or 0, r.class_id or 0, r.kept) for r in probminhash.near_duplicates(docs).collect()))
    assert got == [
        (0, 0, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (4, 4, True), (5, 4, False),
        (6, 6, True), (7, 7, True), (8, 7, False), (9, 9, True),
    ]
    assert probminhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_chain_a_hub_and_a_loop(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    hub = [(100, i) for i in range(101, 300)]
    loop = [(500, 501), (501, 502), (502, 500), (500, 500), (501, 500)]
    edges = spark.createDataFrame(chain + hub + loop, "a bigint, b bigint")
    got = {r.node: r.component for r in components(edges).collect()}
    want = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 300)} | {500: 500, 501: 500, 502: 500}
    assert got == want
