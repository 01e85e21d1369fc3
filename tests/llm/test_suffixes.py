"""Repeated passages against all pairs of runs."""

import random

import numpy as np
import pytest

from retinue.llm import suffixes

TABLE = "doc_id bigint, text string, words string, node string, body int"


def runs(rows, least):
    """Covered words of each document: those in a run of ``least`` words that occurs elsewhere too."""
    places = {}
    texts = {i: (t or "").lower().split() for i, t in rows}
    for i, words in texts.items():
        for at in range(len(words) - least + 1):
            places.setdefault(tuple(words[at : at + least]), []).append((i, at))
    covered = {}
    for found in places.values():
        if len(found) > 1:
            for i, at in found:
                covered.setdefault(i, set()).update(range(at, at + least))
    return covered


def covered(rows):
    out = {}
    for r in rows:
        assert r.n_words == r.end - r.start >= 20
        out.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    return out


def test_minimisers_and_window_hashes():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 50, 300).astype(np.uint64)
    for width in (1, 2, 3, 7, 10, 31, 38):
        hashes = suffixes.window_hashes(words, width)
        assert len(hashes) == 300 - width + 1
        keys = [tuple(words[i : i + width]) for i in range(len(hashes))]
        assert len(set(hashes.tolist())) == len(set(keys))
    for window in (1, 2, 5, 13, 200):
        grams = rng.integers(0, 40, 200).astype(np.uint64)
        want = [i + int(np.argmin(grams[i : i + window])) for i in range(200 - window + 1)]
        assert suffixes.minimisers(grams, window).tolist() == want


def test_texts_side_by_side_have_the_suffixes_of_each_alone():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 2**32, rng.integers(50, 120)).astype(np.uint32) for _ in range(12)]
    sizes = np.array([len(t) for t in texts])
    text, *rest = suffixes.retained(np.concatenate(texts), sizes, 50, 10)
    for n, words in enumerate(texts):
        own, *alone = suffixes.retained(words, sizes[n : n + 1], 50, 10)
        assert len(own) and all((a[text == n] == b).all() for a, b in zip(rest, alone, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_by_brute_force(spark, seed):
    rng = random.Random(seed)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    passages = [prose(rng.randint(20, 60)) for _ in range(6)]
    texts = [prose(rng.randint(0, 80)) for _ in range(40)]
    for _ in range(60):
        parts = [prose(rng.randint(0, 30)) for _ in range(2)] + rng.sample(passages, rng.randint(1, 3))
        rng.shuffle(parts)
        texts.append(" \n".join(parts))
    base = prose(120)
    for _ in range(25):
        words = base.split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = prose(1)
        texts.append(" ".join(words).upper())
    half = prose(19)
    texts += [f"{prose(10)} {half} {prose(10)}" for _ in range(4)]  # one word too short
    texts += [f"{passages[0]} x y z {passages[0]}", None, "", "one", "same " * 100]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], TABLE).repartition(5)
    got = suffixes.repeated_passages(docs, least=20, gram=5).collect()
    found, want = covered(got), runs(rows, 20)
    assert set(found) == set(want)
    for i in want:
        assert found[i] <= want[i]
    missed = sum(len(want[i] - found[i]) for i in want)
    assert missed <= 0.002 * sum(map(len, want.values()))
    # Every passage has a first place, and no text that holds a copy of it all is a first place again.
    assert any(r.first for r in got) and not all(r.first for r in got)


def test_copies_and_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text) for i in (9, 4, 7)] + [(None, text), (20, None), (21, ""), (22, "a b")]
    rows += [(30, "q " + text), (30, "zz " * 3)]
    rows += [(40, "k " * 100_000)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], TABLE)
    got = {r.doc_id: r for r in suffixes.repeated_passages(docs).collect()}
    assert sorted(got) == [4, 7, 9, 30, 40]
    assert (got[4].start, got[4].end, got[4].first) == (0, 60, True)
    assert not got[7].first and not got[9].first
    assert got[30].n_words == 60
    assert got[40].other_id == 40 and got[40].n_words == 100_000
    assert suffixes.repeated_passages(docs.limit(0)).count() == 0


def test_a_passage_of_all_texts_makes_few_pairs(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"a{i} {passage} b{i}") for i in range(400)], "doc_id bigint, text string")
    words = docs.selectExpr("doc_id AS node", "transform(split(text, ' '), w -> hash(w)) AS words")
    found = suffixes.suffixes(words, 50, 10)
    pairs = suffixes.neighbours(found)
    assert pairs.count() <= found.count()
    got = suffixes.repeated_passages(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(400))
    assert {(r.start, r.end) for r in got} == {(1, 61)} and sum(r.first for r in got) == 1


def test_long_passages_around_a_run_of_all_texts(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    footer = prose(45)
    texts = [f"{prose(rng.randint(5, 40))} {footer} {prose(rng.randint(0, 40))}" for _ in range(400)]
    for _ in range(12):  # longer passages that hold the footer, each in two texts
        before, after = prose(rng.randint(0, 8)), prose(rng.randint(10, 15))
        texts += [f"{prose(20)} {before} {footer} {after} {prose(20)}" for _ in range(2)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = suffixes.repeated_passages(docs).collect()
    assert covered(got) == runs(rows, 50) and len(got) == 24


def test_adjoining_passages_keep_a_first_place_each(spark):
    p, q = (" ".join(f"{x}{i}" for i in range(60)) for x in "pq")
    texts = {1: f"a b {p} c", 2: f"{p} {q}", 3: f"d {q} e"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = suffixes.repeated_passages(docs).collect()
    assert sorted((r.doc_id, r.start, r.end, r.other_id, r.first) for r in got) == [
        (1, 2, 62, 2, True),
        (2, 0, 60, 1, False),
        (2, 60, 120, 3, True),
        (3, 1, 61, 2, False),
    ]


def test_partners_are_the_smallest_of_all_and_not_only_of_neighbours(spark):
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(55))
    docs = spark.createDataFrame(
        [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(9)) + f" {passage}") for i in range(1, 60)],
        "doc_id bigint, text string",
    )
    got = {r.doc_id: (r.other_id, r.first) for r in suffixes.repeated_passages(docs).collect()}
    assert got == {1: (2, True)} | {i: (1, False) for i in range(2, 60)}
