"""Checksums of parts, counts, weights and the draw against plain computations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retinue.llm import importance
from retinue.llm.queries import QUERIES

TABLE = "doc_id bigint, text string, row string, sums string, score int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def crcs(text, most):
    own = words(text)
    return [
        zlib.crc32(" ".join(own[i : i + n]).encode()) for n in range(1, most + 1) for i in range(len(own) - n + 1)
    ]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZ09 ._ßé日\x00\n~{`"), max_size=40), max_size=4), st.integers(1, 4))
def test_every_run_has_its_checksum(texts, most):
    scans = [importance.scan(text) for text in texts]
    counts = np.array([len(s) for _, s in scans], np.int64)
    lengths = np.array([n for own, _ in scans for n in own], np.int64)
    sums = np.array([n for _, own in scans for n in own], np.uint32)
    found = [[] for _ in texts]
    for run, owners in importance.features(sums, lengths, counts, most):
        for crc, owner in zip(run.tolist(), owners.tolist()):
            found[owner].append(crc)
    assert found == [crcs(text, most) for text in texts]


def test_shifts_over_long_parts():
    rng = random.Random(1)
    for length in (0, 1, 15, 16, 255, 4096, 70_001, 1 << 20):
        head, tail = rng.randbytes(50), rng.randbytes(length)
        moved = importance.shifted(np.array([zlib.crc32(head)], np.uint32), np.array([length]))
        assert int(moved[0]) ^ zlib.crc32(tail) == zlib.crc32(head + tail)


def plain(rows, target, most=1, buckets=10_000, least=20, percent=10, seed=2024):
    s = Counter(c % buckets for _, text in rows for c in crcs(text, most))
    t = Counter(c % buckets for text in target for c in crcs(text, most))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        gains = [
            math.floor(
                1000
                * math.log(
                    float(t[b] + 1) * float(all_s + buckets) / (float(s[b] + 1) * float(all_t + buckets))
                )
            )
            for b in (c % buckets for c in crcs(text, most))
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(gains), weight, score, None, len(words(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def run(spark, rows, target, **options):
    docs = spark.createDataFrame([(i, text, "a", "b", 0) for i, text in rows], TABLE)
    goal = spark.createDataFrame([(text,) for text in target], "text string")
    found = importance.importance(docs, goal, **options)
    return sorted([tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()], key=str)


@pytest.mark.parametrize("options", [{}, {"most_words": 3, "buckets": 97, "least_words": 5, "percent": 50}])
def test_weights_and_draw_by_brute_force(spark, options):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "日本", "a-b", "x_y"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 25, 80])))) for i in range(300)]
    rows += [(500 + i, rows[3][1]) for i in range(150)]  # copies
    rows += [(900, None), (901, ""), (None, "one two " * 30), (902, "long " * 20_000), (7, rows[7][1])]
    target = [" ".join(rng.choices(vocabulary[:20], k=30)) for _ in range(10)] + [None, ""]
    short = {{"most_words": "most", "least_words": "least"}.get(k, k): v for k, v in options.items()}
    assert run(spark, rows, target, **options) == plain(rows, target, **short)


def test_empty_tables(spark):
    assert run(spark, [], ["a b"]) == []
    assert run(spark, [(1, None)], []) == plain([(1, None)], [])
    rows = [(i, "some words " * 15) for i in range(40)]
    assert run(spark, rows, []) == plain(rows, [])


def test_drawn_documents_keep_their_columns(spark):
    rows = [(i, f"word{i} and more " * 10) for i in range(50)]
    docs = spark.createDataFrame([(i, text, "a", "b", i) for i, text in rows], TABLE)
    goal = spark.createDataFrame([("more",)], "text string")
    drawn = importance.resample(docs, goal, percent=20)
    assert drawn.columns == docs.columns
    want = {r[0] for r in plain(rows, ["more"], percent=20) if r[4]}
    assert {(r["doc_id"], r["text"], r["score"]) for r in drawn.collect()} == {
        (i, text, i) for i, text in rows if i in want
    }


def test_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("text").collect()]
    found = QUERIES["op12_importance_resampling"](spark, folder).collect()
    assert sorted(map(tuple, found), key=str) == plain(docs, target)
