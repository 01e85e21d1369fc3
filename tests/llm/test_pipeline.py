"""The pipeline's stages one after the other, each against plain Python on its own input."""

from collections import Counter

import corpus_pipeline as pipeline
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from retinue.llm import bpe
from test_documents import plain_lines
from test_near_duplicates import similarity, weighted


def run_stage(spark, name, docs):
    return dict(pipeline.STAGES)[name](spark, docs, None)


def test_stages_on_the_smallest_tables(spark):
    assert [name for name, _ in pipeline.STAGES] == [
        "language ID",
        "line dedup",
        "MinHash near-dedup",
        "mixing sources to target weights",
        "byte-level BPE encoding and decoding",
    ]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spare = spark.createDataFrame(
        [(10**6, None, "en", "s", None), (10**6 + 1, "12 !", "en", "s", 4), (None, "the and of it is", None, None, 1)],
        docs.schema,
    )
    docs = docs.unionByName(spare).withColumn("row", F.lit(1)).withColumn("kept", F.lit("x"))
    read, columns = docs, docs.columns
    frames = {}
    for name, stage in pipeline.STAGES:
        out = pipeline.settle(stage(spark, read, None))
        frames[name] = (read.collect(), out.collect())
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == columns and out.dtypes == docs.dtypes
        read = out

    before, after = frames["language ID"]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert {10**6, 10**6 + 1} <= gone and len(gone) <= 2 + 0.02 * len(before)

    before, after = frames["line dedup"]
    want = plain_lines([(r.doc_id, r.text) for r in before])
    assert Counter((r.doc_id, r.text) for r in after) == Counter({(k[0], k[3]): n for k, n in want.items()})
    assert all(r.n_chars == len(r.text) for r in after)

    before, after = frames["MinHash near-dedup"]
    left = {r.doc_id: weighted(r.text) for r in after}
    assert len(left) == len(after)
    for r in before:
        if r.doc_id not in left:
            # Whoever went has a similar text among those before.
            bag = weighted(r.text)
            assert any(o.doc_id != r.doc_id and similarity(bag, weighted(o.text)) >= 0.8 - 1e-9 for o in before)
    bags = [b for b in left.values() if b]
    for n, a in enumerate(bags):
        for b in bags[:n]:
            if a.keys() & b.keys():
                assert similarity(a, b) < 0.8

    before, after = frames["mixing sources to target weights"]
    copies = Counter(r.doc_id for r in after)
    assert set(copies) <= {r.doc_id for r in before} and max(copies.values()) <= 3
    assert {(r.doc_id, r.text) for r in after} <= {(r.doc_id, r.text) for r in before}

    before, after = frames["byte-level BPE encoding and decoding"]
    encoding = tiktoken.Encoding(
        "x",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    want = Counter((r.doc_id, len(encoding.encode_ordinary(r.text))) for r in before)
    assert Counter((r.doc_id, r.n_tokens) for r in after) == want


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d e f g"), (1, "other words of the same id"), (2, "A b c d e f g"), (None, "a b c d e f g"), (3, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = run_stage(spark, "MinHash near-dedup", docs).collect()
    assert Counter(r.doc_id for r in got) == Counter([1, None, 3])
    assert run_stage(spark, "MinHash near-dedup", docs.limit(0)).count() == 0


def test_an_empty_table_passes_all_stages(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        docs = pipeline.settle(stage(spark, docs, None))
    assert docs.count() == 0


def test_rows_with_the_same_id_leave_the_same_one_in_any_order(spark):
    rows = [(1, f"text {i} " + " ".join(f"w{i}_{k}" for k in range(20)), "en", "s", 1) for i in range(6)]
    rows += [(2, None, "en", "s", None), (2, None, "de", "s", None), (None, "a", "en", "s", 1), (None, "a", "en", "s", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    kept = []
    for given in (rows, rows[::-1]):
        docs = spark.createDataFrame(given, schema).repartition(3)
        kept.append(sorted(run_stage(spark, "MinHash near-dedup", docs).collect(), key=str))
    assert kept[0] == kept[1]
    assert [r.doc_id for r in kept[0]].count(1) == 1 and [r.doc_id for r in kept[0]].count(None) == 2
