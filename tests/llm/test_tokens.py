"""Tokenizers, blocks and codes against the libraries, text by text."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from retinue.llm import bpe, tokenfiles
from retinue.llm.defaults import bpe_digests
from retinue.llm.eliasfano import EliasFano
from retinue.llm.tasks import worker_memory

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "",
    " ",
    "  ",
    "a",
    " a  b ",
    "a\n b",
    "a \nb\t\tc",
    "it's IT'S it 's, we'll",
    "Ünï çöde ÀÉ ſtraße İstanbul ŉ",
    "é ́x ño",
    "a b   c d",
    "x\x1cy \x1d z\x85w",
    "日本語 テスト 한국어 ١٢٣ ½²",
    "<|endoftext|> <|startoftext|>x",
    "end. of!! it?!., a.b.c 3.14 1,000",
    "ΣΑΣ σας Σ. ΟΔΟΣ",
    "😀 a😀b ‍️",
    "\r\n\r\n a\r\n",
    "word " * 50,
]


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding(
        "x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={}
    )


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def block_ids(encoding, texts):
    tokens, codes, totals = bpe.cut_block(pa.array(texts, pa.string()), public_tokenizers.PATTERN)
    ids = [encoding.encode_ordinary(token) for token in tokens.to_pylist()]
    ends = np.cumsum(totals)
    return [
        [i for code in codes[end - n : end] for i in ids[code]] for end, n in zip(ends, totals, strict=True)
    ]


def test_blocks_give_the_ids_of_whole_texts(encoding):
    assert block_ids(encoding, ODD) == [encoding.encode_ordinary(text) for text in ODD]


ALPHABET = st.sampled_from(list("abAB'stl .,!\n\t\r\x0b\x1c\x85\xa0 éÉßſİı́日½²_-") + ["<|endoftext|>"])


def test_strings_of_special_tokens_are_those_tokens(tokenizer):
    texts = [
        "hello <|startoftext|> world", "x<|endoftext|>y", "<|EndOfText|> <|STARTOFTEXT|>", "plain. Text", "", "a <|startof",
    ]
    ids, lengths = tokenfiles.tokenize(pa.array(texts, pa.string()), WORDS)
    want = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert np.split(ids, np.cumsum(lengths)[:-1])[0].tolist() == want[0] and 49406 in want[0]
    assert lengths.tolist() == list(map(len, want)) and ids.tolist() == [i for own in want for i in own]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), min_size=1, max_size=5))
def test_random_texts(texts):
    e = tiktoken.Encoding(
        "x", pat_str=public_tokenizers.PATTERN, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={}
    )
    # Bytes as ids show the text, and the pieces must come one by one from the pattern.
    assert block_ids(e, texts) == [e.encode_ordinary(text) for text in texts]


def test_words_give_the_ids_of_whole_texts(tokenizer):
    ids, lengths = tokenfiles.tokenize(pa.array(ODD, pa.string()), WORDS)
    parts = np.split(ids, np.cumsum(lengths)[:-1])
    assert [p.tolist() for p in parts] == [tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]


def test_random_words(tokenizer):
    rng = random.Random(1)
    letters = list("abAB'stl .,!\n\t\r\x0b\x1c\x85\xa0 éÉßſİı́日½²ΣΑς") + ["<|endoftext|>"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(3000)]
    ids, lengths = tokenfiles.tokenize(pa.array(texts, pa.string()), WORDS)
    parts = np.split(ids, np.cumsum(lengths)[:-1])
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [p.tolist() for p in parts] == want


def test_words_of_every_letter_and_case(tokenizer):
    letters = [chr(c) for c in range(1, 0x400) if not 0xD800 <= c < 0xE000]
    texts = [a + b + "x" for a in letters[:0x250] for b in ("", "é", "Ž", "'s", "1")] + ["".join(letters)]
    ids, lengths = tokenfiles.tokenize(pa.array(texts, pa.string()), WORDS)
    own = np.split(ids, np.cumsum(lengths)[:-1])
    assert [o.tolist() for o in own] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_frequent_words_stay_where_rare_ones_are_forgotten(tokenizer, monkeypatch):
    monkeypatch.setattr(tokenfiles, "REMEMBERED", 40)
    tokenfiles.worker_memory("tokenfiles").clear()
    for n in range(12):
        texts = ["often met", f"rare{n} " * 3, *(f"w{n}x{k}" for k in range(15))]
        ids, lengths = tokenfiles.tokenize(pa.array(texts, pa.string()), WORDS)
        own = np.split(ids, np.cumsum(lengths)[:-1])
        assert [o.tolist() for o in own] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        words = tokenfiles.worker_memory("tokenfiles")["words", WORDS]
        assert "often" in words.places and len(words.places) < 80
    assert "rare0" not in words.places
    tokenfiles.worker_memory("tokenfiles").clear()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6) | st.integers(0, 3), max_size=700))
def test_elias_fano(gaps):
    numbers = np.cumsum(np.array(gaps, np.int64))
    code = EliasFano.of(numbers)
    back, end = EliasFano.frombuffer(b"ab" + code.tobytes(), 2)
    assert end == 2 + len(code.tobytes())
    assert back.all().tolist() == numbers.tolist()
    assert [back.select(i) for i in range(len(numbers))] == numbers.tolist()


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    assert len(EliasFano.of(ends).tobytes()) < 100_000 * 13 / 8


def test_token_file_answers_single_documents():
    ids = np.array([5, 1, 1, 70, 71, 1], np.uint32)
    buffer = tokenfiles.dump([None, -7, 9], np.array([2, 1, 3]), ids)
    file = tokenfiles.TokenFile(buffer)
    assert [file.doc_id(i) for i in range(len(file))] == [None, -7, 9]
    assert file.document(2).tolist() == [70, 71, 1]
    assert file.doc_ids().to_pylist() == [None, -7, 9]
    wide = tokenfiles.TokenFile(tokenfiles.dump([1], np.array([1]), np.array([1 << 20], np.uint32)))
    assert wide.document(0).tolist() == [1 << 20]


TABLE = "doc_id bigint, text string, body string, row string, file string"


def table(spark):
    rows = [(i, text, "b", "r", "f") for i, text in enumerate(ODD)]
    rows += [(None, "no id", None, None, None), (3, None, None, None, None), (5, ODD[5], "b", "r", "f")]
    rows += [(100, "very long text, " * 200_000, None, None, None)]
    return rows, spark.createDataFrame(rows, TABLE)


def test_byte_bpe_on_odd_rows(spark, encoding):
    rows, docs = table(spark)
    encoded = bpe.encode(docs, path=RANKS, pattern=public_tokenizers.PATTERN)
    got = sorted((str(r.doc_id), r.ids, bytes(r.content)) for r in bpe.decode(encoded, path=RANKS).collect())
    texts = [(str(r[0]), r[1] or "") for r in rows]
    assert got == sorted((i, encoding.encode_ordinary(t), t.encode()) for i, t in texts)
    assert bpe.decode(bpe.encode(docs.limit(0), path=RANKS, pattern="x"), path=RANKS).count() == 0


def test_byte_bpe_with_many_blocks(spark, encoding, monkeypatch):
    rows = [(i, f"text {i % 7} of{i % 3} words.\n\nNext") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 200)
    monkeypatch.setattr(bpe, "FLUSH_ROWS", 10)
    stored = docs.sparkSession.createDataFrame(docs.collect(), docs.schema)
    got = {r.doc_id: r.ids for r in bpe.encode(stored, path=RANKS, pattern=public_tokenizers.PATTERN).collect()}
    assert got == {i: encoding.encode_ordinary(t) for i, t in rows}


def test_ids_are_decoded_where_they_are_put_together(spark):
    rows, docs = table(spark)
    once = bpe.encode(docs, path=RANKS, pattern=public_tokenizers.PATTERN, decoded=True)
    again = bpe.decode(once.drop("content"), path=RANKS)
    seen = [sorted((str(r.doc_id), r.ids, bytes(r.content)) for r in found.collect()) for found in (once, again)]
    assert seen[0] == seen[1] and len(seen[0]) == len(rows)
    # One step in Python for each stage: two would hold twice the workers.
    plan = bpe_digests(docs)._jdf.queryExecution().sparkPlan().toString()
    last = plan[: plan.index("FlatMapCoGroupsInArrow")]
    assert "MapInArrow" not in last


def test_blocks_are_cut_without_what_another_operator_left():
    worker_memory("language")["model"] = "large"
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "body": ["some words"]})
    ((_, _, tokens, codes, totals),) = bpe._blocks(iter([batch]), public_tokenizers.PATTERN, True, 1000)
    assert (tokens.to_pylist(), codes.tolist(), totals.tolist()) == (["some", " words"], [0, 1], [2])
    assert "model" not in worker_memory("bpe")


def test_remembered_words_take_little_of_a_worker(tokenizer):
    tracemalloc.start()
    words = tokenfiles._Words(tokenizer, 4000)
    for start in range(0, 40_000, 2000):
        words.find([f"w{n}" for n in range(start, start + 2000)])
    # Those of the last time stay until as many new ones came.
    used = tracemalloc.get_traced_memory()[0] / 4000 * tokenfiles.REMEMBERED
    tracemalloc.stop()
    assert used < 100 << 20


def test_token_files_on_odd_rows(spark, tokenizer, tmp_path, monkeypatch):
    rows, docs = table(spark)
    monkeypatch.setattr(tokenfiles, "PIECE_BYTES", 60)
    place = str(tmp_path / "files")
    manifest = tokenfiles.write_token_files(docs, place, path=WORDS, most_ids=40)
    assert manifest.count() > 2
    found = tokenfiles.read_token_files(spark, place).join(manifest, "file").collect()
    got = {}
    for r in found:
        got.setdefault(str(r.doc_id), []).append((r.start + r.first, np.frombuffer(r.ids, "<u4").tolist()))
    position = 0
    in_order = sorted((v[0], i, v[1]) for i, part in got.items() for v in part)
    for start, _, ids in in_order:
        assert start == position and ids[-1] == 1
        position += len(ids)
    order = [None if i == "None" else int(i) for _, i, _ in in_order]
    assert order[0] is None and order[1:] == sorted(order[1:])
    want = {}
    for r in rows:
        want.setdefault(str(r[0]), []).append(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1])
    assert {i: sorted(v[1] for v in part) for i, part in got.items()} == {i: sorted(v) for i, v in want.items()}


def test_rows_of_the_executor_hold_no_whole_token_files(spark, tokenizer, tmp_path):
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(5)], "doc_id long, text string")
    place = f"file://{tmp_path}/out"
    manifest = tokenfiles.write_token_files(docs, place, path=WORDS)
    read = tokenfiles.read_token_files(spark, place)
    assert "content" not in read._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in read.collect()} == {
        n: [*tokenizer.encode(f"text {n}", add_special_tokens=False).ids, 1] for n in range(5)
    }
    starts = {r.file: r.start for r in tokenfiles.file_starts(spark, place).collect()}
    assert starts == {r.file: r.start for r in manifest.collect()}


def test_no_documents_give_no_files(spark, tmp_path):
    docs = spark.createDataFrame([], TABLE)
    assert tokenfiles.write_token_files(docs, str(tmp_path / "none"), path=WORDS).count() == 0


def test_queries_on_the_small_tables(spark, encoding, tokenizer):
    from retinue.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {r.doc_id: r for r in QUERIES["op9_byte_bpe"](spark, folder).collect()}
    files = {r.doc_id: r for r in QUERIES["op1_token_files"](spark, folder).collect()}
    assert len(got) == len(files) == len(docs)
    start = 0
    for d in docs:
        ids = encoding.encode_ordinary(d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(d.text.encode())
        words = [*tokenizer.encode(d.text, add_special_tokens=False).ids, 1]
        f = files[d.doc_id]
        assert (f.start, f.n_tokens) == (start, len(words))
        assert f.ids_crc32 == zlib.crc32(np.array(words, "<u4").tobytes())
        start += len(words)
