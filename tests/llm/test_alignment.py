"""Alignment of two tokenizers against the plain definition on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from retinue.llm import alignment
from retinue.llm.queries import QUERIES

PATHS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
TABLE = "doc_id bigint, text string, block string, pair int"

ODD = [
    None,
    "",
    " ",
    "   ",
    " a",
    "a ",
    "a  b",
    "  two  spaces ",
    "tab\tand\nlines\n\n here \n x",
    "naïve café — “quoted”… it's they'll",
    "日本語のテキスト と 空白",
    "смешанный текст 123,456.78 €",
    "emoji 👩‍👩‍👧 ok 🇩🇪",
    "hidden ▁ space x▁y",
    "<|endoftext|> and <s> </s> <unk> <0x41> text",
    "no break wide     ᠎ ​\u0085x \x1c y",
    "\x00 nul \x00\x00",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20,
    "ＦＵＬＬ ﬁ ligature é",
    "\r\n windows \r\n lines",
]


@pytest.fixture(scope="module")
def own():
    return alignment.Tokenizers(*PATHS)


def plain_tokens(text):
    """Token bytes and ids of both sides, straight from the libraries."""
    a, b = plain_tokens.both
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    letters = alignment._byte_letters()
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a if i != 50256]
    bytes_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in ids_b
    ]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    return [list(zip(x, map(len, y))) for x, y in ((ids_a, bytes_a), (ids_b, bytes_b))]


plain_tokens.both = (Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1]))
plain_tokens.both[0].encode_special_tokens = True


def plain_alignment(text):
    """Groups, and links as pairs of ids, by walking over the bytes."""
    tokens = plain_tokens(text) if text else None
    if tokens is None:
        return None
    sides = []
    for side in tokens:
        at, spans = 0, []
        for token, length in side:
            spans.append((token, at, at + length))
            at += length
        sides.append(spans)
    a, b = sides
    links, j = [], 0
    for token, start, end in a:
        while b[j][2] <= start:
            j += 1
        k = j
        while k < len(b) and b[k][1] < end:
            links.append((token, b[k][0]))
            k += 1
    groups, left_a, left_b = [], [], []
    ends_b = {end for _, _, end in b}
    cuts = [end for _, _, end in a if end in ends_b]
    ia = ib = 0
    for cut in cuts:
        left_a, left_b = [], []
        while ia < len(a) and a[ia][2] <= cut:
            left_a.append(str(a[ia][0]))
            ia += 1
        while ib < len(b) and b[ib][2] <= cut:
            left_b.append(str(b[ib][0]))
            ib += 1
        groups.append(f"{','.join(left_a)}|{','.join(left_b)}")
    return len(a), len(b), groups, links


def plain(rows):
    found = [(doc_id, plain_alignment(text)) for doc_id, text in rows]
    counts = Counter(link for _, own in found if own for link in own[3])
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for doc_id, own in found:
        if own is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = own
        best = sum(counts[link] == highest[link[1]] for link in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(counts[link] for link in links), digest))
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzäöüéñç"
    vocabulary = ["".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(200)] + ["the", "and", "Of", "x1"]
    return [
        "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", ", ", ".\n", "  "]) for _ in range(rng.randint(1, 120)))
        for _ in range(n)
    ]


def run(spark, rows):
    docs = spark.createDataFrame([(i, text, "x", 0) for i, text in rows], TABLE)
    found = alignment.aligned(docs, path_a=PATHS[0], path_b=PATHS[1])
    return sorted([tuple(r) for r in found.collect()], key=str)


def test_odd_texts_word_by_word_as_whole(own):
    for text in filter(None, ODD):
        f = alignment.Fragment.of(text, own).ended(own)
        want = plain_alignment(text)
        assert f.sound == (want is not None), text
        if want:
            assert f.groups == ";".join(want[2]), text
            assert f.counts.tolist() == [want[0], want[1], len(want[2]), len(want[3])]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab é日 \n\t'.1▁ s"), min_size=1, max_size=60), st.data())
def test_fragments_compose_in_any_bracketing(text, data):
    t = test_fragments_compose_in_any_bracketing.tokenizers
    whole = alignment.Fragment.of(text, t).ended(t)
    parts = [alignment.Fragment.of(p, t) for p in alignment.cut_ranges(text, data.draw(st.integers(1, 9)))]
    while len(parts) > 1:
        i = data.draw(st.integers(0, len(parts) - 2))
        parts[i : i + 2] = [parts[i].joined(parts[i + 1], t)]
    joined = parts[0].ended(t)
    assert joined.sound == whole.sound
    if whole.sound:
        assert (joined.groups, joined.counts.tolist()) == (whole.groups, whole.counts.tolist())
        assert joined.pairs.tolist() == whole.pairs.tolist() and joined.times.tolist() == whole.times.tolist()
        want = plain_alignment(text)
        assert joined.groups == ";".join(want[2])
    else:
        assert plain_alignment(text) is None


test_fragments_compose_in_any_bracketing.tokenizers = alignment.Tokenizers(*PATHS)


@pytest.mark.parametrize("size", [64 << 10, 200])
def test_alignment_by_brute_force(spark, monkeypatch, size):
    """With small ranges most texts are composed from many, over several steps."""
    monkeypatch.setattr(alignment, "RANGE_BYTES", size)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 20_000)
    texts = corpus(1, 80) + ODD + ["the and Of x1"] * 40
    texts += [" ".join(corpus(2, 40)), "日本語" * 300, "one two  " * 500]
    rows = list(enumerate(texts))
    rows += [(None, "the end"), (3, texts[3]), (3, texts[4])]
    assert run(spark, rows) == plain(rows)


def test_an_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == plain([(1, None), (2, "")])


def test_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op13_token_alignment"](spark, folder).collect()
    assert sorted(map(tuple, found), key=str) == plain(docs)
