"""Which tokens of two tokenizers share bytes of a text, composed from byte ranges."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field, fields
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.llm.bpe import _BREAK, _chunks
from retinue.llm.frames import carried
from retinue.llm.tasks import pack, pieces, release, unpack, worker_memory
from retinue.operators.staging import settle

#: Text of one block of documents, in bytes. A block's words are aligned once.
BLOCK_BYTES = 16 << 20
#: Words that are encoded and aligned side by side.
SLICE_WORDS = 32_768
#: Longer texts are cut into ranges of about this many bytes, which any task may align.
RANGE_BYTES = 64 << 10
#: Neighbouring ranges that one step of the tree composes.
FAN = 8
_SPACE = "▁"  # how the second tokenizer writes a space


# --- tokens ----------------------------------------------------------------------------------


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        a_bytes = [b""] * self.a.get_vocab_size()
        for token, number in self.a.get_vocab().items():
            own = [letters.get(c) for c in token]
            a_bytes[number] = token.encode() if None in own else bytes(own)
        pieces_b = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces_b)
        ]
        if any(_SPACE in p.lstrip(_SPACE) for p in pieces_b):
            raise ValueError("the second tokenizer joins words: texts cannot be cut at spaces")
        self.a_bytes, self.b_bytes = (pa.array(t, pa.large_binary()) for t in (a_bytes, b_bytes))
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in table]) for table in (a_bytes, b_bytes))
        self.a_names, self.b_names = ([str(i) for i in range(len(t))] for t in (a_bytes, b_bytes))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words, each behind one space, and how many each has: of A, of B."""
        out = []
        for first in range(0, len(words), 4096):
            some = words[first : first + 4096]
            a = [e.ids for e in self.a.encode_batch_fast([" " + w for w in some], add_special_tokens=False)]
            b = self.b.encode(some, num_threads=1)
            out.append([f(ids) for ids in (a, b) for f in (_flat, _sizes)])
        if not out:
            return (np.empty(0, np.int64),) * 4
        return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64)


def _sizes(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(map(len, lists), np.int64, len(lists))


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte: itself, or the next one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def _tokenizers(paths: tuple[str, str]) -> Tokenizers:
    memory = worker_memory("alignment")
    key = ("alignment", *paths)
    if key not in memory:
        memory[key] = Tokenizers(*paths)
    return memory[key]


# --- groups of words ---------------------------------------------------------------------------


@dataclass
class Words:
    """Words that stand alone, aligned: both tokenizers end a token at each word's end.

    ``links`` are pairs of ids, word after word: the id of A times 2**32 plus that of B.
    ``groups`` is the text of each word's groups. A word whose tokens do not join to its own
    bytes is not ``sound``.
    """

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    links: np.ndarray
    groups: list[str]
    sound: np.ndarray


def align(words: list[str], t: Tokenizers) -> Words:
    """Align words, ``SLICE_WORDS`` at a time."""
    starts = range(0, max(len(words), 1), SLICE_WORDS)
    parts = [_align(words[start : start + SLICE_WORDS], t) for start in starts]
    if len(parts) == 1:
        return parts[0]
    return Words(
        **{
            f.name: list(chain.from_iterable(getattr(p, f.name) for p in parts))
            if f.name == "groups"
            else np.concatenate([getattr(p, f.name) for p in parts])
            for f in fields(Words)
        }
    )


def _align(words: list[str], t: Tokenizers) -> Words:
    """Lay the tokens of both sides over the bytes of each word behind a space.

    Between two neighbouring token ends of either side lie bytes of one token of A and one
    of B: each such stretch is a link, and where both end a group ends.
    """
    a, n_a, b, n_b = t.encode(words)
    sound = _sound(words, a, n_a, b, n_b, t)
    if not sound.all():
        a, b = a[np.repeat(sound, n_a)], b[np.repeat(sound, n_b)]
        n_a, n_b = np.where(sound, n_a, 0), np.where(sound, n_b, 0)
    a_ends, b_ends = np.cumsum(t.a_lengths[a]), np.cumsum(t.b_lengths[b])
    ends = np.union1d(a_ends, b_ends)
    of_a, of_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    word = np.repeat(np.arange(len(words)), n_a)[of_a] if len(ends) else np.empty(0, np.int64)
    both = (a_ends[of_a] == ends) & (b_ends[of_b] == ends) if len(ends) else np.empty(0, bool)
    n_links = np.bincount(word, minlength=len(words))
    n_groups = np.bincount(word[both], minlength=len(words))
    names_a, names_b = [t.a_names[i] for i in a.tolist()], [t.b_names[i] for i in b.tolist()]
    texts, at_a, at_b = [], 0, 0
    for end_a, end_b in zip((of_a[both] + 1).tolist(), (of_b[both] + 1).tolist(), strict=True):
        texts.append(f"{','.join(names_a[at_a:end_a])}|{','.join(names_b[at_b:end_b])}")
        at_a, at_b = end_a, end_b
    bounds = np.concatenate([[0], np.cumsum(n_groups)]).tolist()
    groups = [";".join(texts[i:j]) for i, j in zip(bounds, bounds[1:])]
    return Words(n_a, n_b, n_groups, n_links, (a[of_a] << 32) | b[of_b], groups, sound)


def _sound(words: list[str], a, n_a, b, n_b, t: Tokenizers) -> np.ndarray:
    """Whether the tokens of each word join to a space and the word, on both sides."""
    whole = [f" {word}".encode() for word in words]
    data = np.frombuffer(b"".join(whole), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, whole), np.int64, len(whole)))
    out = np.ones(len(words), bool)
    for ids, n, table, sizes in ((a, n_a, t.a_bytes, t.a_lengths), (b, n_b, t.b_bytes, t.b_lengths)):
        joined = np.frombuffer(_joined(table, ids), np.uint8)
        own_ends = np.concatenate([[0], np.cumsum(sizes[ids])])[np.cumsum(n)]
        if np.array_equal(own_ends, ends) and np.array_equal(joined, data):
            continue
        parts = zip(np.concatenate([[0], own_ends]).tolist(), own_ends.tolist(), whole)
        out &= np.fromiter((joined[i:j].tobytes() == w for i, j, w in parts), bool, len(words))
    return out


def _joined(table: pa.Array, ids: np.ndarray) -> bytes:
    flat = table.take(pa.array(ids, pa.int64()))
    ends = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1, flat.offset * 8)
    return flat.buffers()[2].to_pybytes()[ends[0] : ends[-1]] if len(flat) else b""


# --- fragments -----------------------------------------------------------------------------------


@dataclass
class Fragment:
    """What is known of a range of bytes without its neighbours.

    ``head`` is the text before the first place where both tokenizers surely begin a token,
    ``tail`` the text from the last one on; their groups stay open. ``groups``, ``pairs`` and
    ``counts`` describe the closed ones between. A range without such a place is ``whole``:
    all of it is ``head``. Fragments of neighbouring ranges compose, in any bracketing, to
    the fragment of both.
    """

    whole: bool
    head: str
    tail: str = ""
    groups: str = ""
    pairs: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(4, np.int64))
    sound: bool = True

    @classmethod
    def of(cls, text: str, t: Tokenizers) -> Fragment:
        breaks = [m.start() for m in _BREAK.finditer(text)]
        if not breaks:
            return cls(True, text)
        first, last = breaks[0], breaks[-1]
        return cls(False, text[:first], text[last:]).closing(text[first:last], t)

    def closing(self, text: str, t: Tokenizers, before: Fragment | None = None, after: Fragment | None = None) -> Fragment:
        """Put the groups of ``text``, which both ends close, between those of two fragments."""
        parts = [f for f in (before, after) if f is not None]
        words = [p[1:] for p in _BREAK.split(text)] if text else []
        distinct = list(dict.fromkeys(words))
        found = align(distinct, t)
        code = {word: n for n, word in enumerate(distinct)}
        codes = np.array([code[w] for w in words], np.int64)
        times = np.bincount(codes, minlength=len(distinct))
        pairs = np.concatenate([found.links, *[f.pairs for f in parts]])
        n = np.concatenate([np.repeat(times, found.n_links), *[f.times for f in parts]])
        self.pairs, place = np.unique(pairs, return_inverse=True)
        self.times = np.bincount(place, weights=n, minlength=len(self.pairs)).astype(np.int64)
        own = np.array([(times * c).sum() for c in (found.n_a, found.n_b, found.n_groups, found.n_links)], np.int64)
        self.counts = sum([f.counts for f in parts], own)
        middle = ";".join([found.groups[c] for c in codes.tolist()])
        texts = [before.groups if before else "", middle, after.groups if after else ""]
        self.groups = ";".join([x for x in texts if x])
        self.sound = bool(found.sound.all()) and all(f.sound for f in parts)
        return self

    def joined(self, other: Fragment, t: Tokenizers) -> Fragment:
        """The fragment of both ranges. Where they meet a head closes, a tail closes, or both."""
        seam = (self.head if self.whole else self.tail) + other.head
        if not self.whole and not other.whole:
            return Fragment(False, self.head, other.tail).closing(seam, t, self, other)
        breaks = [m.start() for m in _BREAK.finditer(seam)]
        if self.whole and other.whole:
            return Fragment.of(seam, t)
        if self.whole:
            if not breaks:
                return Fragment(False, seam, other.tail).closing("", t, None, other)
            return Fragment(False, seam[: breaks[0]], other.tail).closing(seam[breaks[0] :], t, None, other)
        if not breaks:
            return Fragment(False, self.head, seam).closing("", t, self)
        return Fragment(False, self.head, seam[breaks[-1] :]).closing(seam[: breaks[-1]], t, self)

    def ended(self, t: Tokenizers) -> Fragment:
        """Close both ends: the range is a whole text."""
        first = Fragment(False, "").closing(f" {self.head}", t)
        rest = Fragment(False, "").closing(self.tail, t)
        inner = Fragment(False, "").closing("", t, first, self)
        return Fragment(False, "").closing("", t, inner, rest)


_FRAGMENT = (
    "whole boolean, head string, tail string, groups string, pairs binary, times binary, "
    "counts array<bigint>, sound boolean"
)
_FIELDS = [part.split()[0] for part in _FRAGMENT.split(", ")]


def _stored(f: Fragment) -> dict:
    return {
        "whole": f.whole,
        "head": f.head,
        "tail": f.tail,
        "groups": f.groups,
        "pairs": f.pairs.tobytes(),
        "times": f.times.tobytes(),
        "counts": f.counts.tolist(),
        "sound": f.sound,
    }


def _loaded(row: dict) -> Fragment:
    pairs, times = (np.frombuffer(row[c], np.int64) for c in ("pairs", "times"))
    own = {"pairs": pairs, "times": times, "counts": np.array(row["counts"], np.int64)}
    return Fragment(**{c: own.get(c, row[c]) for c in _FIELDS})


_ARROW = {
    "whole": pa.bool_(), "head": pa.string(), "tail": pa.string(), "groups": pa.string(), "pairs": pa.binary(),
    "times": pa.binary(), "counts": pa.list_(pa.int64()), "sound": pa.bool_(),
}


def cut_ranges(text: str, size: int) -> list[str]:
    """Ranges of about ``size`` bytes, cut between characters."""
    data = text.encode()
    cuts = [0]
    while cuts[-1] < len(data):
        end = min(cuts[-1] + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        cuts.append(end)
    return [data[i:j].decode() for i, j in zip(cuts, cuts[1:])]


def long_texts(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Fragments of whole texts, one row a text: its ranges aligned apart, then composed as a tree.

    Neither the ranges of a text nor the steps of its tree need one task.
    """
    size = RANGE_BYTES
    id_type = docs.schema["doc_id"].dataType
    names = ["doc_id", "text_no", "part", "body"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ranges = cut_ranges(batch.column("body")[i].as_py(), size)
                again = pa.array(np.full(len(ranges), i))
                columns = [batch.column(c).take(again) for c in names[:2]]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(range(len(ranges)), pa.int64()), pa.array(ranges, pa.string())], names
                )

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizers(paths)
        for batch in batches:
            rows = [_stored(Fragment.of(text, t)) for text in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names[:3]], *[pa.array([r[c] for r in rows], k) for c, k in _ARROW.items()]],
                [*names[:3], *_ARROW],
            )

    def compose(table: pa.Table) -> pa.Table:
        t = _tokenizers(paths)
        table = table.sort_by("part")
        rows = [_loaded(row) for row in table.select(_FIELDS).to_pylist()]
        while len(rows) > 1:
            pairs = [rows[i : i + 2] for i in range(0, len(rows), 2)]
            rows = [p[0].joined(p[1], t) if len(p) == 2 else p[0] for p in pairs]
        stored = _stored(rows[0])
        first = table.slice(0, 1)
        columns = [
            first.column("doc_id"),
            first.column("text_no"),
            pa.array([first.column("part")[0].as_py() // FAN], pa.int64()),
            *[pa.array([stored[c]], k) for c, k in _ARROW.items()],
        ]
        return pa.Table.from_arrays(columns, [*names[:3], *_ARROW])

    numbered = docs.withColumn("text_no", F.monotonically_increasing_id())
    schema = docs.select("doc_id").schema.add("text_no", "long").add("part", "long")
    parts = settle(numbered.select("doc_id", "text_no", "body").mapInArrow(cut, schema.add("body", "string")))
    steps, most = 0, parts.agg(F.max("part")).first()[0] or 0
    schema = f"doc_id {id_type.simpleString()}, text_no bigint, part bigint, {_FRAGMENT}"
    rows = parts.repartition("text_no", "part").mapInArrow(start, schema)
    while most >= FAN**steps:
        rows = rows.groupBy("text_no", (F.col("part") / FAN).cast("bigint").alias("_step")).applyInArrow(compose, schema)
        steps += 1
    return rows


# --- blocks ----------------------------------------------------------------------------------------

# A block: its documents, the words each consists of, the links of each word, and the
# distinct pairs of ids among them with the number of links that hold each.
_BLOCK = (
    "n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>, "
    "sizes binary, codes binary, word_links binary, link_pairs binary, times binary, pairs binary, pair_links binary"
)
_BLOCK_FIELDS = [part.split()[0] for part in _BLOCK.split(", ")]


def _block(ids: pa.Array, stats, shas, sizes, codes, word_links, link_pairs, times, pairs, pair_links) -> pa.RecordBatch:
    def one(values) -> pa.ListArray:
        values = values if isinstance(values, pa.Array) else pa.array(values)
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    packed = [pa.array([pack(part)], pa.binary()) for part in (sizes, codes, word_links, link_pairs, times)]
    raw = [pa.array([part.astype(np.int64).tobytes()], pa.binary()) for part in (pairs, pair_links)]
    return pa.RecordBatch.from_arrays(
        [one(ids), *[one(s.astype(np.int64)) for s in stats], one(pa.array(shas, pa.string())), *packed, *raw],
        ["doc_ids", *_BLOCK_FIELDS],
    )


def _digest(groups: str) -> str:
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of successive runs of the given sizes."""
    so_far = np.concatenate([[0], np.cumsum(values)])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return so_far[bounds[1:]] - so_far[bounds[:-1]]


def short_blocks(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Blocks of whole texts: every distinct word of a block is encoded and aligned once."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizers(paths)
        for piece in pieces(batches, "body", BLOCK_BYTES):
            distinct, marked, sizes = _chunks(piece.column("body"))
            codes = (marked >> 1).astype(np.int64)
            found = align(distinct.to_pylist(), t)
            # Empty texts have one empty word; other texts with an unsound word have no tokens either.
            empty = np.asarray(pc.equal(piece.column("body"), ""))
            lost = empty | (_sums((~found.sound[codes]).astype(np.int64), sizes) > 0)
            codes = codes[np.repeat(~lost, sizes)]
            sizes = np.where(lost, 0, sizes)
            stats = [_sums(n[codes], sizes) for n in (found.n_a, found.n_b, found.n_groups, found.n_links)]
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            shas = [
                _digest(";".join([found.groups[c] for c in codes[i:j].tolist()])) for i, j in zip(bounds, bounds[1:])
            ]
            pairs, link_pairs = np.unique(found.links, return_inverse=True)
            used = np.bincount(codes, minlength=len(distinct))
            pair_links = np.bincount(link_pairs, np.repeat(used, found.n_links), len(pairs)).astype(np.int64)
            times = np.ones(len(link_pairs), np.int64)
            ids = piece.column("doc_id")
            yield _block(ids, stats, shas, sizes, codes, found.n_links, link_pairs, times, pairs, pair_links)
            del found, distinct, marked, codes
            release()

    return docs.mapInArrow(cut, f"doc_ids array<{id_type}>, {_BLOCK}")


def long_blocks(fragments: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Each composed text as a block of its own, as if it were one word."""
    id_type = fragments.schema["doc_id"].dataType.simpleString()

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizers(paths)
        for batch in batches:
            for i, row in enumerate(batch.select(_FIELDS).to_pylist()):
                f = _loaded(row).ended(t)
                n = len(f.pairs) if f.sound else 0
                one = np.array([1 if n else 0])
                stats = [np.array([c]) for c in (f.counts if n else np.zeros(4, np.int64))]
                yield _block(
                    batch.column("doc_id").slice(i, 1), stats, [_digest(f.groups) if n else ""], one,
                    np.zeros(one[0], np.int64), np.array([n]), np.arange(n), f.times[:n], f.pairs[:n], f.times[:n],
                )

    return fragments.mapInArrow(end, f"doc_ids array<{id_type}>, {_BLOCK}")


def pair_rows(blocks: DataFrame) -> DataFrame:
    """``block``, ``place``, ``pair``, ``n``: the distinct pairs of each block and their links there."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair, n = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("pairs", "pair_links"))
                for first in range(0, len(pair), 50_000):
                    part = slice(first, first + 50_000)
                    place = np.arange(first, first + len(pair[part]), dtype=np.int32)
                    block = np.full(len(place), batch.column("block")[i].as_py())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block), pa.array(place), pa.array(pair[part]), pa.array(n[part])],
                        ["block", "place", "pair", "n"],
                    )

    found = blocks.select("block", "pairs", "pair_links")
    return found.mapInArrow(rows, "block bigint, place int, pair bigint, n bigint")


def aligned(
    docs: DataFrame, *, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Align the tokens of two tokenizers over every whole text.

    ``path_a`` is a byte-level tokenizer, which is given a space and the text, ``path_b`` a
    piece tokenizer, which adds the space itself; special tokens' strings are ordinary text.
    Returns one row per input row: ``doc_id``, ``n_a``, ``n_b`` (tokens), ``n_groups`` (byte
    offsets where both end), ``n_links`` (pairs of occurrences that share bytes),
    ``n_best`` (links whose pair of ids is the most frequent of its B id in the corpus),
    ``count_sum`` (over links, how many links of the corpus hold the pair) and
    ``groups_sha256``.

    Both tokenizers begin a token at a single space between other characters, so words are
    aligned apart: once per block of texts. Texts above ``RANGE_BYTES`` are cut into byte
    ranges that any task may take; a range gives an open head, closed groups and an open
    tail, and a tree of joins composes them. Blocks send each distinct pair of ids once, with
    its number; sums come back by block.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte,
    have no tokens: zeros and an empty digest. Rows may repeat, also with the same id or none.
    Equally frequent pairs all are the most frequent. Columns may have any name. An empty
    table gives an empty result. One text must fit a task, as must its groups at the end.
    """
    paths = (path_a, path_b)
    rows = carried(docs, doc_id=doc_id, body=F.coalesce(F.col(f"`{text}`"), F.lit(""))).select("doc_id", "body")
    is_long = F.octet_length("body") > RANGE_BYTES
    short = short_blocks(rows.where(~is_long), paths)
    composed = long_blocks(long_texts(rows.where(is_long), paths), paths)
    blocks = settle(short.unionByName(composed).withColumn("block", F.monotonically_increasing_id()))
    pairs = pair_rows(blocks)
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("links")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    counts = settle(counts)
    highest = counts.groupBy("b").agg(F.max("links").alias("highest"))
    judged = counts.join(highest, "b").select("pair", "links", (F.col("links") == F.col("highest")).alias("best"))
    found = pairs.drop("n").join(judged, "pair").select("block", "place", "links", "best")
    return _assembled(blocks, found)


def _assembled(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """Sum what the corpus says of a block's pairs over links, words and documents."""
    id_type = blocks.schema["doc_ids"].dataType.elementType
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def assemble(block: pa.Table, pairs: pa.Table) -> pa.Table:
        out = []
        for row in range(block.num_rows):
            get = {c: block.column(c)[row] for c in block.column_names}
            place = pairs.column("place").to_numpy()
            links, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            links[place] = pairs.column("links").to_numpy()
            best[place] = pairs.column("best").to_numpy().astype(np.int64)
            sizes, codes, word_links, link_pairs, times = (
                unpack(get[c].as_py()).astype(np.int64)
                for c in ("sizes", "codes", "word_links", "link_pairs", "times")
            )
            sums = [_sums(_sums(times * v[link_pairs], word_links)[codes], sizes) for v in (best, links)]
            columns = [get[c].values for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
            out.append(pa.table([*columns, *map(pa.array, sums), get["groups_sha256"].values], names))
        return pa.concat_tables(out) if out else _nothing(block, names)

    counted = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint"
    own = blocks.drop("pairs", "pair_links")
    return (
        own.groupBy("block")
        .cogroup(found.groupBy("block"))
        .applyInArrow(assemble, f"doc_id {id_type.simpleString()}, {counted}, groups_sha256 string")
    )


def _nothing(block: pa.Table, names: list[str]) -> pa.Table:
    kinds = [block.schema.field("doc_ids").type.value_type, *[pa.int64()] * 6, pa.string()]
    return pa.schema(list(zip(names, kinds, strict=True))).empty_table()
