"""Byte-level BPE: every distinct pre-token of the corpus is encoded once."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retinue.llm.frames import carried
from retinue.llm.tasks import gathered, list_pieces, pack, pieces, spans, unpack, worker_memory

#: Text of one block of documents, in bytes. A block's pre-tokens are handled together.
BLOCK_BYTES = 16 << 20
#: Rows of encoded pre-tokens that are gathered before they are sent to their blocks.
FLUSH_ROWS = 400_000

# A single space between two characters that no engine takes for white space starts a new
# match of the pattern, whatever stands around it.
_BREAK = re.compile(r"(?<=\S)(?= \S)")
_SPACES = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# Texts in which each space is such a break.
_UNEVEN = rf"^ | $|[{_SPACES}] | [{_SPACES}]"
# Characters whose classes all engines agree on, without white space.
_COMMON = r"\x21-\x7E\x{A1}-\x{24F}"
# Chunks without white space but for single line feeds between other characters. There the
# pattern's alternatives for white space come down to one line feed, and need no look-ahead.
_SIMPLE = rf"^[{_COMMON}]+(\n[{_COMMON}]+)*$"
_LOOK_AHEAD = r"|\s+(?!\S)|\s+"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    memory = worker_memory("bpe")
    key = ("bpe", path, pattern)
    if key not in memory:
        memory[key] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={}
        )
    return memory[key]


def _token_bytes(path: str) -> pa.Array:
    """Bytes of each id."""
    memory = worker_memory("bpe")
    key = ("token bytes", path)
    if key not in memory:
        ranks = load_ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        memory[key] = pa.array(table, pa.large_binary())
    return memory[key]


def _contents(lists: pa.ListArray, table: pa.Array) -> pa.Array:
    """Bytes that each list of ids decodes to."""
    flat = table.take(pc.list_flatten(lists))
    ends = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1, flat.offset * 8)
    bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
    data = flat.buffers()[2] or pa.py_buffer(b"")
    content = pa.Array.from_buffers(
        pa.large_binary(), len(lists), [None, pa.py_buffer(ends[bounds].copy()), data]
    )
    return content.cast(pa.binary())


def _chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Cut texts before single spaces.

    Returns the distinct chunks, without their space; for each chunk in order twice its
    index, plus one if it opens its text; and the number of chunks of each text.
    """
    texts = texts.cast(pa.large_string())
    uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, " ")
    counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
    values = pc.list_flatten(lists)
    if uneven.any():
        parts = [
            _BREAK.split(text) if odd else None for text, odd in zip(texts.to_pylist(), uneven.tolist(), strict=True)
        ]
        columns, ends = [], np.cumsum(counts)
        for i in range(len(parts)):
            if parts[i] is None:
                columns.append(values.slice(ends[i] - counts[i], counts[i]))
            else:
                # Each later part begins with the space that the other way has removed.
                own = [part if k == 0 else part[1:] for k, part in enumerate(parts[i])]
                columns.append(pa.array(own, pa.large_string()))
                counts[i] = len(own)
        values = pa.concat_arrays(columns)
    encoded = values.dictionary_encode()
    marked = encoded.indices.to_numpy() * np.int32(2)
    marked[(np.cumsum(counts) - counts)[counts > 0]] += 1
    return encoded.dictionary, marked, counts


def _split(chunks: pa.Array, pattern: str) -> tuple[pa.Array, np.ndarray]:
    """Pre-tokens of each chunk side by side, and their number for each chunk.

    Chunks with unusual characters are left whole: the tokenizer splits them itself, with
    the same result.
    """
    bare = pc.utf8_ltrim(chunks, " ")
    simple = pc.match_substring_regex(bare, _SIMPLE).to_numpy(zero_copy_only=False)
    marks = pc.replace_substring_regex(chunks, f"({pattern.removesuffix(_LOOK_AHEAD)}|\\n)", "\\1\x00")
    simple &= pattern.endswith(_LOOK_AHEAD)
    ready = pc.if_else(pa.array(simple), pc.utf8_rtrim(marks, "\x00"), chunks)
    lists = pc.split_pattern(ready, "\x00")
    values, counts = pc.list_flatten(lists), pc.list_value_length(lists).to_numpy().astype(np.int64)
    odd = np.flatnonzero(~simple & (counts > 1))
    if len(odd):  # a chunk with the mark itself
        whole = set(odd.tolist())
        parts = [[c] if n in whole else own for n, (c, own) in enumerate(zip(chunks.to_pylist(), lists.to_pylist()))]
        values, counts = pa.array([p for own in parts for p in own], pa.large_string()), np.array([len(p) for p in parts])
    return values, counts


def cut_block(texts: pa.Array, pattern: str, positions: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pre-tokens of some texts, the place of each pre-token in that list, and each text's number.

    The list is in order of first appearance among the distinct chunks. Without
    ``positions`` only the list is filled.
    """
    chunks, marked, counts = _chunks(texts)
    used = np.zeros(2 * len(chunks), bool)
    used[marked] = True
    marks = np.flatnonzero(used)
    own = chunks.take(pa.array(marks >> 1))
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), own, pa.scalar("", pa.large_string()))
    split, sizes = _split(pc.if_else(pa.array((marks & 1).astype(bool)), own, spaced), pattern)
    # An empty text has one chunk without any pre-token.
    empty = pc.equal(split, "").to_numpy(zero_copy_only=False)
    if empty.any():
        sizes = sizes - np.add.reduceat(empty.astype(np.int64), np.cumsum(sizes) - sizes)
        split = split.filter(pa.array(~empty))
    encoded = split.dictionary_encode()
    if not positions:
        return encoded.dictionary, np.empty(0, np.int32), np.empty(0, np.int64)
    number = np.cumsum(used, dtype=np.int32) - np.int32(1)
    inverse = number[marked]
    sizes = sizes.astype(np.int32)
    lengths = sizes[inverse]
    starts = np.cumsum(sizes, dtype=np.int32) - sizes
    codes = gathered(encoded.indices.to_numpy(), starts[inverse], lengths)
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return encoded.dictionary, codes, ends[bounds[1:]] - ends[bounds[:-1]]


def _block_key(tokens: pa.Array) -> int:
    """A key that only a block with the same list of pre-tokens has."""
    if not len(tokens):
        return 0
    ends = np.frombuffer(tokens.buffers()[1], np.int64, len(tokens) + 1, tokens.offset * 8)
    digest = xxhash.xxh64(np.diff(ends).tobytes())
    digest.update(tokens.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])))
    return digest.intdigest() - (1 << 63)


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str, positions: bool, block_bytes: int):
    worker_memory("bpe")  # what another operator has left goes before blocks are held
    for piece in pieces(batches, "body", block_bytes):
        tokens, codes, totals = cut_block(piece.column("body"), pattern, positions)
        yield piece, _block_key(tokens), tokens, codes, totals


def token_table(docs: DataFrame, path: str, pattern: str, block_bytes: int) -> DataFrame:
    """``block``, ``code``, ``token``: the distinct pre-tokens of each block of documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, tokens, _, _ in _blocks(batches, pattern, False, block_bytes):
            for start in range(0, len(tokens), 50_000):
                some = tokens.slice(start, 50_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), block)),
                        pa.array(np.arange(start, start + len(some), dtype=np.int32)),
                        some.cast(pa.string()),
                    ],
                    ["block", "code", "token"],
                )

    return docs.mapInArrow(cut, "block bigint, code int, token string")


def sequences(docs: DataFrame, pattern: str, block_bytes: int) -> DataFrame:
    """One row per block: its documents' ids and their pre-tokens as places in the block's list."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, block, _, codes, totals in _blocks(batches, pattern, True, block_bytes):
            ids = piece.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([pack(totals)], pa.binary()),
                    pa.array([pack(codes)], pa.binary()),
                ],
                ["block", "doc_ids", "totals", "codes"],
            )

    return docs.mapInArrow(cut, f"block bigint, doc_ids array<{id_type}>, totals binary, codes binary")


def encode_tokens(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode each distinct token once; its ids go to every block that has it.

    Rows are dealt by token and sorted, so equal tokens follow each other. A token has at
    most one row per block, so frequent tokens stay few rows. Returns packed rows ``block``,
    ``codes``, ``counts``, ``ids``.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path, pattern)
        last, last_ids = None, []
        blocks: list[np.ndarray] = []
        codes: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            block, code = np.concatenate(blocks), np.concatenate(codes)
            count, flat = np.concatenate(counts), np.concatenate(ids)
            starts = np.cumsum(count) - count
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            parts = np.split(order, cuts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([int(block[p[0]]) for p in parts], pa.int64()),
                    pa.array([pack(code[p]) for p in parts], pa.binary()),
                    pa.array([pack(count[p]) for p in parts], pa.binary()),
                    pa.array([pack(flat[spans(starts[p], count[p])]) for p in parts], pa.binary()),
                ],
                ["block", "codes", "counts", "ids"],
            )

        for batch in batches:
            tokens = batch.column("token").dictionary_encode()
            distinct = tokens.dictionary.to_pylist()
            found = [last_ids if token == last else encoding.encode_ordinary(token) for token in distinct]
            last, last_ids = distinct[-1], found[-1]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for own in found for i in own), np.int64, int(sizes.sum()))
            chosen = tokens.indices.to_numpy()
            blocks.append(batch.column("block").to_numpy())
            codes.append(batch.column("code").to_numpy())
            counts.append(sizes[chosen])
            ids.append(flat[spans((np.cumsum(sizes) - sizes)[chosen], sizes[chosen])])
            held += len(chosen)
            if held >= FLUSH_ROWS:
                yield flush()
                held = 0
                for gathered in (blocks, codes, counts, ids):
                    gathered.clear()
        if held:
            yield flush()

    dealt = tokens.repartition("token").sortWithinPartitions("token")
    return dealt.mapInArrow(encode, "block bigint, codes binary, counts binary, ids binary")


def encode(
    docs: DataFrame,
    *,
    path: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int | None = None,
    decoded: bool = False,
) -> DataFrame:
    """Ids of every text: ``doc_id`` and ``ids``, one row per input row.

    With ``decoded`` also ``content``, the bytes of :func:`decode`, looked up by the task that puts the
    ids together: a second step would hold two Python workers for each running task.

    ``path`` is a file of token ranks that all executors can read, ``pattern`` cuts a text
    into pre-tokens. Null text is empty and has no ids; rows may repeat; an empty table
    gives an empty result. One text, however long, is a row of a task and is never cut
    between blocks.

    Documents are cut in blocks (``block_bytes`` of text, by default ``BLOCK_BYTES``): larger ones shuffle less, smaller
    ones take less of a worker's memory, about 20 bytes for one of text. A block sends each of its
    distinct pre-tokens once, dealt by token, where equal ones of all blocks meet and are
    encoded together. The ids come back by block and meet the block's sequence of
    positions, which holds about two bytes per pre-token in place of an exploded row.

    The documents are read twice and must come in the same order both times, as from files.
    A block's key is a hash of its pre-tokens: if the second reading differs, the block
    finds no ids and the task fails, rather than give wrong ids.
    """
    block_bytes = BLOCK_BYTES if block_bytes is None else block_bytes
    rows = carried(docs, doc_id=doc_id, body=F.coalesce(F.col(text), F.lit(""))).select("doc_id", "body")
    encoded = encode_tokens(token_table(rows, path, pattern, block_bytes), path, pattern)
    id_field = pa.field("doc_id", _arrow_type(rows))

    def assemble(sequence: pa.Table, tokens: pa.Table) -> pa.Table:
        worker_memory("bpe")
        fields = [id_field, ("ids", pa.list_(pa.int32())), ("content", pa.binary())]
        schema = pa.schema(fields if decoded else fields[:2])
        if not sequence.num_rows:
            return schema.empty_table()
        code = [unpack(part) for part in tokens.column("codes").to_pylist()]
        count = [unpack(part).astype(np.int64) for part in tokens.column("counts").to_pylist()]
        flat = [unpack(part) for part in tokens.column("ids").to_pylist()]
        size = 1 + max((int(c.max()) for c in code if len(c)), default=-1)
        lengths = np.zeros(size, np.int64)
        starts = np.zeros(size, np.int64)
        known = np.zeros(size, bool)
        offset = 0
        for c, n, ids in zip(code, count, flat, strict=True):
            lengths[c], known[c] = n, True
            starts[c] = offset + np.cumsum(n) - n
            offset += len(ids)
        every = np.concatenate(flat).astype(np.int32) if flat else np.empty(0, np.int32)
        out = []
        for row in range(sequence.num_rows):
            totals = unpack(sequence.column("totals")[row].as_py()).astype(np.int64)
            codes = unpack(sequence.column("codes")[row].as_py()).astype(np.int64)
            if len(codes) and (int(codes.max()) >= size or not known[codes].all()):
                raise ValueError("the documents changed between two readings; write them to a table first")
            ids = sequence.column("doc_ids")[row].values
            # By runs of documents, so that a list array's 32-bit offsets never overflow.
            bounds = np.concatenate([[0], np.cumsum(totals)])
            for first in range(0, len(ids), 1000):
                last = min(first + 1000, len(ids))
                part = codes[bounds[first] : bounds[last]]
                sizes = lengths[part]
                ends = np.concatenate([[0], np.cumsum(sizes)])
                offsets = ends[bounds[first : last + 1] - bounds[first]].astype(np.int32)
                values = pa.array(every[spans(starts[part], sizes)], pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(offsets), values)
                contents = [_contents(lists, _token_bytes(path))] if decoded else []
                out.append(pa.RecordBatch.from_arrays([ids.slice(first, last - first), lists, *contents], schema=schema))
        return pa.Table.from_batches(out, schema=schema)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return (
        sequences(rows, pattern, block_bytes)
        .groupBy("block")
        .cogroup(encoded.groupBy("block"))
        .applyInArrow(assemble, f"doc_id {id_type}, ids array<int>" + ", content binary" * decoded)
    )


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["doc_id"].dataType)


def decode(encoded: DataFrame, *, path: str) -> DataFrame:
    """Bytes of ids: adds ``content`` to frames with ``ids``.

    The table of token bytes has one row per entry of the vocabulary, so each task loads it
    and looks ids up there.
    """
    schema = T.StructType([*encoded.schema.fields, T.StructField("content", T.BinaryType())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(path)
        for batch in batches:
            for piece in list_pieces(iter([batch]), "ids", 4 << 20):
                content = _contents(piece.column("ids"), table)
                yield pa.RecordBatch.from_arrays([*piece.columns, content], [*piece.schema.names, "content"])

    return encoded.mapInArrow(look_up, schema)
