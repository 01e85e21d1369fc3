"""Token files: id arrays of many documents with Elias-Fano coded boundaries."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retinue.llm.eliasfano import EliasFano
from retinue.llm.frames import carried
from retinue.llm.tasks import gathered, pieces, shrink, worker_memory
from retinue.operators.staging import settle

_HEADER = "<8sBQqQ"
_MAGIC = b"TOKENEF1"
#: Text that is tokenized at a time.
PIECE_BYTES = 4 << 20
#: Words whose ids a worker process remembers, some 300 bytes each.
REMEMBERED = 200_000
# Characters that fold to lower case one by one and are already composed.
_SIMPLE = "[^\x00-įĲ-ňŊ-ž]"
_LETTER_STOP = "([a-zß-öø-ɏ])([.,!?;:])"


# Hadoop's names of a scheme that Arrow knows by another.
_ARROW_SCHEMES = re.compile("^s3[an]://")


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a folder, and the folder's path there."""
    return fs.FileSystem.from_uri(_ARROW_SCHEMES.sub("s3://", folder))


def dump(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: header, document ids, ends of documents, token ids.

    ``doc_ids`` ascends, null first. Both sequences are Elias-Fano coded. Token ids take
    two bytes each where all fit, else four, little endian.
    """
    known = [i for i in doc_ids if i is not None]
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    first = known[0] if known else 0
    header = struct.pack(_HEADER, _MAGIC, width, len(doc_ids) - len(known), first, len(ids))
    # Python's integers, as the difference of two 64-bit numbers may need 65 bits.
    offsets = [i - first for i in known]
    if offsets and offsets[-1] >= 1 << 62:
        raise ValueError("document ids of one file lie too far apart")
    names = EliasFano.of(np.array(offsets, np.int64)).tobytes()
    ends = EliasFano.of(np.cumsum(lengths, dtype=np.int64)).tobytes()
    return b"".join([header, names, ends, ids.astype(f"<u{width}").tobytes()])


class TokenFile:
    """A file's documents; ``ends`` and ``names`` answer select for single documents."""

    def __init__(self, buffer):
        magic, width, self.nulls, self.first, n_ids = struct.unpack_from(_HEADER, buffer, 0)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        self.names, offset = EliasFano.frombuffer(buffer, struct.calcsize(_HEADER))
        self.ends, offset = EliasFano.frombuffer(buffer, offset)
        self.ids = np.frombuffer(buffer, f"<u{width}", n_ids, offset)

    def __len__(self) -> int:
        return self.ends.count

    def doc_id(self, index: int) -> int | None:
        return None if index < self.nulls else self.first + self.names.select(index - self.nulls)

    def bounds(self, index: int) -> tuple[int, int]:
        return (self.ends.select(index - 1) if index else 0), self.ends.select(index)

    def document(self, index: int) -> np.ndarray:
        start, end = self.bounds(index)
        return self.ids[start:end]

    def doc_ids(self) -> pa.Array:
        known = self.names.all() + self.first
        return pa.concat_arrays([pa.nulls(self.nulls, pa.int64()), pa.array(known, pa.int64())])


def _tokenizer(path: str):
    memory = worker_memory("tokenfiles")
    if ("tokenizer", path) not in memory:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        memory["tokenizer", path] = Tokenizer.from_file(path)
    return memory["tokenizer", path]


def _may_be_special(texts: pa.Array, tokenizer) -> pa.Array:
    """Texts that may hold the string of a special token, which the tokenizer takes as that token.

    Looks for what all such strings begin with, which no change of case produces.
    """
    contents = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    lead = re.match("[^A-Za-z]*", os.path.commonprefix(contents)).group() if contents else ""
    if lead:
        return pc.match_substring(texts, lead)
    pattern = "|".join(map(re.escape, contents)) or "^$^"
    return pc.match_substring_regex(texts, pattern, ignore_case=True)


class _Letters:
    """Words of letters that a tokenizer neither changes nor cuts: its model alone gives their ids.

    Left out are the steps before the model, which take most of the time of a short word.
    """

    def __init__(self, tokenizer):
        self.model = tokenizer.model
        self.table: dict[int, str] = {}
        for letter in filter(str.islower, map(chr, range(0x250))):
            if tokenizer.normalizer.normalize_str(letter) != letter:
                continue
            cut = tokenizer.pre_tokenizer.pre_tokenize_str(letter)
            if len(cut) == 1:
                self.table[ord(letter)] = cut[0][0]
        letters = "".join(map(chr, self.table))
        # Without such letters, or should they not stay together, no word is taken.
        if letters and self.ids(letters) != tokenizer.encode(letters, add_special_tokens=False).ids:
            letters = ""
        self.match = re.compile(f"[{re.escape(letters)}]+" if letters else "(?!)").fullmatch

    def ids(self, word: str) -> list[int]:
        # The model sees bytes as characters.
        return [token.id for token in self.model.tokenize(word.translate(self.table))]


class _Words:
    """Ids of words this worker has met, side by side in one array.

    At half of ``most`` new words those not met since the last such time are forgotten, so
    that frequent words stay.
    """

    def __init__(self, tokenizer, most: int):
        self.tokenizer, self.letters, self.most = tokenizer, _Letters(tokenizer), most
        self.places: dict[str, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.met = np.empty(0, bool)
        self.new = 0

    def find(self, words: list[str]) -> np.ndarray:
        """The words' numbers in ``starts``."""
        if self.new > self.most // 2:
            self._forget()
        unknown = [word for word in words if word not in self.places]
        if unknown:
            self._add(unknown)
        found = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        self.met[found] = True
        return found

    def _forget(self) -> None:
        stay = np.flatnonzero(self.met)
        names = np.array(list(self.places), object)[stay].tolist()
        sizes = np.diff(self.starts)[stay]
        self.flat = gathered(self.flat, self.starts[stay], sizes)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.places = dict(zip(names, range(len(names)), strict=True))
        self.met = np.zeros(len(names), bool)
        self.new = 0

    def _add(self, words: list[str]) -> None:
        parts = [self.flat]
        sizes: list[int] = []
        for first in range(0, len(words), 2048):
            own = words[first : first + 2048]
            ids = [self.letters.ids(word) if self.letters.match(word) else None for word in own]
            others = [n for n, found in enumerate(ids) if found is None]
            if others:
                found = self.tokenizer.encode_batch_fast([own[n] for n in others], add_special_tokens=False)
                for n, encoding in zip(others, found, strict=True):
                    ids[n] = encoding.ids
            sizes += map(len, ids)
            parts.append(np.fromiter(chain.from_iterable(ids), np.uint32))
        self.places.update(zip(words, range(len(self.places), len(self.places) + len(words)), strict=True))
        self.flat = np.concatenate(parts)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.array(sizes, np.int64))])
        self.met = np.concatenate([self.met, np.ones(len(words), bool)])
        self.new += len(words)


def tokenize(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, side by side, and their number for each text.

    The tokenizer drops white space and never joins what stands on both sides of it, so
    each distinct word is encoded once. A stop behind a letter starts a new piece for the
    tokenizer too and is set apart, and simple letters are put in lower case, as the
    tokenizer does: fewer pieces are distinct then. A text with the string of a special
    token is encoded whole.
    """
    tokenizer = _tokenizer(path)
    memory = worker_memory("tokenfiles")
    if ("words", path) not in memory:
        memory["words", path] = _Words(tokenizer, REMEMBERED)
    words: _Words = memory["words", path]
    texts = texts.cast(pa.large_string())
    special = _may_be_special(texts, tokenizer)
    whole = np.flatnonzero(special.to_numpy(zero_copy_only=False))
    lists = pc.ascii_split_whitespace(pc.if_else(special, pa.scalar("", pa.large_string()), texts))
    counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
    spoken = pc.list_flatten(lists).dictionary_encode()
    # From here on distinct words only.
    own = spoken.dictionary
    plain = pc.invert(pc.match_substring_regex(own, _SIMPLE))
    apart = pc.replace_substring_regex(pc.utf8_lower(own), _LETTER_STOP, r"\1 \2")
    parts = pc.split_pattern(pc.if_else(plain, apart, own), " ")
    encoded = pc.list_flatten(parts).dictionary_encode()
    distinct = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
    chosen = words.find(distinct)[encoded.indices.to_numpy()]
    sizes = np.diff(words.starts)[chosen]
    flat = gathered(words.flat, words.starts[chosen], sizes)
    # Ids of each distinct word, then of each word in order.
    ends = np.concatenate([[0], np.cumsum(sizes)])
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy())])
    starts, lengths = ends[bounds[:-1]], ends[bounds[1:]] - ends[bounds[:-1]]
    order = spoken.indices.to_numpy()
    ids = gathered(flat, starts[order], lengths[order])
    ends = np.concatenate([[0], np.cumsum(lengths[order])])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if not len(whole):
        return ids, ends[bounds[1:]] - ends[bounds[:-1]]
    pieces_ = [ids[ends[i] : ends[j]] for i, j in zip(bounds, bounds[1:])]
    for n in whole.tolist():
        pieces_[n] = np.array(tokenizer.encode(texts[n].as_py(), add_special_tokens=False).ids, np.uint32)
    return np.concatenate(pieces_), np.array([len(p) for p in pieces_], np.int64)


def write_token_files(
    docs: DataFrame,
    folder: str,
    *,
    path: str,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    most_ids: int = 1 << 23,
) -> DataFrame:
    """Tokenize every text and write token files into ``folder``, in ascending order of ids.

    ``path`` is a tokenizer file that all executors can read, ``folder`` a place that all
    can write. Each document ends with ``end_id``. Null text is empty. Documents without
    an id come first; rows with the same id follow each other. An empty table writes no file.

    Rows are ranged by id and sorted; ties are broken by text and row, so a repeated id
    spreads over tasks. A task closes a file at ``most_ids`` ids, holding at most one text
    more. Files are written aside and then renamed: a task that runs twice leaves the same
    files. Returns the manifest, a written table with one row per file: ``file``, ``start``
    (ids in all files before it), ``n_docs``, ``n_ids``.
    """
    rows = carried(docs, doc_id=F.col(doc_id).cast("bigint"), body=F.coalesce(F.col(text), F.lit("")))
    ranged = (
        rows.select("doc_id", "body", F.xxhash64("body").alias("tie"), F.monotonically_increasing_id().alias("row"))
        .repartitionByRange("doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "row")
        .select("doc_id", "body")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, place = _store(folder)
        names: list[int | None] = []
        sizes: list[np.ndarray] = []
        arrays: list[np.ndarray] = []
        held = closed = 0

        def close() -> pa.RecordBatch:
            name = f"{task.partitionId():06d}-{closed:06d}.tok"
            lengths = np.concatenate(sizes)
            aside = f"{place}/.{name}.{task.taskAttemptId()}"
            with store.open_output_stream(aside) as file:
                file.write(dump(names, lengths, np.concatenate(arrays)))
            store.move(aside, f"{place}/{name}")
            return pa.RecordBatch.from_pylist([{"file": name, "n_docs": len(names), "n_ids": int(lengths.sum())}])

        store.create_dir(place, recursive=True)
        for piece in pieces(batches, "body", PIECE_BYTES):
            ids, lengths = tokenize(piece.column("body"), path)
            ends = np.cumsum(lengths)
            names += piece.column("doc_id").to_pylist()
            sizes.append(lengths + 1)
            arrays.append(np.insert(ids, ends, end_id))
            held += len(ids) + len(lengths)
            if held >= most_ids:
                yield close()
                closed += 1
                held = 0
                for gathered in (names, sizes, arrays):
                    gathered.clear()
        if names:
            yield close()

    files = settle(ranged.mapInArrow(write, "file string, n_docs bigint, n_ids bigint"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    return settle(files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the token files. Without their content no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of token files: ``file``, ``doc_id``, ``first`` (ids before it in its file) and ``ids``.

    ``ids`` is binary, unsigned 32-bit little endian. Spark's binary reader lists the files and
    deals them to tasks by size; a task opens one file at a time itself, as whole files in
    the executor's rows take several times their size there. Documents leave it a thousand at a time.
    """

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(folder)
        for name in (n for batch in batches for n in batch.column("file").to_pylist()):
            with store.open_input_file(f"{place}/{name}") as file:
                tokens = TokenFile(file.read_buffer())
            ends = np.concatenate([[0], tokens.ends.all()])
            names = tokens.doc_ids()
            for at in range(0, len(tokens), 1000):
                bounds = ends[at : at + 1001]
                part = tokens.ids[bounds[0] : bounds[-1]].astype("<u4")
                offsets = ((bounds - bounds[0]) * 4).astype("<i4")
                content = pa.Array.from_buffers(
                    pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(part)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * (len(bounds) - 1), pa.string()),
                        names.slice(at, len(bounds) - 1),
                        pa.array(bounds[:-1], pa.int64()),
                        content,
                    ],
                    ["file", "doc_id", "first", "ids"],
                )
            del tokens, names, ends
        shrink()

    return _files(spark, folder).mapInArrow(unfold, "file string, doc_id bigint, first bigint, ids binary")


def file_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``file``, ``start``: how many ids stand in all files before each, from the files' headers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(folder)
        for batch in batches:
            sizes = []
            for name in batch.column("file").to_pylist():
                with store.open_input_file(f"{place}/{name}") as file:
                    sizes.append(struct.unpack(_HEADER, file.read(struct.calcsize(_HEADER)))[4])
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(sizes, pa.int64())], ["file", "n_ids"])

    # One row per file.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    counted = _files(spark, folder).mapInArrow(count, "file string, n_ids bigint")
    return settle(counted.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")))
