"""Language identification by unigram piece models, summed over all segmentations of a word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm.frames import carried
from retinue.llm.tasks import pieces, worker_memory
from retinue.operators.staging import settle

#: Text that is split into words at a time.
PIECE_BYTES = 16 << 20
#: Letters of a word that are segmented together; longer words count as several.
LONGEST = 32
#: Words that are segmented together.
WORDS = 4096
#: Words of texts whose logarithms are held together.
SUMMED = 1 << 17
UNKNOWN = "und"
# A word's beginning in the vocabulary.
_START = "▁"
# Words whose chance is below this are summed in logarithms: what smaller numbers lose of
# their digits is far below the last digit of any chance above it.
_FAINT = 1e-150


class Vocabulary:
    """The vocabulary's pieces of lower-case letters as a trie, for many words at a time.

    A letter that is no piece itself stands for the pieces of its UTF-8 bytes.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        processor = SentencePieceProcessor(model_file=path)
        self.size = processor.get_piece_size()
        self.bytes = np.array([processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        children: dict[tuple[int, str], int] = {}
        ends = [-1]
        self.longest = 1
        for number in range(self.size):
            piece = processor.id_to_piece(number)
            letters = piece.removeprefix(_START)
            if processor.is_byte(number) or piece != piece.lower() or not (letters.isalpha() or piece == _START):
                continue
            node = 0
            for letter in piece:
                if (node, letter) not in children:
                    children[node, letter] = len(ends)
                    ends.append(-1)
                node = children[node, letter]
            ends[node] = number
            self.longest = max(self.longest, len(piece))
        letters = sorted({letter for _, letter in children})
        self._letters = np.zeros(0x110000, np.int32)
        self._letters[[ord(letter) for letter in letters]] = np.arange(1, len(letters) + 1)
        self._width = len(letters) + 1
        keys = np.array([node * self._width + int(self._letters[ord(c)]) for node, c in children], np.int64)
        order = np.argsort(keys)
        self._keys = keys[order]
        self._next = np.fromiter(children.values(), np.int64, len(children))[order]
        self._ends = np.array(ends, np.int32)

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``found[word, end, length]``: piece that ends there, or -1; the words' lengths; extra letters.

        Numbers from ``size`` on stand for the extra letters, which only bytes can spell.
        """
        longest = max(map(len, words))
        points = np.array(words, f"<U{longest}").view(np.uint32).reshape(len(words), longest)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        letters = self._letters[points]
        found = np.full((len(words), longest + 1, self.longest + 1), -1, np.int32)
        for start in range(longest):
            rows = np.flatnonzero(lengths > start)
            node = np.zeros(len(rows), np.int64)
            for length in range(1, min(self.longest, longest - start) + 1):
                key = node * self._width + letters[rows, start + length - 1]
                at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
                alive = self._keys[at] == key
                rows, node = rows[alive], self._next[at[alive]]
                if not len(rows):
                    break
                found[rows, start + length, length] = self._ends[node]
        bare = (found[:, 1:, 1] < 0) & (np.arange(longest) < lengths[:, None])
        extra, places = np.unique(points[bare], return_inverse=True)
        found[:, 1:, 1][bare] = self.size + places
        return found, lengths, extra

    def spelled(self, extra: np.ndarray) -> list[np.ndarray]:
        return [self.bytes[list(chr(point).encode("utf-8", "surrogatepass"))] for point in extra.tolist()]

    def extended(self, chances: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Rows for the extra letters, and a last row of zeros that number -1 reaches."""
        own = [chances[numbers].prod(axis=0) for numbers in self.spelled(extra)]
        return np.vstack([chances, *own, np.zeros((1, chances.shape[1]))])


def _vocabulary(path: str) -> Vocabulary:
    memory = worker_memory("language")
    if ("pieces", path) not in memory:
        memory["pieces", path] = Vocabulary(path)
    return memory["pieces", path]


def _forward(found: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Chance of each beginning of each word under each column of ``chances``."""
    alpha = np.zeros((found.shape[0], found.shape[1], chances.shape[1]))
    alpha[:, 0] = 1
    present = (found >= 0).any(axis=0)
    for end in range(1, found.shape[1]):
        for length in np.flatnonzero(present[end]).tolist():
            alpha[:, end] += alpha[:, end - length] * chances[found[:, end, length]]
    return alpha


def _log_forward(found: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """As :func:`_forward` in logarithms: slower, for words of any chance."""
    alpha = np.full((found.shape[0], found.shape[1], logs.shape[1]), -np.inf)
    alpha[:, 0] = 0
    present = (found >= 0).any(axis=0)
    for end in range(1, found.shape[1]):
        for length in np.flatnonzero(present[end]).tolist():
            alpha[:, end] = np.logaddexp(alpha[:, end], alpha[:, end - length] + logs[found[:, end, length]])
    return alpha


def _logs(table: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(table)


def _batches_by_length(words: list[str]) -> Iterator[np.ndarray]:
    order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
    for first in range(0, len(words), WORDS):
        yield order[first : first + WORDS]


def log_chances(words: list[str], vocabulary: Vocabulary, chances: np.ndarray) -> np.ndarray:
    """Log probability of each word (with its start mark) per column of ``chances``."""
    out = np.empty((len(words), chances.shape[1]))
    for rows in _batches_by_length(words):
        found, lengths, extra = vocabulary.edges([words[i] for i in rows.tolist()])
        table = vocabulary.extended(chances, extra)
        whole = _forward(found, table)[np.arange(len(rows)), lengths]
        out[rows] = _logs(whole)
        faint = np.flatnonzero((whole < _FAINT).any(axis=1))
        if len(faint):
            alpha = _log_forward(found[faint], _logs(table))
            out[rows[faint]] = alpha[np.arange(len(faint)), lengths[faint]]
    return out


def expected_counts(words: list[str], counts: np.ndarray, vocabulary: Vocabulary, chances: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words' segmentations, forward and backward."""
    total = np.zeros(vocabulary.size)
    for rows in _batches_by_length(words):
        found, lengths, extra = vocabulary.edges([words[i] for i in rows.tolist()])
        table = vocabulary.extended(chances[:, None], extra)
        alpha = _forward(found, table)[:, :, 0]
        whole = alpha[np.arange(len(rows)), lengths]
        faint = whole < _FAINT
        sums = np.zeros(len(table))
        if faint.any():
            sums += _log_expected(found[faint], lengths[faint], counts[rows[faint]], _logs(table))
            clear = ~faint
            found, lengths, alpha, whole, rows = found[clear], lengths[clear], alpha[clear], whole[clear], rows[clear]
        table = table[:, 0]
        beta = np.zeros_like(alpha)
        beta[np.arange(len(rows)), lengths] = counts[rows] / whole
        present = (found >= 0).any(axis=0)
        for end in range(found.shape[1] - 1, 0, -1):
            for length in np.flatnonzero(present[end]).tolist():
                piece = found[:, end, length]
                share = beta[:, end] * table[piece]
                beta[:, end - length] += share
                sums += np.bincount(piece % len(table), alpha[:, end - length] * share, len(table))
        total += sums[: vocabulary.size]
        for numbers, share in zip(vocabulary.spelled(extra), sums[vocabulary.size : -1], strict=True):
            np.add.at(total, numbers, share)
    return total


def _log_expected(found: np.ndarray, lengths: np.ndarray, counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Expected counts of the rows of ``logs``, one column, for words of any chance."""
    alpha = _log_forward(found, logs)[:, :, 0]
    whole = alpha[np.arange(len(found)), lengths]
    # A word that no segmentation can spell teaches nothing.
    spelt = np.isfinite(whole)
    found, lengths, counts, alpha, whole = found[spelt], lengths[spelt], counts[spelt], alpha[spelt], whole[spelt]
    logs = logs[:, 0]
    beta = np.full_like(alpha, -np.inf)
    beta[np.arange(len(found)), lengths] = -whole
    sums = np.zeros(len(logs))
    present = (found >= 0).any(axis=0)
    for end in range(found.shape[1] - 1, 0, -1):
        for length in np.flatnonzero(present[end]).tolist():
            piece = found[:, end, length]
            share = beta[:, end] + logs[piece]
            beta[:, end - length] = np.logaddexp(beta[:, end - length], share)
            sums += np.bincount(piece % len(logs), counts * np.exp(alpha[:, end - length] + share), len(logs))
    return sums


def _sums(logs: np.ndarray, indices: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the rows ``logs[indices[start:end]]`` of each text, for some ``SUMMED`` words at a time."""
    sums = np.empty((len(bounds) - 1, logs.shape[1]))
    first = 0
    while first < len(sums):
        # One text at least, however long.
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SUMMED, "right")) - 1)
        own = logs[indices[bounds[first] : bounds[last]]]
        sums[first:last] = np.add.reduceat(own, bounds[first:last] - bounds[first], axis=0)
        first = last
    return sums


def _word_lists(texts: pa.Array) -> pa.Array:
    """Runs of letters in lower case, cut every ``LONGEST`` letters, for each text."""
    letters = pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.large_string())), r"[^\pL]+", " ")
    longer = pc.match_substring_regex(letters, rf"\pL{{{LONGEST}}}\pL")
    if pc.any(longer).as_py():
        cut = pc.replace_substring_regex(letters, rf"(\pL{{{LONGEST}}})", r"\1 ")
        letters = pc.if_else(longer, cut, letters)
    return pc.ascii_split_whitespace(letters)


@dataclass(frozen=True)
class LanguageModel:
    """Piece probabilities, one column per language, over a vocabulary file all executors can read."""

    languages: tuple[str, ...]
    chances: np.ndarray
    path: str


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``n`` over frames of ``lang`` and ``body``, summed in each piece first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "body", PIECE_BYTES):
            langs = piece.column("lang").dictionary_encode()
            lists = _word_lists(piece.column("body"))
            words = pc.list_flatten(lists).dictionary_encode()
            of_word = np.repeat(langs.indices.to_numpy().astype(np.int64), pc.list_value_length(lists).to_numpy())
            width = max(1, len(words.dictionary))
            pairs, n = np.unique(of_word * width + words.indices.to_numpy(), return_counts=True)
            for first in range(0, len(pairs), 50_000):
                some = pairs[first : first + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.dictionary.take(pa.array(some // width)).cast(pa.string()),
                        words.dictionary.take(pa.array(some % width)).cast(pa.string()),
                        pa.array(n[first : first + 50_000]),
                    ],
                    ["lang", "word", "n"],
                )

    counted = docs.mapInArrow(count, "lang string, word string, n bigint").where("word <> ''")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(
    labelled: DataFrame,
    *,
    path: str,
    text: str = "text",
    lang: str = "lang",
    train_docs: int = 8000,
    rounds: int = 4,
    smoothing: float = 0.05,
    most_languages: int = 500,
) -> LanguageModel | None:
    """Learn each language's piece probabilities by expectation maximisation.

    ``train_docs`` bounds the expected number of documents a language learns from: rows are
    chosen by a hash of their text. Their word counts are a table; each round sums the
    expected piece counts of all its words. The model, vocabulary times languages, is all
    that reaches the driver; more than ``most_languages`` languages are refused.

    Null texts and null languages teach nothing. Without any labelled word: None.
    """
    spark = labelled.sparkSession
    rows = carried(labelled, lang=lang, body=text).select("lang", "body").dropna()
    # One row per language: a small written table, so that the join moves no text.
    sizes = settle(rows.groupBy("lang").agg(F.count("*").alias("documents")))
    share = F.pmod(F.xxhash64("body"), F.lit(1 << 20)) * F.col("documents") < F.lit(train_docs << 20)
    chosen = rows.join(sizes, "lang").where(share).select("lang", "body")
    counts = settle(word_counts(chosen))
    languages = [r.lang for r in counts.select("lang").distinct().limit(most_languages + 1).collect()]
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not languages:
        return None
    languages.sort()
    column = {name: i for i, name in enumerate(languages)}
    vocabulary = _vocabulary(path)
    chances = np.full((vocabulary.size, len(languages)), 1 / vocabulary.size)
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(chances)

        def expect(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            pieces_of = _vocabulary(path)
            total = np.zeros(model.value.shape)
            for batch in batches:
                langs = np.array(batch.column("lang").to_pylist())
                words = np.array([_START + word for word in batch.column("word").to_pylist()], object)
                n = batch.column("n").to_numpy().astype(float)
                for name in np.unique(langs).tolist():
                    own, at = langs == name, column[name]
                    total[:, at] += expected_counts(list(words[own]), n[own], pieces_of, model.value[:, at])
            piece, at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(at), pa.array(total[piece, at])], ["piece", "at", "expected"]
            )

        sums = counts.mapInArrow(expect, "piece bigint, at bigint, expected double")
        table = sums.groupBy("piece", "at").agg(F.sum("expected").alias("expected")).toPandas()
        seen = np.zeros_like(chances)
        seen[table["piece"], table["at"]] = table["expected"]
        chances = (seen + smoothing) / (seen + smoothing).sum(axis=0)
        model.unpersist()
    return LanguageModel(tuple(languages), chances, path)


def predict(docs: DataFrame, model: LanguageModel | None, *, text: str = "text", **keep: str | Column) -> DataFrame:
    """Most probable language of every whole text, with its posterior probability.

    Each text is scored by the words in it, each distinct word once per piece of the
    input, and languages are equally likely beforehand. Returns the columns ``keep`` names,
    ``lang_pred`` and ``score``. A text that is null or has no letter, and any text without
    a model, is ``und`` with score 0. Equal scores give the first language by name. Rows may
    repeat; an empty table gives an empty result.
    """
    rows = carried(docs, **keep, body=F.coalesce(F.col(text), F.lit(""))).drop("row")
    if model is None:
        return rows.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    names = np.array([*model.languages, UNKNOWN], object)
    shared = rows.sparkSession.sparkContext.broadcast(model.chances)
    path = model.path
    schema = rows.drop("body").schema.add("lang_pred", "string").add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for piece in pieces(batches, "body", PIECE_BYTES):
            lists = _word_lists(piece.column("body"))
            words = pc.list_flatten(lists).dictionary_encode()
            distinct = [_START + word if word else "" for word in words.dictionary.to_pylist()]
            logs = np.zeros((len(distinct), shared.value.shape[1]))
            real = [i for i, word in enumerate(distinct) if word]
            if real:
                logs[real] = log_chances([distinct[i] for i in real], vocabulary, shared.value)
            indices = words.indices.to_numpy()
            bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
            filled = np.array([bool(word) for word in distinct], np.int64)[indices]
            n_words = np.diff(np.concatenate([[0], np.cumsum(filled)])[bounds])
            # Every text gives at least one word, the empty one, so that no slice is empty.
            sums = _sums(logs, indices, bounds)
            best = sums.argmax(axis=1)
            posterior = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            none = n_words == 0
            best[none], posterior[none] = len(names) - 1, 0.0
            columns = [piece.column(name) for name in piece.schema.names if name != "body"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names[best], pa.string()), pa.array(posterior)], schema.names
            )

    return rows.mapInArrow(score, schema)
