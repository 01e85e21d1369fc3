"""Helpers of the functions that run inside Python tasks."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard


def worker_memory(owner: str) -> dict:
    """A dictionary that lives as long as the Python worker process, which Spark reuses for many tasks.

    Only for what can be made again, such as a loaded vocabulary. It belongs to one operator
    at a time: another ``owner`` finds it empty, so that the stages of a pipeline do not add
    up in a worker.
    """
    memory = sys.modules.setdefault("_retinue_worker", ModuleType("_retinue_worker")).__dict__
    if memory.get("owner") != owner:
        for name in [n for n in memory if not (isinstance(n, str) and n.startswith("__"))]:
            del memory[name]
        memory["owner"] = owner
        shrink()
    return memory


def pieces(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the strings of ``column`` take about ``most_bytes`` at most.

    A single longer value is a piece of its own. The cuts depend on the batch alone.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        before = np.cumsum(lengths, dtype=np.int64) - lengths
        marks = before // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)
                release()
    shrink()


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes))


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``range(start, start + length)``."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[start : start + length]`` side by side, with little memory beside the result."""
    out = np.empty(int(lengths.sum()), values.dtype)
    done = 0
    for first in range(0, len(starts), 1 << 18):
        part = spans(starts[first : first + (1 << 18)], lengths[first : first + (1 << 18)])
        np.take(values, part, out=out[done : done + len(part)])
        done += len(part)
    return out


def release() -> None:
    """Give memory that Arrow keeps for later back to the system: several workers share a machine."""
    pa.default_memory_pool().release_unused()


def shrink() -> None:
    """As :func:`release`, for what Python and the C library keep too.

    Spark hands out its idle workers in turn, so each of them keeps what one task has left.
    """
    gc.collect()
    release()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def list_pieces(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """As :func:`pieces`, for a column of lists and the number of their elements."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)
        marks = (np.cumsum(lengths) - lengths) // most
        cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)
