"""Arrow text columns as flat byte and word arrays."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The white space of the word rule ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def pieces(batches: Iterator[pa.RecordBatch], most_bytes: int = 8 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches, cut into runs of rows whose text comes to about ``most_bytes`` (or one longer row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.binary_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(first, last - first)
            first = last


#: What a worker remembers between tasks: by its name, a function that forgets it.
REMEMBERED: dict[str, Callable[[], None]] = {}


def _give_back() -> None:
    """What has been freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over batches that gives what it has freed back to the system at the end of its task.

    Workers live on between tasks and stages; what their allocators keep would count against the tasks that follow. So would
    what they remember: a task begins by forgetting all of it but what it ``keeps`` itself.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = [forget for name, forget in REMEMBERED.items() if name != keeps]
        for forget in others:
            forget()
        if others:
            _give_back()
        yield from run(batches)
        _give_back()

    return wrapped


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the offsets of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.LargeStringArray:
    """Strings that lie one after another in ``data``."""
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All words of all texts, and the number of words before each text (one more entry than texts)."""
    space = SPACE[data]
    start = ~space
    start[1:] &= space[:-1] | False
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = ~space[first]
    begins = np.flatnonzero(start)
    kept = np.cumsum(~space)
    at = np.r_[kept[begins] - 1, kept[-1] if len(kept) else 0]
    bounds = np.searchsorted(begins, offsets)
    return strings(data[~space], at), bounds


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + lengths[i]] for all i, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
