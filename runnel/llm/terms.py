"""Terms of Arrow text columns for the corpus statistics: classes of ASCII bytes, A-Z lower-cased, all else unchanged."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from runnel.llm.text_arrays import utf8, words

DIGITS, LETTERS = range(0x30, 0x3A), range(0x61, 0x7B)


def folding(*inside: range) -> np.ndarray:
    """What each byte becomes: A-Z small, bytes of longer UTF-8 characters and ``inside`` as they are, all others a space."""
    table = np.full(256, 0x20, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    for part in inside:
        table[list(part)] = list(part)
    table[0x41:0x5B] = table[0x61:0x7B]
    return table


#: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` and ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
LETTER_TERMS, WORD_TERMS = folding(LETTERS), folding(DIGITS, LETTERS)


def folded(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts with every separator a space, and the offsets of each text; null is empty."""
    data, offsets = utf8(texts)
    return table[data], offsets


def coded(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms, the number of each term in turn, and the number of terms before each text."""
    all_terms, bounds = words(data, offsets)
    terms = all_terms.dictionary_encode()
    return terms.dictionary, terms.indices.to_numpy(), bounds


def distinct_pairs(owner: np.ndarray, code: np.ndarray, n_codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (owner, code) and how often each occurs, in the order of their first occurrence."""
    found = pa.array(owner.astype(np.int64) * n_codes + code).dictionary_encode()
    both = found.dictionary.to_numpy()
    return both // max(n_codes, 1), both % max(n_codes, 1), np.bincount(found.indices.to_numpy(), minlength=len(both))


def piece_ids() -> Iterator[int]:
    """Numbers of the pieces that a task makes, unlike those of all other tasks of its stage, of 43 digits at most."""
    first = TaskContext.get().partitionId() << 22
    while True:
        yield first
        first += 1
