"""Word hashes and shingle sets of Arrow text columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from runnel.llm.text_arrays import utf8, words


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes, those of longer UTF-8 characters among them, stay."""
    out = data.copy()
    out[(out >= 65) & (out <= 90)] += 32
    return out


def word_codes(texts: pa.Array, lower: bool = False) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words, the number of each word in turn, and the number of words before each text."""
    data, offsets = utf8(texts)
    all_words, bounds = words(lower_ascii(data) if lower else data, offsets)
    coded = all_words.dictionary_encode()
    return coded.dictionary.cast(pa.large_binary()).to_pylist(), coded.indices.to_numpy(), bounds


def word_hashes(distinct: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in distinct), np.uint64, len(distinct))


def factors(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text as sorted 64-bit hashes, one text after another, and the bounds.

    Words are lower-cased in A-Z. A text of fewer than k words has its whole sequence as its only shingle.
    """
    distinct, code, bounds = word_codes(texts, lower=True)
    h = word_hashes(distinct)[code] if len(code) else np.zeros(0, np.uint64)
    by = factors(k, 11)
    runs = sum((h[j : len(h) - k + 1 + j] * by[j] for j in range(k)), np.zeros(max(0, len(h) - k + 1), np.uint64))
    runs = mix(runs)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        elif b > a:
            out.append(mix(np.array([(h[a:b] * by[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    ends = np.cumsum([0, *map(len, out)])
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), ends
