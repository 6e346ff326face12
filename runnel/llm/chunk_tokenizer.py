"""Whole texts to ids of a public BPE tokenizer, each distinct piece encoded once a worker.

A text is cut where white space follows a character that is no white space. Byte-level and word-level BPE
tokenizers never join characters over such a place, so the ids of a text are those of its chunks in order.

A chunk of Latin letters, ASCII digits and most ASCII signs is parted into the pieces of the tokenizer's own pattern
(runs of letters, of digits, of signs) on its bytes, all chunks of a batch at once. Other chunks stay whole. Pieces and
chunks are made distinct by Arrow; those that this worker has not met are encoded by the library: its model encodes
pieces, and a chunk is split by the pattern first, or encoded as a text where the pattern route does not cover it and
where it holds an added token ("<|endoftext|>"), which gets its own id as in the library's default setting.
"""

from __future__ import annotations

import itertools
import json
import os

import numpy as np
import pyarrow as pa
import regex

from runnel.llm.text_arrays import REMEMBERED, SPACE, gather, strings, utf8

#: Bytes of pieces that a worker remembers, each counted with PIECE_COST more than its text; beyond it, those that only one
#: batch has used are forgotten, or all if that frees less than half.
MOST_BYTES, PIECE_COST = 112 << 20, 200

# Fixed value: the split pattern of byte-level tokenizers that name none.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters for which lower case and NFC are one character each, whatever stands beside them.
PLAIN = regex.compile("[\x21-\x7e\xc0-\xff\x09-\x0d ]*")
SPACES = regex.compile(r"\s")
#: Byte-level vocabularies write a byte as one printable character: itself, or the next one from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
PRINTED = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}

#: Kinds of bytes: white space, letters, digits, signs, and what leaves a chunk whole (an apostrophe may begin a piece).
BLANK, LETTER, DIGIT, SIGN, OTHER = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[33:127] = SIGN
KIND[48:58] = DIGIT
KIND[[*range(65, 91), *range(97, 123)]] = LETTER
KIND[SPACE] = BLANK
KIND[ord("'")] = OTHER

#: The name under which a worker's tokenizers are remembered between tasks.
TOKENIZERS = "tokenizers"
_loaded: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """One for each worker process and vocabulary, until a task of another kind runs there."""
    if path not in _loaded:
        _loaded[path] = ChunkTokenizer(path)
        REMEMBERED[TOKENIZERS] = _loaded.clear
    return _loaded[path]


class ChunkTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model.tokenize
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = [t["content"] for t in spec["added_tokens"]]
        odd = [t["content"] for t in spec["added_tokens"] if t["normalized"] or t["lstrip"] or t["rstrip"] or SPACES.search(t["content"])]
        if odd:
            raise ValueError(f"added tokens that may reach over chunks or stand in other letters: {odd}")
        self.added = regex.compile("|".join(map(regex.escape, added)) or r"(?!)").search
        normal = json.dumps(spec["normalizer"])
        self.lower, self.normalizes = "Lowercase" in normal, spec["normalizer"] is not None
        split = json.dumps(spec["pre_tokenizer"])
        if spec["model"]["type"] != "BPE" or '"ByteLevel"' not in split or '"add_prefix_space": true' in split:
            raise ValueError(f"not a byte-level BPE without a leading space: {path}")
        pattern = regex.search(r'"Regex": ("(?:[^"\\]|\\.)*")', split)
        self.pattern = regex.compile(json.loads(pattern[1]) if pattern else BYTE_LEVEL)
        self.kind = KIND.copy()
        self.kind[[ord(t[0]) for t in added if ord(t[0]) < 128]] = OTHER
        # The byte route is for the two patterns whose pieces it makes.
        self.drops_blanks = self._pieces("ab,12 c..") == ["ab", ",", "1", "2", "c", ".."]
        self.by_bytes = self.drops_blanks or not self.normalizes and self._pieces("ab,12 c..") == ["ab", ",", "12", " c", ".."]
        self.forget()

    def _pieces(self, chunk: str) -> list[str]:
        return self.pattern.findall(chunk)

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.uses = np.zeros(1 << 14, np.uint32)

    def _shrink(self) -> None:
        """Forget the pieces that one batch alone has used."""
        old = [p for p, u in zip(self.known, self.uses[: len(self.known)].tolist(), strict=True) if u > 1]  # in the order of places
        kept = np.flatnonzero(self.uses[: len(self.known)] > 1)
        flat, start, length = self.flat, self.start[kept], self.length[kept]
        self.forget()
        if sum(map(len, old)) + PIECE_COST * len(old) + 4 * int(length.sum()) < MOST_BYTES // 2:
            self._remember(old, gather(flat, start, length), length)
            self.uses[: len(old)] = 1

    def _split(self, chunk: str) -> list[str] | None:
        """Pieces of a chunk by the pattern, None where the library must see the chunk as a text."""
        if self.added(chunk) or self.normalizes and not PLAIN.fullmatch(chunk):
            return None
        return self._pieces(chunk.lower() if self.lower else chunk)

    def _model(self, piece: str) -> list[int]:
        bare = piece.removeprefix(" ")
        text = bare if bare.isascii() and bare.isalnum() else bare.encode().decode("latin-1").translate(PRINTED)
        return [t.id for t in self.model(text if bare is piece else PRINTED[0x20] + text)]

    def _learn(self, new: list[str], whole: list[bool]) -> None:
        """Remember the ids of new pieces, and of chunks that were left whole."""
        encode = self._model
        split = [self._split(text) if chunk else [text] for text, chunk in zip(new, whole, strict=True)]
        texts = [text for text, pieces in zip(new, split, strict=True) if pieces is None]
        asked = (e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False))
        ids = [next(asked) if s is None else encode(s[0]) if len(s) == 1 else [i for p in s for i in encode(p)] for s in split]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self._remember(new, np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(lengths.sum())), lengths)

    def _remember(self, new: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        n, k = len(self.known), len(new)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + k > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[n : n + k] = self.used + np.cumsum(lengths) - lengths
        self.length[n : n + k] = lengths
        self.used += len(flat)
        self.known.update(zip(new, range(n, n + k), strict=True))
        self.held += sum(map(len, new)) + PIECE_COST * k + flat.nbytes

    def _places(self, distinct: list[str], whole: np.ndarray) -> np.ndarray:
        """Which of the remembered pieces and chunks each of these is."""
        if self.held > MOST_BYTES:
            self._shrink()
        known = self.known
        at = [i for i, c in enumerate(distinct) if c not in known]
        for i in range(0, len(at), 20_000):
            some = at[i : i + 20_000]
            self._learn([distinct[j] for j in some], whole[some].tolist())
        place = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        self.uses[place] += 1
        return place

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        """The bytes, in lower case where that is what the tokenizer does; and of each byte: whether a piece or whole chunk
        begins there, whether it lies in a chunk that is parted, and whether it is kept (all are if None)."""
        n = len(data)
        space = SPACE[data]
        cut = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        # White space outside ASCII (or a control that may be taken for it) before a place: no cut there.
        a, b, c = data[cut - 1], data[np.maximum(cut - 2, 0)], data[np.maximum(cut - 3, 0)]
        odd = (a >= 0x1C) & (a <= 0x1F) | (b == 0xC2) & ((a == 0x85) | (a == 0xA0))
        odd |= (c == 0xE1) & (b == 0x9A) | (c == 0xE2) & ((b == 0x80) | (b == 0x81)) | (c == 0xE3) & (b == 0x80)
        here = np.zeros(n, bool)
        here[cut[~odd]] = True
        here[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        cut = np.flatnonzero(here)
        if not self.by_bytes:
            return data, here, np.zeros(n, bool), None
        kind = self.kind[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF, letters but for two
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
        whole = np.maximum.reduceat(kind, cut) == OTHER
        size = np.diff(cut, append=n)
        begin, before = here.copy(), np.r_[kind[:1], kind[:-1]]
        if self.drops_blanks:
            whole |= np.maximum.reduceat(kind, cut) == BLANK
            plain = ~np.repeat(whole, size)
            keep = ~plain | (kind != BLANK)
            begin |= (kind != before) | (kind == DIGIT)
            begin &= keep & plain | here
            begin[cut[~whole]] &= keep[cut[~whole]]
            if self.lower:
                data = data.copy()
                data[plain & (data >= 65) & (data <= 90)] += 32
                lead = lead[plain[lead] & (data[lead + 1] <= 0x9E)]
                data[lead + 1] += 0x20
        else:
            first = kind[cut] == BLANK
            whole |= first & ((data[cut] != 0x20) | (size == 1) | (kind[np.minimum(cut + 1, n - 1)] == BLANK))
            plain = ~np.repeat(whole, size)
            keep = None
            begin |= (kind != before) & (before != BLANK) & plain
        return data, begin, plain, keep

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """int32 ids of all texts one after another, and the number of ids of each text; null is empty."""
        data, offsets = utf8(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        data, begin, plain, keep = self._cut(data, offsets)
        at = np.flatnonzero(begin)
        bounds = np.r_[at, len(data)]
        if keep is not None:
            bounds = np.r_[np.cumsum(keep, dtype=np.int32)[at] - 1, np.count_nonzero(keep)]
            data = data[keep]
        coded = strings(data, bounds).dictionary_encode()
        code = coded.indices.to_numpy()
        whole = np.zeros(len(coded.dictionary), bool)
        whole[code[~plain[at]]] = True
        place = self._places(coded.dictionary.to_pylist(), whole)[code]
        lengths = self.length[place]
        upto = np.r_[0, np.cumsum(lengths)]
        return gather(self.flat, self.start[place], lengths), np.diff(upto[np.searchsorted(at, offsets)])
