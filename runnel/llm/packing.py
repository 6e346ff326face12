"""Packing examples into sequences: vector bin packing by the dot-product heuristic.

A bin (sequence) has room for a number of tokens, of segments and of loss-bearing tokens. Bins are filled one
after another: of the examples that fit in all three, the one whose demand has the largest dot product with the
room that is left, both as shares of the limits, goes in next. Where examples may be cut, what no example fits
is filled with the first tokens of the one with the largest product, and its rest waits for another bin. Which
tokens bear loss is told by a mask per example; without one all do, and loss is a dimension only in name.

A task packs the examples of its own partition, WINDOW at a time, and what is left of a window goes on to the
next, so nothing is shuffled, memory is bounded, and a lost task is done again with the same outcome.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.llm.chunk_tokenizer import TOKENIZERS, tokenizer
from runnel.llm.text_arrays import pieces, strings, tidy, utf8

WINDOW = 2048
#: Bytes of text that a Python worker packs at once, and of these that it encodes at once.
PIECE, SLICE = 2 << 20, 1 << 19
#: sequence_id = partition * SEQUENCES + number in the partition.
SEQUENCES = 1 << 36


def fill_bin(
    tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int], cut: bool, bears: list[np.ndarray] | None = None
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """One bin out of the examples: [(example, tokens of it)], and which examples are still there.

    ``tokens`` and ``loss`` lose what goes in; only the last example of the bin can go in in part. ``bears`` has the
    masks of the examples, of which the last ``tokens`` are still to be placed; without it the first tokens bear loss.
    """
    most = np.array(limits, float)
    room = most.copy()
    here = tokens > 0
    out: list[tuple[int, int]] = []
    demand = np.stack([tokens, np.ones(len(tokens)), loss]) / most[:, None]
    while room[0] >= 1 and room[1] >= 1 and here.any():
        score = (room / most) @ demand
        paid = None
        fits = here & (tokens <= room[0]) & (loss <= room[2])
        if fits.any():
            i = int(np.argmax(np.where(fits, score, -1.0)))
            take = int(tokens[i])
        elif cut:
            i = int(np.argmax(np.where(here, score, -1.0)))
            if bears is None:
                take = int(min(room[0], room[2] if loss[i] else room[0]))
            else:
                upto = np.cumsum(bears[i][len(bears[i]) - tokens[i] :][: int(room[0])])
                take = int(np.searchsorted(upto, room[2], side="right"))
                paid = int(upto[take - 1]) if take else 0
            if take < 1:
                break
        else:
            break
        out.append((i, take))
        paid = min(int(loss[i]), take) if paid is None else paid
        room -= (take, 1, paid)
        tokens[i] -= take
        loss[i] -= paid
        here[i] = tokens[i] > 0
        if here[i]:
            break
    return out, here


def powers(n: int) -> list[int]:
    """n as a sum of powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Pieces of one partition. An example is (key, start, ids, bears) of the ids that are still to be placed.

    ``bears`` tells which ids bear loss; all do if it is None, which is so for all examples or none.
    """

    def __init__(self, first_sequence: int, limits: tuple[int, int, int]):
        self.next, self.limits = first_sequence, limits
        self.waiting: list[tuple[int, int, np.ndarray, np.ndarray | None]] = []
        self.rows: list[tuple] = []

    def put(self, parts: list[tuple[int, int, np.ndarray]]) -> None:
        """Write one sequence, or, if it is neither full nor a power of two long, several that are."""
        n = sum(len(p[2]) for p in parts)
        lengths = [n] if n == self.limits[0] else powers(n)
        i, used = 0, 0
        for length in lengths:
            offset = 0
            while offset < length:
                key, start, ids = parts[i]
                ids = ids[used : used + length - offset]
                self.rows.append((key, start + used, len(ids), zlib.crc32(ids), self.next, offset))
                offset += len(ids)
                used += len(ids)
                if used == len(parts[i][2]):
                    i, used = i + 1, 0
            self.next += 1

    def add(self, key: int, ids: np.ndarray, bears: np.ndarray | None = None) -> None:
        """Whole sequences of an example are cut off while their loss fits; what is left waits to be packed."""
        size, n, at = self.limits[0], len(ids), 0
        while n - at >= size and (size if bears is None else bears[at : at + size].sum()) <= self.limits[2]:
            self.rows.append((key, at, size, zlib.crc32(ids[at : at + size]), self.next, 0))
            self.next += 1
            at += size
        if n > at:
            self.waiting.append((key, at, ids[at:], None if bears is None else bears[at:]))
            if len(self.waiting) >= WINDOW:
                self.pack(size)

    def pack(self, keep_below: int) -> None:
        """Fill bins until what waits has fewer than ``keep_below`` tokens."""
        tokens = np.array([len(w[2]) for w in self.waiting], np.int64)
        masks = [w[3] for w in self.waiting]
        bears = masks if masks and masks[0] is not None else None
        loss = tokens.copy() if bears is None else np.array([m.sum() for m in bears], np.int64)
        done = np.zeros(len(tokens), np.int64)
        while tokens.sum() >= max(1, keep_below):
            placed, _ = fill_bin(tokens, loss, self.limits, True, bears)
            parts = []
            for i, take in placed:
                key, start, ids, _ = self.waiting[i]
                parts.append((key, start + int(done[i]), ids[done[i] : done[i] + take]))
                done[i] += take
            self.put(parts)
        self.waiting = [
            (k, s + int(d), ids[d:].copy(), None if m is None else m[d:].copy())
            for (k, s, ids, m), d in zip(self.waiting, done, strict=True)
            if d < len(ids)
        ]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _encode_spans(path: str, texts: pa.Array, spans: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, their number in each text, and which bear loss, with a place for each text's end id."""
    data, _ = utf8(texts)
    parts = spans.flatten()
    flag = parts.field("loss").to_numpy(zero_copy_only=False).astype(bool)
    size = parts.field("size").to_numpy().astype(np.int64)
    ids, counts = tokenizer(path).encode(strings(data, np.r_[0, np.cumsum(size)]))
    last = np.cumsum(spans.value_lengths().to_numpy().astype(np.int64))
    ends = np.r_[0, np.cumsum(counts)][last]
    some = np.diff(last, prepend=0) > 0
    end_bears = np.zeros(len(last), bool)
    end_bears[some] = flag[last[some] - 1]
    return ids, np.diff(ends, prepend=0), np.insert(np.repeat(flag, counts), ends, end_bears)


def _pack_documents(path: str, end_id: int, limits: tuple[int, int, int]):
    @functools.partial(tidy, keeps=TOKENIZERS)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() * SEQUENCES, limits)
        known: dict[int, tuple] = {}  # of examples that still wait
        count = 0

        def out() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            key, start, length, crc, sequence, offset = zip(*rows, strict=True) if rows else ((),) * 6
            columns = [[known[k][0] for k in key], start, length, crc, [known[k][1] for k in key], sequence, offset]
            waits = {w[0] for w in packer.waiting}
            for k in [k for k in known if k not in waits]:
                del known[k]
            names = [c.split()[0] for c in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in pieces(batches, PIECE):
            if "spans" in batch.schema.names:
                ids, counts, bears = _encode_spans(path, batch["text"], batch["spans"])
            else:
                parts = [tokenizer(path).encode(some["text"]) for some in pieces(iter([batch]), SLICE)]
                (ids, counts), bears = map(np.concatenate, zip(*parts, strict=True)), None
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype("<u4")
            ends = ends + np.arange(1, len(ends) + 1)
            for doc, n, end in zip(batch["doc_id"].to_pylist(), (counts + 1).tolist(), ends.tolist(), strict=True):
                known[count] = (doc, n)
                packer.add(count, ids[end - n : end], None if bears is None else bears[end - n : end])
                count += 1
            packer.pack(limits[0])
            yield out()
        packer.pack(0)
        yield out()

    return run


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    end_id: int = 0,
    max_tokens: int = 1024,
    max_segments: int = 64,
    max_loss_tokens: int = 1024,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text and ``end_id``; all bear loss. Documents are cut freely: whole
    sequences first, then the rests are packed as vectors. A sequence that would be neither full nor a power of two
    long is parted into such, so no sequence is padded.

    Null text is empty (the end id alone). Rows that repeat a doc_id, or have none, are documents of their own. An
    empty table gives no rows; other columns are not read. max_tokens must be a power of two, at least 1.
    """
    limits = _limits(max_tokens, max_segments, max_loss_tokens)
    return documents.select("doc_id", "text").mapInArrow(_pack_documents(tokenizer_path, end_id, limits), PIECES)


def pack_examples(
    examples: DataFrame,
    tokenizer_path: str,
    end_id: int = 0,
    max_tokens: int = 1024,
    max_segments: int = 64,
    max_loss_tokens: int = 1024,
) -> DataFrame:
    """As pack_documents, for examples (doc_id, parts) of which not all tokens bear loss.

    ``parts`` is an array of structs (text, loss), such as the turns of op3 with loss where the role is assistant. Ids
    are those of each part's text by itself, then ``end_id``, which bears loss if the last part does. Null loss is
    false, null text empty. No sequence holds more than max_loss_tokens tokens that bear loss.
    """
    limits = _limits(max_tokens, max_segments, max_loss_tokens)
    parts = F.coalesce("parts", F.expr("array(named_struct('text', '', 'loss', false))"))
    rows = examples.select("doc_id", parts.alias("parts")).select(
        "doc_id",
        F.array_join(F.transform("parts", lambda p: F.coalesce(p["text"], F.lit(""))), "").alias("text"),
        F.transform(
            "parts",
            lambda p: F.struct(
                F.coalesce(F.octet_length(p["text"]), F.lit(0)).alias("size"), F.coalesce(p["loss"], F.lit(False)).alias("loss")
            ),
        ).alias("spans"),
    )
    return rows.mapInArrow(_pack_documents(tokenizer_path, end_id, limits), PIECES)


def _limits(max_tokens: int, max_segments: int, max_loss_tokens: int) -> tuple[int, int, int]:
    if max_tokens < 1 or max_tokens & (max_tokens - 1) or max_segments < 1 or max_loss_tokens < 1:
        raise ValueError("max_tokens must be a power of two, the other limits 1 at least")
    return max_tokens, max_segments, max_loss_tokens


def op10_pack(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
