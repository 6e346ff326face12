"""Token files: ids entropy-coded by a static range asymmetric numeral system (rANS).

A file set is a Parquet table of segments in ascending doc_id order. A segment holds whole documents, about
SEGMENT_TOKENS ids, and one frequency table, counted over all its ids and shared by all its blocks. A block is
BLOCK_TOKENS ids dealt in turn to LANES lanes, each lane a rANS stream of its own (64-bit state, 32-bit words),
so blocks decode apart from each other and the lanes of many blocks decode together, one vector step an id.

Checkpoints of a block: the first id it holds (block number times BLOCK_TOKENS), its lanes' end states, and the
number of words of each lane, whose running sum says where its words lie. Its checksum is the CRC-32 of its ids
(little-endian, 32 bits each), compared when it is decoded.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runnel.llm.chunk_tokenizer import TOKENIZERS, tokenizer
from runnel.llm.storage import new_path
from runnel.llm.text_arrays import pieces, tidy

SEGMENT_TOKENS, BLOCK_TOKENS, LANES = 4 << 20, 1 << 15, 64
SCALE, LOW = 18, np.uint64(1 << 31)
#: Bytes of text that a Python worker encodes at once.
PIECE = 4 << 20

SEGMENTS = (
    "shard int, segment int, n_tokens long, doc_ids array<long>, doc_tokens array<int>, table binary, "
    "states binary, lane_words binary, words binary, block_crc32 array<long>"
)
_SEGMENTS_ARROW = pa.schema(
    [("shard", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
    + [("doc_tokens", pa.list_(pa.int32()))]
    + [(c, pa.binary()) for c in ("table", "states", "lane_words", "words")]
    + [("block_crc32", pa.list_(pa.int64()))]
)


def frequency_table(ids: np.ndarray, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur, ascending, and frequencies of 1 at least that add up to 2**scale."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    if len(symbols) > 1 << scale:
        raise ValueError(f"{len(symbols)} distinct ids do not fit a table of {1 << scale}")
    freq = np.maximum(1, counts[symbols] * (1 << scale) // counts.sum())
    excess = int(freq.sum()) - (1 << scale)
    largest = np.argsort(-freq, kind="stable")
    if excess < 0:
        freq[largest[0]] -= excess
    while excess > 0:
        take = largest[freq[largest] > 1][:excess]
        freq[take] -= 1
        excess -= len(take)
    return symbols, freq


def _active(n: int, lanes: int, step: int) -> int:
    """How many lanes, from the first, have an id at this step; only the last block can be short."""
    full, rest = divmod(n, BLOCK_TOKENS)
    return min(lanes, full * LANES + min(LANES, max(0, rest - step * LANES)))


def _shape(n: int) -> tuple[int, int]:
    blocks = -(-n // BLOCK_TOKENS)
    return blocks * LANES, min(BLOCK_TOKENS // LANES, -(-n // LANES)) if blocks == 1 else BLOCK_TOKENS // LANES


def encode_ids(ids: np.ndarray) -> dict:
    """table, states, lane_words, words and block_crc32 of a segment's ids."""
    n = len(ids)
    if not n:
        return {"table": b"", "states": b"", "lane_words": b"", "words": b"", "block_crc32": []}
    symbols, freq = frequency_table(ids)
    index = np.zeros(int(symbols[-1]) + 1, np.int32)
    index[symbols] = np.arange(len(symbols))
    f64, cum = freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64)
    lanes, steps = _shape(n)
    per = BLOCK_TOKENS // LANES
    grid = np.zeros(lanes * per, np.int32)
    grid[:n] = index[ids]
    grid = grid.reshape(-1, per, LANES).transpose(1, 0, 2).reshape(per, lanes)
    x = np.full(lanes, LOW, np.uint64)
    held = np.zeros((lanes, per * SCALE // 32 + 2), np.uint32)
    count = np.zeros(lanes, np.int64)
    s32, scale = np.uint64(32), np.uint64(SCALE)
    room = np.uint64(63 - SCALE)
    for step in range(steps - 1, -1, -1):
        a = _active(n, lanes, step)
        code = grid[step, :a]
        f, v = f64[code], x[:a]
        out = np.flatnonzero(v >= f << room)
        if len(out):
            held[out, count[out]] = v[out] & np.uint64(0xFFFFFFFF)
            count[out] += 1
            v[out] >>= s32
        q = v // f
        x[:a] = (q << scale) + (v - q * f) + cum[code]
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6)
    raw = ids.astype("<u4")
    return {
        "table": table,
        "states": x.astype("<u8").tobytes(),
        "lane_words": count.astype("<u2").tobytes(),
        "words": held[np.arange(held.shape[1]) < count[:, None]].astype("<u4").tobytes(),
        "block_crc32": [zlib.crc32(raw[i : i + BLOCK_TOKENS]) for i in range(0, n, BLOCK_TOKENS)],
    }


def decode_ids(row: dict, first_block: int = 0, n_blocks: int | None = None) -> np.ndarray:
    """Ids of blocks ``first_block`` and following of a segment; raises ValueError where a checksum differs."""
    total = row["n_tokens"]
    blocks = -(-total // BLOCK_TOKENS)
    last = blocks if n_blocks is None else min(blocks, first_block + n_blocks)
    n = min(total, last * BLOCK_TOKENS) - first_block * BLOCK_TOKENS
    if n <= 0:
        return np.zeros(0, np.uint32)
    table = np.frombuffer(zlib.decompress(row["table"]), "<u4")
    symbols, freq = np.cumsum(table[: len(table) // 2], dtype=np.int64), table[len(table) // 2 :]
    code_of = np.repeat(np.arange(len(freq), dtype=np.int32), freq)
    f64, cum = freq.astype(np.uint64), np.r_[0, np.cumsum(freq, dtype=np.int64)[:-1]].astype(np.uint64)
    mine = slice(first_block * LANES, last * LANES)
    count = np.frombuffer(row["lane_words"], "<u2").astype(np.int64)
    at = np.cumsum(count)[mine].copy()
    x = np.frombuffer(row["states"], "<u8")[mine].copy()
    words = np.frombuffer(row["words"], "<u4").astype(np.uint64)
    lanes, steps = _shape(n)
    per = BLOCK_TOKENS // LANES
    grid = np.zeros((per, lanes), np.int32)
    s32, scale, mask = np.uint64(32), np.uint64(SCALE), np.uint64((1 << SCALE) - 1)
    for step in range(steps):
        a = _active(n, lanes, step)
        v = x[:a]
        slot = v & mask
        code = code_of[slot.astype(np.int64)]
        grid[step, :a] = code
        v = f64[code] * (v >> scale) + slot - cum[code]
        low = np.flatnonzero(v < LOW)
        if len(low):
            at[low] -= 1
            v[low] = (v[low] << s32) | words[at[low]]
        x[:a] = v
    flat = grid.reshape(per, -1, LANES).transpose(1, 0, 2).reshape(-1)[:n]
    ids = symbols[flat].astype("<u4")
    for b in range(first_block, last):
        i = (b - first_block) * BLOCK_TOKENS
        if zlib.crc32(ids[i : i + BLOCK_TOKENS]) != row["block_crc32"][b]:
            raise ValueError(f"shard {row['shard']}, segment {row['segment']}, block {b}: wrong checksum")
    return ids


def _write_segments(path: str, end_id: int, segment_tokens: int):
    @functools.partial(tidy, keeps=TOKENIZERS)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment = TaskContext.get().partitionId(), 0
        held, docs, lengths, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            row = {"shard": shard, "segment": segment, "n_tokens": len(ids), "doc_ids": docs, "doc_tokens": lengths}
            return pa.RecordBatch.from_pylist([row | encode_ids(ids)], schema=_SEGMENTS_ARROW)

        for batch in pieces(batches, PIECE):
            ids, counts = tokenizer(path).encode(batch["text"])
            ends = np.cumsum(counts)
            held.append(np.insert(ids, ends, end_id).astype(np.uint32))
            docs += batch["doc_id"].to_pylist()
            lengths += (counts + 1).tolist()
            size += len(held[-1])
            if size >= segment_tokens:
                yield flush()
                segment += 1
                held, docs, lengths, size = [], [], [], 0
        if docs:
            yield flush()

    return run


def write_token_files(
    documents: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, segment_tokens: int = SEGMENT_TOKENS
) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, in ascending doc_id order.

    Null text is empty: its ids are the end id alone. Rows go by doc_id (null first), ties by text; repeated rows
    are all written. An empty table writes an empty file set. Other columns are not read. ``tokenizer_path`` must
    exist on every executor.
    """
    rows = documents.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows.mapInArrow(_write_segments(tokenizer_path, end_id, segment_tokens), SEGMENTS).write.option(
        "compression", "uncompressed"
    ).parquet(path)


@tidy
def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_ids(row)
            lengths = np.array(row["doc_tokens"], np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(crc), row["shard"], np.int32)),
                    pa.array(np.full(len(crc), row["segment"], np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts),
                    pa.array(lengths),
                    pa.array(crc, pa.int64()),
                ],
                names=["shard", "segment", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, segment and the number of ids before it. Only shard totals meet in one task, one row a task that wrote."""
    sizes = spark.read.parquet(path).select("shard", "segment", "n_tokens")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    totals = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    totals = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("of_shards"))
    inside = W.partitionBy("shard").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("shard", "segment", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("of_segments"))
    return sizes.join(totals, "shard").select("shard", "segment", (F.col("of_shards") + F.col("of_segments")).alias("first"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    rows = spark.read.schema(SEGMENTS).parquet(path).mapInArrow(
        _read_documents, "shard int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    joined = rows.join(segment_starts(spark, path), ["shard", "segment"])
    return joined.select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op9_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "tokens")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_files(documents, path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path)
