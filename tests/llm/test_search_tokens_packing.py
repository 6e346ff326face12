import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from runnel.llm import ann_search as A
from runnel.llm import chunk_tokenizer as CT
from runnel.llm import packing as P
from runnel.llm import token_files as T
from runnel.llm.chunk_tokenizer import ChunkTokenizer

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = ["", None, " a", "a   b \n\nword", "x y 　z", "ΑΣ ΑΣ.", "é é ́x", "İstanbul I'm 's", "<|endoftext|> hi", "\x1c \x1d x\x85 y", "don't 4567 ... ¿qué?", "日本語　です", "a   b", "ﬁ Å ²ª"]


@pytest.mark.parametrize("name", FILES)
def test_chunks_give_the_library_ids(name):
    c = ChunkTokenizer(public_tokenizers.path(name))
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice(" \n\t  éaB'.1\x1cΣş́²") for _ in range(rnd.randrange(14))) for _ in range(300)]
    ids, n = c.encode(pa.array(texts))
    ends = np.cumsum(n)
    for t, a, b in zip(texts, ends - n, ends, strict=True):
        assert ids[a:b].tolist() == c.library.encode(t or "", add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("name", FILES)
def test_added_tokens_get_their_own_ids(name):
    path = public_tokenizers.path(name)
    fresh, c, rnd = Tokenizer.from_file(path), ChunkTokenizer(path), random.Random(2)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "|>", " ", "  ", "\n", "é", "Hi", "'s", "a4", "\u3000", "ΑΣ"]
    texts = ODD + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(9))) for _ in range(600)]
    ids, n = c.encode(pa.array(texts))
    ends = np.cumsum(n)
    for t, a, b in zip(texts, ends - n, ends, strict=True):
        assert ids[a:b].tolist() == fresh.encode(t or "", add_special_tokens=False).ids, repr(t)
    assert c.encode(pa.array(["<|endoftext|> hi"]))[0].tolist() == {FILES[0]: [49407, 1883], FILES[1]: [50256, 23105]}[name]


@pytest.mark.parametrize("name", FILES)
def test_pieces_cut_on_bytes_give_the_library_ids(name, monkeypatch):
    """Letters with and without marks, signs, digits, blanks of all kinds; also when a worker forgets between batches."""
    path = public_tokenizers.path(name)
    fresh, c, rnd = Tokenizer.from_file(path), ChunkTokenizer(path), random.Random(3)
    monkeypatch.setattr(CT, "MOST_BYTES", 150_000)
    shrunk = []
    monkeypatch.setattr(CT.ChunkTokenizer, "_shrink", lambda self, was=CT.ChunkTokenizer._shrink: (was(self), shrunk.append(len(self.known))))
    bits = [" ", "  ", "\n", "\t", "a", "B", "xyz", "É", "ß", "ÿ", "À", "×", "÷", "1", "23", ".", ",", "'", "'s", "’", "<", "|", "-", "_", "´", "e", "h"]
    bits += ["\u0301", "\u0331", "日", "\u3000", "\xa0", "\x1c", "\x85", "\x7f", "\x00", "ﬁ", "İ", "²", "Σ"]
    for _ in range(12):
        texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(12))) for _ in range(300)]
        ids, n = c.encode(pa.array(texts))
        ends = np.cumsum(n)
        for t, a, b in zip(texts, ends - n, ends, strict=True):
            assert ids[a:b].tolist() == fresh.encode(t, add_special_tokens=False).ids, repr(t)
    assert len(shrunk) > 1 and max(shrunk) > 10  # some pieces are forgotten, those in use are not


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(0, 49407), max_size=400), st.sampled_from([1, 90, 400]))
def test_rans_round_trip(values, times):
    ids = np.array(values * times, np.uint32)
    row = T.encode_ids(ids) | {"n_tokens": len(ids), "shard": 0, "segment": 0}
    assert (T.decode_ids(row) == ids).all()
    if len(ids) > T.BLOCK_TOKENS:
        assert (T.decode_ids(row, 1, 1) == ids[T.BLOCK_TOKENS : 2 * T.BLOCK_TOKENS]).all()


def test_damage_is_noticed():
    ids = np.arange(5000, dtype=np.uint32) % 700
    row = T.encode_ids(ids) | {"n_tokens": 5000, "shard": 0, "segment": 0}
    words = bytearray(row["words"])
    words[40] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        T.decode_ids(row | {"words": bytes(words)})


DOCS = "doc_id long, text string, start int"


def encoded(rows, name, end):
    t = ChunkTokenizer(public_tokenizers.path(name)).library
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4") for x in rows]


def test_token_files_equal_the_library(spark, tmp_path):
    rows = [(i * 7 % 101, t, 0) for i, t in enumerate(ODD * 3)] + [(None, "null id", 0), (500, "word " * 30000, 0), (501, "twice", 0), (501, "twice", 0)]
    path = f"file://{tmp_path}/t"
    T.write_token_files(spark.createDataFrame(rows, DOCS), path, public_tokenizers.path(FILES[0]), segment_tokens=50)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in T.read_token_files(spark, path).collect())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = encoded([r[1] for r in order], FILES[0], 1)
    starts = np.cumsum([0, *map(len, ids)])
    assert got == [(s, r[0], len(i), zlib.crc32(i)) for s, r, i in zip(starts.tolist(), order, ids, strict=False)]
    T.write_token_files(spark.createDataFrame([], DOCS), path + "0", public_tokenizers.path(FILES[0]))
    assert T.read_token_files(spark, path + "0").count() == 0


@pytest.mark.parametrize("segments", [64, 2])
def test_packing_covers_all_without_padding(spark, segments):
    rows = [(i, t, 0) for i, t in enumerate(ODD)] + [(None, "x", 0), (3, "same id", 0), (900, "long text here " * 3000, 0)] + [(1000 + i, "word " * (i * 13 % 400), 0) for i in range(150)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    out = P.pack_documents(df, public_tokenizers.path(FILES[1]), max_segments=segments).collect()
    want = defaultdict(int)
    for r, i in zip(rows, encoded([r[1] for r in rows], FILES[1], 0), strict=True):
        want[r[0], len(i)] += len(i)
    got, sequences = defaultdict(int), defaultdict(list)
    ids = {r[0]: i for r, i in zip(rows, encoded([r[1] for r in rows], FILES[1], 0), strict=True)}
    for p in out:
        got[p.doc_id, p.doc_tokens] += p.length
        sequences[p.sequence_id].append((p.offset, p.length))
        if p.doc_id not in (None, 3):
            assert zlib.crc32(ids[p.doc_id][p.start : p.start + p.length]) == p.ids_crc32
    assert got == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 1024 and at & (at - 1) == 0 and len(parts) <= segments


def test_packing_of_nothing(spark):
    assert P.pack_documents(spark.createDataFrame([], DOCS), public_tokenizers.path(FILES[1])).count() == 0
    with pytest.raises(ValueError):
        P.pack_documents(spark.createDataFrame([], DOCS), "", max_tokens=1000)


def test_bins_keep_all_three_limits():
    rnd = np.random.default_rng(1)
    tokens = rnd.integers(1, 300, 200)
    loss = np.minimum(tokens, rnd.integers(0, 150, 200))
    left_t, left_l = tokens.copy(), loss.copy()
    bins = 0
    while left_t.any():
        placed, _ = P.fill_bin(left_t, left_l, (512, 5, 200), cut=False)
        assert placed and len(placed) <= 5
        assert sum(tokens[i] for i, _ in placed) <= 512 and sum(loss[i] for i, _ in placed) <= 200
        bins += 1
    lower = max(tokens.sum() / 512, 200 / 5, loss.sum() / 200)
    assert bins <= 1.25 * lower + 1


def test_the_loss_limit_binds_on_prompts_and_answers(spark):
    rnd = random.Random(4)
    rows = [(i, [(f"ask {i} " * rnd.randrange(60), False), (f"tell {i} " * rnd.randrange(40), True)]) for i in range(150)]
    rows += [(500, [("word " * 3000, True)]), (501, [("word " * 3000, False), ("é end", True)]), (502, []), (503, None), (504, [(None, True)])]
    df = spark.createDataFrame(rows, "doc_id long, parts array<struct<text: string, loss: boolean>>").repartition(2)
    out = P.pack_examples(df, public_tokenizers.path(FILES[1]), max_tokens=512, max_loss_tokens=100).collect()
    ids, masks = {}, {}
    for key, parts in rows:
        each = [encoded([t], FILES[1], 0)[0][:-1] for t, _ in parts or []]
        ids[key] = np.r_[*each, 0].astype("<u4") if each else np.zeros(1, "<u4")
        masks[key] = np.r_[*[np.full(len(e), b) for e, (_, b) in zip(each, parts or [], strict=True)], bool(parts and parts[-1][1])]
    tokens, loss, placed = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in out:
        assert zlib.crc32(ids[p.doc_id][p.start : p.start + p.length]) == p.ids_crc32
        tokens[p.sequence_id] += p.length
        loss[p.sequence_id] += int(masks[p.doc_id][p.start : p.start + p.length].sum())
        placed[p.doc_id] += p.length
    assert placed == {k: len(v) for k, v in ids.items()}
    assert max(loss.values()) == 100 and max(tokens.values()) == 512
    plain = P.pack_documents(spark.createDataFrame([(1, "word " * 3000, 0)], DOCS), public_tokenizers.path(FILES[1]), max_tokens=512, max_loss_tokens=100).collect()
    lengths = defaultdict(int)
    for p in plain:
        lengths[p.sequence_id] += p.length
    assert max(lengths.values()) <= 100 and sum(lengths.values()) == len(encoded(["word " * 3000], FILES[1], 0)[0])


VECTORS = "vec_id long, embedding array<float>, score int"


def brute(rows, k=10):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, x in ok:
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in ok if i != q)
            out[q] = d[:k]
    return out


def test_search_against_brute_force(spark):
    rnd = np.random.default_rng(5)
    x = rnd.standard_normal((3000, 24)).astype(np.float32)
    x[500:1400] = x[500]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(5000, None), (5100, [0.0] * 24), (5200, [float("nan")] * 24), (5300, [1.0] * 3), (None, [1.0] * 24), (5400, [None] * 24), (5500, []), (5600, [float("inf")] * 24)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], VECTORS)
    got = defaultdict(list)
    for r in A.search(df, df.filter(F.col("vec_id") % 100 == 0)).collect():
        got[r.query_id].append((r.rank, r.score, r.vec_id))
    want = brute(rows)
    assert set(got) == set(want)
    found = 0
    for q, hits in got.items():
        hits.sort()
        assert [h[0] for h in hits] == list(range(1, 11))
        assert [h[1:] for h in hits] == sorted(h[1:] for h in hits)
        found += len({h[2] for h in hits} & {i for _, i in want[q]})
        if 500 <= q < 1400:
            assert [(h[1], h[2]) for h in hits] == want[q]
    assert found >= 0.9 * 10 * len(want)


def test_lengths_and_doubles_are_searched_exactly(spark):
    """Doubles that are no floats, components beyond the range of floats, and two lengths, each by itself."""
    rnd = np.random.default_rng(6)
    rows = [(i, (rnd.standard_normal(12) * (1e100 if i < 300 else 1)).tolist()) for i in range(700)]
    rows += [(1000 + i, rnd.standard_normal(5).tolist()) for i in range(300)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for r in A.search(df, df.filter(F.col("vec_id") % 100 == 0)).collect():
        got[r.query_id].append((r.rank, r.score, r.vec_id))
    of, found = dict(rows), 0
    assert set(got) == {i for i in of if i % 100 == 0}
    for q, hits in got.items():
        hits.sort()
        same = [i for i in of if len(of[i]) == len(of[q]) and i != q]
        d = {i: float(np.sqrt(((np.array(of[i]) - np.array(of[q])) ** 2).sum())) for i in same}
        want = sorted(same, key=lambda i: (d[i], i))[:10]
        assert all(s == pytest.approx(d[v], rel=1e-14) for _, s, v in hits) and len(hits) == 10
        found += len({v for _, _, v in hits} & set(want))
    assert found >= 9 * len(got)


def test_queries_travel_to_few_groups():
    """Lists that are near each other share groups: a query of a clustered table is dealt to a small part of them."""
    rnd = np.random.default_rng(7)
    centres = rnd.standard_normal((60, 16)).astype(np.float32) * 5
    x = (centres[rnd.integers(0, 60, 8000)] + rnd.standard_normal((8000, 16)) * 0.3).astype(np.float32)
    index = A.fit(x, 2_000_000, 11, 0.985)
    assert index.group.max() + 1 == 100 and (np.diff(index.group) >= 0).all()
    probed = index.lists(A.rotate(x[:200], index.rotation), index.probes)
    dealt = [len(np.unique(np.concatenate([index.group[index.first_cell[a] : index.first_cell[a] + index.cells[a]] for a in lists]))) for lists in probed]
    assert np.mean(dealt) < 25
    load = np.bincount(index.group, weights=np.repeat(np.bincount(index.lists(A.rotate(x, index.rotation), 1)[:, 0], minlength=len(index.cells)) / index.cells, index.cells))
    assert load.max() < 3 * load.mean()


def test_search_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.0], 0)], VECTORS)
    got = sorted(tuple(r) for r in A.search(df, df.filter("vec_id = 0")).collect())
    assert got == [(0, 1, 2, 0.0), (0, 2, 1, 2**0.5)]
    assert A.search(df.limit(0), df).count() == 0 and A.search(df, df.limit(0)).count() == 0


def test_tasks_of_another_kind_forget_the_tokenizers():
    import public_tokenizers

    from runnel.llm import chunk_tokenizer, text_arrays

    path = public_tokenizers.path("byte_bpe_50k.json")
    first = chunk_tokenizer.tokenizer(path)
    assert list(text_arrays.tidy(lambda rows: rows, keeps=chunk_tokenizer.TOKENIZERS)(iter([1]))) == [1] and chunk_tokenizer.tokenizer(path) is first
    assert list(text_arrays.tidy(lambda rows: rows)(iter([1]))) == [1] and not chunk_tokenizer._loaded


def test_packing_encodes_a_slice_at_a_time(monkeypatch):
    """The rows do not depend on the slices that are encoded at once, and no more than a slice is."""
    rnd = random.Random(4)
    texts = [None if i % 7 == 0 else " ".join(rnd.choice(["alpha", "beta", "don't", "x1"]) for _ in range(rnd.randrange(200))) for i in range(300)]
    batch = pa.record_batch([pa.array(range(300)), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(P, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("Of", (), {"partitionId": lambda self: 0})())}))
    seen, encode = [], ChunkTokenizer.encode

    def counted(self, some):
        seen.append(sum(len(t or "") for t in some.to_pylist()))
        return encode(self, some)

    def rows():
        run = P._pack_documents(public_tokenizers.path("byte_bpe_50k.json"), 0, (1024, 64, 1024))
        return [r for b in run(iter([batch])) for r in b.to_pylist()]

    whole = rows()
    monkeypatch.setattr(ChunkTokenizer, "encode", counted)
    monkeypatch.setattr(P, "SLICE", 5000)
    assert rows() == whole and len(seen) > 10 and max(seen) <= 5000
