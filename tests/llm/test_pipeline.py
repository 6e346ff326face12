import collections
import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from test_dedup import near_brute
from tokenizers import Tokenizer

from runnel.llm import language_id

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_are_in_order():
    assert list(STAGES) == ["language_id", "exact_dedup", "near_dedup", "source_mix", "pack"]


def mix_brute(rows):
    """Copies of each doc_id: weights 3, 1, 2 by source, 150 % of all words, at most twice, by Pareto ranks."""
    size = {i: len((t or "").encode().split()) for i, t, _ in rows}
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    have = {s: sum(size[i] for i, _, x in rows if x == s) for s in sources}
    left, open_ = 1.5 * sum(have.values()), set(sources)
    target = {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * have[s]}
        for s in over or open_:
            target[s] = 2 * have[s] if over else level * weight[s]
            left -= target[s]
        open_ -= over or set(open_)
    out = {}
    for s in sources:
        mine = [i for i, _, x in rows if x == s]
        e = target[s] / have[s] if have[s] else 0
        whole, p = int(e), e - int(e)
        u = {i: int(hashlib.md5(f"mix|{i}".encode()).hexdigest()[:13], 16) / 2**52 for i in mine}
        rest = target[s] - whole * have[s]
        for i in sorted(mine, key=lambda i: (u[i], i)):
            take = p > 0 and size[i] / 2 <= rest
            out[i] = whole + take
            rest -= size[i] if p > 0 else 0
    return out


def test_pipeline_equals_brute_force(spark, sf_dir):
    """Every stage's rows against a plain version on all that the stage before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    model = language_id.fit(docs.filter(~language_id.held_out(docs["doc_id"])))
    judged = language_id.identify(docs, model).collect()
    kept = STAGES["language_id"](spark, docs, sf_dir).cache()
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {r.doc_id for r in judged if r.lang_pred != "und" and r.score >= 0.4} and kept.columns == docs.columns
    assert len(ids) >= 0.98 * len(text)

    last = {}
    for i in ids:
        last[text[i][0]] = max(i, last.get(text[i][0], i))
    kept = STAGES["exact_dedup"](spark, kept, sf_dir).cache()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(last.values()) and kept.columns == docs.columns

    found = near_brute([(i, text[i][0]) for i in last.values()])
    kept = STAGES["near_dedup"](spark, kept, sf_dir).cache()
    ids = sorted(i for i, (_, c) in found.items() if c == i)
    assert sorted(r.doc_id for r in kept.collect()) == ids and kept.columns == docs.columns

    copies = mix_brute([(i, *text[i]) for i in ids])
    kept = STAGES["source_mix"](spark, kept, sf_dir).cache()
    assert collections.Counter(r.doc_id for r in kept.collect()) == {i: n for i, n in copies.items() if n} and kept.columns == docs.columns

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {i: len(library.encode(text[i][0], add_special_tokens=False).ids) + 1 for i, n in copies.items() if n}
    got, filled = collections.Counter(), collections.Counter()
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        assert r.doc_tokens == tokens[r.doc_id]
        got[r.doc_id] += r.length
        filled[r.sequence_id] += r.length
    assert got == {i: n * copies[i] for i, n in tokens.items()}
    assert all(n <= 1024 and n & (n - 1) == 0 for n in filled.values())


ODD = "doc_id long, text string, lang string, source string, n_chars long, size int, _row int, _copies int, key string, component_id long"


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_bear_odd_rows(spark, sf_dir, name):
    """Nulls in every column, empty and very long texts, repeated rows and ids, columns named like those of the plans."""
    words = " ".join(np.random.default_rng(1).choice(["the", "of", "and", "rion", "thing", "tha"], 80).tolist())
    rows = [(i, words + f" {i} {i * 7}", "en", "a", 1, 1, 1, 1, "k", 5) for i in range(30)] + [(None,) * 10, (None, words, None, None, None, None, None, None, None, None)]
    rows += [(50, None, "en", "b", 0, 0, 0, 0, "", 0), (51, "", "en", None, 0, 0, 0, 0, "", 0), (52, "12 !", "en", "b", 4, 0, 0, 0, "", 0), (53, "word " * 60000, "en", "b", 9, 9, 9, 9, "k", 9)]
    rows += [(60, "twice the same row here", "en", "a", 1, 1, 1, 1, "k", 1)] * 2 + [(61, "one id for two texts", "en", "a", 1, 1, 1, 1, "k", 1), (61, "two texts for one id", "en", "a", 1, 1, 1, 1, "k", 1)]
    docs = spark.createDataFrame(rows, ODD)
    out = STAGES[name](spark, docs, sf_dir)
    got = out.collect()
    if name != "pack":
        assert out.columns == docs.columns and {tuple(r) for r in got} <= set(rows)
    ids = collections.Counter(r.doc_id for r in got)
    if name == "exact_dedup":
        texts = collections.Counter(r.text or "" for r in got)
        assert set(texts) == {r[1] or "" for r in rows} and set(texts.values()) == {1}
    if name == "near_dedup":
        assert ids[None] == 2 and ids[50] == ids[51] == 1 and ids[60] == ids[61] == 2
    if name == "pack":
        assert set(ids) == {r[0] for r in rows}
    empty = STAGES[name](spark, docs.limit(0), sf_dir)
    assert empty.count() == 0 and empty.columns == out.columns
