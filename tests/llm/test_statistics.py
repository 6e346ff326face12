"""Source divergence, importance resampling and toxicity against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from runnel.llm import importance_resampling as I
from runnel.llm import source_divergence as D
from runnel.staging import materialize

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, value string"


def frame(spark, rows):
    """Documents with columns beside those of the table, whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], DOCS)


def some_documents(seed, n=120, sources=("a", "b", "c", None), langs=("xx", "yy", None)):
    rnd = random.Random(seed)
    stock = ["Tea", "tea", "élan", "the", "of", "x1y", "rot-weiß", "Ä", "…", "12", "zz"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(n):
        text = rnd.choice([" ", "\n", ", ", "\x00", "\t "]).join(rnd.choices(stock, k=rnd.choice([0, 1, 3, 25, 60])))
        rows.append((i + 1, rnd.choice([text, text, text, None, ""]), rnd.choice(langs), rnd.choice(sources)))
    rows.append((500, "the tea of " * 9000, "xx", "a"))
    return rows + rows[3:6]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_audit(rows, least):
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))) for _, text, lang, source in rows]
    out = set()
    for lang in {t[0] for t in terms}:
        mine = [t for t in terms if t[0] == lang]
        df = Counter(w for t in mine for w in set(t[2]))
        kept = sorted(w for w in df if df[w] >= least)
        counts = {s: Counter() for _, s, _ in mine}
        for _, s, ws in mine:
            counts[s].update(w for w in ws if df[w] >= least)

        def share(c, kept=kept):
            total = sum(c.values()) + 2 * len(kept)
            return {w: 1 + 10**9 * (c[w] + 2) // total for w in kept}

        q = share(sum(counts.values(), Counter()))
        p = {s: share(c) for s, c in counts.items()}
        for s in p:
            pair = [(o, sum((p[s][w] - p[o][w]) ** 2 // (p[s][w] + p[o][w]) for w in kept)) for o in p if o != s]
            term = [(w, (p[s][w] - q[w]) ** 2 // (p[s][w] + q[w])) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, items, most in (("pair", pair, None), ("term", term, 10)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("block,shard", [(128, 4096), (1, 3)])
def test_divergence_equals_the_plain_version(spark, monkeypatch, block, shard):
    """Also with many blocks and shards, a long text, nulls, repeated rows and columns of clashing names."""
    for name, value in (("BLOCK", block), ("SHARD", shard)):
        monkeypatch.setattr(D, name, value)
    rows = some_documents(1)
    got = D.audit(frame(spark, rows), least_documents=4)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows, 4)


def test_divergence_without_terms_or_rows(spark):
    assert D.audit(frame(spark, [])).count() == 0
    got = {tuple(r) for r in D.audit(frame(spark, [(1, None, None, "a"), (2, "12", None, "b"), (3, "tea", "xx", None)])).collect()}
    assert got == {("", "a", "pair", "b", 0, 1), ("", "b", "pair", "a", 0, 1)}


def test_shares_are_exact_beyond_products_of_64_bits(spark):
    cases = [(3, 7), (10**15 - 1, 10**15), (123_456_789_012_345, 987_654_321_098_765), (2, 9 * 10**15 // 1000), (5, 5)]
    df = spark.createDataFrame(cases, "n long, total long").select("n", "total", D.parts_per_billion(F.col("n"), F.col("total")).alias("p"))
    assert all(r.p == 1 + 10**9 * r.n // r.total for r in df.collect())


def test_divergence_query_equals_its_sql(matches):
    matches(D.op11_source_divergence, D.OP11_SQL)


def plain_resample(rows, target, lo, hi, buckets, least, percent):
    def grams(text):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return len(ws), Counter(" ".join(ws[i : i + n]) for n in range(lo, hi + 1) for i in range(len(ws) - n + 1))

    docs = [(i, *grams(text)) for i, text, _, _ in rows]
    s, t = Counter(), Counter()
    for into, counts in [(s, c) for _, _, c in docs] + [(t, grams(text)[1]) for text in target]:
        for f, n in counts.items():
            into[zlib.crc32(f.encode()) % buckets] += n
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log(float(t[b] + 1) * float(S + buckets) / (float(s[b] + 1) * float(T + buckets)))) for b in range(buckets)}
    out = []
    for i, words, c in docs:
        n = sum(c.values())
        weight = sum(k * gain[zlib.crc32(f.encode()) % buckets] for f, k in c.items()) // n if n else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), words))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = [(*r[:4], k + 1) for k, r in enumerate(able[: len(able) * percent // 100])]
    return drawn, Counter(r[:4] for r in out)


@pytest.mark.parametrize("lo,hi,buckets,percent", [(1, 1, 10_000, 10), (1, 3, 50, 60), (2, 2, 7, 100)])
def test_resampling_equals_the_plain_version(spark, lo, hi, buckets, percent):
    rows = [r for r in some_documents(2, 200)]
    rows += [(None, "tea of the " * 30, "xx", "a"), (None, "w", None, None)]
    target = ["The TEA rot-weiß", None, "", "wa wb wc 12 x1y élan " * 5]
    texts = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = I.resample(frame(spark, rows), texts, lo, hi, buckets, 20, percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = [tuple(r) for r in got.collect()]
    drawn, every = plain_resample(rows, target, lo, hi, buckets, 20, percent)
    assert Counter(r[:4] for r in got) == every
    assert sorted((r for r in got if r[4] is not None), key=lambda r: r[4]) == drawn
    kept = I.drawn_documents(frame(spark, rows), texts, shortest=lo, longest=hi, buckets=buckets, percent=percent)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in drawn} and kept.columns == DOCS.replace(",", "").split()[::2]


def test_resampling_of_ties_in_many_ranges(spark):
    """One text under ascending and repeated ids: all weights are equal, repeated ids tie in their scores."""
    rows = [(i % 400, "tea " * 20, "xx", "a") for i in range(2000)]
    texts = spark.createDataFrame([("tea",)], "text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r) for r in I.resample(frame(spark, rows).repartition(7), texts, percent=50).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    drawn, every = plain_resample(rows, ["tea"], 1, 1, 10_000, 20, 50)
    assert Counter(r[:4] for r in got) == every
    assert sorted((r for r in got if r[4] is not None), key=lambda r: r[4]) == drawn


def test_resampling_holds_one_piece_at_a_time(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(I, "materialize", lambda df, name, *a, **options: kept.setdefault(name, materialize(df, name, *a, **options)))
    rows = [(i, f"tea{i} of the " * 1_300_000, None, None) for i in range(3)]  # two fill a piece
    docs = frame(spark, rows).coalesce(1)
    assert sorted(r.n_features for r in I.resample(docs, spark.createDataFrame([("tea",)], "text string"), least_words=1).collect()) == [3_900_000] * 3
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0).num_rows for f in kept["counts"].inputFiles()]
    assert kept["counts"].count() == 2 and set(groups) == {1}
    weighed = I.weigh(kept["counts"], kept["dictionary"], I.bucket_gains(kept["dictionary"], 10_000))
    assert "collect_list" not in weighed._jdf.queryExecution().toString()  # of all n-grams of a task's pieces


def test_resampling_of_nothing(spark):
    texts = spark.createDataFrame([("tea",)], "text string")
    assert I.resample(frame(spark, []), texts).count() == 0
    got = I.resample(frame(spark, [(1, None, None, None), (2, "tea " * 30, None, None)]), texts.filter("false"))
    assert sorted((r.doc_id, r.n_features, r.rank) for r in got.collect()) == [(1, 0, None), (2, 30, None)]


def test_resampling_query_equals_its_sql(matches):
    matches(I.op12_importance_resampling, I.OP12_SQL)
