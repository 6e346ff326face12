import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from runnel.llm import near_dedup as N
from runnel.llm import substring_dedup as S
from runnel.llm.components import components

DOCS = "doc_id long, text string, n_shingles int"


def near_brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    head = {i: i for i in sets}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k) and find(a) != find(b):
                head[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed=1):
    """Copies, chains of near copies, a crowd of siblings that are mostly no links, tiny texts."""
    rnd = random.Random(seed)
    word = lambda: f"W{rnd.randrange(5000)}"
    texts = [None, "", "  ", "One", "one", "a b c", "A b C", "a b c d e", "a b c d e f"]
    for _ in range(12):
        base = [word() for _ in range(rnd.randrange(30, 120))]
        for _ in range(rnd.randrange(1, 6)):
            texts.append(" ".join(base))
            base[rnd.randrange(len(base))] = word()
    base = [word() for _ in range(160)]
    for _ in range(70):
        copy = list(base)
        for _ in range(rnd.randrange(2, 7)):
            copy[rnd.randrange(160)] = word()
        texts.append("\n".join(copy))
    texts.append(" ".join(base))
    rnd.shuffle(texts)
    return list(enumerate(texts, 10))


@pytest.mark.parametrize("block", [(2000, 500_000), (20, 2_000)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block[0])
    monkeypatch.setattr(N, "BLOCK_SHINGLES", block[1])
    rows = corpus()
    got = N.near_dedup(spark.createDataFrame([(i, t, 0) for i, t in rows], DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_edges(spark):
    assert N.near_dedup(spark.createDataFrame([], DOCS)).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(5, text, 0), (3, text, 0), (3, text, 0), (None, text, 0), (None, "alone here", 0), (9, "x " * 40000, 0)], DOCS)
    got = Counter((r.doc_id, r.component_id, r.kept) for r in N.near_dedup(df).collect())
    assert got == {(5, 3, False): 1, (3, 3, True): 2, (None, 3, False): 1, (None, None, True): 1, (9, 9, True): 1}
    assert sorted(r.doc_id for r in N.survivors(df.filter("doc_id is not null").distinct()).collect()) == [3, 9]


def test_sketch_estimates_similarity():
    rnd = np.random.default_rng(3)
    a = rnd.integers(0, 2**63, 1000).astype(np.uint64)
    for shared in (700, 860, 950, 1000):
        b = np.r_[a[:shared], rnd.integers(0, 2**63, 1000 - shared).astype(np.uint64)]
        sets = np.concatenate([np.unique(a), np.unique(b)])
        m = N.minhash(sets, np.array([0, 1000, 2000]))
        s = N.odd_sketch(m)
        z = int(np.bitwise_count((s[0] ^ s[1]).view(np.uint64)).sum())
        est = 1 + N.BITS / (4 * N.SAMPLES) * np.log(max(1 - 2 * z / N.BITS, 1e-9))
        true = shared / (2000 - shared)
        assert abs(est - true) < 0.2 and (true < 0.75 or est >= N.PASS)


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)]
    head = {v: v for e in edges for v in e}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for a, b in edges:
        if find(a) != find(b):
            head[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for e in edges if e[0] != e[1] for v in e}


@pytest.mark.parametrize("n", [3000, 5000])
def test_components_of_ascending_chains(spark, n):
    """A chain along its ids takes few rounds, as do a comb and a star whose middle has the largest id."""
    chain = [(i, i + 1) for i in range(n)]
    comb = [(20_000 + 2 * i, 20_000 + 2 * j + 1) for i in range(1000) for j in (i, i + 1) if j < 1000]
    star = [(30_000 + i, 39_999) for i in range(2000)]
    got = {r.id: r.component for r in components(spark.createDataFrame(chain + comb + star, "a long, b long")).collect()}
    assert got == {v: 10_000 * (e[0] // 10_000) for e in chain + comb + star for v in e}


def test_a_long_chain_of_revisions_is_one_group(spark):
    """Each revision is a near copy of the one before it alone: 200 links one after another."""
    words, rows = [f"w{k}" for k in range(120)], []
    for i in range(200):
        rows.append((i, " ".join(words), 0))
        words[i * 7 % 120] = f"r{i}"
    assert near_brute([r[:2] for r in rows]) == {i: (116, 0) for i in range(200)}
    got = N.near_dedup(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (116, 0, i == 0) for i in range(200)}


def cut_brute(rows):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = defaultdict(lambda: 1 << 60)
    for i, w in words.items():
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            first[key] = min(first[key], i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_substrings_equal_brute_force(spark):
    rnd = random.Random(7)
    passages = [[f"p{j}x{k}" for k in range(n)] for j, n in enumerate((49, 50, 51, 60, 120, 300))] + [["same"] * 130]
    rows = []
    for i in rnd.sample(range(1000), 60):
        text = []
        for _ in range(rnd.randrange(1, 5)):
            text += [f"u{rnd.randrange(10**9)}" for _ in range(rnd.randrange(0, 40))] + rnd.choice(passages)
        rows.append((i, rnd.choice((" ", "\n", "\t ")).join(text)))
    rows += [(2001, rows[0][1]), (2002, None), (2003, ""), (2004, "é x " * 60)]
    got = S.substring_dedup(spark.createDataFrame([(i, t, 0) for i, t in rows], DOCS)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == cut_brute(rows)


def test_substrings_edges(spark):
    w = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(3, w, 0), (3, w + " x", 0), (5, "a " + w, 0), (None, w, 0), (None, None, 0), (7, w, 0), (7, w, 0)], DOCS)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in S.substring_dedup(df, with_text=True).collect())
    assert got == {(3, 60, 0, None): 1, (3, 61, 0, None): 1, (5, 61, 60, "a"): 1, (None, 60, 0, None): 1, (None, 0, 0, None): 1, (7, 60, 60, ""): 2}
    assert S.substring_dedup(df.limit(0)).count() == 0


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def test_patterns_that_make_sums_alike_are_told_apart(spark):
    """Sums of powers modulo 2**64 are equal for a Thue-Morse run and its complement; the words are not."""
    run = thue_morse(1024)
    rows = [(1, "p " + " ".join("ab"[b] for b in run)), (2, "p " + " ".join("ba"[b] for b in run)), (3, "q " + " ".join("ba"[b] for b in run[:49]))]
    got = S.substring_dedup(spark.createDataFrame([(i, t, 0) for i, t in rows], DOCS)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == cut_brute(rows)


def test_runs_have_the_hash_of_their_words():
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 4, 4000).astype(np.uint64)
    got = S.run_hashes(h, 50, 5)
    assert len(got[50]) == 3951 and len(got[16]) == 3985
    for n in (2, 16, 50):
        of = {}
        for i, x in enumerate(got[n].tolist()):
            assert of.setdefault(tuple(h[i : i + n].tolist()), x) == x
        assert len(set(of.values())) == len(of)
    assert len(S.run_hashes(h[:30], 50, 5)[50]) == 0


BATCH_ROWS = [[(1, 1), (2, 1), (2, 2)], [(3, 3), (1, 4)], [(4, 5)], [(3, 6), (5, 6), (5, 6)], [(9, 7)], [(5, 8), (4, 8)], [(7, 9), (7, 10)]]


def test_index_finds_repeats_across_runs_and_compacts_by_levels(spark, tmp_path):
    index = S.FingerprintIndex(spark, f"file://{tmp_path}/index", fanout=2)
    found, levels = [], []
    for b in BATCH_ROWS[:6]:
        found.append(sorted(r.hash for r in index.add(spark.createDataFrame(b, "hash long, doc_id long")).collect()))
        levels.append([level for _, level in index.runs])
    assert found == [[2], [1], [], [3], [], [4, 5]]
    assert levels == [[0], [1], [1, 0], [2], [2, 0], [2, 1]]
    index.close()
    # A later job goes on with the files alone.
    later = S.FingerprintIndex(spark, f"file://{tmp_path}/index", fanout=2)
    assert later.runs == index.runs and later.version == 6 and later.buckets == index.buckets
    assert sorted(r.hash for r in later.add(spark.createDataFrame([(9, 11), (8, 11), *BATCH_ROWS[6]], "hash long, doc_id long")).collect()) == [7, 9]
    rows = sorted(tuple(r) for n, _ in later.runs for r in later.table(n).collect())
    assert [r for r in rows if r[0] in (1, 3, 7)] == [(1, 1, 4), (3, 3, 6), (7, 9, 10)]
    later.close()


def test_runs_are_merge_joined_without_a_shuffle(spark, tmp_path):
    index = S.FingerprintIndex(spark, f"file://{tmp_path}/index", fanout=9)
    for b in BATCH_ROWS[:2]:
        index.add(spark.createDataFrame(b, "hash long, doc_id long"))
    (a, _), (b, _) = index.runs
    with index._sorted_buckets():
        plan = index.table(a).join(index.table(b).hint("merge"), "hash", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
    index.close()


def test_substrings_equal_their_sql(matches):
    matches(S.op2_substring_dedup, S.OP2_SQL)


def test_near_duplicates_equal_their_sql(matches):
    matches(N.op8_near_dedup, N.OP8_SQL)


def test_a_leader_of_many_pairs_is_copied(spark, monkeypatch):
    monkeypatch.setattr(N, "SPREAD", 7)
    rows = corpus(5)
    got = N.near_dedup(spark.createDataFrame([(i, t, 0) for i, t in rows], DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_brute(rows)
