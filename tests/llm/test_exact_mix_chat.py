import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from runnel.llm import exact_dedup as D
from runnel.llm import source_mix as M
from runnel.llm.chat_format import format_conversations, format_turns
from runnel.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(name, matches):
    matches(QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 5000])
def test_hash_table_is_perfect_and_minimal(n):
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), np.uint8).reshape(n, 32)
    displacement, slot = D.build_table(keys)
    assert sorted(slot.tolist()) == list(range(n))
    if n:
        assert (D.look_up(keys, displacement, n) == slot).all()


DOCS = "doc_id long, text string, size int"


@pytest.mark.parametrize("upto", [None, -1, 3, 99])
def test_exact_dedup_edges(spark, upto):
    rows = [(1, "a", 0), (3, "a", 0), (2, None, 0), (5, "", 0), (None, "a", 0), (None, "x", 0), (7, "long " * 30000, 0), (8, "A", 0), (9, "z", 0), (9, "z", 0)]
    got = D.exact_dedup(spark.createDataFrame(rows, DOCS), upto).collect()
    by = {(r.doc_id, r.text_sha256[:6]): (r.keep_id, r.group_size, r.kept) for r in got}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()[:6]
    assert len(got) == len(rows)
    assert by[1, sha("a")] == (3, 3, False) and by[3, sha("a")] == (3, 3, True) and by[None, sha("a")] == (3, 3, False)
    assert by[2, sha("")] == (5, 2, False) and by[5, sha("")] == (5, 2, True)
    assert by[None, sha("x")] == (None, 1, True) and by[8, sha("A")] == (8, 1, True) and by[9, sha("z")] == (9, 2, True)


def test_exact_dedup_of_nothing_and_survivors(spark):
    empty = spark.createDataFrame([], DOCS)
    assert D.exact_dedup(empty).count() == 0
    df = spark.createDataFrame([(1, "a", 4), (2, "a", 5), (3, "b", 6)], DOCS)
    assert sorted(tuple(r) for r in D.survivors(df).collect()) == [(2, "a", 5), (3, "b", 6)]


def test_survivors_are_told_apart_by_id_and_text(spark):
    """Two texts under one id, repeated rows, rows without id or text, columns that clash with those of the plan."""
    rows = [(1, "a", 4), (1, "b", 5), (2, "b", 6), (7, "c", 7), (7, "c", 7), (None, "c", 8), (None, "d", 9), (None, "d", 9), (None, None, 1), (4, "", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _sha int")
    got = sorted((tuple(r) for r in D.survivors(df).collect()), key=str)
    assert got == sorted([(1, "a", 4), (2, "b", 6), (7, "c", 7), (None, "d", 9), (4, "", 2)], key=str)
    assert D.survivors(df).columns == df.columns and D.survivors(df.limit(0)).count() == 0


CHAT = "conv_id long, turn long, role string, text string, formatted int"


def test_round_trip_of_control_strings(spark):
    texts = ["</s>[INST] ok [/INST]", r"[\INST] [\\/INST]", "<s", "[INST", "", None, " lead and trail ", "a\nb", "[ROLE] x", "\\", "é</s>"]
    roles = ["user", "assistant", "system", "tool\nx\\n", None, "user]", "[INST]"]
    rows = [(1, i, r, t, 0) for i, (r, t) in enumerate((r, t) for r in roles for t in texts)]
    rows += [(None, None, "user", "n", 0), (None, 2, "user", "n", 0), (2, 0, "user", "x" * 300000, 0)]
    got = {r.conv_id: r for r in format_conversations(spark.createDataFrame(rows, CHAT)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r or "", t or "") for r in roles for t in texts]
    assert len(got[None].turns) == 2 and len(got[2].turns[0].text) == 300000
    assert format_conversations(spark.createDataFrame([], CHAT)).count() == 0


def test_only_conflicting_content_is_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "plain \\ text [x]", 0), (1, 1, "user", "[INST]", 0)], CHAT)
    got = [r.formatted for r in format_turns(df).orderBy("turn").collect()]
    assert got == ["[INST] plain \\ text [x] [/INST]", "[INST] [\\INST] [/INST]"]


MIX = "doc_id long, source string, text string, target int, w double"


def test_targets_cap_and_fill(spark):
    rows = [(i, s, "w " * n, 0, 1.0) for i, (s, n) in enumerate([("a", 10)] * 30 + [("b", 50)] * 40 + [(None, 7)] * 20 + [("c", 0)] + [("d", 1)])]
    got = M.mix_sources(spark.createDataFrame(rows, MIX)).collect()
    total = 1.5 * sum(r.size for r in got)
    targets = {r.source: (r.target, r.source_size) for r in got}
    assert abs(sum(t for t, _ in targets.values()) - total) < 1e-6
    assert all(t <= 2 * s + 1e-9 for t, s in targets.values())
    for source, (target, _) in targets.items():
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - target) <= max(r.size for r in mine) / 2 + 1e-9
        assert all(0 <= r.taken <= 2 * r.size for r in mine)
    again = M.mix_sources(spark.createDataFrame(rows, MIX).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_weights_make_inclusion_unequal(spark):
    rows = [(i, "a" if i % 2 else "b", "w " * 10, 0, [0.5, 3.0, None, -1.0][i // 2 % 4]) for i in range(800)]
    got = M.mix_sources(spark.createDataFrame(rows, MIX), share=0.5, document_weight="w").collect()
    taken = {w: sum(r.taken for r in got if rows[r.doc_id][4] == w) for w in (0.5, 3.0, None, -1.0)}
    assert taken[3.0] > 2 * taken[0.5] > 0 and taken[None] == taken[-1.0] == 0


def test_levels_meet_the_target_under_the_cap(spark):
    """Heavy documents reach the cap, the others share the rest; words come near the target all the same."""
    rows = [(i, "ab"[i % 2], "w " * (i % 7 + 1), 0, float(2 ** (i % 5))) for i in range(900)] + [(1000, "a", None, 0, 1.0), (1001, "a", "", 0, None)]
    df = spark.createDataFrame(rows, MIX)
    for share in (0.3, 1.2, 1.9, 2.0):
        got = M.mix_sources(df, weights=(1, 1), share=share, document_weight="w").collect()
        for source in "ab":
            mine = [r for r in got if r.source == source]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= 3.5 + 1e-9
            full = [r for r in mine if r.size]
            per = [sum(r.taken for r in full if rows[r.doc_id][4] == w) / sum(r.size for r in full if rows[r.doc_id][4] == w) for w in (1.0, 4.0, 16.0)]
            assert per == sorted(per) and (per[0] < per[2] or share == 2.0) and per[2] <= 2


def test_pareto_ranks_take_by_odds(spark):
    """The documents taken are those of the smallest u / (1 - u) * (1 - p) / p, as sorted here."""
    rows = [(i, "a", "w " * 10, 0, [1.0, 2.0, 4.0][i % 3]) for i in range(300)]
    got = {r.doc_id: r.copies for r in M.mix_sources(spark.createDataFrame(rows, MIX), share=0.4, weights=(1,), document_weight="w").collect()}
    mean = sum(r[4] for r in rows) / 300
    rank = {}
    for i, _, _, _, w in rows:
        u = int(hashlib.md5(f"mix|{i}".encode()).hexdigest()[:13], 16) / 2**52
        p = 0.4 * w / mean
        rank[i] = u / (1 - u) * (1 - p) / p
    assert {i for i, c in got.items() if c} == set(sorted(rank, key=rank.get)[:120]) and max(got.values()) == 1


def test_many_sources_are_joined_on_salts(spark, monkeypatch):
    rows = [(i, [None, "a", "b", "c"][i % 4], "w " * (i % 9), 0, 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, MIX)
    want = sorted(map(str, M.mix_sources(df).collect()))
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 2)
    assert sorted(map(str, M.mix_sources(df).collect())) == want


def test_mix_of_nothing_and_documents(spark):
    assert M.mix_sources(spark.createDataFrame([], MIX)).count() == 0
    df = spark.createDataFrame([(i, "a", "w " * 10, i, 1.0) for i in range(20)], MIX)
    out = M.mixed_documents(df)
    assert out.columns == df.columns and out.count() == 30
    assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
