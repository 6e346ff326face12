"""How far the sources of a language differ in their vocabulary, and the terms that mark each of them.

Two passes with a vocabulary automaton:

1. Each piece of the corpus (about PIECE bytes of texts) gives its distinct terms with the documents that hold them,
   so a frequent term is one row a piece. Their sums over a language are exact document frequencies; the terms in at
   least ``least_documents`` documents are kept.
2. Each piece gets those kept terms that it holds, which its own size bounds, and an Aho-Corasick automaton over them,
   each padded with a delimiter on both sides, counts their occurrences again in the texts of each source.

The sparse postings (language, source, term, occurrences) give smoothed shares in parts per billion. The divergence of
two sources adds up, over all kept terms, (p - q)^2 / (p + q), rounded down: postings are dealt by term into shards and by
source into blocks, and each (pair of blocks, shard) is a small dense table in a task, whose sums are added up. Terms that
neither source holds add the same each and are counted, not listed.

All numbers are integers; a share is found by three divisions of 64-bit numbers, exact up to 9e15 occurrences. A term
has a number in place of its text: the piece that comes first of those that hold it, and its place there.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runnel.llm.storage import materialize, new_path
from runnel.llm.terms import LETTER_TERMS, coded, distinct_pairs, folded, piece_ids
from runnel.llm.text_arrays import pieces, tidy

#: Bytes of text that are a piece, and that are cut into terms at once (or one longer text).
PIECE, SLICE = 64 << 20, 4 << 20
#: Digits of a place among the terms of a piece; a piece with more terms is several, each with all its texts.
PLACE_BITS = 20
#: Terms of a shard and sources of a block, on average; a task's table has at most about 2 * BLOCK * SHARD cells.
SHARD, BLOCK = 4096, 128
BILLION = 1_000_000_000

_PIECES = pa.schema(
    [
        ("piece", pa.int64()), ("lang", pa.string()), ("terms", pa.list_(pa.string())), ("found_in", pa.list_(pa.int64())), ("packed_terms", pa.binary()),
        ("sources", pa.list_(pa.string())), ("texts", pa.list_(pa.binary())),
    ]
)
_PIECES_SQL = "piece long, lang string, terms array<string>, found_in array<long>, packed_terms binary, sources array<string>, texts array<binary>"
_POSTINGS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_POSTINGS_SQL = "lang string, source string, ids array<long>, counts array<long>"
_PAIRS = "lang string, source string, other string, value long"


def _packed(text: bytes) -> bytes:
    return len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True)


def _unpacked(packed: pa.Scalar) -> str:
    data = packed.as_buffer()
    return pa.decompress(data.slice(8), int.from_bytes(data.slice(0, 8), "little"), "zstd", asbytes=True).decode()


def _rows(schema: pa.Schema, *columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class _Part:
    """What a piece holds of one language: terms with their documents by slices, and packed texts of its sources."""

    def __init__(self) -> None:
        self.terms, self.held, self.sources, self.texts = [], [], [], []

    def add(self, terms: pa.Array, held: np.ndarray, texts: dict[str, list[bytes]]) -> None:
        self.terms.append(terms)
        self.held.append(held)
        for source, parts in texts.items():
            self.sources.append(source)
            self.texts.append(_packed(b" ".join([b"", *parts, b""])))

    def rows(self, lang: str, number: Iterator[int]) -> Iterator[pa.RecordBatch]:
        found = pa.concat_arrays(self.terms).dictionary_encode()
        terms = found.dictionary.cast(pa.string())
        held = np.zeros(len(terms), np.int64)
        np.add.at(held, found.indices.to_numpy(), np.concatenate(self.held))
        order = pc.sort_indices(terms)  # packs well
        terms, held = terms.take(order), held[order.to_numpy()]
        for at in range(0, max(len(terms), 1), 1 << PLACE_BITS):
            some = slice(at, at + (1 << PLACE_BITS))
            packed = _packed(" ".join(terms[some].to_pylist()).encode())
            yield _rows(_PIECES, [next(number)], [lang], [terms[some]], [held[some]], [packed], [self.sources], [self.texts])


@tidy
def _make_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each piece and language."""
    number, parts, size = piece_ids(), {}, 0
    for batch in pieces(batches, SLICE):
        data, offsets = folded(batch["text"], LETTER_TERMS)
        terms, code, bounds = coded(data, offsets)
        langs = batch["lang"].dictionary_encode()
        of_row = langs.indices.to_numpy()
        row, term, _ = distinct_pairs(np.repeat(np.arange(len(of_row)), np.diff(bounds)), code, len(terms))
        lang, term, held = distinct_pairs(of_row[row], term, len(terms))
        sources = batch["source"].to_pylist()
        for i, name in enumerate(langs.dictionary.to_pylist()):
            texts: dict[str, list[bytes]] = {}
            for r in np.flatnonzero(of_row == i).tolist():
                texts.setdefault(sources[r], []).append(data[offsets[r] : offsets[r + 1]].tobytes())
            mine = lang == i
            parts.setdefault(name, _Part()).add(terms.take(pa.array(term[mine])), held[mine], texts)
        size += len(data)
        if size >= PIECE:
            for name, part in parts.items():
                yield from part.rows(name, number)
            parts, size = {}, 0
    for name, part in parts.items():
        yield from part.rows(name, number)


@tidy
def _recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of a piece's kept terms in the texts of each of its sources."""
    for batch in batches:
        for r in range(batch.num_rows):
            kept = batch["kept"].slice(r, 1).flatten()
            terms = _unpacked(batch["packed_terms"][r]).split(" ")
            ids = kept.field("id").to_numpy()
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for i, at in enumerate(kept.field("i").to_pylist()):
                automaton.add_word(f" {terms[at]} ", i)
            automaton.make_automaton()
            counts: dict[str, np.ndarray] = {}
            for source, packed in zip(*(batch[name].slice(r, 1).flatten() for name in ("sources", "texts")), strict=True):
                n = np.bincount(np.fromiter(map(itemgetter(1), automaton.iter(_unpacked(packed))), np.int64), minlength=len(ids))
                name = source.as_py()
                counts[name] = counts[name] + n if name in counts else n
            some = [np.flatnonzero(n) for n in counts.values()]
            found = [n[at] for n, at in zip(counts.values(), some, strict=True)]
            yield _rows(_POSTINGS, [batch["lang"][r].as_py()] * len(counts), list(counts), [ids[at] for at in some], found)


def cut(documents: DataFrame) -> DataFrame:
    """The corpus in pieces, as a table."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    path = new_path(documents.sparkSession, "pieces")
    documents.select(*text).mapInArrow(_make_pieces, _PIECES_SQL).write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(_PIECES_SQL).parquet(path)


def vocabulary(corpus: DataFrame, least_documents: int) -> DataFrame:
    """piece, i, id: where each kept term stands in each piece that holds it."""
    place = F.shiftleft("piece", PLACE_BITS).bitwiseOR(F.col("i").cast("long")).alias("place")
    held = corpus.select("piece", "lang", F.posexplode(F.arrays_zip("terms", "found_in")).alias("i", "t"))
    held = held.select("lang", F.col("t.terms").alias("term"), place, F.col("t.found_in").alias("found_in"))
    term = W.partitionBy("lang", "term")
    known = held.select("place", F.sum("found_in").over(term).alias("documents"), F.min("place").over(term).alias("id"))
    i = F.col("place").bitwiseAND((1 << PLACE_BITS) - 1).cast("int").alias("i")
    return known.filter(F.col("documents") >= least_documents).select(F.shiftright("place", PLACE_BITS).alias("piece"), i, "id")


def postings(corpus: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, id, n: the occurrences of each kept term in each source that holds it."""
    lists = kept.groupBy("piece").agg(F.collect_list(F.struct("i", "id")).alias("kept"))
    counted = corpus.drop("terms", "found_in").join(lists, "piece").mapInArrow(_recount, _POSTINGS_SQL)
    rows = counted.select("lang", "source", F.explode(F.arrays_zip("ids", "counts")).alias("t"))
    return materialize(rows.groupBy("lang", "source", F.col("t.ids").alias("id")).agg(F.sum("t.counts").alias("n")), "postings")


def texts_of(terms: DataFrame, corpus: DataFrame) -> DataFrame:
    """The rows of ``terms`` with the term that ``id`` stands for as ``item``."""
    places = corpus.select(F.col("piece").alias("_piece"), "terms")
    found = terms.join(places, F.shiftright("id", PLACE_BITS) == F.col("_piece"))
    at = F.col("id").bitwiseAND((1 << PLACE_BITS) - 1).cast("int")
    return found.withColumn("item", F.col("terms")[at]).drop("_piece", "terms")


def parts_per_billion(n: Column, total: Column) -> Column:
    """1 + floor(BILLION * n / total) for n <= total, thousand by thousand so that no product exceeds 64 bits."""

    total = F.greatest(total, F.lit(1).cast("long"))  # without terms nothing is divided
    done, rest = F.lit(0).cast("long"), n
    for _ in range(3):
        more = rest * F.lit(1000).cast("long")
        done, rest = done * 1000 + F.call_function("div", more, total), more % total
    return done + 1


def divergence(p: Column, q: Column) -> Column:
    square = (p - q) * (p - q)
    return F.call_function("div", square, p + q)


def _floored(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _pair_sums(table: pa.Table) -> pa.Table:
    """Of one language, pair of blocks and shard: each pair's sum over the shard's terms, beyond that of terms that neither holds.

    Rows without a term name the sources and bring their share for absent terms. The first shard adds the absent
    share of all terms of the language.
    """
    lang, a, b, shard = (table[c][0].as_py() for c in ("lang", "a", "b", "shard"))
    absent = table.filter(pc.is_null(table["id"]))
    names, block = absent["source"].to_pylist(), absent["block"].to_numpy()
    none, size = absent["p"].to_numpy(), int(absent["vocabulary"][0].as_py())
    given = table.filter(pc.is_valid(table["id"]))
    terms = given["id"].combine_chunks().dictionary_encode()
    at = pc.index_in(given["source"].combine_chunks(), absent["source"].combine_chunks()).to_numpy()
    dense = np.repeat(none[:, None], len(terms.dictionary), axis=1)
    dense[at, terms.indices.to_numpy()] = given["p"].to_numpy()
    left = np.flatnonzero(block == a)
    found: list[tuple[str, str, int]] = []
    for i in left.tolist():
        right = np.arange(i + 1, len(names)) if a == b else np.flatnonzero(block == b)
        same = _floored(none[i], none[right])
        value = (_floored(dense[i], dense[right]) - same[:, None]).sum(axis=1) + (same * size if shard == 0 else 0)
        found += [(names[i], names[j], v) for j, v in zip(right.tolist(), value.tolist(), strict=True) if v or shard == 0]
    first, second, values = ([f[k] for f in found] for k in range(3))
    return pa.table(
        [pa.array([lang] * len(found), pa.string()), pa.array(first, pa.string()), pa.array(second, pa.string()), pa.array(values, pa.int64())],
        names=["lang", "source", "other", "value"],
    )


def pair_values(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, other, value for every ordered pair of sources of a language.

    shares: lang, source, id, p. groups: lang, source, vocabulary, none (the share of a term that the source lacks).
    """
    per_lang = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"), F.greatest(F.lit(1), F.ceil(F.max("vocabulary") / SHARD)).alias("shards")
    )
    block = F.pmod(F.xxhash64("source"), F.col("blocks"))
    dealt = groups.join(per_lang, "lang").withColumn("block", block).withColumn("_with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("a", F.least("block", "_with")).withColumn("b", F.greatest("block", "_with")).drop("_with", "blocks")
    dealt = materialize(dealt, "blocks")
    columns = ["lang", "a", "b", "shard", "source", "block", "vocabulary", "id", "p"]
    named = dealt.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    named = named.withColumn("id", F.lit(None).cast("long")).withColumn("p", F.col("none")).select(columns)
    given = shares.join(dealt.drop("block", "vocabulary"), ["lang", "source"]).withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")))
    given = given.withColumn("block", F.lit(None).cast("long")).withColumn("vocabulary", F.lit(None).cast("long")).select(columns)
    sums = named.unionByName(given).groupBy("lang", "a", "b", "shard").applyInArrow(_pair_sums, _PAIRS)
    once = materialize(sums.groupBy("lang", "source", "other").agg(F.sum("value").alias("value")), "pairs")
    turned = once.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")
    return once.unionByName(turned)


def audit(documents: DataFrame, least_documents: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: the sources of a language by divergence, and the terms that mark a source.

    Part ``pair`` ranks all other sources of the language by their divergence from the source (0 if the language keeps no
    term); part ``term`` the ``top`` terms whose share in the source exceeds that in its language. Ties go to
    the smaller item in UTF-8. Null text, lang and source are empty ones. Repeated rows count as often as they come. A
    group without terms is compared all the same; an empty table gives no rows. Other columns are not read.
    """
    corpus = cut(documents)
    found = postings(corpus, vocabulary(corpus, least_documents))
    sizes = found.groupBy("lang", "id").agg(F.lit(1)).groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    counts = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = corpus.select("lang", F.explode("sources").alias("source")).distinct()
    groups = groups.join(sizes, "lang", "left").join(counts, ["lang", "source"], "left").na.fill(0, ["vocabulary", "total"])
    groups = groups.withColumn("total", F.col("total") + 2 * F.col("vocabulary"))
    groups = materialize(groups.withColumn("none", parts_per_billion(F.lit(2).cast("long"), F.col("total"))), "groups")
    shares = found.join(groups.select("lang", "source", "total"), ["lang", "source"])
    shares = materialize(shares.select("lang", "source", "id", "n", parts_per_billion(F.col("n") + 2, F.col("total")).alias("p")), "shares")

    pairs = pair_values(shares.drop("n"), groups).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    order = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    langs = groups.groupBy("lang").agg(F.sum(F.col("total") - 2 * F.col("vocabulary")).alias("_n"), F.max("vocabulary").alias("_v"))
    langs = langs.select("lang", (F.col("_n") + 2 * F.col("_v")).alias("total"))
    whole = shares.withColumn("all", F.sum("n").over(W.partitionBy("id"))).join(langs, "lang")
    marked = whole.withColumn("q", parts_per_billion(F.col("all") + 2, F.col("total"))).filter("p > q")
    marked = marked.select("lang", "source", "id", divergence(F.col("p"), F.col("q")).alias("value"))
    # Ties at the last place stay until their terms are known.
    best = marked.withColumn("_at", F.rank().over(W.partitionBy("lang", "source").orderBy(F.desc("value")))).filter(F.col("_at") <= top)
    named = texts_of(materialize(best, "terms"), corpus)
    named = named.select("lang", "source", F.lit("term").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(named.filter(F.col("rank") <= top))


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 10),
seen AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) JOIN kept USING (lang, term) GROUP BY ALL),
cell AS (
  SELECT g.lang, g.source, kept.term, coalesce(seen.n, 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) g
  JOIN kept USING (lang) LEFT JOIN seen ON seen.lang = g.lang AND seen.source = g.source AND seen.term = kept.term),
per AS (
  SELECT *, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p,
    sum(n) OVER (PARTITION BY lang, term) AS m FROM cell),
whole AS (
  SELECT lang, term, 1 + (1000000000 * (m + 2)) // (sum(m) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT DISTINCT lang, term, m FROM per)),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM per a JOIN per b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0) AS value
  FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM per JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM every UNION ALL SELECT * FROM term))
WHERE part = 'pair' OR rank <= 10
"""
