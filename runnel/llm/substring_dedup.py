"""Substring dedup: passages of WINDOW words that an earlier document has are cut out of later ones.

A window's hash is the smallest hash among its GRAM-word runs, so windows that overlap share it for long stretches
and a document has about one hash per 18 words, while equal windows always have equal hashes.

Those hashes are indexed like a log-structured store. Each batch of documents (ascending doc_id) becomes an immutable
run, sorted by hash in buckets, and is merge-joined with the runs before it, bucket by bucket and without a shuffle;
hashes found there, or twice in the batch, are repeated. FANOUT runs of a level are compacted into one of the next, so
a hash is rewritten once a level. A manifest in the index's folder names the runs, and a later job can open it.

Candidates, the windows whose hash is repeated, are verified by two 64-bit digests over all their words, independent of
the window hash: trees of nonlinear mixes, so no pattern of words makes them alike. A window goes where its digest also
starts in a document with a smaller doc_id. Before they are shuffled, a batch of documents keeps one window of each
digest, of its smallest document; its later ones are decided at once. Documents with the same words all through (by
SHA-256) are one document for the index; all but the first go whole.
"""

from __future__ import annotations

import contextlib
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runnel.llm.shingles import factors, mix, word_codes, word_hashes
from runnel.llm.storage import exists, join_groups, materialize, new_path
from runnel.llm.text_arrays import pieces, tidy

WINDOW, GRAM = 50, 16
#: Batches the query deals the table into, and runs of a level that an index compacts into one of the next.
BATCHES, FANOUT = 4, 2
#: Bytes of text that a Python worker hashes at once.
PIECE = 4 << 20


def run_hashes(hashes: np.ndarray, size: int, seed: int) -> dict[int, np.ndarray]:
    """Hashes of the runs of 1, 2, 4, ... and ``size`` words that begin at each word, as trees of nonlinear mixes."""
    by = factors(64, seed)

    def join(a: np.ndarray, b: np.ndarray, far: int) -> np.ndarray:
        b = b[far:]
        return mix(a[: len(b)] + b * by[far])

    out = {1: hashes}
    n = 1
    while 2 * n <= size:
        out[2 * n] = join(out[n], out[n], n)
        n *= 2
    whole, done = out[n], n
    while done < size:
        n = 1 << ((size - done).bit_length() - 1)
        whole = join(whole, out[n], done)
        done += n
    out[size] = whole
    return out


class Words:
    """Word hashes of a batch of texts: bounds, window starts, window hashes and, with ``digests``, digests of windows."""

    def __init__(self, texts: pa.Array, digests: bool = False):
        distinct, code, self.bounds = word_codes(texts)
        self.size = np.diff(self.bounds)
        hashes = [word_hashes(distinct, s)[code] if len(code) else np.zeros(0, np.uint64) for s in (1, 2)[: 1 + digests]]
        grams = run_hashes(hashes[0], WINDOW if digests else GRAM, 51)
        # Least hash of WINDOW - GRAM + 1 runs in turn, by doubling.
        span, least = 1, mix(grams[GRAM] ^ np.uint64(0x9E3779B97F4A7C15))
        wanted = WINDOW - GRAM + 1
        while span * 2 <= wanted:
            least = np.minimum(least[:-span], least[span:]) if len(least) > span else least[:0]
            span *= 2
        rest = wanted - span
        if rest:
            least = np.minimum(least[:-rest], least[rest:]) if len(least) > rest else least[:0]
        full = self.size >= WINDOW
        starts, counts = self.bounds[:-1][full], self.size[full] - WINDOW + 1
        self.at = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        self.doc = np.repeat(np.flatnonzero(full), counts)
        self.hash = least[self.at].view(np.int64)
        #: Two digests of the window that begins at each word.
        self.digests = (grams[WINDOW].view(np.int64), run_hashes(hashes[1], WINDOW, 52)[WINDOW].view(np.int64)) if digests else ()


def word_digests(texts: pa.Array) -> list[bytes]:
    """SHA-256 of each text's words, joined by one space."""
    return [hashlib.sha256(b" ".join((t or "").encode().split())).digest() for t in texts.to_pylist()]


def row_keys(digests: list[bytes]) -> np.ndarray:
    """Part of the digests, which tells rows of one doc_id apart."""
    return np.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], np.int64)


PRINTS = "doc_id long, n_words long, row_key long, digest binary, prints array<long>"


@tidy
def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A document's word count, the digest of all its words, and its window hashes."""
    for batch in pieces(batches, PIECE):
        w = Words(batch["text"])
        digests = word_digests(batch["text"])
        new = np.flatnonzero(np.r_[True, (w.hash[1:] != w.hash[:-1]) | (w.doc[1:] != w.doc[:-1])][: len(w.hash)])
        ends = np.searchsorted(w.doc[new], np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(ends.astype(np.int32), w.hash[new])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"].cast(pa.int64()), pa.array(w.size), pa.array(row_keys(digests)), pa.array(digests, pa.binary()), lists],
            names=["doc_id", "n_words", "row_key", "digest", "prints"],
        )


class FingerprintIndex:
    """Sorted runs (hash, first_doc, last_doc) of the window hashes of all batches so far, in the folder ``path``.

    The folder may hold the index of a former job, which is then continued. Each change writes a new version of the
    manifest after the runs it names are complete; a job that dies in between leaves the version before it valid.
    """

    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        self.version, self.runs = 0, []  # of each run: name, level
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._tables: dict[str, str] = {}
        if exists(spark, f"{self.path}/manifest"):
            rows = spark.read.parquet(f"{self.path}/manifest").collect()  # a row for each run and version, log2 of the batches
            self.version = max(r["version"] for r in rows)
            last = sorted((r["turn"], r["name"], r["level"], r["buckets"]) for r in rows if r["version"] == self.version)
            self.runs, self.buckets = [(name, level) for _, name, level, _ in last], last[0][3]

    def table(self, name: str) -> DataFrame:
        """A run, as a table that is known to be sorted by hash in buckets."""
        if name not in self._tables:
            table = f"runnel_{name}_{uuid.uuid4().hex[:8]}"
            self.spark.sql(
                f"CREATE TABLE {table} (hash BIGINT, first_doc BIGINT, last_doc BIGINT) USING parquet CLUSTERED BY (hash) "
                f"SORTED BY (hash) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'"
            )
            self._tables[name] = table
        return self.spark.table(self._tables[name])

    def _write(self, rows: DataFrame) -> str:
        name = f"run_{uuid.uuid4().hex}"
        dealt = rows.repartition(self.buckets, "hash").sortWithinPartitions("hash")
        table = f"runnel_{name}"
        dealt.write.bucketBy(self.buckets, "hash").sortBy("hash").option("path", f"{self.path}/{name}").saveAsTable(table)
        self._tables[name] = table
        return name

    def _commit(self) -> None:
        self.version += 1
        rows = [(self.version, i, name, level, self.buckets) for i, (name, level) in enumerate(self.runs)]
        manifest = self.spark.createDataFrame(rows, "version int, turn int, name string, level int, buckets int")
        manifest.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    @contextlib.contextmanager
    def _sorted_buckets(self):
        """Scans of one-file buckets say that they are sorted, so merge joins of runs neither shuffle nor sort."""
        key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
        before = self.spark.conf.get(key, "false")
        self.spark.conf.set(key, "true")
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def add(self, batch: DataFrame) -> DataFrame:
        """Take in rows (hash, doc_id); return the hashes among them that are repeated, each once."""
        name = self._write(batch.groupBy("hash").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")))
        new = self.table(name)
        found = new.filter("first_doc < last_doc").select("hash")
        for run, _ in self.runs:
            found = found.union(new.join(self.table(run).select("hash").hint("merge"), "hash", "left_semi").select("hash"))
        with self._sorted_buckets():
            found = materialize(found.distinct(), "repeated")
        self.runs.append((name, 0))
        self.compact()
        self._commit()
        return found

    def compact(self) -> None:
        """While a level has ``fanout`` runs, merge them into one of the next, in which a hash has its smallest document."""
        level = 0
        while any(at >= level for _, at in self.runs):
            old = [name for name, at in self.runs if at == level]
            if len(old) >= self.fanout:
                rows = self.table(old[0])
                for name in old[1:]:
                    other = self.table(name).select("hash", F.col("first_doc").alias("f"), F.col("last_doc").alias("l")).hint("merge")
                    rows = rows.join(other, "hash", "full").select(
                        "hash", F.least("first_doc", "f").alias("first_doc"), F.greatest("last_doc", "l").alias("last_doc")
                    )
                with self._sorted_buckets():
                    merged = self._write(rows)
                self.runs = [r for r in self.runs if r[0] not in old] + [(merged, level + 1)]
            level += 1

    def close(self) -> None:
        """Forget the tables of this session; the files stay."""
        for table in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables = {}


WINDOWS = "doc_id long, row_key long, pos int, len int, w1 long, w2 long, decided boolean"


@tidy
def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate windows with their digests; of those with one digest, all but the smallest document's are decided."""
    for batch in pieces(batches, PIECE):
        w = Words(batch["text"], digests=True)
        ids, keys = batch["doc_id"].to_numpy(), batch["row_key"].to_numpy()
        # Candidates: the (document, hash) pairs that are in the documents' lists.
        lists = batch["hashes"]
        of = np.repeat(np.arange(batch.num_rows), pc_lengths(lists))
        wanted = lists.flatten().to_numpy()
        tag = mix(wanted.view(np.uint64) + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        mine = mix(w.hash.view(np.uint64) + w.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        pick = np.flatnonzero(np.isin(mine, tag))
        at, doc = w.at[pick], w.doc[pick]
        w1, w2 = (d[at] for d in w.digests)
        order = np.lexsort((at, ids[doc], w2, w1))
        a, b, d = w1[order], w2[order], ids[doc][order]
        head = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
        first = d[np.maximum.accumulate(np.where(head, np.arange(len(d)), 0))] if len(d) else d
        # One row for a digest and its smallest document's place; later documents' windows are decided.
        decided = np.zeros(len(pick), bool)
        decided[order] = d > first
        same = np.zeros(len(pick), bool)
        same[order] = head | (d == first)
        pos = at - w.bounds[:-1][doc]
        run = np.flatnonzero(decided)
        begin = run[np.r_[True, (doc[run][1:] != doc[run][:-1]) | (pos[run][1:] != pos[run][:-1] + 1)][: len(run)]] if len(run) else run
        length = np.diff(np.r_[np.searchsorted(run, begin), len(run)]) if len(run) else run
        keep = np.flatnonzero(~decided & same)
        rows = np.r_[keep, begin]
        n = len(keep)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[doc[rows]]),
                pa.array(keys[doc[rows]]),
                pa.array(pos[rows].astype(np.int32)),
                pa.array(np.r_[np.ones(n, np.int32), length.astype(np.int32)]),
                pa.array(w1[rows]),
                pa.array(np.r_[w2[keep], pos[begin] + (ids[doc[begin]] << 20)]),
                pa.array(np.arange(len(rows)) >= n),
            ],
            names=["doc_id", "row_key", "pos", "len", "w1", "w2", "decided"],
        )


def pc_lengths(lists: pa.ListArray) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy())


def removed_mask(n_words: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words that lie in one of the windows that start at starts, ..., starts + lengths - 1."""
    step = np.zeros(n_words + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths + WINDOW - 1, -1)
    return np.cumsum(step[:-1]) > 0


@tidy
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, PIECE):
        rows, texts = batch.to_pylist(), []
        removed, sha = [], []
        for row in rows:
            text = (row["text"] or "").encode().split()
            gone = removed_mask(len(text), np.array(row["pos"]), np.array(row["len"]))
            removed.append(int(gone.sum()))
            texts.append(b" ".join(t for t, g in zip(text, gone.tolist(), strict=True) if not g))
            sha.append(hashlib.sha256(texts[-1]).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["row_key"], pa.array(removed, pa.int64()), pa.array(sha), pa.array([t.decode() for t in texts])],
            names=["doc_id", "row_key", "n_removed", "cut_sha256", "cut_text"],
        )


def repeated_hashes(prints: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Window hashes of rows (doc_id, prints) that occur in two documents, by way of the index, in ascending batches."""
    index = FingerprintIndex(prints.sparkSession, new_path(prints.sparkSession, "index"))
    shares = [i / batches for i in range(1, batches)]
    edges = prints.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] or []
    edges = [None, *sorted(set(edges)), None]
    found = None
    for low, high in zip(edges, edges[1:], strict=False):
        part = prints
        if low is not None:
            part = part.filter(F.col("doc_id") > low)
        if high is not None:
            part = part.filter(F.col("doc_id") <= high)
        new = index.add(part.select(F.explode("prints").alias("hash"), "doc_id"))
        found = new if found is None else found.union(new)
    found = materialize(found.distinct(), "hashes")
    index.close()
    return found


def substring_dedup(documents: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and with ``with_text`` kept_text
    (null where nothing is removed).

    Null text has no words. A text of fewer than WINDOW words is never cut. Windows are judged on the input. Rows
    without doc_id lose nothing and take nothing from others. Rows that repeat a doc_id are one document as to
    "smaller", each with its own result. An empty table gives no rows. Other columns are not read.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = materialize(documents.mapInArrow(_prints, PRINTS), "prints")
    total = prints.count()
    long_rows = prints.filter((F.col("n_words") >= WINDOW) & F.col("doc_id").isNotNull())
    copies = long_rows.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    copies = materialize(copies, "copies")
    marked = join_groups(long_rows.select("doc_id", "row_key", "prints", "digest"), copies, "digest", "size", total)
    single = materialize(marked.filter("first_doc is null or doc_id = first_doc").select("doc_id", "row_key", "prints"), "indexed")

    hashes = repeated_hashes(single.select("doc_id", "prints"))
    wanted = single.select("doc_id", F.explode("prints").alias("hash")).join(hashes, "hash")
    wanted = wanted.groupBy("doc_id").agg(F.collect_set("hash").alias("hashes"))
    texts = documents.join(wanted, "doc_id").mapInArrow(_with_key, "doc_id long, row_key long, text string, hashes array<long>")
    texts = materialize(texts, "candidates")
    windows = texts.mapInArrow(_windows, WINDOWS)
    smallest = F.min("doc_id").over(W.partitionBy("w1", "w2", "decided"))
    gone = windows.withColumn("first_doc", smallest).filter("decided or doc_id > first_doc")
    gone = gone.groupBy("doc_id", "row_key").agg(F.collect_list("pos").alias("pos"), F.collect_list("len").alias("len"))
    cut = texts.select("doc_id", "row_key", "text").join(gone, ["doc_id", "row_key"]).mapInArrow(
        _cut, "doc_id long, row_key long, n_removed long, cut_sha256 string, cut_text string"
    )
    if not with_text:
        cut = cut.drop("cut_text")
    cut = cut.dropDuplicates(["doc_id", "row_key"])

    rows = prints.select("doc_id", "n_words", "row_key", "digest")
    rows = join_groups(rows, copies, "digest", "size", total).join(cut, ["doc_id", "row_key"], "left")
    whole = F.col("doc_id") > F.col("first_doc")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    out = [
        F.col("doc_id"),
        F.col("n_words"),
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, empty).otherwise(F.coalesce("cut_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
    ]
    if with_text:
        out += [F.when(whole, F.lit("")).otherwise(F.col("cut_text")).alias("kept_text")]
    return rows.select(*out)


@tidy
def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The row's key beside its text: rows of one doc_id are cut each by its own windows."""
    for batch in pieces(batches, PIECE):
        keys = pa.array(row_keys(word_digests(batch["text"])))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], keys, batch["text"], batch["hashes"]], names=["doc_id", "row_key", "text", "hashes"])


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH listed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(ws[p : p + 49], ' ') AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM listed)
), gone AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY w) AS first_doc FROM windows) WHERE doc_id > first_doc
), words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM listed
), marked AS (
  SELECT w.doc_id, w.word, w.p, coalesce(max(g.p) OVER (PARTITION BY w.doc_id ORDER BY w.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) > 0 AS cut
  FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.p = w.p
), kept AS (
  SELECT doc_id, count(*) FILTER (cut) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT cut), '')) AS kept_sha256
  FROM marked GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM listed LEFT JOIN kept USING (doc_id)
"""
