"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents and unlabelled text are learned from; labels that say "not toxic" count for nothing but the
class prior, the share of toxic documents. With g the score of a document and l the logistic loss, the risk is

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

whose second part is the risk of the negatives, told from the unlabelled text by taking the positives' share off. Where
a flexible model drives it below zero, steps go back up until it is positive again (the non-negative correction).

Features are indicators: a word, or the first letters of a word, comes in a document at least COUNTS times, or makes
up at least RATES of its words. The candidates are those that positives show more often than unlabelled
documents, counted on Spark over the whole texts of the sample; the MOST_FEATURES with the largest likelihood ratio are
kept. CLASSIFIERS linear models are trained, each without another share of the unlabelled documents, and averaged.

The sample is bounded: about MOST_POSITIVE confirmed toxic documents and MOST_UNLABELLED others, drawn by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.storage import materialize
from runnel.llm.terms import WORD_TERMS, coded, distinct_pairs, folded
from runnel.llm.text_arrays import pieces, tidy

#: Documents of the training sample, about; a bounded number whatever the table's size.
MOST_POSITIVE, MOST_UNLABELLED = 2000, 8000
#: Letters at the beginning of a word that are a feature; 0 is the whole word.
PREFIXES = (0, 4, 5, 6, 7)
#: Least occurrences, and least shares of a document's words (with two occurrences at least).
COUNTS, RATES = (1, 2, 4), (1 / 400, 1 / 100, 1 / 30)
LEVELS = len(COUNTS) + len(RATES)
MOST_FEATURES, LEAST_POSITIVES, LEAST_LIFT, LEAST_RATIO = 2048, 3, 1.5, 8.0
CLASSIFIERS, STEPS, RATE, PENALTY = 3, 300, 0.1, 5e-4
#: The share of toxic documents where no label tells it, and the bounds of what labels may tell.
PRIOR, LEAST_PRIOR, MOST_PRIOR = 0.1, 0.005, 0.9
THRESHOLD = 0.7
#: Bytes of text that a worker looks at at once.
SLICE = 4 << 20


@dataclass
class Model:
    stems: list[str]
    weights: np.ndarray  # (stems, LEVELS)
    bias: float
    prior: float


def held_out(key: Column) -> Column:
    """Documents whose labels are never learned: CRC-32 of the doc_id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def stems_of(terms: pa.Array) -> list[pa.Array]:
    """For each of PREFIXES the stem of every term: ``^`` and its first letters, null if it is shorter; the whole term as it is."""
    out = []
    for k in PREFIXES:
        if k:
            long_enough = pc.greater_equal(pc.utf8_length(terms), k)
            first = pc.binary_join_element_wise(pa.scalar("^", terms.type), pc.utf8_slice_codeunits(terms, 0, k), pa.scalar("", terms.type))
            out.append(pc.if_else(long_enough, first, pa.scalar(None, terms.type)))
        else:
            out.append(terms)
    return out


def _occurrences(texts: pa.Array, lexicon: pa.Array | None) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The stems (``lexicon`` or all), distinct (text, stem) with their occurrences, and the words of each text."""
    data, offsets = folded(texts, WORD_TERMS)
    terms, code, bounds = coded(data, offsets)
    size = np.diff(bounds)
    views = stems_of(terms)
    if lexicon is None:
        found = pa.concat_arrays([v.cast(pa.large_string()) for v in views]).dictionary_encode()
        lexicon, number = found.dictionary, found.indices.fill_null(-1).to_numpy()
    else:
        number = np.concatenate([pc.index_in(v.cast(pa.large_string()), lexicon).fill_null(-1).to_numpy() for v in views])
    number = number.reshape(len(PREFIXES), len(terms))
    text = np.repeat(np.arange(len(size)), size)
    known = [number[v][code] for v in range(len(PREFIXES))]
    at = [np.flatnonzero(k >= 0) for k in known]
    owner, stem, n = distinct_pairs(np.concatenate([text[a] for a in at]), np.concatenate([k[a] for k, a in zip(known, at, strict=True)]), len(lexicon))
    return lexicon, owner, stem, n, size


def _levels(n: np.ndarray, words: np.ndarray) -> Iterator[np.ndarray]:
    """For each level whether n occurrences among so many words reach it."""
    for least in COUNTS:
        yield n >= least
    for rate in RATES:
        yield (n >= 2) & (n >= rate * words)


@tidy
def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """stem, level, and the positive and unlabelled documents of the piece that reach it."""
    for batch in pieces(batches, SLICE):
        stems, owner, stem, n, size = _occurrences(batch["text"], None)
        flags = [batch[name].to_numpy(zero_copy_only=False).astype(bool) for name in ("positive", "unlabelled")]
        for level, reached in enumerate(_levels(n, size[owner])):
            p, u = (np.bincount(stem[reached & flag[owner]], minlength=len(stems)) for flag in flags)
            some = np.flatnonzero(p + u)
            columns = [stems.take(pa.array(some)).cast(pa.string()), pa.array(np.full(len(some), level, np.int32)), pa.array(p[some]), pa.array(u[some])]
            yield pa.RecordBatch.from_arrays(columns, names=["stem", "level", "p", "u"])


def _features(shared):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stems, number = shared.value  # number: of a (stem, level), -1 if it is no feature
        for batch in pieces(batches, SLICE):
            _, owner, stem, n, size = _occurrences(batch["text"], pa.array(stems, pa.large_string()))
            rows: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for level, reached in enumerate(_levels(n, size[owner])):
                feature = number[stem, level]
                for i, f in zip(owner[reached & (feature >= 0)].tolist(), feature[reached & (feature >= 0)].tolist(), strict=True):
                    rows[i].append(f)
            columns = [batch["positive"], batch["unlabelled"], pa.array([sorted(r) for r in rows], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["positive", "unlabelled", "features"])

    return run


def _sample(documents: DataFrame, labels: DataFrame, learn: Column) -> tuple[DataFrame, float]:
    """positive, unlabelled, text of the training sample, and the class prior."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learn)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labelled, toxic = known.agg(F.count(F.lit(1)), F.count_if(F.col("toxic") == 1)).first()
    prior = PRIOR if toxic == labelled else min(max(toxic / labelled, LEAST_PRIOR), MOST_PRIOR)
    rows = documents.select("doc_id", "text").filter(learn)
    total = rows.count()

    def drawn(most: int, n: int, *key: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(17), *key), F.lit(1 << 40)) < int((1 << 40) * min(1.0, most / max(n, 1)))

    # About MOST_POSITIVE numbers.
    confirmed = known.filter(F.col("toxic") == 1).filter(drawn(MOST_POSITIVE, toxic, "doc_id")).select(F.col("doc_id").alias("_id"))
    marked = rows.join(F.broadcast(confirmed), F.col("doc_id") == F.col("_id"), "left")
    marked = marked.select("doc_id", "text", F.col("_id").isNotNull().alias("positive"), drawn(MOST_UNLABELLED, total, "doc_id", "text").alias("unlabelled"))
    # Equal rows are drawn together, and once.
    return marked.filter("positive or unlabelled").groupBy("doc_id", "text", "positive", "unlabelled").agg(F.lit(1)).drop("doc_id"), prior


def candidates(sample: DataFrame, positives: int, unlabelled: int) -> list[tuple[str, int]]:
    """The (stem, level) that tell positives from unlabelled documents best, at most MOST_FEATURES."""
    counts = sample.mapInArrow(_frequencies, "stem string, level int, p long, u long")
    per = counts.groupBy("stem", "level").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).filter(F.col("p") >= LEAST_POSITIVES)
    share = (F.col("p") + F.col("u")) / (positives + unlabelled)

    def fits(k: Column, n: int, rate: Column) -> Column:
        """Log-likelihood of k of n documents at a rate."""
        yes = F.when(k > 0, k * F.log(rate)).otherwise(0.0)
        return yes + F.when(k < n, (n - k) * F.log(1 - rate)).otherwise(0.0)

    ratio = fits(F.col("p"), positives, F.col("p") / positives) + fits(F.col("u"), unlabelled, F.col("u") / unlabelled)
    ratio = ratio - fits(F.col("p"), positives, share) - fits(F.col("u"), unlabelled, share)
    lifted = per.filter(F.col("p") * unlabelled > LEAST_LIFT * positives * F.col("u")).withColumn("ratio", ratio).filter(F.col("ratio") > LEAST_RATIO)
    best = lifted.orderBy(F.desc("ratio"), "stem", "level").limit(MOST_FEATURES).select("stem", "level").collect()
    return [tuple(r) for r in best]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def train(positive: list[list[int]], unlabelled: list[list[int]], n_features: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of one linear classifier, by full-batch steps on the non-negative risk."""
    sides = []
    for rows in (positive, unlabelled):
        sides.append((np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([f for r in rows for f in r], np.int64), len(rows)))
    (row_p, col_p, n_p), (row_u, col_u, n_u) = sides
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    mean, spread = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, STEPS + 1):
        z_p = np.bincount(row_p, w[col_p], n_p) + b
        z_u = np.bincount(row_u, w[col_u], n_u) + b
        negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        as_negative_p, as_negative_u = -prior * _sigmoid(z_p) / n_p, _sigmoid(z_u) / n_u
        if negative >= 0:
            by_p, by_u = as_negative_p - prior * _sigmoid(-z_p) / n_p, as_negative_u
        else:
            by_p, by_u = -as_negative_p, -as_negative_u
        of_features = np.bincount(col_p, by_p[row_p], n_features) + np.bincount(col_u, by_u[row_u], n_features) + PENALTY * w
        grad = np.r_[of_features, by_p.sum() + by_u.sum()]
        mean += 0.1 * (grad - mean)
        spread += 0.01 * (grad * grad - spread)
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


def fit(documents: DataFrame, labels: DataFrame, learn: Column) -> Model | None:
    """The model of ``documents`` (doc_id, text) and ``labels`` (doc_id, toxic), learned from rows whose doc_id meets ``learn``.

    Of a doc_id with several labels the largest counts. Labels that are null, without doc_id, or without a document
    are not used. None if no document is confirmed toxic.
    """
    drawn, prior = _sample(documents, labels, learn)
    sample = materialize(drawn, "toxic-sample")
    positives, unlabelled = sample.agg(F.count_if("positive"), F.count_if("unlabelled")).first()
    if not positives or not unlabelled:
        return None
    chosen = candidates(sample, positives, unlabelled)
    stems = sorted({stem for stem, _ in chosen})
    place = {stem: i for i, stem in enumerate(stems)}
    number = np.full((len(stems), LEVELS), -1, np.int64)
    for i, (stem, level) in enumerate(chosen):
        number[place[stem], level] = i
    if not chosen:
        return Model([], np.zeros((0, LEVELS)), float(np.log(prior / (1 - prior))), prior)
    shared = sample.sparkSession.sparkContext.broadcast((stems, number))
    rows = sample.mapInArrow(_features(shared), "positive boolean, unlabelled boolean, features array<int>").toArrow()
    features = rows["features"].to_pylist()
    found = sorted(zip(rows["positive"].to_pylist(), rows["unlabelled"].to_pylist(), features, strict=True))
    of_positive, of_unlabelled = [f for p, _, f in found if p], [f for _, u, f in found if u]
    total, bias = np.zeros(len(chosen)), 0.0
    for k in range(CLASSIFIERS):
        others = [f for i, f in enumerate(of_unlabelled) if i % CLASSIFIERS != k] or of_unlabelled
        w, b = train(of_positive, others, len(chosen), prior)
        total, bias = total + w / CLASSIFIERS, bias + b / CLASSIFIERS
    return Model(stems, np.where(number >= 0, total[number], 0.0), bias, prior)


def _probabilities(model: Model, texts: pa.Array) -> np.ndarray:
    if not model.stems:
        return np.full(len(texts), _sigmoid(np.array(model.bias)))
    _, owner, stem, n, size = _occurrences(texts, pa.array(model.stems, pa.large_string()))
    z = np.full(len(size), model.bias)
    for level, reached in enumerate(_levels(n, size[owner])):
        z += np.bincount(owner[reached], model.weights[stem[reached], level], len(size))
    return _sigmoid(z)


def score(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every whole text, without a shuffle.

    Null and empty texts have the score of a text without any feature. Without a model all scores are 0. Repeated rows
    are all scored; other columns are not read.
    """
    rows = documents.select("doc_id", "text")
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # MOST_FEATURES stems at most

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, SLICE):
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(_probabilities(shared.value, batch["text"]))], names=["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below ``threshold``, all columns as they are; all of them without a model."""
    if model is None:
        return documents
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, SLICE):
            yield batch.filter(pa.array(_probabilities(shared.value, batch["text"]) < threshold))

    return documents.mapInArrow(run, documents.schema)


def op13_toxicity(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out(F.col("doc_id")))
    return score(documents, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
