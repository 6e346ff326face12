"""Language identification by a linear-chain conditional random field over words.

Every word has the sum of the weights of its features as its score for each language: byte n-grams, prefixes and
suffixes (all hashed to up to FEATURES places), and itself if it is in the lexicon of the training sample. Transition
weights tie the languages of neighbouring words. Forward-backward gives each word its distribution over the
languages given the whole text, so a text that switches languages is labelled word by word; the shares of a
document are the means over its words that have a letter.

The weights are fitted on a bounded sample of labelled documents (TRAIN_DOCS a language and SAMPLE_DOCS in all, TRAIN_WORDS words
of each; every language that has a label is learned), joined to sequences that also switch languages, by full-batch gradient steps on the likelihood. Distinct words are
scored once a batch, and the recursions run over all documents of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.shingles import factors, mix
from runnel.llm.text_arrays import pieces, tidy, utf8, words

#: Bounds of the training sample: documents a language (about, and three times as many at most), and words of each.
TRAIN_DOCS, TRAIN_WORDS = 300, 120
#: Bytes of text that a Python worker labels at once.
PIECE = 1 << 20
#: Distinct words whose features (some dozens of numbers each) are held at once when texts are labelled.
WORDS = 1 << 13
#: Places that features are hashed to, and weights of a model at most (64 MB); more languages have fewer places.
FEATURES, MOST_WEIGHTS, LEAST_FEATURES = 1 << 16, 1 << 24, 1 << 10
SEQUENCE, STEPS = 40, 30
#: Words of a long text that the recursions take as one run; with more languages than MOST_CUT, of which a run would need
#: the square, texts are not cut, which gives the same marginals.
RUN, MOST_CUT = 128, 16
#: Numbers of an array of (words or features, languages) that are worked on at once, and documents of the sample in all.
BLOCK, SAMPLE_DOCS = 1 << 24, 300 * 16
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (features + 1, languages); the last row stays 0
    transitions: np.ndarray
    lexicon: np.ndarray  # sorted hashes of words


def feature_count(languages: int) -> int:
    """The largest power of two up to FEATURES with which the weights stay within MOST_WEIGHTS."""
    places = min(FEATURES, 1 << (MOST_WEIGHTS // languages).bit_length() - 1) if languages <= MOST_WEIGHTS else 0
    if places < LEAST_FEATURES:
        raise ValueError(f"{languages} languages are more than a model of {MOST_WEIGHTS} weights can tell apart")
    return places


def word_features(distinct: pa.LargeStringArray, lexicon: np.ndarray | None, places: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all words one after another, where each word's begin, and the hashes of the words."""
    data, offsets = utf8(pc.utf8_lower(distinct))
    n = len(offsets) - 1
    size = np.diff(offsets)
    # Each word between two marks.
    ends = np.cumsum(size + 2)
    begin = ends - size - 2
    padded = np.empty(int(ends[-1]) if n else 0, np.uint64)
    inner = np.ones(len(padded), bool)
    inner[begin] = inner[ends - 1] = False
    padded[begin], padded[ends - 1], padded[inner] = 2, 3, data
    by = factors(8, 41)
    keys, owner = [], []
    word = np.repeat(np.arange(n), size + 2)
    stop = np.repeat(ends, size + 2)
    for k in (2, 3, 4):
        h = sum((padded[j : len(padded) - k + 1 + j] * by[j] for j in range(k)), np.zeros(max(0, len(padded) - k + 1), np.uint64))
        ok = np.flatnonzero(np.arange(len(h)) + k <= stop[: len(h)])
        keys.append(mix(h[ok] + by[7:] * np.uint64(k)))
        owner.append(word[ok])
    for k in (1, 2, 3):
        full = np.flatnonzero(size >= k)
        for side, at in ((1, begin[full] + 1), (2, ends[full] - 1 - k)):
            h = sum((padded[at + j] * by[j] for j in range(k)), np.zeros(len(full), np.uint64))
            keys.append(mix(h + by[6:7] * np.uint64(10 * side + k)))
            owner.append(full)
    position = mix(padded + by[2] * (np.arange(len(padded), dtype=np.int64) - np.repeat(begin, size + 2)).astype(np.uint64))
    total = np.r_[np.uint64(0), np.cumsum(position)]
    whole = mix(total[ends] - total[begin]) if n else np.zeros(0, np.uint64)
    place = [k % np.uint64(places) for k in keys]
    if lexicon is not None and len(lexicon):
        known = np.flatnonzero(lexicon[np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)] == whole)
        place.append((whole[known] ^ by[5]) % np.uint64(places))
        owner.append(known)
    owner_all = np.concatenate(owner)
    order = np.argsort(owner_all, kind="stable")
    counts = np.bincount(owner_all, minlength=n)
    return np.concatenate(place)[order].astype(np.int64), np.cumsum(counts) - counts, whole


def _scores(weights: np.ndarray, features: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """(words, languages): every word has a feature, as its marks make one n-gram at least."""
    if not len(begins):
        return np.zeros((0, weights.shape[1]), np.float32)
    ends = np.r_[begins[1:], len(features)]
    out = np.empty((len(begins), weights.shape[1]), np.float32)
    most, i = max(1, BLOCK // weights.shape[1]), 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(ends, begins[i] + most, side="right")))
        out[i:j] = np.add.reduceat(weights[features[begins[i] : ends[j - 1]]], begins[i:j] - begins[i], axis=0)
        i = j
    return out / np.sqrt(ends - begins)[:, None].astype(np.float32)


def _passages(local: np.ndarray, first: np.ndarray, size: np.ndarray, move: np.ndarray) -> np.ndarray:
    """(runs, languages, languages): from the message that enters a run to the state of its last word, up to a factor."""
    order = np.argsort(-size, kind="stable")
    at, size = first[order], size[order]
    out = np.eye(len(move))[None] * local[at][:, :, None]
    for t in range(1, int(size[0])):
        n = len(size) - int(np.searchsorted(size[::-1], t, side="right"))
        step = (out[:n] @ move) * local[at[:n] + t][:, None, :]
        out[:n] = step / step.max(axis=(1, 2), keepdims=True)
    back = np.empty_like(out)
    back[order] = out
    return back


def _runs_of_texts(local: np.ndarray, bounds: np.ndarray, move: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into runs of up to ``run`` words: begins, sizes, and the messages that enter from before and from behind.

    The recursions take as many steps as the longest text has words; a message crosses a whole run in one step.
    """
    size = np.diff(bounds)
    runs = -(-size // run)
    of = np.repeat(np.arange(len(size)), runs)
    turn = np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs)
    first = bounds[:-1][of] + turn * run
    length = np.minimum(run, bounds[1:][of] - first)
    enter, leave = np.ones((len(of), len(move))), np.ones((len(of), len(move)))
    several = np.flatnonzero(runs[of] > 1)
    if len(several):
        passage = np.zeros((len(of), *move.shape))
        passage[several] = _passages(local, first[several], length[several], move)
        for k in range(1, int(runs.max())):
            here = np.flatnonzero(turn == k)
            message = (enter[here - 1][:, None, :] @ passage[here - 1])[:, 0] @ move
            enter[here] = message / message.sum(axis=1, keepdims=True)
        for k in range(int(runs.max()) - 1, 0, -1):
            here = np.flatnonzero(turn == k)
            message = (passage[here] @ leave[here][:, :, None])[:, :, 0] @ move.T
            leave[here - 1] = message / message.sum(axis=1, keepdims=True)
    return first, length, enter, leave


def marginals(scores: np.ndarray, bounds: np.ndarray, transitions: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """Distribution of each word over the languages by forward-backward, all texts at once.

    To ``pairs`` the expected number of times that language j follows language i is added; then texts are not cut.
    """
    top = scores.max(axis=1, keepdims=True) if len(scores) else scores
    local = np.exp(scores - top).astype(np.float32)
    move = np.exp(transitions).astype(np.float32)
    whole = int(np.diff(bounds).max(initial=1))
    cut = pairs is None and len(move) <= MOST_CUT
    begin, size, enter, leave = _runs_of_texts(local, bounds, move, RUN if cut else max(1, whole))
    order = np.argsort(-size, kind="stable")
    begin, size, enter, leave = begin[order], size[order], enter[order].astype(np.float32), leave[order].astype(np.float32)
    steps = int(size[0]) if len(size) else 0
    ones = np.ones((len(move), 1), np.float32)  # sums over languages
    active = len(size) - np.searchsorted(size[::-1], np.arange(steps), side="right")
    forward = np.empty_like(local)
    state = None
    for t in range(steps):
        at = begin[: active[t]] + t
        state = enter * local[at] if t == 0 else (state[: active[t]] @ move) * local[at]
        state = state / (state @ ones)
        forward[at] = state
    back = leave[:0]
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        if len(back) < n:
            back = np.concatenate([back, leave[len(back) : n]])
        joint = forward[at] * back
        forward[at] = joint / (joint @ ones)
        ahead = local[at] * back
        if pairs is not None and t:
            before = forward[at - 1]
            pairs += move * ((before / ((before @ move) * ahead).sum(axis=1, keepdims=True)).T @ ahead)
        back = ahead @ move.T
        back /= back @ ones
    return forward


def train(samples: list[tuple[str, list[str]]], seed: int = 3) -> Model:
    """Fit the field on (language, words) samples."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in samples})
    n = len(languages)
    of = {lang: i for i, lang in enumerate(languages)}
    text = pa.array([w for _, ws in samples for w in ws], pa.large_string())
    coded = text.dictionary_encode()
    code, label = coded.indices.to_numpy(), np.repeat([of[lang] for lang, _ in samples], [len(ws) for _, ws in samples])
    places = feature_count(n)
    _, _, whole = word_features(coded.dictionary, None, places)
    lexicon = np.unique(whole[np.bincount(code, minlength=len(whole)) >= 3])
    features, begins, _ = word_features(coded.dictionary, lexicon, places)
    counts = np.diff(np.r_[begins, len(features)])
    owner, share = np.repeat(np.arange(len(begins)), counts), 1 / np.sqrt(np.repeat(counts, counts))
    # Runs of one language of 4 to SEQUENCE words, dealt into sequences at random: most switch now and then.
    cuts, at = [], 0
    ends = np.cumsum([len(ws) for _, ws in samples])
    for end in ends:
        while at < end:
            step = int(min(end - at, rng.integers(4, SEQUENCE + 1)))
            cuts.append((at, at + step))
            at += step
    turn = rng.permutation(len(cuts))
    index = np.concatenate([np.arange(*cuts[i]) for i in turn])
    code, label = code[index], label[index]
    bounds = np.unique(np.r_[np.arange(0, len(code), SEQUENCE), len(code)])
    inside = np.ones(len(code), bool)
    inside[bounds[:-1]] = False
    second = np.flatnonzero(inside)
    w, t = np.zeros((places + 1, n), np.float32), np.zeros((n, n))
    seen_t = np.zeros((n, n))
    np.add.at(seen_t, (label[second - 1], label[second]), 1)
    whole_blocks = max(1, BLOCK // n // SEQUENCE)
    blocks = [bounds[i : i + whole_blocks + 1] for i in range(0, len(bounds) - 1, whole_blocks)]
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    for step in range(1, STEPS + 1):
        scores = _scores(w, features, begins)
        pair = np.zeros((n, n))
        by_word = np.zeros((n, len(begins)))
        for at in blocks:
            here = slice(at[0], at[-1])
            off = -marginals(scores[code[here]], at - at[0], t, pair)
            off[np.arange(len(off)), label[here]] += 1
            for i in range(n):
                by_word[i] += np.bincount(code[here], off[:, i], len(begins))
        grad = -0.02 * w
        for i in range(n):
            grad[:, i] += np.bincount(features, by_word[i][owner] * share, places + 1)
        grad_t = (seen_t - pair) / len(code) * 50 - 0.02 * t
        for x, g, m, v in ((w, grad, moments[0], moments[1]), (t, grad_t, moments[2], moments[3])):
            m += 0.1 * (g - m)
            v += 0.05 * (g * g - v)
            x += 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.95**step)) + 1e-8)
    return Model(languages, w, t, lexicon)


def held_out(key: Column) -> Column:
    """Documents that are never learned from: CRC-32 of the doc_id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


@tidy
def _sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        data, offsets = utf8(batch["text"])
        all_words, bounds = words(data, offsets)
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            first = a + max(0, (b - a - TRAIN_WORDS) // 2)
            out.append(all_words.slice(first, min(b, first + TRAIN_WORDS) - first).to_pylist())
        columns = [batch["turn"], batch["lang"], pa.array(out, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["turn", "lang", "words"])


def fit(labelled: DataFrame) -> Model | None:
    """The model of rows (doc_id, text, lang), all of whose languages are learned.

    It is fitted on a sample by a hash of doc_id and text: about TRAIN_DOCS documents a language, fewer if all languages
    together had more than SAMPLE_DOCS, of each TRAIN_WORDS words. Rows that are equal are drawn together, so the sample is also cut at three times its
    expected size, in the order of the hash. Time grows with the square of the languages, memory in proportion to them; tests train and label
    with 200. More languages than a model has weights for (16,384) are an error. None if nothing is labelled.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    most = MOST_WEIGHTS // LEAST_FEATURES
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    n = counts.count()
    if not n:
        return None
    if n > most:
        raise ValueError(f"{n} languages are more than the {most} that a model can tell apart")
    docs = min(TRAIN_DOCS, -(-SAMPLE_DOCS // n))
    rates = counts.select(F.col("lang").alias("_lang"), F.least(F.lit(1.0), docs / F.col("n")).alias("rate"))
    u = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    drawn = rows.select("text", "lang", u.alias("u")).join(F.broadcast(rates), F.col("lang") == F.col("_lang")).filter("u < rate")
    drawn = drawn.select((F.col("u") / F.col("rate")).alias("turn"), "lang", "text")
    some = drawn.mapInArrow(_sample_words, "turn double, lang string, words array<string>")
    got = some.orderBy("turn", "lang", "words").limit(3 * docs * n).toArrow().to_pylist()
    samples = sorted((r["lang"], r["words"]) for r in got if r["words"])
    return train(samples) if samples else None


def _word_scores(model: Model, distinct: pa.LargeStringArray) -> np.ndarray:
    """(words, languages), the features of WORDS words at a time."""
    out = np.empty((len(distinct), len(model.languages)), np.float32)
    for i in range(0, len(distinct), WORDS):
        features, begins, _ = word_features(distinct.slice(i, WORDS), model.lexicon, len(model.weights) - 1)
        out[i : i + WORDS] = _scores(model.weights, features, begins)
    return out


def _label(model: Model, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the batch's texts: predicted language, score, and of their words: language and the bounds of the texts."""
    names = np.array(model.languages, object)
    data, offsets = utf8(batch["text"])
    all_words, bounds = words(data, offsets)
    coded = all_words.dictionary_encode()
    letter = pc.match_substring_regex(coded.dictionary, r"\p{L}").to_numpy(zero_copy_only=False)
    scores = _word_scores(model, coded.dictionary)
    scores[~letter] = 0
    code = coded.indices.to_numpy()
    p = marginals(scores[code], bounds, model.transitions)
    counted = letter[code]
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[counted]
    n = np.bincount(text, minlength=len(bounds) - 1)
    mass = np.stack([np.bincount(text, p[counted, i], len(n)) for i in range(len(names))], axis=1)
    best = mass.argmax(axis=1)
    score = np.where(n > 0, mass[np.arange(len(best)), best] / np.maximum(n, 1), 0.0)
    of_words = p.argmax(axis=1) if len(p) else np.zeros(0, int)
    return np.where(n > 0, names[best], UNKNOWN), np.clip(score, 0, 1), of_words, bounds


def _piece(model: Model) -> int:
    """Bytes of text at once: fewer where each word has more numbers."""
    return PIECE * MOST_CUT // max(MOST_CUT, len(model.languages))


def _runs(model: Model, of_words: np.ndarray, bounds: np.ndarray) -> pa.Array:
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        cut = a + np.flatnonzero(np.r_[True, np.diff(of_words[a:b]) != 0])[: b - a]
        stop = np.r_[cut[1:], b] if len(cut) else cut
        out.append([{"first": int(i - a), "words": int(j - i), "lang": model.languages[of_words[i]]} for i, j in zip(cut, stop, strict=True)])
    return pa.array(out, pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())])))


def _predict(shared, spans: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in pieces(batches, _piece(model)):
            pred, score, of_words, bounds = _label(model, batch)
            columns = [batch["doc_id"], pa.array(pred, pa.string()), pa.array(score)]
            if spans:
                columns.append(_runs(model, of_words, bounds))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "spans"][: len(columns)])

    return run


#: A document whose best language has less than this share of its words is rejected.
LEAST_SCORE = 0.4


def keep_identified(documents: DataFrame, model: Model | None, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is found with ``least_score`` or more, all columns as they are, without a shuffle.

    Without a model nothing can be judged and all stay.
    """
    if model is None:
        return documents
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, _piece(shared.value)):
            pred, score, _, _ = _label(shared.value, batch)
            yield batch.filter(pa.array((pred != UNKNOWN) & (score >= least_score)))

    return documents.mapInArrow(run, documents.schema)


def identify(documents: DataFrame, model: Model | None, spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score of every whole text; with ``spans`` also its runs of words of one language.

    Score is the mean, over the words with a letter, of the probability of the predicted language. ``und`` with
    score 0 where the text is null, empty or has no letter, and everywhere if nothing could be learned. Ties go to
    the first language by code point. Repeated rows are all predicted; other columns are not read.
    """
    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    extra = ", spans array<struct<first:int,words:int,lang:string>>" if spans else ""
    if model is None:
        out = rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        return out.withColumn("spans", F.lit(None).cast("array<struct<first:int,words:int,lang:string>>")) if spans else out
    shared = documents.sparkSession.sparkContext.broadcast(model)  # MOST_WEIGHTS weights at most
    return rows.mapInArrow(_predict(shared, spans), f"doc_id {kind}, lang_pred string, score double{extra}")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(documents.filter(~held_out(F.col("doc_id"))))
    found = identify(documents, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
