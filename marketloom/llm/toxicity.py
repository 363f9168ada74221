"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence is a bag of word features and has a probability p = sigmoid(bias + sum of
weights); weights are not negative, so that harmless words cannot outweigh an offence. A document is toxic if any of its sentences is: P = 1 - prod(1 - p), the
noisy-or, whose gradient with respect to the document's label trains the weights of the
sentences. The same weights then score every sentence of every text and point at the worst.

The features are a word's letters and its 4- and 5-letter pieces, so that marked stems are
found inside words never seen in training. The model is fitted on a bounded sample of the
labelled rows; everything else runs over all rows, in place, without shuffling texts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import fresh, small_batches, stored

SENTENCE = re.compile(r"[^.!?\n]+")
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Distinct words whose weight a task keeps before it starts anew.
CACHE = 200_000
THRESHOLD = 0.7


@dataclass(frozen=True)
class Fit:
    """sample: labelled rows at most, the bound on what is fitted; features: weights at most."""

    sample: int = 12_000
    features: int = 4_096
    seen_in: int = 4
    rounds: int = 150
    rate: float = 0.15
    lasso: float = 1e-5


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]


def features_of(word: str) -> tuple[str, ...]:
    """The word's letters in lower case and the pieces of 4 and 5 of them, its ends marked."""
    letters = NOT_LETTERS.sub("", word).lower()
    if not letters:
        return ()
    marked = f"<{letters}>"
    found = {marked}
    for n in (4, 5):
        found.update(marked[i : i + n] for i in range(len(marked) - n + 1))
    return tuple(found)


class _Kept(dict):
    """A value for each word, computed when it is first asked for; bounded."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = self.make(word)
        return value


def held_out(doc_id: Column) -> Column:
    """Whether the remainder of crc32 of the id as text, modulo 3, is 1; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> DataFrame:
    """text, toxic of at most fit.sample labelled rows, the first by a hash of their id."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.sample)
    # at most fit.sample rows of two numbers
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id").select("text", "toxic")


def _feature_counts(sample: DataFrame) -> DataFrame:
    """feature, pos, neg: in how many toxic and other texts of the sample a feature occurs."""
    schema = pa.schema([("feature", pa.string()), ("pos", pa.int64()), ("neg", pa.int64())])

    def run(batches):
        counts: dict[str, list[int]] = {}
        kept = _Kept(features_of)

        def flush():
            names = list(counts)
            for at in range(0, len(names), 50_000):
                part = names[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([counts[x][0] for x in part]), pa.array([counts[x][1] for x in part])], schema=schema)
            counts.clear()

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for feature in set().union(*map(kept.__getitem__, set(text.split()))):
                    if feature not in counts:
                        counts[feature] = [0, 0]
                    counts[feature][toxic == 0] += 1
                if len(counts) > 400_000:
                    yield from flush()
        yield from flush()

    return sample.mapInArrow(run, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def fit_noisy_or(texts: list[list[np.ndarray]], toxic: np.ndarray, n_features: int, fit: Fit) -> tuple[float, np.ndarray]:
    """Bias and non-negative weights that minimise the log loss of the noisy-or over documents plus
    lasso times the weights' sum, by projected Adam.

    texts: for each document its sentences, each an array of feature numbers.
    """
    n_sentences = np.array([len(x) for x in texts], np.int64)
    flat = [s for x in texts for s in x]
    doc_of = np.repeat(np.arange(len(texts)), n_sentences)
    ids = np.concatenate(flat) if flat else np.empty(0, np.int64)
    sentence_of = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
    y = toxic.astype(float)
    rate = min(max(y.mean(), 1e-4), 0.5)
    bias, w = math.log(rate / max(1.0, n_sentences.mean())), np.zeros(n_features)
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, fit.rounds + 1):
        z = np.clip(bias + np.bincount(sentence_of, w[ids], len(flat)), -30, 30)
        q = np.bincount(doc_of, np.logaddexp(0, z), len(texts))
        p = np.maximum(-np.expm1(-q), 1e-12)
        by_doc = np.where(y > 0, -np.exp(-q) / p, 1.0) / len(texts)
        by_sentence = by_doc[doc_of] / (1 + np.exp(-z))
        g = np.concatenate(([by_sentence.sum()], np.bincount(ids, by_sentence[sentence_of], n_features) + fit.lasso))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = fit.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        bias, w = bias - move[0], np.maximum(w - move[1:], 0)
    return float(bias), w


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """The model from labels' toxic marks, learnt only where held_out is false.

    Texts are the only inputs. Of the features in at least fit.seen_in sampled texts, the
    fit.features that speak most for a toxic mark are kept; they and their weights are what
    reaches the driver. Without labelled rows of both kinds nothing scores as toxic.
    """
    small_batches(docs.sparkSession)
    sample = stored(_sample(docs, labels, fit))
    totals = {r["toxic"] != 0: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = totals.get(True, 0), totals.get(False, 0)
    if not n_pos or not n_neg:
        return Model(-12.0, {})
    counts = _feature_counts(sample).filter(F.col("pos") + F.col("neg") >= fit.seen_in)
    share = (F.col("pos") + F.col("neg")) / (n_pos + n_neg)
    gain = (F.col("pos") / n_pos - F.col("neg") / n_neg) / F.sqrt(share * (1 - share) + F.lit(1e-6))
    names = [r["feature"] for r in counts.filter(gain > 0).orderBy(gain.desc(), "feature").limit(fit.features).select("feature").collect()]
    number = {x: i for i, x in enumerate(names)}

    def run(batches):
        kept = _Kept(lambda word: tuple(number[x] for x in features_of(word) if x in number))
        texts, marks = [], []
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sentences = [np.array([x for word in s.split() for x in kept[word]], np.int64) for s in SENTENCE.findall(text)]
                # sentences without features all score alike; they stay, as their number matters
                texts.append(sentences or [np.empty(0, np.int64)])
                marks.append(toxic != 0)
        if texts:
            bias, w = fit_noisy_or(texts, np.array(marks), len(number), fit)
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(w))], pa.int64()), pa.array([bias, *w.tolist()], pa.float64())], names=["number", "weight"])

    # the sample is bounded, so one task can hold its feature numbers
    found = {r["number"]: r["weight"] for r in sample.coalesce(1).mapInArrow(run, "number long, weight double").collect()}
    return Model(found.pop(-1), {names[i]: w for i, w in found.items() if abs(w) > 1e-3})


def score_text(text: str, bias: float, weight) -> tuple[float, int, int, float]:
    """Noisy-or score of a text; start, end and score of its worst sentence (the first of equals).
    A text without sentences counts as one empty sentence."""
    total, worst = 0.0, None
    for found in SENTENCE.finditer(text):
        z = bias + sum(map(weight, found.group().split()))
        if worst is None or z > worst[2]:
            worst = (found.start(), found.end(), z)
        total += z if z > 30 else math.log1p(math.exp(z))
    if worst is None:
        total, worst = math.log1p(math.exp(bias)), (0, 0, bias)
    start, end, top = worst
    return -math.expm1(-total), start, end, 1 / (1 + math.exp(-top)) if top > -30 else 0.0


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs' rows, all columns kept, with score, predicted, worst_start, worst_end, worst_score.

    worst_start and worst_end are code-point offsets of the sentence likeliest to offend. A
    null text scores as an empty one. Columns of these names in docs are replaced.
    """
    small_batches(docs.sparkSession)
    added = ["score", "predicted", "worst_start", "worst_end", "worst_score"]
    base = docs.drop(*added)
    bias, weights = model.bias, model.weights

    def run(batches):
        kept = _Kept(lambda word: sum(weights.get(x, 0.0) for x in features_of(word)))
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            found = [score_text(x.as_py(), bias, kept.__getitem__) for x in text]
            scores = [min(1.0, max(0.0, x[0])) for x in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array([int(x >= threshold) for x in scores], pa.int32()),
                 pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.int32()), pa.array([x[3] for x in found], pa.float64())],
                names=[*batch.schema.names[:-1], *added])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.withColumn(fresh(base, "_scored_text"), F.coalesce(F.col("text"), F.lit(""))).mapInArrow(run, f"{schema}, score double, predicted int, worst_start int, worst_end int, worst_score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """doc_id, held_out, score, predicted and the worst sentence for every row of docs.

    An empty table gives no rows; repeated ids are scored row by row.
    """
    model = train(docs, labels, fit)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "worst_start", "worst_end", "worst_score")


def reject_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that are predicted toxic; columns as in docs."""
    return score(docs, train(docs, labels)).filter("predicted = 0").select(*docs.columns)
