"""Quality classifier: a support vector machine over n-grams scaled by naive Bayes ratios.

A text is the set of its byte n-grams, pairs as they are and triples hashed into
``TRIPLES`` places, and of the n-grams of its repeats: for ``SPAN`` words in a row, which of them
are the word before them again. Every n-gram is scaled by its log-count ratio, the logarithm of its
share in the documents of label 1 over its share in those of label 0, and the text's
vector is brought to length 1. A linear hinge-loss model is fitted to these vectors
by dual coordinate descent: one multiplier a document, changed in turn to its best
value, while the weights follow. Margins become probabilities through a logistic
curve, fitted to the margins of documents that the model of the other half has not
seen and weighed to the share of the labels among all labelled documents.

The fit runs on the driver, on at most ``ROWS`` documents of each label, chosen by the hash
of the id; their n-grams are gathered by Spark. Scores come from whole texts at
the scan, with no shuffle, so hot keys and copies change nothing there.

Null and empty texts have no n-gram and get the score of the bias alone. Labels other
than 0 and 1, of documents that are not there or without an id are left out; an id with
both labels counts for both; documents of one id are learnt from once, by their
least text. With labels of one kind or none, all scores are the share of the label.
Equal texts get equal scores; an empty table gives an empty one.
"""

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foralytics.llm.common import remainder_of_id, slices, table

PAIRS = 1 << 16
TRIPLES = 1 << 17
# Words in a row of which it counts whether each repeats the one before.
SPAN = 4
REPEATS = 1 << SPAN
FEATURES = PAIRS + TRIPLES + REPEATS
# Labelled documents of each label that are learnt from: the documented bound of the fit.
ROWS = 2000
SMOOTHING = 1.0
# Weight of the hinge loss against the length of the weights.
COST = 4.0
EPOCHS = 40
TOLERANCE = 0.01
# A document counts as good from this score on.
GOOD = 0.3
TEXT_BYTES = 4 << 20


def ngrams(text: bytes, place: np.ndarray) -> np.ndarray:
    """The distinct n-grams of a text; ``place`` is working space of ``FEATURES`` numbers."""
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(data) < 2:
        return np.zeros(0, np.int64)
    two = data[:-1] | data[1:] << np.uint32(8)
    three = two[:-1] | data[2:] << np.uint32(16)
    hashed = (three * np.uint32(0x9E3779B1) >> np.uint32(15)) + np.uint32(PAIRS)
    found = np.concatenate([two, hashed]).astype(np.int64)
    at = np.arange(len(found), dtype=place.dtype)
    # The last of equal n-grams stays in its place, so each is found once.
    place[found] = at
    return np.concatenate([found[place[found] == at], repeats(text)])


def repeats(text: bytes) -> np.ndarray:
    """The distinct n-grams of repeated words."""
    words = text.split()
    if len(words) <= SPAN:
        return np.zeros(0, np.int64)
    again = np.fromiter(map(operator.eq, words[1:], words), np.int64, len(words) - 1)
    codes = sum(again[k : len(again) - SPAN + 1 + k] << k for k in range(SPAN))
    return np.flatnonzero(np.bincount(codes, minlength=REPEATS)) + PAIRS + TRIPLES


@dataclass
class Model:
    """``ratio`` scales n-grams, ``weight`` judges the scaled ones; ``curve`` turns margins into scores."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    curve: tuple[float, float]

    def margin(self, found: np.ndarray) -> float:
        scale = self.ratio[found]
        length = float(np.sqrt(scale @ scale))
        return self.bias + (float(scale @ self.weight[found]) / length if length else 0.0)

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * margin + self.curve[1], -60, 60)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Logarithm of every n-gram's share among the indicators of label 1 over that among those of label 0."""
    shares = []
    for label in (1, 0):
        counts = np.full(FEATURES, SMOOTHING)
        for i in np.flatnonzero(labels == label):
            counts[rows[i]] += 1
        shares.append(counts / counts.sum())
    return np.log(shares[0] / shares[1])


def dual_descent(
    rows: list[np.ndarray], values: list[np.ndarray], sides: np.ndarray, bounds: np.ndarray, seed: int = 1
) -> tuple[np.ndarray, float, np.ndarray]:
    """(weights, bias, multipliers) of least hinge loss: |w|^2 / 2 + sum of bounds * max(0, 1 - side * margin).

    ``sides`` are 1 and -1; the bias is the weight of one more value, always 1.
    """
    weight, bias = np.zeros(FEATURES), 0.0
    held = np.zeros(len(rows))
    squares = np.array([v @ v + 1 for v in values])
    random = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in random.permutation(len(rows)).tolist():
            slope = sides[i] * (weight[rows[i]] @ values[i] + bias) - 1
            open_slope = min(slope, 0.0) if held[i] <= 0 else max(slope, 0.0) if held[i] >= bounds[i] else slope
            if open_slope:
                worst = max(worst, abs(open_slope))
                new = min(max(held[i] - slope / squares[i], 0.0), bounds[i])
                move = (new - held[i]) * sides[i]
                held[i] = new
                weight[rows[i]] += move * values[i]
                bias += move
        if worst < TOLERANCE:
            break
    return weight, bias, held


def logistic_curve(margins: np.ndarray, truth: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the likeliest logistic curve, by Newton's steps with a weak pull to slope 1."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -60, 60)))
        rest, bend = weights * (chance - truth), weights * chance * (1 - chance) + 1e-9
        gradient = np.array([rest @ margins + 1e-2 * (slope - 1), rest.sum()])
        curvature = np.array([[bend @ margins**2 + 1e-2, bend @ margins], [bend @ margins, bend.sum() + 1e-6]])
        step = np.linalg.solve(curvature, gradient)
        # Halved steps keep a separable sample from running off.
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(slope), 1e-6), float(offset)


def _machine(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    ratio = log_count_ratios(rows, labels)
    values = []
    for found in rows:
        scale = ratio[found]
        values.append(scale / max(1e-12, np.sqrt(scale @ scale)))
    # Both labels weigh the same in the loss.
    share = 0.5 / np.maximum(1, np.bincount(labels, minlength=2)) * len(labels)
    weight, bias, _ = dual_descent(rows, values, np.where(labels == 1, 1.0, -1.0), COST * share[labels])
    return Model(ratio, weight, bias, (1.0, 0.0))


def fit(rows: list[np.ndarray], labels: np.ndarray, counts: tuple[int, int]) -> Model:
    """The model of the sampled n-gram sets; ``counts`` are the labelled documents of label 0 and 1 in all."""
    prior = (counts[1] + 1) / (sum(counts) + 2)
    constant = Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, (1.0, float(np.log(prior / (1 - prior)))))
    if min(np.bincount(labels, minlength=2)) < 2:
        return constant
    # Every other document of a label, so both halves have both.
    half = np.zeros(len(labels), np.int64)
    for label in (0, 1):
        mine = np.flatnonzero(labels == label)
        half[mine] = np.arange(len(mine)) % 2
    margins = np.zeros(len(labels))
    for side in (0, 1):
        model = _machine([rows[i] for i in np.flatnonzero(half != side)], labels[half != side])
        for i in np.flatnonzero(half == side):
            margins[i] = model.margin(rows[i])
    shares = np.array([1 - prior, prior]) / np.bincount(labels, minlength=2) * len(labels)
    whole = _machine(rows, labels)
    whole.curve = logistic_curve(margins, labels.astype(float), shares[labels])
    return whole


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = np.zeros(FEATURES, np.int64)
    for batch in slices(batches, "text", TEXT_BYTES):
        found = [ngrams(text.as_buffer().to_pybytes(), place).astype("<i4").tobytes() for text in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["doc_id", "label", "ngrams"])


def learn(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    """The model of ``labels`` (doc_id, label 0 or 1) on the texts of ``docs`` (doc_id, text).

    Up to ``rows`` documents of each label are learnt from, by the hash of the id.
    """
    known = labels.where("label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    there = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {r["label"]: r["count"] for r in there.groupBy("label").count().collect()}
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = [there.where(F.col("label") == label).orderBy(*order).limit(rows) for label in (0, 1)]
    # At most 2 x ``rows`` ids and labels are broadcast.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")
    once = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    found = once.mapInArrow(_gather, "doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", label int, ngrams binary")
    sampled = sorted(found.collect(), key=lambda r: (r["label"], r["doc_id"]))
    sets = [np.frombuffer(r["ngrams"], "<i4").astype(np.int64) for r in sampled]
    return fit(sets, np.array([r["label"] for r in sampled], np.int64), (counts.get(0, 0), counts.get(1, 0)))


def _judge(model: Model, name: str):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.zeros(FEATURES, np.int64)
        for batch in slices(batches, "text", TEXT_BYTES):
            texts = batch.column(batch.schema.get_field_index("text"))
            margins = [model.margin(ngrams(t.as_buffer().to_pybytes() if t.is_valid else b"", place)) for t in texts]
            scores = pa.array(model.score(np.array(margins, float)))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    return judge


def with_quality(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 by the whole of column ``text``, its only input; ``name`` must be new."""
    if name in docs.columns:
        raise ValueError(f"column {name} is there already")
    return docs.mapInArrow(_judge(model, name), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = GOOD) -> DataFrame:
    """Rows of ``docs`` that score ``least`` or more, by the model of ``labels``; all columns stay.

    ``docs`` must have no column ``__quality``.
    """
    return with_quality(docs, learn(docs, labels), "__quality").where(F.col("__quality") >= least).drop("__quality")


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by the quality labels of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = remainder_of_id(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    scored = with_quality(docs.select("doc_id", held_out.alias("held_out"), "text"), learn(docs, labels))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
