import math
import random
import zlib

import numpy as np
import pytest
import tables
from pyspark.sql import functions as F

from foralytics.llm.quality_classifier import (
    FEATURES, GOOD, PAIRS, SMOOTHING, TRIPLES, dual_descent, fit, keep_good, learn, log_count_ratios, logistic_curve, ngrams, op12_quality, with_quality,
)


def plain_ngrams(text):
    """Pairs by their value, triples by the multiplicative hash of theirs, and which of four words are the one before."""
    data = text.encode()
    pairs = {a | b << 8 for a, b in zip(data, data[1:])}
    triples = {PAIRS + (((a | b << 8 | c << 16) * 0x9E3779B1 % 2**32) >> 15) for a, b, c in zip(data, data[1:], data[2:])}
    words = data.split()
    again = [a == b for a, b in zip(words, words[1:])]
    spans = {PAIRS + TRIPLES + sum(again[i + k] << k for k in range(4)) for i in range(len(again) - 3)}
    return pairs | triples | spans


def corpus(n=400, seed=1):
    random.seed(seed)
    rows, labels = [], []
    for i in range(n):
        good = random.random() < 0.7
        words = [random.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(random.randint(0, 50)) for _ in range(random.randint(3, 60))]
        rows.append((i, " ".join(w if good or random.random() < 0.5 else w + random.choice(["$$", "!!", "###"]) for w in words), "en", "a"))
        if i % 3:
            labels.append((i, int(good), 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def test_ngrams_against_plain_sets():
    place = np.zeros(FEATURES, np.int64)
    random.seed(5)
    for text in ["", "a", "ab", "aaaa", "漢字 かな 🙂🙂", "x" * 5000, "b b b b", "b b b b b", "a b b c c c d d d d d e"] + ["".join(random.choice("ab \n$é") for _ in range(random.randint(0, 400))) for _ in range(50)]:
        found = ngrams(text.encode(), place)
        assert len(found) == len(set(found.tolist())) and set(found.tolist()) == plain_ngrams(text)


def test_ratios_against_plain_counts():
    place = np.zeros(FEATURES, np.int64)
    texts, labels = ["abc", "abd", "xyz", "abx"], np.array([1, 1, 0, 0])
    ratio = log_count_ratios([ngrams(t.encode(), place) for t in texts], labels)
    total = {label: SMOOTHING * FEATURES + sum(len(plain_ngrams(t)) for t, k in zip(texts, labels) if k == label) for label in (0, 1)}
    for feature in set().union(*map(plain_ngrams, texts)) | {0}:
        count = {label: sum(feature in plain_ngrams(t) for t, k in zip(texts, labels) if k == label) for label in (0, 1)}
        wanted = math.log((count[1] + SMOOTHING) / total[1]) - math.log((count[0] + SMOOTHING) / total[0])
        assert ratio[feature] == pytest.approx(wanted, abs=1e-12)


def test_dual_descent_closes_the_gap():
    random = np.random.default_rng(3)
    rows = [random.choice(40, 6, replace=False) for _ in range(120)]
    values = [random.standard_normal(6) for _ in rows]
    sides = np.where(random.random(len(rows)) < 0.4, 1.0, -1.0)
    bounds = random.uniform(0.3, 2, len(rows))
    weight, bias, held = dual_descent(rows, values, sides, bounds)
    margins = np.array([weight[r] @ v + bias for r, v in zip(rows, values)])
    primal = 0.5 * (weight @ weight + bias**2) + bounds @ np.maximum(0, 1 - sides * margins)
    dual = held.sum() - 0.5 * (weight @ weight + bias**2)
    assert (held >= 0).all() and (held <= bounds).all()
    assert 0 <= primal - dual < 0.02 * primal
    # No nearby weights do better.
    for _ in range(50):
        move, shift = random.standard_normal(FEATURES) * 0.01, float(random.standard_normal() * 0.01)
        other = np.array([(weight + move)[r] @ v + bias + shift for r, v in zip(rows, values)])
        assert 0.5 * ((weight + move) @ (weight + move) + (bias + shift) ** 2) + bounds @ np.maximum(0, 1 - sides * other) > dual


def test_curve_against_a_grid():
    random = np.random.default_rng(8)
    margins = random.standard_normal(300)
    truth = (random.random(300) < 1 / (1 + np.exp(-(2 * margins - 0.5)))).astype(float)
    weights = random.uniform(0.5, 2, 300)

    def loss(slope, offset):
        z = slope * margins + offset
        return weights @ (np.log1p(np.exp(z)) - truth * z) + 0.5e-2 * (slope - 1) ** 2

    best = logistic_curve(margins, truth, weights)
    assert all(loss(*best) <= loss(best[0] + a, best[1] + b) + 1e-9 for a in (-0.1, -0.01, 0, 0.01, 0.1) for b in (-0.1, -0.01, 0, 0.01, 0.1))


def test_scores_of_unseen_documents(spark, tmp_path):
    rows, labels = corpus()
    tables.save(tables.documents(spark, rows, extra=True), tmp_path)
    truth = {i: q for i, q, _ in labels}
    # Labels of held-out documents are the other way round: they must not be looked at.
    wrong = [(i, 1 - q if held_out(i) else q, t) for i, q, t in labels]
    folder = tables.save(spark.createDataFrame([*wrong, (None, 1, 0), (10**9, 0, 0), (5, None, 0)], LABELS), tmp_path, "labels")
    found = op12_quality(spark, folder)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = found.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= GOOD) and r["held_out"] == held_out(r["doc_id"]) for r in got)
    unseen = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in unseen) > 0.85 * len(unseen)
    assert sorted((r["doc_id"], r["score"]) for r in found.collect()) == sorted((r["doc_id"], r["score"]) for r in got)


def test_held_out_documents_of_the_test_table(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    got = op12_quality(spark, folder).where("held_out").join(truth, "doc_id").collect()
    bad, good = ([r["score"] for r in got if r["quality"] == q] for q in (0, 1))
    above = sum((b < g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert len(got) > 50 and above > 0.9
    assert sum(r["predicted"] == r["quality"] for r in got) > 0.9 * len(got)


def test_repeated_words_are_told_from_prose(spark):
    random.seed(11)
    rows, labels = [], []
    for i in range(300):
        words = ["".join(random.choice("abcdefgh") for _ in range(random.randint(2, 6))) for _ in range(60)]
        good = i % 3 > 0
        rows.append((i, " ".join(words if good else [w for w in words[:10] for _ in range(6)]), "en", "a"))
        labels.append((i, int(good), 0))
    model = learn(tables.documents(spark, rows[:200]), spark.createDataFrame(labels, LABELS).withColumnRenamed("quality", "label"))
    got = with_quality(tables.documents(spark, rows[200:]), model).collect()
    assert sum((r["score"] >= GOOD) == (r["doc_id"] % 3 > 0) for r in got) == len(got)


def test_awkward_rows(spark):
    rows, labels = corpus(120)
    model = learn(tables.documents(spark, rows), spark.createDataFrame(labels, LABELS).withColumnRenamed("quality", "label"))
    docs = tables.documents(spark, [*tables.awkward_rows(), (None, "alpha1", None, None)], extra=True).drop("score")
    scored = with_quality(docs, model)
    assert set(scored.columns) == {*docs.columns, "score"}
    by_text = {}
    for r in scored.collect():
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    place = np.zeros(FEATURES, np.int64)
    text = "漢字 かな été 🙂🙂 naïve"
    vector = np.zeros(FEATURES)
    vector[sorted(plain_ngrams(text))] = 1
    vector *= model.ratio
    margin = model.weight @ vector / np.sqrt(vector @ vector) + model.bias
    assert by_text[text] == pytest.approx(1 / (1 + math.exp(-(model.curve[0] * margin + model.curve[1]))))
    assert len(ngrams(b"", place)) == 0 and model.margin(ngrams(b"", place)) == model.bias
    with pytest.raises(ValueError):
        with_quality(docs, model, "text")
    assert with_quality(tables.empty(spark), model).count() == 0


def test_one_label_or_none(spark):
    docs = tables.documents(spark)
    for labels, share in (([], 0.5), ([(1, 1), (2, 1)], 0.75), ([(1, 0), (1, 0), (99, 1)], 1 / 3)):
        model = learn(docs, spark.createDataFrame(labels, "doc_id long, label int"))
        scores = {round(r["score"], 12) for r in with_quality(docs, model).collect()}
        assert scores == {round(share, 12)}
    assert learn(tables.empty(spark), spark.createDataFrame([(1, 1)], "doc_id long, label int")).curve[1] == 0


def test_filter_keeps_columns(spark):
    rows, labels = corpus(150)
    docs = tables.documents(spark, rows, extra=True)
    kept = keep_good(docs, spark.createDataFrame(labels, LABELS).withColumnRenamed("quality", "label"))
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)
    assert kept.where(F.col("text").contains("$$") & F.col("text").contains("###") & (F.length("text") > 300)).count() == 0


def test_fit_is_the_share_without_both_labels():
    assert fit([np.zeros(0, np.int64)] * 3, np.array([1, 1, 1]), (0, 3)).score(np.zeros(1))[0] == pytest.approx(0.8)
