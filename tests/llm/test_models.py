"""Context-tree weighting against a recursive version, the network against differences and held-out labels."""

import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from tables import documents, empty, prose, rows, save

from foralytics.llm import context_tree as ctw
from foralytics.llm import language_id
from foralytics.llm.queries import QUERIES
from foralytics.llm.scoring import language_model_scores


def test_log_gamma():
    xs = [0.5, 1.0, 1.5, 2.5, 7.5, 8.0, 30.5, 1e6]
    assert ctw.log_gamma(np.array(xs)) == pytest.approx([math.lgamma(x) for x in xs], abs=1e-9, rel=1e-12)


class PlainTree:
    """The trees as a dictionary of (context, known bits) -> [zeros, ones]."""

    def __init__(self, texts):
        self.counts = {}
        for text in texts:
            for context, symbol in self.steps(text):
                for level in range(8):
                    for depth in range(ctw.DEPTH + 1):
                        node = (context[ctw.DEPTH - depth :], symbol >> (8 - level), level)
                        self.counts.setdefault(node, [0, 0])[(symbol >> (7 - level)) & 1] += 1
        self.children = {}
        for context, known, level in self.counts:
            if context:
                self.children.setdefault((context[1:], known, level), []).append((context, known, level))
        self.weighted = {}
        self.weight = {}
        for node in sorted(self.counts, key=lambda x: -len(x[0])):
            a, b = self.counts[node]
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
            if len(node[0]) == ctw.DEPTH:
                self.weight[node], self.weighted[node] = 1.0, own
                continue
            below = sum(self.weighted[c] for c in self.children[node])
            self.weight[node] = math.exp(own - np.logaddexp(own, below))
            self.weighted[node] = np.logaddexp(own, below) - math.log(2)

    @staticmethod
    def steps(text):
        data = bytes(ctw.DEPTH) + text.encode() + b"\0"
        return [(data[i - ctw.DEPTH : i], data[i]) for i in range(ctw.DEPTH, len(data))]

    def score(self, text):
        total = 0.0
        for context, symbol in self.steps(text):
            for level in range(8):
                bit, chance = (symbol >> (7 - level)) & 1, None
                for depth in range(ctw.DEPTH, -1, -1):
                    node = (context[ctw.DEPTH - depth :], symbol >> (8 - level), level)
                    counts = self.counts.get(node)
                    if counts is None:
                        continue
                    own = (counts[bit] + 0.5) / (sum(counts) + 1)
                    w = self.weight[node]
                    chance = own if chance is None else w * own + (1 - w) * chance
                total += math.log10(0.5 if chance is None else chance)
        return total


def scored_rows():
    random.seed(8)
    texts = [prose(20 + i, random.randint(1, 25)) for i in range(30)] + ["", None, "été 漢字", "\0 a", prose(20, 5).upper(), "zq\n\tzq"]
    return [(i, t, "en", "s") for i, t in enumerate(texts)]


def test_scores_equal_the_recursion(spark):
    from pyspark.sql import functions as F

    table = scored_rows()
    docs = documents(spark, table, extra=True).withColumn("held_out", F.col("doc_id") % 3 == 1)
    got = {r["doc_id"]: r for r in language_model_scores(docs, chunk_bytes=900, buckets=3).collect()}
    train = [t or "" for i, t, *_ in table if i % 3 != 1]
    tree = PlainTree(train)
    counts = Counter(w for t in train for w in [*brute.words(t, lower=True), None])
    n_all, n_distinct = sum(counts.values()), len(counts)
    for i, text, *_ in table:
        tokens = [*brute.words(text, lower=True), None]
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (i % 3 == 1, len(tokens), n_all)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n_all + n_distinct + 1)) for w in tokens))
        assert r["score"] == pytest.approx(tree.score(text or ""), rel=1e-4, abs=1e-4)


def test_the_model_is_a_distribution(spark):
    """The probabilities of all texts of no byte or one byte and more add up to at most one."""
    from pyspark.sql import functions as F

    texts = [(0, "abab", "en", "s"), (1, "", "en", "s")] + [(2 + k, chr(k), "en", "s") for k in range(1, 128)]
    docs = documents(spark, texts).withColumn("held_out", F.col("doc_id") > 1)
    assert sum(10 ** r["score"] for r in language_model_scores(docs).where("doc_id > 0").collect()) < 1


def test_nothing_to_learn_from(spark, tmp_path):
    from pyspark.sql import functions as F

    assert QUERIES["op7_scoring"](spark, save(empty(spark), tmp_path)).collect() == []
    docs = documents(spark, [(1, "a b", "en", "s")]).withColumn("held_out", F.lit(True))
    r = language_model_scores(docs).first()
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)
    assert r["score"] == pytest.approx(4 * 8 * math.log10(0.5))


def test_scoring_query_holds_out_by_checksum(spark, tmp_path):
    docs = documents(spark, extra=True)
    for r in QUERIES["op7_scoring"](spark, save(docs, tmp_path)).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)


def test_gradients_equal_differences():
    random_numbers = np.random.default_rng(2)
    model = language_id.train([("abc", "x"), ("bcd", "y"), ("xyz", "z")][:1])
    h = language_id.HIDDEN
    for p in (d for d in (model.ahead, model.back)):
        p.byte = random_numbers.standard_normal((3 * h, 256))
        p.state = random_numbers.standard_normal((3 * h, h))
    model.out = random_numbers.standard_normal((3, 2 * h + 1))
    data = random_numbers.integers(0, 256, (7, 5)).astype(np.uint8)
    truth, used = np.array([0, 1, 2, 1, 0]), np.array([7, 3, 7, 1, 5])

    def loss():
        chance = model.labels(data)
        kept = np.arange(7)[:, None] < used
        return -(np.log(chance[:, truth, np.arange(5)]) * kept).sum() / used.sum()

    for p, g in zip(model.parameters(), language_id._gradients(model, data, truth, used), strict=True):
        for at in zip(*(random_numbers.integers(0, s, 6) for s in p.shape), strict=True):
            if p.shape[-1] == 256:
                at = (at[0], data[0, 0])
            before, step = p[at], 0.02
            p[at] = before + step
            high = loss()
            p[at] = before - step
            low = loss()
            p[at] = before
            assert g[at] == pytest.approx((high - low) / (2 * step), abs=2e-3)


def test_held_out_languages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert len(got) > 200
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_awkward_texts(spark, tmp_path):
    docs = documents(spark, extra=True)
    got = rows(QUERIES["op10_language_id"](spark, save(docs, tmp_path)))
    found = {r[0]: r[2] for r in got}
    assert len(got) == docs.count()
    assert all(found[i] == "und" for i in (4, 5, 6, 10))
    assert all(found[i] in ("en", "fr", "de") for i in (1, 7, 11, 14))
    kept = language_id.keep_known(docs, docs)
    assert kept.columns == docs.columns and not {4, 5, 6, 10} & {r["doc_id"] for r in kept.collect()}
    assert QUERIES["op10_language_id"](spark, save(empty(spark), tmp_path)).collect() == []


def test_pooling_covers_whole_texts():
    model = language_id.train([("aaaa " * 100, "a"), ("bbbb " * 100, "b")] * 8)
    long = (b"aaaa " * 5000) + (b"bbbb " * 9000)
    chance = language_id.pooled(model, [long, b"aaaa aaaa", b"bbbb", b""])
    assert chance[0][1] == pytest.approx(9 / 14, abs=0.05)
    assert chance[1].argmax() == 0 and chance[2].argmax() == 1 and chance[3].sum() == 0


def test_copies_take_one_place_of_the_sample(spark):
    # Texts that begin alike are different texts.
    cut = 400
    table = [("copied text " * 3, "en")] * 500 + [(f"text {k}", "en") for k in range(50)]
    table += [("é" * (cut - 1) + str(k), "fr") for k in range(9)] + [("x" * cut + str(k), "de") for k in range(9)] + [(None, "en"), ("a", None)]
    got = language_id.sample(spark.createDataFrame(table, "text string, lang string"), 40)
    by_lang = {k: [t for t, lang in got if lang == k] for k in ("en", "fr", "de")}
    assert len(by_lang["en"]) == len(set(by_lang["en"])) == 40 and len(by_lang["fr"]) == len(by_lang["de"]) == 9
    assert len(language_id.sample(spark.createDataFrame(table, "text string, lang string"))) == 69
    # The same rows however they are dealt out, and in the same order.
    assert language_id.sample(spark.createDataFrame(table[::-1], "text string, lang string").repartition(7), 40) == got


def plain_states(direction, sequence):
    """States of one direction over one sequence, unit by unit."""
    h = direction.state.shape[1]

    def soft(x):
        return x / (1 + abs(x))

    last, out = [0.0] * h, []
    for byte in sequence:
        read = [direction.byte[k, byte] for k in range(3 * h)]
        update = [0.5 + 0.5 * soft(read[k] + sum(direction.state[k, i] * last[i] for i in range(h))) for k in range(h)]
        reset = [0.5 + 0.5 * soft(read[h + k] + sum(direction.state[h + k, i] * last[i] for i in range(h))) for k in range(h)]
        new = [soft(read[2 * h + k] + sum(direction.state[2 * h + k, i] * reset[i] * last[i] for i in range(h))) for k in range(h)]
        last = [(1 - u) * a + u * b for u, a, b in zip(update, last, new, strict=True)]
        out.append(last)
    return out


def test_labels_equal_a_plain_network():
    random_numbers = np.random.default_rng(6)
    h = language_id.HIDDEN
    ahead, back = (language_id.Direction(random_numbers.standard_normal((3 * h, 256)).astype(np.float32), random_numbers.standard_normal((3 * h, h)).astype(np.float32)) for _ in range(2))
    model = language_id.Model(["x", "y", "z"], ahead, back, random_numbers.standard_normal((3, 2 * h + 1)).astype(np.float32))
    data = random_numbers.integers(0, 256, (11, 4)).astype(np.uint8)
    found = model.labels(data)
    for column in range(4):
        sequence = data[:, column].tolist()
        states = [a + b for a, b in zip(plain_states(ahead, sequence), plain_states(back, sequence[::-1])[::-1], strict=True)]
        for t, state in enumerate(states):
            scores = [math.exp(sum(w * x for w, x in zip(row[:-1].tolist(), state, strict=True)) + float(row[-1])) for row in model.out]
            assert found[t, :, column] == pytest.approx([x / sum(scores) for x in scores], abs=1e-4)


def test_the_whole_of_a_sampled_text_is_learnt_from():
    """Texts whose first bytes say nothing: what tells the languages apart comes late."""
    start = "0123456789 " * 60
    rows = [(start + "aaaa bbbb " * 200, "x"), (start + "yyyy zzzz " * 200, "y")] * 6
    chance = language_id.pooled(language_id.train(rows), [b"aaaa bbbb aaaa", b"zzzz yyyy zzzz"])
    assert chance[0].argmax() == 0 and chance[1].argmax() == 1
