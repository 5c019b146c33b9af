import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
import tables
from pyspark.sql import functions as F

from foralytics.llm.periodic_runs import lyndon_groups, op13_periodic_runs, periodic_parts, runs_of, with_runs


def plain_lyndon(word):
    """Length of the longest Lyndon word at every place: smaller than all of its proper suffixes."""
    out = []
    for i in range(len(word)):
        ends = [j for j in range(i + 1, len(word) + 1) if all(word[i:j] < word[k:j] for k in range(i + 1, j))]
        out.append(ends[-1] - i)
    return out


def plain_runs(words, exponent=4, least=6):
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        same = [words[k] == words[k + q] for k in range(n - q)] + [False]
        start = None
        for k, s in enumerate(same):
            if s and start is None:
                start = k
            if not s and start is not None:
                length = k - start + q
                # A stretch that a smaller period has as well is no run of this one.
                smaller = any(words[start + r : start + length] == words[start : start + length - r] for r in range(1, q))
                if length >= max(least, exponent * q) and not smaller:
                    found[start, q] = length
                start = None
    return [(s, found[s, q], q) for s, q in sorted(found)]


def plain_answer(doc_id, text):
    words = brute.words(text)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def test_lyndon_words_of_both_orders():
    random.seed(3)
    for _ in range(300):
        word = [random.randint(0, random.choice([1, 2, 4])) for _ in range(random.randint(1, 40))]
        for order in (word, [-w for w in word]):
            lengths, groups = lyndon_groups(order)
            assert lengths == plain_lyndon(order)
            first = {}
            for i, g in enumerate(groups):
                assert first.setdefault(g, order[i : i + lengths[i]]) == order[i : i + lengths[i]]


@pytest.mark.parametrize("exponent, least", [(3, 3), (4, 6), (5, 12)])
def test_runs_against_all_periods(exponent, least):
    random.seed(exponent)
    for _ in range(300):
        word = [random.randint(0, 2) for _ in range(random.randint(0, 30))]
        root = [random.randint(0, 3) for _ in range(random.randint(1, 7))]
        word += (root * 12)[: random.randint(0, 40)] + word[::-1]
        codes = np.array(word, np.int64)
        wanted = plain_runs(word, exponent, least)
        assert runs_of(codes, exponent, least) == wanted
        parts = periodic_parts(codes, np.zeros(len(codes), np.int64), exponent, least)
        cut = [(a + s, length, q) for a, b in parts for s, length, q in runs_of(codes[a:b], exponent, least)]
        assert cut == wanted


def documents(spark, extra=False):
    random.seed(9)
    rows = tables.awkward_rows()
    rows += [(None, "a b " * 9, "en", None), (None, None, None, None)]
    rows += [(100 + k, " ".join(random.choice("abc") * random.randint(1, 2) for _ in range(random.randint(1, 90))), "en", "a") for k in range(150)]
    for k in range(60):
        root = [random.choice("de") + random.choice("fg") for _ in range(random.randint(1, 6))]
        rows.append((300 + k, " ".join(["p"] * random.randint(0, 9) + (root * 9)[: random.randint(10, 50)] + ["q r"]), "en", "a"))
    rows += [(400, "x " * 5, "en", "a"), (401, "x " * 6, "en", "a"), (402, "x\ny " * 4, "en", "a"), (403, "x y " * 3 + "x", "en", "a"), (404, "x y " * 20_000, "en", "a")]
    return tables.documents(spark, rows, extra)


def test_query_against_plain_runs(spark, tmp_path):
    docs = documents(spark, extra=True)
    folder = tables.save(docs, tmp_path)
    wanted = sorted((plain_answer(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if len(r["text"] or "") < 70_000), key=repr)
    found = op13_periodic_runs(spark, folder).where("doc_id is null or doc_id not in (11, 404)")
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    wanted = [w for w in wanted if w[0] not in (11, 404)]
    assert tables.rows(found) == wanted
    assert sum(w[1] > 0 for w in wanted) > 40
    long = {r["doc_id"]: r for r in op13_periodic_runs(spark, folder).where("doc_id in (11, 404)").collect()}
    assert len(long) == 2 and (zlib.crc32(b"404") % 10 == 0 or (long[404]["length"], long[404]["period"]) == (40_000, 2))


def test_columns_stay_and_empty_tables(spark):
    found = with_runs(documents(spark, extra=True))
    assert {"score", "start", "runs", "collapsed"} <= set(found.columns)
    kept = {r["doc_id"]: r["collapsed"] for r in found.where("doc_id in (4, 6, 401, 402)").collect()}
    assert kept == {4: "", 6: "", 401: "x", 402: "x y"}
    assert with_runs(tables.empty(spark)).count() == 0
    with pytest.raises(ValueError):
        with_runs(tables.empty(spark).withColumn("runs", F.lit(1)))
    with pytest.raises(ValueError):
        with_runs(tables.empty(spark), exponent=2)
