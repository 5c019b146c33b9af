"""The pipeline, stage by stage, against plain versions."""

import zlib

import brute
import corpus_pipeline
import numpy as np
import pytest
from tables import documents, empty, prose, save

import __spark_entry__ as contract
from foralytics.llm.queries import ORACLE, QUERIES


def corpus():
    base = [prose(200 + i, 60) for i in range(10)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(100 + i, t.replace("dolor", "d0lor", 1), "en", "s0") for i, t in enumerate(base[:4])]
    rows += [(200 + i, f"{prose(300 + i, 20)} {ITEM.upper()} {prose(400 + i, 20)}", "en", "s1") for i in range(3)]
    return rows + [(300, "??? !!!", "en", "s0"), (301, None, None, None), (302, base[0], "en", None)]


ITEM = "what is the name of the river that flows through the old town of nowhere and ends in a lake"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("corpus")
    save(documents(spark, corpus(), extra=True), at)
    return save(spark.createDataFrame([(1, ITEM)], "item_id long, text string"), at, "benchmark")


def test_stages_and_run(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, found = docs.columns, []
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, folder)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        found.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    texts = [[(r["doc_id"], r["text"]) for r in d.collect()] for d in found[:4]]
    assert sorted(i for i, _ in texts[0]) == [r[0] for r in sorted(corpus()) if r[0] not in (300, 301)]
    want = [i for i, _, c in brute.linked(texts[0], 5, 4, 5) if i == c]
    assert sorted(i for i, _ in texts[1]) == sorted(want) and not {100, 302} & set(want)
    assert sorted(i for i, _ in texts[2]) == sorted(i for i in want if not 200 <= i < 300)
    assert {i for i, _ in texts[3]} <= set(want) and max(map([i for i, _ in texts[3]].count, want)) <= 2
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"))
    rows, start = [], 0
    for i, text in sorted(texts[3]):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        rows.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in found[4].orderBy("start").collect()] == rows
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(rows)


def test_an_empty_corpus(spark, folder, tmp_path):
    save(empty(spark), tmp_path)
    save(spark.read.parquet(f"{folder}/benchmark.parquet"), tmp_path, "benchmark")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered_queries():
    assert [k for k in contract.queries() if k.startswith("op")] == list(QUERIES)
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(ORACLE) <= set(QUERIES)
