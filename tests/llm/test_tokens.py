"""Token files: exact round trips."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents, empty, save

from foralytics.llm import tokenizing
from foralytics.llm.common import BATCH_BYTES, small_batches
from foralytics.llm.queries import QUERIES
from foralytics.llm.token_files import SEGMENTS, decode_segment, encode_segment, write_token_files
from foralytics.llm.tokenizing import word_encoder

ids_of_docs = st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=400), max_size=6)


@given(ids_of_docs)
@settings(max_examples=60, deadline=None)
def test_segments_round_trip(docs):
    ids = np.array([i for d in docs for i in d], np.uint32)
    lengths = np.array([len(d) for d in docs], np.int64)
    got, got_lengths = decode_segment(encode_segment(ids, lengths))
    assert got.tolist() == ids.tolist() and got_lengths.tolist() == lengths.tolist()


def test_small_numbers_take_few_bits_and_outliers_are_kept():
    ids = np.full(1280, 1000, np.uint32) + np.arange(1280, dtype=np.uint32) % 8
    ids[::128] = 4_000_000_000
    payload = encode_segment(ids, np.array([1280]))
    assert len(payload) < 1280
    assert decode_segment(payload)[0].tolist() == ids.tolist()


@pytest.fixture(scope="module")
def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_encoder_equals_the_tokenizer(tokenizer):
    random.seed(3)
    signs = list("aAbZéÉß'<>|.,;:!?-_ \n\t\x0b\x1c\x85\xa0 12½²漢字żİıﬁé́œŒ🙂\"\\[]`{}~&=Ωσς")
    texts = ["".join(random.choices(signs, k=random.randint(0, 50))) for _ in range(3000)]
    texts += ["", "  ", "it's", "a<|endoftext|>b", "<|startoftext|>'s", "don't,'x'"]
    ids, lengths = word_encoder()()(pa.array(texts))
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert lengths.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_query(spark, tmp_path, tokenizer):
    docs = documents(spark, extra=True)
    got = [tuple(r) for r in QUERIES["op1_token_files"](spark, save(docs, tmp_path)).orderBy("start").collect()]
    want, start = [], 0
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def test_empty_table(spark, tmp_path):
    assert QUERIES["op1_token_files"](spark, save(empty(spark), tmp_path)).collect() == []


def test_forgotten_pieces_are_learnt_again(tokenizer, monkeypatch):
    monkeypatch.setattr(tokenizing, "KEPT_UNITS", 300)
    encode = tokenizing._build(public_path())
    random.seed(8)
    for _ in range(20):
        texts = ["".join(random.choice(["abc", "the ", "é", "漢字", " ", "\n", "don't ", "12", "!!", "x" * random.randint(1, 90), "🙂"]) for _ in range(random.randint(0, 60))) for _ in range(40)]
        ids, lengths = encode(pa.array(texts))
        want = [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def public_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_pieces_of_one_hash_are_told_apart():
    class OneHash(tokenizing.Pieces):
        @staticmethod
        def hashed(units):
            return np.full(len(units), 7, np.uint64)

    pieces, units = OneHash(), pa.array(["a", "bb", "c"])
    assert pieces.add(units, pieces.hashed(units), np.array([1, 2, 2, 3], np.uint32), np.array([1, 2, 1])).tolist() == [0, 1, 2]
    wanted = pa.array(["c", "z", "a", "bb"])
    assert pieces.find(wanted, pieces.hashed(wanted)).tolist() == [2, -1, 0, 1]


def test_hashes_depend_on_all_bytes():
    random.seed(2)
    units = ["", "a", "ab", "a\0", "é" * 40] + ["x" * k for k in range(1, 150)] + ["".join(random.choice("ab") for _ in range(random.randint(0, 80))) for _ in range(500)]
    whole = tokenizing.Pieces.hashed(pa.array(units)).tolist()
    assert len(set(whole)) == len(set(units))
    assert tokenizing.Pieces.hashed(pa.array(["other", *units]).slice(1)).tolist() == whole


def test_packing_takes_little_memory():
    ids = np.random.default_rng(1).integers(0, 49_000, 1_000_000).astype(np.uint32)
    lengths = np.full(1000, 1000, np.int64)
    tracemalloc.start()
    payload = encode_segment(ids, lengths)
    packing = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    got, got_lengths = decode_segment(payload)
    unpacking = tracemalloc.get_traced_memory()[1] - len(payload)
    tracemalloc.stop()
    assert (got == ids).all() and (got_lengths == lengths).all()
    # The ids are 4 MB.
    assert packing < 30e6 and unpacking < 16e6


def test_workers_get_small_batches(spark, tmp_path):
    """The encoder gives, as the id of each text, the KB that the buffers of its batch hold."""

    def encoder():
        return lambda texts: (np.full(len(texts), sum(b.size for b in texts.buffers() if b) >> 10), np.ones(len(texts), np.int64))

    docs = spark.range(0, 6000, 1, 1).selectExpr("id doc_id", "repeat(cast(id % 10 as string), 3000) text")
    write_token_files(docs, f"{tmp_path}/out", encoder, None, 1)
    segments = spark.read.schema(SEGMENTS).parquet(f"{tmp_path}/out").orderBy("segment").collect()
    assert [i for s in segments for i in s["doc_ids"]] == list(range(6000))
    assert max(decode_segment(s["payload"])[0].max() for s in segments) << 10 < 2 * BATCH_BYTES


def test_a_limit_of_the_session_is_kept(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    with pytest.raises(ValueError), small_batches(spark, 1000):
        assert spark.conf.get(key) == "1000"
        raise ValueError
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "2000")
    try:
        with small_batches(spark, 1000):
            assert spark.conf.get(key) == "2000"
        assert spark.conf.get(key) == "2000"
    finally:
        spark.conf.unset(key)
