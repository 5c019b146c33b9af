"""Scoring of documents by context-tree weighting and by a unigram of words.

Documents are dealt into chunks of about ``CHUNK_BYTES``. A chunk sends its
distinct words and byte grams with their training counts to the buckets of their
hashes, packed; a bucket sums the counts over all chunks, works out the trees of its
grams, and answers each chunk with the counts and probabilities that it asked for, in
the order of the keys, which the chunk works out again. So nothing that grows with the corpus is broadcast or held by one task: what travels
is the distinct words and grams of every chunk.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foralytics.llm import context_tree as ctw
from foralytics.llm.common import remainder_of_id, shuffle_partitions, table
from foralytics.llm.words import from_planes, mixed, planes, word_codes
from foralytics.scratch import scratch_path, stage

CHUNK_BYTES = 8 << 20
# Bytes that are numbered in one table.
SLICE_BYTES = 1 << 20
# Keys of several slices that are held before they are summed up.
HELD_KEYS = 200_000
# Training counts of a word or gram in a chunk, and of a word in all, stay below 2^40.
COUNT_BYTES = 5
ASK = "bucket int, chunk int, keys binary, counts binary"
ANSWER = "chunk int, bucket int, answers binary"
ROOTS = "latest int, node int, zeros double, ones double, log_weighted double, n_words long, n_tokens long"


def _text_slices(texts: pa.Array):
    """Row ranges of about ``SLICE_BYTES``."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > SLICE_BYTES:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _column(rows: pa.Table, name: str) -> pa.Array:
    column = rows[name].combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at.ravel(), values, len(distinct))


class _Counts:
    """Counts by key that are added slice by slice and summed up before they pile up."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint64), np.zeros(0))]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.held.append((keys, counts))
        if sum(len(k) for k, _ in self.held[1:]) > max(HELD_KEYS, len(self.held[0][0])):
            self.held = [self.total()]

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        return _grouped(*(np.concatenate(x) for x in zip(*self.held, strict=True)))


def _predicted(firsts: np.ndarray, total: int) -> np.ndarray:
    """Whether a byte of the stream, counted from ``DEPTH`` on, is predicted: all but the zeros before a text."""
    kept = np.ones(total, bool)
    for lead in range(ctw.DEPTH):
        kept[firsts + lead] = False
    return kept[ctw.DEPTH :]


@dataclass
class Numbered:
    """A slice of texts: its distinct words and grams, and which of them stands where."""

    rows: tuple[int, int]
    words: np.ndarray
    word_at: np.ndarray
    n_words: np.ndarray
    grams: np.ndarray
    gram_at: np.ndarray
    # Whether the byte at a place is predicted, and whether a gram is that of one.
    kept: np.ndarray
    asked: np.ndarray
    firsts: np.ndarray
    sizes: np.ndarray


def _numbered(texts: pa.Array, a: int, b: int) -> Numbered:
    hashes, codes, counts = word_codes(texts[a:b], lower=True)
    data, firsts = ctw.stream([x.as_buffer().to_pybytes() for x in texts[a:b]])
    grams, number = ctw.distinct_grams(data)
    kept = _predicted(firsts, len(data))
    asked = np.zeros(len(grams), bool)
    asked[number[kept]] = True
    return Numbered((a, b), hashes, codes.astype(np.int32), counts, grams, number.astype(np.int32), kept, asked, firsts, np.diff(np.append(firsts, len(data))))


def _distinct(texts: pa.Array, train: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """(distinct words, training counts) and (distinct grams, training counts) of a chunk."""
    words, grams = _Counts(), _Counts()
    for a, b in _text_slices(texts):
        part = _numbered(texts, a, b)
        words.add(part.words, np.bincount(part.word_at, np.repeat(train[a:b], part.n_words), len(part.words)))
        taught = part.kept & np.repeat(train[a:b], part.sizes)[ctw.DEPTH :]
        grams.add(part.grams[part.asked], np.bincount(part.gram_at[taught], minlength=len(part.grams))[part.asked])
        # The next slice is numbered before these names are bound again.
        del part, taught
    return words.total(), grams.total()


def _bucket_of(keys: np.ndarray, is_gram: bool, buckets: int) -> np.ndarray:
    """Words in the buckets up to ``buckets``, grams above; grams that share their last bytes meet in one."""
    part = mixed(keys >> np.uint64(8 * (ctw.DEPTH - ctw.SPLIT + 1)) if is_gram else keys)
    return ((part >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64) + buckets * is_gram


def _ask(buckets: int):
    def ask(rows: pa.Table) -> pa.Table:
        chunk = rows["chunk"][0].as_py()
        texts = pc.fill_null(_column(rows, "text"), "")
        train = ~_column(rows, "held_out").to_numpy(zero_copy_only=False)
        out = []
        for is_gram, (keys, counts) in enumerate(_distinct(texts, train)):
            bucket = _bucket_of(keys, bool(is_gram), buckets)
            order = np.argsort(bucket, kind="stable")
            keys, counts, bucket = keys[order], counts[order].astype(np.uint64), bucket[order]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
            for i, j in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
                out.append((int(bucket[i]), planes(keys[i:j], 8), planes(counts[i:j], COUNT_BYTES)))
        return pa.table(
            {
                "bucket": pa.array([x[0] for x in out], pa.int32()), "chunk": pa.array([chunk] * len(out), pa.int32()),
                "keys": pa.array([x[1] for x in out], pa.binary()), "counts": pa.array([x[2] for x in out], pa.binary()),
            }
        )

    return ask


def _summed(rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(keys of each row, distinct keys, their counts over all rows)."""
    asked = [from_planes(x, 8) for x in rows["keys"].to_pylist()]
    counts = [from_planes(x, COUNT_BYTES) for x in rows["counts"].to_pylist()]
    return asked, *_grouped(np.concatenate(asked), np.concatenate(counts).astype(np.float64))


def _roots(buckets: int):
    def roots(rows: pa.Table) -> pa.Table:
        _, keys, counts = _summed(rows)
        if rows["bucket"][0].as_py() < buckets:
            found = ([-1], [-1], [0.0], [0.0], [0.0], [int((counts > 0).sum())], [int(counts.sum())])
        else:
            first, node, zeros, ones, log_weighted = ctw.Subtree(keys, counts).roots()
            latest = (keys[first] >> np.uint64(8 * ctw.DEPTH)).astype(np.int32)
            none = np.zeros(len(node), np.int64)
            found = (latest, node.astype(np.int32), zeros, ones, log_weighted, none, none)
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
        names = [x.split()[0] for x in ROOTS.split(", ")]
        return pa.table({k: pa.array(x, t) for k, x, t in zip(names, found, kinds, strict=True)})

    return roots


def _answer(buckets: int, upper: list[tuple[np.ndarray, ...]]):
    def answer(rows: pa.Table) -> pa.Table:
        asked, keys, counts = _summed(rows)
        words = rows["bucket"][0].as_py() < buckets
        sent = (lambda x: planes(x.astype(np.uint64), COUNT_BYTES)) if words else (lambda x: x.astype(np.float32).tobytes())
        values = counts if words else ctw.Subtree(keys, counts).log10_probabilities(
            upper, (keys >> np.uint64(8 * ctw.DEPTH)).astype(np.int64)
        )
        return pa.table(
            {
                "chunk": rows["chunk"], "bucket": rows["bucket"],
                "answers": pa.array([sent(values[np.searchsorted(keys, x)]) for x in asked], pa.binary()),
            }
        )

    return answer


def _score(n_all: int, n_distinct: int, n_ends: int, buckets: int):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        texts = pc.fill_null(_column(docs, "text"), "")
        # Numbered once: the keys of all slices are those the chunk has asked for, in their order.
        parts = [_numbered(texts, i, j) for i, j in _text_slices(texts)]
        known = []
        for is_gram in (False, True):
            keys = [p.grams[p.asked] if is_gram else p.words for p in parts]
            keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]))
            bucket = _bucket_of(keys, is_gram, buckets)
            mine = sorted(
                (k, x) for k, x in zip(answers["bucket"].to_pylist(), answers["answers"].to_pylist(), strict=True)
                if (k >= buckets) == is_gram
            )
            found = [np.frombuffer(x, np.float32) if is_gram else from_planes(x, COUNT_BYTES) for _, x in mine]
            values = np.empty(len(keys))
            values[np.argsort(bucket, kind="stable")] = np.concatenate(found or [np.zeros(0)])
            known.append((keys, values))

        def look_up(is_gram: bool, wanted: np.ndarray) -> np.ndarray:
            keys, values = known[is_gram]
            return values[np.searchsorted(keys, wanted)] if len(wanted) else np.zeros(0)

        n_tokens, n_known, base, scores, n_bytes = [], [], [], [], []
        while parts:
            # A slice is given back before the next one is scored.
            part = parts.pop(0)
            counts, n = part.n_words, part.rows[1] - part.rows[0]
            seen = look_up(False, part.words)
            text_of = np.repeat(np.arange(n), counts)
            n_tokens.append(counts + 1)
            n_known.append(np.bincount(text_of, (seen > 0)[part.word_at], n).astype(np.int64) + (n_ends > 0))
            base.append(
                np.bincount(text_of, np.log10(seen + 1)[part.word_at], n)
                + math.log10(n_ends + 1) - (counts + 1) * math.log10(n_all + n_distinct + 1)
            )
            chance = np.zeros(len(part.grams))
            chance[part.asked] = look_up(True, part.grams[part.asked])
            each = np.where(part.kept, chance[part.gram_at], 0.0)
            # The first zeros of the stream have no gram; a text's range begins at its own first byte.
            scores.append(np.add.reduceat(each, part.firsts))
            n_bytes.append(part.sizes - ctw.DEPTH)
        bits = -np.concatenate(scores) / math.log10(2) / np.concatenate(n_bytes)
        return pa.table(
            {
                "doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": pa.array(np.concatenate(n_tokens)),
                "n_known": pa.array(np.concatenate(n_known)), "train_tokens": pa.array([n_all] * docs.num_rows, pa.int64()),
                "base_score": pa.array(np.concatenate(base)), "score": pa.array(np.concatenate(scores)),
                "bits_per_byte": pa.array(bits),
            }
        )

    return score


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def language_model_scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, buckets: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, held_out) with the scores of both models, learnt where ``held_out`` is false.

    A null text is empty; an empty text is its end only. ``score`` is log10 of the
    probability of the text's UTF-8 bytes and its end, given as a zero byte, and
    ``bits_per_byte`` the code length of these bytes, the end included. Equal
    texts have equal scores. Without training rows the unigram knows nothing and
    the trees give every bit one half.
    """
    spark = docs.sparkSession
    buckets = buckets or 2 * shuffle_partitions(spark)
    docs = docs.select("doc_id", "text", "held_out")
    totals = docs.agg(
        F.sum(F.octet_length("text").cast("long")).alias("n"), F.count_if(~F.col("held_out")).alias("n_ends")
    ).first()
    chunks = max(1, -(-(totals["n"] or 0) // chunk_bytes))
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(chunks)).cast("int"))
    asked_at = scratch_path(spark, "asked")
    asked = stage(dealt.groupBy("chunk").applyInArrow(_ask(buckets), ASK), "", asked_at)
    roots = stage(asked.groupBy("bucket").applyInArrow(_roots(buckets), ROOTS), "roots")
    words = roots.agg(F.sum("n_words").alias("distinct"), F.sum("n_tokens").alias("all")).first()
    # 256 x 255 rows at most.
    upper = roots.where("node >= 0").groupBy("latest", "node").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_weighted").alias("log_weighted")
    ).toPandas()
    levels = ctw.upper_levels(*(upper[c].to_numpy() for c in ("latest", "node", "zeros", "ones", "log_weighted")))
    answers = asked.groupBy("bucket").applyInArrow(_answer(buckets, levels), ANSWER)
    n_ends = totals["n_ends"] or 0
    n_all, n_distinct = (words["all"] or 0) + n_ends, (words["distinct"] or 0) + (n_ends > 0)
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(n_all, n_distinct, n_ends, buckets), SCORED
    )


def op7_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt from the six sevenths that are not held out."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (remainder_of_id(F.col("doc_id"), 7) == 2).alias("held_out")
    )
    return language_model_scores(docs)
