"""Removal of passages that repeat across documents, by super-k-mer partitioning.

A window is ``length`` consecutive words. Its minimiser is the smallest hash of
``core`` consecutive words in it, so equal windows have equal minimisers, and
consecutive windows mostly share theirs: such a run is a super-k-mer. It travels
as one packed string, its words joined by spaces, to the bucket of its minimiser,
where sorting the windows shows which of them also start in a smaller document.

Packed strings are about three times the text, so they are cut only where it can
matter: the minimisers are first gathered without text, 24 bytes for some 20
windows, and only those seen in two documents or more are sent.

A minimiser of more than ``hot`` super-k-mers would fill a bucket of its own. Its
windows go out one by one instead, as 128-bit digests, which Spark counts with a
map-side minimum and joins back; no task gathers them.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foralytics.llm.common import slices, table
from foralytics.llm.words import run_hashes, smallest_in_runs, word_hashes
from foralytics.scratch import discard, scratch_path, stage

LENGTH = 50
CORE = 10
HOT = 50_000
# Bytes of packed strings that a task sorts together; a longer bucket stays whole.
SORTED_BYTES = 8 << 20
LAST_ID = (1 << 63) - 1
ID = pa.int64()


def _runs(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs; ``same[i]`` tells that i continues the run of i - 1."""
    starts = np.flatnonzero(~same)
    return starts, np.diff(np.append(starts, len(same)))


def super_kmers(texts: pa.Array, length: int, core: int) -> tuple[np.ndarray, ...]:
    """(text, first word, windows, minimiser) of every super-k-mer."""
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    if len(hashes) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    smallest = smallest_in_runs(run_hashes(hashes, core), length - core + 1).view(np.int64)
    text_of = np.repeat(np.arange(len(counts)), counts)[: len(smallest)]
    at = np.arange(len(smallest))
    whole = np.flatnonzero(at + length <= ends[text_of])
    text_of, low = text_of[whole], smallest[whole]
    same = np.zeros(len(whole), bool)
    same[1:] = (low[1:] == low[:-1]) & (text_of[1:] == text_of[:-1])
    first, n = _runs(same)
    return text_of[first], whole[first] - (ends - counts)[text_of[first]], n, low[first]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _find(length: int, core: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            text, start, n, low = super_kmers(batch.column(2), length, core)
            yield _batch(
                minimiser=pa.array(low, ID), id=batch.column(0).take(pa.array(text)), text_key=batch.column(1).take(pa.array(text)),
                start=pa.array(start, pa.int32()), n=pa.array(n, pa.int32()),
            )

    return find


def _cut(length: int):
    """Packed strings, or for hot minimisers the digests of the windows, of the listed super-k-mers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            rows = {k: [] for k in ("minimiser", "id", "text_key", "start", "n", "packed", "digest")}
            for i, key, text, hits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.encode().split()
                for hit in hits:
                    run = words[hit["start"] : hit["start"] + hit["n"] + length - 1]
                    parts = [(hit["start"], hit["n"], b" ".join(run), None)]
                    if hit["hot"]:
                        windows = (b" ".join(run[j : j + length]) for j in range(hit["n"]))
                        parts = [(hit["start"] + j, 1, None, hashlib.blake2b(w, digest_size=16).digest()) for j, w in enumerate(windows)]
                    for start, n, packed, digest in parts:
                        for name, value in zip(rows, (hit["minimiser"], i, key, start, n, packed, digest), strict=True):
                            rows[name].append(value)
            kinds = (ID, ID, ID, pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield _batch(**{k: pa.array(v, kind) for (k, v), kind in zip(rows.items(), kinds, strict=True)})

    return cut


def repeated_windows(ids: np.ndarray, codes: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """Whether each window of the strings (``codes`` of words, ``counts`` words each) also starts in one of a smaller id.

    Windows are sorted by hash, and each is compared word by word with the window
    of the smallest id that it would repeat; should two differ, whole windows are
    sorted instead.
    """
    ends = np.cumsum(counts)
    string_of = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(np.arange(len(codes)) + length <= ends[string_of])
    owner = ids[string_of[at]]
    hashes = run_hashes(codes.astype(np.uint64) + np.uint64(1), length)[at]
    order = np.lexsort((owner, hashes))
    new = np.ones(len(order), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    leader = np.empty(len(order), np.int64)
    leader[order] = first
    later = np.flatnonzero(owner > owner[leader])
    steps = np.arange(length)
    for some in np.array_split(later, max(1, len(later) * length // 4_000_000)):
        if (codes[at[some][:, None] + steps] != codes[at[leader[some]][:, None] + steps]).any():
            rows = codes[at[:, None] + steps]
            group = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
            least = np.full(group.max() + 1, LAST_ID)
            np.minimum.at(least, group, owner)
            return owner > least[group]
    found = np.zeros(len(at), bool)
    found[later] = True
    return found


def _sort(length: int):
    """Rows in order of their minimiser -> runs of windows that repeat a smaller document's."""

    def judged(rows: pa.Table) -> pa.RecordBatch:
        column = dict(zip(rows.column_names, rows.combine_chunks().to_batches()[0].columns, strict=True))
        split = pc.split_pattern(column["packed"].cast(pa.string()), " ")
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = split.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        ids = column["id"].to_numpy(zero_copy_only=False)
        found = repeated_windows(ids, codes, counts, length)
        windows = counts - length + 1
        string_of = np.repeat(np.arange(len(ids)), windows)
        place = np.arange(len(string_of)) - np.repeat(np.cumsum(windows) - windows, windows)
        same = np.zeros(len(found), bool)
        same[1:] = (found[1:] == found[:-1]) & (string_of[1:] == string_of[:-1])
        first, n = _runs(same)
        first, n = first[found[first]], n[found[first]]
        take = pa.array(string_of[first])
        start = column["start"].to_numpy(zero_copy_only=False)[string_of[first]] + place[first]
        return _batch(
            id=column["id"].take(take), text_key=column["text_key"].take(take),
            start=pa.array(start, pa.int32()), n=pa.array(n, pa.int32()),
        )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in slices(batches, "packed", SORTED_BYTES):
            low = batch.column(0).to_numpy(zero_copy_only=False)
            if held and held[-1].column(0)[-1].as_py() == low[0]:
                # The last bucket may go on: cut where its rows begin.
                done = pa.Table.from_batches(held)
                values = done.column(0).to_numpy()
                cut = int(np.flatnonzero(values != low[0])[-1]) + 1 if (values != low[0]).any() else 0
                if cut:
                    yield judged(done.slice(0, cut))
                held = done.slice(cut).to_batches()
            elif held:
                yield judged(pa.Table.from_batches(held))
                held = []
            held.append(batch)
        if held:
            yield judged(pa.Table.from_batches(held))

    return sort


def _rest(length: int):
    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            out = {"doc_id": batch.column(0)}
            n_words, n_removed, kept_text = [], [], []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                n_words.append(len(words))
                if runs:
                    steps = np.zeros(len(words) + 1, np.int64)
                    for run in runs:
                        steps[run["start"]] += 1
                        steps[run["start"] + run["n"] + length - 1] -= 1
                    kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()
                    words = [words[j] for j in kept]
                n_removed.append(n_words[-1] - len(words))
                kept_text.append(b" ".join(words))
            out |= {"n_words": pa.array(n_words, ID), "n_removed": pa.array(n_removed, ID), "kept": pa.array(kept_text, pa.binary()).cast(pa.string())}
            yield _batch(**out)

    return rest


def remove_repeats(docs: DataFrame, length: int = LENGTH, core: int = CORE, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of ``docs`` (doc_id, text).

    A word goes if a window over it also starts in a document of a smaller id;
    ``kept`` joins the others by one space. Windows are judged on the input. Null
    and empty texts have no words and keep an empty text. Rows of one id never
    remove each other's words; a null id counts as larger than any other.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.xxhash64("text").alias("text_key")
    )
    found_at, hits_at = scratch_path(spark, "super-kmers"), scratch_path(spark, "shared-kmers")
    kind = "id long, text_key long, start int, n int"
    found = stage(
        keyed.select("id", "text_key", "text").mapInArrow(_find(length, core), f"minimiser long, {kind}"), "", found_at
    )
    shared = found.groupBy("minimiser").agg(
        F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("n_rows")
    ).where("least < most").select("minimiser", (F.col("n_rows") > hot).alias("hot"))
    hits = stage(found.join(shared, "minimiser"), "", hits_at)
    discard(spark, found_at)

    def pieces(of: DataFrame) -> DataFrame:
        listed = of.groupBy("id", "text_key").agg(F.collect_set(F.struct("minimiser", "start", "n", "hot")).alias("hits"))
        return (
            keyed.join(listed, ["id", "text_key"])
            .select("id", "text_key", "text", "hits")
            .mapInArrow(_cut(length), f"minimiser long, {kind}, packed binary, digest binary")
        )

    runs = (
        pieces(hits.where("not hot"))
        .select("minimiser", "id", "text_key", "start", "n", "packed")
        .repartition("minimiser")
        .sortWithinPartitions("minimiser")
        .mapInArrow(_sort(length), kind)
    )
    if not hits.where("hot").isEmpty():
        singles = stage(pieces(hits.where("hot")).select("digest", "id", "text_key", "start", "n"), "digests")
        least = singles.groupBy("digest").agg(F.min("id").alias("least"))
        runs = runs.unionByName(
            singles.join(least, "digest").where("least < id").select("id", "text_key", "start", "n")
        )
    runs = stage(runs, "repeats")
    listed = runs.groupBy("id", "text_key").agg(F.collect_set(F.struct("start", "n")).alias("runs"))
    discard(spark, hits_at)
    return keyed.join(listed, ["id", "text_key"], "left").select("doc_id", "text", "runs").mapInArrow(
        _rest(length), "doc_id long, n_words long, n_removed long, kept string"
    )


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document, as a digest."""
    docs = table(spark, sf_dir, "documents")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
