"""Token ids in files of patched frame-of-reference blocks.

A token file is a Parquet table of segments, one row each, so that Spark's own
writers commit it and any cluster file system holds it. A segment stands for
consecutive documents in ascending ``doc_id`` order; its ``payload`` is, with all
numbers little-endian:

    header      magic "PFOR", uint32 documents, uint32 ids, uint32 blocks
    lengths     uint32 for each document: its number of ids
    block index uint32 for each block and one more: where it starts in the blocks
    blocks      uint32 minimum, uint8 width, uint8 exceptions, then the packed
                values, the exceptions' places (uint8) and their high parts (uint32)

A block holds 128 ids (the last one fewer, padded with its minimum). The minimum
is subtracted, and the low ``width`` bits of all values are packed. The width is
the one that fits ``PERCENTILE`` of the block's values, or any wider one that makes
the block smaller; of the values that do not fit, the bits above ``width`` are kept
in the exception list. The block index allows a reader to decode any block alone.
"""

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foralytics.llm.common import shuffle_partitions, slices, small_batches, table
from foralytics.llm.tokenizing import word_encoder
from foralytics.scratch import scratch_path

BLOCK = 128
PERCENTILE = 0.9
MAGIC = b"PFOR"
# Bytes of text that one segment holds, about; a longer document is one segment.
SEGMENT_BYTES = 4 << 20
END_ID = 1
# Blocks that are packed, or unpacked, at once.
STEP = 512


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` values of ``width`` bits each as rows of bytes."""
    words = np.zeros((len(values), BLOCK * width // 64), np.uint64)
    wide = values.astype(np.uint64)
    for lane in range(BLOCK):
        word, shift = divmod(lane * width, 64)
        words[:, word] |= wide[:, lane] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= wide[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8").view(np.uint8)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(packed).view("<u8")
    values = np.empty((len(packed), BLOCK), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for lane in range(BLOCK):
        word, shift = divmod(lane * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        values[:, lane] = value & mask
    return values


def _by_width(width: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(width, numbers of up to ``STEP`` blocks of that width), so that what packing takes is bounded."""
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        for a in range(0, len(rows), STEP):
            yield w, rows[a : a + STEP]


def encode_segment(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One payload; ``ids`` are uint32, ``lengths`` the ids of each document."""
    n_blocks = -(-len(ids) // BLOCK)
    padded = np.full(n_blocks * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    padded[: len(ids)] = ids
    blocks = padded.reshape(n_blocks, BLOCK)
    low = blocks.min(axis=1, initial=np.uint32(0xFFFFFFFF)) if n_blocks else np.zeros(0, np.uint32)
    rest = blocks - low[:, None]
    bits, each = np.empty(rest.shape, np.uint8), np.empty((n_blocks, 33), np.int64)
    # How many values need w bits, for each w; then more than w, and the bytes of a block at that width.
    for a in range(0, n_blocks, STEP):
        some = _bit_lengths(rest[a : a + STEP])
        n = len(some)
        bits[a : a + n] = some
        each[a : a + n] = np.bincount((np.arange(n)[:, None] * 33 + some).ravel(), minlength=33 * n).reshape(n, 33)
    above = BLOCK - np.cumsum(each, axis=1)
    cost = BLOCK // 8 * np.arange(33) + 5 * above
    cost[above > (1 - PERCENTILE) * BLOCK] = 1 << 30
    width = cost.argmin(axis=1)
    n_out = above[np.arange(n_blocks), width]
    starts = np.concatenate([[0], np.cumsum(6 + BLOCK // 8 * width + 5 * n_out)]).astype("<u4")
    body = np.zeros(int(starts[-1]), np.uint8)
    first = starts[:-1].astype(np.int64)
    body[first[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    body[first + 4] = width
    body[first + 5] = n_out
    for w, rows in _by_width(width):
        if w:
            kept = rest[rows] & np.uint32((1 << w) - 1)
            body[(first[rows] + 6)[:, None] + np.arange(BLOCK // 8 * w)] = _pack(kept, w)
        row, place = np.nonzero(bits[rows] > w)
        at = first[rows] + 6 + BLOCK // 8 * w
        order = np.arange(len(row)) - np.searchsorted(row, row)
        body[at[row] + order] = place
        high = (rest[rows][row, place] >> np.uint32(w)).astype("<u4").view(np.uint8).reshape(-1, 4)
        body[(at[row] + n_out[rows][row] + 4 * order)[:, None] + np.arange(4)] = high
    head = np.array([len(lengths), len(ids), n_blocks], "<u4").tobytes()
    return b"".join([MAGIC, head, lengths.astype("<u4").tobytes(), starts.tobytes(), body.tobytes()])


def decode_segment(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, lengths) of a payload."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token segment")
    n_docs, n_ids, n_blocks = (int(x) for x in np.frombuffer(payload, "<u4", 3, 4))
    lengths = np.frombuffer(payload, "<u4", n_docs, 16)
    starts = np.frombuffer(payload, "<u4", n_blocks + 1, 16 + 4 * n_docs)
    body = np.frombuffer(payload, np.uint8, int(starts[-1]), 16 + 4 * n_docs + 4 * (n_blocks + 1))
    first = starts[:-1].astype(np.int64)
    low = np.ascontiguousarray(body[first[:, None] + np.arange(4)]).view("<u4").reshape(-1)
    width, n_out = body[first + 4].astype(np.int64), body[first + 5].astype(np.int64)
    ids = np.zeros((n_blocks, BLOCK), np.uint32)
    for w, rows in _by_width(width):
        values = np.zeros((len(rows), BLOCK), np.uint32)
        if w:
            values = _unpack(body[(first[rows] + 6)[:, None] + np.arange(BLOCK // 8 * w)], w)
        at = first[rows] + 6 + BLOCK // 8 * w
        row = np.repeat(np.arange(len(rows)), n_out[rows])
        order = np.arange(len(row)) - np.searchsorted(row, row)
        place = body[at[row] + order]
        high = np.ascontiguousarray(body[(at[row] + n_out[rows][row] + 4 * order)[:, None] + np.arange(4)])
        values[row, place] |= high.view("<u4").reshape(-1) << np.uint32(w)
        ids[rows] = values + low[rows][:, None]
    return ids.reshape(-1)[:n_ids], lengths


SEGMENTS = "part int, segment long, part_start long, n_ids long, doc_ids array<long>, payload binary"


def write_token_files(
    docs: DataFrame, path: str, encoder: Callable[[], Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]],
    end_id: int | None = END_ID, partitions: int | None = None,
) -> None:
    """Writes the ids of ``docs`` (doc_id, text) in ascending ``doc_id`` order.

    ``encoder()`` is called once a task and gives a function from texts to (ids,
    ids of each text); ``end_id`` is appended to each document. A null text is
    empty, a null id comes first, rows of one id are kept, by the hash of their text. Files
    hold ranges of ids, which is the one shuffle; an empty table gives no segment.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder()
        part, start, count = TaskContext.get().partitionId(), 0, 0
        for batch in slices(batches, "text", SEGMENT_BYTES):
            ids, lengths = encode(pc.fill_null(batch.column(1), ""))
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                lengths = lengths + 1
            payload = encode_segment(ids.astype(np.uint32, copy=False), lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([count], pa.int64()), pa.array([start], pa.int64()),
                    pa.array([len(ids)], pa.int64()), pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([payload], pa.binary()),
                ],
                names=["part", "segment", "part_start", "n_ids", "doc_ids", "payload"],
            )
            start, count = start + len(ids), count + 1

    n = partitions or shuffle_partitions(docs.sparkSession)
    rows = (
        docs.select("doc_id", "text")
        .repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .mapInArrow(segments, SEGMENTS)
    )
    with small_batches(docs.sparkSession):
        rows.write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files, decoded.

    ``start`` counts the ids of all documents before it. Segments know their place
    in their file; the files' totals, one row each, are summed up in a window.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths = decode_segment(batch.column(3)[i].as_py())
                ends = np.cumsum(lengths.astype(np.int64))
                raw = memoryview(np.ascontiguousarray(ids.astype("<u4"))).cast("B")
                starts = ends - lengths
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ends), batch.column(0)[i].as_py()), pa.int32()),
                        batch.column(2)[i].values,
                        pa.array(starts + batch.column(1)[i].as_py(), pa.int64()),
                        pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64()),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows = segments.select("part", "part_start", "doc_ids", "payload").mapInArrow(
        documents, "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    # One row a file.
    return rows.join(F.broadcast(offsets), F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("start") + F.col("_offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the token files of ``docs`` into the shared folder and reads them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, word_encoder(tokenizer))
    return read_token_files(spark, path)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, from the files."""
    return token_files(table(spark, sf_dir, "documents"))
