"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in both directions, labels every byte
with a probability of each language, and the document's probabilities are pooled
from all of its bytes. It is trained in numpy by backpropagation through time on a
bounded sample of labelled rows, on the driver; its weights, a few kilobytes, go
with the task. Prediction reads whole texts, cut into segments of ``SEGMENT`` bytes
which are read side by side, with no shuffle.

Gates are x / (1 + |x|), moved to 0..1, and states x / (1 + |x|): they cost a fraction of
the logistic and hyperbolic functions and learn these tasks as well.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foralytics.llm.common import remainder_of_id, slices, table

HIDDEN = 8
# Bytes read from one state; a longer text is several segments, all of which count.
SEGMENT = 96
# Labelled rows of each language that are learnt from.
ROWS_PER_LANGUAGE = 400
# Groups in which the hashes of a language's texts are cut down first.
SALTS = 64
STEPS = 220
BATCH = 256
RATE = 0.02
# A document is rejected below this pooled probability.
LEAST = 0.4
UNKNOWN = "und"
TEXT_BYTES = 3 << 20
SIDE_BY_SIDE = 2048


def soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Direction:
    """One gated recurrent layer: update and reset gates and a candidate, in this order."""

    byte: np.ndarray  # 3H x 256
    state: np.ndarray  # 3H x H

    def forward(self, data: np.ndarray, tape: list | None = None) -> np.ndarray:
        """States (steps, H, batch) over ``data`` (steps, batch) of bytes.

        Rows of one unit lie side by side, so that every operation runs over the batch.
        """
        h, batch = self.state.shape[1], data.shape[1]
        states = np.empty((len(data), h, batch), np.float32)
        last = np.zeros((h, batch), np.float32)
        # Gates are kept as 1 + x / (1 + |x|); their half is taken into the weights and the step.
        gates_of, candidate_of = self.state[: 2 * h], 0.5 * self.state[2 * h :]
        read, scale, candidate_scale = (np.empty((k * h, batch), np.float32) for k in (3, 2, 1))
        gates, held, inner = (np.empty((k * h, batch), np.float32) for k in (2, 1, 1))
        for t in range(len(data)):
            if tape is not None:
                scale, candidate_scale, gates, held, inner = (x.copy() for x in (scale, candidate_scale, gates, held, inner))
            np.take(self.byte, data[t], axis=1, out=read, mode="clip")
            np.matmul(gates_of, last, out=gates)
            gates += read[: 2 * h]
            np.abs(gates, out=scale)
            scale += 1
            gates /= scale
            gates += 1
            np.multiply(gates[h:], last, out=held)
            np.matmul(candidate_of, held, out=inner)
            inner += read[2 * h :]
            np.abs(inner, out=candidate_scale)
            candidate_scale += 1
            inner /= candidate_scale
            new = np.subtract(inner, last, out=states[t])
            new *= gates[:h]
            new *= 0.5
            new += last
            if tape is not None:
                tape.append((last, gates, held, inner, scale, candidate_scale))
            last = new
        return states

    def backward(self, data: np.ndarray, tape: list, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``byte`` and ``state``, given those of the states (backpropagation through time)."""
        h = self.state.shape[1]
        of_byte, of_state = np.zeros_like(self.byte), np.zeros_like(self.state)
        carried = np.zeros_like(wanted[0])
        for t in range(len(data) - 1, -1, -1):
            last, gates, held, inner, scale, candidate_scale = tape[t]
            update, reset = 0.5 * gates[:h], 0.5 * gates[h:]
            grad = wanted[t] + carried
            # The slope of x / (1 + |x|) is 1 / (1 + |x|)^2; gates are half of that.
            of_inner = grad * update / candidate_scale**2
            of_held = self.state[2 * h :].T @ of_inner
            of_update = grad * (inner - last) * 0.5 / scale[:h] ** 2
            of_reset = of_held * last * 0.5 / scale[h:] ** 2
            of_gates = np.concatenate([of_update, of_reset])
            carried = grad * (1 - update) + of_held * reset + self.state[: 2 * h].T @ of_gates
            of_state[: 2 * h] += of_gates @ last.T
            of_state[2 * h :] += of_inner @ (0.5 * held).T
            np.add.at(of_byte.T, data[t], np.concatenate([of_gates, of_inner]).T)
        return of_byte, of_state


@dataclass
class Model:
    languages: list[str]
    ahead: Direction
    back: Direction
    out: np.ndarray  # languages x (2H + 1)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.byte, self.ahead.state, self.back.byte, self.back.state, self.out]

    def labels(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (steps, languages, batch) of every byte of ``data`` (steps, batch)."""
        h = self.ahead.state.shape[1]
        ahead, back = self.ahead.forward(data), self.back.forward(data[::-1])
        chance = np.empty((len(data), len(self.out), data.shape[1]), np.float32)
        for t in range(len(data)):
            scores = np.matmul(self.out[:, :h], ahead[t], out=chance[t])
            scores += self.out[:, h : 2 * h] @ back[len(data) - 1 - t]
            scores += self.out[:, -1:]
            scores -= scores.max(axis=0)
            np.exp(scores, out=scores)
            scores /= scores.sum(axis=0)
        return chance


def segments(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes (segments, ``SEGMENT``), text of each segment, bytes in use of each segment).

    The unused end of a text's last segment holds zeros.
    """
    sizes = np.array([len(x) for x in texts], np.int64)
    counts = -(-sizes // SEGMENT)
    text_of = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(text_of)) - np.repeat(np.cumsum(counts) - counts, counts)
    used = np.minimum(SEGMENT, sizes[text_of] - number * SEGMENT)
    data = np.zeros(len(text_of) * SEGMENT, np.uint8)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    first_segment = (np.cumsum(counts) - counts) * SEGMENT
    first_byte = np.cumsum(sizes) - sizes
    for i in range(len(texts)):
        data[first_segment[i] : first_segment[i] + sizes[i]] = raw[first_byte[i] : first_byte[i] + sizes[i]]
    return data.reshape(-1, SEGMENT), text_of, used


def train(rows: list[tuple[str, str]], seed: int = 1) -> Model:
    """The network learnt from (text, language) rows by Adam over mini-batches of segments."""
    languages = sorted({language for _, language in rows})
    random = np.random.default_rng(seed)

    def start(*shape: int) -> np.ndarray:
        return (random.standard_normal(shape) * 0.3).astype(np.float32)

    h, n = HIDDEN, len(languages)
    model = Model(languages, *(Direction(start(3 * h, 256), start(3 * h, h)) for _ in range(2)), start(n, 2 * h + 1))
    data, text_of, used = segments([text.encode() for text, _ in rows])
    truth = np.array([languages.index(language) for _, language in rows])[text_of] if len(rows) else text_of
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in model.parameters()]
    # Every language weighs the same, however many segments it has.
    share = 1 / np.maximum(1, np.bincount(truth, minlength=n))[truth] if len(truth) else truth
    for step in range(1, STEPS + 1):
        if not len(data) or n < 2:
            break
        chosen = random.choice(len(data), BATCH, p=share / share.sum())
        grads = _gradients(model, data[chosen].T, truth[chosen], used[chosen])
        pace = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for p, g, (mean, square) in zip(model.parameters(), grads, moments, strict=True):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            p -= pace * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return model


def _gradients(model: Model, data: np.ndarray, truth: np.ndarray, used: np.ndarray) -> list[np.ndarray]:
    """Of the mean loss over the bytes in use, each labelled with its text's language."""
    h = model.ahead.state.shape[1]
    tapes: tuple[list, list] = ([], [])
    ahead = model.ahead.forward(data, tapes[0])
    back = model.back.forward(data[::-1], tapes[1])[::-1]
    both = np.concatenate([ahead, back, np.ones((len(data), 1, data.shape[1]), np.float32)], axis=1)
    scores = model.out @ both
    scores -= scores.max(axis=1, keepdims=True)
    chance = np.exp(scores)
    chance /= chance.sum(axis=1, keepdims=True)
    chance[:, truth, np.arange(len(truth))] -= 1
    chance *= ((np.arange(len(data))[:, None] < used) / used.sum())[:, None, :].astype(np.float32)
    of_out = np.einsum("tlb,tib->li", chance, both, optimize=True)
    of_both = model.out.T @ chance
    of_ahead = model.ahead.backward(data, tapes[0], of_both[:, :h])
    of_back = model.back.backward(data[::-1], tapes[1], of_both[::-1, h : 2 * h])
    return [*of_ahead, *of_back, of_out]


def pooled(model: Model, texts: list[bytes]) -> np.ndarray:
    """Probabilities (texts, languages): the mean of all bytes' label probabilities."""
    data, text_of, used = segments(texts)
    total = np.zeros((len(texts), len(model.languages)))
    for a in range(0, len(data), SIDE_BY_SIDE):
        n = used[a : a + SIDE_BY_SIDE]
        chance = model.labels(np.ascontiguousarray(data[a : a + SIDE_BY_SIDE].T))
        for i in np.flatnonzero(n < SEGMENT).tolist():
            chance[n[i] :, :, i] = 0
        np.add.at(total, text_of[a : a + SIDE_BY_SIDE], chance.sum(axis=0).T)
    sizes = np.array([max(1, len(x)) for x in texts])
    return total / sizes[:, None]


def sample(labelled: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> list[tuple[str, str]]:
    """Up to ``rows`` different texts of each language, by the hash of the text: the documented bound of the training.

    Copies take one place. The hashes are cut down within salts of a language first, so no task
    sees all of a language's; only the texts of the chosen ones are gathered, whole.
    """
    hashes = labelled.where("lang is not null and text is not null").select("lang", F.xxhash64("text").alias("hash")).distinct()
    salt = F.pmod("hash", F.lit(SALTS))
    few = hashes.withColumn("place", F.row_number().over(Window.partitionBy("lang", salt).orderBy("hash"))).where(F.col("place") <= rows)
    order = Window.partitionBy("lang").orderBy("hash")
    chosen = few.select("lang", "hash", F.row_number().over(order).alias("place")).where(F.col("place") <= rows)
    # At most ``rows`` hashes a language are broadcast.
    texts = labelled.select("lang", F.xxhash64("text").alias("hash"), "text").join(F.broadcast(chosen), ["lang", "hash"])
    once = texts.groupBy("lang", "hash", "place").agg(F.min("text").alias("text"))
    return [(r["text"], r["lang"]) for r in sorted(once.collect(), key=lambda r: (r["lang"], r["place"]))]


def _predict(model: Model, names_of_result: tuple[str, str]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            texts = pc.fill_null(batch.column(batch.schema.get_field_index("text")), "")
            lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            known = np.flatnonzero(lettered)
            if len(known) and model.languages:
                chance = pooled(model, [texts[int(i)].as_buffer().to_pybytes() for i in known])
                names[known] = np.array(model.languages, object)[chance.argmax(axis=1)]
                scores[known] = np.minimum(1.0, chance.max(axis=1))
            columns = [*batch.columns, pa.array(names.tolist(), pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names_of_result])

    return predict


def identify(docs: DataFrame, labelled: DataFrame, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its probability, learnt from ``labelled`` (text, lang).

    ``docs`` has a column ``text``; its other columns go through untouched and are
    no input, equal texts get equal predictions. ``und`` and 0 stand for null texts
    and texts without a letter, and for all if nothing is labelled. ``names`` must be
    none of the columns.
    """
    model = train(sample(labelled))
    added = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return docs.mapInArrow(_predict(model, names), T.StructType([*docs.schema.fields, *added]))


def keep_known(docs: DataFrame, labelled: DataFrame, least: float = LEAST) -> DataFrame:
    """Rows of ``docs`` whose language is told with a probability of ``least`` or more; all columns stay.

    ``docs`` must have no column ``__lang`` or ``__chance``.
    """
    told = identify(docs, labelled, ("__lang", "__chance"))
    return told.where((F.col("__lang") != UNKNOWN) & (F.col("__chance") >= least)).drop("__lang", "__chance")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    held_out = (remainder_of_id(F.col("doc_id"), 4) == 2).alias("held_out")
    return identify(docs.select("doc_id", held_out, "text"), docs.where(~held_out)).select(
        "doc_id", "held_out", "lang_pred", "score"
    )
