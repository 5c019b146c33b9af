"""Encoding of texts with a public tokenizer, each distinct piece of a word once."""

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from foralytics.llm.words import mixed

Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

# Pieces whose ids a Python worker keeps, for all of its tasks; beyond them, those seen in one batch alone are forgotten.
KEPT_UNITS = 700_000
# Bytes of a piece that are hashed eight at a time; of a longer one a digest is taken.
HASHED = 64
# Pieces that are encoded in one call, joined by spaces.
JOINED = 512
# Pieces of texts whose ids are looked up at once.
GATHERED = 1 << 16
# Letters and marks whose case, normal form and class no Unicode version changes.
PLAIN = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = r"!-&(-/:-;=-@\[-`{-~"
# A word with anything else (an apostrophe, a less-than sign, a letter of another block)
# stays whole; in other words, runs of marks and single digits are set apart.
APART = rf"([^\s\x0b]*[^\s\x0b{PLAIN}0-9{MARKS}][^\s\x0b]*)|([{MARKS}]+)|([0-9])"

_encoders: dict[str, Encoder] = {}


def _build(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    suffix = tokenizer.model.end_of_word_suffix
    last = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, i in tokenizer.get_vocab().items():
        last[i] = token.endswith(suffix)
    one_run = re.compile(f"[{PLAIN}]+|[0-9]|[{MARKS}]+")
    known = Pieces()

    def learn(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, ids of each)."""
        pieces, sizes = [], []
        for i in range(0, len(units), JOINED):
            group = units[i : i + JOINED]
            found = tokenizer.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0]
            ids = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(last[ids]) + 1
            if len(ends) != len(group):
                # Units of several tokens with an end of their own are told apart one by one.
                ids, each = learn_alone(group)
                pieces.append(ids)
                sizes.append(each)
                continue
            pieces.append(ids)
            sizes.append(np.diff(ends, prepend=0))
        return np.concatenate(pieces), np.concatenate(sizes)

    def learn_alone(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [x.ids for x in tokenizer.encode_batch_fast(units, add_special_tokens=False)]
        return np.concatenate([np.array(x, np.uint32) for x in each]), np.array([len(x) for x in each], np.int64)

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, APART, r" \1\2\3 "))
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        coded = split.flatten().dictionary_encode()
        units, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        # The pieces of the texts are not needed beside their ids.
        del split, coded
        hashes = known.hashed(units)
        rows = known.find(units, hashes)
        fresh = np.flatnonzero(rows < 0)
        if len(fresh):
            new = units.take(pa.array(fresh))
            texts_of = new.to_pylist()
            plain = np.array([one_run.fullmatch(u) is not None for u in texts_of])
            # One unit a call where a unit may be several words of the tokenizer.
            for chosen, by in ((np.flatnonzero(plain), learn), (np.flatnonzero(~plain), learn_alone)):
                if len(chosen):
                    at = known.add(new.take(pa.array(chosen)), hashes[fresh[chosen]], *by([texts_of[i] for i in chosen.tolist()]))
                    rows[fresh[chosen]] = at
        known.used(rows)
        starts = known.edges[rows]
        each = (known.edges[rows + 1] - starts)[codes]
        done = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(each, out=done[1:])
        ends = done[np.cumsum(counts)] if len(counts) else np.zeros(0, np.int64)
        found = np.empty(int(done[-1]), np.uint32)
        for a in range(0, len(codes), GATHERED):
            b = min(a + GATHERED, len(codes))
            places = np.repeat(starts[codes[a:b]] - (done[a:b] - done[a]), each[a:b])
            places += np.arange(len(places))
            found[done[a] : done[b]] = known.flat[places]
        known.forget()
        return found, np.diff(np.concatenate([[0], ends])).astype(np.int64)

    return encode


class Pieces:
    """Pieces of words and their ids, some 60 bytes each: sorted hashes tell where a piece is, the piece itself whether it is the one."""

    def __init__(self) -> None:
        self.units = pa.array([], pa.string())
        self.hashes, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        # The ids of piece i are flat[edges[i]:edges[i + 1]]; so many batches have used it.
        self.flat, self.edges, self.uses = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int32)

    @staticmethod
    def hashed(units: pa.Array) -> np.ndarray:
        """64-bit hashes of the units' bytes, eight at a time."""
        n = len(units)
        if not n:
            return np.zeros(0, np.uint64)
        _, offsets, data = units.buffers()
        starts = np.frombuffer(offsets, np.int32)[units.offset : units.offset + n + 1].astype(np.int64)
        sizes, starts = np.diff(starts), starts[:-1]
        raw = np.zeros((data.size if data else 0) + 8, np.uint8)
        raw[:-8] = np.frombuffer(data, np.uint8) if data else 0
        words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        hashes = mixed(sizes.astype(np.uint64))
        for k in range(0, min(int(sizes.max()), HASHED), 8):
            on = np.flatnonzero(sizes > k)
            unused = np.maximum(0, 8 - (sizes[on] - k)).astype(np.uint64) * np.uint64(8)
            word = words[starts[on] + k] << unused
            hashes[on] = mixed(hashes[on] ^ word) + np.uint64(k)
        for i in np.flatnonzero(sizes > HASHED).tolist():
            digest = hashlib.blake2b(raw[starts[i] : starts[i] + sizes[i]], digest_size=8).digest()
            hashes[i] = np.frombuffer(digest, np.uint64)[0]
        return hashes

    def find(self, units: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Number of each unit, -1 for one that is not known."""
        rows = np.full(len(units), -1, np.int64)
        if not len(units) or not len(self.hashes):
            return rows
        # In order, the searches stay near each other.
        order = np.argsort(hashes)
        at = np.empty(len(units), np.int64)
        at[order] = np.minimum(np.searchsorted(self.hashes, hashes[order]), len(self.hashes) - 1)
        like = np.flatnonzero(self.hashes[at] == hashes)
        rows[like] = self.order[at[like]]
        same = pc.equal(self.units.take(pa.array(rows[like])), units.take(pa.array(like))).to_numpy(zero_copy_only=False)
        for i in like[~same].tolist():
            # Another piece of the same hash: look through all that have it.
            place, rows[i] = int(at[i]), -1
            while place < len(self.hashes) and self.hashes[place] == hashes[i]:
                if self.units[int(self.order[place])].as_py() == units[i].as_py():
                    rows[i] = self.order[place]
                place += 1
        return rows

    def add(self, units: pa.Array, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The numbers that the units get."""
        first = len(self.units)
        self.units = pa.concat_arrays([self.units, units])
        self.flat = np.concatenate([self.flat, ids])
        self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(sizes)])
        self.uses = np.concatenate([self.uses, np.zeros(len(units), np.int32)])
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.order = np.insert(self.order, at, (first + order).astype(np.int32))
        return np.arange(first, first + len(units))

    def used(self, rows: np.ndarray) -> None:
        self.uses[rows] += 1

    def forget(self) -> None:
        """If there are too many, keep the pieces that several batches have used, or none if these are still too many."""
        if len(self.units) <= KEPT_UNITS:
            return
        several = np.flatnonzero(self.uses > 1)
        kept = several if 2 * len(several) <= KEPT_UNITS else several[:0]
        units, sizes, starts = self.units.take(pa.array(kept)), np.diff(self.edges)[kept], self.edges[kept]
        done = np.cumsum(sizes)
        ids = self.flat[np.arange(int(done[-1]) if len(done) else 0) + np.repeat(starts - (done - sizes), sizes)]
        self.__init__()
        if len(units):
            self.add(units, self.hashed(units), ids, sizes)


def word_encoder(path: str | None = None) -> Callable[[], Encoder]:
    """Encoder of the tokenizers file at ``path``, by default the public 49k word vocabulary.

    That tokenizer never joins anything across white space, and marks the last
    token of every run of letters or marks and of every digit. So texts are cut into
    these runs, and each distinct run is encoded once: many in one call, told apart
    by the end marks. A word whose runs could be cut differently is encoded whole.
    """

    def make() -> Encoder:
        where = path
        if where is None:
            import public_tokenizers

            where = public_tokenizers.path("word_bpe_49k.json")
        if where not in _encoders:
            _encoders[where] = _build(where)
        return _encoders[where]

    return make
