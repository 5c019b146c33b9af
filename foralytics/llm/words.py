"""Words of many texts at once, as numbers."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc


def word_codes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash of every distinct word, its number for every word, words of each text).

    Words are what ASCII white space separates; ``lower`` folds A-Z; a null text
    has none. Each distinct word is hashed once, with the same key everywhere.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    split = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    words = np.array(coded.dictionary.to_pylist(), dtype=object)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    if not len(words):
        return np.zeros(0, np.uint64), codes, counts
    hashes = pd.util.hash_array(words, categorize=False)
    blank = np.flatnonzero(words == "")
    if not len(blank):
        return hashes, codes, counts
    # Empty pieces stand at the ends of texts; the number of the blank one falls away.
    real = codes != blank[0]
    text_of = np.repeat(np.arange(len(counts)), counts)
    codes = codes[real]
    codes = np.where(codes > blank[0], codes - 1, codes)
    return np.delete(hashes, blank[0]), codes, np.bincount(text_of[real], minlength=len(counts)).astype(np.int64)


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, words of each text)."""
    hashes, codes, counts = word_codes(texts, lower)
    return hashes[codes], counts


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which near ones fall apart."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def run_hashes(values: np.ndarray, length: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of ``length`` consecutive values at every place, from runs of doubled length."""
    if len(values) < length:
        return np.zeros(0, np.uint64)
    run, size, power = values.astype(np.uint64), 1, base
    while size * 2 <= length:
        run = run[: len(run) - size] * np.uint64(power) + run[size:]
        size, power = size * 2, power * power % (1 << 64)
    out = run
    if size < length:
        # The last ``length`` - ``size`` values are covered by an overlapping run.
        n = len(values) - length + 1
        out = mixed(run[:n]) * np.uint64(base) + run[length - size : length - size + n]
    return mixed(out)


def smallest_in_runs(values: np.ndarray, length: int) -> np.ndarray:
    """Minimum of ``length`` consecutive values at every place."""
    low, size = values, 1
    while size * 2 <= length:
        low, size = np.minimum(low[: len(low) - size], low[size:]), size * 2
    n = len(values) - length + 1
    return np.minimum(low[:n], low[length - size : length - size + n])


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit numbers, byte by byte, which compresses well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(packed: bytes, width: int) -> np.ndarray:
    rows = np.frombuffer(packed, np.uint8).reshape(width, -1)
    values = np.zeros((rows.shape[1], 8), np.uint8)
    values[:, :width] = rows.T
    return values.view(np.uint64).ravel()
