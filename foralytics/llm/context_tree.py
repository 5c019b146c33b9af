"""Context-tree weighting over bytes, from counts.

Every byte is eight binary decisions, each with a context tree of its own. A
node of a tree stands for the last 0 to ``DEPTH`` bytes and the bits of the byte
that are already known. It holds the zeros and ones that training saw there, and
estimates the next bit by Krichevsky and Trofimov's rule. Its weighted probability
is half its own block probability and half the product of its children's; so the
weight of its own estimate against its child's follows, and a prediction mixes
the estimates of all depths. A child without any counts leaves the prediction to
its parent. Counts do not depend on the order of the training text, so they can be
gathered in any order and place.

Grams are numbers of ``DEPTH`` + 1 bytes: the context, the latest byte foremost,
then the byte that follows. Sorted grams thus hold every context as a range.
"""

import numpy as np

DEPTH = 5
SYMBOL = 8
# Depths from this one on are worked out among the grams that share their last bytes.
SPLIT = 2


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for positive numbers (Stirling's series above 8)."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    low = x < 8
    y = np.where(low, x + 8, x)
    if low.any():
        small = x[low]
        shift[low] = sum(np.log(small + k) for k in range(8))
    inverse = 1 / y
    series = inverse * (1 / 12 - inverse**2 * (1 / 360 - inverse**2 * (1 / 1260 - inverse**2 / 1680)))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


def own_weight(zeros, ones, children) -> tuple[np.ndarray, np.ndarray]:
    """(weight of a node's own estimate, log of its weighted probability); ``children``: log of their product."""
    own = log_block(zeros, ones)
    both = np.logaddexp(own, children)
    return np.exp(own - both), both - np.log(2)


class Subtree:
    """The nodes of depths ``SPLIT`` to ``DEPTH`` over sorted distinct ``grams`` and their ``counts``."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.symbol = (grams & np.uint64(0xFF)).astype(np.int64)
        context = grams >> np.uint64(SYMBOL)
        n = len(grams)
        weights = counts.astype(np.float64)
        self.levels = []
        for level in range(8):
            bit = (self.symbol >> (7 - level)) & 1
            known = self.symbol >> (8 - level)
            tables, below = {}, None
            for depth in range(DEPTH, SPLIT - 1, -1):
                held = context >> np.uint64(8 * (DEPTH - depth))
                # Grams of a context are neighbours, but a node's grams also share the known bits.
                new = np.ones(n, bool)
                new[1:] = held[1:] != held[:-1]
                key = (np.cumsum(new) - 1) * (1 << level) + known
                _, first, node = np.unique(key, return_index=True, return_inverse=True)
                node = node.ravel()
                zeros = np.bincount(node, weights * (bit == 0), len(first))
                ones = np.bincount(node, weights * bit, len(first))
                if below is None:
                    weight, log_weighted = np.ones(len(first)), log_block(zeros, ones)
                else:
                    children = np.bincount(node[below[0]], below[1], len(first))
                    weight, log_weighted = own_weight(zeros, ones, children)
                below = (first, log_weighted)
                tables[depth] = (node, zeros, ones, weight)
            self.levels.append((bit, known, tables, below))

    def roots(self) -> tuple[np.ndarray, ...]:
        """(index of a gram, tree node, zeros, ones, log weighted probability) of each node of depth ``SPLIT``."""
        parts = []
        for level, (_, known, tables, (first, log_weighted)) in enumerate(self.levels):
            _, zeros, ones, _ = tables[SPLIT]
            parts.append((first, (1 << level) + known[first], zeros, ones, log_weighted))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def log10_probabilities(self, upper: list[tuple[np.ndarray, np.ndarray, np.ndarray]], latest: np.ndarray) -> np.ndarray:
        """Of each gram's symbol in its context.

        ``upper`` holds (zeros, ones, weight) by (latest byte, tree node) for the
        depths above ``SPLIT``, from 0 on; ``latest`` is each gram's latest byte.
        """
        total = np.zeros(len(self.symbol))
        for level, (bit, known, tables, _) in enumerate(self.levels):
            path = []
            for depth, (zeros, ones, weight) in enumerate(upper):
                at = (latest if depth else np.zeros_like(latest), (1 << level) + known)
                path.append((zeros[at], ones[at], weight[at]))
            for depth in range(SPLIT, DEPTH + 1):
                node, zeros, ones, weight = tables[depth]
                path.append((zeros[node], ones[node], weight[node]))
            chance, seen = np.full(len(bit), 0.5), np.zeros(len(bit), bool)
            for zeros, ones, weight in reversed(path):
                own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
                chance = np.where(seen, weight * own + (1 - weight) * chance, own)
                seen |= zeros + ones > 0
            total += np.log10(chance)
        return total


def upper_levels(latest: np.ndarray, node: np.ndarray, zeros, ones, log_weighted) -> list[tuple[np.ndarray, ...]]:
    """(zeros, ones, weight) arrays of depths 0 and 1, from sums over the roots of depth 2.

    One entry for each latest byte and tree node: 256 x 255 at most.
    """
    shape = (256, 256)
    a, b, c = (np.zeros(shape) for _ in range(3))
    a[latest, node], b[latest, node], c[latest, node] = zeros, ones, log_weighted
    weight, log_one = own_weight(a, b, c)
    log_one[(a + b) == 0] = 0
    top_a, top_b = a.sum(axis=0, keepdims=True), b.sum(axis=0, keepdims=True)
    top_weight, _ = own_weight(top_a, top_b, log_one.sum(axis=0, keepdims=True))
    return [(top_a, top_b, top_weight), (a, b, weight)]


def stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, first place of each): ``DEPTH`` zeros before and one after each text, the end."""
    parts = []
    for text in texts:
        parts.append(bytes(DEPTH))
        parts.append(text)
        parts.append(b"\0")
    sizes = np.array([len(x) + DEPTH + 1 for x in texts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes


def distinct_grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct grams, number of the gram that ends at every place from ``DEPTH`` on).

    Runs are numbered byte by byte: the number of a run and the next byte give the
    place in a table, which numbers the longer runs.
    """
    used = np.zeros(256, bool)
    used[data] = True
    small = (np.cumsum(used) - 1).astype(np.int32)[data]
    alphabet = int(used.sum())
    number, n = small, alphabet
    for length in range(1, DEPTH + 1):
        kind = np.int32 if n * alphabet < 1 << 31 else np.int64
        code = number[: len(data) - length].astype(kind) * kind(alphabet) + small[length:].astype(kind)
        present = np.zeros(n * alphabet, bool)
        present[code] = True
        found = np.flatnonzero(present)
        rank = np.empty(n * alphabet, np.int32)
        rank[found] = np.arange(len(found), dtype=np.int32)
        number, n = rank[code], len(found)
    place = np.empty(n, np.int64)
    place[number] = np.arange(len(number))
    grams = np.zeros(n, np.uint64)
    for back in range(1, DEPTH + 1):
        grams = (grams << np.uint64(8)) | data[place + DEPTH - back]
    return (grams << np.uint64(8)) | data[place + DEPTH], number
