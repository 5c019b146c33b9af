"""Trees of token bitmaps over sets, and their dual traversal.

A set is known by its size and a bitmap in which each token sets one bit. Two
sets have at most ``common bits + excess`` tokens in common, where the excess of
a set is its size less its set bits (tokens that share a bit). A node holds the
OR of its sets' bitmaps, their least and greatest size and their greatest
excess, so the same bound holds for any pair taken from two nodes: node pairs
that cannot reach the overlap that the similarity asks for are pruned at once.
"""

from dataclasses import dataclass

import numpy as np

# Sets of a few hundred tokens leave most bits free, so the bounds are tight.
BITS = 2048
FAN = 8
# Pairs of nodes that are judged at once.
STEP = 20_000


def bitmaps(tokens: np.ndarray, set_of: np.ndarray, n_sets: int) -> np.ndarray:
    """A row of ``BITS`` / 64 numbers for each set; tokens are mixed 64-bit hashes."""
    seen = np.zeros((n_sets, BITS), bool)
    seen[set_of, (tokens >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(seen, axis=1).view(np.uint64)


@dataclass
class Level:
    bits: np.ndarray
    least: np.ndarray
    most: np.ndarray
    excess: np.ndarray
    # Component of all sets below, -1 where there are several.
    group: np.ndarray


def _level_above(low: Level) -> Level:
    starts = np.arange(0, len(low.least), FAN)
    group = np.minimum.reduceat(low.group, starts)
    return Level(
        np.bitwise_or.reduceat(low.bits, starts, axis=0),
        np.minimum.reduceat(low.least, starts),
        np.maximum.reduceat(low.most, starts),
        np.maximum.reduceat(low.excess, starts),
        np.where(group == np.maximum.reduceat(low.group, starts), group, -1),
    )


def build(sizes: np.ndarray, bits: np.ndarray, groups: np.ndarray) -> list[Level]:
    """Levels from the sets, which the caller has put in order, up to one root."""
    set_bits = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    levels = [Level(bits, sizes, sizes, sizes - set_bits, groups)]
    while len(levels[-1].least) > 1:
        levels.append(_level_above(levels[-1]))
    return levels


def _survive(level: Level, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Node pairs in which some two sets of different groups may have ``num`` / ``den`` in common."""
    kept = (level.group[a] != level.group[b]) | (level.group[a] < 0)
    smaller, larger = np.minimum(level.most[a], level.most[b]), np.maximum(level.least[a], level.least[b])
    kept &= den * smaller >= num * larger
    common = np.bitwise_count(level.bits[a] & level.bits[b]).sum(axis=1)
    overlap = np.minimum(smaller, common + np.minimum(level.excess[a], level.excess[b]))
    return kept & ((num + den) * overlap >= num * (level.least[a] + level.least[b]))


def plausible_pairs(
    sizes: np.ndarray, bits: np.ndarray, groups: np.ndarray, num: int, den: int
) -> tuple[np.ndarray, np.ndarray]:
    """(i, j), i < j, of all pairs that the bounds cannot rule out and whose groups differ.

    Groups are non-negative numbers; sets of one group are already known to be joined.
    """
    # Sets alike in size and bits stand side by side, so nodes are tight.
    order = np.lexsort((bits[:, 0], sizes))
    levels = build(sizes[order], bits[order], groups[order])
    a = b = np.zeros(1, np.int64)
    if len(sizes) == 1:
        return a[:0], b[:0]
    for level in reversed(levels[:-1]):
        n = len(level.least)
        children = np.arange(FAN)
        # All pairs may be gone by now.
        found_a, found_b = [a[:0]], [b[:0]]
        for at in range(0, len(a), STEP // FAN**2 + 1):
            x = a[at : at + STEP // FAN**2 + 1, None, None] * FAN + children[None, :, None]
            y = b[at : at + STEP // FAN**2 + 1, None, None] * FAN + children[None, None, :]
            x, y = (z.ravel() for z in np.broadcast_arrays(x, y))
            # Above the sets a node meets itself too; a set does not.
            valid = (y < n) & ((x < y) if level is levels[0] else (x <= y))
            x, y = x[valid], y[valid]
            kept = _survive(level, x, y, num, den)
            found_a.append(x[kept])
            found_b.append(y[kept])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
    i, j = order[a], order[b]
    return np.minimum(i, j), np.maximum(i, j)


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join what ``(i, j)`` join: a breadth-first forest, ``n`` - 1 at most."""
    linked = np.zeros((n, n), bool)
    linked[i, j] = linked[j, i] = True
    fresh = np.ones(n, bool)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for root in range(n):
        if not fresh[root]:
            continue
        fresh[root] = False
        queue = [root]
        while queue and fresh.any():
            node = queue.pop(0)
            near = np.flatnonzero(linked[node] & fresh)
            if len(near):
                fresh[near] = False
                out.append((np.full(len(near), node), near))
                queue.extend(near.tolist())
    if not out:
        return i[:0], j[:0]
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])
