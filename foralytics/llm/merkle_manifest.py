"""Merkle manifest of a dataset, with leaf places from ranked bitmaps.

Every row is a leaf; the leaves of a group ascend by key and are hashed together, three
at a time and level by level, to the group's subroot; the subroots, in the order of the
groups, likewise to the root. A row's proof are the siblings on its way up.

Places come without sorting the rows. Keys are cut into ranges of ``IDS``; the keys of a
group in a range are a compressed bitmap, an array of 16-bit numbers while that is
shorter, and where rows share a key a list of their numbers. Tasks make bitmaps of what they
see, which are merged by (group, range). The rows in every range are added up in a
directory of three levels, and the place of a row is the directory's sum before its range
plus the rank of its key in the bitmap, by popcounts. For that, bitmaps and rows meet
in the partition of the range and one passes the other, so no task holds a range's rows;
rows of a range are dealt over ``SALTS`` partitions, those without a key over 256.

Then rows are keyed by (group, block of ``BLOCK`` places). A block is an array with one
slot a place, reduced by seven levels in one task to one node of the next, much smaller
tree, until a group is one node. Way back, every block takes the path above it
and gives its leaves their proofs. A group of any size is so many blocks.

Rows without a key come first, and the null group is a group like any other, the first.
Rows of one key are ordered by leaf; equal rows stand beside each other, each in its own place.
An empty table gives an empty manifest. Column names do not matter: only the leaf, the
group and the key go on.
"""

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foralytics.llm.common import remainder_of_id, table
from foralytics.scratch import discard, scratch_path, stage

# A run of nodes that becomes one.
RUN = 3
LEVELS = 7
BLOCK = RUN**LEVELS
# Keys of a range, as bits, and bits of a directory level above it.
BITS = 12
IDS = 1 << BITS
STEP = 18
SALTS = 4
SALTS_OF_NONE = 256
# The range of rows without a key, below all others.
NONE = -(1 << 63)
# Copies of a row that one step writes out.
COPIES = 4096


def tagged(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: Sequence[Column]) -> Column:
    """sha256 of the tagged values, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[tagged(v) for v in values]), 256))


# --- bitmaps ---------------------------------------------------------------------------


def pack(lows: np.ndarray) -> bytes:
    """Sorted distinct numbers below ``IDS``: a bitmap, or 16-bit numbers if that is shorter."""
    if 2 * len(lows) < IDS // 8:
        return lows.astype("<u2").tobytes()
    bits = np.zeros(IDS, np.uint8)
    bits[lows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    if len(packed) < IDS // 8:
        return np.frombuffer(packed, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little"))


class Ranks:
    """Rows before each key of a range: ranks in its bitmap, and the further rows of keys that several share."""

    def __init__(self, packed: bytes, shared: bytes, numbers: bytes) -> None:
        self.lows = unpack(packed) if len(packed) < IDS // 8 else None
        if self.lows is None:
            self.words = np.frombuffer(packed, "<u8")
            self.directory = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])
        self.shared = np.frombuffer(shared, "<u2").astype(np.int64)
        self.further = np.concatenate([[0], np.cumsum(np.frombuffer(numbers, "<i8") - 1)])

    def before(self, lows: np.ndarray) -> np.ndarray:
        if self.lows is not None:
            rank = np.searchsorted(self.lows, lows)
        else:
            word, bit = lows >> 6, (lows & 63).astype(np.uint64)
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.directory[word] + np.bitwise_count(below)
        return rank + self.further[np.searchsorted(self.shared, lows)]

    def rows(self, lows: np.ndarray) -> np.ndarray:
        """Rows that have the key."""
        at = np.searchsorted(self.shared, lows)
        return 1 + self.further[np.searchsorted(self.shared, lows, side="right")] - self.further[at]


BITMAP = "tree string, range long, ids binary, shared binary, numbers binary, total long"


def _bitmap(lows: np.ndarray, numbers: np.ndarray) -> dict:
    """Columns of a bitmap; ``numbers`` are the rows of each of the distinct ``lows``."""
    several = numbers > 1
    return {
        "ids": pack(lows), "shared": lows[several].astype("<u2").tobytes(), "numbers": numbers[several].astype("<i8").tobytes(), "total": int(numbers.sum()),
    }


def _summed(lows: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, of = np.unique(lows, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, of, numbers)
    return distinct, sums


def _bitmaps_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of (tree, range, low, rows), as far as a batch goes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        trees = batch.column(0).dictionary_encode()
        ranges, lows, rows = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2, 3))
        tree = trees.indices.to_numpy(zero_copy_only=False)
        order = np.lexsort((ranges, tree))
        tree, ranges, lows, rows = tree[order], ranges[order], lows[order], rows[order]
        starts = np.flatnonzero(np.append(True, (tree[1:] != tree[:-1]) | (ranges[1:] != ranges[:-1])))
        out = []
        for a, b in zip(starts, np.append(starts[1:], len(tree)), strict=True):
            out.append({"tree": trees.dictionary[int(tree[a])].as_py(), "range": int(ranges[a]), **_bitmap(*_summed(lows[a:b], rows[a:b]))})
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW_BITMAP)


_ARROW_BITMAP = pa.schema([("tree", pa.string()), ("range", pa.int64()), ("ids", pa.binary()), ("shared", pa.binary()), ("numbers", pa.binary()), ("total", pa.int64())])


def _merge(parts: pa.Table) -> pa.Table:
    """The bitmaps of one range as one."""
    lows, numbers = [], []
    for part in parts.select(["ids", "shared", "numbers"]).to_pylist():
        mine = unpack(part["ids"])
        rows = np.ones(len(mine), np.int64)
        rows[np.searchsorted(mine, np.frombuffer(part["shared"], "<u2"))] = np.frombuffer(part["numbers"], "<i8")
        lows.append(mine)
        numbers.append(rows)
    first = parts.slice(0, 1).select(["tree", "range"]).to_pylist()[0]
    return pa.Table.from_pylist([{**first, **_bitmap(*_summed(np.concatenate(lows), np.concatenate(numbers)))}], schema=_ARROW_BITMAP)


def directory(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps with ``first``, the rows of the tree before the range, and ``size``, those of the whole tree.

    A window sees the ranges of one node of the level above, at most 2 ** ``STEP``.
    """
    levels = [bitmaps.withColumn("up", F.shiftright("range", STEP))]
    for _ in range(2):
        above = levels[-1].groupBy("tree", F.col("up").alias("range")).agg(F.sum("total").alias("total"))
        levels.append(above.withColumn("up", F.shiftright("range", STEP)))
    top = levels.pop().select("tree", "range", "total")
    whole = Window.partitionBy("tree")
    found = top.select(
        "tree", F.col("range").alias("above"),
        F.coalesce(F.sum("total").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("total").over(whole).alias("size"),
    )
    for level in reversed(levels):
        run = Window.partitionBy("tree", "up").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        here = level.withColumn("inside", F.coalesce(F.sum("total").over(run), F.lit(0)))
        joined = here.join(found.withColumnRenamed("above", "up"), ["tree", "up"])
        found = joined.select(
            "tree", F.col("range").alias("above"), (F.col("before") + F.col("inside")).alias("before"), "size",
            *[c for c in ("ids", "shared", "numbers") if c in level.columns],
        )
    return found.withColumnsRenamed({"above": "range", "before": "first"})


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows behind the bitmap of their range, with the place of their key and the number of rows that have it."""
    held, ranks, first, size = None, None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        trees = batch.column(0).dictionary_encode()
        tree = trees.indices.to_numpy(zero_copy_only=False)
        ranges, lows = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 4))
        is_row = batch.column(3).to_numpy(zero_copy_only=False) == 1
        place, same, sizes = (np.zeros(len(tree), np.int64) for _ in range(3))
        starts = np.flatnonzero(np.append(True, (tree[1:] != tree[:-1]) | (ranges[1:] != ranges[:-1]) | ~is_row[1:]))
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(tree)).tolist(), strict=True):
            key = (trees.dictionary[int(tree[a])].as_py(), int(ranges[a]))
            if not is_row[a]:
                held, ranks = key, Ranks(*(batch.column(k)[a].as_py() for k in (9, 10, 11)))
                first, size = batch.column(12)[a].as_py(), batch.column(13)[a].as_py()
                a += 1
            if a < b:
                if held != key:
                    raise ValueError(f"no bitmap of range {key}")
                low = lows[a:b].astype(np.int64)
                place[a:b], same[a:b], sizes[a:b] = first + ranks.before(low), ranks.rows(low), size
        rows = np.flatnonzero(is_row)
        kept = batch.take(pa.array(rows))
        yield pa.RecordBatch.from_arrays(
            [*(kept.column(k) for k in (0, 1, 4, 5, 6, 7, 8)), pa.array(place[rows]), pa.array(same[rows]), pa.array(sizes[rows])],
            names=["tree", "range", "low", "key", "leaf", "changed", "n", "place", "same", "size"],
        )


def placed(rows: DataFrame) -> DataFrame:
    """(tree, key, leaf, changed, place, size) of (tree, key, leaf, changed, n): the place of each row among the ``size`` of its tree.

    ``n`` equal rows come out as that many.
    """
    spark, kind = rows.sparkSession, rows.schema["key"].dataType.simpleString()
    parts = rows.select(
        "tree", F.coalesce(F.shiftright("key", BITS), F.lit(NONE)).alias("range"),
        F.coalesce(F.col("key").bitwiseAND(IDS - 1), F.lit(0)).cast("int").alias("low"), "key", "leaf", "changed", "n",
    )
    seen = parts.select("tree", "range", "low", "n").mapInArrow(_bitmaps_of_batches, BITMAP)
    scratch = {name: scratch_path(spark, name) for name in ("bitmaps", "ranked", "placed")}
    merged = stage(seen.groupBy("tree", "range").applyInArrow(_merge, BITMAP), "", scratch["bitmaps"])
    salts = F.when(F.col("range") == NONE, SALTS_OF_NONE).otherwise(SALTS)
    salt = F.conv(F.hex(F.substring("leaf", 1, 1)), 16, 10).cast("int") % salts
    ahead = directory(merged).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    columns = {"tree": "string", "range": "long", "salt": "int", "is_row": "int", "low": "int", "key": kind, "leaf": "binary", "changed": "binary", "n": "long",
               "ids": "binary", "shared": "binary", "numbers": "binary", "first": "long", "size": "long"}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])

    both = shaped(ahead.withColumn("is_row", F.lit(0))).unionAll(shaped(parts.withColumn("salt", salt).withColumn("is_row", F.lit(1))))
    met = both.repartition("tree", "range", "salt").sortWithinPartitions("tree", "range", "salt", "is_row")
    schema = f"tree string, range long, low int, key {kind}, leaf binary, changed binary, n long, place long, same long, size long"
    ranked = stage(met.mapInArrow(_rank, schema), "", scratch["ranked"])
    # Rows that share a key stand in the order of their leaves: cells by the leaf's first bytes, then within a cell.
    ties = ranked.where("same > n").withColumn("cell", F.substring("leaf", 1, 2))
    of_key = ["tree", "range", "low"]
    ahead_of_cell = Window.partitionBy(*of_key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = ties.groupBy(*of_key, "cell").agg(F.sum("n").alias("rows"))
    cells = cells.select(*of_key, "cell", F.coalesce(F.sum("rows").over(ahead_of_cell), F.lit(0)).alias("ahead"))
    in_cell = Window.partitionBy(*of_key, "cell").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    apart = ties.withColumn("within", F.coalesce(F.sum("n").over(in_cell), F.lit(0))).join(cells, [*of_key, "cell"])
    apart = apart.withColumn("place", F.col("place") + F.col("ahead") + F.col("within"))
    names = ["tree", "key", "leaf", "changed", "n", "place", "size"]
    whole = ranked.where("same = n").select(*names).unionAll(apart.select(*names))
    # Copies are written out in two steps, so no array of all of them is built.
    steps = whole.withColumn("step", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})")))
    each = steps.withColumn("copy", F.explode(F.expr(f"sequence(step * {COPIES}, least(n, (step + 1) * {COPIES}) - 1)")))
    each = each.select("tree", "key", "leaf", "changed", (F.col("place") + F.col("copy")).alias("place"), "size")
    found = stage(each, "", scratch["placed"])
    discard(spark, scratch["bitmaps"], scratch["ranked"])
    return found


# --- levels ----------------------------------------------------------------------------


def levels_of(digests: list[bytes], one_block: bool) -> list[list[bytes]]:
    """The levels above an array of hexadecimal digests: to one node, or seven of a tree with further blocks."""
    levels = [digests]
    while len(levels) <= LEVELS and (len(levels[-1]) > 1 or not one_block):
        last = levels[-1]
        levels.append([hashlib.sha256(b"".join(last[i : i + RUN])).hexdigest().encode() for i in range(0, len(last), RUN)])
    return levels


def way_up(levels: list[list[bytes]], place: int) -> list[tuple[bytes, bytes]]:
    """What stands before and after a node and those above it in their runs."""
    path = []
    for level in levels[:-1]:
        run = place - place % RUN
        path.append((b"".join(level[run:place]), b"".join(level[place + 1 : run + RUN])))
        place //= RUN
    return path


def folded(digest: bytes, path: Sequence[tuple[bytes, bytes]]) -> bytes:
    for before, after in path:
        digest = hashlib.sha256(before + digest + after).hexdigest().encode()
    return digest


def _slots(nodes: pa.Table) -> tuple[np.ndarray, list[bytes], bool]:
    """(slot of every row, array of digests by slot, whether the tree is this block alone)."""
    slots = nodes.column("place").to_numpy() % BLOCK
    digests = [b""] * len(slots)
    for slot, digest in zip(slots.tolist(), nodes.column("digest").to_pylist(), strict=True):
        digests[slot] = digest.hex().encode()
    return slots, digests, nodes.column("size")[0].as_py() <= BLOCK


_NODE = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("digest", pa.binary()), ("size", pa.int64())])
_PATH = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))
PATH = "array<struct<before: binary, after: binary>>"


def _reduce(nodes: pa.Table) -> pa.Table:
    """The block's node in the next tree."""
    _, digests, alone = _slots(nodes)
    first = nodes.slice(0, 1).to_pylist()[0]
    top = levels_of(digests, alone)[-1][0]
    node = {"tree": first["tree"], "place": first["place"] // BLOCK, "digest": bytes.fromhex(top.decode()), "size": -(-first["size"] // BLOCK)}
    return pa.Table.from_pylist([node], schema=_NODE)


def _by_block(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {BLOCK}"))


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((tree, root), (tree, block, path)) of ``nodes`` (tree, place, digest, size), digests of 32 bytes.

    The path goes from the node that a block becomes up to the root. Every round is
    over a tree smaller by ``BLOCK``.
    """
    slim = _by_block(nodes.select("tree", "place", "digest", "size"))
    blocks = stage(slim.groupBy("tree", "block").applyInArrow(_reduce, "tree string, place long, digest binary, size long"), "nodes")
    if blocks.where("size > 1").isEmpty():
        nothing = F.array().cast(PATH)
        return blocks.select("tree", F.col("digest").alias("root")), blocks.select("tree", F.col("place").alias("block"), nothing.alias("path"))
    roots, above = climb(blocks)
    paths = _by_block(blocks).groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(_paths, f"tree string, block long, path {PATH}")
    return roots, stage(paths, "paths")


def _paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """The path of every node of a block: its way inside, then the block's own."""
    slots, digests, alone = _slots(nodes)
    levels = levels_of(digests, alone)
    rest = above.column("path")[0].as_py()
    paths = [[{"before": b, "after": a} for b, a in way_up(levels, s)] + rest for s in slots.tolist()]
    return pa.table({"tree": nodes.column("tree"), "block": nodes.column("place"), "path": pa.array(paths, _PATH)})


PROOF = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _prove(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Proof and recomputed root of every leaf of a block."""
    slots, digests, alone = _slots(nodes)
    levels = levels_of(digests, alone)
    up = above.select(["path", "subroot", "root"]).to_pylist()[0]
    rest, root = [(p["before"], p["after"]) for p in up["path"]], up["root"].hex()
    proofs, roots = [], []
    for slot, changed in zip(slots.tolist(), nodes.column("changed").to_pylist(), strict=True):
        path = way_up(levels, slot) + rest
        proofs.append(hashlib.sha256(b"".join(b + a for b, a in path)).hexdigest())
        leaf = digests[slot] if changed is None else changed.hex().encode()
        roots.append(folded(leaf, path).decode())
    columns = {
        "key": nodes.column("key"), "leaf": [digests[s].decode() for s in slots.tolist()], "subroot": [up["subroot"].hex()] * len(slots),
        "root": [root] * len(slots), "proof_sha256": proofs, "folded_root": roots, "verified": [r == root for r in roots],
    }
    return pa.table(columns)


def in_order(names: DataFrame, column: str) -> DataFrame:
    """``names`` with ``place``, by the bytes of ``column``: a range sort, written once, whose parts are counted."""
    ordered = stage(names.orderBy(column).withColumn("id", F.monotonically_increasing_id()), "ordered")
    part, inside = F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND((1 << 33) - 1)
    counts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    # One row a partition of the sort.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("ahead"))
    return ordered.withColumn("part", part).join(starts, "part").withColumn("place", F.col("ahead") + inside).drop("part", "ahead", "id")


def merkle_manifest(docs: DataFrame, leaf: Column, changed: Column, group: str, key: str) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, digests in hexadecimal.

    ``leaf`` gives a row's 32 bytes and ``changed`` what is found there later, null if
    nothing has changed: ``folded_root`` is worked out from it and the siblings, and ``verified``
    tells that it is the root. ``key`` is a whole number.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("")).alias("tree")
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "leaves")
    rows = docs.select(tree, F.col(key).cast("long").alias("key"), leaf.alias("leaf"), changed.alias("changed"))
    counted = stage(rows.groupBy("tree", "key", "leaf", "changed").agg(F.count(F.lit(1)).alias("n")), "", path)
    leaves = placed(counted)
    discard(spark, path)
    roots, above = climb(leaves.withColumnRenamed("leaf", "digest"))
    subroots = in_order(roots, "tree")
    count = roots.count()
    members = subroots.select(F.lit("").alias("tree"), "place", F.col("root").alias("digest"), F.lit(count).cast("long").alias("size"), F.col("tree").alias("member"))
    members = stage(members, "subroots")
    root, top = climb(members)
    # The way from a subroot to the root, one row a group.
    ways = _by_block(members).groupBy("tree", "block").cogroup(top.join(root, "tree").groupBy("tree", "block")).applyInArrow(
        _member_paths, f"tree string, subroot binary, root binary, rest {PATH}"
    )
    whole = above.join(ways, "tree").select("tree", "block", F.concat("path", "rest").alias("path"), "subroot", "root")
    placed_leaves = _by_block(leaves.withColumnRenamed("leaf", "digest"))
    return placed_leaves.groupBy("tree", "block").cogroup(whole.groupBy("tree", "block")).applyInArrow(
        _prove, "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )


def _member_paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
    paths = _paths(nodes, above)
    root = [above.column("root")[0].as_py()] * len(nodes)
    return pa.table({"tree": nodes.column("member"), "subroot": nodes.column("digest"), "root": root, "rest": paths.column("path")})


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, checked against texts that have lost their line ends where the crc32 of the id is even."""
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    cut = (remainder_of_id(F.col("doc_id"), 2) == 0) & F.contains(text, F.lit("\n"))
    changed = F.when(cut, leaf_of([*values, F.replace(text, F.lit("\n"), F.lit(""))]))
    return merkle_manifest(docs, leaf_of([*values, text]), changed, "source", "doc_id").withColumnRenamed("key", "doc_id")
