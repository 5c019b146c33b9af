"""Join of documents whose word n-gram sets are alike, through signature trees.

1. Every text becomes the set of its distinct n-grams (64-bit hashes), of which
   the size, a digest and a bitmap are kept. Equal sets form a class.
2. Partitions. Two sets of Jaccard similarity t or more differ in a known number
   of tokens at most, which their size class bounds. Tokens are dealt, by hash,
   into one part more than that; so some part is equal in both. The hash of each
   part is a key, and sets with a common key share a tree. No pair is missed, and
   a common passage or word makes no large tree, as a part takes tokens from all
   over the text. A part that is empty or holds one token says little, as a common
   passage may have put it there. There are a quarter more parts than needed, so that
   equal parts of more tokens are left over; keys of the others are sent only for the
   few sets whose parts of more tokens might all differ.
3. Keys travel packed with the id of their document, many to a row, to the bucket of
   their hash; a task sends a class once. A bucket lists the documents of every key
   that has several, equal lists once, and the documents give way to their classes.
4. Trees over these lists give the pairs that size and bitmap bounds leave. The
   first pass sends only a spanning forest of them, so a group of many copies
   costs as many pairs as it has sets. The pairs are verified on the whole sets.
5. The second pass takes the lists whose sets are not yet all joined and sends
   every pair that the bounds leave between different components. After it, every
   alike pair is joined. Lists longer than ``block`` are cut into blocks; the
   smallest class goes with every block in the first pass, and in the second the
   sets outside the main component do.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foralytics.llm.common import row_key, shuffle_partitions, slices, small_batches, table
from foralytics.llm.components import components
from foralytics.llm.signature_tree import bitmaps, plausible_pairs, spanning
from foralytics.llm.words import from_planes, mixed, planes, run_hashes, word_hashes
from foralytics.scratch import discard, scratch_path, stage

# Sets of one size class differ in size by half at most.
RATIO = 1.5
BLOCK = 1024
# Keys that a task gathers before it sends them, packed by bucket.
SENT_KEYS = 800_000
KEY_BYTES = 6
# Classes that a task remembers to have sent.
SEEN = 200_000
# Partners that are compared with one set in one task.
PARTNERS = 512
# Documents of a list that one row holds.
ROW = 4096
TEXT_BYTES = 4 << 20


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, tokens of each text): distinct word n-grams, sorted within each text.

    A-Z are folded. A text of fewer words has one token, its whole sequence; null,
    empty and blank texts have none.
    """
    words, counts = word_hashes(texts, lower=True)
    ends = np.cumsum(counts)
    starts = ends - counts
    tokens = np.zeros(len(words), np.uint64)
    runs = run_hashes(words, n)
    tokens[: len(runs)] = runs
    keep = np.zeros(len(words), bool)
    for i in np.flatnonzero(counts > 0).tolist():
        a, b, k = starts[i], ends[i], int(counts[i])
        if k < n:
            tokens[a] = mixed(run_hashes(words[a:b], k) + np.uint64(k))[0]
            keep[a] = True
        else:
            part = tokens[a : b - n + 1]
            part.sort()
            keep[a : b - n + 1] = np.concatenate([[True], part[1:] != part[:-1]])
    text_of = np.repeat(np.arange(len(counts)), counts)
    return tokens[keep], np.bincount(text_of[keep], minlength=len(counts)).astype(np.int64)


def digests(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Class of each set: equal for equal sets, 64 bits."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return mixed(_sums(mixed(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)), owner, len(sizes)) + sizes.astype(np.uint64)).view(np.int64)


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2^64, in two halves that are exact in doubles."""
    low = np.bincount(owner, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    high = np.bincount(owner, (values >> np.uint64(32)).astype(np.float64), n)
    # Halves of 2^20 tokens stay below 2^52.
    return low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))


def size_classes(most: int) -> list[int]:
    """Lower ends of the size classes that hold sizes up to ``most``, and one end more."""
    ends = [1]
    while ends[-1] <= most:
        ends.append(max(ends[-1] + 1, int(ends[-1] * RATIO)))
    return ends


def part_keys(tokens: np.ndarray, sizes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, set of each key); sets alike by ``num`` / ``den`` and not equal share one."""
    ends = np.array(size_classes(math.ceil(int(sizes.max(initial=1)) * den / num) + 1))
    own = np.searchsorted(ends, sizes, "right") - 1
    keys, owners = [], []
    step = 0
    while True:
        # A set goes into its class and into those above that its partners may be in.
        cls = np.minimum(own + step, len(ends) - 2)
        chosen = np.flatnonzero((sizes > 0) & (own + step == cls) & ((step == 0) | (sizes * den >= num * ends[cls])))
        if not len(chosen):
            return np.concatenate(keys) if keys else np.zeros(0, np.uint64), np.concatenate(owners) if owners else np.zeros(0, np.int64)
        step += 1
        top = ends[cls[chosen] + 1] - 1
        differ = (den - num) * 2 * top // (den + num)
        some = differ > 0  # else only equal sets are alike
        chosen, top, differ = chosen[some], top[some], differ[some]
        if not len(chosen):
            continue
        parts = differ + 1 + 1 + differ // 4
        first = np.cumsum(parts) - parts
        total = int(parts.sum())
        place = np.full(len(sizes), -1)
        place[chosen] = np.arange(len(chosen))
        owner = np.repeat(place, sizes)
        mine = owner >= 0
        token, owner = tokens[mine], owner[mine]
        seed = cls[chosen].astype(np.uint64)
        salted = mixed(token ^ mixed(seed + np.uint64(77))[owner])
        part = ((salted >> np.uint64(32)) * parts[owner].astype(np.uint64)) >> np.uint64(32)
        slot = first[owner] + part.astype(np.int64)
        sums = _sums(mixed(salted), slot, total)
        held = np.bincount(slot, minlength=total)
        set_of = np.repeat(np.arange(len(chosen)), parts)
        number = np.arange(total) - first[set_of]
        a = sizes[chosen]
        # At most so many tokens, and parts, differ from a partner's.
        worst = (den - num) * (a + np.minimum(a * den // num, top)) // (den + num)
        needed = held > 1
        for few in (1, 0):
            # A part that is equal in both is as full in both; some equal one is fuller unless this holds.
            fuller = np.bincount(set_of[held > few], minlength=len(chosen))
            needed |= (held == few) & (worst >= fuller)[set_of]
        tag = mixed((seed[set_of] << np.uint64(32)) + number.astype(np.uint64))
        keys.append(mixed(sums + tag)[needed])
        owners.append(chosen[set_of[needed]])


def _batch(schema: list[tuple[str, pa.Array]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x for _, x in schema], names=[k for k, _ in schema])


def _describe(n: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            tokens, sizes = shingle_sets(batch.column(2), n)
            bits = bitmaps(tokens, np.repeat(np.arange(len(sizes)), sizes), len(sizes))
            yield _batch(
                [
                    ("doc_id", batch.column(0)), ("text_key", batch.column(1)), ("n_shingles", pa.array(sizes)),
                    ("cls", pa.array(digests(tokens, sizes))), ("bits", pa.array([x.tobytes() for x in bits], pa.binary())),
                ]
            )

    return describe


def _send_keys(n: int, num: int, den: int, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def packed() -> pa.RecordBatch:
            keys, owners = (np.concatenate(x) for x in zip(*held, strict=True))
            # In order, the first bytes of the keys hardly differ and pack well.
            order = np.argsort(keys)
            keys, owners = keys[order], owners[order]
            bucket = (keys >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            edges = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True))
            return _batch(
                [
                    ("bucket", pa.array(bucket[cuts].astype(np.int32))),
                    ("keys", pa.array([planes(keys[a:b] >> np.uint64(64 - 8 * KEY_BYTES), KEY_BYTES) for a, b in edges], pa.binary())),
                    ("owners", pa.array([planes(owners[a:b], 8) for a, b in edges], pa.binary())),
                ]
            )

        for batch in slices(batches, "text", TEXT_BYTES):
            tokens, sizes = shingle_sets(batch.column(1), n)
            cls = digests(tokens, sizes)
            owners = batch.column(0).to_numpy(zero_copy_only=False)
            # A class is sent once as long as it is remembered, however many copies it has.
            fresh = np.zeros(len(cls), bool)
            for i, c in enumerate(cls.tolist()):
                fresh[i] = c not in seen
                seen.add(c)
            if len(seen) > SEEN:
                # Sent again, a class is only listed again.
                seen.clear()
            mine = np.repeat(fresh, sizes)
            keys, owner = part_keys(tokens[mine], sizes[fresh], num, den)
            if len(keys):
                held.append((keys, owners[fresh][owner]))
                count += len(keys)
            if count > SENT_KEYS:
                yield packed()
                held, count = [], 0
        if held:
            yield packed()

    return send


def _list_owners(rows: pa.Table) -> pa.Table:
    """The packed keys of a bucket -> the lists of documents that share a key, ``ROW`` to a row."""
    keys = np.concatenate([from_planes(x, KEY_BYTES) for x in rows["keys"].to_pylist()])
    owners = np.concatenate([from_planes(x, 8) for x in rows["owners"].to_pylist()]).view(np.int64)
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
    keys, owners = keys[new], owners[new]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    digest = mixed(np.add.reduceat(mixed(owners.view(np.uint64)), starts) + sizes.astype(np.uint64)).view(np.int64)
    several = np.flatnonzero(sizes > 1)
    several = several[np.unique(digest[several], return_index=True)[1]]
    out = []
    for s in several.tolist():
        members = owners[starts[s] : starts[s] + sizes[s]]
        out.extend((int(digest[s]), k, members[k : k + ROW]) for k in range(0, len(members), ROW))
    return pa.table(
        {
            "list": pa.array([x[0] for x in out], pa.int64()), "part": pa.array([x[1] for x in out], pa.int64()),
            "members": pa.array([x[2] for x in out], pa.list_(pa.int64())),
        }
    )


LISTS = "list long, part long, members array<long>"


def _traverse(num: int, den: int, forest: bool):
    """Rows (list, block, cls, n, bits, label, own), a block together -> pairs of classes."""

    def judged(rows: pa.Table) -> pa.RecordBatch:
        cls = rows["cls"].to_numpy()
        first = np.unique(cls, return_index=True)[1]
        rows = rows.take(pa.array(first)).combine_chunks()
        cls = rows["cls"].to_numpy()
        bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint64).reshape(len(cls), -1)
        groups = np.arange(len(cls)) if forest else np.unique(rows["label"].to_numpy(), return_inverse=True)[1].ravel()
        i, j = plausible_pairs(rows["n"].to_numpy(), bits, groups, num, den)
        if forest:
            i, j = spanning(len(cls), i, j)
        else:
            own = rows["own"].to_numpy(zero_copy_only=False)
            i, j = i[own[i] | own[j]], j[own[i] | own[j]]
        return _batch([("a", pa.array(np.minimum(cls[i], cls[j]))), ("b", pa.array(np.maximum(cls[i], cls[j])))])

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, blocks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            new = np.concatenate([[False], (lists[1:] != lists[:-1]) | (blocks[1:] != blocks[:-1])])
            edges = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                piece = batch.slice(a, b - a)
                key = (piece.column(0)[0].as_py(), piece.column(1)[0].as_py())
                if held and key != (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()):
                    yield judged(pa.Table.from_batches(held))
                    held = []
                held.append(piece)
        if held:
            yield judged(pa.Table.from_batches(held))

    return traverse


def _full_sets(n: int):
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            tokens, sizes = shingle_sets(batch.column(1), n)
            ends = np.cumsum(sizes)
            raw = [tokens[b - k : b].tobytes() for b, k in zip(ends.tolist(), sizes.tolist(), strict=True)]
            yield _batch([("cls", batch.column(0)), ("tokens", pa.array(raw, pa.binary()))])

    return full


def _verify(num: int, den: int):
    """Rows (a, salt, b, tokens), first a's own set with b null -> the pairs that are alike."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, mine = None, np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            for a, _, b, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = np.frombuffer(raw, np.uint64)
                if b is None:
                    hub, mine = a, tokens
                    continue
                assert a == hub
                both = len(mine) + len(tokens)
                common = both - len(np.unique(np.concatenate([mine, tokens])))
                if den * common >= num * (both - common):
                    out.append((a, b))
            yield _batch([("a", pa.array([x for x, _ in out], pa.int64())), ("b", pa.array([y for _, y in out], pa.int64()))])

    return verify


def _sets_of(classes: DataFrame, reps: DataFrame, docs: DataFrame, n: int, path: str) -> DataFrame:
    """(cls, tokens) of the ``classes``, from one document of each; written, as it is read several times.

    The document of a class is found by one key, which also tells its repeated rows, so texts are shuffled once.
    """
    row = row_key(F.col("rep.doc_id"), F.col("rep.text_key"))
    wanted = classes.join(reps.select("cls", "rep"), "cls").select("cls", row.alias("row"))
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text_key")).alias("row"), "text")
    texts = keyed.join(wanted, "row").dropDuplicates(["row"])
    with small_batches(docs.sparkSession):
        return stage(texts.select("cls", "text").mapInArrow(_full_sets(n), "cls long, tokens binary"), "", path)


def _alike(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of the ``pairs`` of classes those whose whole sets are alike."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("salts"))
    salted = pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    partners = salted.join(sets.withColumnRenamed("cls", "b"), "b").select("a", "salt", "b", "tokens")
    hubs = salts.join(sets.withColumnRenamed("cls", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "tokens"
    )
    rows = partners.unionByName(hubs).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.mapInArrow(_verify(num, den), "a long, b long")


def jaccard_components(
    docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, buckets: int | None = None, block: int = BLOCK
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Documents are linked when ``den`` times their common n-grams is at least
    ``num`` times all; ``component_id`` is the smallest ``doc_id`` that links
    reach. Texts without words are linked with nothing. Rows of equal text are in
    one class, repeated rows too. A null ``doc_id`` is never the smallest one
    unless it stands alone. Other columns are not looked at.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * shuffle_partitions(spark)
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    at = {name: scratch_path(spark, name) for name in ("lists", "listed", "tried", "links", "sets", "open", "more", "missing", "more-links", "more-sets")}
    with small_batches(spark):
        described = stage(
            docs.mapInArrow(_describe(n), "doc_id long, text_key long, n_shingles long, cls long, bits binary"), "described"
        )
    reps = described.where("n_shingles > 0").groupBy("cls").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")).alias("rep"),
        F.first("n_shingles").alias("n"), F.first("bits").alias("bits"),
    )
    reps = stage(reps, "classes")
    owner = F.coalesce("doc_id", "text_key").alias("owner")
    with small_batches(spark):
        lists = stage(
            docs.select(owner, "text").mapInArrow(_send_keys(n, num, den, buckets), "bucket int, keys binary, owners binary")
            .groupBy("bucket").applyInArrow(_list_owners, LISTS).dropDuplicates(["list", "part"]),
            "", at["lists"],
        )
    members = lists.select("list", F.explode("members").alias("owner"))
    classes = described.where("n_shingles > 0").select(owner, "cls")
    listed = members.join(classes, "owner").select("list", "cls").distinct()
    cuts = listed.groupBy("list").agg(
        F.min("cls").alias("least"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"), F.count(F.lit(1)).alias("size")
    ).where("size > 1")
    own = stage(
        listed.join(cuts.drop("size"), "list").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")), "", at["listed"]
    )
    discard(spark, at["lists"])
    home_of_least = F.pmod(F.xxhash64("least"), F.col("blocks")).cast("int")
    with_least = own.select("list", "block", "cls").unionByName(
        own.where(F.col("block") != home_of_least).select("list", "block", F.col("least").alias("cls")).distinct()
    )

    def pairs_of(entries: DataFrame, forest: bool) -> DataFrame:
        rows = entries.join(reps.select("cls", "n", "bits"), "cls").select("list", "block", "cls", "n", "bits", "label", "own")
        return (
            rows.repartition("list", "block").sortWithinPartitions("list", "block")
            .mapInArrow(_traverse(num, den, forest), "a long, b long").distinct()
        )

    marked = with_least.select("*", F.lit(0).cast("long").alias("label"), F.lit(True).alias("own"))
    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()

    tried = stage(pairs_of(marked, True), "", at["tried"])
    sets = _sets_of(ends(tried), reps, docs, n, at["sets"])
    links = stage(_alike(tried, sets, num, den), "", at["links"])
    labels = components(links).withColumnsRenamed({"node": "cls", "component": "label"})
    known = own.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    # Lists with several components: what is outside the one of the least class goes to every block.
    mixed_lists = known.groupBy("list").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min_by("label", "cls").alias("main")
    ).where("low <> high").select("list", "main")
    open_rows = stage(known.join(mixed_lists, "list"), "", at["open"])
    discard(spark, at["listed"])
    elsewhere = (
        open_rows.where("blocks > 1 and label <> main")
        .select("list", F.col("block").alias("home"), "blocks", "cls", "label")
        .select("list", "home", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "cls", "label")
        .where("block <> home")
    )
    entries = open_rows.select("list", "block", "cls", "label", F.lit(True).alias("own")).unionByName(
        elsewhere.select("list", "block", "cls", "label", F.lit(False).alias("own"))
    )
    more = stage(pairs_of(entries, False).join(tried, ["a", "b"], "left_anti"), "", at["more"])
    discard(spark, at["open"], at["tried"])
    if not more.isEmpty():
        # Nearly all of these sets are there from the first pass.
        missing = stage(ends(more).join(sets, "cls", "left_anti"), "", at["missing"])
        if not missing.isEmpty():
            sets = sets.unionAll(_sets_of(missing, reps, docs, n, at["more-sets"]))
        links = stage(links.unionByName(_alike(more, sets, num, den)), "", at["more-links"])
        labels = components(links).withColumnsRenamed({"node": "cls", "component": "label"})
    discard(spark, *(at[name] for name in ("sets", "more-sets", "more", "missing", "links", "more-links")))
    first = reps.select("cls", F.col("rep.doc_id").alias("first_id"))
    joined = first.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    least = joined.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_class = joined.join(least, "label").select("cls", "component_id")
    rows = described.select("doc_id", "text_key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("cls")).alias("cls"))
    return rows.join(of_class, "cls", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Rows of ``docs`` that are the smallest of their component; all columns stay.

    Rows equal in id and text are one document, of which any row stays, also where other columns
    differ. Texts without words all stay. ``docs`` must have no column ``__row``.
    """
    found = jaccard_components(docs, n, num, den)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        row_key(F.col("doc_id"), F.col("text_key")).alias("__row")
    ).distinct()
    keyed = docs.withColumn("__row", row_key(F.col("doc_id"), F.xxhash64("text")))
    return keyed.join(kept, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets are alike by 0.9."""
    docs = table(spark, sf_dir, "documents")
    return jaccard_components(docs, n=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")
