"""Jaccard join, substring removal and decontamination against plain versions."""

import random

import brute
import numpy as np
import pytest
from tables import awkward_rows, documents, empty, rows, save

from foralytics.llm.components import components
from foralytics.llm.decontamination import Item, drop_leaks, find_leaks, myers
from foralytics.llm.jaccard_join import jaccard_components, keep_one_of_each, part_keys
from foralytics.llm.queries import QUERIES
from foralytics.llm.signature_tree import bitmaps, plausible_pairs, spanning
from foralytics.llm.substrings import remove_repeats
from foralytics.llm.words import mixed


def near_copies(seed, families=6, members=12):
    """Families of texts with a few words changed, and lone ones."""
    random.seed(seed)
    out = []
    for family in range(families):
        text = [f"w{random.randint(0, 4000)}" for _ in range(random.choice((6, 12, 40, 90)))]
        for _ in range(members):
            copy = list(text)
            for _ in range(random.randint(0, max(1, len(text) // 14))):
                copy[random.randrange(len(copy))] = f"x{random.randint(0, 10**6)}"
            out.append(" ".join(copy))
    random.shuffle(out)
    return [(i, t, "en", f"s{i % 3}") for i, t in enumerate(out)]


@pytest.mark.parametrize("n, num, den, block", [(3, 90, 100, 1024), (5, 4, 5, 1024), (1, 3, 5, 4), (2, 4, 5, 3)])
def test_components_equal_all_pairs(spark, n, num, den, block):
    table = near_copies(n * 7 + block)
    got = jaccard_components(documents(spark, table), n, num, den, block=block)
    want = brute.linked([(r[0], r[1]) for r in table], n, num, den)
    assert rows(got.select("doc_id", "n_shingles", "component_id")) == sorted(want, key=repr)


def test_jaccard_query_on_awkward_rows(spark, tmp_path):
    docs = documents(spark, extra=True)
    got = rows(QUERIES["op2_jaccard_join"](spark, save(docs, tmp_path)))
    assert got == sorted(brute.linked([(r[0], r[1]) for r in awkward_rows()], 3, 90, 100), key=repr)


def test_one_of_each_stays(spark):
    kept = keep_one_of_each(documents(spark, extra=True)).collect()
    assert sorted(r["doc_id"] for r in kept) == [-2, 1, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14]
    assert "component_id" in kept[0].asDict() and "__text_key" not in kept[0].asDict()


def test_alike_sets_share_a_key():
    random_numbers = np.random.default_rng(4)
    for num, den in ((9, 10), (4, 5), (3, 5)):
        for size in (1, 2, 5, 9, 10, 11, 17, 60, 333):
            a = mixed(random_numbers.integers(0, 2**62, size).astype(np.uint64))
            for _ in range(15):
                gone = int(random_numbers.integers(0, size // 3 + 1))
                new = int(random_numbers.integers(0, size // 3 + 1))
                b = np.concatenate([a[gone:], mixed(random_numbers.integers(0, 2**62, new).astype(np.uint64))])
                common, union = size - gone, size + new
                if den * common < num * union or not gone + new or not len(b):
                    continue
                keys, owner = part_keys(np.concatenate([np.sort(a), np.sort(b)]), np.array([size, len(b)]), num, den)
                assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_trees_lose_no_pair():
    random_numbers = np.random.default_rng(5)
    sets = [set(random_numbers.integers(0, 300, random_numbers.integers(1, 60)).tolist()) for _ in range(60)]
    sets += [s ^ {int(random_numbers.integers(0, 300))} for s in sets if len(s) > 2]
    tokens = [mixed(np.array(sorted(s), np.uint64)) for s in sets]
    sizes = np.array([len(s) for s in sets])
    bits = bitmaps(np.concatenate(tokens), np.repeat(np.arange(len(sets)), sizes), len(sets))
    i, j = plausible_pairs(sizes, bits, np.arange(len(sets)), 4, 5)
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    alike = {(a, b) for b in range(len(sets)) for a in range(b) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert alike <= found and len(found) < len(sets) ** 2 / 4
    a, b = spanning(len(sets), i, j)
    assert len(a) < len(sets)
    assert not plausible_pairs(sizes, bits, np.zeros(len(sets), int), 4, 5)[0].size


def test_chains_and_hubs_become_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(200, 230)] + [(5, 5), (None, 3)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{k: 100 for k in range(200, 230)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def removed(df):
    from pyspark.sql import functions as F

    return rows(df.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)))


def shared_passages(seed):
    random.seed(seed)
    passages = [[f"p{random.randint(0, 50)}" for _ in range(random.randint(4, 20))] for _ in range(4)]
    out = []
    for i in range(60):
        text = [f"w{random.randint(0, 500)}" for _ in range(random.randint(0, 30))]
        for _ in range(random.randint(0, 2)):
            at = random.randint(0, len(text))
            text[at:at] = random.choice(passages)
        out.append((i, " ".join(text), "en", "s"))
    return out


@pytest.mark.parametrize("length, core, hot", [(5, 2, 10**6), (5, 5, 2), (3, 1, 1), (8, 3, 5)])
def test_removal_equals_all_windows(spark, length, core, hot):
    table = shared_passages(length * 10 + core)
    want = brute.removed([(r[0], r[1]) for r in table], length)
    got = removed(remove_repeats(documents(spark, table), length, core, hot))
    assert got == sorted(((i, *v) for (i, _), v in want.items()), key=repr)


def test_removal_query_on_awkward_rows(spark, tmp_path):
    docs = documents(spark, extra=True)
    want = brute.removed([(r[0], r[1]) for r in awkward_rows()])
    got = rows(QUERIES["op4_substrings"](spark, save(docs, tmp_path)))
    assert got == sorted(((r[0], *want[r[0], r[1]]) for r in awkward_rows()), key=repr)


def plain_distance(pattern, text):
    """(distance, end) of the best occurrence, by dynamic programming."""
    last = list(range(len(pattern) + 1))
    best = (last[-1], 0)
    for end, c in enumerate(text, 1):
        now = [0]
        for i, p in enumerate(pattern, 1):
            now.append(min(last[i] + 1, now[-1] + 1, last[i - 1] + (p != c)))
        last = now
        best = min(best, (last[-1], end))
    return best


def test_bit_parallel_distance():
    random.seed(6)
    for _ in range(200):
        pattern = "".join(random.choices("abcd", k=random.randint(1, 90)))
        text = "".join(random.choices("abcd", k=random.randint(0, 60)))
        masks = {}
        for i, c in enumerate(pattern):
            masks[c] = masks.get(c, 0) | 1 << i
        distance, end = plain_distance(pattern, text)
        got = myers(masks, len(pattern), text, len(pattern))
        assert (got or (len(pattern), 0))[0] == distance and (not got or distance == len(pattern) or got[1] == end)


def edited(text, n):
    text = list(text)
    for _ in range(n):
        at = random.randrange(len(text))
        text[at : at + random.randint(0, 1)] = random.choice(["", "x", "yz"])[:1]
    return "".join(text)


def test_leaks_equal_all_comparisons(spark):
    random.seed(7)
    items = [(k, " ".join(f"t{random.randint(0, 9)}{'abcdef'[random.randint(0, 5)] * 3}" for _ in range(random.randint(2, 30)))) for k in range(12)]
    items += [(20, None), (21, "  "), (22, "short one"), (23, items[0][1])]
    docs = []
    for i in range(60):
        text = " ".join(f"d{random.randint(0, 99)}" for _ in range(20))
        if i % 3 == 0:
            chosen = random.choice(items[:12])[1]
            text += " " + edited(chosen, random.randint(0, 12)) + " end."
        docs.append((i, text, "en", "s"))
    docs += [(60, None, None, None), (61, "", None, None), (62, "a SHORT, one b", None, None), (62, "shorten one", None, None)]
    got = {(r[0], r[1]): r[2] for r in rows(find_leaks(documents(spark, docs, extra=True), spark.createDataFrame(items, "item_id long, text string")))}
    want = {}
    plain = lambda t: " " + " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split()) + " "
    for k, item in items:
        if len(plain(item)) <= 2:
            continue
        one = Item(k, plain(item), 0.08)
        for i, text, *_ in docs:
            distance, _ = plain_distance(one.text, plain(text))
            if distance <= one.edits:
                want[i, k] = distance
    assert got == want and any(want.values()) and (62, 22) in want
    kept = drop_leaks(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([r[0] for r in docs if r[0] not in {i for i, _ in want}] + [62])


def test_no_documents_and_no_items(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(documents(spark), none).collect() == []
    assert drop_leaks(documents(spark), none).count() == len(awkward_rows())
    assert jaccard_components(empty(spark)).collect() == []
    assert remove_repeats(empty(spark)).collect() == []
    some = spark.createDataFrame([(1, "an item of some length that is nowhere")], "item_id long, text string")
    assert find_leaks(empty(spark), some).collect() == []


def test_items_of_one_id_that_begin_alike_are_all_found(spark):
    random.seed(9)
    begin, one, two = (" ".join(f"w{random.randint(0, 999):03}" for _ in range(20)) for _ in range(3))
    docs = documents(spark, [(1, f"before {begin} {one} after", "en", "s"), (2, f"before {begin} {two} after", "en", "s")])
    for item_id in (None, 7):
        items = spark.createDataFrame([(item_id, f"{begin} {one}"), (item_id, f"{begin} {two}")], "item_id long, text string")
        assert rows(find_leaks(docs, items).select("doc_id", "item_id", "edits")) == [(1, item_id, 0), (2, item_id, 0)]
