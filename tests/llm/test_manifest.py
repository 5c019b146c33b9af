import hashlib
import random
import zlib

import numpy as np
import pytest
import tables

from foralytics.llm.merkle_manifest import BLOCK, IDS, Ranks, _bitmap, in_order, levels_of, op11_merkle_manifest, pack, unpack


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tag(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(digests):
    """(root, [siblings before and after of each leaf, level by level])."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for leaf, i in enumerate(at):
            run = i - i % 3
            paths[leaf].append(("".join(digests[run:i]), "".join(digests[i + 1 : run + 3])))
        digests = [sha(*digests[i : i + 3]) for i in range(0, len(digests), 3)]
        at = [i // 3 for i in at]
    return digests[0], paths


def plain_manifest(docs):
    """Rows of the contract for (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for doc_id, text, lang, source, n_chars in docs:
        head = [tag(doc_id), tag(source), tag(lang), tag(n_chars)]
        leaf = changed = sha(*head, tag(text))
        if zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 2 == 0 and text is not None:
            changed = sha(*head, tag(text.replace("\n", "")))
        groups.setdefault(source, []).append((doc_id, leaf, changed))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(plain_tree([leaf for _, leaf, _ in groups[name]]))
    if not trees:
        return []
    root, tops = plain_tree([t[0] for t in trees])
    out = []
    for name, (subroot, paths), top in zip(names, trees, tops, strict=True):
        for (doc_id, leaf, changed), path in zip(groups[name], paths, strict=True):
            digest = changed
            for before, after in path + top:
                digest = sha(before, digest, after)
            proof = sha(*[b + a for b, a in path + top])
            out.append((doc_id, leaf, subroot, root, proof, digest, digest == root))
    return sorted(out, key=repr)


def answer(spark, folder, docs, extra=False):
    folder = tables.save(tables.documents(spark, docs, extra) if docs else tables.empty(spark), folder)
    docs = [(*r, len(r[1] or "")) for r in docs]
    found = op11_merkle_manifest(spark, folder)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return tables.rows(found), plain_manifest(docs)


def test_awkward_rows(spark, tmp_path):
    docs = tables.awkward_rows()
    # Rows without an id, rows of one id and equal rows, ids at both ends, sources that order by bytes.
    docs += [(None, f"t{k % 5}\n", "en", "a") for k in range(17)] + [(7, f"line\n{k}", "en", "c") for k in range(11)]
    docs += [(-(1 << 63), "least", "en", "b"), ((1 << 63) - 1, "most\n", "en", "b"), (1 << 40, "far\n", None, "b"), (-5, "x\ny", "en", "é"), (6, "q", "en", "Z"), (6, "", "en", "")]
    found, wanted = answer(spark, tmp_path, docs, extra=True)
    assert found == wanted
    assert 0 < sum(not r[-1] for r in wanted) < len(wanted)


@pytest.mark.parametrize("docs", [[], [(1, "one\n", "en", "a")], [(1, "x", None, None)] * 5])
def test_few_rows(spark, tmp_path, docs):
    found, wanted = answer(spark, tmp_path, docs)
    assert found == wanted


def test_many_blocks_and_ranges(spark, tmp_path):
    random.seed(2)
    ids = random.sample(range(-3 * IDS, 9 * IDS), 3 * BLOCK + 5) + [random.getrandbits(60) for _ in range(50)]
    docs = [(i, f"text {i % 97}\n", "en", "hot") for i in ids] + [(i, "x", "en", f"s{i % 30}") for i in range(BLOCK)]
    found, wanted = answer(spark, tmp_path, docs)
    assert found == wanted


def test_bitmaps_and_ranks():
    random.seed(4)
    for count in (0, 1, 5, IDS // 16 - 1, IDS // 16, 1000, IDS):
        lows = np.array(sorted(random.sample(range(IDS), count)), np.int64)
        assert unpack(pack(lows)).tolist() == lows.tolist()
        numbers = np.array([random.choice([1, 1, 1, 4]) for _ in lows], np.int64)
        made = _bitmap(lows, numbers)
        ranks = Ranks(made["ids"], made["shared"], made["numbers"])
        assert ranks.before(lows).tolist() == (np.cumsum(numbers) - numbers).tolist()
        assert ranks.rows(lows).tolist() == numbers.tolist()
        assert made["total"] == numbers.sum()


def test_levels_of_a_block():
    digests = [sha(str(i)).encode() for i in range(10)]
    assert levels_of(digests, True)[-1] == [plain_tree([d.decode() for d in digests])[0].encode()]
    assert [len(level) for level in levels_of(digests[:1], False)] == [1] * 8
    assert [len(level) for level in levels_of(digests[:1], True)] == [1]


def test_order_of_groups(spark):
    names = [f"={i:05d}" for i in range(3000)] + ["", "=", "=é"]
    random.seed(1)
    random.shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "tree string").repartition(7)
    found = {r["tree"]: r["place"] for r in in_order(df, "tree").collect()}
    assert [n for n, _ in sorted(found.items(), key=lambda x: x[1])] == sorted(names, key=str.encode)
    assert sorted(found.values()) == list(range(len(names)))
