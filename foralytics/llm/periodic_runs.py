"""Runs of repeated words inside a text, from Lyndon roots.

A run is a stretch of words with smallest period q that no neighbouring word extends.
By the runs theorem the longest Lyndon word at some place of each period of a run is
exactly its root, for the order of the words or for the opposite one. The first phase
of Baier's suffix sorter gathers suffixes that begin with the same longest Lyndon word
in one group, so it yields these words under both orders without sorting a suffix:
groups are taken from the highest down, and every group lengthens the words of the
nearest places before its members whose groups are still to come. Equal groups
a word's length apart are copies of a root; their chain is extended to both sides by
the longest common extension of the text with itself, one period on.

A run of ``exponent`` periods holds each of its words ``exponent`` times. So before that,
whole batches of texts are cut at the words that are rarer in their part, again and
again; what falls out cannot touch a run, and the cut parts are grouped one by one.

Runs are local to a text, so nothing is shuffled, and a hot key or copies change nothing.
Null and empty texts, and texts without a word, have no run; a text of one repeated
word is one run; equal rows get equal results; an empty table gives an empty one.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foralytics.llm.common import WORD, slices, table
from foralytics.llm.words import word_codes

# A run is reported from so many periods and so many words on.
EXPONENT = 4
LEAST = 6
# Rounds of cutting before the grouping; it needs none of them to be right.
ROUNDS = 12
TEXT_BYTES = 2 << 20

Run = tuple[int, int, int]
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_groups(word: list[int]) -> tuple[list[int], list[int]]:
    """(length of the longest Lyndon word, its group) at every place, in the order of the numbers.

    Places of one group begin with the same longest Lyndon word. Places whose group
    has been taken leave a linked list, so the nearest one before a place whose group
    is still to come is its neighbour there.
    """
    n = len(word)
    firsts: dict[int, list[int]] = {}
    for i, w in enumerate(word):
        firsts.setdefault(w, []).append(i)
    members, sizes, group = [], [], [0] * n
    for g, w in enumerate(sorted(firsts)):
        members.append(firsts[w])
        sizes.append(1)
        for i in firsts[w]:
            group[i] = g
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    top = len(members) - 1
    before, after = list(range(-1, n)), list(range(1, n + 2))
    while top >= 0:
        length = sizes[top]
        followed: dict[int, int] = {}
        for i in members[top]:
            if group[i] == top:
                a, b = before[i], after[i]
                after[a], before[b] = b, a
                if a >= 0:
                    followed[a] = followed.get(a, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for i, times in followed.items():
            moves.setdefault((times, group[i]), []).append(i)
        # Words that go on with more copies are higher, and all are right above the shorter word.
        for times, old in sorted(moves, reverse=True) if len(moves) > 1 else moves:
            new, moved = len(sizes), moves[times, old]
            sizes.append(sizes[old] + times * length)
            members.append(moved)
            for i in moved:
                group[i] = new
            # ``above`` of the highest group names no group; it is never followed.
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            below[up] = new
        top = below[top]
    return [sizes[g] for g in group], group


def common_extension(codes: np.ndarray, i: int, j: int, limit: int) -> int:
    """How many words from ``i`` on equal those from ``j`` on, up to ``limit``; looked at in doubling steps."""
    done, step = 0, 16
    while done < limit:
        step = min(step, limit - done)
        unlike = np.flatnonzero(codes[i + done : i + done + step] != codes[j + done : j + done + step])
        if len(unlike):
            return done + int(unlike[0])
        done, step = done + step, step * 2
    return done


def runs_of(codes: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> list[Run]:
    """(start, length, period) of the runs of ``exponent`` periods and ``least`` words or more, by start and period."""
    n, back = len(codes), codes[::-1]
    found = set()
    for order in (codes, -codes):
        lengths, groups = (np.array(x, np.int64) for x in lyndon_groups(order.tolist()))
        at = np.arange(n)
        # A run of so many periods holds one root less, whole and in a chain.
        for k in range(1, exponent - 1):
            at = at[at + k * lengths[at] < n]
            at = at[groups[at + k * lengths[at]] == groups[at]]
        first = at - lengths[at]
        heads = at[(first < 0) | (groups[first] != groups[at])]
        for i in heads.tolist():
            q = int(lengths[i])
            right = common_extension(codes, i, i + q, n - i - q)
            # To the left, the text is read backwards.
            left = common_extension(back, n - i, n - i - q, i)
            if left + right + q >= max(least, exponent * q):
                found.add((i - left, left + right + q, q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def periodic_parts(codes: np.ndarray, text_of: np.ndarray, exponent: int, least: int) -> list[tuple[int, int]]:
    """(first, end) of the parts of the texts outside which no run has a word."""
    place, part = np.arange(len(codes)), text_of
    width = int(codes.max(initial=0)) + 1
    for _ in range(ROUNDS):
        key = part * width + codes[place]
        order = np.argsort(key)
        ordered = key[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(key) else order
        often = np.empty(len(key), bool)
        often[order] = np.repeat(np.diff(np.append(starts, len(key))) >= exponent, np.diff(np.append(starts, len(key))))
        kept, of = place[often], part[often]
        new = np.ones(len(kept), bool)
        new[1:] = (kept[1:] != kept[:-1] + 1) | (of[1:] != of[:-1])
        number = np.cumsum(new) - 1
        long = (np.bincount(number) >= least)[number] if len(number) else np.zeros(0, bool)
        kept, number = kept[long], number[long]
        if len(kept) == len(place):
            break
        place, part = kept, number
    if not len(place):
        return []
    edges = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    return [(int(a), int(b) + 1) for a, b in zip(place[edges], place[np.append(edges[1:], len(place)) - 1], strict=True)]


def _search(column: str, names: tuple[str, str], exponent: int, least: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, TEXT_BYTES):
            texts = batch.column(batch.schema.get_field_index(column))
            _, codes, counts = word_codes(texts)
            codes = codes.astype(np.int64)
            starts = np.cumsum(counts) - counts
            text_of = np.repeat(np.arange(len(counts)), counts)
            runs: dict[int, list[Run]] = {}
            for a, b in periodic_parts(codes, text_of, exponent, least):
                for start, length, period in runs_of(codes[a:b], exponent, least):
                    i = int(text_of[a])
                    runs.setdefault(i, []).append((a - int(starts[i]) + start, length, period))
            collapsed = []
            for i, text in enumerate(texts):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                for start, length, period in reversed(runs.get(i, [])):
                    words[start + period : start + length] = [None] * (length - period)
                collapsed.append(b" ".join(w for w in words if w is not None) if i in runs else b" ".join(words))
            flat = np.array([run for i in sorted(runs) for run in runs[i]], np.int64).reshape(-1, 3)
            ends = np.cumsum([0] + [len(runs.get(i, ())) for i in range(len(texts))])
            fields = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields), pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=[*batch.schema.names, *names],
            )

    return search


def with_runs(
    docs: DataFrame, column: str = "text", exponent: int = EXPONENT, least: int = LEAST, names: tuple[str, str] = ("runs", "collapsed")
) -> DataFrame:
    """``docs`` with the runs of a text (start, length, period) and the text that keeps one period of each.

    Words are what ASCII white space separates; the collapsed text joins the kept ones
    by one space. Runs are ordered by start and period and count words from 0. Other
    columns go through untouched; ``names`` must be none of them. ``exponent`` is 3 or more.
    """
    if exponent < 3:
        raise ValueError("runs of fewer than three periods are no chain of roots")
    if set(names) & set(docs.columns):
        raise ValueError(f"columns {sorted(set(names) & set(docs.columns))} are there already")
    runs = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))
    added = [T.StructField(names[0], runs), T.StructField(names[1], T.StringType())]
    return docs.mapInArrow(_search(column, names, exponent, least), T.StructType([*docs.schema.fields, *added]))


def echoed(text: Column, doc_id: Column) -> Column:
    """The text in which, for a tenth of the ids, the words from a place on repeat a stretch of them.

    What the query is asked of; a null id counts as empty text.
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.call_function("div", n - a, 3 + g % 8)).cast("int")
    times = F.call_function("div", n - a + p - 1, p).cast("int")
    rest = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    edited = F.array_join(F.concat(F.slice(words, F.lit(1), a), rest), " ")
    return F.when((h % 10 == 0) & (n > 0), edited).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the longest run, and digests of all runs and of the collapsed text, of every document."""
    docs = table(spark, sf_dir, "documents")
    found = with_runs(docs.select("doc_id", echoed(F.col("text"), F.col("doc_id")).alias("text"))).drop("text")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
