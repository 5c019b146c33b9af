"""Documents that hold a test item, up to a number of edits.

An item may differ from the document in ``RATE`` of its characters. It is cut into
one piece more than it may have edits, so one piece at least stands in the document
unchanged. All pieces of a block of items form one Aho-Corasick automaton; at each
exact hit of a piece, the text around it is compared with the item: first by counting
common 4-grams, each edit costs four at most, then by Myers' bit-parallel distance.

The items are the stated query set. They are sent to the tasks in blocks of about
``BLOCK_CHARS``, each in a pass over the documents; documents are not shuffled.
"""

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foralytics.llm.common import table
from foralytics.scratch import stage

RATE = 0.08
# Shorter items are looked for without edits, from word to word.
SHORT = 30
GRAM = 4
BLOCK_CHARS = 1_000_000


def plain(text: Column) -> Column:
    """Lower case, letters and digits only, one space between words and at both ends."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.concat(F.lit(" "), words, F.lit(" "))


class Item:
    """A test item ready to be looked for; ``text`` has a space at both ends."""

    def __init__(self, item_id: int, text: str, rate: float):
        self.item_id = item_id
        self.text = text if len(text) - 2 < SHORT else text[1:-1]
        self.edits = 0 if len(text) - 2 < SHORT else int(rate * len(self.text))
        self.grams = {self.text[i : i + GRAM] for i in range(len(self.text) - GRAM + 1)}
        self.least = len(self.text) - GRAM + 1 - GRAM * self.edits
        self.masks: dict[str, int] = {}
        for i, c in enumerate(self.text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def pieces(self) -> list[tuple[str, int]]:
        """(piece, where it ends in the item)."""
        n = self.edits + 1
        edges = [len(self.text) * i // n for i in range(n + 1)]
        return [(self.text[a:b], b) for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def distance(self, text: str) -> tuple[int, int] | None:
        """(edits, end) of the best place in ``text``, the first of equal ones, if within the budget."""
        if self.edits:
            grams = self.grams
            if sum(text[i : i + GRAM] in grams for i in range(len(text) - GRAM + 1)) < self.least:
                return None
        return myers(self.masks, len(self.text), text, self.edits)


def myers(masks: dict[str, int], length: int, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the pattern's best occurrence in ``text``, None above ``most``."""
    every, top = (1 << length) - 1, 1 << (length - 1)
    up, down, score, best = every, 0, length, None
    for end, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        more = (down | ~(horizontal | up)) & every
        less = up & horizontal
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more = more << 1 & every
        less = less << 1 & every
        up = (less | ~(vertical | more)) & every
        down = more & vertical
        if score <= most and (best is None or score < best[0]):
            best = (score, end)
            if not score:
                break
    return best


def find_items(text: str, automaton: ahocorasick.Automaton) -> dict[Item, tuple[int, int]]:
    """Item -> (edits, end) of its best place in ``text``."""
    best: dict[Item, tuple[int, int]] = {}
    tried = set()
    for end, owners in automaton.iter(text):
        for item, piece_end in owners:
            start = end + 1 - piece_end
            if (item, start) in tried or best.get(item, (1,))[0] == 0:
                continue
            tried.add((item, start))
            first = max(0, start - item.edits)
            found = item.distance(text[first : start + len(item.text) + item.edits])
            if found and (item not in best or found[0] < best[item][0]):
                best[item] = (found[0], first + found[1])
    return best


FOUND = "doc_id long, item_id long, edits int, item_chars int, match_end long"


def _match(items: list[tuple[int, str]], rate: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners: dict[str, list[tuple[Item, int]]] = {}
        for item_id, text in items:
            item = Item(item_id, text, rate)
            for piece, end in item.pieces():
                owners.setdefault(piece, []).append((item, end))
        automaton = ahocorasick.Automaton()
        for piece, who in owners.items():
            automaton.add_word(piece, who)
        automaton.make_automaton()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for item, (edits, end) in find_items(text.as_py(), automaton).items():
                    out.append((doc_id, item.item_id, edits, len(item.text), end))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
            names = [x.split()[0] for x in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names)

    return match


def find_leaks(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, edits, item_chars, match_end) for each row of ``docs`` and item that it holds.

    ``match_end`` is a place in the plain text. Null, empty and unlettered texts
    hold nothing, and such items are in nothing; repeated rows and repeated items
    each count. Items of one text and different ids are all found.
    """
    spark = docs.sparkSession
    texts = items.select(F.col("item_id").cast("long"), plain(F.col("text")).alias("plain")).where("length(plain) > 2")
    total = texts.agg(F.sum(F.length("plain"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS)
    found = spark.createDataFrame([], FOUND)
    for block in range(blocks):
        mine = texts.where(F.pmod(F.xxhash64("plain"), F.lit(blocks)) == block)
        wanted = [(r["item_id"], r["plain"]) for r in mine.collect()]
        if wanted:
            plain_docs = docs.select("doc_id", plain(F.col("text")).alias("plain"))
            found = found.unionByName(plain_docs.mapInArrow(_match(wanted, rate), FOUND))
    return found


def drop_leaks(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """Rows of ``docs`` that hold none of the ``items``; all columns stay.

    ``docs`` must have no column ``__key``. The leaks are written first: Spark then knows their size when it plans the join.
    """
    key = F.xxhash64("text")
    leaks = stage(find_leaks(docs.select(key.alias("doc_id"), "text"), items, rate).select(F.col("doc_id").alias("__key")).distinct(), "leaks")
    return docs.join(leaks, key == F.col("__key"), "left_anti").select(*docs.columns)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark item, with the item and its edits."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
