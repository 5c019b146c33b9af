"""Main texts of web pages by wrappers that are inferred from the pages of a host.

A wrapper is a union-free regular expression over the tokens of a page: elements
in order, each of which may be optional or repeated, constant texts, and slots for
texts that differ. It begins as the first page; each further page is aligned with it:

* neighbours of the same kind, single or in groups, become one repeated group,
* an element that only one side has becomes optional,
* a text that differs becomes a slot.

Aligning two wrappers works the same way, so every task infers wrappers from its own
pages, and these are aligned in rounds of up to ``FAN`` of a host: a host's pages never
meet in one place. What varies inside a host is its content: the wrapper says which
element holds it.

A text is the host's own if it stands on nearly all of its distinct pages; these are
counted by a Spark aggregation. Own texts are dropped only where no element was entered,
in the page, html or body: parts of it that hold nothing else, anywhere if they
are containers, before and after the article if they are paragraphs or heads.

A null, empty or tagless page is text or nothing, repeated rows are repeated, very long
pages are one piece to the parser and count whole, and other columns of the pages are not looked at.
"""

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foralytics.llm.common import slices, table
from foralytics.llm.html_tree import Element, blocks, parse, tidy
from foralytics.scratch import stage

# Siblings that repeat together, at most.
GROUP = 3
# Wrappers of a host that one task aligns, at most, up to FAN to the power of ROUNDS + 1 tasks.
FAN = 64
ROUNDS = 2
# Elements deeper than this are one with the element around them.
DEPTH = 60
# Distinct pages, and share of a host's distinct pages, on which a text must stand to be the host's own.
CONSTANT = 3
NEARLY_ALL = 0.9
# Longer texts are compared by a hash of the whole text and its length, so wrappers stay small.
TEXT_KEY = 32
# Different texts of a repeated element, at most; with more it is a slot.
TEXTS = 64
MAIN = ("article", "main")
# Elements that hold the whole page: to enter them singles nothing out.
WHOLE = ("html", "body")
BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption".split())
PAGE_BYTES = 4 << 20


@dataclass
class Node:
    key: str
    pages: int = 1
    repeated: bool = False
    optional: bool = False
    aside: bool = False
    # Key of the constant text of this element itself, of a repeated one a line for each; None is a slot.
    text: str | None = ""
    # Characters of text seen in this element itself where it varies, and of any.
    chars: int = 0
    parts: list["Node"] = field(default_factory=list)

    def packed(self) -> list:
        return [self.key, self.pages, int(self.repeated), int(self.optional), int(self.aside), self.text, self.chars, [p.packed() for p in self.parts]]

    @staticmethod
    def unpacked(x: list) -> "Node":
        return Node(x[0], x[1], bool(x[2]), bool(x[3]), bool(x[4]), x[5], x[6], [Node.unpacked(p) for p in x[7]])


def own_text(element: Element) -> str:
    return tidy("".join(p for p in element.parts if isinstance(p, str)))


def text_key(text: str) -> str:
    if len(text) <= TEXT_KEY:
        return f"{len(text)} {text}"
    return f"{len(text)} {hashlib.blake2b(text.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}"


def tag_of(key: str) -> str:
    return key.split(".")[0].split("#")[0]


def of_page(element: Element, depth: int = 0) -> Node:
    """A page's own wrapper, repeated siblings folded; an element at ``DEPTH`` has all text below it as its own."""
    text = own_text(element) if depth < DEPTH else tidy(" ".join(blocks(element)))
    node = Node(element.key, aside=element.aside, chars=len(text), text=text_key(text) if text else "")
    if not element.aside and depth < DEPTH:
        node.parts = fold([of_page(p, depth + 1) for p in element.parts if not isinstance(p, str)])
    return node


def both_texts(a: str | None, b: str | None, repeated: bool) -> str | None:
    """What two elements have for text: a slot if it differs, but up to ``TEXTS`` different ones where it repeats."""
    if a == b or a is None or b is None:
        return a if a == b else None
    if not repeated:
        return None
    texts = sorted({x for x in (*a.split("\n"), *b.split("\n")) if x})
    return "\n".join(texts) if len(texts) <= TEXTS else None


def aligned(a: Node, b: Node, pages: bool = True) -> Node:
    """The wrapper of what ``a`` and ``b`` stand for; ``pages``: they are of different pages."""
    repeated = a.repeated or b.repeated or not pages
    return Node(
        a.key, a.pages + b.pages if pages else max(a.pages, b.pages), repeated,
        a.optional or b.optional, a.aside, both_texts(a.text, b.text, repeated), a.chars + b.chars,
        align(a.parts, b.parts, pages),
    )


def align(a: list[Node], b: list[Node], pages: bool = True) -> list[Node]:
    """Common parts in order (the longest common run of keys); the others become optional."""
    if [x.key for x in a] == [x.key for x in b]:
        return [aligned(x, y, pages) for x, y in zip(a, b, strict=True)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].key == b[j].key else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i].key == b[j].key:
            out.append(aligned(a[i], b[j], pages))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            a[i].optional = True
            out.append(a[i])
            i += 1
        else:
            b[j].optional = True
            out.append(b[j])
            j += 1
    return fold(out)


def fold(parts: list[Node]) -> list[Node]:
    """Groups of up to ``GROUP`` siblings that follow their like become one repeated group."""
    for size in range(1, GROUP + 1):
        out: list[Node] = []
        i = 0
        while i < len(parts):
            now = parts[i : i + size]
            if len(now) == size and [x.key for x in out[-size:]] == [x.key for x in now]:
                out[-size:] = [aligned(x, y, False) for x, y in zip(out[-size:], now, strict=True)]
                i += size
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


def varying(node: Node, own: frozenset[str]) -> int:
    """Characters of text in a node that is not the host's own, asides left out."""
    if node.aside:
        return 0
    fixed = node.text is not None and all(x in own for x in node.text.split("\n") if x)
    return (0 if fixed else node.chars) + sum(varying(p, own) for p in node.parts)


def main_path(wrapper: Node, own: frozenset[str] = frozenset()) -> list[str]:
    """Keys from the page down to the element that holds the varying text.

    The way leads into a part as long as it alone holds what varies and is no block of
    text itself. Where several parts vary, an ``article`` or ``main`` element below is
    entered if the wrapper finds more of the varying text in it than in all the rest.
    """
    path, node = [], wrapper
    while True:
        inner = [p for p in node.parts if varying(p, own)]
        # Varying text of the element itself, beside its parts, would be lost inside of one.
        if len(inner) != 1 or varying(node, own) > varying(inner[0], own) or inner[0].repeated or tag_of(inner[0].key) in BLOCK:
            break
        node = inner[0]
        path.append(node.key)
    if any(tag_of(key) in MAIN for key in path):
        return path
    best: tuple[int, list[str]] = (0, [])
    todo: list[tuple[Node, list[str]]] = [(p, path) for p in node.parts]
    while todo:
        part, above = todo.pop()
        if part.aside:
            continue
        here, held = [*above, part.key], varying(part, own)
        if tag_of(part.key) in MAIN and held > best[0]:
            best = (held, here)
        todo.extend((p, here) for p in part.parts)
    return best[1] if 2 * best[0] > varying(node, own) else path


def constants(wrapper: Node, path: list[str], own: frozenset[str]) -> list[str]:
    """The host's own texts outside the element at ``path``; in the whole page, those of parts that hold no others."""
    if not varying(wrapper, own):
        return []
    out: set[str] = set()

    def gather(node: Node) -> None:
        if not node.aside and not varying(node, own):
            out.update(x for x in (node.text or "").split("\n") if x)
            for part in node.parts:
                gather(part)

    found = [wrapper]
    for key in [*path, None]:
        if key is None and path and tag_of(path[-1]) not in WHOLE:
            break
        inside = []
        for node in found:
            out.update(x for x in (node.text or "").split("\n") if x in own)
            for part in node.parts:
                if part.key == key:
                    inside.append(part)
                else:
                    gather(part)
        found = inside
    return sorted(out)


def main_text(page: Element, path: list[str], same: frozenset[str]) -> str:
    """Blocks of the elements at ``path``; of the whole page without the host's own texts. "" if there are none."""
    found = [page]
    for key in path:
        found = [p for e in found for p in e.parts if not isinstance(p, str) and p.key == key and not p.aside]
    if not same or path and tag_of(path[-1]) not in WHOLE:
        return "\n".join(t for e in found for t in blocks(e))

    def owned(part: Element) -> bool:
        return part.tag not in BLOCK and not part.aside and all(text_key(t) in same for t in blocks(part))

    texts = []
    for e in found:
        rest = Element(e.tag, e.key, False)
        # An empty element in its place still parts the texts around it.
        rest.parts = [p if isinstance(p, str) or not owned(p) else Element(p.tag, p.key, False) for p in e.parts]
        texts += blocks(rest)
    while texts and text_key(texts[-1]) in same:
        texts.pop()
    first = next((i for i, t in enumerate(texts) if text_key(t) not in same), 0)
    return "\n".join(texts[first:])


def own_texts(page: Element) -> set[str]:
    """Keys of the texts of a page's elements, asides left out."""
    out, todo = set(), [(page, 0)]
    while todo:
        element, depth = todo.pop()
        if not element.aside:
            if text := own_text(element) if depth < DEPTH else tidy(" ".join(blocks(element))):
                out.add(text_key(text))
            if depth < DEPTH:
                todo.extend((p, depth + 1) for p in element.parts if not isinstance(p, str))
    return out


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", PAGE_BYTES):
        out: list[tuple[str, bytes, str | None]] = []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = hashlib.blake2b(source.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            out.append((host, page, None))
            out.extend((host, page, x) for x in own_texts(parse(source)))
        columns = list(zip(*out, strict=True)) or [[]] * 3
        kinds = (pa.string(), pa.binary(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["host", "page", "text"])


def host_texts(pages: DataFrame) -> DataFrame:
    """(host, own): the texts on nearly all distinct pages of a host; pages equal in html count once."""
    seen = pages.mapInArrow(_seen, "host string, page binary, text string").distinct()
    counted = stage(seen.groupBy("host", "text").agg(F.count("*").alias("pages")).where(F.col("pages") >= CONSTANT), "host-texts")
    sizes = counted.where("text is null").select("host", F.col("pages").alias("of"))
    own = counted.where("text is not null").join(sizes, "host").where(F.col("pages") >= NEARLY_ALL * F.col("of"))
    return own.groupBy("host").agg(F.collect_list("text").alias("own"))


PARTIAL = "host string, part long, wrapper string"


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers: dict[str, Node] = {}
    for batch in slices(batches, "html", PAGE_BYTES):
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            node = of_page(parse(source))
            wrappers[host] = aligned(wrappers[host], node) if host in wrappers else node
    packed = [json.dumps(w.packed()) for w in wrappers.values()]
    parts = [TaskContext.get().partitionId()] * len(packed)
    columns = [pa.array(list(wrappers), pa.string()), pa.array(parts, pa.int64()), pa.array(packed, pa.string())]
    yield pa.RecordBatch.from_arrays(columns, names=["host", "part", "wrapper"])


def _join_up(rows: pa.Table) -> pa.Table:
    wrapper = None
    for packed in sorted(rows["wrapper"].to_pylist()):
        node = Node.unpacked(json.loads(packed))
        wrapper = node if wrapper is None else aligned(wrapper, node)
    return pa.table({"host": rows["host"].slice(0, 1), "part": rows["part"].slice(0, 1), "wrapper": pa.array([json.dumps(wrapper.packed())])})


def _rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rules = []
        for packed, texts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            wrapper, own = Node.unpacked(json.loads(packed)), frozenset(texts or ())
            path = main_path(wrapper, own)
            rules.append(json.dumps({"path": path, "same": constants(wrapper, path, own)}))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rules, pa.string())], names=["host", "wrapper", "rule"])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, rule) of every host of ``pages`` (host, html), from all of its pages."""
    pages = pages.select("host", F.coalesce("html", F.lit("")).alias("html"))
    wrappers = pages.mapInArrow(_infer, PARTIAL)
    for done in range(ROUNDS, -1, -1):
        # The tasks' numbers lose a digit of base FAN a round; the last round has one group a host.
        wrappers = wrappers.withColumn("part", F.expr(f"part div {FAN}") if done else F.lit(0).cast("long"))
        wrappers = wrappers.groupBy("host", "part").applyInArrow(_join_up, PARTIAL)
    return wrappers.select("host", "wrapper").join(host_texts(pages), "host", "left").mapInArrow(_rules, "host string, wrapper string, rule string")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rules: dict[str, tuple[list[str], frozenset[str]]] = {}
    for batch in slices(batches, "html", PAGE_BYTES):
        texts = []
        for source, rule in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if rule not in rules:
                if len(rules) > 10_000:
                    rules.clear()
                read = json.loads(rule)
                rules[rule] = (read["path"], frozenset(read["same"]))
            page = parse(source or "")
            path, same = rules[rule]
            # A page unlike its host's wrapper is taken by itself.
            texts.append(main_text(page, path, same) or main_text(page, main_path(of_page(page), same), same))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html).

    A null or empty page has an empty text. Pages without a host (a null or odd url)
    are treated as pages of one host. Repeated rows are repeated in the result.
    """
    hosted = pages.select(
        "page_id", "url", "html", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^/]*//([^/?#]*)", 1)).alias("host")
    )
    # Written first: Spark knows the size of the rules when it plans the join, and need not deal pages by host.
    rules = stage(infer_wrappers(hosted).select("host", "rule"), "rules")
    return hosted.join(rules, "host").select("page_id", "url", "html", "rule").mapInArrow(
        _extract, "page_id long, url string, text string"
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    texts = main_texts(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
