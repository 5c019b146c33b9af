"""Elements and text blocks of a web page, from its token stream."""

import html
import re

# Tags that stand inside a line of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that are no part of an article.
ASIDE = frozenset(
    "head nav header footer aside form script style noscript template iframe object svg canvas button select "
    "textarea menu dialog audio video".split()
)
# Words that name such elements in class, id and role.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner billboard menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar side aside footer foot masthead topbar cookie cookies "
    "consent gdpr notice notices notification alert newsletter subscribe subscription signup popup modal overlay comment comments "
    "commentlist reply replies respond disqus share sharing social related recommended recommendations widget login search toolbar "
    "pagination pager skip legal copyright disclaimer contentinfo complementary hidden".split()
)
# Words beside them that leave a name what it is; any other word makes it a name of something else.
FRAME_WORDS = frozenset(
    "site page main global primary secondary left right top bottom box block area wrapper wrap container section list item items "
    "inner outer link links post posts article entry bar button buttons icon icons slot unit form content group panel user users "
    "reader readers text title titles body author message media network networks inline sticky mobile desktop row col column grid "
    "strip zone space holder placeholder heading label".split()
)
# A header is an aside as that of a site; that of an article holds its headline.
HEADERS = frozenset("header head".split())
OF_SITE = frozenset("site page main global top".split())
# A start of one of these closes an open one of the same line.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|iframe|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[a-zA-Z/!?][^>]*>|[^<]+|<",
    re.S | re.I,
)
MARK = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Element:
    """A block element; ``parts`` are its elements and, as strings, the raw texts between them."""

    __slots__ = ("aside", "key", "parts", "tag")

    def __init__(self, tag: str, key: str, aside: bool):
        self.tag, self.key, self.aside = tag, key, aside
        self.parts: list = []


def names_aside(name: str) -> bool:
    """Whether one word of a class, an id or a role names an element that is no part of an article.

    All of the name counts: ``ad-slot`` and ``siteFooter`` do, ``share-price`` does not.
    """
    words = [w.lower() for w in WORDS.findall(name) if not w.isdigit()]
    if any(w in ASIDE_WORDS for w in words):
        return all(w in ASIDE_WORDS or w in FRAME_WORDS for w in words)
    return any(w in HEADERS for w in words) and all(w in HEADERS or w in OF_SITE for w in words)


def _marks(attributes: str) -> tuple[str, bool]:
    """(key, whether the marks tell of an aside); words of classes and ids with digits are a page's own and no part of the key."""
    key, aside = "", False
    for m in MARK.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "class":
            words = " ".join(w for w in value.split() if not re.search(r"\d", w))
            key += f".{words}" if words else ""
        elif m[1].lower() == "id" and not re.search(r"\d", value):
            key += f"#{value}"
        aside = aside or any(names_aside(w) for w in value.split())
    return key, aside


def _close_paragraph(stack: list[Element]) -> None:
    """A block ends an open paragraph, with what is open inside a line of it."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == "p":
            del stack[i:]
            return
        if stack[i].tag not in INLINE:
            return


def parse(source: str) -> Element:
    """The tree of a page's block elements; tags inside a line are left out, a line break is a space.

    Of elements inside a line only asides are kept, up to their end tag. Elements that
    are never closed end where a browser would end them, or with the element around
    them; stray end tags count for nothing.
    """
    root = Element("#page", "#page", False)
    stack = [root]
    for token in TOKEN.finditer(source):
        if token[1]:
            continue
        tag = token[3]
        if tag is None:
            text = token[0]
            if text[0] != "<" or len(text) == 1:
                stack[-1].parts.append(text)
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                stack[-1].parts.append(" ")
            elif token[2]:
                # Only asides and what they hold are on the stack.
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag not in INLINE:
                        break
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
            elif tag not in VOID and (token[4] or stack[-1].tag in INLINE) and not token[4].endswith("/"):
                key, aside = _marks(token[4])
                if aside or stack[-1].tag in INLINE:
                    stack[-1].parts.append(opened := Element(tag, tag + key, True))
                    stack.append(opened)
            continue
        if token[2]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        _close_paragraph(stack)
        if tag == "body":
            while len(stack) > 1 and stack[-1].tag == "head":
                stack.pop()
        over = CLOSES.get(tag, ())
        while stack[-1].tag in over:
            stack.pop()
        key, aside = _marks(token[4]) if token[4] else ("", False)
        # A page has one html and one body, whose classes often name the page.
        key = "" if tag in ("html", "body") else key
        if tag == "header" and any(e.tag == "article" for e in stack):
            named = aside
        else:
            named = tag in ASIDE or (aside and tag not in ("html", "body", "article", "main"))
        element = Element(tag, tag + key, named)
        stack[-1].parts.append(element)
        if tag not in VOID and not token[4].endswith("/"):
            stack.append(element)
    return root


def tidy(raw: str) -> str:
    """Character references decoded, white space as single spaces, none at the ends."""
    return " ".join(html.unescape(raw).split())


def blocks(element: Element) -> list[str]:
    """Texts of the blocks of an element in page order, without its asides."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            text = tidy("".join(line))
            if text:
                out.append(text)
            line.clear()

    # Not recursive: pages may nest as deep as they like.
    todo = [iter(element.parts)]
    while todo:
        for part in todo[-1]:
            if isinstance(part, str):
                line.append(part)
            elif part.aside and part.tag in INLINE:
                continue
            else:
                flush()
                if not part.aside:
                    todo.append(iter(part.parts))
                    break
        else:
            flush()
            todo.pop()
    return out
