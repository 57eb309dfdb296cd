"""A tolerant reader of HTML: an element tree, digests of its subtrees, and the text blocks of a main part."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import xxhash

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WORD = re.compile(r"[a-z0-9]+")

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CLOSES_PARAGRAPH = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
# An opening tag ends open elements of these names, up to the nearest container.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tr", "td", "th", "tbody", "thead"}, {"table"}),
}

# What is no article text, by element, role, or word of a class or id.
FURNITURE_TAGS = frozenset(
    "nav footer aside form script style head title noscript iframe template textarea button select input dialog svg canvas "
    "object embed audio video menu".split()
)
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form note".split()
)
FURNITURE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo promotion banner cookie cookies consent notice notices notification alert popup modal newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations comment comments reply "
    "replies discussion disqus respond widget masthead toolbar pagination pager".split()
)
# Of these, what may as well name a section of an article: inside one, only the host's counts decide.
SECTION_ROLES = frozenset("note alert".split())
SECTION_WORDS = frozenset(
    "navigation menu aside promotion banner consent notice notices notification alert popup modal subscription share sharing "
    "social related recommended recommendations reply replies discussion respond widget toolbar".split()
)
ARTICLE_ROLES, ARTICLE_WORDS = FURNITURE_ROLES - SECTION_ROLES, FURNITURE_WORDS - SECTION_WORDS


@dataclass(slots=True)
class Element:
    tag: str
    words: frozenset[str] = frozenset()
    role: str = ""
    children: list[Element | str] = field(default_factory=list)
    digest: int = 0
    text: int = 0  # sum of the hashes of its texts
    n_words: int = 0
    in_article: bool = False


def parsed(text: str) -> Element:
    """The tree of a page. Unclosed elements end where the standard or their container ends them."""
    root = Element("#root")
    stack = [root]
    at = 0
    while at < len(text):
        found = TOKEN.search(text, at)
        if not found:
            stack[-1].children.append(text[at:])
            break
        if found.start() > at:
            stack[-1].children.append(text[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            _close(stack, tag)
            continue
        _end_open(stack, tag)
        words, role = _labels(found[3]) if found[3] else (frozenset(), "")
        element = Element(tag, words, role, in_article=stack[-1].in_article or stack[-1].tag == "article")
        stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(text, at)
            element.children.append(text[at : end.start() if end else len(text)])
            at = end.end() if end else len(text)
        elif tag not in VOID:
            stack.append(element)
    return root


def _labels(attributes: str) -> tuple[frozenset[str], str]:
    words: set[str] = set()
    role = ""
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        if name.lower() in ("class", "id"):
            words.update(WORD.findall(value))
        elif name.lower() == "role":
            role = value.strip()
    return frozenset(words), role


def _close(stack: list[Element], tag: str) -> None:
    for place in range(len(stack) - 1, 0, -1):
        if stack[place].tag == tag:
            del stack[place:]
            return


def _end_open(stack: list[Element], tag: str) -> None:
    if tag in CLOSES_PARAGRAPH:
        for place in range(len(stack) - 1, 0, -1):
            if stack[place].tag == "p":
                del stack[place:]
                break
            if stack[place].tag in BLOCKS:
                break
    names, walls = ENDS.get(tag, ((), ()))
    for place in range(len(stack) - 1, 0, -1):
        if stack[place].tag in walls:
            break
        if stack[place].tag in names:
            del stack[place:]
            return


def digested(element: Element) -> None:
    """Sets the digest of every subtree: its tag, labels, words and children. Links and numbers of pages do not count.
    Also its texts and words, without furniture.

    Children come before parents, without recursion, since pages may nest deeply.
    """
    order, waiting = [], [element]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting.extend(child for child in node.children if not isinstance(child, str))
    for node in reversed(order):
        parts = [node.tag, " ".join(sorted(node.words)), node.role]
        node.text = node.n_words = 0
        for child in node.children:
            if not isinstance(child, str):
                parts.append(str(child.digest))
                if not is_furniture(child, True):
                    node.text += child.text
                    node.n_words += child.n_words
            elif words := child.split():
                parts.append(" ".join(words))
                node.text += xxhash.xxh3_64_intdigest(parts[-1].encode("utf-8", "surrogatepass"))
                node.n_words += len(words)
        node.digest = xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def is_furniture(node: Element, inside: bool) -> bool:
    """``inside``: within the main part, where a header belongs to the article."""
    if node.tag in FURNITURE_TAGS or node.role in (ARTICLE_ROLES if node.in_article else FURNITURE_ROLES):
        return True
    if node.tag == "header" or "header" in node.words:
        return not inside
    return node.tag not in ("article", "main", "body", "html") and not (
        ARTICLE_WORDS if node.in_article else FURNITURE_WORDS
    ).isdisjoint(node.words)


def text_size(node: Element) -> int:
    total, waiting = 0, [node]
    while waiting:
        for child in waiting.pop().children:
            if isinstance(child, str):
                total += len(child)
            elif not is_furniture(child, True):
                waiting.append(child)
    return total


def main_part(root: Element) -> Element | None:
    """The main element or article with the most text outside furniture, an article with the articles beside it; None if a
    page has neither. A main element without articles counts as one."""
    found: list[tuple[Element, Element]] = []
    waiting = [(root, False)]
    while waiting:
        node, inside = waiting.pop()
        for child in node.children:
            if isinstance(child, str) or is_furniture(child, inside):
                continue
            main, plain = child.tag == "main" or child.role == "main", FURNITURE_WORDS.isdisjoint(child.words)
            if plain and (main or child.tag == "article"):
                found.append((child, node))
            if main or child.tag != "article" or not plain:
                waiting.append((child, inside or main))
    articles = {id(child) for child, _ in found if child.tag == "article"}
    for child, _ in found:
        if child.tag != "article" and not _holds(child, articles):
            _count_as_article(child)
    if not found:
        return None
    best, parent = max(reversed(found), key=lambda pair: text_size(pair[0]))
    beside = [child for child, other in found if other is parent and child.tag == "article"]
    return Element("#main", children=beside) if best.tag == "article" and len(beside) > 1 else best


def _holds(part: Element, wanted: set[int]) -> bool:
    waiting = [part]
    while waiting:
        for child in waiting.pop().children:
            if not isinstance(child, str):
                if id(child) in wanted:
                    return True
                waiting.append(child)
    return False


def _count_as_article(part: Element) -> None:
    waiting = [part]
    while waiting:
        for child in waiting.pop().children:
            if not isinstance(child, str):
                child.in_article = True
                waiting.append(child)


def digested_main(root: Element) -> Element | None:
    """The main part, with the digests, texts and words of the page set."""
    main = main_part(root)
    digested(root)
    if main and main.tag == "#main":
        main.text, main.n_words = sum(c.text for c in main.children), sum(c.n_words for c in main.children)
    return main


def subtrees(root: Element, main: Element | None) -> dict[int, int | None]:
    """The digest of each element with content, and a digest of the texts beside it: those of the main part, else of the page.

    None stands for texts shorter than the element's own, beside which it is no mere template. Headers and titles of the
    main part belong to it, also where articles share them.
    """
    scope = main or root
    parts = {id(c) for c in main.children} if main and main.tag == "#main" else {id(main)}
    found: dict[int, int | None] = {}
    waiting = [(root, root is scope)]
    while waiting:
        node, inside = waiting.pop()
        for child in node.children:
            if isinstance(child, str) or inside and main and child.tag in ("h1", "header"):
                continue
            if id(child) not in parts and child.children and child.tag not in ("html", "body", "head"):
                words, text = (child.n_words, child.text) if inside else (0, 0)
                beside = (scope.text - text) % (1 << 64) - (1 << 63)
                found[child.digest] = beside if scope.n_words - words >= max(1, child.n_words) else None
            waiting.append((child, inside or id(child) in parts))
    return found


def deletable(part: Element, inside: bool) -> set[int]:
    """The digests of all subtrees below ``part`` that the text comes from."""
    found, waiting = set(), [part]
    while waiting:
        for child in waiting.pop().children:
            if not isinstance(child, str) and not is_furniture(child, inside):
                found.add(child.digest)
                waiting.append(child)
    return found


def template_of(part: Element, inside: bool, recurring: set[int]) -> set[int]:
    """The recurring digests to delete below ``part``: none if more words than stay would go, as in edited copies of a text."""
    gone, waiting = 0, [(part, False)]
    while waiting:
        node, linked = waiting.pop()
        for child in node.children:
            if isinstance(child, str) or is_furniture(child, inside):
                continue
            if child.digest not in recurring:
                waiting.append((child, linked or child.tag == "a"))
            elif not linked:
                gone += child.n_words - _linked_words(child)
    return recurring if 2 * gone <= part.n_words else set()


def _linked_words(part: Element) -> int:
    total, waiting = 0, [part]
    while waiting:
        node = waiting.pop()
        if node.tag == "a":
            total += node.n_words
        else:
            waiting.extend(c for c in node.children if not isinstance(c, str) and not is_furniture(c, True))
    return total


def block_texts(part: Element, inside: bool, deleted: set[int]) -> list[str]:
    """Texts of the blocks below ``part`` in page order, without furniture and deleted subtrees."""
    blocks: list[str] = []
    pending: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(pending).split()):
            blocks.append(text)
        pending.clear()

    waiting: list[Element | str | None] = [part]
    while waiting:
        node = waiting.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            pending.append(html.unescape(node))
        elif node is part or not (is_furniture(node, inside) or node.digest in deleted):
            if node.tag in ("br", "hr", "wbr"):
                pending.append("" if node.tag == "wbr" else " ")
            if node.tag in BLOCKS or node is part:
                flush()
                waiting.append(None)
            waiting.extend(reversed(node.children))
    flush()
    return blocks
