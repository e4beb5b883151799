"""Main text of web pages by composite text density.

A page becomes a tree of elements. Elements that are boilerplate by tag or role, or by name unless they hold the text
itself, are cut first. Every other node
gets its characters per tag, adjusted by the share of link text and link tags; a parent's score is the sum of its
children's densities. The subtree with the largest sum is the content; the least density on the path from it to the
body is the threshold at which other subtrees outside of it count as content too.
"""

import re
from dataclasses import dataclass, field
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from emberline.llm.texts import add_columns

# --- Fixed values: element classes of HTML, and names by which boilerplate is known -----
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup: it goes on to the end tag, or else to the end of the page.
RAW = frozenset("script style iframe textarea title xmp".split())
#: Content that is not shown, cut if the element is ended by its own end tag. Without one, what follows is the page's.
ENDED = frozenset("noscript template svg object canvas audio video".split())
#: Here and in the elements inside of them, "/>" ends an element.
FOREIGN = frozenset(("svg", "math"))
CUT = frozenset("head nav footer aside form menu dialog button select option label fieldset datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img input math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded "
    "mphantom msub msup msubsup munder mover munderover mmultiscripts semantics annotation".split()
)
BOUNDARY = frozenset("html body table td th caption".split())
CUT_NAMES = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "topbar sidebar footer header masthead cookie cookies consent gdpr notice alert comment comments disqus reply "
    "replies share sharing social related recommended newsletter subscribe signup login popup modal overlay "
    "breadcrumb breadcrumbs widget toolbar pagination pager search disclaimer copyright skip".split()
)
#: Words that make a header the one of the text, and words after which a name says what an element has or lacks.
OWN_NAMES = frozenset("article content entry main post story".split())
STATES = frozenset("has have with without no hide show".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: Open elements that a start tag ends, as the end tag may be left out.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)

#: Elements open at once; start tags beyond it are read as if they were not there, as browsers do.
DEPTH = 512

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<[/a-zA-Z][^>]*+(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+("[^"]*+"|'[^']*+'|[^ \t\n\f\r>]*+))?"""
)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True, eq=False)
class Node:
    tag: str
    parent: "Node | None"
    first: int
    cut: bool = False
    last: int = 0
    chars: int = 0
    link_chars: int = 0
    tags: int = 0
    link_tags: int = 0
    density: float = 0.0
    #: 1 if a name speaks for boilerplate, 2 if the name is nothing else.
    doubt: int = 0
    #: Characters of the longest article or main element in it, itself included.
    article: int = 0
    children: list["Node"] = field(default_factory=list)


def _attributes(attrs: str) -> dict[str, str]:
    """Values by lower-case name; of repeated names the first counts."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(attrs):
        value = value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1 else value
        out.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return out


def _named(token: str, inside_article: bool) -> bool:
    """Whether a class or an id speaks for boilerplate."""
    words = [w.lower() for w in _NAME.findall(token)]
    for i, word in enumerate(words):
        if word not in CUT_NAMES or not STATES.isdisjoint(words[:i]):
            continue
        if word != "header" or not (inside_article or OWN_NAMES.intersection(words)):
            return True
    return False


def _boilerplate(tag: str, attrs: str, inside_article: bool) -> tuple[bool, int]:
    """Whether the element is boilerplate by tag, role or as hidden, and whether its names speak for it (`doubt`)."""
    if tag in CUT or (tag == "header" and not inside_article):
        return True, 0
    if not attrs or tag in ("html", "body", "article", "main"):
        return False, 0
    has = _attributes(attrs)
    if "hidden" in has or has.get("aria-hidden", "").strip().lower() == "true" or has.get("role", "").strip().lower() in CUT_ROLES:
        return True, 0
    found = [t for name in ("class", "id") for t in has.get(name, "").split() if _named(t, inside_article)]
    return False, (2 if any(t.lower() in CUT_NAMES for t in found) else 1) if found else 0


def parse(html: str) -> tuple[Node, list[str]]:
    """The tree, and the pieces of text in page order; a node's text is pieces[first:last], cut parts left out.

    Elements whose names alone speak for boilerplate are still part of it.
    """
    root = Node("#root", None, 0)
    pieces: list[str] = []
    stack = [root]
    links = cut = articles = foreign = 0
    endless: set[str] = set()
    lifted = False

    def text(raw: str) -> None:
        if cut:
            return
        plain = unescape(raw) if "&" in raw else raw
        pieces.append(plain)
        n = len(plain.strip())
        stack[-1].chars += n
        if links:
            stack[-1].link_chars += n

    def pop(ended: bool = False) -> None:
        nonlocal links, cut, articles, foreign, lifted
        node = stack.pop()
        unseen = ended and node.tag in ENDED
        if unseen:
            del pieces[node.first :]
        node.last = len(pieces)
        links -= node.tag == "a"
        cut -= node.cut
        articles -= node.tag in ("article", "main")
        foreign -= node.tag in FOREIGN
        if node.tag not in INLINE and not cut:
            pieces.append(" ")
        up = stack[-1]
        if not node.cut and not unseen:
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.tag == "a")
            if node.tag in ENDED:  # without an end: what was read into it is its parent's
                up.tags += node.tags
                up.children.extend(node.children)
                lifted = True
            else:
                up.tags += node.tags + 1
                up.children.append(node)
            if node.tag in ("article", "main"):
                node.article = max(node.article, node.chars)
            up.article = max(up.article, node.article)

    def pop_to(tag: str, bounds: frozenset[str] | set[str], ended: bool = False) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                while len(stack) > i + 1:
                    pop()
                pop(ended)
                return
            if stack[i].tag in bounds:
                return

    at = 0
    while True:
        found = _MARKUP.search(html, at)
        if found is None:
            break
        if found.start() > at:
            text(html[at : found.start()])
        at = found.end()
        if not found["tag"]:
            continue
        tag = found["tag"].lower()
        if found["end"]:
            if tag == "br":
                text(" ")
            elif tag not in VOID:
                pop_to(tag, BOUNDARY if tag not in BOUNDARY else frozenset(), True)
            continue
        if tag in RAW:
            done = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = done.end() if done else len(html)
            continue
        if (foreign or tag in FOREIGN) and found["attrs"].endswith("/"):
            continue
        if tag in ENDED and len(stack) >= DEPTH and tag not in endless:
            done = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            if done:
                at = done.end()
            else:
                endless.add(tag)
            continue
        if tag in VOID:
            if tag not in INLINE:
                text(" ")
            stack[-1].tags += not cut
            continue
        if tag in CLOSES_P:
            pop_to("p", BOUNDARY | {"button"})
        for ended in ENDS.get(tag, ((), ()))[0]:
            pop_to(ended, ENDS[tag][1])
        if tag == "a":
            pop_to("a", BOUNDARY | CLOSES_P)
        if tag not in INLINE and not cut:
            pieces.append(" ")
        if len(stack) >= DEPTH:
            continue
        sure, doubt = (False, 0) if tag in ENDED else _boilerplate(tag, found["attrs"], articles > 0)
        node = Node(tag, stack[-1], len(pieces), sure, doubt=doubt)
        stack.append(node)
        links += tag == "a"
        cut += node.cut
        articles += tag in ("article", "main")
        foreign += tag in FOREIGN
    if at < len(html):
        text(html[at:])
    while len(stack) > 1:
        pop()
    root.last = len(pieces)
    if lifted:
        for node in _walk(root):
            for child in node.children:
                child.parent = node
    return root, pieces


def _cut_named(root: Node, pieces: list[str]) -> None:
    """Cut the elements that are boilerplate by name, unless they hold the text itself.

    Such an element stays if the longest article of the page is in it, or if it holds most of the page's text; one
    whose name is nothing but a word for boilerplate is cut even then where an article has text outside of it. If
    names would leave the page without text, none is cut.
    """
    cut: list[Node] = []
    # Each node with the longest article beside the path to it, and the characters of the outermost article around it.
    todo = [(root, 0, 0)]
    while todo:
        node, beside, around = todo.pop()
        if node.doubt:
            rest = max(beside, around - node.chars)
            holds = 0 < node.article >= rest
            most = 2 * node.chars > root.chars and not (node.doubt == 2 and rest > 0)
            if not holds and not most:
                cut.append(node)
                continue
        if not around and node.tag in ("article", "main"):
            around = node.chars
        first = second = 0
        for child in node.children:
            first, second = max(first, child.article), max(second, min(first, child.article))
        for child in node.children:
            # The longest of the others: of equal ones, the other one is as long.
            todo.append((child, max(beside, second if child.article == first else first), around))
    if not cut or sum(n.chars for n in cut) >= root.chars:
        return
    gone = set(map(id, cut))
    order = list(_walk(root))
    for node in cut:
        pieces[node.first : node.last] = [""] * (node.last - node.first)
    # Counts are taken anew from the innermost elements outwards: what is cut is taken from all elements around it.
    less: dict[int, list[int]] = {}
    for node in reversed(order):
        if id(node) in gone:
            lost = [node.chars, node.link_chars, node.tags + 1, node.link_tags + (node.tag == "a")]
        elif (lost := less.get(id(node))) is not None:
            node.chars -= lost[0]
            node.link_chars -= lost[1]
            node.tags -= lost[2]
            node.link_tags -= lost[3]
            node.children = [c for c in node.children if id(c) not in gone]
        if lost is not None and node.parent is not None:
            known = less.setdefault(id(node.parent), [0, 0, 0, 0])
            for i in range(4):
                known[i] += lost[i]


def _weigh(body: Node) -> list[Node]:
    """Set the composite density of every node below `body`, and list them."""
    nodes, todo = [], [body]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo.extend(node.children)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        if not node.chars:
            continue
        tags, plain = max(1, node.tags), max(1, node.chars - node.link_chars)
        base = log(log(node.chars / plain * node.link_chars + share * node.chars + e) + e - 1)
        ratio = node.chars / max(1, node.link_chars) * tags / max(1, node.link_tags)
        node.density = node.chars / tags * max(0.0, log(max(ratio, 1.0))) / max(base, 1e-9)
    return nodes


def _inside(node: Node, ancestor: Node) -> bool:
    return ancestor.first <= node.first and node.last <= ancestor.last


def main_text(html: str | None) -> str:
    """The article's text: white space folded, blocks joined by one blank, trimmed; empty if there is none."""
    if not html:
        return ""
    root, pieces = parse(html)
    _cut_named(root, pieces)
    body = next((n for n in _walk(root) if n.tag == "body"), root)
    nodes = _weigh(body)
    best = max(nodes, key=lambda n: (sum(c.density for c in n.children), n.density))
    if not best.chars:
        return ""
    path, up = [], best
    while up is not None and up is not body.parent:
        path.append(up)
        up = up.parent
    # A page that names its article is taken at its word: the outermost such element around the densest subtree.
    named = [n for n in path if n.tag in ("article", "main")]
    if named:
        chosen = [named[-1]]
    else:
        least = min(n.density for n in path)
        above = set(map(id, path))
        chosen = [best] + [
            n for n in nodes
            if n.density >= max(least, 1e-9) and id(n) not in above and not _inside(n, best) and n.link_chars * 2 <= n.chars
        ]
    marked = bytearray(len(pieces))
    for node in chosen:
        marked[node.first : node.last] = b"\x01" * (node.last - node.first)
    out = []
    for i, piece in enumerate(pieces):
        if marked[i]:
            out.append(piece)
        elif out and out[-1] != " ":
            out.append(" ")
    return " ".join("".join(out).split())


def _walk(root: Node):
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo.extend(reversed(node.children))


def extract(pages: DataFrame) -> DataFrame:
    """`pages` with text and n_chars (code points) instead of columns of these names; no shuffle.

    Null and empty pages, and pages without any text outside of boilerplate, give the empty text; names of elements
    alone never make a page empty. Content of video, svg and their like is cut up to their end tag; without one they hide nothing. A page that is cut
    off anywhere is read as far as it goes. Elements nested more than 512 deep keep their text but not their own node. Repeated rows come out alike; an empty table stays empty.
    """
    fields = [StructField("text", StringType(), False), StructField("n_chars", LongType(), False)]

    def compute(html: pa.Array) -> list[list]:
        texts = [main_text(h) for h in html.to_pylist()]
        return [texts, [len(t) for t in texts]]

    return add_columns(pages, "html", fields, compute)
