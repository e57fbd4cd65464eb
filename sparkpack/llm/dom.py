"""A small DOM for messy pages, and its compact form: sibling runs of one kind folded, plain inline markup dissolved."""
from __future__ import annotations

import re
from html.parser import HTMLParser

# Fixed values of HTML: elements without an end tag, elements that break a line of text, elements whose start ends a paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td
    tfoot th thead title tr ul""".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
RAW = frozenset(["script", "style"])
#: A start tag of the key ends the nearest open element of the set, unless one of the bounds is nearer.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
P_BOUNDS = frozenset(["button", "td", "th", "caption", "html", "object", "table", "template"])

#: Deeper elements join the text of their ancestor at this depth.
DEPTH = 60
#: Children of different kinds a node keeps in order; beyond that equal kinds are folded wherever they stand.
WIDE = 32

_WORD = re.compile("[a-z]+")
_CAMEL = re.compile("(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "key", "words", "role", "kids", "fold")

    def __init__(self, tag: str, attrs=()):
        self.tag, self.kids, self.fold, self.words, self.role = tag, [], None, (), ""
        for name, value in attrs:
            value = value or ""
            if name in ("class", "id"):
                self.words += tuple(t for part in value.split() if not any(c.isdigit() for c in part) or name == "id"
                                    for t in _WORD.findall(_CAMEL.sub(" ", part).lower()))
            elif name == "role" or name == "itemprop":
                self.role += f" {value.lower()}"
            elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                self.role += " hidden"
        self.key = tag if not (self.words or self.role) else ".".join((tag, *sorted(set(self.words)), *_WORD.findall(self.role)))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page")
        self.stack, self.raw = [self.root], 0

    def _end_nearest(self, tags, bounds) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                del self.stack[i:]
                return
            if self.stack[i].tag in bounds:
                return

    def handle_starttag(self, tag, attrs):
        if tag in RAW:
            self.raw = 1
            return
        if tag in BLOCK:
            self._end_nearest({"p"}, P_BOUNDS)
        if tag in ENDS:
            self._end_nearest(*ENDS[tag])
        node = Node(re.sub("[^a-z0-9]", "-", tag), attrs)
        self.stack[-1].kids.append(node)
        if tag not in VOID and len(self.stack) < DEPTH:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in RAW:
            self.raw = 0
            return
        tag = re.sub("[^a-z0-9]", "-", tag)
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        if not self.raw:
            self.stack[-1].kids.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


class Fold:
    """A node of the compact tree: stands for sibling elements of one kind."""
    __slots__ = ("node", "key", "text", "links", "kids", "keep")

    def __init__(self, node: Node):
        self.node, self.key, self.text, self.links, self.kids, self.keep = node, node.key, [], 0, [], True


def _fill(fold: Fold, node: Node, in_link: bool) -> None:
    node.fold = fold
    for kid in node.kids:
        if isinstance(kid, str):
            if kid.strip():
                fold.text.append(kid)
                fold.links += len(kid) if in_link else 0
        elif kid.key in INLINE or kid.key == "br":
            _fill(fold, kid, in_link or kid.tag == "a")
        elif kid.tag == "a":
            _fill(_child(fold, kid), kid, True)
        else:
            _fill(_child(fold, kid), kid, in_link)


def _child(fold: Fold, kid: Node) -> Fold:
    if fold.kids and fold.kids[-1].key == kid.key:
        return fold.kids[-1]
    if len(fold.kids) >= WIDE:
        for other in fold.kids:
            if other.key == kid.key:
                return other
    fold.kids.append(Fold(kid))
    return fold.kids[-1]


def compact(root: Node) -> Fold:
    fold = Fold(root)
    _fill(fold, root, False)
    return fold


def shape(fold: Fold) -> str:
    """The structure without texts."""
    return f"{fold.key}({','.join(map(shape, fold.kids))})" if fold.kids else fold.key


def preorder(fold: Fold) -> list[Fold]:
    out = [fold]
    for kid in fold.kids:
        out += preorder(kid)
    return out
