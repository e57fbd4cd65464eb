"""HTML extraction by wrapper induction: the pages of a host are aligned by simple tree matching; what never changes is its template,
what varies is content."""
from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpack.llm import dom
from sparkpack.llm.common import stage

#: Different texts a slot is known by: its SAMPLE smallest hashes, which merge in any order.
SAMPLE = 8
#: Pages, and different pages, from which on a text that never changes counts as template.
EVIDENCE = 4
#: Pages' structures a task holds before it writes what it has.
HELD = 4096
#: Partial templates merged at a time.
FAN = 64

# Elements and names that never hold an article's text.
OUTSIDE = frozenset("""aside audio button canvas datalist dialog footer form head iframe input menu meter nav noframes noscript object
    option progress select svg template textarea title video""".split())
COMMENTS = frozenset("comment comments commentlist disqus discussion replies reply respond".split())
OUTER_WORDS = COMMENTS | frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-share consent
    cookie cookies dropdown footer gdpr hidden login masthead menu modal nav navbar navigation navigational newsletter notice notices
    paginated pagination pager popup promo promotion recommended related search share sharing shopping sidebar signup skip social
    sponsor sponsored subscribe subscription teaser toolbar tracking widget widgets""".split())
#: Names of an article's own element on pages without an article or main element.
ARTICLE_WORDS = frozenset("article articlebody content entry post story".split())
OUTER_ROLES = frozenset("banner navigation complementary contentinfo search form dialog alert hidden".split())


# Templates: [key, pages, hashes, characters, characters in links, children] -----------------------------------------

def _hash(parts: list[str]) -> int:
    text = " ".join(" ".join(parts).split())
    return int.from_bytes(hashlib.md5(text.encode("utf-8", "replace")).digest()[:8], "big") if text else 0


def page_template(fold: dom.Fold) -> list:
    return [fold.key, 1, [_hash(fold.text)], sum(map(len, fold.text)), fold.links, [page_template(k) for k in fold.kids]]


def tree_match(a: list, b: list, memo: dict) -> int:
    """Simple tree matching: the most nodes of two trees that can be paired, keeping ancestors and order."""
    if a[0] != b[0]:
        return 0
    key = (id(a), id(b))
    if key not in memo:
        memo[key] = 1 + _align(a[-1], b[-1], memo)[-1][-1]
    return memo[key]


def _align(a: list, b: list, memo: dict) -> list[list[int]]:
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            own = best[i][j] + tree_match(x, y, memo) if x[0] == y[0] else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], own)
    return best


def pairs(a: list, b: list, memo: dict) -> list[tuple[int, int]]:
    """The children paired by the best match, in order."""
    if [x[0] for x in a] == [y[0] for y in b] and len({x[0] for x in a}) == len(a):
        return [(i, i) for i in range(len(a))]
    best, i, j, out = _align(a, b, memo), len(a), len(b), []
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def merge(into: list, other: list, memo: dict | None = None) -> list:
    """Align two templates of one key; what only one of them has stays, after its left neighbour."""
    memo = {} if memo is None else memo
    found = dict((j, i) for i, j in pairs(into[-1], other[-1], memo))
    into[1] += other[1]
    into[2] = sorted(set(into[2]) | set(other[2]))[:SAMPLE]
    into[3] += other[3]
    into[4] += other[4]
    kids, done = [], 0
    for j, kid in enumerate(other[-1]):
        if j in found:
            kids += into[-1][done: found[j]]
            kids.append(merge(into[-1][found[j]], kid, memo))
            done = found[j] + 1
        else:
            kids.append(kid)
    into[-1] = kids + into[-1][done:]
    return into


def _add_equal(into: list, other: list) -> None:
    """Merge two templates of the same shape."""
    into[1] += other[1]
    if other[2] != into[2]:
        into[2] = sorted(set(into[2]) | set(other[2]))[:SAMPLE]
    into[3] += other[3]
    into[4] += other[4]
    for a, b in zip(into[-1], other[-1]):
        _add_equal(a, b)


_PARTIAL = pa.schema([("host", pa.string()), ("part", pa.string()), ("template", pa.string())])


def _induced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, written = TaskContext.get().partitionId(), 0
    held: dict[tuple[str, str], list] = {}

    def out():
        hosts: dict[str, list] = {}
        for (host, _), tree in sorted(held.items()):
            hosts[host] = merge(hosts[host], tree) if host in hosts else tree
        return pa.RecordBatch.from_arrays([pa.array(list(hosts), pa.string()), pa.array([f"{task}:{written}"] * len(hosts)),
                                           pa.array([json.dumps(t) for t in hosts.values()])], schema=_PARTIAL)

    for batch in batches:
        for host, html in zip(batch.column(0), batch.column(1)):
            fold = dom.compact(dom.parse(html.as_py() or ""))
            at, tree = (host.as_py(), dom.shape(fold)), page_template(fold)
            tree[2] = [_hash([t for f in dom.preorder(fold) for t in f.text])]       # the root knows pages by their whole text
            if at in held:
                _add_equal(held[at], tree)
            else:
                held[at] = tree
        if len(held) >= HELD:
            yield out()
            held, written = {}, written + 1
    if held:
        yield out()


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by host and group: one template at a time."""
    last, tree = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([str(last[1])]), pa.array([json.dumps(tree)])], schema=_PARTIAL)

    for batch in batches:
        for host, group, text in zip(*(c.to_pylist() for c in batch.columns[:3])):
            if (host, group) == last:
                tree = merge(tree, json.loads(text))
            else:
                if last is not None:
                    yield out()
                last, tree = (host, group), json.loads(text)
    if last is not None:
        yield out()


def host_of(url: Column) -> Column:
    """The host in lower case, '' for null or anything without one."""
    return F.coalesce(F.regexp_extract(F.lower(url.cast("string")), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def induce_templates(pages: DataFrame) -> DataFrame:
    """host, template (JSON) from host, html. Every page counts.

    Tasks align what they read; then FAN partial templates at a time meet, in as many rounds as the host with the most of
    them needs, so a host's pages never meet in one task.
    """
    parts = stage(pages.select("host", "html").mapInArrow(_induced, "host string, part string, template string"))
    while True:
        most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return parts.select("host", "template")
        groups = -(-most // FAN)
        some = parts.withColumn("group", F.pmod(F.xxhash64("part"), F.lit(groups)) if groups > 1 else F.lit(0).cast("long"))
        some = some.repartition("host", "group").sortWithinPartitions("host", "group", "part").select("host", "group", "template", "part")
        parts = stage(some.mapInArrow(_merged, "host string, part string, template string"))


# Reading a page by its host's template -----------------------------------------------------------------------------

def _fixed(t: list, pages: list) -> bool:
    """The slot's text never changed while the host's pages did."""
    return len(t[2]) == 1 and t[2][0] != 0 and t[1] >= EVIDENCE and len(pages) >= EVIDENCE


def _as_tree(fold: dom.Fold) -> list:
    return [fold.key, fold, [_as_tree(k) for k in fold.kids]]


def _mark(fold: list, template: list | None, pages: list, memo: dict, marks: dict) -> None:
    """Per node of the page: whether its text is template, and whether it is mostly links."""
    t = template
    marks[id(fold[1])] = (t is not None and _fixed(t, pages), t is not None and 2 * t[4] > t[3] > 0)
    found = {i: j for i, j in pairs(fold[-1], t[-1], memo)} if t is not None else {}
    for i, kid in enumerate(fold[-1]):
        _mark(kid, t[-1][found[i]] if i in found else None, pages, memo, marks)


def _has_article(fold: dom.Fold) -> bool:
    return any(k.node.tag in ("article", "main") or _has_article(k) for k in fold.kids)


def _outside(fold: dom.Fold, in_article: bool) -> bool:
    node = fold.node
    if node.tag in OUTSIDE or not COMMENTS.isdisjoint(node.words) and node.tag != "body":
        return True
    if node.role and not OUTER_ROLES.isdisjoint(node.role.split()):
        return True
    if not in_article and (node.tag == "header" or "header" in node.words) and node.tag not in ("html", "body"):
        return not _has_article(fold)
    if node.tag in ("html", "body", "main", "article"):
        return False
    return not OUTER_WORDS.isdisjoint(node.words) and not _has_article(fold)


#: An article element counts before a main element, that before an element named like one.
REGIONS = ("article", "main", "named")


def _regions(fold: dom.Fold, tag: str) -> list[dom.Fold]:
    if _outside(fold, False):
        return []
    node = fold.node
    if node.tag == tag or tag == "main" and not {"main", "articlebody"}.isdisjoint(node.role.split()):
        return [fold]
    if tag == "named" and node.tag not in ("html", "body") and not ARTICLE_WORDS.isdisjoint(node.words):
        return [fold]
    return [r for k in fold.kids for r in _regions(k, tag)]


def _slots(fold: dom.Fold, in_article: bool) -> list[dom.Fold]:
    """The nodes of a region that may hold its text."""
    out = [fold]
    for k in fold.kids:
        if not _outside(k, in_article):
            out += _slots(k, in_article or k.node.tag in ("article", "main"))
    return out


def _size(folds: list[dom.Fold]) -> int:
    return sum(len(t) for f in folds for t in f.text)


def content_slots(root: dom.Fold, template: list | None) -> set[int]:
    """Preorder numbers of the nodes whose own text is content.

    Within the page's article (or main part) all slots that vary; on pages without one, all varying slots of the page but
    those of mostly links. If nothing varies there is nothing to tell them apart by, and every slot counts.
    """
    marks: dict[int, tuple[bool, bool]] = {}
    _mark(_as_tree(root), template, template[2] if template else [], {}, marks)
    whole = _slots(root, False)
    inside: list[dom.Fold] = []
    for tag in REGIONS:
        inside = [f for r in _regions(root, tag) for f in _slots(r, True)]
        if 4 * _size(inside) >= _size(whole) and _size(inside):
            break
    else:
        inside = []
    if inside:
        kept = [f for f in inside if not marks[id(f)][0]]
        kept = kept if _size(kept) else inside
    else:
        kept = [f for f in whole if marks[id(f)] == (False, False)]
        kept = kept if _size(kept) else [f for f in whole if not marks[id(f)][1]]
    use = {id(f) for f in kept}
    return {i for i, f in enumerate(dom.preorder(root)) if id(f) in use}


def page_text(root: dom.Node, kept: set[int]) -> str:
    """The text of the kept nodes: one space for white space inside a block, blocks joined by an empty line."""
    number = {id(f): i for i, f in enumerate(dom.preorder(root.fold))}
    blocks: list[str] = []
    line: list[str] = []

    def end():
        words = " ".join("".join(line).split())
        if words:
            blocks.append(words)
        line.clear()

    def walk(node: dom.Node, use: bool):
        for kid in node.kids:
            if isinstance(kid, str):
                if use:
                    line.append(kid)
            elif kid.tag == "br":
                line.append(" ")
            else:
                breaks = kid.tag in dom.BLOCK
                if breaks:
                    end()
                walk(kid, number[id(kid.fold)] in kept)
                if breaks:
                    end()

    walk(root, 0 in kept)
    end()
    return "\n\n".join(blocks)


def _extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    host, template, known = None, None, {}
    for batch in batches:
        texts = []
        for own, html, tree in zip(batch.column(2), batch.column(3), batch.column(4)):
            own = own.as_py()
            root = dom.parse(html.as_py() or "")
            fold = dom.compact(root)
            if own not in known:
                if len(known) >= 256:
                    known.clear()
                known[own] = (json.loads(tree.as_py()) if tree.is_valid else None, {})
            template, shapes = known[own]
            # which region a page of this shape has also depends on where its text stands
            at = (dom.shape(fold), tuple(bool(f.text) for f in dom.preorder(fold)), _share(fold))
            if at not in shapes:
                if len(shapes) >= 1024:
                    shapes.clear()
                shapes[at] = content_slots(fold, template)
            texts.append(page_text(root, shapes[at]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _share(root: dom.Fold) -> tuple:
    whole = _size(_slots(root, False))
    return tuple(4 * s >= whole and s > 0 for s in (_size([f for r in _regions(root, t) for f in _slots(r, True)]) for t in REGIONS))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page: its main text by its host's template.

    Null html is an empty page, null or odd urls share the host ''. Hosts with few or equal pages give no evidence; then only
    the elements and names decide what belongs to the article. Repeated rows count and appear each, other columns are ignored,
    no pages give no rows.

    Templates are one row a host and meet the pages by an ordinary join, which Spark broadcasts below its threshold and splits
    at hot hosts above it.
    """
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host_of(F.col("url")).alias("host"),
                        F.col("html").cast("string").alias("html"))
    templates = induce_templates(slim).select(F.col("host").alias("_host"), "template")
    both = slim.join(templates, F.col("host") == F.col("_host"), "left").select("page_id", "url", "host", "html", "template")
    out = both.mapInArrow(_extracted, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
