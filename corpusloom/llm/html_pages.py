"""The main text of web pages, by wrapper induction.

For each host a few pages are taken and their DOM trees aligned by simple tree
matching. A node that is the same in all of them belongs to the host's
template; one that is matched but varies, or is in some pages only, is a slot.
From the root down, the wrapper goes into the element that holds most of the
varying text, links not counted, until no child does: that is where the content
lies, and every page of the host is read there, without template nodes and
without elements that by name or class are no part of an article. Names are
votes: what lies around the content is never left out by them. Semantic
elements (article, main) decide only on hosts without a wrapper, as those of
one page, and on pages without the wrapper's element.
"""

from __future__ import annotations

import html as htmllib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import only, prepare, staged
from corpusloom.llm.components import run_groups, small_or_shuffled

#: Pages of a host that its wrapper is induced from, at most, those up to SAMPLE_CHARS first.
SAMPLE, SAMPLE_CHARS = 8, 200_000
#: Blocks and depth up to which trees are aligned by tree matching; larger ones are aligned path by path, in linear time.
MATCH_NODES, MATCH_DEPTH = 1500, 120
#: Hosts up to which the wrappers are broadcast.
BROADCAST_HOSTS = 5_000
#: Hosts' pages in a task where wrappers are too many to be broadcast.
HOST_PAGES = 2_000
#: Pages that share more than this part of their article, or the only two of a host of all their text, are no evidence on what is template.
SAME_ARTICLE, SAME_PAGE = 0.5, 0.8
#: Pairs of pages needed to call a node within the content template, the first if the content is an article; what part of the varying text leads into an element.
ARTICLE_PAIRS, PAIRS, MOST = 4, 2, 0.6

#: Fixed values of HTML: elements without end, blocks, elements whose text is no text, and what ends an open element.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg math".split())
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "legend", "summary"}
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
#: Elements, and words in a class, id or role, that are no part of an article; the last ones only say so.
OUT_TAGS = frozenset("nav footer aside button select dialog menu object canvas audio video head".split())
VOTING_TAGS = frozenset(["form"])
OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navigation navbar menu breadcrumb breadcrumbs "
    "footer sidebar widget cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "comment comments commentlist disqus respond reply replies share sharing social related recommended toolbar pagination pager copyright skip "
    "contentinfo complementary search dialog".split()
)
#: Words that name reader comments, and words after which a name says what an element has or lacks, not what it is.
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
MODIFIERS = frozenset("has have no not non with without w is if hide hides hidden show shows toggle supports enable enabled disable disabled open closed allow".split())
#: An element that its name would leave out stays if it holds more than HOLDS of a page's text and all that no name speaks against has less than SPARE.
HOLDS, SPARE = 0.5, 0.25
#: Those only outside an article.
PAGE_TAGS, PAGE_WORDS = frozenset(["header"]), frozenset("header masthead topbar banner site-header".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[^a-z0-9]+")


class Node:
    """An element: its name with class or id, its own text and how much of it is in links, its children, whether it is left out or lies in an article, and what its names say.

    ``vote`` is 1 if the names are those of something other than an article, 2 if of comments.

    ``path`` has the names from the root; ``place`` also which of the children of that name each is.
    """

    __slots__ = ("tag", "name", "parent", "children", "text", "linked", "out", "article", "vote", "path", "place", "kinds")

    def __init__(self, tag: str, name: str, parent: "Node | None", out: bool, article: bool, vote: int = 0):
        self.tag, self.name, self.parent, self.children, self.text, self.linked, self.out, self.article, self.kinds, self.vote = tag, name, parent, [], [], 0, out, article, {}, vote
        self.path = self.place = hash64(f"{parent.path if parent else 0}/{name}")
        if parent:
            parent.kinds[name] = nth = parent.kinds.get(name, 0) + 1
            self.place = hash64(f"{parent.place}/{name}/{nth}")


def hash64(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _names(value: str) -> set[str]:
    """The words of a class, id or role; of each name only those before a modifier."""
    out: set[str] = set()
    for name in value.split():
        for word in _WORD.split(name):
            if word in MODIFIERS:
                break
            out.add(word)
    return out


def _element(tag: str, attributes: str, parent: Node) -> Node:
    article, out, name = parent.article, parent.out or tag in OUT_TAGS, tag
    words: set[str] = set()
    role = False
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key = key.lower()
            value = value.strip("\"'").lower()
            if key in ("class", "id", "role"):
                words |= _names(value)
                role = role or key == "role" and value.strip() == "main"
                if key != "role" and value:
                    name += "." + " ".join([w for w in _WORD.split(value) if not any(map(str.isdigit, w))][:3])
            elif key == "hidden" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) or key == "aria-hidden" and value == "true":
                out = True
    vote = 0
    if tag not in ("body", "html"):
        vote = 2 if words & COMMENTS else int(tag in VOTING_TAGS or bool(words & OUT_WORDS) or not article and bool(words & PAGE_WORDS))
    if not article:
        out = out or tag in PAGE_TAGS
        article = not out and (tag in ("article", "main") or role)
    return Node(tag, name, parent, out, article, vote)


def _settle(root: Node) -> None:
    """Leave out what the names speak against, but not what the content lies in.

    That is the main element or the largest article; where there is neither,
    an element with most of the text, if hardly any is left without it.
    """
    every = nodes(root)
    weight: dict[int, int] = {}
    for node in reversed(every):
        own = 0 if node.out else max(0, sum(map(len, node.text)) - node.linked)
        weight[id(node)] = own + sum(weight[id(c)] for c in node.children)
    content = [n for n in every if n.article and not n.out and (n.parent is None or not n.parent.article)]
    total, spoken, said = weight[id(root)], 0, 0
    under: dict[int, int] = {}
    for node in every:
        within = under[id(node.parent)] if node.parent is not None else 0
        under[id(node)] = max(within, node.vote)
        spoken += weight[id(node)] if node.vote and not within else 0
        said += weight[id(node)] if node.vote == 2 and within < 2 else 0
    spare = total - spoken < SPARE * total
    named = [n for n in content if n.vote < 2] or (content if total - said < SPARE * total else [])  # an article called a comment only where there is hardly anything else
    chosen = max(named, key=lambda n: (n.tag != "article", weight[id(n)]), default=None)
    around: set[int] = set()
    while chosen is not None:
        around.add(id(chosen))
        chosen = chosen.parent
    for node in every:
        if node.parent is not None and node.parent.out:
            node.out = True
        if node.vote and not node.out and id(node) not in around and not (node.vote == 1 and spare and weight[id(node)] > HOLDS * total):
            node.out = True
        if node.out:
            node.article = False


def parse(source: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The tree, and the blocks of text in page order with the block element that each is in."""
    root = Node("", "", None, False, False)
    stack, blocks, held = [root], [], []
    owner, anchors, linked = root, 0, 0

    def flush() -> None:
        nonlocal held, linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                blocks.append((owner, text))
                owner.text.append(text)
                owner.linked += min(linked, len(text))
            held = []
        linked = 0

    def close(upto: int) -> None:
        nonlocal owner, anchors
        while len(stack) > upto:
            gone = stack.pop()
            anchors -= gone.tag == "a"
            if gone.tag in BLOCKS or gone.vote:
                flush()
                owner = next(n for n in reversed(stack) if n.tag in BLOCKS or n.vote or n is root)

    position, size = 0, len(source)
    while position < size:
        m = _TOKEN.match(source, position)
        position = m.end()
        tag = m[2]
        if tag is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                if not stack[-1].out:
                    held.append(htmllib.unescape(token) if "&" in token else token)
                    linked += len(held[-1]) if anchors else 0
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag not in BLOCKS and stack[i].tag in BLOCKS:
                    break  # an inline end tag closes nothing beyond its block
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, position)
            position = end.end() if end else size
            continue
        if tag in ("br", "wbr"):
            held.append(" " if tag == "br" else "")
            continue
        if tag in BLOCKS:
            if tag in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        close(i)
                        break
                    if stack[i].tag in BLOCKS:
                        break
            if tag in ENDS:
                ended, scope = ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in scope:
                        break
                    if stack[i].tag in ended:
                        close(i)
            flush()
        if tag in VOID:
            if tag in BLOCKS:
                flush()
            continue
        if tag in ("html", "body") and any(n.tag == tag for n in stack):
            continue
        node = _element(tag, m[3], stack[-1])
        if node.tag in BLOCKS or node.out or node.vote:
            stack[-1].children.append(node)
            if tag not in BLOCKS:
                flush()
        stack.append(node)
        anchors += tag == "a"
        if tag in BLOCKS or node.vote:
            owner = node
    close(1)
    flush()
    _settle(root)
    return root, blocks


def match_trees(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of nodes in the largest order-preserving match of two trees (simple tree matching)."""
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def score(x: Node, y: Node) -> int:
        if x.name != y.name:
            return 0
        if not x.children or not y.children:
            return 1 + (x.text == y.text)
        key = (id(x), id(y))
        if key not in memo:
            m = [[0] * (len(y.children) + 1)]
            for i, p in enumerate(x.children, 1):
                row, above = [0], m[-1]
                for j, q in enumerate(y.children, 1):
                    row.append(max(above[j], row[j - 1], above[j - 1] + score(p, q)))
                m.append(row)
            memo[key] = (1 + m[-1][-1], m)
        return memo[key][0]

    pairs, todo = [], [(a, b)]
    score(a, b)
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        if x.children and y.children:
            m = memo[id(x), id(y)][1]
            i, j = len(x.children), len(y.children)
            while i and j:
                if m[i][j] == m[i - 1][j]:
                    i -= 1
                elif m[i][j] == m[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    todo.append((x.children[i], y.children[j]))
    return pairs


def match_paths(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of nodes with the same path: those with equal texts first, the rest in page order. Linear, for large trees."""
    waiting: dict[int, dict[tuple, list[Node]]] = {}
    for y in nodes(b):
        waiting.setdefault(y.path, {}).setdefault(tuple(y.text), []).append(y)
    pairs, rest = [], []
    for x in nodes(a):
        if equal := waiting.get(x.path, {}).get(tuple(x.text)):
            pairs.append((x, equal.pop(0) if len(equal) < 64 else equal.pop()))
        else:
            rest.append(x)
    left = {path: iter([y for kind in kinds.values() for y in kind]) for path, kinds in waiting.items()}
    pairs += [(x, y) for x in rest if (y := next(left.get(x.path, iter(())), None)) is not None]
    return pairs


def nodes(root: Node) -> list[Node]:
    """All elements, each after its parent and in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node.children)
    return out


def _matchable(root: Node) -> bool:
    every, depth = nodes(root), {}
    for node in every:
        depth[id(node)] = depth.get(id(node.parent), -1) + 1
    return len(every) <= MATCH_NODES and max(depth.values()) <= MATCH_DEPTH


def mark(node: Node, text: str) -> int:
    return hash64(f"{node.path}|{text}")


def _copies(pairs: list[tuple[Node, Node]], only: bool) -> bool:
    """Whether two pages, ``only`` the two of a host, tell the same, so that what they share is no evidence of a template."""
    size = lambda x: sum(map(len, x.text))
    inside = [(x, y) for x, y in pairs if x.article]
    for some, most in ((inside, SAME_ARTICLE), (pairs, SAME_PAGE if only else 1.0)):
        total = sum(size(x) for x, _ in some)
        if total:
            return sum(size(x) for x, y in some if x.text == y.text) > most * total
    return False


def induce(pages: list[str]) -> tuple[list[int], int | None, int | None]:
    """A host's wrapper: marks of template texts, the place of the content's element, and of the element above it."""
    trees = [parse(p)[0] for p in dict.fromkeys(pages)]
    if len(trees) < 2:
        return [], None, None
    base, small = trees[0], [_matchable(t) for t in trees]
    apart, same, evidence = 0, {}, [base]
    for other, fits in zip(trees[1:], small[1:], strict=True):
        pairs = match_trees(base, other) if fits and small[0] else match_paths(base, other)
        if _copies(pairs, len(trees) == 2):
            continue
        apart += 1
        evidence.append(other)
        for x, y in pairs:
            if x.text and x.text == y.text:
                same[id(x)] = (x, same.get(id(x), (x, 0))[1] + 1)
    if not apart:
        return [], None, None
    constant = [x for x, n in same.values() if n == apart]
    template = {mark(x, t) for x in constant for t in x.text}
    slot = _content(evidence, template)
    inside = {mark(x, t) for x in constant for t in x.text if slot is None or _under(x, slot.place)}
    marks = template if apart >= (ARTICLE_PAIRS if slot and slot.article else PAIRS) else template - inside
    return sorted(marks), slot and slot.place, slot and slot.parent and slot.parent.place


def _content(trees: list[Node], template: set[int]) -> Node | None:
    """The element that most of the varying text leads to; an article as a whole."""
    mass: dict[int, int] = {}
    below: dict[int, dict[int, Node]] = {}
    for tree in trees:
        weight: dict[int, int] = {}
        for node in reversed(nodes(tree)):
            own = 0 if node.out else max(0, sum(len(t) for t in node.text if mark(node, t) not in template) - node.linked)
            weight[id(node)] = total = own + sum(weight[id(c)] for c in node.children)
            mass[node.place] = mass.get(node.place, 0) + total
            kids = below.setdefault(node.place, {})
            for c in node.children:
                kids.setdefault(c.place, c)
    found, here = None, trees[0].place
    while mass[here] and not (found and found.article):
        place = max(below[here], key=lambda p: (mass[p], p), default=None)
        if place is None or mass[place] < MOST * mass[here] or not (below[place] or below[here][place].article):
            break
        found, here = below[here][place], place
    return found if found and found.tag not in ("html", "body") else None


def main_text(source: str, marks: frozenset, slot: int | None, above: int | None = None) -> str:
    """The blocks of a page's article, one to a line."""
    blocks = [(n, t) for n, t in parse(source)[1] if not n.out]
    if slot is not None:
        inside = [_under(n, slot) for n, _ in blocks]
        if any(inside):
            first = inside.index(True)
            return "\n".join(t for i, (n, t) in enumerate(blocks) if mark(n, t) not in marks and (inside[i] or i < first and n.tag in HEADINGS and n.parent and n.parent.place == above))
    blocks = [(n, t) for n, t in blocks if mark(n, t) not in marks] if marks else blocks
    return "\n".join([t for n, t in blocks if n.article] or [t for _, t in blocks])


def _under(node: Node | None, place: int) -> bool:
    while node is not None:
        if node.place == place:
            return True
        node = node.parent
    return False


def _host(url: Column) -> Column:
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)


_WRAPPERS = pa.schema([("host", pa.string()), ("marks", pa.list_(pa.int64())), ("slot", pa.int64()), ("above", pa.int64())])


def wrappers(pages: DataFrame) -> DataFrame:
    """A wrapper (host, marks, slot, above) for each host, from SAMPLE of its pages, first by a hash of page_id, or all where it has fewer."""
    thin = pages.filter("page_id is not null").select("host", "page_id", (F.length("html") > SAMPLE_CHARS).alias("_large")).distinct()
    thin = thin.withColumn("_salt", F.pmod(F.xxhash64("page_id"), F.lit(64)))  # a large host is thinned out in 64 tasks first
    order = ["_large", F.xxhash64("page_id", F.lit(9)), F.col("page_id")]
    some = thin.withColumn("_n", F.row_number().over(Window.partitionBy("host", "_salt").orderBy(*order))).filter(F.col("_n") <= SAMPLE)
    picked = some.withColumn("_n", F.row_number().over(Window.partitionBy("host").orderBy(*order))).filter(F.col("_n") <= SAMPLE)
    ids = staged(picked.select(F.col("page_id").alias("_id")), "sample").distinct()
    sample = pages.join(small_or_shuffled(ids), F.col("page_id") == F.col("_id"), "left_semi")
    sample = sample.groupBy("host", "page_id").agg(F.min("html").alias("html"))

    def work(group: dict[str, list]) -> list[tuple]:
        order = np.argsort(np.array(group["page_id"]), kind="stable")
        return [(group["host"][0], *induce([group["html"][i] for i in order]))]

    return staged(run_groups(sample.select("host", "page_id", "html"), ["host"], work, _WRAPPERS), "wrappers")


def _with_wrappers(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Pages with the wrapper of their host: broadcast if a count shows few hosts, else joined on blocks of a host's pages."""
    known = known.withColumnRenamed("host", "_host")
    if known.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        return rows.join(F.broadcast(known), F.col("host") == F.col("_host"), "left")
    sizes = rows.groupBy(F.col("host").alias("_h")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOST_PAGES)
    sizes = sizes.select("_h", F.ceil(F.col("n") / HOST_PAGES).cast("int").alias("_blocks"))
    large = small_or_shuffled(staged(sizes, "hosts"))
    dealt = rows.join(large, F.col("host") == F.col("_h"), "left").drop("_h")
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("_blocks", F.lit(1))).cast("int"))
    known = known.join(large, F.col("_host") == F.col("_h"), "left")
    known = known.withColumn("_b", F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1))).drop("_h", "_blocks")
    return dealt.join(known, (F.col("host") == F.col("_host")) & (F.col("_block") == F.col("_b")), "left")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of each page: page_id, url, text, n_chars.

    Null html counts as empty and gives an empty text; pages without a host in their url share one
    wrapper; rows with equal ids give a row each, and one of them may be in a
    sample; a page is read as a whole, however long; other columns are ignored.
    """
    prepare(pages.sparkSession)
    rows = only(pages, page_id=id_col, url=url_col, html=html_col).withColumn("host", _host(F.col("url")))
    known = wrappers(rows.filter("html is not null"))

    @F.pandas_udf("string")
    def text(html: pd.Series, marks: pd.Series, slot: pd.Series, above: pd.Series) -> pd.Series:
        out, sets = [], {}
        for source, m, *ends in zip(html, marks, slot, above, strict=True):
            key = () if m is None else tuple(m)
            if key not in sets:
                sets[key] = frozenset(key)
            out.append(main_text(source or "", sets[key], *[None if e is None else int(e) for e in ends]))
        return pd.Series(out, dtype=object)

    ends = [F.col(c).cast("string") for c in ("slot", "above")]  # nullable longs would become floats in pandas
    done = _with_wrappers(rows, known).select("page_id", "url", text("html", "marks", *ends).alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))
