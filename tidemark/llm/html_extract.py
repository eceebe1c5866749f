"""Main text of web pages by tree scoring.

Each page is parsed into a tree of elements.  Every paragraph passes points to its
ancestors: one, one per comma and one per hundred characters (three at most), in full
to its parent, half to the grandparent and less further up.  An element's score is
multiplied by the share of its text that is not link text.  The best container is the
article; siblings that score well, and the blocks beside it that are not links, are kept
with it.  Elements that never hold article text are cut from the tree first, by tag
(menus, forms, scripts and the like), role or hiding.  Class and id words only raise a
doubt: a doubted element stays if other names of it speak for article text, if it holds
an article of weight, or if it holds more prose than all that nobody doubts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: elements without content, blocks, and those whose text is not prose.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CUT = frozenset(
    "script style noscript template nav header footer aside button select textarea input svg canvas iframe object embed "
    "dialog menu head title video audio map search".split()
)
#: Start tags that close an open paragraph, and elements that close an open one of their kind.
_SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table select div article section body td th blockquote".split())
_ENDS_PARAGRAPH = BLOCKS - {"p"}
_PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6".split())
#: What stands in an article beside its main container.
_BESIDE = _PARAGRAPHS | frozenset("ul ol dl table figure hgroup".split())
_UNLIKELY = re.compile(
    r"\b(?:ads?|advert\w*|banner|breadcrumbs?|combx|comments?|cookie\w*|consent|disqus|disclaimer|footer|footnote|gdpr|header|menu|masthead|modal|"
    r"nav\w*|newsletter|notice|outbrain|pager|pagination|popup|promo\w*|related|replies|reply|remark|rss|share|sharing|shoutbox|sidebar|skyscraper|"
    r"social|sponsor\w*|subscribe|tags|toolbar|widget|alert)\b"
)
#: `with-sidebar` is not the sidebar.
_BESIDES = re.compile(r"\b(?:with|has|no|without) .*")
#: Words for what readers wrote; more prose than the article's does not make it the article.
_REPLIES = re.compile(r"\b(?:comments?|disqus|replies|reply)\b")
_LIKELY = re.compile(r"\b(?:article|body|content|main|post|entry|story|text)\b")
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_SENTENCES = 80
_ARTICLE_SHARE = 0.2
_SHARES = (1.0, 0.5, 0.25, 0.125)


class Node:
    __slots__ = ("tag", "parent", "children", "score", "cut", "doubt", "length", "linked", "likely", "prose", "article")

    def __init__(self, tag: str, parent: "Node | None", cut: bool = False, likely: bool = False, doubt: str = ""):
        self.tag, self.parent, self.cut, self.likely, self.doubt = tag, parent, cut, likely, doubt
        self.children: list[Node | str] = []
        self.score, self.length, self.linked, self.prose, self.article = 0.0, 0, 0, 0.0, 0.0


def _spoken_for(names: list[str]) -> bool:
    """Whether one whole name, such as `content` or `main-text`, stands for article text: `post-tags` and `main-menu` do not."""
    return any(_LIKELY.fullmatch(name.split(" ")[-1]) and not _UNLIKELY.search(name) for name in names)


def _cut(tag: str, attributes: dict[str, str | None]) -> tuple[bool, bool, str, bool]:
    """(whether the element never holds article text, whether its names speak for article text, the words that raise a doubt, whether it is an article by tag)."""
    parts = f"{attributes.get('class') or ''} {attributes.get('id') or ''}".split()
    parts = [re.sub(r"[-_]+", " ", re.sub(r"([a-z])([A-Z])", r"\1 \2", part)).strip().lower() for part in parts]
    parts = [_BESIDES.sub("", part) for part in parts]
    names = " ".join(parts)
    likely = bool(_LIKELY.search(names)) or tag in ("article", "main")
    hidden = "hidden" in attributes or "display:none" in (attributes.get("style") or "").replace(" ", "").lower()
    if tag in ("html", "body"):
        return False, False, "", False
    # Some pages stand in one form, or are hidden from readers aloud while a dialog is open.
    wrapper = tag == "form" or (attributes.get("aria-hidden") or "") == "true"
    unlikely = tag in CUT or (attributes.get("role") or "").lower() in _ROLES or hidden
    doubted, article = bool(_UNLIKELY.search(names)), tag in ("article", "main")
    doubt = names if doubted and not article and not _spoken_for(parts) else ""
    return unlikely, likely, f"{doubt} wrapper" if wrapper else doubt, article and not doubted


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("#root", None)
        # The open elements from the root down, and for each tag the places of its own among them.
        self.path, self.places = [self.root], {}

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._close_paragraph()
        for kind in _SELF_CLOSING.get(tag, ()):
            self._close(kind, _SCOPES - {kind})
        if tag == "br":
            self.here.children.append(" ")
        if tag in VOID:
            return
        cut, likely, doubt, article = _cut(tag, dict(attrs))
        node = Node(tag, self.here, cut or self.here.cut, likely, doubt)
        node.article = float(article)
        self.here.children.append(node)
        self.here = node
        self.places.setdefault(tag, []).append(len(self.path))
        self.path.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "p" or tag in VOID:
            self._close_paragraph()
            return
        self._close(tag, frozenset() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data):
        self.here.children.append(data)

    def _close_paragraph(self) -> None:
        """A paragraph ends at the next block; inline elements left open in it end too."""
        self._close("p", _ENDS_PARAGRAPH)

    def _close(self, tag: str, barriers: frozenset[str]) -> None:
        """End the innermost open element of the tag, unless one of the barriers is open within it."""
        own = self.places.get(tag)
        if not own or any(self.places[b][-1] > own[-1] for b in barriers if self.places.get(b)):
            return
        for node in self.path[own[-1] :][::-1]:
            self.places[node.tag].pop()
            self.path.pop()
        self.here = self.path[-1]


def _blocks(top: Node) -> Iterator[tuple[Node, str, float]]:
    """(nearest block, its text between other blocks with white space as one space, share of link text), in page order."""
    parts: list[str] = []
    links: list[str] = []
    owner = top

    def flush() -> Iterator[tuple[Node, str, float]]:
        text = " ".join("".join(parts).split())
        linked = len(" ".join("".join(links).split()))
        parts.clear()
        links.clear()
        if text:
            yield owner, text, min(linked / len(text), 1.0)

    stack: list[tuple[Node, int, Node, bool]] = [(top, 0, top, False)]
    while stack:
        node, at, block, linked = stack.pop()
        if at < len(node.children):
            stack.append((node, at + 1, block, linked))
            child = node.children[at]
            if isinstance(child, str):
                owner = block
                parts.append(child)
                if linked:
                    links.append(child)
            elif not child.cut:
                inner = child if child.tag in BLOCKS else block
                if inner is child:
                    yield from flush()
                stack.append((child, 0, inner, linked or child.tag == "a"))
        elif node.tag in BLOCKS or not stack:
            owner = block
            yield from flush()


def _points(text: str) -> float:
    return 1 + text.count(",") + min(len(text) / 100, 3)


def _settle_doubts(top: Node) -> None:
    """Cuts the doubted elements that are not article text, with all they hold.

    From the outside in: what a kept element holds without further doubts counts for the
    undoubted prose that the doubted elements within it are held against.
    """
    order, stack = [], [top]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node) and not c.cut]
    if not any(node.doubt for node in order):
        return
    _measure(top)
    blocks = [(block, text, _points(text) * (1 - _link_density(block))) for block, text, _ in _blocks(top)]
    sentences = any(len(text) > _SENTENCES for _, text, _ in blocks)
    for block, text, points in blocks:
        block.prose += points if len(text) > _SENTENCES or not sentences else 0.0
    own = {id(node): node.prose for node in order}
    articles = {id(node) for node in order if node.article}
    for node in order:
        node.article = 0.0
    for node in reversed(order):
        if id(node) in articles:
            node.article = max(node.article, node.prose)
        if node.parent is not None and node is not top:
            node.parent.prose += node.prose
            node.parent.article = max(node.parent.article, node.article)
    least = _ARTICLE_SHARE * top.article

    def within(start: Node) -> tuple[float, list[Node]]:
        """Prose under start without doubts, and the outermost doubted elements."""
        clear, doubted, stack = 0.0, [], [start]
        while stack:
            node = stack.pop()
            clear += own[id(node)]
            for child in node.children:
                if isinstance(child, Node) and not child.cut:
                    (doubted if child.doubt else stack).append(child)
        return clear, doubted

    clear, doubted = within(top)
    while doubted:
        kept = [
            node for node in doubted
            if node.article and node.article >= least or node.prose > clear and (clear == 0 or not _REPLIES.search(node.doubt))
        ]
        staying = {id(node) for node in kept}
        for node in doubted:
            node.cut = id(node) not in staying
        doubted = []
        for node in kept:
            more, inner = within(node)
            clear += more
            doubted += inner
    for node in order:
        node.length = node.linked = 0


def _measure(top: Node) -> None:
    """Length of text and of link text of every element."""
    order, stack = [], [(top, False)]
    while stack:
        node, linked = stack.pop()
        linked = linked or node.tag == "a"
        order.append(node)
        for child in node.children:
            if isinstance(child, str):
                size = len("".join(child.split()))
                node.length += size
                node.linked += size * linked
            elif not child.cut:
                stack.append((child, linked))
    for node in reversed(order):
        if node.parent is not None and node is not top:
            node.parent.length += node.length
            node.parent.linked += node.linked


def _link_density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def main_text(html: str) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    root = builder.root
    _settle_doubts(root)
    _measure(root)
    texts: dict[int, list[str]] = {}
    scored: dict[int, Node] = {}
    for block, text, _ in list(_blocks(root)):
        texts.setdefault(id(block), []).append(text)
        points = _points(text) * (1 - _link_density(block))
        holder = block.parent if block.tag in _PARAGRAPHS and block.parent is not None else block
        for share in _SHARES:
            if holder is None:
                break
            holder.score += points * share
            scored[id(holder)] = holder
            holder = holder.parent
    if not scored:
        return ""
    worth = lambda node: (node.score * (1.25 if node.likely else 1.0)) * (1 - _link_density(node))
    best = max(scored.values(), key=worth)
    if best.tag == "p" and best.parent is not None:
        best = best.parent
    return "\n\n".join(_article_texts(best, worth))


def _article_texts(best: Node, worth) -> list[str]:
    """Texts of the best container and of what belongs to the article beside it, in page order."""
    least = max(1.0, 0.2 * worth(best))
    if best.parent is None or best.tag in ("article", "main", "body", "html"):
        beside = [best] if best.parent is None else best.parent.children
        kept = [c for c in beside if c is best or isinstance(c, Node) and not c.cut and c.tag == best.tag and worth(c) >= least]
        return [text for node in kept for _, text, _ in _blocks(node)]
    whole = best.parent
    while whole is not None and whole.tag != "article":
        whole = whole.parent
    whole = whole or best.parent
    loose = whole.tag in ("article", "main") or whole.likely
    above, node = set(), best
    while node is not whole:
        node = node.parent
        above.add(id(node))
    verdict: dict[int, bool | None] = {id(best): True}

    def belongs(block: Node) -> bool | None:
        """Of the element beside the best container: True for all its text, None for what is not links, False for nothing."""
        path = []
        while id(block) not in verdict and id(block) not in above:
            path.append(block)
            block = block.parent
        found = verdict.get(id(block))
        if path and id(block) in above:
            beside = path[-1]
            found = True if worth(beside) >= least else None if loose or beside.tag in _BESIDE else False
        for node in path:
            verdict[id(node)] = found
        return found

    every = [(belongs(block), text, linked) for block, text, linked in _blocks(whole)]
    return [text for found, text, linked in every if found or found is None and linked < 0.5]


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    Null html counts as empty; pages without text give the empty string and 0.  Blocks are
    joined by an empty line.  Unclosed and truncated markup is read as far as it goes.
    Repeated rows and null ids each keep a row; other columns are ignored; an empty
    table gives an empty result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h) for h in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select("page_id", "url", F.coalesce(pages["html"], F.lit("")).alias("html"))
    return rows.mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint")
