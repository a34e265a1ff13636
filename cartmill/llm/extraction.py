"""Main text of web pages: the best-scoring run of words and tags, completed within its container.

A page is cut into text and tags by one scan, which also notes where elements begin and end and what they hold. Words
score positive, more so as plain text than in links; tags score negative, little if labelled pages have them inside
main text and much if never. A second scan finds the contiguous run with the largest sum: it tells where the main text
is, not yet where it ends. The run is completed in the element that holds it: all of an ``article``; otherwise the
neighbours between and next to what the run touches that are no lists of links, so that a table of short cells, a
paragraph that is a link or an unknown element does not end the text; then likewise for elements of the same kind beside it.

Menus, adverts, forms, comments and the like score nothing and are left out wherever they stand. Some elements are that by
name. Words of class, id and role, and forms, only say so of elements that hold neither an article nor most of
the page's words, as a page's outermost box may well be called 'has-sidebar', 'widget' or be a form.

Defined results: a null or empty page, and one without a word that counts, has empty text; unclosed elements end with
their container or the page; an unfinished tag or comment at the end is dropped; pages without markup are text; a
null id or URL is passed through; equal rows give equal results. Work is linear in the page's length but for deep
nesting, each level of which is looked through once.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartmill.llm import common
from cartmill.llm.labelled_pages import PAGES

_RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# elements that are not main text whatever they hold
_ASIDE = set(
    "head nav footer aside menu dialog button select option datalist template svg canvas object video audio map noscript".split()
)
_PRE = r"(?:^|[\s_-])(?<!has-)(?<!no-)(?<!with-)(?<!has_)(?<!no_)(?<!with_)(?<!without-)"
_COMMENTS = re.compile(
    _PRE + r"(?:comment\w*|disqus\w*|discussions?|repl(?:y|ies)|respond|responses|reactions?|talkback|guestbook|feedback)"
    r"(?=$|[\s_-]|\d)",
    re.IGNORECASE,
)
_HINT = re.compile(
    _PRE + r"(?:ad|ads|adv|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|sidenav|widget\w*|menu\w*|nav|navbar|"
    r"navigation|breadcrumbs?|footer|masthead|topbar|cookie\w*|consent|gdpr|notice\w*|alert\w*|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|signup|login|searchbox|share|sharing|social|related|recommend\w*|"
    r"form|copyright|disclaimer|toolbar|pagination|pager|skip|contentinfo|complementary|search|dialog)(?=$|[\s_-]|\d)"
    r"|(?:^|\s)(?:(?:site|page|top|main|global)[_-]?)?header(?=$|\s)",
    re.IGNORECASE,
)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"'>]|$)""", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Item:
    """A piece of text or a tag; ``skip`` marks what is inside an element that is no main text."""

    kind: str  # "text", or a tag's name
    text: str = ""
    link: bool = False
    skip: bool = False
    node: int = 0  # the innermost element


@dataclass
class Node:
    """An element that is neither inline nor empty: items ``start`` to ``end`` lie in it."""

    name: str
    attributes: str
    parent: int
    start: int
    end: int = -1
    words: int = 0
    link_words: int = 0
    holds: set[str] = field(default_factory=set)  # which of article, main and h1 are inside
    aside: bool = False

    @property
    def plain(self) -> int:
        return self.words - self.link_words


def _tag_end(page: str, at: int, last: dict[str, int], failed: set[int]) -> int:
    """Place after the tag that begins at ``at``, quotes respected if they close; -1 if it does not end.

    ``last`` holds the page's last place of each quote and ``failed`` the opening quotes after which no tag ends, so
    that no part of the page is searched for either again and again.
    """
    end = page.find(">", at)
    if end < 0:
        return -1
    quote = page.find('"', at, end), page.find("'", at, end)
    if quote == (-1, -1):
        return end + 1
    i, opened = at, []
    while i < len(page):
        m = _QUOTE_OR_END.search(page, i)
        if m is None:
            break
        if m[0] == ">":
            return m.end()
        opened.append(m.start())
        if m.start() in failed:
            break
        if m[0] not in last:
            last[m[0]] = page.rfind(m[0])
        if m.end() > last[m[0]]:
            break
        i = page.find(m[0], m.end()) + 1
    failed.update(opened)
    return end + 1


_QUOTE_OR_END = re.compile("[\"'>]")


def _signs(name: str, attributes: str) -> str:
    """"hidden", "comments" or "hint" by the attributes of an element, or nothing."""
    found = ""
    if not attributes:
        return found
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            return "hidden"
        if key in ("class", "id", "role"):
            if _COMMENTS.search(value):
                found = "comments"
            elif not found and _HINT.search(value):
                found = "hint"
    return found


def _mark_asides(nodes: list[Node]) -> None:
    """Decide which elements are no main text; parents stand before what they hold."""
    named = [n.name in _ASIDE for n in nodes]
    for i, n in enumerate(nodes):
        named[i] = named[i] or n.parent >= 0 and named[n.parent]
    whole = max(1, nodes[0].plain - sum(n.plain for i, n in enumerate(nodes) if named[i] and not named[n.parent]))
    # an article or main element somewhere else says that a box of many words is not the main text
    proper = [n for i, n in enumerate(nodes) if n.name in ("article", "main") and not named[i] and n.plain]
    starts, ends = [n.start for n in proper], sorted(n.end for n in proper)
    sectioned = [False]  # whether an article, main or section is around
    for n in nodes[1:]:
        up = nodes[n.parent]
        sectioned.append(sectioned[n.parent] or up.name in ("article", "main", "section"))
        if up.aside or n.name in _ASIDE:
            n.aside = True
            continue
        sign = _signs(n.name, n.attributes)
        if sign == "hidden":
            n.aside = n.name not in ("html", "body")
        elif n.name in ("html", "body", "main"):
            continue
        elif sign == "comments":
            n.aside = not n.holds & {"main", "h1"}
        elif n.name == "header" and not sectioned[-1]:
            n.aside = True
        elif n.name != "article" and (sign or n.name in ("form", "fieldset")):
            elsewhere = bisect_right(ends, n.start) + len(starts) - bisect_left(starts, n.end)
            most = 2 * n.plain >= whole and not elsewhere
            n.aside = not (n.holds & {"article", "main"} or most)


def _above(nodes: list[Node], n: Node):
    """Numbers of the elements that hold ``n``, from inside outwards."""
    at = n.parent
    while at >= 0:
        yield at
        at = nodes[at].parent


# Elements that a following element of the second kind ends
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}


def parse(page: str) -> tuple[list[Item], list[Node]]:
    """The page's text and tags in order, and its elements."""
    out: list[Item] = []
    nodes = [Node("", "", -1, 0)]
    stack = [0]
    open_names: Counter = Counter()
    links = 0
    at, size = 0, len(page)
    last: dict[str, int] = {}
    failed: set[int] = set()
    lower = page.lower() if len(page.lower()) == size else page

    def text(piece: str) -> None:
        out.append(Item("text", piece, links > 0, False, stack[-1]))
        n = len(piece.split())
        nodes[stack[-1]].words += n
        if links > 0:
            nodes[stack[-1]].link_words += n

    def close() -> Node:
        done = nodes[stack.pop()]
        done.end = len(out)
        open_names[done.name] -= 1
        up = nodes[stack[-1]]
        up.words += done.words
        up.link_words += done.link_words
        up.holds |= done.holds | ({done.name} & {"article", "main", "h1"})
        return done

    def pop(name: str) -> None:
        if open_names[name]:
            while close().name != name:
                pass

    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            text(page[at:start])
        if start == size:
            break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        following = page[start + 1 : start + 2]
        closing = following == "/"
        m = _NAME.match(page, start + 1 + closing)
        if m is None:
            if following in ("!", "?", "/"):
                end = page.find(">", start)
                at = size if end < 0 else end + 1
            else:
                text("<")
                at = start + 1
            continue
        end = _tag_end(page, start, last, failed)
        if end < 0:
            break
        name, attributes = m[0].lower(), page[m.end() : end - 1]
        at = end
        if closing:
            if name == "a":
                links = max(0, links - 1)
            out.append(Item(name, node=stack[-1]))
            if name not in _VOID:
                pop(name)
            continue
        if name in _RAW and not attributes.rstrip().endswith("/"):
            close_at = lower.find(f"</{name}", at)
            close_at = size if close_at < 0 else close_at
            after = page.find(">", close_at)
            at = size if after < 0 else after + 1
            continue
        if name == "body":
            pop("head")
        if name not in _INLINE and name not in _VOID:
            if nodes[stack[-1]].name == "p":
                close()  # a paragraph ends where the next block begins
            while nodes[stack[-1]].name in _ENDS and name in _ENDS[nodes[stack[-1]].name]:
                close()
        out.append(Item(name, node=stack[-1]))
        if name not in _VOID and name not in _INLINE and not attributes.endswith("/"):
            nodes.append(Node(name, attributes, stack[-1], len(out)))
            stack.append(len(nodes) - 1)
            open_names[name] += 1
        elif name in _INLINE and name != "a" and _signs(name, attributes):
            # an inline element is left out like any other, up to its end
            nodes.append(Node(name, attributes, stack[-1], len(out)))
            stack.append(len(nodes) - 1)
            open_names[name] += 1
        if name == "a":
            links += 1
    while len(stack) > 1:
        close()
    nodes[0].end = len(out)
    _mark_asides(nodes)
    for item in out:
        item.skip = nodes[item.node].aside
    return out, nodes


def items(page: str) -> list[Item]:
    return parse(page)[0]


_HEADING = re.compile("h[1-6]")


def _feature(item: Item) -> tuple[str, int]:
    """What an item counts as, and how many times."""
    if item.kind == "text":
        return ("link words" if item.link else "words"), len(item.text.split())
    return ("<heading>" if _HEADING.fullmatch(item.kind) else f"<{item.kind}>"), 1


_TAG, _NEVER = 1.0, -40.0  # score of a tag seen outside only by way of exception, and of one never seen inside


@lru_cache(maxsize=1)
def weights() -> dict[str, float]:
    """Scores counted from the labelled pages: words between 0 and 1, tags below 0."""
    inside, outside = Counter(), Counter()
    for page in PAGES:
        before, main, after = re.split(r"\[\[|\]\]", page)
        # marks that no page has as text keep their place among the items
        part = outside
        for item in items(f"{before}<x-in>{main}<x-out>{after}"):
            if item.kind in ("x-in", "x-out"):
                part = inside if item.kind == "x-in" else outside
            elif not item.skip:
                feature, n = _feature(item)
                part[feature] += n
    out = {}
    for feature in inside | outside:
        share = (inside[feature] + 0.5) / (inside[feature] + outside[feature] + 1)
        if feature.startswith("<"):
            out[feature] = _NEVER if not inside[feature] else -_TAG * (1 - share)
        else:
            out[feature] = share
    return out


_UNKNOWN = -1.0  # a tag that no labelled page has


def _best_run(found: list[Item]) -> tuple[int, int]:
    """The contiguous run of items with the largest sum of scores."""
    score = weights()
    best = total = 0.0
    start, region = 0, (0, 0)
    for i, item in enumerate(found):
        if item.skip:
            continue
        feature, n = _feature(item)
        if not n:
            continue
        gain = n * score.get(feature, _UNKNOWN if feature[0] == "<" else 0.0)
        if total <= 0:
            total, start = 0.0, i
        total += gain
        if total > best:
            best, region = total, (start, i + 1)
    return region


# elements that text consists of, whatever their length
_TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure figcaption hr address details".split())
_PIECES = _TEXT_BLOCKS | set("li dt dd tr td th tbody thead tfoot caption".split())
_PROSE = 20  # words from which a box beside the text counts as more of it


@dataclass
class _Part:
    """A child of an element, or text that stands between its children."""

    start: int
    end: int
    words: int
    link_words: int
    node: Node | None = None

    def belongs(self, loose: bool) -> bool:
        """Whether it may be main text beside main text; boxes directly in the page's body must say more."""
        if self.node is not None and self.node.aside or not self.words:
            return False
        if self.node is not None and self.node.name == "p":
            return True
        few_links = 2 * self.link_words < self.words
        if self.node is None or self.node.name in _TEXT_BLOCKS:
            return few_links
        return few_links and (not loose or self.words - self.link_words >= _PROSE // 2)


    def resembles(self, other: Node) -> bool:
        """Whether it is a box like another one and holds prose."""
        if self.node is None or self.node.aside or self.words - self.link_words < _PROSE or 5 * self.link_words >= self.words:
            return False
        return (self.node.name, _class(self.node)) == (other.name, _class(other))


def _parts_of(found: list[Item], nodes: list[Node], children: dict[int, list[int]], at: int) -> list[_Part]:
    node, out = nodes[at], []
    place = node.start
    for k in [*children.get(at, ()), None]:
        upto = nodes[k].start if k is not None else node.end
        own = [i for i in range(place, upto) if found[i].kind == "text"]
        words = sum(len(found[i].text.split()) for i in own)
        if words:
            linked = sum(len(found[i].text.split()) for i in own if found[i].link)
            out.append(_Part(place, upto, words, linked))
        if k is not None:
            out.append(_Part(nodes[k].start, nodes[k].end, nodes[k].words, nodes[k].link_words, nodes[k]))
            place = nodes[k].end
    return out


def _holder(found: list[Item], nodes: list[Node], first: int, last: int) -> int:
    """The innermost element that holds the run and is more than a block of text."""
    a = next(found[i].node for i in range(first, last) if found[i].kind == "text" and not found[i].skip)
    b = next(found[i].node for i in range(last - 1, first - 1, -1) if found[i].kind == "text" and not found[i].skip)
    around = {a, *_above(nodes, nodes[a])}
    at = b
    while at not in around:
        at = nodes[at].parent
    while nodes[at].name in _PIECES and nodes[at].parent >= 0:
        if nodes[at].name in ("td", "th") and nodes[at].plain >= _PROSE:
            break  # a cell may be a page's column
        at = nodes[at].parent
    return at


def _completed(found: list[Item], nodes: list[Node], first: int, last: int) -> tuple[int, int]:
    """The run with what belongs to it in the elements around it."""
    children: dict[int, list[int]] = {}
    for k, n in enumerate(nodes):
        if n.parent >= 0:
            children.setdefault(n.parent, []).append(k)
    while True:
        at = _holder(found, nodes, first, last)
        article = next((k for k in (at, *_above(nodes, nodes[at])) if nodes[k].name == "article"), None)
        if article is not None:
            return nodes[article].start, nodes[article].end
        parts = _parts_of(found, nodes, children, at)
        loose = nodes[at].name in ("", "html", "body")
        touched = [p for p in parts if p.start < last and p.end > first and p.words]
        kept = list(touched)  # without boxes of links that the run ran into
        while kept and not kept[-1].belongs(loose):
            kept.pop()
        while kept and not kept[0].belongs(loose):
            kept.pop(0)
        if not kept or len(kept) == len(touched):
            break
        first, last = max(first, kept[0].start), min(last, kept[-1].end)
    ok, whole = [p.belongs(loose) for p in parts], True
    while True:
        inside = [i for i, p in enumerate(parts) if p.start < last and p.end > first]
        if inside:
            low, high = inside[0], inside[-1]
            while low > 0 and (ok[low - 1] or not parts[low - 1].words):
                low -= 1
            while high + 1 < len(parts) and (ok[high + 1] or not parts[high + 1].words):
                high += 1
            if whole or low < inside[0]:  # blocks that the run touches are taken whole, the boxes around it are not
                first = min(first, parts[low].start)
            if whole or high > inside[-1]:
                last = max(last, parts[high].end)
        inner, whole = nodes[at], False
        if inner.parent < 0 or inner.name in ("main", "body", "html"):
            return first, last
        at = inner.parent
        parts = _parts_of(found, nodes, children, at)
        ok = [p.resembles(inner) for p in parts]  # beside a box only boxes of its kind, with prose


def _class(node: Node) -> str:
    return next((v.strip("\"'") for k, v in _ATTRIBUTE.findall(node.attributes) if k.lower() == "class"), "")


def main_text(page: str | None) -> str:
    """The main text: blocks in page order, white space as one space."""
    if not page:
        return ""
    found, nodes = parse(page)
    first, last = _best_run(found)
    if first == last:
        return ""
    first, last = _completed(found, nodes, first, last)
    while first > 0 and (found[first - 1].kind == "text" or found[first - 1].kind in _INLINE):
        first -= 1
    while last < len(found) and (found[last].kind == "text" or found[last].kind in _INLINE):
        last += 1
    parts = []
    for item in found[first:last]:
        if item.kind == "text":
            if not item.skip:
                parts.append(item.text)
        elif item.kind not in _INLINE:
            parts.append(" ")
    return " ".join(html.unescape("".join(parts)).split())


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, text and n_chars, its code points."""
    schema = common.schema_of(
        common.field(pages, id_col), common.field(pages, url_col), ("text", T.StringType()), ("n_chars", T.LongType())
    )

    def rows(batch):
        for key, url, page in batch:
            text = main_text(page)
            yield key, url, text, len(text)

    return common.arrow_map(common.doc_rows(pages, id_col, url_col, html_col), rows, schema, batch=256)
