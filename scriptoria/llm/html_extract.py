"""Main-text extraction from web pages: containers are scored by page, and a host's pages vote on the path to use."""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Callable, Collection, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import cut_lineage

# Names of HTML elements by their part in a page.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
DROPPED = {"script", "style", "noscript", "iframe", "template", "svg", "canvas", "audio", "video", "head", "title", "nav", "footer", "aside", "form", "button", "select", "textarea", "dialog", "menu", "header", "datalist", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption", "hgroup"} | DROPPED - {"button", "svg", "canvas"}
#: Parts of a line of text.
PHRASING = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "u", "var"}
CONTAINER = {"article", "body", "div", "main", "section", "td", "center", "blockquote", "html"}
#: A start tag of the first kind ends open elements of the second, up to the nearest of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_MARK = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[A-Za-z][^>]*+>?""", re.DOTALL)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
#: Attributes that tell something of an element.
_TELLING = {"class", "id", "role", "hidden", "aria-hidden", "style"}
#: Words that tell chrome: as a whole class or id; and of a part of the page (a division, section or list) as one of the hyphenated parts of it, too.
_CHROME = re.compile(
    r"(?:ad|ads|adv|advert\w*|adsense|adslot|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|alert|newsletter|subscri\w*|signup|sign-up|paywall|"
    r"rail|sidebar|side-bar|widget|menu|nav|navbar|navigation|breadcrumbs?|share|sharing|social|related|recommend\w*|more-stories|comments?|disqus|respond|replies|reply|feedback|discussions?|ratings?|"
    r"footer|foot|site-header|page-header|masthead|popup|modal|overlay|toolbar|pagination|pager|tags|skip-link|hidden)",
    re.IGNORECASE,
)
_PART = re.compile(rf"(?:^|(?<=[_-]))({_CHROME.pattern})(?=$|[_-])", re.IGNORECASE)
_LOOKS = r"banner|rail|menu|nav|navigation|social|related|recommend\w*|respond|replies|reply|foot|tags|sharing|promo\w*|discussions?|ratings?|feedback|overlay|pager"
#: Of these words, those that an article may use for its own matter: as whole names, and as parts of names (foot-care, notice-period, related-work).
_AMBIGUOUS = re.compile(rf"(?:{_LOOKS})", re.IGNORECASE)
_AMBIGUOUS_PART = re.compile(rf"(?:{_LOOKS}|notice|notification|alert|consent|hidden|modal)", re.IGNORECASE)
#: Parts of a page, of which a hyphenated name tells what they are; a paragraph or a heading is named for its looks.
_PARTS = {"div", "section", "ul", "ol", "table", "aside", "center", "dl", "details", "article"}
#: Parts that are dropped whatever they hold: they have no text of a page, or it is not shown.
_UNSEEN = {"script", "style", "noscript", "iframe", "template", "svg", "canvas", "audio", "video", "head", "title", "button", "select", "textarea", "datalist", "noembed", "noframes"}
_CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "alertdialog"}
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


class Tree:
    """Nodes with a parent and a name each, a parent before its children; sums go up it and marks go down it in one pass."""

    def __init__(self) -> None:
        self.parent: list[int] = []

    def add(self, parent: int) -> int:
        self.parent.append(parent)
        return len(self.parent) - 1

    def sums(self, at: Iterable[tuple[int, int]]) -> list[int]:
        """For each node the sum of the numbers given for it and for all below it."""
        total = [0] * len(self.parent)
        for node, x in at:
            if node >= 0:
                total[node] += x
        for node in range(len(total) - 1, -1, -1):
            if self.parent[node] >= 0:
                total[self.parent[node]] += total[node]
        return total

    def below(self, marked: Callable[[int], bool]) -> list[bool]:
        """For each node whether it or one above it is marked."""
        out: list[bool] = []
        for node, parent in enumerate(self.parent):
            out.append(marked(node) or parent >= 0 and out[parent])
        return out


#: Containers above a path's last one that its name spells out; what is above them is told by a hash.
SPELT = 24


class Paths(Tree):
    """The paths of open containers of a page: equal paths are one node, whose name is the same on every page."""

    def __init__(self) -> None:
        super().__init__()
        self.names: list[str] = []
        self.labels: list[str] = []
        self.depths: list[int] = []
        self._hashes: list[bytes] = []
        self._nodes: dict[tuple[int, str], int] = {}

    def under(self, parent: int, label: str) -> int:
        node = self._nodes.get((parent, label))
        if node is None:
            node = self._nodes[parent, label] = self.add(parent)
            above = self._hashes[parent] if parent >= 0 else b""
            self._hashes.append(hashlib.blake2b(above + label.encode("utf-8", "replace"), digest_size=16).digest())
            self.labels.append(label)
            self.depths.append(self.depths[parent] + 1 if parent >= 0 else 1)
            if self.depths[-1] <= SPELT:
                self.names.append(f"{self.names[parent]}>{label}" if parent >= 0 else label)
            else:
                self.names.append(f"#{self._hashes[-1].hex()}>{label}")
        return node


@dataclass(slots=True)
class Block:
    """A stretch of text with no block boundary inside. path: the node of its open containers; told, body: what _chrome() goes by."""

    text: str
    path: int
    link_chars: int
    told: int = -1  # the innermost open element that is told to be chrome
    body: int = -1  # the outermost open article or main
    told_at_body: int = -1  # what `told` was where that began

    @property
    def weight(self) -> int:
        return max(0, len(self.text) - 2 * self.link_chars)

    @property
    def links(self) -> bool:
        """Whether it is links and little else."""
        return self.link_chars >= 0.8 * len(self.text)


@dataclass(slots=True)
class _Element:
    tag: str
    path: int  # the node of the containers around it
    label: bool  # a container
    dropped: bool
    told: bool
    body: bool


def generalised(tag: str, attributes: dict[str, str]) -> str:
    """Tag and sorted classes (the id where there is no class), with digits taken as one sign, so that pages of a template agree."""
    names = sorted(set((attributes.get("class") or attributes.get("id") or "").lower().split()))
    return _DIGITS.sub("0", ".".join([tag, *names]))


def _attributes(source: str) -> dict[str, str]:
    """The telling attributes of a start tag. They are read one by one from its beginning, so that no name is seen in a value; of several of a name the first counts."""
    out: dict[str, str] = {}
    if source and not source.isspace():
        for m in _ATTR.finditer(source):
            name = m[1].lower()
            if name in _TELLING and name not in out:
                out[name] = html.unescape(m[2] or m[3] or m[4] or "")
    return out


#: Unseen; chrome unless it holds the page's article; the same, or most of the page's text (a wrapper); chrome if it is mostly links.
_KEPT, _DROPPED, _TOLD, _WRAPPER, _LINKED = range(5)


def _kind(tag: str, attributes: dict[str, str], in_body: bool, alone: bool) -> int:
    """What a start tag tells of its element. Words of a line stay, whatever they are called, unless they are `alone`: begin a line that is in no paragraph. Inside an article or main, names that may be of the article's own matter count only for lists of links."""
    if tag in _UNSEEN:
        return _DROPPED
    if attributes and tag not in ("body", "html", "article", "main"):
        if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.IGNORECASE):
            return _DROPPED
    if tag in PHRASING:
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split() if alone else ()
        return _DROPPED if any(_CHROME.fullmatch(x) for x in names) or alone and attributes.get("role", "").lower() in _CHROME_ROLES else _KEPT
    if tag in DROPPED:
        # An article's own header holds its title.
        if tag == "header" and in_body:
            return _KEPT
        return _WRAPPER if tag == "form" else _TOLD
    if not attributes or tag in ("body", "html", "article", "main"):
        return _KEPT
    if attributes.get("role", "").lower() in _CHROME_ROLES:
        return _WRAPPER if attributes["role"].lower() == "form" else _TOLD
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    whole = [x for x in names if _CHROME.fullmatch(x)]
    if whole:
        return _LINKED if in_body and tag not in _PARTS and all(_AMBIGUOUS.fullmatch(x) for x in whole) else _TOLD
    named = tag in _PARTS or "-" in tag or tag in ("form", "body", "html")
    found = [m[1] for x in names for m in _PART.finditer(x)] if named else []
    if not found:
        return _KEPT
    if in_body and all(_AMBIGUOUS_PART.fullmatch(x) for x in found):
        return _LINKED
    # A name of such words only is no wrapper's, which has another word, too.
    return _TOLD if any(all(_CHROME.fullmatch(w) for w in re.split("[_-]", x)) for x in names) else _WRAPPER


def _chrome(page: Page) -> list[bool]:
    """For each element that is told to be chrome whether it or one around it is so indeed.

    None is that holds a main, or most of the page's text and all of its articles (a wrapper: or no article, if
    the page has none), or that counts only for links and is not mostly links.
    """
    blocks, told = page.blocks, page.told
    total = sum(b.weight for b in blocks)
    weight = told.sums((b.told, b.weight) for b in blocks)
    links, chars = told.sums((b.told, b.link_chars) for b in blocks), told.sums((b.told, len(b.text)) for b in blocks)
    inside = told.sums((b.told_at_body, 1) for b in blocks if b.body >= 0)
    mains = told.sums((b.told_at_body, 1) for b in blocks if b.body in page.mains)
    articles = sum(b.body >= 0 for b in blocks)

    def is_chrome(e: int) -> bool:
        if mains[e] or page.kinds[e] == _LINKED and 2 * links[e] < chars[e]:
            return False
        whole = inside[e] == articles and (articles > 0 or page.kinds[e] == _WRAPPER)
        return not (whole and 2 * weight[e] > total)

    return told.below(is_chrome)


class Page:
    """The text blocks of a page outside dropped parts, in page order, with the containers they stand in.

    Null, empty and broken pages are read as far as they go. Where all text stands in what is told to be chrome, none is given,
    unless it stands in an article or main. Open elements are found by their names, so that reading takes no longer
    for tags that never end, or that end and never began.
    """

    def __init__(self, page: str | None) -> None:
        self.blocks: list[Block] = []
        self.paths, self.told = Paths(), Tree()
        self.kinds: list[int] = []
        self.mains: set[int] = set()
        if page:
            self._read(page)
            chrome = _chrome(self)
            kept = [b for b in self.blocks if b.told < 0 or not chrome[b.told]]
            self.blocks = kept or [b for b in self.blocks if b.body >= 0]

    def _read(self, page: str) -> None:
        stack: list[_Element] = []
        places: dict[str, list[int]] = {}  # of open elements on the stack, by tag
        block_at: list[int] = []
        barriers: list[int] = []  # of dropped and told elements
        parts: list[str] = []
        links = in_link = dropped = bodies = 0
        path = told = body = told_at_body = -1

        def flush() -> None:
            nonlocal links
            if parts:
                text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
                if text:
                    self.blocks.append(Block(text, path, min(links, len(text)), told, body, told_at_body))
                parts.clear()
            links = 0

        def pop(to: int) -> None:
            nonlocal path, dropped, told, body, told_at_body, bodies
            while len(stack) > to:
                e = stack.pop()
                places[e.tag].pop()
                if e.tag in BLOCK:
                    block_at.pop()
                if e.dropped or e.told:
                    barriers.pop()
                dropped -= e.dropped
                if e.told:
                    flush()
                    told = self.told.parent[told]
                if e.body:
                    bodies -= 1
                    if not bodies:
                        body = told_at_body = -1
                path = e.path

        last = lambda tags: max((places[t][-1] for t in tags if places.get(t)), default=-1)
        at, n, number = 0, len(page), 0
        while at < n:
            m = _MARK.search(page, at)
            begin = m.start() if m else n
            if begin > at and not dropped:
                parts.append(page[at:begin])
                if in_link:
                    links += begin - at
            if m is None:
                break
            at = m.end()
            if m[0].startswith("<![CDATA[") and not dropped:
                parts.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "a":
                    in_link = 0
                if tag in BLOCK:
                    flush()
                i = last((tag,))
                behind = tag in ("p", "b", "i", "span", "a") and barriers and barriers[-1] > i  # a stray end tag ends nothing outside chrome
                if i >= 0 and not behind and (tag in BLOCK or not block_at or block_at[-1] < i):
                    pop(i)
                continue
            if tag == "br":
                parts.append(" ")
                continue
            if tag in BLOCK:
                flush()
            if tag in VOID:
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(page, at)
                at = end.start() if end else n
            if tag in CLOSES:
                same, until = CLOSES[tag]
                while (i := last(same)) > last(until):
                    pop(i)
                    if tag != "tr":
                        break
            elif tag in BLOCK and block_at and stack[block_at[-1]].tag == "p":
                pop(block_at[-1])  # a block ends an open paragraph
            if tag == "a":
                in_link = 1
            if m[3].endswith("/") and tag not in BLOCK:
                continue
            attributes = _attributes(m[3])
            alone = not bodies and bool(attributes) and tag in PHRASING and (not block_at or stack[block_at[-1]].tag in CONTAINER) and not "".join(parts).strip()
            kind = _kind(tag, attributes, bodies > 0, alone) if tag not in HEADINGS else _KEPT
            number += 1
            outer = path
            if kind >= _TOLD:
                if tag not in BLOCK:
                    flush()  # text before it does not stand in it
                told = self.told.add(told)
                self.kinds.append(kind)
            is_body = tag in ("article", "main")
            if is_body:
                bodies += 1
                if bodies == 1:
                    body, told_at_body = number, told
                    if tag == "main":
                        self.mains.add(number)
            if tag in CONTAINER:
                path = self.paths.under(path, generalised(tag, attributes) if attributes else tag)
            places.setdefault(tag, []).append(len(stack))
            if tag in BLOCK:
                block_at.append(len(stack))
            if kind != _KEPT:
                barriers.append(len(stack))
            stack.append(_Element(tag, outer, tag in CONTAINER, kind == _DROPPED, kind >= _TOLD, is_body))
            dropped += kind == _DROPPED
        flush()


def blocks_of(page: str | None) -> list[Block]:
    return Page(page).blocks


#: Share of a page's text that a container must hold to stand for the page.
SHARE = 0.7
_SEMANTIC = re.compile(r"^(article|main)(\.|$)")
_CONTENT = re.compile(r"(?:^|[._-])(?:content|article|post|entry|story|body|main|text|page)(?:$|[._-])", re.IGNORECASE)


def score_containers(page: Page) -> dict[str, float]:
    """Votes of a page: its containers' paths with their scores.

    A container's score is its share of the page's text outside links, if that is at least SHARE (else
    nothing), plus a share for a telling tag or name, plus a little for depth, so that of containers which
    hold the same text the innermost wins.
    """
    weights = page.paths.sums((b.path, b.weight) for b in page.blocks)
    total = sum(b.weight for b in page.blocks)
    out: dict[str, float] = {}
    for node, w in enumerate(weights):
        if total and w >= SHARE * total:
            label = page.paths.labels[node]
            named = 1.0 if _SEMANTIC.match(label) else 0.4 if _CONTENT.search(label.partition(".")[2]) else 0.0
            out[page.paths.names[node]] = w / total + named + 0.02 * min(page.paths.depths[node], 10)
    return out


def _apart(page: Page, path: str | None) -> list[bool]:
    """For each block whether it stands outside `path`, which is everywhere where it is null."""
    if path is None:
        return [False] * len(page.blocks)
    under = page.paths.below(lambda node: page.paths.names[node] == path)
    return [b.path < 0 or not under[b.path] for b in page.blocks]


def text_under(page: Page, path: str | None, repeated: Collection[int] = ()) -> str:
    """The blocks under `path`, or all of them if it is null, one a line, and in their places those outside that nothing tells to be chrome.

    Outside, a block is chrome if it is links and little else, or if it is `repeated` on the host's pages.
    """
    return "\n".join(b.text for b, out in zip(page.blocks, _apart(page, path), strict=True) if not out or not b.links and (not repeated or text_key(b.text) not in repeated))


def text_key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def outside(page: Page, best: str | None) -> tuple[int, list[int]]:
    """Key of the text under the page's own best path, and keys of the blocks outside it."""
    apart = _apart(page, best)
    if not any(apart):
        return 0, []
    inner = text_key("\n".join(b.text for b, out in zip(page.blocks, apart, strict=True) if not out))
    return inner, [text_key(b.text) for b, out in zip(page.blocks, apart, strict=True) if out and not b.links]


def extract(html_text: str | None, votes: dict[str, float], repeated: Collection[int] = ()) -> str:
    """The page's text under that of its own qualifying paths which has most votes of the host, else under its own best; see text_under()."""
    page = Page(html_text)
    if not page.blocks:
        return ""
    own = score_containers(page)
    path = best_of({p: votes[p] for p in own if p in votes})
    return text_under(page, path if path is not None else best_of(own), repeated)


#: Bytes of the vote's outcome that are sent to every task; more is joined.
BROADCAST_BYTES = 16 << 20


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#\s]*)", url or "")
    return m[1].lower() if m else ""


def best_of(scores: dict[str, float]) -> str | None:
    """The path with the highest score; of several the least."""
    return min(scores, key=lambda p: (-scores[p], p)) if scores else None


def host_votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, votes, block): the outcome of the vote of each host's pages. Pages without a host vote together.

    Each page votes for its own best path, with that path's score. A row without a path has the key of a block
    outside the pages' own best paths that stands beside two different texts. Nothing is left out, and no list
    is made of what a host has: its paths are rows.

    Each task sums the votes of its own pages before they are shuffled, so that a hot host sends a few rows
    from each task; Spark sums those. Of a block only the least and the greatest key of the texts beside it count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            votes: dict[tuple[str, str], float] = {}
            beside: dict[tuple[str, int], tuple[int, int]] = {}
            for url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                host, read = host_of(url), Page(page)
                own = score_containers(read)
                path = best_of(own)
                if path is not None:
                    votes[host, path] = votes.get((host, path), 0.0) + own[path]
                inner, keys = outside(read, path)
                for key in keys:
                    lo, hi = beside.get((host, key), (inner, inner))
                    beside[host, key] = min(lo, inner), max(hi, inner)
            none = [None] * len(votes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in (*votes, *beside)], pa.string()),
                    pa.array([*(k[1] for k in votes), *([None] * len(beside))], pa.string()),
                    pa.array([*votes.values(), *([None] * len(beside))], pa.float64()),
                    pa.array([*none, *(k[1] for k in beside)], pa.int64()),
                    pa.array([*none, *(x[0] for x in beside.values())], pa.int64()),
                    pa.array([*none, *(x[1] for x in beside.values())], pa.int64()),
                ],
                ["host", "path", "votes", "block", "lo", "hi"],
            )

    ballots = pages.select(F.col(url_col).cast("string"), F.col(html_col).cast("string")).mapInArrow(run, "host string, path string, votes double, block long, lo long, hi long")
    summed = ballots.groupBy("host", "path", "block").agg(F.round(F.sum("votes"), 6).alias("votes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return summed.where("path is not null or lo <> hi").select("host", "path", "votes", "block")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row (id_col, url_col, text) for each page.

    Null and empty pages have the text ''; a page without a container that stands for it gives all its kept
    blocks; null urls are one host; repeated rows and null ids stay; an empty table gives an empty result.
    Other columns are not read. Texts are whole, whatever their length. Paths with as many votes go by name.

    The votes are counted in a first pass over the pages. Their outcome is a few paths a host; where it is
    within `broadcast_bytes` it goes to every task and the pages are not shuffled. Else each page asks, in
    slim rows, for the votes of its own paths and for its own blocks, and what it is told is joined to it.
    """
    votes = cut_lineage(host_votes(pages, url_col, html_col))
    size = votes.agg(F.sum(F.length("host") + F.coalesce(F.length("path"), F.lit(0)) + 64)).first()[0] or 0
    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    schema = f"`{id_col}` {id_type}, `{url_col}` {url_type}, text string"
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    if size <= broadcast_bytes:
        known: dict[str, tuple[dict[str, float], set[int]]] = {}
        for r in votes.toLocalIterator():
            paths, repeated = known.setdefault(r["host"], ({}, set()))
            if r["path"] is not None:
                paths[r["path"]] = r["votes"]
            else:
                repeated.add(r["block"])
        shared = pages.sparkSession.sparkContext.broadcast(known)

        def with_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, none = shared.value, ({}, set())
            for b in batches:
                texts = [extract(page, *known.get(host_of(str(url) if url is not None else None), none)) for url, page in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], [id_col, url_col, "text"])

        return rows.mapInArrow(with_map, schema)

    # A page is told by its url and html: pages that are the same in these have the same text.
    key = F.md5(F.concat_ws("\n", F.coalesce(F.col("url").cast("string"), F.lit("")), F.coalesce(F.col("html"), F.lit("")))).alias("key")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for k, url, page in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                host, read = host_of(url), Page(page)
                own = score_containers(read)
                out += [(k, host, path, None) for path in own]
                out += [(k, host, None, x) for x in {text_key(x.text) for x in read.blocks if not x.links}]
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["key", "host", "path", "block"])

    asked = cut_lineage(rows.select(key, F.col("url").cast("string").alias("url"), "html").mapInArrow(ask, "key string, host string, path string, block long"))
    paths = asked.where("path is not null").select("key", "host", "path").join(votes.where("path is not null").select("host", "path", "votes"), ["host", "path"])
    best = cut_lineage(paths.groupBy("key").agg(F.min(F.struct((-F.col("votes")).alias("low"), "path")).alias("best")).select("key", F.col("best.path").alias("path")))
    blocks = asked.where("path is null").select("key", "host", "block").join(votes.where("path is null").select("host", "block"), ["host", "block"])
    repeated = cut_lineage(blocks.groupBy("key").agg(F.collect_set("block").alias("repeated")))  # of the page's own blocks
    told = rows.withColumn("key", key).join(best, "key", "left").join(repeated, "key", "left").select("id", "url", "html", "path", "repeated")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(page, {path: 1.0} if path is not None else {}, frozenset(told or ())) for page, path, told in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], [id_col, url_col, "text"])

    return told.mapInArrow(joined, schema)
