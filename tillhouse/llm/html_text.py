"""Main text of web pages by scoring the tree of elements.

Every paragraph gives points for its length and commas to the elements around it, the nearer the
more; an element's points are discounted by the share of its text that is link text. The best
element is the container: an ``article`` or ``main`` around it if there is one, else the element with
those siblings that also read like the article. Menus, page headers and footers, sidebars, notices,
adverts, forms, comments and what is never shown are left out beforehand by tag, role and class.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import slices, table

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=|[\"'])*+)>", re.S
)
_QUOTED = re.compile(r"=\s*+\"[^\"]*+\"|=\s*+'[^']*+'")
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_RAW = set("script style noscript template iframe object textarea title svg annotation annotation-xml canvas audio video".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_UNWANTED = set("head nav footer aside form menu dialog button select fieldset label datalist".split())
_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
_UNWANTED_NAMES = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices alert popup modal overlay sidebar widget widgets menu nav navbar navigation breadcrumb "
    "breadcrumbs comment comments disqus respond replies share sharing social related recommended recommendations "
    "newsletter subscribe subscription footer masthead toolbar pagination pager login signup copyright".split()
)
#: Words beside the former that leave a class or id what it is; with any other word it names something else.
_NEUTRAL_NAMES = set(
    "area bar block box btn button buttons container inner outer list item items links main wrap wrapper top bottom left right "
    "site page primary secondary global header section text message form row column col slot unit js user reader post posts "
    "article articles stories count thread".split()
)
_COMMENT_NAMES = set("comment comments disqus respond replies".split())
_CONTAINERS = {"article", "main"}
_BLOCK = set(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_OWN_TEXT = {"div", "section", "article", "main", "body", "html", "center", "details"}
#: An open element that the start of another one ends.
_ENDED_BY = (
    {name: {"p"} for name in _BLOCK if name not in {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}}
    | {"li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "option": {"option"}}
    | {"tr": {"td", "th", "tr", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
)
#: Elements that no end of another one reaches across.
_SCOPES = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "html", "blockquote", "td", "th"}
_STOPS = {tag: tuple(_SCOPES - ended) for tag, ended in _ENDED_BY.items()}
_RAW_ENDS = {tag: re.compile(rf"</{re.escape(tag)}\s*>", re.I) for tag in _RAW}
LEAST_PARAGRAPH = 25
#: An element left out by its name that has this share of the page's text is a wrapper of the article.
WRAPPER_SHARE = 0.75


def _unwanted_names(value: str) -> set[str]:
    """The unwanted names among the classes or ids of an element: whole ones, or with neutral words only."""
    found = set()
    for token in value.split():
        parts = {token.lower()} & _UNWANTED_NAMES or {part.lower() for part in _PARTS.findall(token)}
        if parts <= _UNWANTED_NAMES | _NEUTRAL_NAMES:
            found |= parts & _UNWANTED_NAMES
    return found


def _unwanted(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in _UNWANTED or tag == "header" and not inside_article:
        return True
    if not attributes or tag in _CONTAINERS or tag in ("html", "body"):
        return False
    for name, double, single, bare in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (double or single or bare).lower()
        if name == "role" and value in _ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _named(tag: str, attributes: str) -> set[str]:
    if not attributes or tag in ("main", "html", "body"):
        return set()
    found = set()
    for name, double, single, bare in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            found |= _unwanted_names(double or single or bare)
    return found & _COMMENT_NAMES if tag == "article" else found


class _Tokens:
    """Tags, comments and declarations of a page in order, in time that grows with its length.

    A tag without end is text. The reading of one that runs out at the end of the page tells so of all tags that
    begin outside its quoted values, as it would go on like theirs; there are as many readings as kinds of quotes.
    """

    def __init__(self, source: str):
        self.source = source
        self.last_end = source.rfind(">")
        self.failed: list[tuple[list[int], list[int]]] = []  # begins and ends of the quoted values

    def _fails(self, at: int) -> bool:
        for begins, ends in self.failed:
            i = bisect.bisect_right(begins, at) - 1
            if i < 0 or ends[i] <= at:
                return True
        return False

    def next(self, place: int) -> re.Match | None:
        source = self.source
        while (at := source.find("<", place)) >= 0:
            place = at + 1
            if at > self.last_end and not source.startswith("<!--", at):
                at = source.find("<!--", at)  # all that can still be is a comment without end
                return _TOKEN.match(source, at) if at >= 0 else None
            if self.failed and source[place : place + 1] not in ("!", "?") and self._fails(at):
                continue
            if match := _TOKEN.match(source, at):
                return match
            if source[place : place + 1].isalpha() or source[place : place + 1] == "/" and source[place + 1 : place + 2].isalpha():
                values = [m.span() for m in _QUOTED.finditer(source, at)]
                self.failed.append(([b for b, _ in values], [e for _, e in values]))
        return None


class _Page:
    """Elements in the order of their start tags, and the blocks of text that are not left out.

    What an element's name alone would leave out is decided when the whole page is known.
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.dropped = ["html"], [-1], [False]
        self.names: dict[int, set[str]] = {}
        self.named = [0]  # the nearest element, itself or around it, with an unwanted name; 0 if none
        self.block = [0]  # the nearest block, itself or around it
        self.texts: list[tuple[int, list[tuple[str, int, bool]]]] = []  # element; text, its named element, link
        self._fresh = True
        self._read(source)
        self.blocks = self._kept()

    def _kept(self) -> list[tuple[int, list[str], list[str]]]:
        """Element, text and link text of every block that stays."""
        if not self.names:
            return [(node, [x for x, _, _ in found], [x for x, _, link in found if link]) for node, found in self.texts]
        within = [False]
        for parent, tag in zip(self.parents[1:], self.tags[1:], strict=True):
            within.append(tag in _CONTAINERS or within[parent])
        # Whether an article or main with text stands outside all named elements; characters besides headings and links.
        free = any(within[node] and not named and text.strip() for node, found in self.texts for text, named, _ in found)
        size, every = dict.fromkeys(self.names, 0), 0
        for node, found in self.texts:
            for text, named, link in found:
                if not link and self.tags[node] not in _HEADINGS:
                    every += len(text)
                    if named:
                        size[named] += len(text)
        for node in sorted(self.names, reverse=True):
            if above := self.named[self.parents[node]]:
                size[above] += size[node]
        mains, articles = set(), set()  # named elements that hold one
        for node, tag in enumerate(self.tags):
            if tag in _CONTAINERS and not self.dropped[node]:
                above = self.named[node]
                holds = mains if tag == "main" else articles
                while above and above not in holds:
                    holds.add(above)
                    above = self.named[self.parents[above]]
        left = {0: False}
        for node, names in sorted(self.names.items()):
            comments = names & _COMMENT_NAMES
            holds = node in mains or node in articles and not free and not comments
            wraps = not free and (not comments and size[node] >= WRAPPER_SHARE * every > 0 or size[node] == every > 0)
            left[node] = left[self.named[self.parents[node]]] or not (holds or wraps)
        kept = [(node, [x for x in found if not left[x[1]]]) for node, found in self.texts]
        return [(node, [x for x, _, _ in found], [x for x, _, link in found if link]) for node, found in kept]

    def _text(self, text: str, node: int, in_link: bool) -> None:
        if not text or self.dropped[node]:
            return
        text = html.unescape(text) if "&" in text else text
        named = self.named[node]
        node = self.block[node]
        if self._fresh:
            if not text.strip():
                return
            self.texts.append((node, []))
            self._fresh = False
        self.texts[-1][1].append((text, named, in_link))

    def _read(self, source: str) -> None:
        stack, links, articles, place = [0], 0, 0, 0
        tags, tokens = self.tags, _Tokens(source)
        open_at: dict[str, list[int]] = {}  # depths of the open elements by name
        blocks: list[int] = []  # and of those that are blocks

        def close() -> None:
            nonlocal links, articles
            tag = tags[stack.pop()]
            open_at[tag].pop()
            if tag in _BLOCK:
                blocks.pop()
            links -= tag == "a"
            articles -= tag in _CONTAINERS
            self._fresh |= tag in _BLOCK

        while match := tokens.next(place):
            self._text(source[place : match.start()], stack[-1], links > 0)
            place, tag = match.end(), (match[2] or "").lower()
            if not tag:
                continue
            if match[1]:
                depth = open_at[tag][-1] if open_at.get(tag) else 0
                # A stray end tag inside a block does not end what stands around the block.
                if tag not in _BLOCK and blocks and blocks[-1] > depth:
                    depth = 0
                while depth and len(stack) > depth:
                    close()
                continue
            if tag in _RAW:
                if not match[3].endswith("/"):
                    end = _RAW_ENDS[tag].search(source, place)
                    place = end.end() if end else len(source)
                continue
            if tag == "br":
                self._text(" ", stack[-1], False)
            self._fresh |= tag in _BLOCK
            if tag in _VOID:
                continue
            if ended := _ENDED_BY.get(tag):
                stop = max((open_at[t][-1] for t in _STOPS[tag] if open_at.get(t)), default=0)
                lowest = 0
                for name in ended:
                    depths = open_at.get(name, ())
                    i = bisect.bisect_right(depths, stop)
                    if i < len(depths) and (not lowest or depths[i] < lowest):
                        lowest = depths[i]
                while lowest and len(stack) > lowest:
                    close()
            parent = stack[-1]
            tags.append(tag)
            self.parents.append(parent)
            self.dropped.append(self.dropped[parent] or _unwanted(tag, match[3], articles > 0))
            names = set() if self.dropped[-1] else _named(tag, match[3])
            self.named.append(len(tags) - 1 if names else self.named[parent])
            self.block.append(len(tags) - 1 if tag in _BLOCK else self.block[parent])
            if names:
                self.names[len(tags) - 1] = names
            open_at.setdefault(tag, []).append(len(stack))
            if tag in _BLOCK:
                blocks.append(len(stack))
            stack.append(len(tags) - 1)
            links += tag == "a"
            articles += tag in _CONTAINERS
        self._text(source[place:], stack[-1], links > 0)


def main_text(source: str | None) -> str:
    """The article's blocks in page order with two newlines between them; empty if there are none."""
    page = _Page(source or "")
    blocks = [(node, " ".join("".join(text).split()), len(" ".join("".join(link).split()))) for node, text, link in page.blocks]
    blocks = [block for block in blocks if block[1]]
    if not blocks:
        return ""
    count, parents, tags = len(page.tags), page.parents, page.tags
    score, size, linked = [0.0] * count, [0] * count, [0] * count
    least = LEAST_PARAGRAPH if any(len(text) >= LEAST_PARAGRAPH and tags[n] not in _HEADINGS for n, text, _ in blocks) else 1
    for node, text, link in blocks:
        size[node] += len(text)
        linked[node] += link
        if len(text) < least or tags[node] in _HEADINGS:
            continue
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - link / len(text))
        above, share = node if tags[node] in _OWN_TEXT else max(parents[node], 0), 1.0
        for share in (1.0, 0.5, 1 / 6, 1 / 9):
            score[above] += points * share
            above = parents[above]
            if above < 0:
                break
    for node in range(count - 1, 0, -1):
        size[parents[node]] += size[node]
        linked[parents[node]] += linked[node]
    score = [s * (1 - l / z) if z else 0.0 for s, z, l in zip(score, size, linked, strict=True)]  # noqa: E741
    best = max(range(count), key=lambda node: (score[node], -node)) if any(score) else 0

    above = best
    while above > 0 and tags[above] not in _CONTAINERS:
        above = parents[above]
    chosen = {above if above > 0 else best}
    if above > 0 and tags[above] == "article":  # articles beside it that read like it belong to the text
        for node in range(1, count):
            if tags[node] == "article" and parents[node] == parents[above] and size[node] and linked[node] < 0.25 * size[node]:
                chosen |= {node} if score[node] >= 0.2 * score[above] > 0 else set()
    if above <= 0:
        for node in range(1, count):
            if parents[node] == parents[best] and node != best and size[node]:
                density = linked[node] / size[node]
                chosen |= {node} if (
                    score[node] >= 0.2 * score[best] > 0
                    or tags[node] not in _HEADINGS and density < 0.25 and (size[node] > 80 or not density)
                    or tags[node] in _HEADINGS and not density
                ) else set()
    inside = [False] * count
    for node in range(count):
        inside[node] = node in chosen or parents[node] >= 0 and inside[parents[node]]
    return "\n\n".join(text for node, text, _ in blocks if inside[node])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [main_text(source) for source in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array(map(len, texts), pa.int64()),
        })


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page; no shuffle, one page at a time.

    A null or empty html, and one without text, gives an empty text. Repeated rows and nulls in
    page_id and url stay as they are; other columns are ignored. White space, also a no-break space,
    becomes one space inside a block.
    """
    wanted = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return wanted.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


QUERIES = {"op9_html_text": op9_html_text}
