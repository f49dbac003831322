"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides each block
by its own figures:

* blocks under navigation, page headers, footers, asides, forms, or under an
  element whose class or id says menu, advert, notice, comments and so on are bad;
* blocks with more than ``MOST_LINKED`` of their characters in links are bad;
* long blocks are good where the share of stop words is at least ``LEAST_STOP`` in
  some language; inside ``article`` or ``main`` long blocks are good without, as
  that mark-up is evidence enough;
* other blocks are ambiguous.

In the second pass an ambiguous block takes the label of the nearest decided
blocks before and after it. Within ``article`` or ``main`` only decided blocks of
the same element count: it is bad if all there are bad, else good. Elsewhere it is
good when both sides are, and a heading when the next decided block is.

Character references are decoded once, white space inside a block (``br``
included) becomes one space. Nothing is dropped for its size, and the work is
linear in the page. Null and empty html, and pages without a good block, give an
empty text. Repeated rows are extracted each by itself; an empty table gives no
rows; all other columns are kept in the struct ``page``, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.tables import column, ship, text_column
from arrears.llm.words import slices

# Characters that make a block long, the least share of stop words and the most of linked characters.
LONG = 70
LEAST_STOP = 0.25
MOST_LINKED = 0.33

# Frequent words of a few languages.
STOP_WORDS = {
    "en": "a an and are as at be been but by can for from had has have he her his i if in is it its not of on or our she so that the "
          "their them there they this to was we were what when which who will with would you your",
    "fr": "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus pour qui "
          "que sa se ses son sont sur un une vous",
    "de": "als am an auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im in ist mit "
          "nach nicht noch nur oder sich sie sind so über um und von war wie wir zu zum zur",
    "es": "a al como con de del el en es esta este ha la las le lo los más mi no nos o para pero por que se si sin sobre su sus un una "
          "uno y ya",
    "it": "a al alla che ci come con da dei del della di e gli ha i il in la le lo ma nel non o per più si sono su un una",
    "pt": "a ao as com como da das de do dos e ele em entre mas na no não nos o os ou para pela pelo por que se sem ser seu sua um uma",
    "nl": "aan als bij dat de den der die dit door een en er haar het hij ik in is maar met naar niet of om ook op te tot uit van voor "
          "was wat wij zij zijn",
}

# Tags that end a block, tags without content, and tags whose content is no text of the page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp noembed noframes iframe".split())
UNSEEN_TAGS = frozenset(
    "head noscript template button select option label svg math object canvas audio video map datalist dialog".split()
)
CHROME_TAGS = frozenset("nav header footer aside form menu search fieldset".split())
MAIN_TAGS = frozenset(["article", "main"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

# Words in a class or id, or roles, that mark what is no article; the second list holds inside an article too.
CHROME_WORDS = frozenset(
    "ad ads adv advert advertisement adsense banner billboard breadcrumb breadcrumbs consent cookie cookies copyright disclaimer dropdown "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup "
    "privacy promo promotion related recommended share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags "
    "teaser toolbar topbar widget widgets contentinfo complementary alert alertdialog".split()
)
COMMENT_WORDS = frozenset(
    "comment comments commentlist commentary disqus discussion feedback replies reply respond responses reviews".split()
)

_MARKUP = re.compile(
    r"<(?:[!?]|(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>)"
)
_CUT_TAG = re.compile(r"<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)[^>]*>")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")
_LANGUAGES = list(STOP_WORDS)
_STOPS: dict[str, tuple[int, ...]] = {}
for _i, _language in enumerate(_LANGUAGES):
    for _word in STOP_WORDS[_language].split():
        _STOPS[_word] = (*_STOPS.get(_word, ()), _i)


@dataclass(slots=True)
class Block:
    """A run of text between block-level tags and what the rules know of it."""

    text: str
    linked: int
    heading: bool
    chrome: bool
    region: int
    label: str = ""


@dataclass(slots=True)
class _Open:
    """An element that is still open: whether its text is no article (softly: unless an article opens in it), and the article it begins."""

    tag: str
    chrome: bool = False
    soft: bool = False
    unseen: bool = False
    region: int = 0


@dataclass(slots=True)
class _Page:
    """Blocks found so far, the open elements, and the raw text of the block at hand.

    Only elements that can end a block, hide text or carry a class of their own
    are kept open; counts beside the stack keep every step short, however deep it is.
    """

    html: str
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    raw: list[tuple[str, bool]] = field(default_factory=list)
    links: int = 0
    n_unseen: int = 0
    n_chrome: int = 0
    softly: list[_Open] = field(default_factory=list)
    named: Counter = field(default_factory=Counter)
    open_regions: list[int] = field(default_factory=list)
    regions: int = 0
    last_end: dict[str, int] = field(default_factory=dict)
    low: str = ""

    def text(self, a: int, b: int) -> None:
        if b > a and not self.n_unseen:
            self.raw.append((self.html[a:b], self.links > 0))

    def finish(self) -> None:
        """End the block at hand."""
        if not self.raw:
            return
        joined = "".join(t for t, _ in self.raw)
        text = " ".join(unescape(joined).split())
        if text:
            linked = 0
            if any(is_linked for _, is_linked in self.raw):
                linked = sum(len(" ".join(unescape(t).split())) for t, is_linked in self.raw if is_linked)
            region = self.open_regions[-1] if self.open_regions else 0
            heading = any(e.tag in HEADINGS for e in self.stack[-3:])
            self.blocks.append(Block(text, linked, heading, self.n_chrome > 0, region))
        self.raw.clear()

    def ends_later(self, tag: str, at: int) -> bool:
        """Whether an end tag of this name follows."""
        if tag not in self.last_end:
            self.low = self.low or self.html.lower()
            self.last_end[tag] = self.low.rfind("</" + tag)
        return self.last_end[tag] > at

    def open(self, tag: str, attributes: str, at: int) -> None:
        if tag in MAIN_TAGS:
            # An article shows that what is open around it is a wrapper, or was never closed. Comments stay comments.
            for e in self.softly:
                e.chrome = e.soft = False
            self.n_chrome -= len(self.softly)
            self.softly.clear()
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th"):
            self._close_open(tag)
        element = _Open(tag, unseen=tag in UNSEEN_TAGS)
        if tag in CHROME_TAGS and not (tag == "header" and self.open_regions):
            element.chrome = True
            element.soft = tag in ("form", "fieldset") or not self.ends_later(tag, at)
        if attributes and tag not in ("html", "body", "main"):
            words = names_of(attributes)
            if words & COMMENT_WORDS:
                element.chrome, element.soft = True, False
            elif words & CHROME_WORDS and tag not in MAIN_TAGS and not element.chrome:
                element.chrome = element.soft = True
        if tag in MAIN_TAGS and not element.chrome and not self.n_chrome:
            self.regions += 1
            element.region = self.regions
            self.open_regions.append(element.region)
        self.n_unseen += element.unseen
        self.n_chrome += element.chrome
        if element.soft:
            self.softly.append(element)
        self.named[tag] += 1
        self.stack.append(element)

    def _pop(self, k: int) -> None:
        """Close the elements from place ``k`` on."""
        for e in self.stack[k:]:
            self.n_unseen -= e.unseen
            self.n_chrome -= e.chrome
            if e.soft:
                self.softly.pop()
            self.named[e.tag] -= 1
            if e.region:
                self.open_regions.pop()
        del self.stack[k:]

    def _close_open(self, tag: str) -> None:
        """A start tag ends an element of its own name that is the innermost one open."""
        if self.stack and self.stack[-1].tag == tag:
            self._pop(len(self.stack) - 1)

    def close(self, tag: str) -> None:
        if self.named[tag]:
            k = len(self.stack) - 1
            while self.stack[k].tag != tag:
                k -= 1
            self._pop(k)


def names_of(attributes: str) -> frozenset[str]:
    """Words of the classes, the id and the role; only names of up to two words are evidence."""
    words = set()
    for match in _NAMES.finditer(attributes):
        for name in (match[1] or match[2] or match[3] or "").split():
            parts = _PARTS.findall(_CAMEL.sub("-", name).lower())
            if len(parts) <= 2:
                words.update(parts)
    return frozenset(words)


def blocks_of(html: str) -> list[Block]:
    """Blocks of a page in their order, not labelled yet."""
    page = _Page(html)
    at, end = 0, len(html)
    while at < end:
        start = html.find("<", at)
        if start < 0:
            break
        match = _MARKUP.match(html, start) or _CUT_TAG.match(html, start)
        if match is None:
            # A lone sign, or a tag that the page's end cuts off.
            cut = start + 1 < end and (html[start + 1].isalpha() or html[start + 1] == "/") and html.find(">", start) < 0
            page.text(at, start if cut else start + 1)
            at = end if cut else start + 1
            continue
        page.text(at, start)
        if match["tag"] is None:
            # A comment, a declaration or an instruction.
            mark = "-->" if html.startswith("<!--", start) else ">"
            stop = html.find(mark, start + 2)
            at = end if stop < 0 else stop + len(mark)
            continue
        at = match.end()
        tag, is_end = match["tag"].lower(), match["end"]
        if tag == "br":
            page.raw.append((" ", page.links > 0))
        elif tag == "a":
            page.links = 0 if is_end else 1
        elif is_end:
            if tag in BLOCK_TAGS:
                page.finish()
            page.close(tag)
        elif tag in RAW_TAGS:
            if tag in ("title", "textarea"):
                page.finish()
            stop = re.compile(f"</{re.escape(tag)}[^>]*>?", re.IGNORECASE).search(html, at)
            at = stop.end() if stop else end
        else:
            if tag in BLOCK_TAGS:
                page.finish()
                page.links = 0
            if (tag in BLOCK_TAGS or tag in UNSEEN_TAGS or "-" in tag) and tag not in VOID_TAGS and not match[0].endswith("/>"):
                page.open(tag, match[0][len(tag) + 1 : -1], start)
    if at < end:
        page.text(at, end)
    page.finish()
    return page.blocks


def stop_share(text: str) -> float:
    """Share of stop words among the words, in the language where it is greatest."""
    words = _WORD.findall(text.lower())
    if not words:
        return 0.0
    counts = [0] * len(_LANGUAGES)
    for word in words:
        for i in _STOPS.get(word, ()):
            counts[i] += 1
    return max(counts) / len(words)


def first_pass(block: Block) -> str:
    """Good, bad, or nothing for an ambiguous block."""
    if block.chrome or block.linked > MOST_LINKED * len(block.text):
        return "bad"
    if len(block.text) < LONG or block.heading:
        return ""
    if block.region or stop_share(block.text) >= LEAST_STOP:
        return "good"
    return "bad" if stop_share(block.text) < LEAST_STOP / 2 else ""


def label(blocks: list[Block]) -> None:
    """Both passes, in place."""
    for block in blocks:
        block.label = first_pass(block)
    decided: dict[int, list[int]] = {}
    for i, block in enumerate(blocks):
        if block.label:
            decided.setdefault(0, []).append(i)
            if block.region and not block.chrome:
                decided.setdefault(block.region, []).append(i)
    first = [block.label for block in blocks]
    for i, block in enumerate(blocks):
        if block.label:
            continue
        known = decided.get(block.region, [])
        k = bisect_left(known, i)
        before, after = (known[k - 1] if k else None), (known[k] if k < len(known) else None)
        if block.region:
            near = {first[j] for j in (before, after) if j is not None}
            block.label = "bad" if near == {"bad"} else "good"
        else:
            sides = [first[j] if j is not None else "bad" for j in (before, after)]
            block.label = "good" if sides[1] == "good" and (block.heading or sides[0] == "good") else "bad"


def main_text(html: str | None) -> tuple[str, int, int]:
    """Text of the good blocks, one line each, with the numbers of blocks and of good ones."""
    blocks = blocks_of(html or "")
    label(blocks)
    good = [block.text for block in blocks if block.label == "good"]
    return "\n".join(good), len(blocks), len(good)


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """page (the other columns), text, n_blocks and n_good of each row."""
    ship(pages.sparkSession)
    others = [column(pages, c).alias(c) for c in pages.columns if c != html_col]
    rows = pages.select((F.struct(*others) if others else F.struct(F.lit(0))).alias("page"), text_column(pages, html_col).alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1):
                texts, n, kept = zip(*map(main_text, some.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(kept, pa.int64())],
                    names=["page", "text", "n_blocks", "n_good"],
                )

    added = [T.StructField("text", T.StringType()), T.StructField("n_blocks", T.LongType()), T.StructField("n_good", T.LongType())]
    return rows.mapInArrow(extract, T.StructType([rows.schema["page"], *added]))
