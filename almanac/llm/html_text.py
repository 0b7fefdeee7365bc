"""Main text of web pages by the maximum-scoring run of words and tags.

A page is a sequence of tags and words. A word scores by where it stands (its block element, in a
link or not) and tags score below zero; both weights are log odds learned from pages whose main
region is marked, with counts summed by Spark. Places and tags do not say whether they are in a main
element; where a page has one that holds most words, that is added to the score as a fixed bonus, or taken
from it outside, and tags inside cost next to nothing, so tables and lists end no run. One linear scan
finds the contiguous run with the highest score: the content region. What stands in boilerplate elements
(menus, adverts, forms, comments and the like, by element and by class, id or role) counts nothing in the
scan and is left out of the region's text; an element that holds most of the page's words is never taken
for one, unless it is marked as reader comments. A page is read once, in time linear in its length, however
deep its elements are nested.

Character references are decoded; white space inside a block, line breaks included, becomes one
space; blocks are joined by an empty line, in page order. Nothing else is dropped or capped. Null
or empty html, or a page without any word of positive score, has an empty text. Repeated rows give
a row each; an empty table gives no rows; other columns are not looked at. Equal scores: the
earlier and shorter run.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import ship, slices

#: Labelled pages, about, that weights are learned from; chosen by a hash of the id, whole pages.
TRAIN_PAGES = 2_000
#: Bounds of a weight, and the least cost of a tag.
MOST, TAG_COST = 4.0, 0.2
#: What a word inside the deciding main element gains, and one outside loses; what a tag inside costs.
MAIN_BONUS, MAIN_TAG_COST = MOST + 1, 0.001

#: A quote opens a value only after an equals sign; elsewhere it is a character of a name.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)|([^<]+|<)", re.S)
_RAW = frozenset({"script", "style", "textarea", "title"})
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_TEXT_BLOCKS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 dd dt figcaption".split())
_CELLS = frozenset("li td th caption".split())
_MAIN = frozenset({"article", "main"})
#: Tags that come in numbers inside content: they cost little where no labelled page has them.
_MANY = frozenset("table thead tbody tfoot tr td th caption ul ol li dl dt dd pre br a b i em strong span u code other".split())
#: Elements that are no part of an article, and words in class, id or role that say the same. Fixed values.
_BOILERPLATE = frozenset("nav footer aside form menu button dialog head fieldset select template svg iframe noscript".split())
_COMMENTS = frozenset("comment comments commentlist respond disqus".split())
_MARKS = _COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies "
    "copyright disclaimer discussion dialog footer form hidden login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pagination popup promo promotion recommended related reply replies search share sharing sidebar signup social sponsor "
    "sponsored subscribe tags toolbar widget widgets alert contentinfo complementary".split())
#: Words that may stand beside a mark in one name, as in site-footer or related-posts. Fixed values.
_BESIDE = frozenset(
    "post posts article articles story stories page site main global top bottom left right primary secondary inner outer wrapper wrap "
    "container holder box block panel bar area section list item items link links button buttons icon icons slot unit zone text content "
    "body title heading reader readers user users thread media input message policy more fb".split())
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)


def _is_mark(word: str, marks: frozenset[str]) -> bool:
    """`cookie-bar` and `site-footer` are, `has-sidebar` and `post-content` are not."""
    parts = [p for p in re.split("[-_]+", word) if p]
    return any(p in marks for p in parts) and all(p in _MARKS or p in _BESIDE for p in parts)


def _marked(attributes: str, in_main: bool = False) -> str:
    """`comments`, `other` or nothing: what class, id and role say. Inside the main element an id names a section, and a discussion is one."""
    said = ""
    for found in _ATTRIBUTE.findall(attributes):
        name, value = found[0].lower(), "".join(found[1:]).lower()
        if name in ("class", "role", "id"):
            words = value.split()
            if any(_is_mark(word, _COMMENTS) for word in words):
                return "comments"
            marks = _MARKS - {"discussion"} if in_main else _MARKS
            if not (in_main and name == "id") and any(_is_mark(word, marks) for word in words):
                said = "other"
        elif name == "hidden" or name == "aria-hidden" and value.strip() == "true" or name == "style" and _NOT_SHOWN.search(value):
            said = "other"
    return said


@dataclass(frozen=True)
class Token:
    """kind: a tag as `+p` or `-p`, or where words stand; words: how many, 0 for a tag; block: number of the text's block."""

    kind: str
    words: int
    text: str
    block: int
    main: bool
    boiler: bool


class _Open:
    """An element that is open: in a main element or not, in which block, link and boilerplate."""

    __slots__ = ("name", "main", "block", "link", "boiler", "starts", "block_at")

    def __init__(self, name: str, main: bool, block: str, link: bool, boiler: int, starts: bool, block_at: int):
        self.name, self.main, self.block, self.link, self.boiler, self.starts, self.block_at = name, main, block, link, boiler, starts, block_at


def tokens(page: str) -> list[Token]:
    """Tags and text runs in order; script, style, textarea and title are left out."""
    out: list[tuple[str, int, str, int, bool, int]] = []  # the last is the innermost boilerplate element, by number
    around, first, under, comments = [-1], [0], [0], [False]  # of each boilerplate element; number 0 is none
    stack = [_Open("", False, "body", False, 0, False, 0)]
    open_names: dict[str, int] = {}
    total, block, at = 0, 0, 0

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            gone = stack.pop()
            open_names[gone.name] -= 1
            if gone.starts:
                under[gone.boiler] = total - first[gone.boiler]

    while at < len(page):
        found = _TOKEN.match(page, at)
        at = found.end()
        closing, name, attributes, text = found.groups()
        top = stack[-1]
        if text is not None:
            decoded = html.unescape(text)
            words = len(decoded.split())
            total += words
            out.append((f"{top.block}|{int(top.link)}", words, decoded, block, top.main, top.boiler))
            continue
        if name is None:
            continue
        name = name.lower()
        if not closing and name in _RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            if not attributes.rstrip().endswith("/"):
                at = end.end() if end else len(page)
            continue
        is_block = name in _BLOCKS
        block += is_block
        boiler = top.boiler
        if closing:
            if open_names.get(name):
                depth = len(stack) - 1
                while stack[depth].name != name:
                    depth -= 1
                pop_to(depth)
        else:
            if is_block and name not in ("html", "body") and top.block == "p":  # a block ends a paragraph
                pop_to(top.block_at)
            if name in ("li", "td", "th", "tr", "dt", "dd", "option") and stack[-1].name == name:
                pop_to(len(stack) - 1)
            if name not in _VOID:
                before = stack[-1]
                said = _marked(attributes, before.main) if name not in ("html", "body") else ""
                boiler, starts = before.boiler, False
                if said or name in _BOILERPLATE or name == "header" and not before.main:
                    boiler, starts = len(around), True
                    around.append(before.boiler)
                    first.append(total)
                    under.append(-1)
                    comments.append(said == "comments")
                stack.append(_Open(name, before.main or name in _MAIN, name if is_block else before.block, before.link or name == "a", boiler, starts,
                                   len(stack) if is_block else before.block_at))
                open_names[name] = open_names.get(name, 0) + 1
        top = stack[-1]
        if name == "br":
            out.append(("+br", 0, " ", block, top.main, boiler))
        else:
            known = name if is_block or name in ("a", "b", "i", "em", "strong", "span", "img", "u", "code", "input", "label") else "other"
            out.append((f"{'-' if closing else '+'}{known}", 0, "", block, top.main, boiler))
    pop_to(1)
    # an element that holds most words is spared, and what is in one that is not spared goes with it
    left_out = [False]
    for number in range(1, len(around)):
        left_out.append(left_out[around[number]] or comments[number] or 2 * under[number] <= total)
    return [Token(kind, words, text, place, main and not left_out[boiler], left_out[boiler]) for kind, words, text, place, main, boiler in out]


def _main_decides(found: list[Token]) -> bool:
    """The main element holds most of the words that are no boilerplate; a teaser or an empty element does not."""
    inside = sum(t.words for t in found if t.main)
    return 2 * inside > sum(t.words for t in found if not t.boiler)


@dataclass(frozen=True)
class Weights:
    words: dict[str, float]
    tags: dict[str, float]

    def of(self, token: Token, has_main: bool) -> float:
        if token.boiler:  # left out in any case, so it neither ends a run nor carries one
            return 0.0
        if token.words:
            own = self.words.get(token.kind, _unseen(token.kind))
            return token.words * (own + (MAIN_BONUS if token.main else -MAIN_BONUS) * has_main)
        if token.kind[0] not in "+-":
            return 0.0
        if has_main and token.main:
            return -MAIN_TAG_COST
        return self.tags.get(token.kind, -TAG_COST / 4 if token.kind[1:] in _MANY else -2 * TAG_COST)


def _unseen(place: str) -> float:
    """Weight of a place that no labelled page has."""
    block, link = place.split("|")
    return (MOST / 2 if block in _TEXT_BLOCKS else 0.75 if block in _CELLS else 0.25) - (2.0 if link == "1" else 0.0)


def _counts(page: str) -> Iterator[tuple[str, int, int]]:
    """(place or tag, inside, outside) of a page with a marked main region."""
    found = tokens(page)
    if not _main_decides(found):
        return
    for t in found:
        if t.boiler:
            continue
        if t.words:
            yield "w" + t.kind, t.words * t.main, t.words * (not t.main)
        elif t.kind[0] in "+-":
            yield "t" + t.kind, int(t.main), int(not t.main)


def learn(pages: DataFrame, key: str = "page_id", html_column: str = "html", rows: int = TRAIN_PAGES) -> Weights:
    """Weights from about `rows` of the pages that have a marked main region."""
    ship(pages.sparkSession)
    marked = pages.select(F.col(key).alias("_key"), F.col(html_column).cast("string").alias("html")).where(
        F.col("html").rlike(r"(?i)<(?:article|main)[\s>]"))
    step = max(1, marked.count() // max(1, rows))
    sample = marked.where(F.pmod(F.xxhash64("_key"), F.lit(step)) == 0).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in slices(batches, "html"):
            for page in batch.column(0):
                for name, inside, outside in _counts(page.as_py()):
                    own = counts.setdefault(name, [0, 0])
                    own[0] += inside
                    own[1] += outside
        yield pa.record_batch({"name": pa.array(list(counts), pa.string()), "inside": pa.array([c[0] for c in counts.values()], pa.int64()),
                               "outside": pa.array([c[1] for c in counts.values()], pa.int64())})

    summed = sample.mapInArrow(run, "name string, inside long, outside long").groupBy("name").agg(F.sum("inside"), F.sum("outside")).collect()
    words, tags = {}, {}
    for name, inside, outside in summed:
        odds = max(-MOST, min(MOST, math.log((inside + 1) / (outside + 1))))
        if name[0] == "w":
            words[name[1:]] = odds
        else:
            tags[name[1:]] = -TAG_COST - max(0.0, -odds)
    return Weights(words, tags)


def best_run(scores: list[float]) -> tuple[int, int]:
    """(start, stop) of the contiguous run with the highest sum; (0, 0) if no sum is above zero."""
    best, total, start, found = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def main_text(page: str, weights: Weights) -> str:
    found = tokens(page)
    has_main = _main_decides(found)
    start, stop = best_run([weights.of(t, has_main) for t in found])
    blocks: dict[int, list[str]] = {}
    for t in found[start:stop]:
        if t.text and not t.boiler:
            blocks.setdefault(t.block, []).append(t.text)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(text for text in texts if text)


def extract(pages: DataFrame, weights: Weights, key: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """(key, url, text, n_chars) for every row."""
    ship(pages.sparkSession)
    narrow = pages.select(F.col(key), F.col(url), F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(page.as_py(), weights) for page in batch.column(2)]
            yield pa.record_batch({key: batch.column(0), url: batch.column(1), "text": pa.array(texts, pa.string()),
                                   "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    return narrow.mapInArrow(run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars long")
