"""Main text of web pages: the maximum-scoring run of blocks, words against tags."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S
)
NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
SPACE = re.compile(r"\s+")

# Elements of HTML by their part in a page (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg canvas object select option datalist xmp noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CUT_TAGS = set("nav aside footer button dialog menu search head".split())
# Cut unless the page's main blocks stand in them.
FORM_TAGS = ("form", "fieldset")
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
# Words in class, id and role that name parts beside the article, if all words of the value do or say nothing (fixed values).
COMMENT_WORDS = set("comment comments commentlist disqus reply replies respond discussion".split())
CUT_WORDS = COMMENT_WORDS | set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup"
    " modal overlay newsletter subscribe subscription signup sidebar aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs share sharing"
    " social related recommended recommendations footer pagination pager login search toolbar skip complementary contentinfo".split()
)
HEADER_WORDS = set("header masthead topbar banner".split())
PLACE_WORDS = set(
    "area bar block body bottom box btn button buttons center column container count cta desktop div element floating footer form global google gpt group"
    " holder icon icons info inline inner item items js law left link links list main mobile module nav outer page panel primary region right root row"
    " secondary section site slot small sticky sub thread top unit wide wp wrap wrapper".split()
)
SAY_NOTHING = PLACE_WORDS | set("article articles content entry header post posts stories story text title".split())
# Also what articles are about: as the id of a section, an anchor named after its heading.
TOPICS = set("discussion respond social notice notices menu alert search related promotion share sharing".split())
# Containers say nothing of what they hold (fixed values); the other elements are features with weights.
NEUTRAL = set("html body article main div section table tbody thead tfoot tr td th dl hgroup".split())
FEATURES = (BLOCK | {"a", "b", "strong", "em", "i", "marked", "unmarked"}) - NEUTRAL
TAG_COST = 0.2


def _named(attributes: str, tag: str) -> tuple[bool, bool, bool]:
    """Whether a whole class, id or role names a part beside the article, comments, a page header; a heading's names nothing."""
    cut = comment = header = False
    if tag in HEADINGS:
        return cut, comment, header
    for m in NAMES.finditer(attributes):
        for value in (m[2] or m[3] or m[4] or "").split():
            words = {w.lower() for w in NAME_WORD.findall(value)}
            if tag == "section" and m[1].lower() == "id" and words <= TOPICS:
                continue
            words = {w for w in words if len(w) > 2 or w in CUT_WORDS}
            part = words <= CUT_WORDS | SAY_NOTHING
            cut |= part and bool(words & CUT_WORDS)
            comment |= part and bool(words & COMMENT_WORDS)
            header |= words <= HEADER_WORDS | PLACE_WORDS and bool(words & HEADER_WORDS)
    return cut, comment, header


class Block:
    """A stretch of text between block borders: its words, what it stands in, and the tags before it."""

    __slots__ = ("text", "words", "linked", "features", "cut", "tags", "main")

    def __init__(self, text: str, linked: int, features: frozenset, cut: bool, tags: int, main: bool):
        self.text, self.words, self.linked = text, text.count(" ") + 1, linked
        self.features, self.cut, self.tags, self.main = features, cut, tags, main


def blocks(html: str) -> list[Block]:
    """The page's blocks in order. Elements left open, closed twice or cut short are taken as a browser takes them."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, cut, comment, main
    pieces: list[str] = []
    linked = tags = at = links = 0
    size = len(html)

    def flush() -> None:
        nonlocal linked, tags
        text = SPACE.sub(" ", unescape("".join(pieces))).strip()
        pieces.clear()
        if text:
            top = stack[-1] if stack else ("", False, False, False)
            out.append(Block(text, linked, frozenset(x[0] for x in stack), top[1], tags, top[3]))
            tags = 0
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        pieces.append(text)
        if links:
            linked += len(text.split())

    def close(tag: str) -> None:
        nonlocal links
        while stack:
            links -= stack[-1][0] == "a"
            if stack.pop()[0] == tag:
                break

    while at < size:
        found = TOKEN.search(html, at)
        if not found:
            add(html[at:])
            break
        if found.start() > at:
            add(html[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        closing, attributes = found[1] or found[4], found[3] or found[6] or ""
        tags += 1
        if tag in BLOCK:
            flush()
        if closing:
            if any(x[0] == tag for x in stack):
                if tag in BLOCK or not any(x[0] in BLOCK for x in stack[_last(stack, tag) :]):
                    close(tag)
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else size
            continue
        if tag == "br":
            pieces.append(" ")
        if tag in VOID:
            continue
        if tag in BLOCK and any(x[0] == "p" for x in stack):
            close("p")
        if tag in CLOSES and stack and stack[-1][0] in CLOSES[tag]:
            close(stack[-1][0])
        _, cut, comment, main = stack[-1] if stack else ("", False, False, False)
        named, remarks, header = _named(attributes, tag) if attributes else (False, False, False)
        comment = comment or remarks
        if tag in ("article", "main") and not comment:
            cut = cut and any(x[0] in CUT_TAGS for x in stack)
            main = True
        elif tag not in ("html", "body"):
            cut = cut or tag in CUT_TAGS or named or bool(attributes and HIDDEN.search(attributes))
            cut = cut or (not main and (tag == "header" or header))
        cut = cut or comment
        links += tag == "a"
        stack.append((tag, cut, comment, main))
    flush()
    _judge_forms(out)
    return out


def _judge_forms(found: list[Block]) -> None:
    """Forms are cut, and so are fieldsets, unless most words of the main blocks stand in them: then they are containers."""
    marked = any(b.main and not b.cut for b in found)
    body = [b for b in found if not b.cut and (b.main or not marked)]
    for tag in FORM_TAGS:
        if 2 * sum(b.words for b in body if tag in b.features) > sum(b.words for b in body):
            for b in found:
                b.features -= {tag}
    for b in found:
        b.cut = b.cut or not b.features.isdisjoint(FORM_TAGS)


def _last(stack: list, tag: str) -> int:
    return max(i for i, x in enumerate(stack) if x[0] == tag)


def _features(block: Block, marked: bool) -> frozenset:
    found = block.features & FEATURES
    return found | ({"marked"} if block.main else {"unmarked"} if marked else set())


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last (exclusive) of the contiguous run with the greatest sum; the earliest, shortest one of equals."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def main_text(html: str | None, weights: dict[str, float]) -> str:
    """The text of the page's best region, its blocks joined by newlines; without the parts that are cut."""
    found = blocks(html) if html else []
    marked = any(b.main for b in found)
    inside = [i for i, b in enumerate(found) if b.main and not b.cut]
    scores = []
    for i, b in enumerate(found):
        value = 0.5 + sum(weights.get(f, 0.0) for f in _features(b, marked))
        if b.cut:
            # Left out anyway: nothing between the article's parts, and no more than its tags where no mark tells.
            among = inside and inside[0] < i < inside[-1]
            scores.append(0.0 if among else -0.2 * b.words if marked else -min(0.2 * b.words, TAG_COST * b.tags))
        elif b.main:
            scores.append(max(0.5, min(1.0, value)) * b.words)
        else:
            value = max(-1.0, min(1.0, value))
            scores.append((b.words - b.linked) * value + b.linked * min(value, -0.5) - TAG_COST * b.tags)
    first, last = best_run(scores)
    return "\n".join(b.text for b in found[first:last] if not b.cut)


def learn_weights(pages: DataFrame, html_col: str = "html", prior: float = 50.0) -> dict[str, float]:
    """Log odds of a word standing in the article, for each kind of element around it.

    Pages that mark their article (``article`` or ``main``) are the labelled
    ones: words in the mark and outside cut parts are in, all others out. Counts are summed in each batch
    and added up by Spark; one number for each of ``FEATURES`` reaches the driver.
    Without a labelled page the weights are zero, and words count as text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for html in batch.column(0).to_pylist():
                found = blocks(html) if html else []
                if not any(b.main for b in found):
                    continue
                for b in found:
                    inside = b.main and not b.cut
                    for f in (*_features(b, True), "*"):
                        counts.setdefault(f, [0, 0])[0 if inside else 1] += b.words
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))],
                names=["feature", "inside", "outside"],
            )

    counted = pages.select(html_col).mapInArrow(run, "feature string, inside long, outside long")
    rows = counted.groupBy("feature").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).collect()
    total = next(((r["i"], r["o"]) for r in rows if r["feature"] == "*"), (0, 0))
    base = math.log((total[0] + prior) / (total[1] + prior))
    return {r["feature"]: math.log((r["i"] + prior) / (r["o"] + prior)) - base for r in rows if r["feature"] != "*"}


def extract(pages: DataFrame, weights: dict[str, float] | None = None, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """The pages' other columns with the main text of each whole page.

    Words in a marked article always count for it. A linear scan over the page's blocks adds a word's weight (from what it stands in, see ``learn_weights``)
    and takes off a cost for each tag; the contiguous run of greatest sum is
    the article. Parts whose whole class, id or role names a menu, advert, notice, comments or the
    like are left out of it, and so are forms, except those that hold the page. Character references are decoded, white space within a
    block becomes one space, blocks are joined by a newline. A null or empty
    page, and one without text, gives an empty text. Weights are learned from the pages
    themselves where none are given. A column ``text_col`` is replaced; repeated rows are extracted each.
    """
    weights = learn_weights(pages, html_col) if weights is None else weights
    frame = pages.drop(text_col) if text_col != html_col else pages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h, weights) for h in batch.column(at).to_pylist()], pa.string())
            keep = [i for i, name in enumerate(batch.schema.names) if name != html_col]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), texts], names=[*(batch.schema.names[i] for i in keep), text_col])

    at = frame.columns.index(html_col)
    rest = frame.drop(html_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return frame.mapInArrow(run, f"{fields}{', ' if fields else ''}`{text_col}` string")
