"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

# Names of elements and roles from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot "
    "thead tr ul".split()
)
SPACE = frozenset("br td th wbr img input".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
UNSEEN = frozenset(
    "applet audio button canvas datalist embed frameset head iframe input map math noframes noscript object script select style svg "
    "template textarea title video".split()
)
OUTSIDE = frozenset("aside dialog footer menu nav".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Words that sites use in class names and ids of what isn't the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus feedback gdpr login masthead menu modal nav navbar navigation newsletter notice notification overlay pager "
    "pagination popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription teaser toolbar widget".split()
)
OUTER_HINTS = frozenset("footer header".split())
NEGATED = frozenset("has hide is no not show with without".split())
# Frequent words of the four languages.
STOP_WORDS = frozenset(
    "a and are as at be but by for from had has have he in is it not of on or she that the they this to was were which with you "
    "au aux avec ce cette dans de des du elle en est et il la le les mais ne ou par pas plus pour que qui se sur un une "
    "als an auch auf aus bei das dem den der die ein eine er es für im ist mit nach nicht oder sich sie so und von werden wie zu zum "
    "al como con del el era esta este fue las lo los más muy no o para pero por se ser si sin sobre su una y".split()
)

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title|xmp|iframe|noscript|template)\b(?:[^>"']|"[^"]*"|'[^']*')*>.*?(?:</\1\s*>|\Z)"""
    r"""|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
NAME_PART = re.compile(r"[a-z]+|[0-9]+")

LINKS = 0.5
SHORT = 70
LONG = 200
STOP_LOW, STOP_HIGH = 0.1, 0.25
#: An element is a wrapper of the page, whatever its names say, when it holds more than this share of the text in sight.
WRAPS = 0.5


@dataclass
class Block:
    """A piece of text between block elements, with what the rules look at."""

    text: str
    links: float = 0.0
    heading: bool = False
    article: bool = False
    outside: bool = False
    named: tuple[int, ...] = ()
    label: str = "open"


@dataclass(frozen=True)
class _Place:
    """What holds inside an open element: not in sight, outside by tag or role, in an article, and the elements around it
    whose names hint at something beside the article."""

    unseen: bool = False
    outside: bool = False
    article: bool = False
    named: tuple[int, ...] = ()


def _marks(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, bool]:
    """(unseen, outside, named) of an element by its tag, role, visibility and names."""
    if tag in UNSEEN:
        return True, False, False
    outside, named = tag in OUTSIDE or (tag == "header" and not in_article), tag == "form"
    if not attributes.strip() or tag in ("html", "body", "main"):
        return False, outside, named
    for name, double, single, bare, hidden in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (double or single or bare).lower()
        if hidden or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            return True, outside, named
        if name == "role" and value in ROLES:
            outside = True
        if name in ("class", "id"):
            for word in value.split():
                parts = NAME_PART.findall(word)
                if parts and parts[0] not in NEGATED:
                    ends = {parts[0], parts[-1]}
                    named = named or bool(ends & HINTS or (ends & OUTER_HINTS and not in_article))
    return False, outside, named


def blocks_of(html: str) -> list[Block]:
    """The page's blocks of text in sight, in order. Elements whose names hint at something beside the article are
    numbered; one that holds more than WRAPS of the text is a wrapper, and its names don't count."""
    found: list[Block] = []
    stack: list[tuple[str, _Place]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = numbered = 0
    here = _Place()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                heading = any(opened[tag] for tag in HEADING)
                found.append(Block(text, min(1.0, linked / len(text)), heading, here.article, here.outside, here.named))
            parts.clear()
        linked = 0

    def close_to(depth: int) -> None:
        nonlocal here
        after = stack[depth - 1][1] if depth else _Place()
        if any(tag in BLOCK for tag, _ in stack[depth:]) or (after.outside, after.named) != (here.outside, here.named):
            flush()
        while len(stack) > depth:
            opened[stack.pop()[0]] -= 1
        here = after

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not here.unseen:
            parts.append(piece)
            if opened["a"]:
                linked += len(piece.strip())

    at = 0
    for match in TAG.finditer(html):
        text(html[at : match.start()])
        at = match.end()
        tag = (match[3] or match[6] or "").lower()
        if not tag:
            continue
        if match[2] or match[5]:
            if opened[tag]:
                close_to(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            elif tag in BLOCK:
                flush()
            continue
        if tag in SPACE:
            text(" ")
        if tag in VOID:
            if tag in BLOCK:
                flush()
            continue
        if tag in BLOCK:
            flush()
            # an open paragraph ends where a block starts, an open item where the next one starts
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or (tag in ("li", "dt", "dd", "tr", "option") and stack[k][0] == tag):
                    close_to(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        unseen, outside, named = _marks(tag, match[4] or match[7] or "", here.article)
        inside = here.article or tag in ("article", "main")
        if named:
            numbered += 1
        if (unseen, outside, named) != (here.unseen, here.outside, False) or inside != here.article:
            names = (*here.named, numbered) if named else here.named
            if tag not in BLOCK and not unseen and (outside or named):
                flush()
            here = _Place(here.unseen or unseen, here.outside or outside, inside, names)
        stack.append((tag, here))
        opened[tag] += 1
    text(html[at:])
    flush()
    held: Counter[int] = Counter()
    for block in found:
        for number in block.named:
            held[number] += len(block.text)
    total = sum(len(block.text) for block in found)
    for block in found:
        block.named = tuple(number for number in block.named if held[number] <= WRAPS * total)
    return found


def first_pass(blocks: list[Block]) -> None:
    """Labels what a block's own features decide: good, bad, or open.

    Bad: outside by tag, role or names; beside the article, on a page whose articles hold most of the other text; or
    mostly links. Open: short blocks, headings, and blocks with too few stop words for their length. Good: the rest, and
    on a page without any, its long blocks with few links.
    """
    rest = [b for b in blocks if not (b.outside or b.named)]
    in_article = sum(len(b.text) for b in rest if b.article)
    has_article = in_article > WRAPS * sum(len(b.text) for b in rest if b.links <= LINKS)
    for block in blocks:
        words = block.text.lower().split()
        stops = sum(word in STOP_WORDS for word in words) / max(1, len(words))
        if block.outside or block.named or (has_article and not block.article) or (block.links > LINKS and not block.heading):
            block.label = "bad"
        elif len(block.text) >= SHORT and not block.heading and (stops >= STOP_HIGH or (stops >= STOP_LOW and len(block.text) >= LONG)):
            block.label = "good"
    if not any(b.label == "good" for b in blocks):
        for block in rest:
            if block.label == "open" and (len(block.text) >= SHORT or block.article):
                block.label = "good"


def second_pass(blocks: list[Block]) -> None:
    """Open blocks take the label of their nearest decided neighbours; where those are as near and differ, or there is
    none, they are good inside an article and bad elsewhere.

    Blocks that are bad by where they stand (outside, or beside the article) are no neighbours: what is next to a menu or an
    advert is no menu for that.
    """
    placed = [b for b in blocks if not (b.outside or b.named)]
    articles = any(b.article and b.label != "bad" for b in placed)
    line = [b for b in placed if b.article or not articles or b.label != "bad"]
    nearest: list[list[tuple[int, str]]] = [[] for _ in line]
    for order in (range(len(line)), range(len(line) - 1, -1, -1)):
        last = None
        for k in order:
            if line[k].label != "open":
                last = k
            elif last is not None:
                nearest[k].append((abs(k - last), line[last].label))
    for block, near in zip(line, nearest, strict=True):
        if block.label == "open":
            closest = {label for distance, label in near if distance == min(near)[0]}
            block.label = closest.pop() if len(closest) == 1 else "good" if block.article else "bad"


def decide(blocks: list[Block]) -> list[Block]:
    """Labels every block good or bad, in two passes."""
    first_pass(blocks)
    second_pass(blocks)
    return blocks


def main_text(html: str | None) -> str:
    return "\n".join(block.text for block in decide(blocks_of(html or "")) if block.label == "good")


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` (the page's main text, empty if none) in place of ``html_col``, and ``n_chars``.

    A null or empty page has an empty text; repeated rows give equal rows. Existing columns ``text`` and ``n_chars`` are
    replaced, all others kept. One pass, no shuffle; time and memory grow with the page's length.
    """
    rows = pages.drop("text", "n_chars")
    kept = [name for name in rows.columns if name != html_col]
    rows = rows.select(*kept, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column(len(kept)).to_pylist()]
            columns = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*kept, "text", "n_chars"])

    schema = rows.select(*kept, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return rows.mapInArrow(run, schema)


def op8_html(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
