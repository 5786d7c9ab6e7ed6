"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass judges each block by itself:
where it stands (navigation, adverts, forms, comments and the like are out, an article element
or another that holds most of the prose is in), how much of it is link text, how long it is and how many of its words are stop words.
Blocks it cannot decide, mostly short ones, inherit in the second pass from the nearest
decided blocks before and after.

Defined results: a null or empty page gives an empty text; broken markup (cut tags or comments,
scripts and the like that are never closed) ends with the page; a head ends with its first content,
an open button, select, object or drawing with its parent, or at the next block if it is never closed; text cut inside a character reference stays as it is;
repeated rows get equal results.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.frames import text_column
from pulsemill.llm.quality import FUNCTION_WORDS

# Thresholds of the first pass.
MOST_LINKS = 0.33
MOST_LINKS_IN_ARTICLE = 0.6
LONG_WORDS = 15
# An element is the main part if it holds this share of the page's prose.
MAIN_SHARE = 0.5
STOP_HIGH, STOP_LOW = 0.25, 0.1

# Tags and words of class names, as HTML and common page templates have them.
_BLOCK_TAGS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_RAW_TAGS = frozenset("script style noscript template textarea iframe title".split())
# Their content is no text, but other than that of a raw tag it ends with their parent, if not by their own end tag.
_MUTE_TAGS = frozenset("svg math select button object canvas".split())
_VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BAD_TAGS = frozenset("nav footer aside form menu dialog".split())
_BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
_BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu sidebar aside "
    "footer header masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social comment comments disqus reply replies respond related recommended "
    "pagination pager toolbar widget skip legal copyright disclaimer".split()
)
_MAIN_WORDS = frozenset("article post entry content story main".split())
_SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}

_TOKEN = re.compile(r"<!--|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_OPEN_END = re.compile(r"<(?:/?[a-zA-Z!?][^<>]*)?\Z")
_NAME = re.compile(r"[a-z]+")

_STOP = frozenset(FUNCTION_WORDS)


@dataclass
class Open:
    """An open element: whether it puts its content out, in the main part, or mutes it."""

    tag: str
    bad: bool
    main: int
    mute: bool = False
    open_ended: bool = False


@dataclass
class Block:
    text: list[str] = field(default_factory=list)
    link_chars: int = 0
    bad: bool = False
    main: int = 0


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}


def _judge_element(tag: str, raw: str, parent: Open | None) -> tuple[bool, int]:
    """Whether an element's own tag and attributes put it out, and how surely it is the main part (0 to 3)."""
    attributes = _attributes(raw) if raw else {}
    names = _NAME.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower())
    role = attributes.get("role", "").lower()
    bad = tag in _BAD_TAGS or role in _BAD_ROLES or (tag == "header" and not (parent and parent.main))
    style = attributes.get("style", "").replace(" ", "").lower()
    bad = bad or "display:none" in style or attributes.get("aria-hidden") == "true" or bool(re.search(r"(?:^|\s)hidden(?:\s|$)", raw))
    main = 0
    if tag not in ("html", "body"):
        marked = not _BAD_WORDS.isdisjoint(names)
        wanted = not _MAIN_WORDS.isdisjoint(names)
        # A name such as "post-header" is a part of the main text, one such as "comments" or "ad" never is.
        bad = bad or (marked and not (wanted and tag != "article" and parent is not None and parent.main > 0))
        if not bad:
            main = 3 if tag == "article" or attributes.get("itemprop") == "articleBody" else 2 if tag == "main" or role == "main" else int(wanted)
    return bad, main


def blocks_of(page: str) -> list[Block]:
    """Blocks of a page in order, with where they stand and how much of them is link text."""
    blocks, stack, links = [Block()], [], 0
    opened: Counter[str] = Counter()  # elements on the stack by name
    at, n, in_head = 0, len(page), False
    lowered, last_end = page.lower(), {}

    def mute() -> bool:
        return bool(stack) and stack[-1].mute

    def put(text: str) -> None:
        nonlocal in_head
        # Text other than that of a raw tag ends the head, whether or not its end tag follows.
        in_head = in_head and not text.strip()
        if text and not in_head and not mute():
            block = blocks[-1]
            block.text.append(text)
            if links:
                block.link_chars += len(text.strip())

    def cut() -> None:
        top = stack[-1] if stack else None
        if blocks[-1].text:
            blocks.append(Block())
        blocks[-1].bad, blocks[-1].main = (top.bad, top.main) if top else (False, 0)
        blocks[-1].link_chars = 0

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            # A tag that the end of the page cuts off is no text.
            put(_OPEN_END.sub("", rest))
            break
        put(page[at : m.start()])
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        if m[2] is None:
            continue
        tag, raw = m[2].lower(), m[3]
        if tag in _RAW_TAGS:
            if not m[1] and not raw.endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
                at = n if end is None else end.end()
            continue
        if tag == "head":
            in_head = not m[1]
            continue
        # The end tag of the head may be left out.
        in_head = in_head and tag not in _BLOCK_TAGS
        if mute() and tag in _BLOCK_TAGS and tag != "option":
            # One that is never closed ends where a block does or begins.
            while stack and stack[-1].tag in _MUTE_TAGS and stack[-1].open_ended:
                opened[stack.pop().tag] -= 1
        if tag in _MUTE_TAGS and not m[1] and not raw.endswith("/"):
            if tag in ("button", "select") and stack and stack[-1].tag == tag:
                opened[stack.pop().tag] -= 1
            if tag not in last_end:
                last_end[tag] = lowered.rfind(f"</{tag}")
            top = stack[-1] if stack else None
            stack.append(Open(tag, bool(top and top.bad), top.main if top else 0, True, last_end[tag] < at))
            opened[tag] += 1
            continue
        if tag == "a":
            links = 0 if m[1] else 1
        if tag in _VOID_TAGS or raw.endswith("/"):
            if tag in _BLOCK_TAGS:
                put(" ")
            continue
        muted = mute()
        if m[1]:
            # All that is passed over is closed, so the stack is walked once in all.
            while opened[tag]:
                last = stack.pop().tag
                opened[last] -= 1
                if last == tag:
                    break
        else:
            closes = _SELF_CLOSING.get(tag, {"p"} if tag in _BLOCK_TAGS else set())
            if stack and stack[-1].tag in closes:
                opened[stack.pop().tag] -= 1
            parent = stack[-1] if stack else None
            bad, main = _judge_element(tag, raw, parent)
            # Inline elements matter only where their own names put them out.
            if tag in _BLOCK_TAGS or bad:
                stack.append(Open(tag, bad or bool(parent and parent.bad), max(main, parent.main if parent else 0), muted))
                opened[tag] += 1
            if bad and tag not in _BLOCK_TAGS and not muted:
                cut()
                continue
        if muted and mute():
            continue
        if tag in _BLOCK_TAGS or (m[1] and blocks[-1].bad != bool(stack and stack[-1].bad)):
            links = links if tag == "a" else 0
            cut()
    return [b for b in blocks if b.text]


GOOD, BAD, UNDECIDED = 1, -1, 0


def first_pass(text: str, link_chars: int, in_main: bool) -> int:
    """What a block is by itself."""
    links = link_chars / len(text)
    words = text.lower().split()
    stops = sum(w.strip(".,;:!?\"'()") in _STOP for w in words) / len(words)
    if links > (MOST_LINKS_IN_ARTICLE if in_main else MOST_LINKS):
        return BAD
    if len(words) >= LONG_WORDS and stops >= STOP_HIGH:
        return GOOD
    if in_main:
        return GOOD if len(words) >= LONG_WORDS and stops >= STOP_LOW else UNDECIDED
    return BAD if len(words) >= LONG_WORDS and stops < STOP_LOW else UNDECIDED


def second_pass(marks: list[int], in_main: bool) -> list[bool]:
    """Undecided blocks take the mark of the nearest decided neighbours; where these differ the nearer one counts.

    A tie, and a page without any decided block, go the way the place suggests: in for the main part.
    """
    n = len(marks)
    before, after = [None] * n, [None] * n
    for found, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        last = None
        for i in order:
            found[i] = last
            if marks[i] != UNDECIDED:
                last = i
    out = []
    for i, mark in enumerate(marks):
        if mark == UNDECIDED:
            sides = [(abs(i - j), marks[j]) for j in (before[i], after[i]) if j is not None]
            nearest = [m for d, m in sides if d == min(x for x, _ in sides)]
            mark = nearest[0] if nearest and len(set(nearest)) == 1 else (GOOD if in_main else BAD)
        out.append(mark == GOOD)
    return out


def _main_rank(found: list[tuple[Block, str]]) -> int:
    """How surely a block must be in the main part: the surest elements that hold most of the page's prose."""
    prose = [0, 0, 0, 0]
    for b, text in found:
        if first_pass(text, b.link_chars, b.main > 0) == GOOD:
            prose[b.main] += len(text)
    total = sum(prose)
    for rank in (3, 2, 1):
        if total and sum(prose[rank:]) >= MAIN_SHARE * total:
            return rank
    return 0 if total else max((b.main for b, _ in found), default=0)


def main_text(page: str) -> str:
    """The main text of a page, blocks joined by one space."""
    found = [(b, " ".join(html.unescape("".join(b.text)).split())) for b in blocks_of(page)]
    found = [(b, text) for b, text in found if text and not b.bad]
    surest = _main_rank(found)
    if surest:
        # What stands in a less sure part is in if it reads like prose by itself.
        found = [(b, text) for b, text in found if b.main >= surest or (b.main and first_pass(text, b.link_chars, False) == GOOD)]
    marks = [first_pass(text, b.link_chars, surest > 0) for b, text in found]
    if surest and GOOD not in marks:
        # Without any block that reads like prose, the element's word is all there is to go by.
        marks = [m if m == BAD else GOOD for m in marks]
    return " ".join(text for (_, text), keep in zip(found, second_pass(marks, surest > 0), strict=True) if keep)


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def extract(column: pa.Array, _: object) -> pa.Array:
        return pa.array([main_text(x) if x else "" for x in column.to_pylist()], pa.string())

    texts = pages.select("page_id", "url", text_column(extract, "string")("html").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
