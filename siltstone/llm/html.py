"""Main text of web pages by two-pass block rules.

Pass one splits a page into blocks and decides those with clear evidence: link density, stop-word density and
length, in articles as elsewhere; copyright lines; and what the page itself marks as menu, form, footer, advert and
the like. Pass two lets each ambiguous block inherit the label of its nearest decided neighbour, first
among those of its own container; a heading goes with what follows it.
"""

from __future__ import annotations

import bisect
import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm import _text as T

# Function words of four languages.
STOP_WORDS = frozenset(
    "the of and to in a is that it for on was be with as by this at are from or an not have has but they which you were his her their had all"
    " der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei"
    " de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec aux ou son"
    " el los y del las por con no una su para al lo como más pero sus o este ha si porque esta entre cuando".split()
)
# Elements whose content is never text, elements that are never main text, and elements that end a block.
RAW = frozenset("script style noscript template svg iframe object canvas textarea select option title".split())
AWAY = frozenset("nav header footer aside form button dialog menu fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br button".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that hold the page's text, whatever their class, id or role says.
WHOLE = frozenset("html body main article".split())
# Class and id names, or their leading parts, that mark page furniture.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup"
    " sidebar widget related recommended nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar masthead footer copyright comment comments commentlist disqus replies respond share sharing social login search discussion discussions adbox adslot adunit".split()
)
# Marks that count as the last part of a name too (site-footer), and parts with which a name tells of something elsewhere (has-sidebar).
LAST = frozenset("ad ads advert adverts advertisement banner sidebar nav navbar navigation menu breadcrumb breadcrumbs pagination masthead footer copyright comments commentlist newsletter".split())
# Parts that leave a name the mark's: of containers, places and sizes. With any other part (menu-of-the-day) the name is another.
PARTS = frozenset(
    "area bar block body bottom box button buttons col column container content desktop fixed form group head icon icons inner item items label large left link links list main message messages mobile module panel policy primary right row"
    " secondary section sticky slot small text thread threads title top unit wide wrap wrapper post posts article articles".split()
)
STATES = frozenset("has have with without no not is hide show hidden".split())
# Roles that mark page furniture.
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# Elements that group blocks, and headings.
GROUPS = frozenset("html body main article section div center td blockquote details figure header footer nav aside form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Characters and shares of pass one.
SHORT, LONG, STOP_SHARE, LINK_SHARE = 70, 200, 0.25, 0.5

# a quoted value may hold ">"; a quote that opens no value is a plain character
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>|<[!?][^>]*>", re.S)
_CLASS = re.compile(r"\b(class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HREF = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)
_ROLE = re.compile(r"\brole\s*=\s*[\"']?([a-z]+)", re.I)
_HIDDEN = re.compile(r"\bhidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_COPYRIGHT = re.compile(r"\s*(?:©|\(c\)\s|copyright\b)", re.I)
_ENDS = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}


class Block(NamedTuple):
    """Text, characters in links, whether the page marks it as furniture, whether in an article, whether a heading, its container."""

    text: str
    links: int
    away: bool
    article: bool
    heading: bool = False
    group: int = 0


def _furniture(name: str, attributes: str) -> bool:
    if name in AWAY:
        return True
    if not attributes:
        return False
    if name not in WHOLE:
        for m in _CLASS.finditer(attributes):
            for word in (m[2] or m[3] or m[4] or "").lower().split():
                parts = re.split("[_-]+", word.strip("_-"))
                named = parts[0] in MARKS and all(x in MARKS or x in PARTS or x.replace("x", "").isdigit() for x in parts[1:])
                if named or parts[-1] in LAST and STATES.isdisjoint(parts):
                    return True
        role = _ROLE.search(attributes)
        if role and role[1].lower() in ROLES:
            return True
    return bool(_HIDDEN.search(attributes))


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, in time linear in its length."""
    out, parts, links = [], [], 0
    stack: list[tuple[str, bool, bool]] = []  # open containers: name, furniture, article
    groups, made = [0], 0  # containers that group blocks, by number
    away = article = False
    in_link, at = 0, 0
    last_close = max((m.start() for m in re.finditer(r"</a\b", page, re.I)), default=-1)

    def flush():
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, links, away, article, bool(stack) and stack[-1][0] in HEADINGS, groups[-1]))
            parts.clear()
        links = 0

    def close(k: int):
        nonlocal away, article
        for name, _, _ in stack[k:]:
            if name in GROUPS:
                groups.pop()
        del stack[k:]
        away, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)

    def add(raw: str):
        nonlocal links
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                links += len(text.strip())

    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in RAW:
            if not m[1] and not m[3].endswith("/"):
                end = _ENDS[name].search(page, at)
                at = end.end() if end else n
            continue
        if name == "a":
            # an anchor without a target, or one that nothing closes, is no link
            in_link = int(not m[1] and _HREF.search(m[3]) is not None and last_close >= at)
            continue
        if name not in BLOCKS:
            if not m[1] and name not in VOID and m[3] and _furniture(name, m[3]):
                flush()
                stack.append((name, True, article))
                away = True
            elif m[1] and stack and stack[-1][0] == name:
                flush()
                close(len(stack) - 1)
            continue
        flush()
        if name in VOID or name == "p" and not _CLASS.search(m[3]):
            if name == "p" and stack and stack[-1][0] == "p":
                close(len(stack) - 1)
            continue
        if not m[1]:
            away = away or _furniture(name, m[3])
            article = article or name in ("article", "main")
            stack.append((name, away, article))
            if name in GROUPS:
                made += 1
                groups.append(made)
        else:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if k is not None:
                close(k)
    flush()
    return out


def judge(block: Block) -> tuple[bool | None, str]:
    """Pass one: (main text, boilerplate or undecided; the rule) of a block that the page does not mark."""
    size = len(block.text)
    if block.links > LINK_SHARE * size:
        return False, "links"
    if size < LONG and _COPYRIGHT.match(block.text):
        return False, "copyright"
    if size < SHORT or block.heading:
        return None, "short"
    tokens = block.text.lower().split()
    share = sum(t.strip(".,;:!?\"'()") in STOP_WORDS for t in tokens) / len(tokens)
    if share >= STOP_SHARE:
        return True, "stop words"
    if size >= LONG and block.links == 0 and (share >= STOP_SHARE / 2 or block.article):
        return True, "length"
    return None, "few stop words"


def classify(found: list[Block]) -> list[bool]:
    """Which blocks are main text.

    What the page marks as furniture is not, nor is anything outside the article where there is one. The rest is
    judged block by block; an undecided one inherits from the nearest decided one of its container, or of the
    page where its container has none; at equal distance text wins, and a heading asks what follows it
    first. Where no block is taken in pass one, the undecided ones are text.
    """
    inside = any(x.article and not x.away for x in found)
    rest = [i for i, x in enumerate(found) if not x.away and (x.article or not inside)]
    label = [judge(found[i])[0] for i in rest]
    out = [False] * len(found)
    if True not in label:
        for k, i in enumerate(rest):
            out[i] = label[k] is None
        return out
    every = [k for k, x in enumerate(label) if x is not None]
    mine: dict[int, list[int]] = {}
    for k in every:
        mine.setdefault(found[rest[k]].group, []).append(k)
    for k, i in enumerate(rest):
        x = label[k]
        if x is None:
            decided = mine.get(found[i].group) or every
            at = bisect.bisect(decided, k)
            before, after = decided[at - 1 : at] if at else [], decided[at : at + 1]
            if found[i].heading and after:
                x = label[after[0]]
            else:
                best = min(abs(j - k) for j in before + after)
                x = any(label[j] for j in before + after if abs(j - k) == best)
        out[i] = bool(x)
    return out


def main_text(page: str | None) -> str:
    """The main text of one page; empty for null, blank or text-free pages."""
    if not page:
        return ""
    found = blocks(page)
    return " ".join(b.text for b, keep in zip(found, classify(found)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null or empty html: empty text, 0 characters. Null page_id or url pass through. Repeated rows are
    answered one by one. Other columns are ignored. Empty table: empty result. Pages are whole,
    whatever their length.
    """

    def run(batches):
        for b in T.slices(batches, column="html"):
            texts = [main_text(x) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(T.frugal(run), "page_id long, url string, text string, n_chars long")
