"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element, and every line gets the length of
its text outside links. Boilerplate elements (menus, forms, notices ...) have no text.
Where a page marks an article with text outside links, all lines of the article are
kept, and nothing else. Elsewhere the lengths are summed over sliding windows of lines.
Where the sum surges above a threshold the main text begins, where it dives to zero it
ends, and all lines in between are kept, short ones too. A page whose sums never reach
the threshold uses its largest sum instead.

A class or id makes an element boilerplate if one of its whole words is known as such,
alone or joined with words that say no more than where or what part (``site-header``,
but not ``no-sidebar``), and never an element with more than half of the text of a page
that marks no article outside of it.
An anchor without a target is no link, and a link ends with the block it stands in.

A boilerplate element lasts until its own end, the end of an element around it, or the end
of the page; an article in it is no article of the page (a reader's comment, a teaser),
unless the element has no end of its own and the article follows.

Null and empty pages have an empty text. Unclosed elements end with the page; a cut
tag at the end is dropped. Repeated pages are kept. A page is worked on alone, in one
pass over its tags.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeworks.llm.common import map_batches

WINDOW = 3
SURGE = 80

# HTML element names by what they mean here, and words of boilerplate classes.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BOILERPLATE = frozenset(
    "aside button datalist dialog fieldset footer form head header input menu nav object "
    "option select svg audio video canvas".split()
)
ARTICLE = frozenset(("article", "main"))
#: Elements whose end also ends what was left open in them.
CONTAINERS = frozenset("article aside body div footer form header main nav section table".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLASS_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies disclaimer disqus footer gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "outbrain overlay pagination popup promo promotion related reply replies respond share sharing "
    "sidebar signup social sponsor sponsored subscribe taboola toolbar topbar widget".split()
)
#: Parts of a joined class word that leave its meaning as it is.
CLASS_PARTS = frozenset(
    "area bar block body bottom box btn button buttons container desktop fixed form global google group icon "
    "icons inner item items label left link links list main message mobile module outer page panel policy post "
    "posts primary region right row secondary section side site slot sticky stories sub text thread title top "
    "unit wrap wrapper".split()
)
#: Elements that end where the next of their kind begins.
IMPLIED = frozenset("dd dt li p td th tr".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)

#: A quote opens a value after an equals sign only; a value without quotes ends at white space.
VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[\s/]+|=?[^\s/>=]+(?:\s*=\s*{VALUE}?)?|=)*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
MARKS = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden)(?![\w-])\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*))?", re.I)
TARGET = re.compile(r"(?<![\w-])href\s*=", re.I)
WORDS = re.compile(r"[a-z]{2,}")


def is_boilerplate(name: str, rest: str) -> bool:
    """By the element's name, its role or because it is hidden."""
    if name in BOILERPLATE:
        return True
    if _whole_page(name, rest):
        return False
    for mark, value in MARKS.findall(rest):
        value = value.strip("\"'").lower()
        mark = mark.lower()
        if mark == "role" and value in ROLES:
            return True
        if mark == "hidden" or (mark == "aria-hidden" and value == "true"):
            return True
    return False


def is_named_boilerplate(name: str, rest: str) -> bool:
    """By a class or the id."""
    if _whole_page(name, rest):
        return False
    for mark, value in MARKS.findall(rest):
        if mark.lower() in ("class", "id"):
            for word in value.strip("\"'").lower().split():
                parts = set(WORDS.findall(word))
                if not CLASS_WORDS.isdisjoint(parts) and parts <= CLASS_WORDS | CLASS_PARTS:
                    return True
    return False


def _whole_page(name: str, rest: str) -> bool:
    return name in ("body", "html", *ARTICLE) and "comment" not in rest.lower()


def raw_end(page: str, name: str, at: int) -> int:
    end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
    return end.start() if end else len(page)


def closed_elements(page: str) -> dict[int, int]:
    """Where boilerplate elements with an end of their own begin and end, names matched from the inside."""
    opened: dict[str, list[int]] = {}
    found: dict[int, int] = {}
    at = 0
    while tag := TAG.search(page, at):
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name or name in VOID:
            continue
        if tag["close"] or tag["close2"]:
            if opened.get(name):
                found[opened[name].pop()] = tag.start()
        elif name in RAW:
            at = raw_end(page, name, at)
        elif not (tag["rest"] or tag["rest2"] or "").rstrip().endswith("/"):
            opened.setdefault(name, []).append(tag.start())
    return found


def large_elements(page: str) -> set[int]:
    """Where the elements begin that a class makes boilerplate but that have most of the page's text."""
    opened: dict[str, list[tuple[int | None, int]]] = {}
    inside: list[tuple[int, int]] = []
    at = length = 0
    while tag := TAG.search(page, at):
        length += len(page[at : tag.start()].strip())
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        rest = tag["rest"] or tag["rest2"] or ""
        if not name or name in VOID:
            continue
        if tag["close"] or tag["close2"]:
            if opened.get(name):
                start, before = opened[name].pop()
                if start is not None:
                    inside.append((start, length - before))
        elif name in RAW:
            at = raw_end(page, name, at)
        elif not rest.rstrip().endswith("/"):
            named = tag.start() if is_named_boilerplate(name, rest) else None
            opened.setdefault(name, []).append((named, length))
    length += len(page[at:].strip())
    inside += [(start, length - before) for of in opened.values() for start, before in of if start is not None]
    return {start for start, n in inside if 2 * n > length}


def lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, length outside links, inside the article) per line; boilerplate has no text."""
    found, named = _lines(page, frozenset())
    if any(inside and n for _, n, inside in found):
        return found
    large = large_elements(page) if named else None
    return _lines(page, large)[0] if large else found


def _lines(page: str, spared: set[int] | frozenset[int]) -> tuple[list[tuple[str, int, bool]], bool]:
    """The lines, and whether an element went because of its class; those at ``spared`` stay."""
    found: list[tuple[str, int, bool]] = []
    text: list[str] = []
    plain = 0  # characters outside links
    link = article = 0
    block, link_block, within = "", "", 0  # the block begun last, that of the open link, and blocks in the link
    named = False
    skip, depth, began = "", 0, 0  # the boilerplate element that is open, how often, and where it began
    around: dict[str, int] = {}  # containers that are open, and inside of a boilerplate element
    inner: dict[str, int] = {}
    ends: dict[int, int] | None = None
    heading = False  # inside a heading of a header inside the article

    def end_line() -> None:
        nonlocal plain
        content = " ".join(html.unescape("".join(text)).split())
        if content:
            found.append((content, plain, article > 0))
        text.clear()
        plain = 0

    def add(part: str) -> None:
        nonlocal plain
        if skip and not heading:
            return
        text.append(part)
        if not link:
            plain += len(part.strip())

    at = 0
    while tag := TAG.search(page, at):
        if tag.start() > at:
            add(page[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        closing = bool(tag["close"] or tag["close2"])
        rest = tag["rest"] or tag["rest2"] or ""
        if name in RAW and not closing:
            at = raw_end(page, name, at)
            continue
        if skip:
            if article and skip == "header" and name in HEADINGS:
                end_line()
                heading = not closing
            elif name == skip and name not in VOID:
                depth += -1 if closing else 1
                if not depth:
                    end_line()
                    skip, heading = "", False
                    found.append(("", 0, article > 0))
            elif name in ARTICLE and not closing and not article:
                ends = closed_elements(page) if ends is None else ends
                if ends.get(began, 0) > tag.start():
                    inner[name] = inner.get(name, 0) + 1
                else:  # the element was never closed
                    skip, depth, heading = "", 0, False
                    article = 1
                    around[name] = around.get(name, 0) + 1
            elif name in CONTAINERS and not closing:
                inner[name] = inner.get(name, 0) + 1
            elif name in CONTAINERS and inner.get(name):
                inner[name] -= 1
            elif name in CONTAINERS and around.get(name) and skip != "head":
                end_line()
                skip, depth, heading = "", 0, False
                around[name] -= 1
                article = max(0, article - 1) if name in ARTICLE else article
            continue
        if name in BLOCKS:
            end_line()
        elif name == "br":
            add(" ")
        if not closing and name not in VOID and not rest.rstrip().endswith("/"):
            by_name = is_named_boilerplate(name, rest) and tag.start() not in spared
            named = named or by_name
            if by_name or is_boilerplate(name, rest):
                end_line()
                skip, depth, began, inner = name, 1, tag.start(), {}
                continue
        if name in BLOCKS and name not in VOID:
            if closing:
                link = link if within else 0
                within = max(0, within - 1)
            else:
                if not within and name == link_block and name in IMPLIED:
                    link = 0
                within += 1
            block = "" if closing else name
        if name in CONTAINERS:
            around[name] = max(0, around.get(name, 0) + (-1 if closing else 1))
        if name in ARTICLE:
            article = max(0, article + (-1 if closing else 1))
        elif name == "a":
            link = 0 if closing or not TARGET.search(rest) else 1
            link_block, within = block, 0
    add(page[at:])
    end_line()
    return found, named


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    blocks = lines(page or "")
    if any(inside and n for _, n, inside in blocks):
        return "\n\n".join(text for text, _, inside in blocks if inside and text)
    lengths = [n for _, n, _ in blocks]
    sums = [sum(lengths[max(0, i - window + 1) : i + 1]) for i in range(len(lengths))]
    if not any(sums):
        return ""
    limit = min(surge, max(sums))
    kept: list[str] = []
    i = 0
    while i < len(blocks):
        # a stretch of windows that are not empty; it is main text if it surges
        end = i
        while end < len(blocks) and sums[end]:
            end += 1
        if end > i and max(sums[i:end]) >= limit:
            kept += [text for text, _, _ in blocks[i:end] if text]
        i = max(end, i + 1)
    return "\n\n".join(kept)


def extract(pages: DataFrame, html_column: str = "html", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""

    def function():
        def convert(batch: pa.RecordBatch) -> dict:
            texts = [main_text(p, window, surge) for p in batch.column(2).to_pylist()]
            return {
                "page_id": batch.column(0),
                "url": batch.column(1),
                "text": texts,
                "n_chars": [len(t) for t in texts],
            }

        return convert

    source = pages.select("page_id", "url", html_column)
    kinds = [source.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return map_batches(
        source, function, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long"
    )
