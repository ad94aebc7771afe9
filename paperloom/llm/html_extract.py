"""Main text of web pages by line-block distribution.

Markup is stripped with every block element on a line of its own; elements that
never hold the article (menus, forms, scripts, notices, comments and so on)
leave an empty stretch. A line counts with the characters that are not links.
Sums over sliding windows of lines surge where a run of text begins and dive to
zero where it ends or meets an empty stretch; the runs that surge far enough are
the article, and so are short runs of the same container (the innermost div,
section, article, main, table cell or body around a line), such as a closing
sentence behind an advert.

Tags are hints: an article or main element is one container, and where a run in
one surges, or no run does anywhere, runs outside are left out. If no run surges
and there is no such element, the run with most text is kept. Elements whose end
tags may be left out (p, li, dt, dd, option, table rows and cells) end where HTML
says. Defined results: a null or empty page, or one without text, gives an empty
text; white space within a block becomes one space; repeated rows each give a
row; a null page_id stays null; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm import shared

#: Lines of a window, and the characters of a window that make a surge.
WINDOW, SURGE = 3, 80

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-hidden|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_RAW = frozenset("script style noscript template textarea title iframe object canvas video audio select".split())
_SKIP = frozenset("nav footer aside form button dialog menu label fieldset datalist head".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_OUTER = frozenset("article main".split())
_CONTAINERS = frozenset("article main div section body td th".split())
#: Elements that a start tag ends where they are open, and the elements that it does not look beyond.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select", "datalist")),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tr", "td", "th"), ("table",)), "tfoot": (("tbody", "thead", "tr", "td", "th"), ("table",)),
}
_P_STAYS = frozenset("br option".split())
_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner banners sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments commentlist disqus "
    "share sharing social related newsletter subscribe subscription popup modal overlay widget widgets copyright pagination toolbar login signup".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
_SPLIT = re.compile(r"[^a-z]+")


def _boilerplate(name: str, attributes: str, inside: bool) -> bool:
    if name in _SKIP or name == "header" and not inside:
        return True
    if not attributes or name in ("body", "html", "article", "main", "a"):
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in _ROLES:
            return True
        if key in ("class", "id") and not _NAMES.isdisjoint(_SPLIT.split(value)):
            return not (inside and name in ("header", "h1", "h2") and "header" in value)
    return False


def lines_of(html: str) -> list[tuple[str, int, bool, int]]:
    """(text, characters outside links, within article or main, container's number) per block; an empty text is a removed stretch."""
    out: list[tuple[str, int, bool, int]] = []
    homes, made = [0], 0  # the containers around, innermost last; the outermost article or main has no other inside
    stack: list[str] = []
    skip_at = link_at = outer_at = None  # depth of the element in which text is skipped, a link, the article
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            out.append((text, max(0, len(text.replace(" ", "")) - linked), outer_at is not None, homes[-1]))
        pieces.clear()
        linked = 0

    def close(depth: int) -> None:
        """The element at the depth ends, and with it what is in it."""
        nonlocal skip_at, link_at, outer_at
        if skip_at is not None and depth <= skip_at:
            skip_at = None
        if link_at is not None and depth <= link_at:
            link_at = None
        if outer_at is not None and depth <= outer_at:
            flush()
            outer_at = None
        del homes[1 + sum(x in _CONTAINERS for x in stack[:depth]) :]
        del stack[depth:]

    def imply(name: str) -> None:
        """The start tag ends elements whose end tags may be left out."""
        ended, beyond = _ENDS.get(name, ((), ()))
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth] in beyond:
                break
            if stack[depth] in ended:
                close(depth)
        if name not in _P_STAYS:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth] == "p":
                    close(depth)
                    break
                if stack[depth] in _BLOCK:
                    break

    at, size = 0, len(html)
    while at < size:
        m = _TAG.search(html, at)
        stop = m.start() if m else size
        if stop > at and skip_at is None:
            piece = unescape(html[at:stop])
            pieces.append(piece)
            if link_at is not None:
                linked += len("".join(piece.split()))
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in _BLOCK:
            flush()
        if closing:
            if name in stack:
                close(len(stack) - 1 - stack[::-1].index(name))
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if name in _VOID or attributes.endswith("/") and name not in _BLOCK:
            continue
        if name in _BLOCK:
            imply(name)
        stack.append(name)
        depth = len(stack) - 1
        if name in _CONTAINERS:
            made += 1
            homes.append(made if outer_at is None else homes[-1])
        if skip_at is None and _boilerplate(name, attributes, outer_at is not None):
            flush()
            skip_at = depth
            out.append(("", 0, outer_at is not None, homes[-1]))
        if name in _OUTER and outer_at is None and skip_at is None:
            outer_at = depth
        if name == "a" and link_at is None:
            link_at = depth
    flush()
    return out


def main_text(html: str | None) -> str:
    lines = lines_of(html or "")
    if not lines:
        return ""
    # sums over the windows that begin at each line, with empty windows at the end
    counts = np.array([x[1] for x in lines] + [0] * WINDOW)
    sums = np.convolve(counts, np.ones(WINDOW, int))[WINDOW - 1 : WINDOW - 1 + len(lines)]
    runs, begin = [], None
    for k, (text, own, _, _) in enumerate(lines):
        # a dive: a removed stretch, or this line has no text of its own and neither has what follows in the window
        if begin is not None and (not text or sums[k] == 0):
            runs.append((begin, k))
            begin = None
        if own and begin is None:
            begin = k
    if begin is not None:
        runs.append((begin, len(lines)))
    if not runs:
        return ""
    kept = [r for r in runs if max(sums[r[0] : r[1]]) >= SURGE]
    if inside := [r for r in kept or runs if any(x[2] for x in lines[r[0] : r[1]])]:
        kept = inside
    kept = kept or [max(runs, key=lambda r: counts[r[0] : r[1]].sum())]
    homes = {x[3] for b, e in kept for x in lines[b:e] if x[0]}
    near = [r for r in runs if r in kept or any(x[3] in homes for x in lines[r[0] : r[1]] if x[0])]
    only = any(x[2] for b, e in kept for x in lines[b:e])
    return "\n".join(x[0] for b, e in near for x in lines[b:e] if x[0] and (x[2] or not only))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): one row per row of pages."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = [main_text(h) for h in part["html"]]
            yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return shared.mapped(rows, run, "page_id long, url string, text string, n_chars long")


def op1_html(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
