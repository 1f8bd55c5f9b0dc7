"""Main text of web pages by the distribution of text over lines.

Markup is stripped into lines, one per block element in page order. A line counts with the length
of its text outside links; lines of menus, headers, footers, sidebars, notices, adverts, forms and
reader comments count zero. Where a page marks its article, all lines in it but those of these kinds are the text, linked or
not; there a class, id or role counts only by the word that names the thing (related-work is work). Elsewhere the lengths
are summed over sliding windows of lines. A surge is where the sums rise from zero, the dive where they
fall back to it; stretches between that reach ``enough`` characters, or a share of the highest sum, are kept with the
linked lines that adjoin them, and from them all lines that are not of those kinds.

Null or empty pages, and pages without text, give an empty text. Pages may be cut off or badly nested: a
closing tag ends what is open inside it. Repeated rows are extracted one by one. Columns other than
the named ones are not carried. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackline.llm.bpe import portions

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)/?>"
    r"|</?[a-zA-Z][^>]*\Z",
    re.DOTALL,
)
HINTS = re.compile(r"""\b(class|id|role|hidden|aria-label|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Elements of HTML by what they do.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "meter", "output", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "area", "base", "link", "meta", "param", "source", "track",
}
APART = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg", "object", "canvas", "head", "audio", "video", "datalist"}
MAIN = {"article", "main"}
# Words of class, id and role that name what is not the article.
APART_WORDS = {
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr",
    "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "pager", "pagination", "popup", "promo", "promoted", "related", "replies", "respond", "search", "share", "sharing",
    "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "teaser", "toolbar",
    "widget", "widgets",
}
MAIN_WORDS = {"article", "main"}
ABOUT_OTHERS = {"has", "no", "with", "without", "is"}  # has-sidebar: an element beside such a one
# Words at the end of a class that say what shape a thing has, not what it is: ad-box, share-buttons.
SHAPES = {
    "area", "articles", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "form", "group", "icons", "inner",
    "item", "items", "left", "link", "links", "list", "outer", "panel", "posts", "right", "row", "section", "slot", "stories",
    "text", "top", "unit", "wrap", "wrapper",
}
OWN_HEADER = {"article", "post", "entry", "content", "story"}  # article-header


class Line:
    __slots__ = ("text", "linked", "apart", "main")

    def __init__(self, text: str, linked: int, apart: bool, main: bool):
        self.text, self.linked, self.apart, self.main = text, linked, apart, main


def _hints(attributes: str) -> tuple[set[str], set[str], bool]:
    """Words of class, id and role; of those the ones that name the thing; whether the element is hidden.

    The last word of a name says what the thing is, but for shapes: a cookie-notice is a notice and share-buttons
    are for sharing, but related-work is work and a widget-title is a title.
    """
    words: set[str] = set()
    things: set[str] = set()
    hidden = False
    if attributes and not attributes.isspace():
        for name, value in HINTS.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden":
                hidden = True
            elif name == "style":
                hidden |= "display:none" in value.replace(" ", "").lower()
            elif name != "aria-label":
                for token in value.split():
                    named = [w.lower() for w in WORDS.findall(token)]
                    own = set(named)
                    if not own & ABOUT_OTHERS:
                        words |= own - {"header"} if own & OWN_HEADER else own
                        while len(named) > 1 and (named[-1] in SHAPES or named[-1].isdigit()):
                            named.pop()
                        things |= set(named[-1:]) - ({"header"} if own & OWN_HEADER else set())
    return words, things, hidden


def lines(page: str) -> list[Line]:
    """The blocks of a page that have text, in page order."""
    out: list[Line] = []
    open_elements: list[tuple[str, bool, bool]] = []  # name, in something apart, in the article
    parts: list[str] = []
    linked: list[str] = []
    apart = main = False
    links = 0

    def end_line() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Line(text, len(" ".join(html.unescape("".join(linked)).split())), apart, main))
            parts.clear()
        linked.clear()

    at = 0
    while True:
        found = TAG.search(page, at)
        piece = page[at : found.start() if found else len(page)]
        if piece:
            parts.append(piece)
            if links:
                linked.append(piece)
        if not found:
            break
        at = found.end()
        closing, name, attributes = found.group(1, 2, 3)
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
            if links == 0 and linked:
                linked.append(" ")
        if name == "br":
            parts.append(" ")
            continue
        if not closing and name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in INLINE:
            if name != "span" and name != "a":
                continue
            if closing or not _hints(attributes)[1 if main else 0] & APART_WORDS:
                if not (closing and open_elements and open_elements[-1][0] == name and name == "span"):
                    continue
        end_line()
        if closing:
            for depth in range(len(open_elements) - 1, -1, -1):
                if open_elements[depth][0] == name:
                    del open_elements[depth:]
                    break
        elif name not in VOID:
            if name in {"p", "li", "dt", "dd", "tr", "td", "th", "option"}:
                if open_elements and open_elements[-1][0] == name:  # its end tag was left out
                    open_elements.pop()
                    _, apart, main = open_elements[-1] if open_elements else ("", False, False)
            words, things, hidden = _hints(attributes)
            inside_main = main or name in MAIN or bool(words & MAIN_WORDS and name in {"div", "section"})
            kept = name == "header" and main  # the head of the article itself
            now_apart = apart or hidden or (name in APART and not kept)
            telling = (things if main else words) & APART_WORDS  # inside the article only what names the thing itself
            if telling and name not in {"html", "body"} | MAIN - ({"article"} if main else set()):
                now_apart = now_apart or not (kept and telling <= {"header"})
            open_elements.append((name, now_apart, inside_main))
        _, apart, main = open_elements[-1] if open_elements else ("", False, False)
    end_line()
    return out


def main_text(page: str | None, window: int = 3, rise: float = 0.2, enough: int = 10) -> str:
    """The lines between the surges and dives of a page, joined by a space."""
    found = lines(page or "")
    marked = any(x.main and not x.apart for x in found)
    wanted = [not x.apart and (x.main or not marked) for x in found]
    if marked:
        return " ".join(x.text for x, ok in zip(found, wanted) if ok)
    lengths = np.array([len(x.text) - min(x.linked, len(x.text)) if ok else 0 for x, ok in zip(found, wanted)], np.int64)
    if not lengths.sum():
        return ""
    sums = np.convolve(lengths, np.ones(window, np.int64))  # sums[i]: lines i - window + 1 to i
    filled = np.r_[0, (sums > 0).astype(np.int8), 0]
    surges, dives = np.flatnonzero(np.diff(filled) == 1), np.flatnonzero(np.diff(filled) == -1)
    kept = [False] * len(found)
    for surge, dive in zip(surges, dives):  # the first line of the window after a surge is the surge itself
        if sums[surge:dive].max() >= min(rise * sums.max(), enough):
            while surge and wanted[surge - 1] and not lengths[surge - 1]:  # linked lines that adjoin
                surge -= 1
            while dive < len(found) and wanted[dive] and not lengths[dive]:
                dive += 1
            kept[surge:dive] = wanted[surge:dive]
    return " ".join(x.text for x, ok in zip(found, kept) if ok)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), page: str = "html") -> DataFrame:
    """``keep``, text and n_chars for every page. n_chars counts code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "page"):
            texts = [main_text(x.as_py()) for x in batch.column("page")]
            columns = [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), *columns], ["kept", "text", "n_chars"])

    named = pages.select(F.struct(*keep).alias("kept"), F.col(page).alias("page"))
    kept = named.schema["kept"].dataType.simpleString()
    done = named.mapInArrow(run, f"kept {kept}, text string, n_chars long")
    return done.select(*[F.col("kept")[c].alias(c) for c in keep], "text", "n_chars")
