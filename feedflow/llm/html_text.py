"""Main text of web pages by line-block distribution.

A page becomes lines: every boundary of a block ends one, so where parts of a page meet, several boundaries follow each other and leave
blank lines, as paragraphs of one part hardly do. Lines that are mostly links are blank, and so is what is marked as menu, header,
footer, sidebar, notice, advert, form or comments. The lengths of the lines are summed over sliding windows. A stretch of lines starts where
the windows' sums rise from nothing and ends where they dive to nothing again; it is text if it surges above a threshold, which grows with the
highest surge of the page. Stretches between two surges that are near each other are kept with them. Marks of an article weigh: stretches in it count double,
markup within it leaves no blank lines, and its borders do. If no window surges, the stretch with the most text is kept, of those in
a marked article if there is one.

Pages are read in time proportional to their length, however broken their markup is.

Defined results: null and empty html have empty text; pages that repeat are rows of their own; an empty table gives an empty
result; other columns are ignored. Tags that are never closed end with the element around them, comments and scripts that are
never closed reach to the end of the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from feedflow.llm.shared import prepared

# Lines of a window, and the characters at which its sum counts as text.
WINDOW, SURGE = 2, 86
# A surge is also this part of the page's highest, of which LONG characters count.
PART, LONG = 3, 400
# What stands in a marked article weighs this much.
WEIGHT = 2
# Lines between two surges that are kept with them.
BRIDGE = 12
# A line with this share of its characters in links counts as blank.
LINK_SHARE = 0.7

TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
QUOTE_OR_END = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")

# Elements whose content is no text at all; it is skipped up to the end tag.
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas audio video select option".split())
ASIDE = frozenset("head nav footer aside form button menu dialog fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTER = frozenset("html body article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Words of class names and ids that mark what isn't the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription sidebar sidenav rail menu nav navbar navigation breadcrumb breadcrumbs "
    "footer header masthead topbar comment comments commentlist disqus reply replies respond discussion related recommended share sharing social widget "
    "widgets toolbar pagination pager login signin signup search copyright disclaimer legal hidden".split()
)


@dataclass
class Line:
    """A block of text: its pieces, and how many of its characters are links."""

    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    inside: bool = False
    aside: bool = False

    def text(self) -> str:
        return SPACE.sub(" ", "".join(self.pieces)).strip()


class Tokens:
    """Markup of a page from any position on, in one pass: no part is looked through twice for something that isn't there."""

    def __init__(self, page: str) -> None:
        self.page, self.last = page, page.rfind(">")
        self.quoted, self.unclosed = True, set()

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """``(start, end, closing, name, attributes)`` of the next tag, comment or declaration (those without a name)."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), False, "", ""
            if at > self.last:
                at += 1
                continue
            if page.startswith(("<!", "<?"), at):
                return at, page.find(">", at) + 1, False, "", ""
            if tag := TAG.match(page, at):
                end = self.end(tag.end())
                return at, end + 1, bool(tag[1]), tag[2].lower(), page[tag.end() : end]
            at += 1
        return None

    def end(self, at: int) -> int:
        """Where a tag ends: at the first ``>`` outside of quotes, or the first at all if a quoted value never ends. From then on quotes don't count."""
        place = at
        while self.quoted and (found := QUOTE_OR_END.search(self.page, place)):
            if found[0] == ">":
                return found.start()
            place = self.page.find(found[0], found.end()) + 1
            if not place:
                break
        self.quoted = False
        return self.page.find(">", at)

    def after(self, name: str, at: int) -> int | None:
        """Behind the next end tag of this name."""
        if name not in self.unclosed:
            close = re.compile(rf"</{re.escape(name)}\b", re.IGNORECASE).search(self.page, at)
            if close and close.end() <= self.last:
                return self.page.find(">", close.end()) + 1
            self.unclosed.add(name)
        return None


def is_aside(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is marked as something else than the article."""
    if name in ASIDE or name == "header" and not in_article:
        return True
    if not attributes.strip() or name in OUTER:
        return False
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and value in ROLES or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key in ("class", "id") and not MARKS.isdisjoint(re.split(r"[\s_-]+", value)):
            return True
    return False


def lines_of(page: str, forms: bool = True) -> list[Line]:
    """The page's blocks of text in order; those that are no part of the article are marked ``aside``, with ``forms`` those of forms too."""
    lines, line = [], Line()
    article = links = 0
    # The element that is being skipped as something else: its name and how many of that name are open within.
    skipped, depth, at = "", 0, 0
    paragraph = False
    end = len(page)
    tokens = Tokens(page)
    while at < end:
        found = tokens.next(at)
        stop = found[0] if found else end
        if stop > at:
            piece = html.unescape(page[at:stop])
            line.pieces.append(piece)
            if links:
                line.linked += len(piece.strip())
        if not found:
            break
        _, at, closing, name, attributes = found
        if not name:
            continue
        if name in RAW and not closing:
            if attributes.rstrip().endswith("/") and name in ("svg", "math"):
                continue
            at = tokens.after(name, at) or (end if name in ("script", "style", "textarea", "title") else at)
            continue
        if name == "br":
            line.pieces.append(" ")
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        starts_aside = not closing and not skipped and name not in VOID and (forms or name != "form") and is_aside(name, attributes, article > 0)
        ends_aside = bool(skipped) and closing and (name in OUTER or name == skipped and depth == 1)
        if name in BLOCKS or starts_aside or ends_aside:
            line.inside, line.aside = article > 0, bool(skipped)
            lines.append(line)
            line = Line()
            if paragraph and not (name == "p" and closing):
                # A paragraph that is never closed ends here, which is a boundary of its own.
                lines.append(Line(inside=article > 0, aside=bool(skipped)))
            paragraph = name == "p" and not closing
        if starts_aside:
            skipped, depth = name, 1
            continue
        if ends_aside:
            skipped, depth = "", 0
        elif skipped and name == skipped:
            depth += -1 if closing else 1
        if name in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
    line.inside, line.aside = article > 0, bool(skipped)
    lines.append(line)
    return lines


def distribution(lengths: list[int]) -> list[int]:
    """Sums of the lengths over the window that begins at each line."""
    return [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]


def spans(sums: list[int]) -> list[tuple[int, int]]:
    """Line ranges from where the sums rise from nothing to where they dive to nothing."""
    found, at = [], 0
    while at < len(sums):
        start = at
        while at < len(sums) and sums[at]:
            at += 1
        if at > start:
            found.append((start, at))
        at += 1
    return found


def stretches(lengths: list[int], inside: list[bool]) -> list[tuple[int, int]]:
    """Line ranges that surge, with what lies between near ones; if there is none, the range with the most text, ``inside`` lines first."""
    sums = distribution(lengths)
    ranges = spans(sums)
    marked = {(a, b): any(own and n for n, own in zip(lengths[a:b], inside[a:b], strict=True)) for a, b in ranges}
    heights = {(a, b): max(sums[a:b]) * (WEIGHT if marked[a, b] else 1) for a, b in ranges}
    highest = min(max(heights.values(), default=0), LONG)
    surging = [r for r in ranges if heights[r] > SURGE and heights[r] * PART >= highest]
    if not surging:
        return sorted(ranges, key=lambda r: (not marked[r], -sum(lengths[r[0] : r[1]])))[:1]
    found, kinds = surging[:1], [marked[r] for r in surging[:1]]
    for a, b in surging[1:]:
        first, end = found[-1]
        # Marks that differ from the surges' own say that what lies between is something else.
        kind = kinds[-1]
        if a - end <= BRIDGE and kind == marked[a, b] and inside[end:a].count(kind) == a - end:
            found[-1] = (first, b)
        else:
            found.append((a, b))
            kinds.append(marked[a, b])
    return found


def kept_text(lines: list[Line], surging: bool = False) -> list[str]:
    """The blocks of the main text; with ``surging`` only if a window surges."""
    held = [(line, line.text()) for line in lines]
    article = any(text and line.inside and not line.aside for line, text in held)
    rows: list[tuple[int, str, bool]] = []
    for line, text in held:
        own = article and line.inside
        if own and (line.aside or not text):
            continue
        if rows and own != rows[-1][2]:
            rows += [(0, "", own)] * WINDOW
        keep = not line.aside and (own or line.linked < LINK_SHARE * len(text))
        rows.append((len(text), text, own) if keep else (0, "", own))
    lengths = [n for n, _, _ in rows]
    if surging and max(distribution(lengths), default=0) <= SURGE:
        return []
    return [text for a, b in stretches(lengths, [own for _, _, own in rows]) for n, text, _ in rows[a:b] if n]


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by blank lines. A page that has text in forms only is read again without minding forms, if that surges."""
    page = page or ""
    return "\n\n".join(kept_text(lines_of(page)) or ("<form" in page.lower() and kept_text(lines_of(page, forms=False), surging=True)) or [])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    prepared(pages.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(pages["page_id"].cast("bigint").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"])
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
