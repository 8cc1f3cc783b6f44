"""HTML extraction by tree scoring.

A tolerant scanner turns markup into a tree. Subtrees that are never article
text (menus, headers, footers, forms, scripts, hidden parts) are left out;
elements whose class or id names such a part (sidebars, notices, adverts,
comments) only by what they hold, so a wrapper that mentions one stays. Every paragraph passes points for its
length and commas to its ancestors, fewer with distance; a container's points
are discounted by the share of its text that is links. The best container and
those of its siblings that score like it or read like paragraphs are kept, and
their blocks come out in page order.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm import textbytes as tb

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head nav header footer aside form button select option datalist dialog menu object applet canvas audio video fieldset".split()
) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form toolbar".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs comment comments commentlist cookie cookies "
    "consent disqus footer footnav gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay pagination pager "
    "popup promo promotion recommended related reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar widget widgets".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())
LITTLE = 250  # characters outside of links that a part may hold to be left out for a piece of its name
OPTIONAL_END = frozenset("p li dt dd tr td th".split())
# What an element's names say: nothing, a piece of them is of another part, a whole one is, it holds comments, it is left out.
PLAIN, PIECE, WHOLE, REMARKS, OUT = range(5)
BONUS = {"article": 25.0, "main": 25.0, "section": 3.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "form": -3.0}
GOOD_NAMES = frozenset("article body content entry hentry main page post story text".split())
_CLOSES = {  # a start tag that ends an open one, up to the nearest of these containers
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)),
}
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_QUOTED_END = re.compile(r"(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def scan(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", raw), ("start", name, attributes) and ("end", name, "") in page order."""
    at, size, quoted = 0, len(page), True
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            yield "text", "", page[at:]
            return
        if tag > at:
            yield "text", "", page[at:tag]
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = size if end < 0 else end + 3
            continue
        name = _NAME.match(page, tag)
        if not name:
            if page.startswith(("<!", "<?", "</"), tag):
                end = page.find(">", tag)
                at = size if end < 0 else end + 1
            else:
                yield "text", "", "<"
                at = tag + 1
            continue
        end = _QUOTED_END.match(page, name.end()) if quoted else None
        if end:
            stop = end.end()
        else:
            quoted = False  # a quote is never closed: from here on tags end at the next bracket
            stop = page.find(">", name.end()) + 1
            if not stop:
                return
        word = name.group(1).lower()
        if page[tag + 1] == "/":
            yield "end", word, ""
        else:
            attributes = page[name.end() : stop - 1]
            yield "start", word, attributes
            if word in RAW and not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(word)}(?=[\s/>])", re.I).search(page, stop)
                if not close:
                    return
                yield "end", word, ""
                stop = page.find(">", close.end()) + 1 or size
        at = stop


def _left_out(name: str, attributes: str) -> tuple[int, float]:
    """What a tag and its names say about all inside it (``OUT``: no article text), and what its names are worth."""
    if name in DROPPED:
        return OUT, 0.0
    worth, says, good = 0.0, PLAIN, False
    if attributes:
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (a or b or c).lower()
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _HIDDEN.search(value):
                return OUT, 0.0
            if key == "role" and value in DROPPED_ROLES:
                return OUT, 0.0
            if name == "article" and key == "class" and "comment" in value:
                says = max(says, REMARKS if any(_whole(w) for w in value.split()) else PIECE)
            elif key in ("class", "id") and name not in ("html", "body", "article", "main"):
                words = value.split()
                good = good or not GOOD_NAMES.isdisjoint(words)
                for word in words:
                    pieces = _pieces(word)
                    if pieces & GOOD_NAMES:
                        worth = 5.0
                    if _whole(word):
                        says = max(says, REMARKS if pieces & COMMENT_NAMES else WHOLE)
                    elif pieces & DROPPED_NAMES:
                        says = max(says, PIECE)
    if good:  # class="post comments" is a post
        return PLAIN, worth
    return (says, -5.0) if says else (PLAIN, worth)


def _pieces(word: str) -> set[str]:
    return set(filter(None, re.split(r"[^a-z]+", word)))


def _whole(word: str) -> bool:
    """Whether a class or id is nothing but such a name, or several of them."""
    pieces = _pieces(word)
    return bool(pieces) and pieces <= DROPPED_NAMES


class Tree:
    """Block elements with their blocks of text; inline elements only matter as links."""

    def __init__(self, page: str):
        self.names, self.parents, self.worth, self.says = ["#page"], [-1], [0.0], [PLAIN]
        self.blocks: list[tuple[int, str, int]] = []  # (element, text, characters of it in links)
        self._texts: list[str] = []
        self._linked: list[str] = []
        self._read(page)
        self._leave_out()

    def _flush(self, element: int) -> None:
        if self._texts:
            text = " ".join("".join(self._texts).split())
            if text:
                self.blocks.append((element, text, min(len(text), len(" ".join("".join(self._linked).split())))))
            self._texts, self._linked = [], []

    def _read(self, page: str) -> None:
        stack: list[tuple[str, int]] = [("#page", 0)]  # (name, element) of open tags; inline ones keep their block's element
        skipped, links = 0, 0  # depth inside a part that is left out; open links
        open_names: list[str] = []  # of the left-out part
        for kind, name, value in scan(page):
            if skipped:
                # Inside a left-out part only its own tags are counted.
                if kind == "start" and name == open_names[-1] and name not in VOID:
                    skipped += 1
                elif kind == "end":
                    if name == open_names[-1]:
                        skipped -= 1
                        if not skipped:
                            open_names.pop()
                    elif name in ("body", "html"):
                        skipped = 0
                        open_names.pop()
                continue
            element = stack[-1][1]
            if kind == "text":
                decoded = html.unescape(value)
                self._texts.append(decoded)
                if links:
                    self._linked.append(decoded)
            elif kind == "start":
                if name == "br" or name in VOID and name != "hr":
                    if name == "br":
                        self._texts.append(" ")
                    continue
                says, worth = _left_out(name, value)
                if says == PIECE and name not in BLOCKS:
                    says = PLAIN
                # Parts whose end tag may be missing are read into the tree, which knows where they end.
                dropped = says == OUT and name not in OPTIONAL_END
                if name in BLOCKS or (dropped or says) and name not in ("option", "button", "select", "svg", "math"):
                    self._flush(element)
                    self._close_for(stack, name)
                    element = stack[-1][1]
                if name == "hr":
                    continue
                if dropped:
                    if not value.endswith("/"):
                        skipped = 1
                        open_names.append(name)
                    continue
                links += name == "a"
                if name in BLOCKS or says:
                    self.names.append(name)
                    self.parents.append(element)
                    self.worth.append(worth)
                    self.says.append(says)
                    stack.append((name, len(self.names) - 1))
                else:
                    stack.append((name, element))
            else:
                if name == "br":
                    self._texts.append(" ")
                    continue
                at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
                if not at or name not in BLOCKS and any(n in BLOCKS for n, _ in stack[at + 1 :]):
                    continue
                if name in BLOCKS or element != stack[at - 1][1]:
                    self._flush(element)
                links -= sum(n == "a" for n, _ in stack[at:])
                del stack[at:]
        self._flush(stack[-1][1])

    def _leave_out(self) -> None:
        """Takes out the blocks of parts that are no article text by what they say and hold."""
        if not any(self.says):
            return
        count = len(self.names)
        plain, length, article, out = [0] * count, [0] * count, [False] * count, [False] * count
        for element, text, in_links in self.blocks:
            plain[element] += len(text) - in_links
            length[element] += len(text)
        for i in range(count - 1, 0, -1):  # parents come before their children
            up, says = self.parents[i], self.says[i]
            if says == OUT:
                continue
            plain[up] += plain[i]
            length[up] += length[i]
            article[up] |= article[i] or self.names[i] in ("article", "main") and not says
        for i in range(1, count):
            says = self.says[i]
            some = 2 * plain[i] < plain[0]
            little = plain[i] <= LITTLE or 3 * plain[i] <= 2 * length[i]
            says_out = says == REMARKS or says == WHOLE and some or says == PIECE and some and little
            out[i] = out[self.parents[i]] or says == OUT or says_out and not article[i]
        kept = [b for b in self.blocks if not out[b[0]]]
        if not kept:  # all of the page is in such parts
            for i in range(1, count):
                out[i] = out[self.parents[i]] or self.says[i] == OUT
            kept = [b for b in self.blocks if not out[b[0]]] if plain[0] > LITTLE else []
        self.blocks = kept

    @staticmethod
    def _close_for(stack: list[tuple[str, int]], name: str) -> None:
        """Tags that the start of a block ends: an open paragraph, the item before, the cell before."""
        closing, within = _CLOSES.get(name, ((), ()))
        for i in range(len(stack) - 1, 0, -1):
            open_name = stack[i][0]
            if open_name == "p" or open_name in closing or open_name[0] == "h" and open_name[1:].isdigit() and name[0] == "h" and name[1:].isdigit():
                del stack[i:]
                return
            if open_name in within or open_name in BLOCKS and not closing:
                return


def paragraph_points(text: str) -> float:
    """One point, one per comma, and up to three for length."""
    return 1.0 + sum(map(text.count, ",،、，")) + min(len(text) / 100.0, 3.0)


def article_text(page: str | None) -> str:
    """The article's blocks, one per line; empty if the page has no text outside of what is always left out."""
    if not page:
        return ""
    tree = Tree(page)
    if not tree.blocks:
        return ""
    count = len(tree.names)
    points, length, linked = [0.0] * count, [0] * count, [0] * count
    for element, text, in_links in tree.blocks:
        value, at, distance = paragraph_points(text) * (1 - in_links / len(text)), element, 0
        # A block is the paragraph; the element that holds it directly and its ancestors get its points.
        if tree.names[at] in ("p", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dd", "dt", "figcaption", "summary"):
            length[at] += len(text)
            linked[at] += in_links
            at = tree.parents[at]
        while at >= 0:
            points[at] += value / (1, 2)[distance] if distance < 2 else value / (3 * distance)
            length[at] += len(text)
            linked[at] += in_links
            at, distance = tree.parents[at], distance + 1
    score = [
        (points[i] + BONUS.get(tree.names[i], 0.0) + tree.worth[i]) * (1 - linked[i] / length[i]) if points[i] > 0 and length[i] else 0.0
        for i in range(count)
    ]
    best = max(range(count), key=lambda i: (score[i], -i))
    # Inside an article, its parts belong together.
    above = best
    while above > 0:
        if tree.names[above] in ("article", "main"):
            best = above
            if tree.names[above] == "article":
                break
        above = tree.parents[above]
    keep = {best}
    if tree.names[best] not in ("article", "main", "body", "html", "#page"):
        for i in range(count):
            if tree.parents[i] == tree.parents[best] and length[i]:
                density = linked[i] / length[i]
                if score[i] >= max(10.0, 0.2 * score[best]) or tree.names[i] == "p" and (length[i] > 80 and density < 0.25 or length[i] and not linked[i]):
                    keep.add(i)
    inside = [False] * count
    for i in range(count):
        inside[i] = i in keep or i > 0 and inside[tree.parents[i]]
    return "\n".join(text for element, text, _ in tree.blocks if inside[element])


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A null or empty page, or one without article text, has an empty text.
    Broken markup is read as far as it goes: a comment, a quote or a raw part
    that never ends hides the rest. Repeated rows get the same answer each;
    other columns are ignored.
    """
    chosen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "html", 8 << 20):
                texts = [article_text(page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kind = chosen.schema["page_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
