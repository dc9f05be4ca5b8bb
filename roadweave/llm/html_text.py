"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block. Of every line the length of its text counts, without links. Sums over
windows of ``WINDOW`` lines show where text is dense: a region begins at a surge, the first line whose window's sum
reaches ``SURGE``, and ends at a dive, where the lines run out of text. Lines of the regions that hold the page's text
are kept. What markup itself says bends the distribution: lines in article or main elements that hold most of the text
weigh ``BONUS`` more, lines in menus, headers, footers, sidebars, notices, adverts, forms or comments are cut out. What
class, id and role say is overruled where the element holds the article.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.llm.common import text_of

WINDOW = 3
SURGE = 120
BONUS = 40  # weight of being in an article or main element: any WINDOW of its lines surges
SHARE = 0.25  # a region counts if it has so much of the text of the largest
LINKED = 0.5  # a line with more of its text in links is a menu

# Elements by what they mean to a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
UNSEEN = frozenset("head iframe noscript object script select style svg template textarea title button".split())
AROUND = frozenset("aside dialog footer menu nav search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(["article", "main"])
RAW = frozenset(["script", "style", "textarea", "title", "iframe", "noscript", "template"])
# Words in class, id or role that mark what surrounds an article.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter "
    "notice notices pager pagination popup promo promoted promotion related replies reply respond share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar widget widgets".split()
)

# Words that say of a page that it has or lacks such a part, and words for what an article's header is named by.
STATES = frozenset("has no non not with without".split())
CONTENT = frozenset("article content entry post story".split())
# Words for the shape or place of a part, which leave a name that begins with a word for noise one.
HOLDERS = frozenset("article body center div form main section td".split())  # elements that hold the blocks of an article
PARTS = frozenset(
    "area article bar block body bottom box button buttons center col column container content copy entry form grid group head "
    "heading inner item items layout left link links list main outer page panel post posts right row section site slot "
    "sticky story text title top unit wrap wrapper".split()
)

_TAG = re.compile(r"<(?:!--|(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)|[!?/])")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_STOP = re.compile(r""">|=\s*["']""")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z0-9]+")


class _Finder:
    """Looks ahead in a page, and remembers what isn't found from some place on, so that broken markup takes no longer."""

    def __init__(self, page: str) -> None:
        self.page, self.size, self.missing = page, len(page), set()

    def behind(self, mark: str, at: int) -> int:
        """The place behind the next ``mark``, 0 if there is none."""
        if mark in self.missing:
            return 0
        found = self.page.find(mark, at)
        if found < 0:
            self.missing.add(mark)
        return found + len(mark) if found >= 0 else 0

    def tag(self, at: int) -> int:
        """The place behind a tag whose attributes begin at ``at``. Quotes count where a value begins, not inside one."""
        here = at
        while stop := _STOP.search(self.page, here):
            if stop.group() == ">":
                return stop.end()
            here = self.behind(stop.group()[-1], stop.end())
            if not here:
                break
        return self.behind(">", at) or self.size

    def end_of(self, name: str, at: int) -> int:
        """The place behind the end tag of an element that is skipped, 0 if there is none."""
        if f"</{name}" in self.missing:
            return 0
        found = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(self.page, at)
        if not found:
            self.missing.add(f"</{name}")
        return found.end() if found else 0


def _noisy(name: str, attributes: str) -> tuple[int, bool]:
    """2 for what surrounds an article, 1 for what may, by its class, id or role, else 0; whether a word for an article is with it."""
    if name in AROUND:
        return 2, False
    noise, content = int(name == "form"), False
    if not attributes or name in ("body", "html", *MAIN):
        return noise, content
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return 2, False
        if key in ("class", "id", "role"):
            for part in value.split():
                words = _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", part).lower())
                named = NOISE.intersection(words) and (words[-1] in NOISE or all(w in NOISE or w in PARTS or w.isdigit() for w in words))
                if named and STATES.isdisjoint(words) and words[-1] != "free":
                    noise, content = 1, content or not CONTENT.isdisjoint(words)
    return noise, content


@dataclass
class _Part:
    """An element on the lines from ``first`` to before ``end``: one that may be noise, or an article or main element."""

    first: int
    named: bool = False  # inside an article or main element, or with a word for one in its name
    head: bool = False  # has an h1
    end: int = 0


def _noise(out: list[tuple[str, int, bool, bool, int]], parts: list[_Part], mains: list[_Part]) -> list[bool]:
    """Which lines are noise: those of ``parts`` too, unless the page overrules what their names say.

    It does where a part has the h1 of an article it is in or named by; where it holds most of the text, with an h1 or
    with an article or main element that holds most of the text by itself; and where nothing that surges, and no line
    of an article or main element, is left without it.
    """
    sure = np.array([x for _, _, _, x, _ in out], dtype=bool)
    text = np.array([0 if x else max(len(t) - n, 0) for t, n, _, x, _ in out], dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(text)])
    total = before[-1]
    most = lambda p: 2 * (before[p.end] - before[p.first]) > total
    inner = min((p for p in mains if most(p)), key=lambda p: p.end - p.first, default=None)
    holds = lambda p: inner is not None and p.first <= inner.first and inner.end <= p.end

    def marked(left: list[_Part]) -> np.ndarray:
        steps = np.zeros(len(out) + 1, dtype=np.int64)
        for p in left:
            steps[p.first] += 1
            steps[p.end] -= 1
        return sure | (np.cumsum(steps)[:-1] > 0)

    left = [p for p in parts if not (p.head and p.named or most(p) and (p.head or holds(p)))]
    noise = marked(left)
    kept = np.array([inside for _, _, inside, _, _ in out], dtype=bool) & ~noise
    if left and not kept.any() and text[~noise].sum() < SURGE:
        noise = marked([p for p in left if not most(p)])
    return noise.tolist()


def lines_of(page: str) -> list[tuple[str, int, bool, bool, int]]:
    """(text, characters in links, in an article or main element, in what surrounds one, the number of the element that
    holds it, negative for the page's body) of each block with text."""
    out: list[tuple[str, int, bool, bool, int]] = []
    holders: list[tuple[int, int]] = [(0, -1)]  # open ones: how deep in the stack, and their numbers
    number = 0
    stack: list[tuple[str, bool, _Part | None]] = []  # open elements, and whether each begins something around the article
    opened: Counter[str] = Counter()  # their names
    blocks: list[int] = []  # the places of blocks among them
    finder = _Finder(page)
    parts: list[_Part] = []
    mains: list[_Part] = []
    heads: list[_Part] = []  # open parts that have no h1 yet
    held: list[str] = []
    linked = noisy = main = links = 0
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
        if text:
            out.append((text, linked, main > 0, noisy > 0, holders[-1][1]))
        held.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal noisy, main, links
        for name, noise, part in stack[to:]:
            noisy -= noise
            if part:
                part.end = len(out)
                if heads and heads[-1] is part:
                    heads.pop()
            main -= name in MAIN
            links -= name == "a"
            opened[name] -= 1
        del stack[to:]
        while blocks and blocks[-1] >= to:
            blocks.pop()
        while len(holders) > 1 and holders[-1][0] >= to:
            holders.pop()

    while at < size:
        tag = _TAG.search(page, at)
        text = page[at : tag.start() if tag else size]
        if text:
            held.append(text)
            linked += len(text) if links else 0
        if not tag:
            break
        if tag.group().startswith("<!--"):
            at = finder.behind("-->", tag.end()) or size
            continue
        end = finder.tag(tag.end())
        name = (tag["name"] or "").lower()
        at = end
        if not name:
            continue
        if name in BLOCKS:
            flush()
        elif name == "br":
            held.append(" ")
        if tag["end"]:
            if opened[name]:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            continue
        if name in RAW or name in UNSEEN:
            at = finder.end_of(name, at) or (size if name in RAW else at)
            continue
        if name in VOID or page[end - 2 : end] == "/>":
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):  # these end one of their own kind that is open
            if blocks and stack[blocks[-1]][0] == name:
                close(blocks[-1])
        level, content = _noisy(name, page[tag.end() : end - 1])
        if name == "footer" and opened["blockquote"]:
            level = 0  # who is quoted
        noise = level == 2 or (name == "header" and not main)
        part = None
        if name in MAIN:
            mains.append(part := _Part(len(out)))
        elif level == 1 and not noise:
            parts.append(part := _Part(len(out), content or main > 0))
            heads.append(part)
        elif name == "h1" and not noisy:
            for p in heads:
                p.head = True
            heads.clear()
        if name in BLOCKS:
            blocks.append(len(stack))
        if name in HOLDERS:
            number += 1
            holders.append((len(stack), -number if name == "body" else number))
        stack.append((name, noise, part))
        opened[name] += 1
        noisy += noise
        main += name in MAIN
        links += name == "a"
    flush()
    close(0)
    if not parts:
        return out
    return [(*line[:3], x, line[4]) for line, x in zip(out, _noise(out, parts, mains))]


def _regions(weight: np.ndarray) -> list[tuple[int, int]]:
    """From each surge to the dive after it: (first, behind the last)."""
    if not len(weight):
        return []
    sums = np.convolve(weight, np.ones(WINDOW, dtype=np.int64))[WINDOW - 1 :]
    regions: list[tuple[int, int]] = []
    at, n = 0, len(weight)
    while at < n:
        if weight[at] == 0 or sums[at] < SURGE:
            at += 1
            continue
        end = at
        while end < n and sums[end] > 0:
            end += 1
        regions.append((at, end))
        at = end + 1
    return regions


def _of_one_holder(chosen: np.ndarray, holder: np.ndarray, weight: np.ndarray, noise: np.ndarray, menu: np.ndarray) -> np.ndarray:
    """The chosen lines with what belongs to them: the element that holds most of their text is the article's, and so are
    its other blocks, however short, unless it is the body, and whatever stands between its first and its last block."""
    held = np.unique(holder[chosen], return_inverse=True)
    most = held[0][np.bincount(held[1], weights=weight[chosen] + 1e-9).argmax()]
    kept = np.zeros(len(holder), dtype=bool)
    kept[chosen] = True
    if most >= 0:
        kept |= (holder == most) & ~noise & ~menu
    own = np.flatnonzero(kept & (holder == most))
    between = np.zeros(len(holder), dtype=bool)
    between[own[0] : own[-1] + 1] = True
    return kept & ~(menu & (weight <= 0)) | between & ~noise


def kept_lines(lines: list[tuple[str, int, bool, bool, int]]) -> list[str]:
    """The lines between surges and dives, and those of the element that holds them.

    Noise is cut out before the windows run, so what it interrupts stays together. Lines in article or main elements
    and the others are two sequences, each with windows of its own, so that teasers beside an article don't join it.
    If the elements hold most of the page's text, their lines weigh ``BONUS`` more.
    """
    if not lines:
        return []
    length = np.array([len(text) for text, *_ in lines], dtype=np.int64)
    linked = np.array([n for _, n, *_ in lines], dtype=np.int64)
    menu = linked > LINKED * length
    noise = np.array([x for _, _, _, x, _ in lines])
    main = np.array([m for _, _, m, _, _ in lines])
    weight = np.where(noise | menu, 0, length - np.minimum(linked, length))
    if has_main := bool((main & ~noise).any() and 2 * weight[main].sum() >= weight.sum()):
        weight = np.where(main & ~noise, weight + BONUS, weight)
    found: list[tuple[int, bool, np.ndarray]] = []
    for inside in (True, False):
        at = np.flatnonzero((main == inside) & ~noise)
        for a, b in _regions(weight[at]):
            found.append((int(weight[at[a:b]].sum()), inside, at[a:b]))
    if not found:  # a page of few words: what it has outside of menus
        return [lines[i][0] for i in np.flatnonzero(weight > 0)]
    most = max(total for total, _, _ in found)
    chosen = [at for total, inside, at in found if (has_main and inside) or total >= SHARE * most]
    holder = np.array([h for *_, h in lines])
    return [lines[i][0] for i in np.flatnonzero(_of_one_holder(np.concatenate(chosen), holder, weight, noise, menu))]


def main_text(page: str) -> str:
    return "\n".join(kept_lines(lines_of(page)))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("html")
        texts = [main_text(page.as_py()) for page in batch.column(at)]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row: the page's main text, its blocks joined by line feeds.

    Null and empty html give an empty text; repeated rows are extracted each; other columns are not read.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), text_of("html").alias("html"))
    return rows.mapInArrow(_extracted, f"page_id {kind}, url string, text string, n_chars long")
