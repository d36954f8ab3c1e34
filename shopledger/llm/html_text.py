"""Main text of web pages by two-pass block rules.

A page is cut into blocks of text. The first pass decides the clear ones by length, link density and stop-word
density; what stands in menus, forms and the like is decided by its place. In the second pass short blocks that were
left open take the label of the nearest decided neighbours.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.tables import small_batches

#: Frequent function words of the languages at hand.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by for from had has have he her his in is it its not of on or she that the their they
    this to was were which who will with you
    au aux avec ce ces dans de des du elle en est et il ils la le les leur lui mais ne nous ou par pas pour que qui
    sa se ses son sur un une vous
    aber als auch auf aus bei das dem den der des die ein eine einen er es für hat ich ihr im ist mit nach nicht noch
    oder sich sie sind und vom von war wie wir zu zum zur
    al como con del el ella entre era esta este han hay las lo los más muy no nos o para pero por sin sobre su sus
    también una y
    """.split()
)
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre search
    section select summary table tbody td tfoot th thead tr ul
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Nothing inside these is text of the page.
SILENT = frozenset("audio canvas head iframe noscript object script style svg template title video".split())
#: Their content runs to the end tag, whatever is in it.
RAW = frozenset("iframe noscript script style textarea title".split())
#: Text inside these is never the article's.
ASIDE = frozenset("aside button dialog fieldset footer header label menu nav select textarea".split())
#: These, and elements whose names say so, stand beside the article unless they are found to hold it.
PERHAPS_ASIDE = frozenset(("form",))
ARTICLE = frozenset(("article", "main"))
#: Words in an id, class or role that name a part of the page around the article.
ASIDE_WORDS = frozenset(
    """
    ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie
    cookies disqus dropdown footer form header masthead menu menubar modal nav navbar navigation newsletter notice
    notices notification pager pagination popup promo promoted related replies respond share sharing sidebar
    sidenav skip social sponsor sponsored subscribe subscription topbar widget widgets
    """.split()
)
#: Of these words, those of what readers wrote: that is never the article.
COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
#: With one of these, a name tells about the page's layout and names no part of it: has-sidebar, no-banner.
ABOUT = frozenset("disabled enabled has hide is no non not proof show with without".split())
ASIDE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_NAMING = re.compile(r"(?<![^\s\"'/])(id|class|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?<![^\s\"'/])hidden(?=[\s/=]|$)|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class BlockRules:
    """Lengths in characters. A block with more than max_link of its characters in links is not text. Of the others,
    blocks shorter than `short` are left open; a block is text if it has stop words in a share of `stop_words` at
    least, or inside an article element any share; other blocks of less than `long` characters are left open."""

    max_link: float = 0.4
    short: int = 70
    long: int = 200
    stop_words: float = 0.12
    stop_set: frozenset[str] = field(default=STOP_WORDS, repr=False)


@dataclass
class Block:
    """`outside`: by its place never the article's. `within`: number of the innermost element around it that by its name
    stands beside the article, 0 if there is none."""

    text: str
    linked: int
    outside: bool
    article: int
    within: int = 0


@dataclass
class Page:
    """Blocks, and the elements that by their names stand beside the article: of each number the one around it (0: none),
    and which of them hold an article element."""

    blocks: list[Block]
    around: list[int]
    holders: set[int]


def _names_aside(attributes: str) -> str | None:
    """"always" if an element with these attributes never holds the article, "perhaps" if its names say so."""
    if _HIDDEN.search(attributes):
        return "always"
    found = None
    for kind, *values in _NAMING.findall(attributes):
        value = "".join(values)
        if kind.lower() == "role":
            if value.strip().lower() in ASIDE_ROLES:
                found = "perhaps"
            continue
        for name in value.split():
            words = set(map(str.lower, _WORD.findall(name)))
            if ASIDE_WORDS.isdisjoint(words) or not ABOUT.isdisjoint(words):
                continue
            if not COMMENT_WORDS.isdisjoint(words):
                return "always"
            found = "perhaps"
    return found


def blocks(html: str) -> Page:
    """The page's blocks of text in order, with the characters in links and the kind of place they stand in."""
    out: list[Block] = []
    around, holders = [0], set()
    # open elements: name, whether text inside is silent, whether outside the article by its place, number of the
    # innermost one that may be, article's number
    stack: list[tuple[str, bool, bool, int, int]] = []
    opened_now: Counter[str] = Counter()
    silent, outside, article, articles, links = False, False, 0, 0, 0
    within = 0
    chunks: list[tuple[str, bool]] = []
    breaks = 0

    def text_of(raw: str) -> str:
        return unescape(raw).replace("\0", "�") if "&" in raw or "\0" in raw else raw

    def flush() -> None:
        nonlocal breaks
        breaks = 0
        if chunks:
            whole = " ".join("".join(t for t, _ in chunks).split())
            if whole:
                linked = sum(len("".join(t.split())) for t, in_link in chunks if in_link)
                out.append(Block(whole, linked, outside, article, within))
            chunks.clear()

    def take(raw: str) -> None:
        nonlocal breaks
        if raw and not silent:
            text = text_of(raw)
            if text.strip():
                breaks = 0
            chunks.append((text, links > 0))

    def close(name: str) -> None:
        nonlocal silent, outside, article, links, within
        if not opened_now[name]:
            return
        for at in range(len(stack) - 1, -1, -1):
            if stack[at][0] == name:
                flush_needed = name in BLOCKS or any(n in BLOCKS for n, *_ in stack[at:])
                if flush_needed:
                    flush()
                closed = Counter(n for n, *_ in stack[at:])
                links -= closed["a"]
                opened_now.subtract(closed)
                del stack[at:]
                break
        _, silent, outside, within, article = stack[-1] if stack else ("", False, False, 0, 0)

    at, end = 0, len(html)
    while at < end:
        tag = _TAG.search(html, at)
        if not tag:
            take(html[at:])
            break
        take(html[at : tag.start()])
        at = tag.end()
        if tag["data"] is not None:
            take(tag["data"].replace("&", "&amp;"))
        if not tag["name"]:
            continue
        name = tag["name"].lower()
        if tag["end"]:
            if name in BLOCKS and not opened_now[name]:
                flush()
            close(name)
            continue
        if name == "br":
            breaks += 1
            if breaks > 1:
                flush()
            elif not silent:
                chunks.append((" ", links > 0))
            continue
        if name in BLOCKS:
            flush()
            for opened in ("p", "li", "option") if name not in ("html", "body") else ():
                # a block ends a paragraph that is still open, an item the item before it
                if opened_now[opened] and (opened == "p" or name == opened) and _open_within(stack, opened):
                    close(opened)
        if name in VOID or tag["rest"].rstrip().endswith("/") and name not in BLOCKS and name not in RAW:
            continue
        own = None if name in ("html", "body", "article", "main") else _names_aside(tag["rest"])
        aside = outside or name in ASIDE or own == "always"
        inside = within
        if not aside and (own or name in PERHAPS_ASIDE):
            inside = len(around)
            around.append(within)
        if (aside, inside) != (outside, within) and name not in BLOCKS:
            flush()
        if name in ARTICLE and not article and not aside:
            articles += 1
            holder = inside
            while holder and holder not in holders:
                holders.add(holder)
                holder = around[holder]
        number = article or (articles if name in ARTICLE and not aside else 0)
        stack.append((name, silent or name in SILENT, aside, inside, number))
        opened_now[name] += 1
        links += name == "a"
        _, silent, outside, within, article = stack[-1]
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = stop.start() if stop else end
    flush()
    return Page(out, around, holders)


def _open_within(stack: list[tuple[str, bool, bool, int, int]], name: str) -> bool:
    """Whether an element of this name is open with only inline elements inside it."""
    for opened, *_ in reversed(stack):
        if opened == name:
            return True
        if opened in BLOCKS:
            return False
    return False


def classify(page: Page, rules: BlockRules = BlockRules()) -> list[bool]:
    """Whether each block is the page's text.

    Elements that stand beside the article by their names are left out, as long as that leaves text of an article
    element where there is one, and any text where there is none. Otherwise those around article elements, or those
    that hold half of what would be text at least, are taken for what they hold.
    """
    labels = _decided(page, set(), rules)
    if len(page.around) == 1 or any(kept and b.article for b, kept in zip(page.blocks, labels)):
        return labels
    if page.holders:
        return _decided(page, page.holders, rules)
    if any(labels):
        return labels
    size = [0] * len(page.around)
    for block, kept in zip(page.blocks, _decided(page, set(range(1, len(size))), rules)):
        size[block.within] += len(block.text) * kept
    # an element's number is larger than that of the one around it
    for n in range(len(size) - 1, 0, -1):
        size[page.around[n]] += size[n]
    return _decided(page, {n for n in range(1, len(size)) if 2 * size[n] >= size[0]}, rules)


def _decided(page: Page, opened: set[int], rules: BlockRules) -> list[bool]:
    """Both passes, with the elements in `opened` taken for what they hold."""
    aside = [False] * len(page.around)
    for n in range(1, len(aside)):
        aside[n] = n not in opened or aside[page.around[n]]
    places = [replace(b, outside=b.outside or aside[b.within]) if b.within else b for b in page.blocks]
    labels: list[bool | None] = []
    for block in places:
        length = len(block.text)
        if block.outside or block.linked > rules.max_link * len(block.text.replace(" ", "")):
            labels.append(False)
        elif length < rules.short:
            labels.append(None)
        else:
            words = _LETTERS.findall(block.text.lower())
            density = sum(w in rules.stop_set for w in words) / max(len(words), 1)
            if density >= rules.stop_words or block.article:
                labels.append(True)
            else:
                labels.append(None if length < rules.long else False)
    return _inherited(places, labels)


def _inherited(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """Second pass: open blocks take the label of the nearest decided block on both sides, of the nearer if they
    differ, of the one that is text if both are as near. Inside an article element only its own blocks count, and
    without a decided one it is all text; elsewhere, no decided block means no text."""
    same = [b.article for b in found]
    n = len(found)
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n

    def sweep(order: range, near: list[tuple[int, bool] | None]) -> None:
        last: dict[int, tuple[int, bool]] = {}
        for i in order:
            near[i] = last.get(same[i])
            if labels[i] is not None:
                last[same[i]] = (i, bool(labels[i]))

    sweep(range(n), before)
    sweep(range(n - 1, -1, -1), after)
    out = []
    for i, label in enumerate(labels):
        if label is None:
            sides = [s for s in (before[i], after[i]) if s]
            if same[i]:
                sides = [s for s in sides if s[1] or not found[s[0]].outside]
            if not sides:
                label = bool(same[i])
            else:
                label = min(sides, key=lambda s: (abs(s[0] - i), not s[1]))[1]
        out.append(label)
    return out


def main_text(html: str | None, rules: BlockRules = BlockRules()) -> str:
    page = blocks(html or "")
    return "\n".join(block.text for block, kept in zip(page.blocks, classify(page, rules)) if kept)


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rules: BlockRules = BlockRules(),
) -> DataFrame:
    """(page_id, url, text, n_chars) for every row, without a shuffle.

    Defined cases: html that is null or empty, or has no text, gives an empty text; markup that ends in the middle of a
    tag or comment is read up to there; ids and urls that are null are passed on; repeated rows each get their row; an
    empty table gives an empty table; other columns are not looked at.
    """
    small_batches(pages.sparkSession)
    picked = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, rules) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = picked.schema["page_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
