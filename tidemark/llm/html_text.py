"""HTML extraction by two passes of block rules.

Pass one splits a page into blocks and weighs for each its link density, length and share of stop words, and as
evidence where it stands: in a part that is named or marked as a menu, footer, advert and the like, or in or
outside what the page marks as its article. A part that is named so but holds the page's text counts for nothing, and long text outweighs a name that says little.
Pass two lets blocks that are still open, mostly short ones, inherit the label of their nearest decided
neighbours. Markup is read once from left to right; a page is never cut.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, values_of

#: Frequent words of the corpus languages (English, French, German, Spanish); fixed values.
STOP_WORDS = frozenset(
    """a an and are as at be by for from in is it of on or that the this to was with
    au avec ce dans de des du elle en est et il la le les par pas pour que qui sur un une
    als auch auf das dem den der die ein eine für im ist mit nicht sich sie und von zu
    al con del el es los las lo no para por se su una y""".split()
)
#: Elements whose content is never main text, read to their end tag without a look inside.
RAW = frozenset("script style noscript template iframe svg math canvas object textarea title select option audio video".split())
#: Elements that part the page but are not article text.
AWAY = frozenset("nav header footer aside form menu button dialog fieldset label datalist".split())
BLOCK = frozenset(
    """address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: What class, id and role values say of parts that are not article text, as parts of names. Parts called so may hold prose of their own, which isn't the article's.
AWAY_PROSE = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|comments?|commentlist|replies|disqus|notice|alert|cookies?\w*|consent|gdpr|popup|modal|overlay|"
    r"footer|related|recommend\w*|newsletter|subscribe|subscription|signup|login|widget|contentinfo|complementary|copyright|legal|disclaimer"
)
#: These hold no prose: what is long and reads like text there is the article's.
AWAY_LISTS = re.compile(r"nav|navbar|navigation|menu|breadcrumbs?|header|masthead|topbar|toolbar|share|sharing|social|search|pagination|pager|tags|skip")
#: What may stand beside such words in a name without a meaning of its own; beside other words ("notice-period") a name says less.
PLAIN_PARTS = re.compile(
    r"area|article|bar|body|block|bottom|box|center|container|content|footer|form|global|group|header|holder|inner|item|js|large|left|link|links|list|main|outer|page|panel|post|primary|"
    r"reader|right|secondary|section|side|site|small|text|the|top|user|web|wrap|wrapper|[a-z]?\d*"
)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>|<(/?)([a-zA-Z][\w:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][\w:-]*+)([^<>]*+)>", re.S)
_NAMES = re.compile(r"(?:\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))", re.I)
_HIDDEN = re.compile(r"aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_BARE_HIDDEN, _VALUE = re.compile(r"(?:^|\s)hidden(?:\s|=|$)", re.I), re.compile(r"\"[^\"]*+\"|'[^']*+'")
#: Characters of scripts that put no spaces between words; two count as a word.
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
_WORD = re.compile(r"[^\W_]+")


_LINK = re.compile(r"<(/?)a(?=[\s>/])", re.I)
#: Blocks of fewer words are short; long ones are text with fewer stop words.
SHORT, LONG = 12, 40
#: Shares of linked words over which a block is a list of links, and of stop words that long and other blocks of text have.
MOST_LINKED, LOW_STOPS, HIGH_STOPS = 0.4, 0.15, 0.25
#: What the place says, beside +2, +1, 0, -1 or -3 for the words of a block.
AWAY_WEIGHT, NAMED_WEIGHT, OUTSIDE_WEIGHT, WITHIN_WEIGHT = -4, -2, -2, 1
#: A page with fewer stop words among its words is in a language that the list doesn't know: length and links decide there.
LEAST_STOPS = 0.05


_NO_LINK = _LINK.match("<a>")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    stops: int
    region: int  # the innermost part that is named or marked as none of the article, or -1
    article: int  # the innermost article or main part, or -1
    heading: int  # 1 to 6, or 0
    known: bool = True  # whether the page's language has stop words here


@dataclass
class Region:
    """A part of the page: the one around it, and whether it is one of those that are not article text."""

    up: int
    away: int  # 2: marked so, 1: by a name that says little
    heads: bool = False  # holds a first heading, an article or a main part


def blocks_of(page: str) -> tuple[list[Block], list[Region]]:
    """The blocks of a page in order, and the parts that they stand in."""
    out: list[Block] = []
    regions: list[Region] = []
    stack: list[tuple[str, int, int]] = []  # element, its region or the one around it, its article or the one around it
    opened: Counter = Counter()
    parts: list[tuple[str, bool]] = []
    at, heading, links = 0, 0, 0
    link = None  # the next tag of a link after some place

    def close() -> None:
        nonlocal parts
        text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
        if text:
            linked = size_of(html.unescape(" ".join(t for t, link in parts if link)))
            words = [w.lower() for w in _WORD.findall(text)]
            region, article = stack[-1][1:] if stack else (-1, -1)
            out.append(Block(text, size_of(text), linked, sum(w in STOP_WORDS for w in words), region, article, heading))
        parts = []

    def closed_later(begin: int) -> bool:
        """Whether a link's end tag comes before another link."""
        nonlocal link
        if link is None or link is not _NO_LINK and link.start() < begin:
            link = _LINK.search(page, begin) or _NO_LINK
        return link[1] == "/"

    while True:
        m = _TAG.search(page, at)
        if m is None:
            parts.append((page[at:], links > 0))
            break
        if m.start() > at:
            parts.append((page[at : m.start()], links > 0))
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                parts.append((html.escape(m[0][9:].removesuffix("]]>")), links > 0))
            continue
        name, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "a":
            # 2: a link up to its end tag, also over blocks; 1: one without end, up to the next block
            links = 0 if closing or "href" not in attributes.lower() else 2 if closed_later(at) else 1
            continue
        if name == "br":
            parts.append((" ", False))
            continue
        tracked = name in BLOCK and name not in ("p", "hr", "h1", "h2", "h3", "h4", "h5", "h6") or name in AWAY
        named = "" if closing else " ".join(x for found in _NAMES.findall(attributes) for x in found if x).lower()
        away = 2 * (name in AWAY and name != "header") or int(name == "header")
        if not closing and attributes and name not in VOID and name not in ("html", "body"):
            hidden = "hidden" in attributes.lower() and _BARE_HIDDEN.search(_VALUE.sub("", attributes)) or _HIDDEN.search(attributes)
            if said := 2 if hidden else away_by_name(named) if named else 0:
                tracked, away = True, max(away, said)
        if name in BLOCK or tracked or closing and opened[name]:
            close()
            links = links if links == 2 else 0
            heading = int(name[1]) if name[0] == "h" and name[1:].isdigit() and not closing else 0
        region, article = stack[-1][1:] if stack else (-1, -1)
        if heading == 1 and region >= 0:
            regions[region].heads = True
        if closing:
            if opened[name]:
                while True:  # what is still open inside ends too
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
        elif tracked and name not in VOID and not attributes.endswith("/"):
            if away:
                regions.append(Region(region, away))
                region = len(regions) - 1
            elif name in ("article", "main"):
                if region >= 0:
                    regions[region].heads = True
                regions.append(Region(region, 0))
                region = article = len(regions) - 1
            stack.append((name, region, article))
            opened[name] += 1
    close()
    words = [(b.words, b.stops) for b in out if b.words >= SHORT and b.linked <= MOST_LINKED * b.words]
    if sum(s for _, s in words) < LEAST_STOPS * sum(w for w, _ in words):
        for b in out:
            b.known = False
    return out, regions


def size_of(text: str) -> int:
    """Words of a text; of scripts without spaces, two characters are one."""
    unspaced = 0 if text.isascii() else len(_UNSPACED.findall(text))
    return len(_WORD.findall(text)) + unspaced // 2


def away_by_name(names: str) -> int:
    """What class, id and role values say: 2 for a part with other text than the article's, 1 if they say less, 0 for nothing."""
    found = 0
    for name in names.split():
        parts = [p for p in re.split(r"[_-]+", name.replace("side-bar", "sidebar")) if p]
        if any(map(AWAY_PROSE.fullmatch, parts)):
            if all(AWAY_PROSE.fullmatch(p) or PLAIN_PARTS.fullmatch(p) or AWAY_LISTS.fullmatch(p) for p in parts):
                return 2
            found = 1
        elif any(map(AWAY_LISTS.fullmatch, parts)):
            found = 1
    return found


def by_words(block: Block) -> int:
    """What the words of a block say: 2 and 1 for text, 0 for nothing, less for lists of links and the like."""
    density = block.linked / block.words if block.words else 0.0
    stops = block.stops / block.words if block.words else 0.0
    if density > MOST_LINKED and not (block.heading and block.article >= 0):
        return -3
    if block.text.startswith(("©", "Copyright ")):
        return -2
    if block.words < SHORT or block.heading:
        return 0
    if not block.known:
        return 0 if block.linked else 2 if block.words >= LONG else 1
    if stops >= (LOW_STOPS if block.words >= LONG else HIGH_STOPS):
        return 2 if block.words >= LONG else 1
    return -1 if block.linked else 0


def by_place(blocks: list[Block], regions: list[Region], said: list[int]) -> tuple[list[int], list[bool]]:
    """What the place of each block says, and whether it is in a part that isn't the article's.

    A part that is named as none of the article counts for nothing if it holds half of the page's text and
    a first heading or article, or, where no part or heading is marked so, four fifths of the text.
    """
    weight = lambda least: [b.words if t >= least else 0 for b, t in zip(blocks, said)]
    text = weight(1)
    if not any(text):
        text = weight(0)
    total = sum(text)
    held, heads = [0] * len(regions), [r.heads for r in regions]
    for b, n in zip(blocks, text):
        if b.region >= 0:
            held[b.region] += n
    for k in range(len(regions) - 1, -1, -1):  # parts come after those around them
        if regions[k].up >= 0:
            held[regions[k].up] += held[k]
            heads[regions[k].up] |= heads[k]
    headed = any(b.heading == 1 or b.article >= 0 for b in blocks)
    away: list[int] = []
    for k, r in enumerate(regions):
        void = total > 0 and (2 * held[k] >= total if heads[k] else not headed and 5 * held[k] >= 4 * total)
        away.append(max(0 if void else r.away, away[r.up] if r.up >= 0 else 0))
    articles = {b.article for b in blocks if b.article >= 0 and away[b.article] < 2}
    inside = sum(n for b, n in zip(blocks, text) if b.article in articles)
    marked = bool(articles) and 2 * inside >= total
    out = []
    for b in blocks:
        place = (0, NAMED_WEIGHT, AWAY_WEIGHT)[away[b.region] if b.region >= 0 else 0]
        if place == NAMED_WEIGHT and b.heading == 1 and b.article in articles:
            place = -WITHIN_WEIGHT  # an article's head has its title: as what it heads
        if b.article in articles:
            place += WITHIN_WEIGHT
        elif marked:
            place += OUTSIDE_WEIGHT
        out.append(place)
    return out, [b.region >= 0 and away[b.region] > 0 for b in blocks]


def nearest(decided: list[bool]) -> tuple[list[int], list[int]]:
    """Of each place the last decided one before it and the first after it, or -1, in two sweeps."""
    before, after, last = [], [], -1
    for k, known in enumerate(decided):
        before.append(last)
        last = k if known else last
    last = -1
    for k in range(len(decided) - 1, -1, -1):
        after.append(last)
        last = k if decided[k] else last
    return before, after[::-1]


def labels_of(blocks: list[Block], regions: list[Region]) -> list[bool]:
    """Whether each block is main text."""
    said = [by_words(b) for b in blocks]
    place, apart = by_place(blocks, regions, said)
    sums = [a + b for a, b in zip(said, place)]
    found = [None if s == 0 else s > 0 for s in sums]
    if not any(found) and any(b.heading == 1 or b.article >= 0 for b in blocks):  # nothing reads like text: what a headed page has, but for what is off by its place or its links, is all there is
        found = [True if f is None and p >= 0 else f for f, p in zip(found, place)]
    # what is off by its place says nothing about its neighbours
    before, after = nearest([f is not None and (f or not off) for f, off in zip(found, apart)])
    out: list[bool] = []
    for k, (label, a, b) in enumerate(zip(found, before, after)):
        if label is None:
            if blocks[k].heading and b >= 0:  # a heading goes with what it heads
                label = found[b]
            elif a >= 0 and b >= 0:  # the nearer neighbour; of two as near, one that is main text
                label = found[a] if k - a < b - k else found[b] if b - k < k - a else found[a] or found[b]
            else:
                label = a >= 0 and found[a] or b >= 0 and found[b]
        out.append(bool(label))
    return out


def main_text(page: str | None) -> str:
    """The main text of a page: its blocks joined by one space."""
    if not page:
        return ""
    blocks, regions = blocks_of(page)
    return " ".join(b.text for b, good in zip(blocks, labels_of(blocks, regions)) if good)


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of df: id, url, text and n_chars.

    Null and empty pages have an empty text, as have pages without main text. Broken markup is read
    as far as it goes, very long pages in time linear in their length; of two neighbours as near the one
    that is main text counts; repeated rows, null ids and null urls are kept, ids exactly; other columns
    are left out, whatever their names; an empty table gives no rows.
    """

    def run(parts: Iterator) -> Iterator[tuple]:
        for batch in parts:
            texts = [main_text(page) for page in values_of(batch, "_html")]
            yield batch, {"text": texts, "n_chars": list(map(len, texts))}

    part = df.select(F.col(id_col), F.col(url_col).cast("string").alias(url_col), F.col(html_col).alias("_html"))
    return mapped(part, run, {"text": "string", "n_chars": "long"}, keep=[id_col, url_col])
