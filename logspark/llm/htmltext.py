"""Main text of web pages by site template removal.

1. Each page's markup is read once, in linear time, into a flat list of texts and block ends; an element is a range of
   that list. Scripts, styles, controls and hidden elements give no text. The subtrees of all other containers, menus,
   headers, footers, asides and adverts among them, are hashed by sums over the page's texts; outside articles and main
   areas paragraphs and headings are, too.
2. Spark counts on how many different pages of its host each subtree stands. Pages with one title and the same
   headings are copies of one another and count once (pages without heading: those of one text). A subtree is a template if it stands on SEVERAL
   pages; a paragraph or heading by itself only if that is half of the host's pages (COMMON); inside an article or main area
   only if it is SHARE of them. No length and no size of a host decides.
3. The pages are read again, each with the list of those of its subtrees that are templates. These are cut: outside
   articles unless nothing would be left, inside them unless most of the prose (text outside links) would go, since then
   it is the article that recurs.
4. Where what recurs is at least half of the text around a page's articles and main areas (of a page without these,
   where anything recurs), it is the frame of the site and nothing else is cut: recurrence has decided. Other pages, on hosts
   of few stories or with parts that differ from page to page, are cleared by name: nav, footer, form, aside and header
   elements, roles and, outside articles, telling classes as whole tokens or known compounds; inside articles only those of
   adverts, notices and comments. What holds an article or a main area or most of the prose it stands in (the page's, where
   that has neither, else the article's) is never cut by name; headings and inline elements have no name.
5. Of what is left of these pages the articles, else the main areas, are the text if they hold half of the prose; else all of it is.

References are decoded, white space inside a block becomes one blank, blocks are trimmed and joined by newlines.

Edge cases: null or empty html and pages of markup only have the text ""; a null url is a host of its own; unclosed,
crossed and cut-off tags end with their parent or the page; repeated rows are all returned with equal values; an empty
table gives an empty result. Columns other than id, url and html are ignored.

Scale: counts are combined before the shuffle that gathers them, by host and hash, so that a large host is spread out.
A page's templates come to it by a join on the page's hash; pages with more than COPIES copies are dealt over several keys.
"""

from __future__ import annotations

import html
import itertools
import re
from bisect import bisect_right

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logspark.llm.common import arrow_schema
from logspark.llm.tables import small, written

SEVERAL, SHARE, COMMON = 3, 0.2, 0.5
#: Copies of a page that one key of the join may have; rows of templates that it may broadcast.
COPIES, BROADCAST_ROWS = 1000, 5000

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)""", re.S)
#: Tags that end at the next sign for it, quoted or not: for the rest of a page after UNCLOSED tags whose quotes never end.
SIMPLE = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<()()()(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)""", re.S)
UNCLOSED = 8
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
RAW = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "xmp", "noframes")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
#: Elements whose subtrees are hashed, anywhere and outside of articles.
CONTAINER = frozenset("div section ul ol dl table figure details menu center dir fieldset nav footer header aside form dialog".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 address blockquote pre".split())
#: Elements without text of their own, and those cut by their tag.
SILENT = frozenset("head script style noscript template iframe svg button select textarea object canvas audio video".split())
CUT = frozenset("nav footer form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert advertisement advertising adbox adsense sponsored sponsor promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side-bar rail aside widget widgets footer header masthead topbar toolbar "
    "comment comments commentlist disqus respond replies reply responses share sharing social related recommended more-like-this search searchbox pagination pager".split()
)
#: Elements that a new item of a list or table inside them does not end.
BARS = frozenset("ul ol dl table select".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Base and modulus of the sums that tell subtrees apart.
BASE, PRIME = 0x1B873593CC9E2D51, (1 << 61) - 1
SPACE = re.compile(r"\s+")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


#: Cut by tag whatever prose they hold, unless it is an article or main area.
FIRM = frozenset("nav footer".split())
#: Names that count inside articles, too.
INSIDE = frozenset("ad ads advert advertisement advertising adbox adsense sponsored cookie cookies consent gdpr newsletter subscribe subscription comment comments commentlist disqus respond".split())
#: Those of them that name readers' comments whatever they hold, as comments may outweigh a story.
COMMENTS = frozenset("comments commentlist disqus respond".split())
#: Never cut by class or id: headings and what stands inside a line.
UNNAMED = frozenset(
    "html body article main p h1 h2 h3 h4 h5 h6 a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: Compounds of a name that are parts of a site, such as cookie-banner or related-posts.
PARTS = frozenset(
    "ad ads banner bar block box button buttons consent container content feed footer form header icons inner item items label link links list menu message modal nav notice overlay panel popup posts slot thread unit widget widgets wrap wrapper".split()
)
SITES = frozenset("site page main global primary secondary top bottom left right sub mobile".split())
#: Layout classes start with these names as well: their compounds are only known with SITES in front.
LAYOUT = frozenset("header footer sidebar nav navigation aside menu search".split())


def _site_part(token: str, names: frozenset[str]) -> bool:
    """Whether a class or id, as a whole or as a known compound, names a part of a site."""
    token = token.replace("_", "-")
    first, dash, last = token.partition("-")
    return token in names or (dash != "" and ((first in names and last in PARTS and (first not in LAYOUT or last not in ("container", "content", "wrap", "wrapper", "inner"))) or (first in SITES and last in names)))


class Open:
    """An element that is not closed yet."""

    __slots__ = ("area", "chars", "holds", "level", "links", "prose", "start", "tag")

    def __init__(self, tag: str, start: int, level: int, area: bool):
        self.tag, self.start, self.level, self.area, self.chars, self.links, self.prose, self.holds = tag, start, level, area, 0, 0, 0, False


class Page:
    """Texts and block ends (None), the prose of each, and ranges of them."""

    __slots__ = ("articles", "mains", "named", "out", "plain", "prose", "story", "subtrees")

    def __init__(self):
        self.out: list[str | None] = []
        self.plain: list[int] = []
        self.articles: list[tuple[int, int]] = []
        self.mains: list[tuple[int, int]] = []
        self.named: list[tuple[int, int, int]] = []  # start, end, prose (0: cut whatever it holds)
        self.subtrees: list[tuple[int, int, int, int]] = []  # start, end, hash, place
        self.prose = 0
        self.story: list[str] = []  # words of the title and headings


OUTSIDE, WITHIN, ALONE = 0, 1, 2  # places of subtrees: outside of articles, inside them, a paragraph or heading outside
FREE, WEAK, SURE, HARD, MUTE = 0, 1, 2, 3, 4  # levels of names: none, cut unless it holds most, cut (by name, by tag), without text


def _named(tag: str, attributes: str, inside: bool) -> tuple[int, bool]:
    """The level of an element by its tag and attributes, and whether it is a main area."""
    level, main = (HARD if tag in FIRM else WEAK) if tag in CUT or (tag in ("header", "aside") and not inside) else FREE, tag == "main"
    if tag in SILENT:
        return MUTE, False
    if attributes:
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "role":
                level, main = max(level, WEAK * (value in ROLES)), main or value == "main"
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                return MUTE, False
            elif name in ("class", "id") and tag not in UNNAMED:
                names, words = INSIDE if inside else NAMES, value.split()
                level = max(level, WEAK * any(_site_part(w, names) for w in words), SURE * (inside and any(w in COMMENTS for w in words)))
            elif name in ("class", "id") and tag == "article":
                level = max(level, HARD * any(w.partition("-")[0] in ("comment", "comments", "reply") for w in value.split()))
    return level, main


def read(page: str) -> Page:
    """The page's texts and ranges."""
    found = Page()
    out, plain = found.out, found.plain
    stack = [Open("", 0, FREE, False)]
    sums = [0]
    places: dict[str, list[int]] = {}  # of the open elements of each tag in the stack
    blocks, bars = [0], [0]  # places of open blocks, and of those that end no item outside of them
    mute = areas = links = 0
    title, headings = "", []

    def close() -> None:
        nonlocal mute, areas, links
        e = stack.pop()
        places[e.tag].pop()
        if e.tag in BLOCK:
            blocks.pop()
            if e.tag in BARS:
                bars.pop()
        links -= e.tag == "a"
        end = len(out)
        if e.tag in BLOCK and out and out[-1] is not None:
            out.append(None)
            plain.append(0)
        if e.level == MUTE:
            mute -= 1
            return
        areas -= e.area
        above = stack[-1]
        if e.level and not e.holds:
            found.named.append((e.start, end, 0 if e.level in (SURE, HARD) else e.prose))
        if e.tag in ("h1", "h2") and not places.get("h1") and not places.get("h2"):  # each text once, however headings nest
            headings.append("".join([x or " " for x in out[e.start : end]]))
        if e.area:
            (found.articles if e.tag == "article" else found.mains).append((e.start, end))
        elif e.chars and not e.holds and (e.tag in CONTAINER or (e.tag in LEAF and not areas)):
            place = WITHIN if areas else ALONE if e.tag in LEAF else OUTSIDE
            found.subtrees.append((e.start, end, xxhash.xxh64_intdigest(f"{place} {e.tag} {end - e.start} {between(out, sums, e.start, end)}") - (1 << 63), place))
        above.chars += e.chars
        above.links += e.links
        above.holds |= e.holds or e.area
        above.prose += 0 if e.level == HARD and not e.holds else e.prose

    def text(raw: str) -> None:
        if mute:
            return
        if "&" in raw:
            raw = html.unescape(raw)
        n = len(raw.strip())
        e = stack[-1]
        e.chars += n
        if links:
            e.links += n
        else:
            e.prose += n
        out.append(raw)
        plain.append(0 if links else n)

    def end_block() -> None:
        if out and out[-1] is not None:
            out.append(None)
            plain.append(0)

    def close_to(k: int) -> None:
        while len(stack) > k:
            close()

    at, n, token, unclosed = 0, len(page), TOKEN, 0
    while at < n:
        m = token.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        if not m[2] and token is TOKEN:  # no tag end outside of quotes in all that follows
            unclosed += 1
            if unclosed == UNCLOSED:
                token = SIMPLE
        tag = tag.lower()
        if closing:
            if tag == "br":
                text(" ")
            elif places.get(tag):
                close_to(places[tag][-1])
            continue
        if tag in VOID:
            if tag == "br":
                text("\n")
            elif tag == "hr":
                end_block()
            continue
        if tag in RAW:
            e = RAW[tag].search(page, at)
            title = title or page[at : e.start() if e else n] if tag == "title" else title
            at = e.end() if e else n
            continue
        if tag in BLOCK:
            while places.get("head"):  # whose end tag may be left out
                close()
            if tag not in ("option", "select") and stack[blocks[-1]].tag == "p":
                close_to(blocks[-1])
            for other in SIBLINGS.get(tag, ()):
                if places.get(other) and places[other][-1] > bars[-1]:
                    close_to(places[other][-1])
            end_block()
        level, main = _named(tag, attributes, areas > 0)
        area = not mute and level < HARD and (main or tag == "article")
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            blocks.append(len(stack))
            if tag in BARS:
                bars.append(len(stack))
        stack.append(Open(tag, len(out), level, area))
        mute += level == MUTE
        areas += area
        links += tag == "a"
        if attributes.endswith("/") and tag not in BLOCK:
            close()
    while len(stack) > 1:
        close()
    found.prose, found.story = stack[0].prose, " ".join([title, *headings]).split() if any(map(str.strip, headings)) else []
    return found


def between(out: list[str | None], sums: list[int], start: int, end: int) -> int:
    """A hash of out[start:end]; sums holds those of its beginnings, as far as they have been needed."""
    for x in out[len(sums) - 1 : end]:
        sums.append((sums[-1] * BASE + xxhash.xxh64_intdigest(x or "\x1e")) % PRIME)
    return (sums[end] - sums[start] * pow(BASE, end - start, PRIME)) % PRIME


def main_text(page: str, templates: frozenset[int], names: bool = True, areas: bool = True) -> tuple[str, int, bool]:
    """The text without the page's templates, how many of these were cut, and whether they alone decided.

    names and areas false leave out steps 4 and 5, so that recurrence alone decides on every page.
    """
    found = read(page)
    out, plain = found.out, found.plain
    keep = bytearray(b"\1") * len(out)
    prose = lambda ranges: sum(sum(itertools.compress(plain[a:b], keep[a:b])) for a, b in ranges)
    whole = [(0, len(out))]

    def cut(ranges: list[tuple[int, int]]) -> None:
        for a, b in _outer(ranges):  # each place once, however ranges nest
            keep[a:b] = bytes(b - a)

    recurring = [(a, b) for a, b, h, place in found.subtrees if place != WITHIN and h in templates]
    before = bytes(keep)
    cut(recurring)
    if recurring and not any(k and x and not x.isspace() for x, k in zip(out, keep, strict=True)):
        keep[:], recurring = before, []
    known = bool(recurring) and _knows_frame(found, keep)
    if names and not known:
        around = _outer([*found.articles, *found.mains])
        cut([(a, b) for a, b, own in found.named if not own])
        starts, sums = [a for a, _ in around], [0, *itertools.accumulate(n * k for n, k in zip(plain, keep, strict=True))]

        def holds_most(a: int, own: int) -> bool:
            """Whether a part is most of the prose of the area that it stands in, or of a page without areas."""
            k = bisect_right(starts, a) - 1
            if k >= 0 and a < around[k][1]:
                return 2 * own > sums[around[k][1]] - sums[around[k][0]]
            return not around and 2 * own > found.prose

        cut([(a, b) for a, b, own in found.named if not holds_most(a, own)])
    chosen, left = whole, prose(whole)
    if areas and not known:
        chosen = next((_outer(r) for r in (found.articles, found.mains) if r and 2 * prose(_outer(r)) >= left), whole)
    within = [(a, b) for a, b, h, place in found.subtrees if place == WITHIN and h in templates]
    if within:
        before, held = bytes(keep), prose(chosen)
        cut(within)
        if 2 * prose(chosen) < held:
            keep[:], within = before, []
    inside = bytearray(len(out))
    for a, b in chosen:
        inside[a:b] = b"\1" * (b - a)
    blocks, part = [], []
    for x, k, i in zip(out, keep, inside, strict=True):
        if x is None:
            blocks.append("".join(part))
            part = []
        elif k and i:
            part.append(x)
    blocks.append("".join(part))
    return "\n".join([t for x in blocks if (t := SPACE.sub(" ", x).strip())]), len(recurring) + len(within), known


def _knows_frame(found: Page, keep: bytearray) -> bool:
    """Whether what recurs is at least half of the text around the page's articles and main areas: then it is the site's frame."""
    inside = bytearray(len(found.out))
    for a, b in _outer([*found.articles, *found.mains]):
        inside[a:b] = b"\1" * (b - a)
    around = [(len(x.strip()), k) for x, k, i in zip(found.out, keep, inside, strict=True) if x and not i]
    return 2 * sum(n for n, k in around if not k) >= sum(n for n, _ in around) if any(inside) else True


def _outer(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that lie in no other of them."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges, key=lambda r: (r[0], -r[1])):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


def _pages(df: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    url = F.col(f"`{url_col}`").cast("string")
    return df.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), url.alias("url"), F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("")).alias("host"), F.col(f"`{html_col}`").cast("string").alias("html"))


def find_subtrees(rows: DataFrame) -> DataFrame:
    """(host, hash, place, page, story) of the subtrees of (host, html) rows, written; page tells pages apart, story those that are no copies."""
    schema = "host string, hash long, place byte, page long, story long"
    types = arrow_schema(rows.sparkSession, schema)

    def hashes(batches):
        for b in batches:
            found = []
            for host, page, key in zip(*(c.to_pylist() for c in b.columns), strict=True):
                of = read(page or "")
                story = xxhash.xxh64_intdigest(" ".join(of.story) or SPACE.sub(" ", " ".join([x or "\n" for x in of.out]))) - (1 << 63)
                # The null hash stands once for each page: it counts the host's pages in the same aggregation.
                found += [(host, h, place, key, story) for h, place in {(None, None), *((h, place) for _, _, h, place in of.subtrees)}]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), types, strict=True)], schema=types)

    return written(rows.select("host", "html", F.xxhash64("html").alias("page")).mapInArrow(hashes, schema), "subtrees")


def find_templates(subtrees: DataFrame) -> DataFrame:
    """(host, hash) of the subtrees that are templates of a host."""
    stories = subtrees.groupBy("host", "hash", "place", "story").agg(F.count(F.lit(1)).alias("_"))
    counts = written(stories.groupBy("host", "hash", "place").agg(F.count(F.lit(1)).alias("n")).where(f"hash is null or n >= {SEVERAL}"), "counts")
    hosts = counts.where("hash is null").select("host", F.col("n").alias("pages"))
    enough = F.when(F.col("place") == WITHIN, SHARE * F.col("pages")).when(F.col("place") == ALONE, COMMON * F.col("pages")).otherwise(SEVERAL)
    return counts.where("hash is not null").join(hosts, "host").where(F.col("n") >= enough).select("host", "hash")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", names: bool = True, areas: bool = True) -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars, n_templates (subtrees cut because they recur) and
    by_templates (whether these alone decided, without names and areas)."""
    rows = _pages(pages, id_col, url_col, html_col).withColumn("page", F.xxhash64("html"))
    subtrees = find_subtrees(rows)
    templates = find_templates(subtrees)
    mine = subtrees.where("hash is not null").join(templates, ["host", "hash"], "left_semi")
    copies = subtrees.where("hash is null").groupBy("host", "page").agg(F.ceil(F.count(F.lit(1)) / COPIES).cast("int").alias("keys"))
    own = written(mine.groupBy("host", "page").agg(F.collect_set("hash").alias("own")).join(copies, ["host", "page"]), "own")
    hot = small(own.where("keys > 1").select("host", "page", "keys"), BROADCAST_ROWS)
    dealt = rows.join(hot, ["host", "page"], "left").withColumn("key", F.coalesce(F.pmod(F.xxhash64("page_id", "url"), F.col("keys")).cast("int"), F.lit(0))).drop("keys")
    lists = own.select("host", "page", "own", F.explode(F.sequence(F.lit(0), F.col("keys") - 1)).alias("key"))
    joined = dealt.join(small(lists, BROADCAST_ROWS), ["host", "page", "key"], "left").select("page_id", "url", "html", "own")
    schema = "page_id long, url string, text string, n_chars long, n_templates long, by_templates boolean"
    types = arrow_schema(rows.sparkSession, schema)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [main_text(p or "", frozenset(o or ()), names, areas) for p, o in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                more = [pa.array([x[0] for x in texts], pa.string()), pa.array([len(x[0]) for x in texts], pa.int64()), pa.array([x[1] for x in texts], pa.int64()), pa.array([x[2] for x in texts], pa.bool_())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.string()), *more], schema=types)

    return joined.mapInArrow(run, schema)
