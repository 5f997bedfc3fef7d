"""Main text of web pages, from container paths that the pages of a host agree on."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsieve.session import materialize, ship_package

#: A container is left for a child that holds at least this share of its text.
DESCEND = 0.75
#: A path is left out by a host if so many pages that suggest the winner, and more than keep it, leave it out.
LEFT_OUT = 2
#: A list is a menu if links hold at least this share of its text, in so many items or more.
MENU_SHARE, MENU_ITEMS = 0.8, 3

#: An element that holds at least this share of a page's text is no noise because of its name.
MAJOR = 0.5
#: ... or this share, if the name is one of replies and the title isn't inside.
NEARLY_ALL = 0.9

# fixed values: elements of HTML
RAW = frozenset("script style textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody "
    "td tfoot th thead title tr ul caption option select".split()
)
NOISE_TAGS = frozenset(
    "script style noscript template iframe svg canvas object embed head title nav footer aside form button select "
    "textarea input label dialog menu search audio video map".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# words of class and id that name what isn't the article
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner nav "
    "navbar navigation menu menus breadcrumb breadcrumbs sidebar side footer masthead topbar toolbar cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login comment comments commentlist discussion disqus respond reply replies share sharing social related "
    "recommended recommendations widget widgets pagination pager copyright legal disclaimer skip hidden form search".split()
)
# ... of these, what may be longer than the article
REPLIES = frozenset("comment comments commentlist discussion disqus respond reply replies".split())
# words that turn a name behind them into a layout: has-sidebar, no-comments
LAYOUT = frozenset("has no non not with without".split())
HEADER = frozenset(["header"])
# elements that an opening tag closes
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
LISTS = frozenset("ul ol dl table tbody thead menu".split())
# elements that are text themselves, no containers
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd td pre blockquote table figure figcaption hgroup header details address".split())

# inline elements; any other that isn't named here is a block if a block comes first inside of it
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark meter nobr output progress q rp rt ruby s samp "
    "slot small span strike strong sub sup time tt u var picture".split()
)
#: Elements nested deeper become siblings, as in browsers.
DEEPEST = 512

# An attribute value that isn't quoted ends at white space or ">"; a tag without an end reaches to the end of the
# page. Nothing is tried twice, so a page of any content takes time in proportion to its length.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)?+)?+)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))?+)?+", re.S
)
_NEXT_TAG = re.compile(r"\s*+<([a-zA-Z][^\s/>]*+)")
_P, _NOT_P = frozenset(["p"]), BLOCKS - {"p"}
_NAME = re.compile(r"[a-z]+")
_GENERAL = re.compile(r"\d+")


class Element:
    __slots__ = ("parent", "tag", "path", "noise", "heading", "names", "main", "text", "links", "items", "depth")

    def __init__(
        self, parent: Element | None, tag: str, path: str, noise: bool, heading: bool, names: frozenset[str] = frozenset()
    ) -> None:
        self.parent, self.tag, self.path, self.noise, self.heading = parent, tag, path, noise, heading
        self.names, self.main = names, False  # own names of noise; whether a title or main element is inside
        self.text = self.links = self.items = 0
        self.depth: int = parent.depth + 1 if parent is not None else 0


class Page:
    """Blocks of text of a page with the elements around them. One pass, memory in proportion to the page.

    Names of noise count for elements with a minor share of the text. If nothing is
    left, the page is parsed once more without them.
    """

    def __init__(self, html: str) -> None:
        self.root = Element(None, "", "", False, False)
        self.elements: list[Element] = []
        self.blocks: list[tuple[Element, str, int]] = []  # element, text, characters in links
        self.named: set[str] = set()  # paths of elements that are noise by name
        self.paths: dict[tuple[str, str], str] = {}  # path below a path, one string for all
        self.own_blocks: set[str] = set()  # other elements that hold blocks
        self.by_name = True
        self._parse(html)
        self._drop_named()
        if not self.blocks:
            self.elements, self.by_name = [], False
            self.named.clear()
            self._parse(html)
        self._measure()
        for element, _, links in self.blocks:
            element.links += links
            element.items += 1
        for e in reversed(self.elements):  # parents come first
            e.parent.links += e.links
            e.parent.items += e.items
        self.blocks = [b for b in self.blocks if not self._in_menu(b[0])]
        self._measure(linked=False)

    def _drop_named(self) -> None:
        """Takes out the blocks of elements that are noise by name, replies first.

        A name is no noise where it is the name of a layout: on an element with a major share of the text, or on
        elements that together have one. Replies may be longer than the article, so they need the title inside or
        nearly all of the text for that.
        """
        if not any(e.names for e in self.elements):
            return
        for element in self.elements:
            e = element if element.tag in ("h1", "main") else None
            while e is not None and not e.main:
                e.main = True
                e = e.parent
        self._measure()
        enough = MAJOR * self.root.text
        replies = {
            id(e): e.names & REPLIES
            for e in self.elements
            if e.names & REPLIES and e.text < (enough if e.main else NEARLY_ALL * self.root.text)
        }
        self._drop_blocks(replies)
        self._measure()
        enough = MAJOR * self.root.text
        named = {id(e): e.names - REPLIES for e in self.elements if e.names - REPLIES and e.text < enough}
        shares: Counter[str] = Counter()
        for element, text, _ in self.blocks:
            names, e = set(), element
            while e is not None:
                names |= named.get(id(e), frozenset())
                e = e.parent
            shares.update(dict.fromkeys(names, len(text)))
        layout = {name for name, n in shares.items() if n >= enough}
        self._drop_blocks({e: names - layout for e, names in named.items()})
        for e in (self.root, *self.elements):
            e.text = 0

    def _measure(self, linked: bool = True) -> None:
        """Text of every element with what lies inside of it, without that of links unless ``linked``."""
        for e in (self.root, *self.elements):
            e.text = 0
        for element, text, links in self.blocks:
            element.text += len(text) if linked else len(text) - links
        for e in reversed(self.elements):  # parents come first
            e.parent.text += e.text

    def _drop_blocks(self, noise: dict[int, frozenset[str]]) -> None:
        """Takes out the blocks inside of these elements; headings stay in the header of an article."""
        kept = []
        for block in self.blocks:
            outermost, e = None, block[0]
            while e is not None:
                names = noise.get(id(e))
                if names and not (e.heading and names == HEADER and self._is_heading(block[0])):
                    outermost = e
                e = e.parent
            if outermost is None:
                kept.append(block)
            else:
                self.named.add(outermost.path)
        self.blocks = kept

    @staticmethod
    def _in_menu(element: Element | None) -> bool:
        while element is not None:
            if element.tag in LISTS and element.items >= MENU_ITEMS and element.links >= MENU_SHARE * element.text:
                return True
            element = element.parent
        return False

    def _parse(self, html: str) -> None:
        at, current = 0, self.root
        ends: dict[int, int] | None = None
        pieces: list[str] = []
        linked: list[str] = []
        in_link = 0

        def flush() -> None:
            if pieces:
                text = " ".join(unescape("".join(pieces)).split())
                if text and not current.noise and not (in_header(current) and not self._is_heading(current)):
                    links = len(" ".join(unescape("".join(linked)).split()))
                    self.blocks.append((current, text, links))
                pieces.clear()
                linked.clear()

        def in_header(e: Element | None) -> bool:
            while e is not None and e.heading:
                if e.tag == "header":
                    return True
                e = e.parent
            return False

        def say(text: str) -> None:
            pieces.append(text)
            if in_link:
                linked.append(text)

        def leave(tags: frozenset[str] | set[str], stop: frozenset[str]) -> None:
            """Closes up to the innermost of ``tags``, if none of ``stop`` is in between."""
            nonlocal current, in_link
            e = current
            while e is not self.root and e.tag not in tags:
                if e.tag in stop:
                    return
                e = e.parent
            if e is not self.root:
                flush()
                current, in_link = e.parent, 0

        while True:
            match = _TOKEN.search(html, at)
            if match is None:
                say(html[at:])
                break
            if match.start() > at:
                say(html[at : match.start()])
            at = match.end()
            if match[2] is None:
                if match[0].startswith("<![CDATA["):
                    say(match[0][9:].removesuffix("]]>"))
                continue
            closing, tag = match[1], match[2].lower()
            if closing:
                if tag == "a":
                    in_link = max(0, in_link - 1)
                if tag in BLOCKS or tag in NOISE_TAGS or tag in self.own_blocks:
                    leave({tag}, frozenset() if tag != "li" else LISTS)
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    say(" ")
                continue
            if tag == "a":
                in_link = 1
                continue
            attributes = match[3]
            block = tag in BLOCKS
            if not block and tag not in NOISE_TAGS and tag not in INLINE:
                inside = _NEXT_TAG.match(html, at)
                block = inside is not None and inside[1].lower() in BLOCKS
                if block:
                    self.own_blocks.add(tag)
            if not block and tag not in NOISE_TAGS and not attributes.strip():
                continue
            noise, name, names = self._judge(tag, attributes)
            if not self.by_name:
                names = frozenset()
            if not block and tag not in NOISE_TAGS:
                # an inline element that is noise, or all of whose name says so: its text goes, up to its end
                if (noise or (names and self._named_inline(attributes))) and not match[0].endswith("/>"):
                    ends = ends if ends is not None else self._ends(html)
                    at = ends.get(at, at)
                continue
            flush()
            if block:
                leave(_P, _NOT_P)
                if tag in CLOSES:
                    leave(CLOSES[tag], LISTS)
            if match[0].endswith("/>") and not block:
                continue
            if current.depth >= DEEPEST:
                current = current.parent
            step = f">{tag}.{name}" if name else f">{tag}"
            path = self.paths.setdefault((current.path, step), current.path + step)
            # the header of an article holds its headings, any other none of its text
            header = tag == "header" or (tag == "div" and self.by_name and _names_header(name))
            heading = current.heading or (header and self._within_article(current))
            if header and tag == "div":
                names = names | HEADER
            noise = current.noise or noise or (tag == "header" and not heading)
            current = Element(current, tag, path, noise, heading, names)
            self.elements.append(current)
        flush()

    @staticmethod
    def _named_inline(attributes: str) -> bool:
        """Whether a class or the id consists of names of noise only: ``share-links`` doesn't, ``share`` does."""
        for m in _ATTRIBUTE.finditer(attributes):
            if m[1].lower() in ("class", "id"):
                value = next((x for x in m.groups()[1:4] if x is not None), "").lower()
                if any(words and words <= NOISE_NAMES for words in map(_own_words, value.split())):
                    return True
        return False

    @staticmethod
    def _ends(html: str) -> dict[int, int]:
        """Where each inline element ends, by the end of its opening tag; those without an end are left out."""
        ends: dict[int, int] = {}
        opened: dict[str, list[int]] = {}
        for m in _TOKEN.finditer(html):
            tag = (m[2] or "").lower()
            if not tag or tag in BLOCKS or tag in VOID:
                continue
            if not m[1]:
                opened.setdefault(tag, []).append(m.end())
            elif opened.get(tag):
                ends[opened[tag].pop()] = m.end()
        return ends

    @staticmethod
    def _is_heading(element: Element) -> bool:
        return element.tag in ("h1", "h2", "h3", "h4", "h5", "h6")

    @staticmethod
    def _within_article(element: Element) -> bool:
        while element is not None:
            if element.tag in ("article", "main"):
                return True
            element = element.parent
        return False

    @staticmethod
    def _judge(tag: str, attributes: str) -> tuple[bool, str, frozenset[str]]:
        """Whether an element is noise by itself, its generalised class or id, and its names of noise."""
        if tag in NOISE_TAGS:
            return True, "", frozenset()
        if not attributes.strip():
            return False, "", frozenset()
        found = {}
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), next((x for x in m.groups()[1:4] if x is not None), "").lower())
        noise = (
            "hidden" in found
            or found.get("aria-hidden") == "true"
            or found.get("role") in ROLES
            or "display:none" in found.get("style", "").replace(" ", "")
        )
        names: set[str] = set()
        if tag not in ("html", "body", "main", "article") and not _is_heading_tag(tag):
            for each in f"{found.get('class', '')} {found.get('id', '')}".split():
                names.update(_own_words(each) & NOISE_NAMES)
        first = (found.get("class") or found.get("id") or "").split()
        return noise, _GENERAL.sub("#", first[0]) if first else "", frozenset(names)

    def best(self) -> tuple[Element, set[str]]:
        """The container to which the text leads, and the paths of other containers left out on the way.

        From the root down, as long as one child holds most of the text and what is beside it is
        another container: neither loose text, nor a heading or paragraph, nor the title of the page.
        Inside of an article nothing is left out, inside of a main element only for an article.
        """
        children: dict[int, list[Element]] = {}
        for e in self.elements:
            if e.text:
                children.setdefault(id(e.parent), []).append(e)
        loose, titles = {id(b[0]) for b in self.blocks}, set()
        for element, _, _ in self.blocks:
            e: Element | None = element if element.tag == "h1" else None
            while e is not None and id(e) not in titles:
                titles.add(id(e))
                e = e.parent
        at, left_out, inside = self.root, set(), frozenset()
        while True:
            below = max(children.get(id(at), []), key=lambda e: e.text, default=None)
            if below is None or below.text < DESCEND * at.text or below.tag in ("p", "li", "td", "ul", "ol", "pre") or _is_heading_tag(below.tag):
                return at, left_out
            beside = [e for e in children[id(at)] if e.path != below.path]
            inside = inside | ({at.tag} & {"article", "main"})
            if (
                id(at) in loose
                or any(e.tag in FLOW or id(e) in titles for e in beside)
                or (beside and ("article" in inside or ("main" in inside and below.tag != "article")))
            ):
                return at, left_out
            left_out.update(e.path for e in beside)
            at = below

    def paths_below(self, container: Element) -> set[str]:
        """Paths of the elements with text inside of ``container``."""
        inside, found = {id(container)}, set()
        for e in self.elements:  # parents come first
            if id(e.parent) in inside:
                inside.add(id(e))
                if e.text:
                    found.add(e.path)
        return found

    def text_below(self, path: str, also: str | None = None, without: frozenset[str] = frozenset()) -> str:
        """Text of the elements with this path, in the order of the page; and of those with the
        path ``also``, but for what lies in one of ``without``."""
        chosen = []
        for element, text, _ in self.blocks:
            e: Element | None = element
            dropped = found = False
            while e is not None and e.path != path:
                dropped = dropped or e.path in without
                found = found or e.path == also
                e = e.parent
            if e is not None or (found and not dropped):
                chosen.append(text)
        return "\n\n".join(chosen)

    def has(self, path: str) -> bool:
        return any(e.text and e.path == path for e in self.elements) or path == ""


def _own_words(name: str) -> set[str]:
    """Words of a class or id, without those of what it has or has not."""
    words = _NAME.findall(name)
    return set(words[: next((i for i, w in enumerate(words) if w in LAYOUT), len(words))])


def _names_header(name: str) -> bool:
    return "header" in _own_words(name)


def _is_heading_tag(tag: str) -> bool:
    return len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()


def vote(html: str) -> tuple[str, int, set[str], set[str]] | None:
    """Path and score of the container that a page suggests, the paths it leaves out and those it keeps; none without text."""
    page = Page(html)
    best, left_out = page.best()
    return (best.path, best.text, left_out | page.named, page.paths_below(best)) if best.text > 0 else None


def extract(html: str, winner: str | None, left_out: Iterable[str] = ()) -> str:
    """Main text of a page: what the winning path of its host finds, and what the page itself suggests.

    If the page's own container holds the winner, what the host leaves out is no part of the text. A page without the
    winner, or with most of its text elsewhere, is of another template: nothing of its container is lost.
    """
    page = Page(html)
    own = page.best()[0].path
    if winner is None or winner == own or not page.has(winner):
        return page.text_below(own)
    return page.text_below(winner, own, frozenset(left_out) if winner.startswith(f"{own}>") else frozenset())


def host_of(url: Column) -> Column:
    """Host name of an address, in lower case; empty if there is none."""
    return F.lower(
        F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))
    )


def winning_paths(pages: DataFrame) -> DataFrame:
    """``host, path, left_out``: the container path that most pages of a host suggest, and what it leaves out.

    Votes are summed in every task first, so a hot host is a few rows per task. Ties
    go to the path with more text, then to the later name. ``left_out`` are the paths beside the
    winner that the pages suggesting it leave out, if fewer pages keep them.
    """
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # votes have a path, what they leave out a path and another, what pages keep another only
            votes: Counter[tuple] = Counter()
            scores: Counter[tuple] = Counter()
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = vote(html.as_py()) if html.is_valid else None
                if found is None:
                    continue
                path, score, left_out, kept = found
                votes[host, path, None] += 1
                scores[host, path, None] += score
                votes.update((host, path, other) for other in left_out)
                votes.update((host, None, other) for other in kept)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([k[i] for k in votes], pa.string()) for i in range(3)),
                    pa.array(votes.values(), pa.int64()),
                    pa.array([scores[k] for k in votes], pa.int64()),
                ],
                names=["host", "path", "other", "votes", "score"],
            )

    votes = materialize(
        pages.select("host", "html")
        .mapInArrow(run, "host string, path string, other string, votes long, score long")
        .groupBy("host", "path", "other")
        .agg(F.sum("votes").alias("votes"), F.sum("score").alias("score")),
        "votes",
    )
    winners = (
        votes.where("path is not null and other is null")
        .groupBy("host")
        .agg(F.max(F.struct("votes", "score", "path")).alias("best"))
        .select("host", F.col("best.path").alias("path"))
    )
    kept = votes.where("path is null").select("host", "other", F.col("votes").alias("kept"))
    left_out = (
        votes.where("other is not null")
        .join(winners, ["host", "path"])
        .join(kept, ["host", "other"], "left")
        .where((F.col("votes") >= LEFT_OUT) & (F.col("votes") > F.coalesce("kept", F.lit(0))))
        .groupBy("host")
        .agg(F.collect_set("other").alias("left_out"))
    )
    return winners.join(left_out, "host", "left")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages (page_id, url, html)``.

    Each page suggests the container that holds most of its text outside of menus, adverts,
    forms and the like, as a path of tags and classes without numbers. The
    pages of a host vote, and every page is read again by the winning path; what a page itself suggests
    beyond it stays, unless the host leaves it out. NULL html has
    no text; pages without a host name are one host; repeated rows are extracted (and vote) as often as they
    come. An empty table gives an empty result. Other columns are ignored. The table of
    winners is written first, so Spark knows its size and broadcasts it only if it is small.
    """
    ship_package(pages.sparkSession)
    hosted = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    winners = materialize(winning_paths(hosted), "winners")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                extract(html.as_py(), path.as_py(), left_out.as_py() or ()) if html.is_valid else ""
                for html, path, left_out in zip(batch.column(2), batch.column(3), batch.column(4), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return (
        hosted.join(winners, "host", "left")
        .select("page_id", "url", "html", "path", "left_out")
        .mapInArrow(run, f"page_id {kind}, url string, text string")
        .withColumn("n_chars", F.length("text").cast("bigint"))
    )
