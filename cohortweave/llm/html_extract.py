"""Main text of web pages, by the template that pages of one host share.

A page is a sequence of tokens: tags and text nodes, told apart by their path in the document. Tokens that occur equally
often on every page of a host form an equivalence class; classes of fewer pages are its optional parts. The tokens of a
class stand in one order on all pages (others leave it), and the gaps between them are its slots. What stands in a slot
has a role of its own there, so classes are found again among the roles until none is new: they nest in slots, to any depth.

Text of a class that is on all pages says nothing about a single page: a block of such text alone is left out, in articles
too, and a text that belongs to the template in one slot is content in another. Text of optional parts is content, for it
tells the pages that have it from others. Which slots are content is told by tags, roles and names; where pages disagree
about the names in a slot, most of them decide against a name.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.llm import by_value
from cohortweave.llm.words import blocks
from cohortweave.operators.lookups import lookup_join
from cohortweave.sources.workspace import stored

# Hosts with fewer pages have no template of their own, and parts of fewer pages are none of it.
MIN_PAGES = 3
# An optional part is on one of so many pages of its host at least; so a host has at most so many times the tokens of a page.
PART_OF_PAGES = 10
# Templates that a task keeps ready.
TEMPLATES_HELD = 64

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z]+")

RAW = frozenset("script style textarea noscript template iframe svg object canvas annotation annotation-xml".split())
# Raw elements that may close themselves and, if nothing closes them, hold no more than their tag.
FOREIGN = frozenset("svg object canvas annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section select summary table tbody td tfoot th "
    "thead title tr ul".split()
)
# What an opening tag closes, if it is open in the same container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CONTAINERS = frozenset("ul ol dl table select div section article main aside nav body".split())

BOILERPLATE = frozenset("head nav header footer aside form button select dialog menu".split())
MAIN = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Parts of class names and ids that mark boilerplate.
NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar footer masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup social "
    "share sharing related recommended comment comments disqus respond login widget toolbar pagination pager copyright".split()
)
# Words at the end of a class name or id that say nothing about the kind of its element, and first ones that tell a state.
GENERIC = frozenset(
    "list container wrapper wrap box links link buttons button items item area section block bar slot unit group panel form left "
    "right top bottom inner outer widgets icons posts articles".split()
)
STATES = frozenset("has is no not with without".split())


@dataclass
class Page:
    """Tokens of a page in order, tags and texts that are not blank, and its text blocks."""

    tokens: list[str] = field(default_factory=list)
    # Of each token which text it is, -1 for a tag.
    places: list[int] = field(default_factory=list)
    # (token of the text, text, block, whether it is boilerplate, whether it is in the main element, whether a name says boilerplate)
    texts: list[tuple[str, str, int, bool, bool, bool]] = field(default_factory=list)

    def add(self, token: str, place: int = -1) -> None:
        self.tokens.append(token)
        self.places.append(place)


def _named_boilerplate(value: str) -> bool:
    """Whether one of the names is of boilerplate: by its last part that is not generic, unless it tells a state."""
    for name in value.split():
        parts = _PARTS.findall(name)
        while len(parts) > 1 and parts[-1] in GENERIC and parts[-1] not in NAMES:
            parts.pop()
        if parts and parts[-1] in NAMES and not (len(parts) > 1 and parts[0] in STATES):
            return True
    return False


def _is_boilerplate(tag: str, attributes: str) -> bool:
    """Whether the tag itself, its role or its being hidden marks its element as boilerplate."""
    if tag in BOILERPLATE:
        return True
    if not attributes:
        return False
    if tag not in ("html", "body", "article", "main") and _HIDDEN.search(attributes):
        return True
    return any(name.lower() == "role" and "".join(values).lower() in ROLES for name, *values in _ATTRIBUTE.findall(attributes))


def _is_named(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether class or id hint at boilerplate; in the main element they do not."""
    if not attributes or in_main or tag in ("html", "body"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() in ("class", "id") and (_named_boilerplate(value) or value in ("header", "site-header", "page-header")):
            return True
    return False


def parse(source: str) -> Page:
    """The page's tokens and texts; unclosed and stray tags are tolerated, comments are dropped.

    A name that hints at boilerplate does not count for an element with more than half of the page's text.
    """
    page = Page()
    stack: list[tuple[str, str, bool, bool, tuple[int, ...]]] = []  # tag, path, boilerplate, main, named elements
    named = [0]  # length of the page's text, and of that of each named element
    texts: list[tuple[str, str, int, bool, bool, tuple[int, ...]]] = []
    block, at, size = 0, 0, len(source)
    unclosed: set[str] = set()  # foreign tags that nothing closes from here on

    def text(raw: str) -> None:
        if raw:
            path, boilerplate, main, names = stack[-1][1:] if stack else ("", False, False, ())
            plain = html.unescape(raw)
            shown = " ".join(plain.split())
            if shown:
                page.add(f"{path}|{shown}", len(texts))
            texts.append((f"{path}|{shown}", plain, block, boilerplate, main, names))
            if not boilerplate:
                named[0] += len(shown)
                for i in names:
                    named[i] += len(shown)

    while at < size:
        opening = source.find("<", at)
        if opening < 0:
            text(source[at:])
            break
        if source.startswith("<!--", opening):
            text(source[at:opening])
            end = source.find("-->", opening + 4)
            at = size if end < 0 else end + 3
            continue
        if source.startswith(("<!", "<?"), opening):
            text(source[at:opening])
            end = source.find(">", opening)
            at = size if end < 0 else end + 1
            continue
        found = _TAG.match(source, opening)
        if not found:
            text(source[at : opening + 1])
            at = opening + 1
            continue
        text(source[at:opening])
        at = found.end()
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if tag in BLOCKS:
            block += 1
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                page.add("/" + stack[depth][1])
                del stack[depth:]
            continue
        if tag in RAW and not (tag in FOREIGN and attributes.endswith("/")):
            if tag not in unclosed:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(source, at)
                after = source.find(">", end.end()) if end else -1
                if after >= 0 or tag not in FOREIGN:
                    at = size if after < 0 else after + 1
                    continue
                unclosed.add(tag)
            attributes += "/"
        if tag in BLOCKS and tag != "br":
            close = CLOSES.get(tag, set()) | {"p"}
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in close:
                    del stack[i:]
                elif stack[i][0] in _CONTAINERS:
                    break
        above = stack[-1] if stack else ("", "", False, False, ())
        path = f"{above[1]}/{tag}"
        page.add(path)
        if tag not in VOID and not attributes.endswith("/"):
            main = above[3] or tag in MAIN or 'role="main"' in attributes
            names = above[4]
            if _is_named(tag, attributes, main):
                names = (*names, len(named))
                named.append(0)
            stack.append((tag, path, above[2] or _is_boilerplate(tag, attributes), main, names))
    page.texts = [(*t[:5], any(2 * named[i] <= named[0] for i in t[5])) for t in texts]
    return page


def _hash(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token) - (1 << 63)


# What a token is: a tag, text that is no content, text that a name alone says is none, other text.
TAG, NO_CONTENT, NAMED, CONTENT = range(4)

_PAGE_DDL = "host string, page_hash long, roles array<long>, kinds array<byte>, slots array<long>"


def _sequences(pages: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of each page, their roles to begin with, and their kinds; all are in the slot 0, the whole page."""
    for rows in blocks(pages, "html"):
        tokens, kinds = [], []
        for source in rows.column("html").to_pylist():
            page = parse(source or "")
            tokens.append([_hash(t) for t in page.tokens])
            kinds.append([TAG if i < 0 else NO_CONTENT if (t := page.texts[i])[3] else NAMED if t[5] else CONTENT for i in page.places])
        yield _page_batch(rows, tokens, pa.array(kinds, pa.list_(pa.int8())), [[0] * len(t) for t in tokens])


def _page_batch(rows: pa.RecordBatch, roles: list, kinds: pa.Array, slots: list) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [rows.column("host"), rows.column("page_hash"), pa.array(roles, longs), kinds, pa.array(slots, longs)],
        names=["host", "page_hash", "roles", "kinds", "slots"],
    )


def _roles(before: Sequence[int], slots: Sequence[int]) -> list[int]:
    """What each token is in its slot; roles are only ever split."""
    return [hash(x) if x[1] else x[0] for x in zip(before, slots)]


def _columns(rows: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(rows.column(n).to_pylist() for n in names))


def _occurrences(pages: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and role of a batch: pages, occurrences, two sums that stand for the occurrence vector, and where its first page has it."""
    for rows in pages:
        found: dict[tuple[str, int], list[int]] = {}
        for host, page_hash, roles, kinds in _columns(rows, "host", "page_hash", "roles", "kinds"):
            counts: dict[int, list[int]] = {0: [1, -1, TAG]}  # 0 stands for the page itself
            for place, role in enumerate(roles):
                if role in counts:
                    counts[role][0] += 1
                else:
                    counts[role] = [1, place, kinds[place]]
            a, b = page_hash & 0xFFFFFF, (page_hash >> 24) & 0xFFFFFF
            for role, (n, place, kind) in counts.items():
                sums = found.setdefault((host, role), [0, 0, 0, 0, page_hash, place, 0])
                for i, x in enumerate((1, n, a * n, b * n)):
                    sums[i] += x
                if page_hash < sums[4]:
                    sums[4:6] = page_hash, place
                sums[6] |= kind > TAG
        hosts, names = zip(*found) if found else ((), ())
        columns = list(zip(*found.values())) or [()] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), *(pa.array(c, pa.int64()) for c in (names, *columns))],
            names=["host", "role", "pages", "occurrences", "a", "b", "first_page", "place", "is_text"],
        )


_OCCURRENCES_DDL = "host string, role long, pages long, occurrences long, a long, b long, first_page long, place long, is_text long"

# A host's classes, each its roles in order; a place is (class, place in it, last place).
Places = dict[int, tuple[int, int, int]]


def _places(classes: Sequence[Sequence[int]]) -> Places:
    return {role: (i, place, len(roles) - 1) for i, roles in enumerate(classes) for place, role in enumerate(roles)}


def _rising(values: Sequence[int]) -> set[int]:
    """A longest rising part of different values."""
    ends: list[int] = []
    tails: list[int] = []
    before: dict[int, int | None] = {}
    for v in values:
        i = bisect_left(ends, v)
        before[v] = tails[i - 1] if i else None
        ends[i : i + 1] = [v]
        tails[i : i + 1] = [v]
    kept, at = set(), tails[-1] if tails else None
    while at is not None:
        kept.add(at)
        at = before[at]
    return kept


def out_of_order(roles: Sequence[int], classes: Sequence[Sequence[int]]) -> set[int]:
    """Roles of a page that do not stand as their class has them, once or again and again as a whole."""
    places = _places(classes)
    stand: dict[int, list[int]] = {}
    for role in roles:
        if (found := places.get(role)) is not None:
            stand.setdefault(found[0], []).append(found[1])
    wrong: set[int] = set()
    for i, seen in stand.items():
        size = len(classes[i])
        if len(seen) == size:
            if any(x > y for x, y in zip(seen, seen[1:])):
                wrong.update(classes[i][place] for place in set(seen) - _rising(seen))
        elif seen != list(range(size)) * (len(seen) // size):
            wrong.update(classes[i])
    return wrong


def _checked(pages: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, role) of the roles that leave their class, once per batch."""
    for rows in pages:
        wrong = {(host, role) for host, found, classes in _columns(rows, "host", "roles", "classes") for role in out_of_order(found, classes)}
        hosts, roles = zip(*wrong) if wrong else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(roles, pa.int64())], names=["host", "role"])


def slots_of(roles: Sequence[int], places: Places) -> list[int]:
    """The slot that each token of a page stands in, named by the role before it; 0 is no slot of a class.

    An instance of a class ends with its last token, where the class begins again, or where the slot that holds it ends.
    """
    slots: list[int] = []
    stack: list[list[int]] = []  # class, role that the slot begins with, place
    opened: dict[int, int] = {}
    for role in roles:
        found = places.get(role)
        if found is None:
            slots.append(stack[-1][1] if stack else 0)
            continue
        i, place, last = found
        depth = opened.get(i)
        if depth is None:
            depth = len(stack)
        else:
            keep = depth + (stack[depth][2] < place)
            for one in stack[keep:]:
                del opened[one[0]]
            del stack[keep:]
        slots.append(stack[depth - 1][1] if depth else 0)
        if place == last:
            if depth < len(stack):
                del opened[i]
                del stack[depth:]
        elif depth < len(stack):
            stack[depth][1:] = role, place
        else:
            stack.append([i, role, place])
            opened[i] = depth
    return slots


def _placed(pages: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages with the slots that the classes of their host make, and the roles in them."""
    for rows in pages:
        roles, slots = [], []
        for before, classes in _columns(rows, "roles", "classes"):
            slots.append(slots_of(before, _places(classes or ())))
            roles.append(_roles(before, slots[-1]))
        yield _page_batch(rows, roles, rows.column("kinds"), slots)


def _named(pages: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and slot of a batch: pages on which all, none or some of its content has a name that says it is none."""
    for rows in pages:
        found: dict[tuple[str, int], list[int]] = {}
        for host, kinds, slots in _columns(rows, "host", "kinds", "slots"):
            held: dict[int, int] = {}
            for kind, slot in zip(kinds, slots):
                if slot and kind >= NAMED:
                    held[slot] = held.get(slot, 0) | (1 if kind == NAMED else 2)
            for slot, what in held.items():
                found.setdefault((host, slot), [0, 0, 0])[what - 1] += 1
        hosts, slots = zip(*found) if found else ((), ())
        columns = list(zip(*found.values())) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), *(pa.array(c, pa.int64()) for c in (slots, *columns))], names=["host", "slot", "named", "plain", "mixed"]
        )


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def _counted(pages: DataFrame) -> tuple[DataFrame, int]:
    """The roles that are on enough pages of a host, with their occurrence vectors, stored, and how many there are on any number."""
    sums = [F.sum(c).alias(c) for c in ("pages", "occurrences", "a", "b")]
    first, is_text = F.min_by("place", "first_page").alias("place"), (F.max("is_text") > 0).alias("is_text")
    counted = pages.mapInArrow(_occurrences, _OCCURRENCES_DDL).groupBy("host", "role").agg(*sums, first, is_text)
    seen = Observation()
    likely = stored(counted.observe(seen, F.count(F.lit(1)).alias("n")).filter(F.col("pages") >= MIN_PAGES), "roles")
    return likely, seen.get["n"]


def _classes(pages: DataFrame, likely: DataFrame, whole: bool) -> DataFrame:
    """(host, classes, fixed): the classes of each host, their roles in order, and the roles of texts that are on all of its pages.

    A class has at least two roles of one occurrence vector, and so at most as many as a page has tokens. Where roles are
    the tokens of `whole` pages, a text that is equally often on all of them is fixed wherever it stands, as items of a
    shuffled menu; among roles of slots, which are many more, it must keep the order of its class.
    """
    totals = likely.filter("role = 0").select("host", F.col("pages").alias("total"))
    role = F.struct("place", "role", "is_text")
    vectors = likely.groupBy("host", "pages", "occurrences", "a", "b").agg(F.array_sort(F.collect_list(role)).alias("roles"))
    alike = lookup_join(vectors.filter(F.size("roles") >= 2), totals, ["host"], how="inner").filter(F.col("pages") * PART_OF_PAGES >= F.col("total"))
    own = F.filter("roles", lambda r: r["role"] != 0)
    texts = F.filter("roles", lambda r: r["is_text"] & (F.col("pages") == F.col("total")))
    alike = alike.select("host", F.transform(own, lambda r: r["role"]).alias("own"), F.transform(texts, lambda r: r["role"]).alias("texts"))
    found = stored(alike.groupBy("host").agg(F.collect_list("own").alias("classes"), F.flatten(F.collect_list("texts")).alias("fixed")), "classes")
    checked = lookup_join(pages, found.select("host", "classes"), ["host"], how="inner").mapInArrow(_checked, "host string, role long")
    wrong = checked.distinct().groupBy("host").agg(F.collect_list("role").alias("wrong"))
    gone = F.coalesce("wrong", F.array().cast("array<long>"))
    in_order = F.filter(F.transform("classes", lambda roles: F.array_except(roles, gone)), lambda roles: F.size(roles) >= 2)
    fixed = F.col("fixed") if whole else F.array_except("fixed", gone)
    return stored(found.join(wrong, "host", "left").select("host", in_order.alias("classes"), fixed.alias("fixed")), "classes")


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): the classes of each round, the texts that all pages have, and the slots in which names do not count.

    Pages are parsed once; the rounds go over their tokens. A round gives each token the role that it has in its slot, and
    there are rounds until no role is split.
    """
    rows = pages.filter("host <> ''").select("host", F.xxhash64("page_id", "html").alias("page_hash"), "html")
    placed = stored(rows.mapInArrow(_sequences, _PAGE_DDL), "sequences")
    rounds: list[DataFrame] = []
    before = 0
    while (counted := _counted(placed))[1] > before:
        likely, before = counted
        found = _classes(placed, likely, whole=not rounds)
        rounds.append(found.withColumn("round", F.lit(len(rounds))))
        placed = stored(lookup_join(placed, found.select("host", "classes"), ["host"]).mapInArrow(_placed, _PAGE_DDL), "sequences")
    named = placed.mapInArrow(_named, "host string, slot long, named long, plain long, mixed long").groupBy("host", "slot").agg(
        *[F.sum(c).alias(c) for c in ("named", "plain", "mixed")]
    )
    told = named.filter("mixed = 0 AND named > 0 AND plain > named").groupBy("host").agg(F.collect_list("slot").alias("unnamed"))
    none = placed.sparkSession.createDataFrame([], "host string, classes array<array<long>>, fixed array<long>, round int")
    every = reduce(DataFrame.unionByName, rounds, none)
    of_host = every.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("round", "classes", "fixed"))).alias("rounds"))
    whole = of_host.join(told, "host", "left").select("host", F.to_json(F.struct("rounds", "unnamed")).alias("template"))
    return stored(whole, "templates")


@dataclass(frozen=True)
class Template:
    """The rounds of a host, each the places of its classes and the texts that all pages have, and the slots where no name counts."""

    rounds: list[tuple[Places, frozenset[int]]]
    unnamed: frozenset[int]

    def of(self, page: Page) -> tuple[set[int], set[int]]:
        """Which texts of a page are the template's own, and which stand in slots where no name counts."""
        roles, slots = [_hash(t) for t in page.tokens], [0] * len(page.tokens)
        own: set[int] = set()
        for places, fixed in self.rounds:
            own.update(i for i, role in zip(page.places, roles) if i >= 0 and role in fixed)
            slots = slots_of(roles, places)
            roles = _roles(roles, slots)
        return own, {i for i, slot in zip(page.places, slots) if i >= 0 and slot in self.unnamed}


def read_template(text: str) -> Template:
    held = json.loads(text)
    return Template([(_places(r["classes"]), frozenset(r["fixed"])) for r in held["rounds"]], frozenset(held.get("unnamed") or ()))


def main_text(source: str | None, template: Template | None = None) -> str:
    """Text of the page's content slots: blocks in page order, joined by one space.

    Slots inside boilerplate are left out. If the page has an article or main element, its slots are
    the content; else it is all other slots. Blocks that consist of the template's own text go, unless
    nothing would be left of an article: pages of a host that are copies keep theirs.
    """
    page = parse(source or "")
    own, unnamed = template.of(page) if template else (set(), set())
    slots = [
        (i, t) for i, t in enumerate(page.texts)
        if not t[3] and not (t[5] and i not in unnamed and (t[1].strip() or not unnamed))
    ]
    inside = [(i, t) for i, t in slots if t[4]]
    if any(t[1].strip() for _, t in inside):
        slots = inside
        if all(not t[1].strip() or i in own for i, t in inside):
            own = set()
    found: dict[int, list[tuple[int, str]]] = {}
    for i, t in slots:
        found.setdefault(t[2], []).append((i, t[1]))
    texts = (
        " ".join("".join(plain for _, plain in parts).split())
        for parts in found.values()
        if not own or any(plain.strip() and i not in own for i, plain in parts)
    )
    return " ".join(filter(None, texts))


def _extractor(names: list[str]):
    def extract(pages: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, Template | None] = {}
        for rows in blocks(pages, "html"):
            texts = []
            for source, template in _columns(rows, "html", "template"):
                if template not in known:
                    if len(known) == TEMPLATES_HELD:
                        known.clear()
                    known[template] = None if template is None else read_template(template)
                texts.append(main_text(source, known[template]))
            yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "text"])

    return extract


def extract_text(pages: DataFrame) -> DataFrame:
    """The pages without html, with `text`: the main text of each.

    Pages need page_id, url and html. A null or empty html gives an empty text; pages without a host
    are read without a template. Character references are decoded; white space inside a block is one
    space. Other columns pass through; those named `text`, `host` or `template` are replaced.
    """
    names = [c for c in pages.columns if c not in ("html", "text", "host", "template")]
    hosted = pages.select(*[F.col(f"`{c}`") for c in names], "html", host_of(F.col("url")).alias("host"))
    schema = T.StructType([*[hosted.schema[n] for n in names], T.StructField("text", T.StringType())])
    joined = lookup_join(hosted, templates(hosted), ["host"]).select(*[F.col(f"`{c}`") for c in names], "html", "template")
    return joined.mapInArrow(_extractor(names), schema)


by_value(__name__)
