"""Main text of web pages by wrappers: union-free regular expressions, one a host.

Pages of a host come from the same templates. Their streams of tags and texts are
aligned one after the other: what repeats side by side becomes a repeated group, what
one page lacks an optional part, and texts that differ become slots; texts that the
pages share are the template's. The result is a wrapper. It tells which container the
host fills with text and which texts are fixed, and so what to take from every page.

All different pages of a host are aligned, each whole. A task aligns the pages it reads
into one partial wrapper a host; partial wrappers are aligned with each other in rounds
of at most about `FAN_IN`, so that no host meets in one task. A wrapper counts the
pages of each node and keeps the text that most of them have there (a majority vote that
can be merged), so its size follows the variety of the templates, not the number of pages.

The container is where the slots' text is. Elements, roles and names that are customary
for menus, adverts or comments tell other parts inside it, and outside it only as long
as they leave a quarter of the host's text: a whole article in such a container is found.
"""

from __future__ import annotations

import html as markup
import json
import pickle
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text import stored, text_of

BROADCAST_LOTS = 1_000_000  # 8 MB of keys
LEAST_PAGES = 6  # so many different pages must share a text before it counts as the template's
LONGEST_GROUP = 12  # tokens of a repeated group
FAN_IN = 16  # partial wrappers of a host that one task aligns
LONGEST_WRAPPER = 4000  # nodes; beyond them the rarest parts keep only their weight of text
HELD_NODES = 400_000  # of all wrappers that a task holds before it hands them on
CELLS = 250_000  # of an alignment; longer streams are first cut at tokens that both hold once

ATTRIBUTES = r"""(?:"[^"]*"|'[^']*'|[^'">])*"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style)\b{ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<skip>title|textarea|noscript|template|iframe|svg|select|object|button|datalist)\b{ATTRIBUTES}>.*?</(?P=skip)\s*>"
    r"|<[!?][^>]*>"
    rf"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>{ATTRIBUTES})>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Fixed lists: what HTML elements, roles and customary names mean.
CONTAINERS = frozenset(
    "html body article main section div nav header footer aside form ul ol dl table figure fieldset details dialog menu".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav footer aside form menu dialog head".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe subscription signup login comment comments commentlist respond disqus discussion reply replies share sharing "
    "social related recommended recommendations trending pagination pager widget toolbar skip".split()
)
TEXT_NAMES = frozenset("article content post entry story main body text".split())


@dataclass(frozen=True)
class Place:
    """Where a text stands: containers around it, and at which depths one is customarily no part of an article."""

    path: tuple[str, ...] = ()
    marks: tuple[int, ...] = ()

    def outside(self, depth: int = 0) -> bool:
        """Whether a container below that depth is no part of an article."""
        return bool(self.marks) and self.marks[-1] > depth


@dataclass
class Piece:
    text: str
    place: Place
    link: bool
    block: int


def attributes(raw: str) -> tuple[list[str], str, bool]:
    """Words of class and id, the role, and whether the element is hidden."""
    names, role, hidden = [], "", False
    for key, value in ATTRIBUTE.findall(raw):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            names += [w.lower() for w in NAME.findall(value)]
        elif key == "role":
            role = value.lower()
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
    return names, role, hidden


def pieces(page: str) -> tuple[list[Piece], list[str]]:
    """Texts of a page with their places, and the stream of tags and texts (texts as '')."""
    found: list[Piece] = []
    stream: list[str] = []
    stack: list[tuple[str, Place]] = []
    place, links, block, at = Place(), 0, 0, 0

    def text(raw: str) -> None:
        if raw:
            plain = markup.unescape(raw) if "&" in raw else raw
            found.append(Piece(plain, place, links > 0, block))
            if not plain.isspace():
                stream.append("")

    for m in TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name not in INLINE:
            block += 1
        if m["close"]:
            links -= name == "a" and links > 0
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    place = stack[-1][1] if stack else Place()
                    break
            stream.append("/" + name)
            continue
        links += name == "a"
        raw = m["attributes"]
        names, role, hidden = attributes(raw) if raw.strip(" /") else ([], "", False)
        label = name + "".join(f".{n}" for n in names if not n.isdigit())
        stream.append(label)
        if name in VOID or raw.endswith("/"):
            continue
        if name in CONTAINERS or hidden or names and OUTSIDE_NAMES.intersection(names):
            outside = hidden or name in OUTSIDE or role in OUTSIDE_ROLES
            if name not in ("html", "body"):
                outside = outside or bool(OUTSIDE_NAMES.intersection(names))
            # A header belongs to the page, unless it stands in an article.
            if name == "header" and not {"article", "main"} & {p.split(".")[0] for p in place.path}:
                outside = True
            depth = len(place.path) + 1
            place = Place((*place.path, label), (*place.marks, depth) if outside else place.marks)
            stack.append((name, place))
    text(page[at:])
    return found, stream


# Inference


@dataclass
class Node:
    """Part of a wrapper: a tag, a text (fixed, or a slot) or a repeated group.

    `common` is the text that a majority of the pages have here, if there is one, and `same`
    the margin of its votes: a text on nine pages of ten has a margin of at least 0.8.
    """

    key: object
    common: str | None = None
    group: list[Node] = field(default_factory=list)
    optional: bool = False
    chars: int = 0
    place: Place | None = None
    pages: int = 1
    same: int = 1

    @property
    def text(self) -> str | None:
        return self.common if 5 * self.same >= 4 * self.pages else None

    @property
    def label(self) -> object:
        """What an alignment compares: texts only match inside the same containers."""
        return ("", self.place.path) if self.place else self.key


@dataclass
class Wrapper:
    """`loose` is the text of parts that were too rare to keep, by container."""

    nodes: list[Node]
    pages: int = 1
    loose: dict[Place, int] = field(default_factory=dict)


def nodes_of(page: str) -> list[Node]:
    found, stream = pieces(page)
    texts = iter(p for p in found if not p.text.isspace())
    nodes = []
    for token in stream:
        if token:
            nodes.append(Node(token))
        else:
            piece = next(texts)
            value = " ".join(piece.text.split())
            nodes.append(Node("", value, chars=0 if piece.link else len(value), place=piece.place))
    return nodes


def merged(one: Node, other: Node, one_page: bool = False) -> Node:
    """Two nodes with the same key, of different pages or of one."""
    group = [merged(a, b, one_page) for a, b in zip(one.group, other.group, strict=True)]
    common, same = one.common, one.same
    if one.common == other.common:
        same = max(one.same, other.same) if one_page else one.same + other.same
    elif one_page:
        common, same = None, 0
    else:  # a majority outlives all pairs of different votes
        common, same = (one.common if one.same >= other.same else other.common), abs(one.same - other.same)
    pages = max(one.pages, other.pages) if one_page else one.pages + other.pages
    return Node(one.key, common, group, one.optional or other.optional, one.chars + other.chars, one.place, pages, same)


def groups_in(nodes: list[Node]) -> set[tuple]:
    return {n.key[1:] for n in nodes if isinstance(n.key, tuple)}


def folded(nodes: list[Node], known: set[tuple] = frozenset()) -> list[Node]:
    """Groups that repeat side by side, or that repeat elsewhere, as one node each."""
    begins = {(len(unit), unit[0]) for unit in known}
    for size in range(2, LONGEST_GROUP + 1):
        keys = [n.label for n in nodes]
        done, at = [], 0
        while at < len(nodes):
            first = keys[at]
            times = 0
            if isinstance(first, str) and first and first[0] != "/" and at + size <= len(keys):
                again = at + size < len(keys) and keys[at + size] == first
                if again or (size, first) in begins:
                    unit = keys[at : at + size]
                    times = 1
                    while keys[at + times * size : at + (times + 1) * size] == unit:
                        times += 1
            if times > 1 or times == 1 and tuple(unit) in known:
                group = nodes[at : at + size]
                for i in range(1, times):
                    more = nodes[at + i * size : at + (i + 1) * size]
                    group = [merged(a, b, one_page=True) for a, b in zip(group, more, strict=True)]
                done.append(Node(("repeat", *unit), group=group, pages=max(n.pages for n in group)))
                at += times * size
            else:
                done.append(nodes[at])
                at += 1
        nodes = done
    return nodes


def matched(one: list[object], other: list[object]) -> list[tuple[int, int]]:
    """Places of the keys that are aligned with each other, in order."""
    head = 0
    while head < min(len(one), len(other)) and one[head] == other[head]:
        head += 1
    tail = 0
    while tail < min(len(one), len(other)) - head and one[-1 - tail] == other[-1 - tail]:
        tail += 1
    ends = len(one) - tail, len(other) - tail
    found = [(i, i) for i in range(head)]
    a, b = one[head : ends[0]], other[head : ends[1]]
    if a and b:
        if len(a) * len(b) <= CELLS:
            matcher = SequenceMatcher(None, a, b, autojunk=False)
            inner = [(m.a + i, m.b + i) for m in matcher.get_matching_blocks() for i in range(m.size)]
        else:
            inner = _anchored(a, b)
        found += [(i + head, j + head) for i, j in inner]
    return found + [(ends[0] + i, ends[1] + i) for i in range(tail)]


def _anchored(one: list[object], other: list[object]) -> list[tuple[int, int]]:
    """Long streams: the longest ascending chain of keys that each holds once, and what lies between."""
    counts, others = Counter(one), Counter(other)
    places = {k: j for j, k in enumerate(other) if others[k] == 1}
    both = [(i, places[k]) for i, k in enumerate(one) if counts[k] == 1 and k in places]
    if not both:
        return []
    lasts, chains, before = [], [], {}
    for pair in both:
        at = bisect_left(lasts, pair[1])
        before[pair] = chains[at - 1] if at else None
        lasts[at : at + 1], chains[at : at + 1] = [pair[1]], [pair]
    chain, pair = [], chains[-1]
    while pair:
        chain.append(pair)
        pair = before[pair]
    found, from_one, from_other = [], 0, 0
    for i, j in [*reversed(chain), (len(one), len(other))]:
        between = matched(one[from_one:i], other[from_other:j])
        found += [(a + from_one, b + from_other) for a, b in between]
        if i < len(one):
            found.append((i, j))
        from_one, from_other = i + 1, j + 1
    return found


def aligned(wrapper: list[Node], page: list[Node]) -> list[Node]:
    """The wrapper generalised to match the page (or the other wrapper), too."""
    if [n.label for n in wrapper] != [n.label for n in page]:
        known = groups_in(wrapper) | groups_in(page)
        wrapper, page = folded(wrapper, known), folded(page, known)
    result: list[Node] = []
    a = b = 0
    for i, j in [*matched([n.label for n in wrapper], [n.label for n in page]), (len(wrapper), len(page))]:
        for node in (*wrapper[a:i], *page[b:j]):  # a mismatch: either side may be missing
            node.optional = True
            result.append(node)
        if i < len(wrapper):
            result.append(merged(wrapper[i], page[j]))
        a, b = i + 1, j + 1
    return result


def joined(one: Wrapper, other: Wrapper) -> Wrapper:
    loose = dict(one.loose)
    for place, chars in other.loose.items():
        loose[place] = loose.get(place, 0) + chars
    return _bounded(Wrapper(aligned(one.nodes, other.nodes), one.pages + other.pages, loose))


def _bounded(wrapper: Wrapper) -> Wrapper:
    """Beyond its longest size a wrapper loses its rarest parts; their weight of text stays."""
    if len(wrapper.nodes) > LONGEST_WRAPPER:
        order = sorted(range(len(wrapper.nodes)), key=lambda i: (-wrapper.nodes[i].pages, i))
        rare = set(order[LONGEST_WRAPPER // 2 :])
        for i in rare:
            for node, _ in texts_in([wrapper.nodes[i]]):
                wrapper.loose[node.place] = wrapper.loose.get(node.place, 0) + node.chars
        wrapper.nodes = [n for i, n in enumerate(wrapper.nodes) if i not in rare]
        for n in wrapper.nodes:  # the neighbours are no longer all there
            n.optional = True
    while len(wrapper.loose) > LONGEST_WRAPPER:  # the text of rare containers counts for the ones around them
        rolled: dict[Place, int] = {}
        deepest = max(len(p.path) for p in wrapper.loose)
        for place, chars in wrapper.loose.items():
            if len(place.path) == deepest:
                place = Place(place.path[:-1], tuple(m for m in place.marks if m < deepest))
            rolled[place] = rolled.get(place, 0) + chars
        wrapper.loose = rolled
    return wrapper


def wrapped(page: str) -> Wrapper:
    return _bounded(Wrapper(folded(nodes_of(page))))


def wrapper_of(pages: list[str]) -> list[Node]:
    different = [wrapped(p) for p in dict.fromkeys(pages)]
    wrapper = different[0]
    for page in different[1:]:
        wrapper = joined(wrapper, page)
    return wrapper.nodes


def texts_in(nodes: list[Node], repeated: bool = False) -> Iterator[tuple[Node, bool]]:
    for n in nodes:
        if n.group:
            yield from texts_in(n.group, True)
        elif n.key == "":
            yield n, repeated


def compiled(wrapper: Wrapper) -> dict:
    """What a wrapper says about its host: the container of the text, and fixed texts."""
    slots, fixed, filled = dict(wrapper.loose), [], {}
    texts = list(texts_in(wrapper.nodes))
    for node, _ in texts:
        filled[node.place.path] = max(node.pages, filled.get(node.place.path, 0))
    for node, repeated in texts:
        # A part that at least half of the pages with its container have, on six pages or more.
        usual = node.pages >= LEAST_PAGES and 2 * node.pages >= filled[node.place.path]
        if node.text is not None and usual and not repeated:
            fixed.append(["/".join(node.place.path), node.text])
        else:
            slots[node.place] = slots.get(node.place, 0) + node.chars
    return {"text": "/".join(container(slots)), "fixed": fixed}


def container(slots: dict[Place, int]) -> tuple[str, ...]:
    """The container that holds the text of these places."""
    # Names that leave less than a quarter of the text are wrong about this host.
    inside = {p: n for p, n in slots.items() if not p.outside()}
    trusted = inside if 4 * sum(inside.values()) >= sum(slots.values()) else slots
    weight: dict[tuple[str, ...], int] = {}
    for place, chars in trusted.items():
        for depth in range(len(place.path) + 1):
            path = place.path[:depth]
            weight[path] = weight.get(path, 0) + chars
    return main_path(weight)


def main_path(weight: dict[tuple[str, ...], int]) -> tuple[str, ...]:
    """The container of at least half the text that is named for it, else the innermost with three quarters."""
    if not weight:
        return ()

    def best(paths: list[tuple[str, ...]]) -> tuple[str, ...]:
        return max(paths, key=lambda p: (weight[p], -len(p), p), default=())

    total = weight.get((), 0)
    for named in (
        [p for p in weight if p and p[-1].split(".")[0] == "article"],
        [p for p in weight if p and p[-1].split(".")[0] == "main"],
        [p for p in weight if p and TEXT_NAMES & set(p[-1].split(".")[1:])],
    ):
        path = best(named)
        if path and 2 * weight[path] >= total:
            return path
    return max((p for p in weight if 4 * weight[p] >= 3 * total), key=lambda p: (len(p), weight[p], p), default=())


# Extraction


def extracted(page: str, host: dict | None) -> str:
    """The main text: blocks in page order, white space inside them as single spaces."""
    found, _ = pieces(page)

    def inside(path: tuple[str, ...]) -> list[Piece]:
        return [p for p in found if p.place.path[: len(path)] == path and not p.place.outside(len(path))]

    path = tuple(filter(None, host["text"].split("/"))) if host else ()
    own = inside(path)
    if not path or not any(not p.text.isspace() for p in own):
        # The page is none of the host's usual ones: it is judged by itself.
        slots: dict[Place, int] = {}
        for p in found:
            if not p.link:
                slots[p.place] = slots.get(p.place, 0) + len(p.text.strip())
        own = inside(container(slots))
    fixed = {(a, b) for a, b in host["fixed"]} if host else set()
    blocks: dict[int, list[str]] = {}
    for p in own:
        if fixed and ("/".join(p.place.path), " ".join(p.text.split())) in fixed:
            continue
        blocks.setdefault(p.block, []).append(p.text)
    return " ".join(" ".join("".join(b).split()) for b in blocks.values() if not "".join(b).isspace())


PARTIAL = "host string, part binary, pages bigint"


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial wrapper of every host that a task meets (more if they outgrow its memory)."""
    held: dict[str, Wrapper] = {}
    size = 0
    for batch in batches:
        for host, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            known = held.get(host)
            held[host] = joined(known, wrapped(html)) if known else wrapped(html)
            size += len(held[host].nodes) - (len(known.nodes) if known else 0)
            if size > HELD_NODES:
                yield _rows(held)
                held, size = {}, 0
    yield _rows(held)


def _merged_group(rows: pa.Table) -> pa.Table:
    whole = None
    for part in sorted(rows.column("part").to_pylist()):
        part = pickle.loads(part)
        whole = joined(whole, part) if whole else part
    return pa.Table.from_batches([_rows({rows.column("host")[0].as_py(): whole})])


def _rows(held: dict[str, Wrapper]) -> pa.RecordBatch:
    parts = [pa.array(list(held), pa.string()), pa.array([pickle.dumps(w) for w in held.values()], pa.binary())]
    return pa.RecordBatch.from_arrays([*parts, pa.array([w.pages for w in held.values()], pa.int64())], names=["host", "part", "pages"])


def _compiled(parts: pa.Array) -> pa.Array:
    return pa.array([json.dumps(compiled(pickle.loads(p))) for p in parts.to_pylist()], pa.string())


_read: dict[str, dict] = {}


def _wrapper(text: str | None) -> dict | None:
    if text is None:
        return None
    if text not in _read:
        if len(_read) > 1000:
            _read.clear()
        _read[text] = json.loads(text)
    return _read[text]


def _extracted(pages: pa.Array, wrappers: pa.Array) -> pa.Array:
    both = zip(pages.to_pylist(), wrappers.to_pylist(), strict=True)
    return pa.array([extracted(page or "", _wrapper(w)) for page, w in both], pa.string())


def different(pages: DataFrame) -> DataFrame:
    """host, html of every different page; the html moves only where a host has copies."""
    rows = pages.select("host", "html", F.xxhash64("host", "html").alias("rank"))
    lots = rows.groupBy("rank").agg(F.count("*").alias("n")).where("n > 1")
    copied = stored(lots.select(F.col("rank").alias("lot")), "copied")
    # A checked size decides; beyond it both sides are shuffled.
    few = F.broadcast(copied) if copied.count() <= BROADCAST_LOTS else copied
    same = F.col("rank") == F.col("lot")
    once = rows.join(few, same, "left_semi").groupBy("host", "rank").agg(F.min("html").alias("html"))
    return rows.join(few, same, "left_anti").select("host", "html").unionByName(once.select("host", "html"))


def wrappers(pages: DataFrame) -> DataFrame:
    """(of_host, wrapper) from all different pages of each host."""
    parts = stored(different(pages).mapInArrow(_partials, PARTIAL), "partial")
    while True:
        counts = stored(parts.groupBy(F.col("host").alias("of_host")).agg(F.count("*").alias("n")), "counts")
        if counts.where("n > 1").isEmpty():
            break
        lot = F.pmod(F.xxhash64("part"), F.ceil(F.col("n") / FAN_IN)).alias("lot")
        placed = parts.join(counts, F.col("host") == F.col("of_host")).select("host", "part", "pages", lot)
        parts = stored(placed.groupBy("host", "lot").applyInArrow(_merged_group, PARTIAL), "partial")
    compile_one = F.arrow_udf(_compiled, "string")
    return parts.select(F.col("host").alias("of_host"), compile_one("part").alias("wrapper"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    A null html is an empty page, whose text is empty. Pages without a url, or with one
    that names no host, form one host together. Repeated rows stay repeated, an empty
    table gives no rows, other columns are ignored.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", text_of(F.col("html")).alias("html"), host.alias("host"))
    known = stored(wrappers(rows), "wrappers")
    read = F.arrow_udf(_extracted, "string")
    joined = rows.join(known, F.col("host") == F.col("of_host"), "left")
    found = joined.select("page_id", "url", read("html", "wrapper").alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
