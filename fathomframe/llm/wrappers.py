"""Main text of web pages by wrappers: union-free expressions inferred from pages of one host."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, written
from .urls import host_and_path

#: Pages, in expectation, that one partial wrapper of a host is inferred from, and partial wrappers aligned at a time.
SHARE = 24
DEEPEST = 48
PERIOD = 3

# Element names of HTML and common names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
IN_HEAD = frozenset("html head meta link title style script base noscript template".split())
DROPPED = frozenset("head nav footer aside form script style textarea title noscript iframe template svg math button select dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
PARTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu "
    "sidebar aside footer header masthead cookie cookies consent gdpr notice notices banner popup modal overlay subscribe "
    "subscription newsletter signup comment comments commentlist disqus respond replies share sharing social related "
    "recommended breadcrumb breadcrumbs widget toolbar pagination pager login".split())
MAIN_TAGS = frozenset(["article", "main"])
MAIN_PARTS = frozenset("article articlebody main content post entry story body".split())

_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")


@dataclass
class Open:
    name: str
    key: str
    out: bool  # within a part that is no article text


def _described(name: str, attributes: str) -> tuple[str, bool]:
    """Key of an element (its name and classes) and whether its attributes name a part to leave out."""
    if not attributes.strip():
        return name, False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    classes = " ".join(found.get("class", "").lower().split())
    words = {w for k in ("class", "id") for part in found.get(k, "").split() for w in _SPLIT.split(part.lower())}
    main = bool(words & {"article", "articlebody", "main", "content"}) or found.get("role", "").lower() == "main" or found.get("itemprop", "").lower() == "articlebody"
    out = (bool(words & PARTS) and not (main and not words & {"comment", "comments", "sidebar", "nav", "footer"})) or found.get("role", "").lower() in ROLES or "hidden" in found
    return name + (f".{classes}" if classes else "") + ("#main" if main else ""), out


def events(page: str | None) -> Iterator[tuple[str, object]]:
    """The token stream with the ends that HTML leaves out: ("open", Open), ("close", Open), ("text", str)."""
    text, at, stack = page or "", 0, []

    def pop() -> tuple[str, Open]:
        return "close", stack.pop()

    while at < len(text):
        m = _TAG.search(text, at)
        if m is None:
            yield "text", text[at:]
            break
        if m.start() > at:
            yield "text", text[at : m.start()]
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name == "br":
                yield "text", " "
            elif any(o.name == name for o in stack):
                while stack[-1].name != name:
                    yield pop()
                yield pop()
            continue
        if name in ("br", "hr", "wbr"):
            yield ("text", " ") if name == "br" else ("rule", None)
            continue
        if name in VOID:
            continue
        ends = CLOSES.get(name, set()) | (set() if name in INLINE or name in RAW else {"p"})
        if name not in IN_HEAD:
            ends = ends | {"head"}
        depth = next((i for i in range(len(stack) - 1, max(-1, len(stack) - 12), -1) if stack[i].name in ends), None)
        barrier = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name in ("ul", "ol", "table", "dl", "article", "section", "div")), -1)
        if depth is not None and (depth > barrier or stack[depth].name in ("p", "head")):
            while len(stack) > depth:
                yield pop()
        key, out = _described(name, m[3])
        inside = bool(stack) and stack[-1].out
        header = name == "header" and not any(o.name == "article" for o in stack)
        item = Open(name, key, inside or out or name in DROPPED or header)
        stack.append(item)
        yield "open", item
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(text, at)
            if close is None and name in ("script", "style", "textarea", "title"):
                at = len(text)
            elif close is not None:
                at = close.end()
            yield pop()
    while stack:
        yield pop()


def blocks(page: str | None) -> list[tuple[tuple[str, ...], bool, str]]:
    """path of block elements, left out, text: white space folded, character references decoded."""
    found: list[tuple[tuple[str, ...], bool, str]] = []
    path: list[str] = []
    held: list[str] = []
    marks: list[bool] = []

    def flush() -> None:
        # a run is one block; inline parts that are left out are cut from it
        kept = " ".join(html.unescape("".join(held)).split())
        if kept:
            found.append((tuple(path[:DEEPEST]), bool(outs[-1]) if outs else False, kept))
        held.clear()

    outs: list[bool] = []
    for kind, item in events(page):
        if kind == "text":
            if not marks or not marks[-1]:
                held.append(item)
        elif kind == "rule":
            flush()
        elif item.name in INLINE:
            if kind == "open":
                marks.append(item.out and not (outs and outs[-1]))
            elif marks:
                marks.pop()
        else:
            flush()
            marks.clear()
            if kind == "open":
                path.append(item.key)
                outs.append(item.out)
            else:
                path.pop()
                outs.pop()
    flush()
    return found


# ---- wrapper inference -------------------------------------------------------------------------------------------


@dataclass
class Node:
    """A part of a wrapper: an element, a group of parts, or text (constant, or None for a slot)."""

    key: str
    children: list[Node] = field(default_factory=list)
    often: str = "1"  # 1, ? optional, + repeated, * both
    out: bool = False
    constant: str | None = None
    mass: int = 0

    def expression(self) -> str:
        if self.key == "#":
            body = re.escape(self.constant) if self.constant is not None else "#"
        elif self.key.startswith("("):
            body = "".join(c.expression() for c in self.children)
        else:
            body = f"<{self.key}>{''.join(c.expression() for c in self.children)}</>"
        return body if self.often == "1" else f"({body}){self.often}"


_OFTEN = {frozenset(x): y for x, y in (("1", "1"), ("?", "?"), ("+", "+"), ("*", "*"), ("1?", "?"), ("1+", "+"), ("1*", "*"), ("?+", "*"), ("?*", "*"), ("+*", "*"))}


def _repeat(node: Node) -> Node:
    node.often = _OFTEN[frozenset((node.often, "+"))]
    return node


def _merged(a: Node, b: Node) -> Node:
    same = a.constant if a.constant == b.constant else None
    return Node(a.key, align(a.children, b.children), _OFTEN[frozenset((a.often, b.often))], a.out or b.out, same, a.mass + b.mass)


def fold(nodes: list[Node]) -> list[Node]:
    """Neighbouring repetitions of one to PERIOD parts become a repeated part or group."""
    for period in range(1, PERIOD + 1):
        out: list[Node] = []
        for node in nodes:
            out.append(node)
            while len(out) >= 2 * period and [x.key for x in out[-period:]] == [x.key for x in out[-2 * period : -period]]:
                both = [_merged(x, y) for x, y in zip(out[-2 * period : -period], out[-period:])]
                out[-2 * period :] = [_repeat(both[0])] if period == 1 else both
                if period > 1:
                    out[-period:] = [_repeat(Node("(" + " ".join(x.key for x in both), both, mass=sum(x.mass for x in both)))]
                    break
            if period > 1 and len(out) > period and out[-period - 1].key == "(" + " ".join(x.key for x in out[-period:]):
                group = out[-period - 1]
                group.children = [_merged(x, y) for x, y in zip(group.children, out[-period:])]
                group.mass += sum(x.mass for x in out[-period:])
                del out[-period:]
        nodes = out
    return nodes


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """Two sibling streams as one: common parts merge, what only one has becomes optional, repetitions fold."""
    a, b = fold(a), fold(b)
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].key == b[j].key else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i].key == b[j].key:
            out.append(_merged(a[i], b[j]))
            i, j = i + 1, j + 1
        else:
            left = j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1])
            node = a[i] if left else b[j]
            node.often = _OFTEN[frozenset((node.often, "?"))]
            out.append(node)
            i, j = i + left, j + (not left)
    return fold(out)


def page_tree(page: str | None) -> list[Node]:
    """A page's token stream as nested parts, inline marks left out."""
    top: list[Node] = []
    levels: list[list[Node]] = [top]
    for kind, item in events(page):
        if kind == "text":
            text = " ".join(html.unescape(item).split())
            if text:
                if levels[-1] and levels[-1][-1].key == "#":
                    last = levels[-1][-1]
                    last.constant, last.mass = f"{last.constant} {text}", last.mass + len(text)
                else:
                    levels[-1].append(Node("#", constant=text, mass=len(text)))
        elif kind != "rule" and item.name not in INLINE:
            if kind == "open":
                node = Node(item.key, out=item.out)
                levels[-1].append(node)
                levels.append(node.children if len(levels) < DEEPEST else levels[-1])
            else:
                levels.pop()
    return top


def infer(pages: list[str | None]) -> list[Node]:
    """The wrapper of some pages: the first one's stream, generalised by each other one in turn."""
    wrapper: list[Node] = []
    for i, page in enumerate(pages):
        tree = page_tree(page)
        wrapper = align(wrapper, tree) if i else fold(tree)
    return wrapper


def combine(wrappers: list[list[Node]]) -> list[Node]:
    """One wrapper of several: the first one generalised by each other one in turn."""
    whole = wrappers[0]
    for other in wrappers[1:]:
        whole = align(whole, other)
    return whole


def packed(wrapper: list[Node]) -> str:
    def lists(nodes: list[Node]) -> list:
        return [[n.key, lists(n.children), n.often, n.out, n.constant, n.mass] for n in nodes]

    return json.dumps(lists(wrapper))


def unpacked(text: str) -> list[Node]:
    def nodes(lists: list) -> list[Node]:
        return [Node(key, nodes(children), *rest) for key, children, *rest in lists]

    return nodes(json.loads(text))


def slots(wrapper: list[Node]) -> list[tuple[tuple[str, ...], bool, int]]:
    """path, left out and text seen of all text parts of a wrapper."""
    found, todo = [], [(n, (), False) for n in reversed(wrapper)]
    while todo:
        node, path, out = todo.pop()
        if node.key == "#":
            found.append((path, out, node.mass))
            continue
        inner = path if node.key.startswith("(") else (*path, node.key)
        todo += [(c, inner, out or node.out) for c in reversed(node.children)]
    return found


def regions(parts: list[tuple[tuple[str, ...], bool, int]]) -> list[tuple[str, ...]]:
    """The paths of the elements that hold articles, the one with the most text first: all article or main
    elements, one per template, or else the one element with the most text in its own blocks."""
    named: dict[tuple[str, ...], int] = {}
    plain: dict[tuple[str, ...], int] = {}
    for path, out, mass in parts:
        if out:
            continue
        at = next((i for i, k in enumerate(path) if k.split(".")[0].split("#")[0] == "article"), None)
        if at is None:
            at = next((i for i, k in enumerate(path) if k.split(".")[0].split("#")[0] in MAIN_TAGS or k.endswith("#main")), None)
        if at is not None:
            named[path[: at + 1]] = named.get(path[: at + 1], 0) + mass
        parent = path[:-1] if path else path
        plain[parent] = plain.get(parent, 0) + mass
    if named:
        return sorted(named, key=lambda p: (named[p], p), reverse=True)
    return [max(plain, key=lambda p: (plain[p], p))] if plain else []


def main_region(parts: list[tuple[tuple[str, ...], bool, int]]) -> tuple[str, ...]:
    """The path of the element that holds the article: the first of regions()."""
    return next(iter(regions(parts)), ())


def article(page: str | None, candidates: list[tuple[str, ...]] | None) -> str:
    """The blocks below the first of the wrapper's regions that the page has; a page that has none is judged by
    its own stream."""
    own = blocks(page)
    region = next((r for r in candidates or [] if r and any(p[: len(r)] == r and not out for p, out, _ in own)), None)
    if region is None:
        region = main_region([(p, out, len(t)) for p, out, t in own])
    return "\n\n".join(t for p, out, t in own if not out and p[: len(region)] == region)


def host_wrappers(pages: DataFrame, url: str = "url", page: str = "html", share: int = SHARE) -> DataFrame:
    """host, regions, wrapper: inferred from all pages of each host.

    Shares of about ``share`` pages, dealt by a hash of url and page, give partial wrappers; as many of these at a
    time are aligned, level by level, so a host with a third of all pages never meets in one task.
    """
    rows = pages.select(host_and_path(F.col(url))[0].alias("host"), F.xxhash64(url, page).alias("_h"), F.col(page).alias("html")).where("host IS NOT NULL")
    counts = written(rows.groupBy("host").agg(F.ceil(F.count("*") / share).alias("_shares")), "hosts")
    dealt = rows.join(F.broadcast(counts) if few(counts) else counts, "host").select(
        "host", "_h", "html", F.pmod("_h", "_shares").alias("_share"))
    schema = "host string, _share long, partial string"

    def start(group: pd.DataFrame) -> pd.DataFrame:
        wrapper = infer(list(group.sort_values("_h")["html"]))
        return pd.DataFrame({"host": group["host"].iloc[:1], "_share": group["_share"].iloc[:1] // share, "partial": [packed(wrapper)]})

    def level(group: pd.DataFrame) -> pd.DataFrame:
        wrapper = combine([unpacked(x) for x in sorted(group["partial"])])
        return pd.DataFrame({"host": group["host"].iloc[:1], "_share": group["_share"].iloc[:1] // share, "partial": [packed(wrapper)]})

    most = counts.agg(F.max("_shares")).first()[0] or 0
    partial = written(dealt.groupBy("host", "_share").applyInPandas(start, schema), "partial-wrappers")
    while most > 1:
        partial = written(partial.groupBy("host", "_share").applyInPandas(level, schema), "partial-wrappers")
        most = -(-most // share)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = [unpacked(x) for x in batch["partial"]]
            yield pd.DataFrame({
                "host": batch["host"], "regions": [[list(r) for r in regions(slots(w))] for w in whole],
                "wrapper": ["".join(n.expression() for n in w) for w in whole]})

    return partial.mapInPandas(finish, "host string, regions array<array<string>>, wrapper string")


def extract(pages: DataFrame, url: str = "url", page: str = "html", share: int = SHARE) -> DataFrame:
    """pages with text and n_chars: the article's blocks, joined by an empty line.

    A null or empty page has an empty text. Pages that their host's wrapper does not fit are judged by their own
    token stream. Other columns pass; text and n_chars are replaced.
    """
    wrappers = written(host_wrappers(pages, url, page, share).select(F.col("host").alias("_host"), F.col("regions").alias("_regions")), "wrappers")
    met = pages.withColumn("_of", host_and_path(F.col(url))[0]).join(
        F.broadcast(wrappers) if few(wrappers) else wrappers, F.col("_of") == F.col("_host"), "left")

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for bodies, found in batches:
            yield pd.Series([article(b, [tuple(x) for x in r] if r is not None else None) for b, r in zip(bodies, found)], dtype=object)

    out = met.withColumn("text", F.pandas_udf(run, "string")(F.col(page), F.col("_regions")))
    return out.withColumn("n_chars", F.length("text").cast("long")).drop("_of", "_host", "_regions")
