"""Configured selectors over pages, as a vectorised function.

The selector kinds the extraction rules use: child and descendant steps, `*`,
``text()``, ``@attr``, unions, and the predicates ``[n]``, ``[last()]``,
``[position()>n]``, ``[@a="v"]``, ``[starts-with(@a,"v")]``, ``[contains(@a,"v")]``.
Fixed selectors are better said as patterns (`millrace.functions.markup`), which stay
inside the JVM.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from millrace.functions.text import col

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)


STRAY_AMPERSAND = re.compile(r"&(?!#?\w+;)")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


class PageTree(HTMLParser):
    """A tree of nodes and text; open elements are closed as browsers do."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        # Only terminated references are decoded; any other ampersand is text.
        self.feed(STRAY_AMPERSAND.sub("&amp;", html))
        self.close()

    def _close(self, tag: str, within: frozenset[str] = frozenset()) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in within:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH:
            self._close("p", frozenset(("div", "article", "section", "li", "td", "body")))
        if tag == "li":
            self._close("li", frozenset(("ul", "ol")))
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._close(tag)

    def handle_data(self, data):
        here = self.open[-1].children
        if here and isinstance(here[-1], str):
            here[-1] += data
        else:
            here.append(data)


STEP = re.compile(r"(//?|^)([\w*-]+\(\)|@[\w-]+|[\w*-]+)((?:\[[^\]]*\])*)")
PREDICATE = re.compile(
    r"""\[(?:(\d+)|(last\(\))|position\(\)>(\d+)|@([\w-]+)="([^"]*)"|"""
    r"""(starts-with|contains)\(@([\w-]+),\s*"([^"]*)"\))\]"""
)


def _keep(nodes: list, predicate: tuple[str, ...]) -> list:
    nth, last, after, attr, value, test, test_attr, part = predicate
    if nth:
        return nodes[int(nth) - 1: int(nth)]
    if last:
        return nodes[-1:]
    if after:
        return nodes[int(after):]
    if attr:
        return [n for n in nodes if n.attrs.get(attr) == value]
    holds = str.startswith if test == "starts-with" else str.__contains__
    return [n for n in nodes if holds(n.attrs.get(test_attr, ""), part)]


@lru_cache(maxsize=4096)
def compile_selector(selector: str) -> tuple:
    """Union parts, each a tuple of steps (descend, name, predicates)."""
    parts = []
    for path in filter(None, (p.strip() for p in selector.split("|"))):
        steps = [
            (axis == "//", name, tuple(PREDICATE.findall(tests))) for axis, name, tests in STEP.findall(path)
        ]
        if "".join(m.group(0) for m in STEP.finditer(path)) != path or any(
            len(PREDICATE.findall(t)) != t.count("[") for _, _, t in STEP.findall(path)
        ):
            raise ValueError(f"selector kind not supported: {selector}")
        parts.append(tuple(steps))
    return tuple(parts)


def _inside(node: Node):
    stack = [node]
    while stack:
        here = stack.pop()
        yield here
        stack.extend(c for c in reversed(here.children) if isinstance(c, Node))


def _step(nodes: list[Node], step: tuple) -> list:
    descend, name, predicates = step
    found, seen = [], set()
    for start in nodes:
        for node in _inside(start) if descend else (start,):
            if id(node) in seen:
                continue
            seen.add(id(node))
            if name == "text()":
                found.extend(c for c in node.children if isinstance(c, str))
            elif name.startswith("@"):
                if name[1:] in node.attrs:
                    found.append(node.attrs[name[1:]])
            else:
                hits = [c for c in node.children if isinstance(c, Node) and name in ("*", c.tag)]
                for predicate in predicates:
                    hits = _keep(hits, predicate)
                found.extend(hits)
    return found


def select_texts(root: Node, selector: str) -> list[str]:
    """Texts and attribute values a selector finds, in page order per union part."""
    result = []
    for steps in compile_selector(selector):
        nodes = [root]
        for step in steps:
            nodes = _step(nodes, step)
        result.extend(n for n in nodes if isinstance(n, str))
    return result


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def _select(html: pd.Series, selectors: pd.Series) -> pd.Series:
    def one(page, wanted):
        if page is None:
            return [[] for _ in wanted]
        root = PageTree(page).root
        return [select_texts(root, s) if s else [] for s in wanted]

    return pd.Series([one(page, wanted) for page, wanted in zip(html, selectors)])


def select_fields(html: Column | str, selectors: Column) -> Column:
    """Texts found by each selector of an array; every page is parsed once."""
    return _select(col(html), selectors)


def select_field(html: Column | str, selector: Column | str) -> Column:
    """Texts found by one selector, given as text or as a column."""
    selector = F.lit(selector) if isinstance(selector, str) else selector
    return F.get(_select(col(html), F.array(selector)), 0)
