"""Element selection in HTML text, as an Arrow-batched UDF.

Spark has no HTML reader, so this is the one place where text is walked in Python.
Call it behind ``mentions`` so that only pages holding the wanted markup leave the JVM.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from jobscape.functions.text import _col

# Ship this module inside the task closure: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# HTML elements without content, and the sibling that ends an open one.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option"},
    "p": {"p", "div", "ul", "dl", "article", "h1", "h2", "h3", "li"},
}
ELEMENTS = "array<struct<rule:int,scope:int,pos:int,tag:string,text:string,attrs:map<string,string>>>"
ARROW_ELEMENTS = pa.list_(
    pa.struct(
        [
            ("rule", pa.int32()), ("scope", pa.int32()), ("pos", pa.int32()), ("tag", pa.string()), ("text", pa.string()),
            ("attrs", pa.map_(pa.string(), pa.string())),
        ]
    )
)
_SIMPLE = re.compile(r'^(\w+)?((?:[.#][\w-]+)*)(?:\[([\w-]+)(?:="([^"]*)")?\])?$')


def _rule(selector: str) -> list[tuple]:
    """``a b[c="d"]`` as a list of (tag, classes, id, attribute, value) tests."""
    steps = []
    for part in selector.split():
        found = _SIMPLE.match(part)
        if not found:
            raise ValueError(f"unsupported selector {part}")
        tag, marks, attr, value = found.groups()
        marks = re.findall(r"([.#])([\w-]+)", marks or "")
        ids = [m for kind, m in marks if kind == "#"]
        steps.append((tag, {m for kind, m in marks if kind == "."}, ids[0] if ids else None, attr, value))
    return steps


def _by_tag(rules: list[list[tuple]]) -> dict[str | None, list]:
    """The numbered rules that can match each tag; under None those for any tag."""
    tags = {steps[-1][0] for steps in rules} | {None}
    return {t: [(i, steps) for i, steps in enumerate(rules) if steps[-1][0] in (t, None)] for t in tags}


def _fits(step: tuple, tag: str, attrs: dict) -> bool:
    want_tag, classes, ident, attr, value = step
    return (
        (want_tag is None or want_tag == tag)
        and (not classes or classes <= set((attrs.get("class") or "").split()))
        and (ident is None or attrs.get("id") == ident)
        and (attr is None or (attr in attrs and (value is None or attrs[attr] == value)))
    )


class _Selector(HTMLParser):
    def __init__(self, rules: dict[str | None, list]):
        super().__init__(convert_charrefs=True)
        self.rules, self.open, self.found, self.seen = rules, [], [], 0
        self.deep = 0

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def handle_starttag(self, tag, attrs):
        while self.open and tag in ENDED_BY.get(self.open[-1]["tag"], ()):
            self._close()
        node = {"tag": tag, "attrs": dict(attrs), "pos": self.seen, "text": [], "hits": []}
        self.seen += 1
        for i, steps in self.rules.get(tag, self.rules[None]):
            scope = self._scope(steps) if _fits(steps[-1], tag, node["attrs"]) else None
            if scope is not None:
                node["hits"].append((i, scope))
        self.deep += bool(node["hits"])
        self.open.append(node)
        if tag in VOID:
            self._close()

    def _scope(self, steps):
        """Position of the nearest enclosing element of the rule, whose last step fits, or None when it misses."""
        scope, rest = -1, len(steps) - 2
        if rest < 0:
            return scope
        for outer in reversed(self.open):
            if _fits(steps[rest], outer["tag"], outer["attrs"]):
                scope = outer["pos"] if scope < 0 else scope
                rest -= 1
                if rest < 0:
                    return scope
        return None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for node in reversed(self.open):
            if node["tag"] == tag:
                while self._close() != tag:
                    pass
                return

    def handle_data(self, data):
        for node in self.open if self.deep else ():
            if node["hits"]:
                node["text"].append(data)

    def _close(self):
        node = self.open.pop()
        self.deep -= bool(node["hits"])
        for rule, scope in node["hits"]:
            self.found.append(
                {
                    "rule": rule,
                    "scope": scope,
                    "pos": node["pos"],
                    "tag": node["tag"],
                    "text": re.sub(r"\s+", " ", "".join(node["text"])).strip(),
                    "attrs": [(k, v or "") for k, v in node["attrs"].items()],
                }
            )
        return node["tag"]

    def result(self):
        while self.open:
            self._close()
        return sorted(self.found, key=lambda e: (e["rule"], e["pos"]))


def html_select(html: Column | str, selectors: list[str]) -> Column:
    """Elements matching any of the selectors, in page order within each selector.

    A selector is a chain of ``tag``, ``.class``, ``#id`` and ``[attr="value"]`` tests
    separated by blanks (descendants). Each element carries the number of its selector,
    the position of the nearest enclosing element the chain named (-1 for none), its own
    position, its text and its attributes.
    """
    rules = _by_tag([_rule(s) for s in selectors])

    @F.arrow_udf(ELEMENTS)
    def select(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            rows = []
            for page in pages.to_pylist():
                parser = _Selector(rules)
                parser.feed(page or "")
                parser.close()
                rows.append(parser.result())
            yield pa.array(rows, ARROW_ELEMENTS)

    # Not deterministic for the optimizer: it would otherwise run the UDF once more for
    # every filter it pushes below it.
    return select.asNondeterministic()(_col(html))


def mentions(html: Column | str, *marks: str) -> Column:
    """True for pages holding any of the marks; a cheap test ahead of ``html_select``."""
    found = F.lit(False)
    for mark in marks:
        found = found | F.contains(_col(html), F.lit(mark))
    return found


def of_rule(elements: Column | str, rule: int) -> Column:
    """The elements one selector matched."""
    return F.filter(_col(elements), lambda e: e["rule"] == rule)


def attribute(element: Column, name: str) -> Column:
    return F.try_element_at(element["attrs"], F.lit(name))
