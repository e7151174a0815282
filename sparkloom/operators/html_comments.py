"""Comments of a web page: comment blocks, their author, text and replies.

The page becomes a small tree; blocks are found in comment sectors by class and
tag, author and text by the earliest of the usual places, replies level by level.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

# Classes of comment sectors, blocks, authors, texts and replies.
SECTOR = re.compile("comment")
BLOCK = re.compile("comment|thread|body", re.I)
AUTHOR = re.compile("author|user", re.I)
BODY = re.compile("comment-content|comment-text|commentbody|comment-entry|commententry", re.I)
REPLY = re.compile("child|reply|replies", re.I)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass(eq=False)
class Node:
    tag: str
    classes: str = ""
    parent: "Node | None" = None
    children: list = field(default_factory=list)  # nodes and strings

    def walk(self) -> Iterator["Node"]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self) -> str:
        out, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in ("script", "style"):
                stack += reversed(x.children)
        return " ".join(" ".join(out).split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html")

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs).get("class") or "", self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def visible_text(html: str) -> str:
    return parse(html).text()


def outermost(root: Node, match) -> list[Node]:
    """Matches below ``root`` that lie in no other match."""
    out, stack = [], [c for c in reversed(root.children) if isinstance(c, Node)]
    while stack:
        node = stack.pop()
        if match(node):
            out.append(node)
        else:
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def _is_block(n: Node) -> bool:
    return n.tag == "li" or n.tag == "div" and bool(BLOCK.search(n.classes))


def _earliest(block: Node, rules) -> str:
    whole, best = block.text(), None
    for rule in rules:
        first = next((n for n in block.walk() if rule(n)), None)
        found = first.text() if first is not None else ""
        at = whole.find(found) if found else -1
        if at >= 0 and (best is None or at < best[0]):
            best = at, found
    return best[1] if best else ""


def author(block: Node) -> str:
    named = lambda tag: lambda n: n.tag == tag and ("fn" in n.classes.split() or bool(AUTHOR.search(n.classes)))
    return _earliest(block, [lambda n: n.tag == "cite", *[named(t) for t in ("div", "p", "span", "h4")], lambda n: n.tag == "strong"])


def body(block: Node) -> str:
    classed = lambda tag: lambda n: n.tag == tag and bool(BODY.search(n.classes))
    return _earliest(block, [classed("div"), classed("p"), lambda n: n.tag == "p", lambda n: n.tag == "blockquote"])


def _full(n: Node) -> bool:
    return bool(author(n)) and bool(body(n))


def blocks(sector: Node) -> list[Node]:
    """Comment blocks of a sector, those with author and text.

    Blocks that have a sibling of their tag and first class count, of all
    parents; where a level has fewer than two of them, those inside each of
    its blocks, if these are two or more together.  Else any block counts.
    """
    todo, found = [sector], []
    while todo:
        inner: list[Node] = []
        for level in todo:
            blocks_here = outermost(level, _is_block)
            groups: dict[tuple, list[Node]] = {}
            for n in blocks_here:
                groups.setdefault((id(n.parent), n.tag, (n.classes.split() or [""])[0]), []).append(n)
            good = [n for group in groups.values() if len(group) >= 2 for n in group if _full(n)]
            if len(good) >= 2:
                found += good
            else:
                inner += blocks_here
        todo = inner
    if len(found) >= 2:
        return found
    todo = [sector]
    while todo:
        level = [n for s in todo for n in outermost(s, _is_block)]
        if good := [n for n in level if _full(n)]:
            return good
        todo = level
    return []


def comments(html: str) -> list[tuple[str, str, str, int, str]]:
    """(path, user, text, depth, reply to) of every comment; the top level has depth 1.

    A reply is the outermost element inside a comment that is marked as one and
    has author and text; it is a comment of its own, one level deeper.
    """
    out: list[tuple[str, str, str, int, str]] = []
    taken: set[int] = set()
    is_reply = lambda n: n.tag == "li" or n.tag == "div" and bool(REPLY.search(n.classes))
    sectors = outermost(parse(html), lambda n: n.tag in ("ol", "ul") or n.tag == "div" and bool(SECTOR.search(n.classes)))
    todo = [(n, f"{k}/{i}", 1, "") for k, sector in enumerate(sectors) for i, n in enumerate(blocks(sector))][::-1]
    while todo:
        block, path, depth, reply_to = todo.pop()
        if id(block) in taken:
            continue
        taken.add(id(block))
        user = author(block)
        out.append((path, user, body(block), depth, reply_to))
        todo += [(n, f"{path}/{i}", depth + 1, user) for i, n in enumerate(x for x in outermost(block, is_reply) if _full(x))][::-1]
    return out


def extract(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(row_key, page, user, text, depth, reply_to) of all comments; the key is a hash of page and place."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(hashlib.sha256(f"{k}|{p}".encode()).hexdigest(), str(k), u, t, d, r) for k, h in zip(frame["k"], frame["h"], strict=True) for p, u, t, d, r in comments(h)]
            yield pd.DataFrame(rows, columns=["row_key", "page", "user", "text", "depth", "reply_to"])

    return pages.selectExpr(f"cast(`{key}` as string) k", f"`{html}` h").mapInPandas(each, "row_key string, page string, user string, text string, depth int, reply_to string")


def extract_text(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, text): the visible text of every page."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({key: frame[key], "text": [visible_text(h) for h in frame[html]]})

    return pages.select(key, html).mapInPandas(each, f"{key} {pages.schema[key].dataType.simpleString()}, text string")
