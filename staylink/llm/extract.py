"""Main-text extraction by wrapper induction.

A page is parsed into a tree of labelled elements; neighbouring siblings of one
label are one repeated node.  The trees of a host's pages are aligned by simple
tree matching (the largest order-preserving match of two child lists, found by
dynamic programming) and merged into the host's wrapper.  A node whose own text
is the same on all of the host's pages is template; a node whose text varies is a
slot.  Slots inside the article (or the body, where there is none) are content,
unless their label or a label above says menu, footer, advert, form or the like.

Pages of a host never meet in one task: each partition merges its pages into one
wrapper per host, these are merged per (host, salt), and those per host.  A
wrapper holds labels and text hashes only, so it stays small.  Hosts' wrappers
then join the pages by host (Spark splits a hot host).

Defined results: null or empty html gives the empty text; a null url is one more
host; a host with fewer than ``ENOUGH`` pages, or whose pages are all alike, has
no template inside its article; html cut short is closed at its end; repeated
rows are extracted row by row; an empty table gives no rows.  Only page_id, url
and html are read.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import load
from .urls import host_of

#: Pages of a host from which a constant text counts as template.
ENOUGH = 5
SALTS = 32
#: Elements and class words that hold no main text.
SKIP_TAGS = frozenset("head script style noscript template nav footer aside form button select textarea option iframe svg "
                      "object canvas audio video dialog menu".split())
SKIP_WORDS = frozenset("ad ads advert adverts advertisement advertising banner cookie cookies consent notice notices popup modal "
                       "menu nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead comment comments reply "
                       "replies disqus share sharing social related promo promotion sponsor sponsored newsletter subscribe "
                       "login signup search widget toolbar pagination pager copyright".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe"))
BLOCK = frozenset("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
                  "h5 h6 head header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
_TAG = re.compile(r"""<(?:!--(?s:.*?)(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|[!?/][^>]*+>)""")
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
VARIES = -1
#: Open elements; those nested deeper lie beside one another in the last of them, as in browsers.
DEEP = 300


class Node:
    """An element: label, children (nodes and strings), and what the label says."""
    __slots__ = ("tag", "label", "children", "skip", "slot")

    def __init__(self, tag: str, label: str = "", skip: bool = False):
        self.tag, self.label, self.children, self.skip, self.slot = tag, label or tag, [], skip, None


def parse(page: str) -> Node:
    """The element tree; unclosed elements end where html says they must."""
    root = Node("#")
    stack, at, end = [root], 0, page.rfind(">") + 1
    search = _TAG.search

    def say(text: str) -> None:
        """Text goes to the open element; one nested too deep goes on behind what
        has come since."""
        if len(stack) > DEEP and stack[DEEP - 1].children[-1] is not stack[-1]:
            top = stack[-1]
            stack[-1] = Node(top.tag, top.label, top.skip)
            stack[DEEP - 1].children.append(stack[-1])
        stack[-1].children.append(text)

    while at < end:
        m = search(page, at, end)
        if m is None:
            break
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:  # closing
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        marks = m[3] or m[6] or ""
        label, skip = tag, tag in SKIP_TAGS or (tag == "header" and not any(n.tag in ("article", "main") for n in stack))
        if "=" in marks and tag not in VOID:
            words = [w for g in _MARKS.findall(marks) for w in (g[0] or g[1] or g[2]).lower().split()]
            if words:
                label = tag + "." + words[0]
                if tag not in ("html", "body", "article", "main"):
                    # inside an article a paragraph's compound names ("share-price") say nothing
                    whole = tag == "p" and any(n.tag in ("article", "main") for n in stack)
                    skip = skip or any(p in SKIP_WORDS for w in words for p in ((w,) if whole else re.split(r"[-_]", w)))
        if tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):  # an open paragraph ends here
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK:
                    break
        for over in CLOSES.get(tag, ()):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == over:
                    del stack[k:]
                    break
                if stack[k].tag in ("ul", "ol", "dl", "table", "select"):
                    break
        deep = len(stack) >= DEEP
        node = Node(tag, label, skip or deep and stack[-1].skip)
        stack[DEEP - 1 if deep else -1].children.append(node)
        if tag in VOID or marks.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
            if tag in ("textarea", "title", "noscript"):
                node.children.append(page[at:close.start() if close else len(page)])
            at = close.end() if close else len(page)
            continue
        stack.append(node)
    if at < len(page):
        say(page[at:])
    return root


# A slot is [label, children, text, pages]: text None without any, its hash while constant, else VARIES.

def skeleton(node: Node) -> list:
    """The slot tree of a page's element; remembers each element's slot."""
    import zlib
    slot = node.slot = [node.label, [], None, 1]
    if node.skip:
        return slot
    own = " ".join("".join(c for c in node.children if isinstance(c, str)).split())
    if own:
        slot[2] = zlib.crc32(own.encode())
    for c in node.children:
        if isinstance(c, Node) and c.tag not in VOID:
            s = skeleton(c)
            if slot[1] and slot[1][-1][0] == s[0]:  # a repeated node
                merge(slot[1][-1], s, pages=0)
                _redirect(c, slot[1][-1])
            else:
                slot[1].append(s)
    return slot


def _redirect(node: Node, slot: list) -> None:
    """Point a merged element, and those under it, at the slots they went to."""
    node.slot = slot
    if node.skip:
        return
    kids = [c for c in node.children if isinstance(c, Node) and c.tag not in VOID]
    for c, k in zip(kids, match([c.label for c in kids], [s[0] for s in slot[1]], None, None, repeat=True)):
        _redirect(c, slot[1][k] if k is not None else [c.label, [], VARIES, 0])


def tree_matching(a: list, b: list) -> int:
    """Simple tree matching: nodes in the largest common top-down match."""
    if a[0] != b[0]:
        return 0
    best = [0] * (len(b[1]) + 1)
    for x in a[1]:
        new = [0]
        for j, y in enumerate(b[1]):
            new.append(max(new[-1], best[j + 1], best[j] + tree_matching(x, y)))
        best = new
    return 1 + best[-1]


def match(a: list, b: list, xs, ys, repeat: bool = False) -> list:
    """For each of ``a`` the index in ``b`` that it is aligned to, or None.
    ``xs``, ``ys``: the subtrees, for weights.  ``repeat``: neighbours may share one."""
    if a == b and not repeat:
        return list(range(len(a)))
    if repeat:  # groups of equal neighbours against the list
        groups = [i for i in range(len(a)) if not i or a[i] != a[i - 1]]
        found = match([a[i] for i in groups], b, None, None)
        out, g = [], -1
        for i in range(len(a)):
            g += i in groups
            out.append(found[g])
        return out
    n, m = len(a), len(b)
    score = [[0] * (m + 1) for _ in range(n + 1)]
    weight = {}
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            w = 0
            if a[i] == b[j]:
                w = weight[i, j] = tree_matching(xs[i], ys[j]) if xs else 1
            score[i][j] = max(score[i + 1][j], score[i][j + 1], w + score[i + 1][j + 1] if w else 0)
    out, j = [None] * n, 0
    i = 0
    while i < n and j < m:
        if (i, j) in weight and score[i][j] == weight[i, j] + score[i + 1][j + 1]:
            out[i] = j
            i, j = i + 1, j + 1
        elif score[i][j] == score[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def merge(wrapper: list, page: list, pages: int = 1) -> None:
    """Align ``page`` with ``wrapper`` (same label) and merge it in."""
    if wrapper is page:
        return
    wrapper[3] += page[3] if pages else 0
    if page[2] is not None:
        wrapper[2] = page[2] if wrapper[2] is None else wrapper[2] if wrapper[2] == page[2] else VARIES
    if not page[1]:
        return
    at = match([p[0] for p in page[1]], [w[0] for w in wrapper[1]], page[1], wrapper[1])
    out, done = [], 0
    for p, k in zip(page[1], at):
        if k is None:
            out.append(p)
        else:
            out += wrapper[1][done:k + 1]
            done = k + 1
            merge(wrapper[1][k], p, pages)
    wrapper[1] = out + wrapper[1][done:]


def slots_vary(slot: list) -> bool:
    return slot[2] == VARIES or any(slots_vary(c) for c in slot[1])


def template_of(wrapper: list | None, page: list) -> set:
    """ids of the page's slots whose text is template by the host's wrapper."""
    out: set = set()
    if wrapper is None or wrapper[3] < ENOUGH or not slots_vary(wrapper):
        return out

    def walk(w, p):
        if w[2] not in (None, VARIES) and w[2] == p[2] and w[3] >= ENOUGH:
            out.add(id(p))
        for x, k in zip(p[1], match([x[0] for x in p[1]], [y[0] for y in w[1]], p[1], w[1])):
            if k is not None:
                walk(w[1][k], x)

    walk(wrapper, page)
    return out


def regions(root: Node) -> list[Node]:
    """Articles, outermost, in page order; the whole page if it has none."""
    found, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.skip:
            continue
        if n.tag in ("article", "main"):
            found.append(n)
            continue
        todo += [c for c in reversed(n.children) if isinstance(c, Node)]
    return found or [root]


def main_text(page: str, wrapper: list | None = None) -> str:
    """The text of a page's varying slots."""
    if not page:
        return ""
    root = parse(page)
    template = template_of(wrapper, skeleton(root))
    blocks: list[list[str]] = [[]]

    def walk(n: Node) -> None:
        if n.skip:
            blocks.append([])
            return
        block = n.tag in BLOCK
        if block:
            blocks.append([])
        constant = n.slot is not None and id(n.slot) in template
        for c in n.children:
            if isinstance(c, str):
                if not constant:
                    blocks[-1].append(c)
            elif c.tag == "br":
                blocks[-1].append(" ")
            elif c.tag not in VOID:
                walk(c)
        if block:
            blocks.append([])

    for region in regions(root):
        walk(region)
    done = (" ".join(entities.unescape("".join(b)).split()) for b in blocks if b)
    return " ".join(b for b in done if b)


def _merged(wrappers: list[str]) -> str:
    out = None
    for w in wrappers:
        w = json.loads(w)
        if out is None:
            out = w
        else:
            merge(out, w)
    return json.dumps(out, separators=(",", ":"))


def induce(pages: DataFrame) -> DataFrame:
    """(host, wrapper): one wrapper per host, as JSON."""
    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
                if page:
                    s = skeleton(parse(page))
                    if host in found:
                        merge(found[host], s)
                    else:
                        found[host] = s
        if found:
            yield pa.RecordBatch.from_pydict({"host": list(found), "wrapper": [json.dumps(w) for w in found.values()]})

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [_merged(group["wrapper"].tolist())]})

    parts = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(partials, "host string, wrapper string") \
                 .withColumn("salt", F.spark_partition_id() % SALTS)
    parts = parts.groupBy("host", "salt").applyInPandas(combine, "host string, wrapper string")
    return parts.groupBy("host").applyInPandas(combine, "host string, wrapper string")


@F.arrow_udf(T.StringType())
def _extract(pages: pa.Array, wrappers: pa.Array) -> pa.Array:
    seen: dict = {}
    out = []
    for page, w in zip(pages.to_pylist(), wrappers.to_pylist()):
        if w is not None and w not in seen:
            if len(seen) > 2000:
                seen.clear()
            seen[w] = json.loads(w)
        out.append(main_text(page or "", seen.get(w)))
    return pa.array(out, pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    d = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    wrappers = induce(pages)
    return d.join(wrappers, "host", "left").select("page_id", "url", _extract("html", "wrapper").alias("text")) \
            .withColumn("n_chars", F.length("text").cast("long"))


def op4_extract(spark, sf_dir: str) -> DataFrame:
    return extract(load(spark, sf_dir, "pages"))
