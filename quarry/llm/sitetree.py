"""HTML extraction with a site style tree: same-host pages merged, unimportant branches removed."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

# HTML's element classes and the names by which pages mark what is not the article. A name
# in a class or id marks its element if all its words are such names (cookie-notice, not has-sidebar).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("head script style noscript template iframe object svg canvas nav aside footer form button select menu dialog".split())
BLOCK = frozenset(
    "html body main article section header h1 h2 h3 h4 h5 h6 hgroup p div ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address details summary fieldset center".split()
)
CLOSES_P = BLOCK - {"html", "body", "li", "dt", "dd", "caption", "thead", "tbody", "tfoot", "tr", "td", "th"} | {"nav", "aside", "footer", "form", "menu", "hr"}
CLOSES_SELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
LANDMARK = frozenset({"article", "main"})
UNMARKED = LANDMARK | {"html", "body"}  # their names say what the page has, not what they are
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "header masthead footer sidebar aside notice notices cookie cookies consent gdpr banner popup modal newsletter subscribe "
    "subscription signup login share sharing social comment comments disqus respond related recommended widget toolbar pagination "
    "skip copyright legal disclaimer".split()
)
#: Names that mark a part of the article itself when they are inside it.
INSIDE_OK = frozenset({"header", "legal"})

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|$)|<[!?/][^>]*(?:>|$)", re.S)
ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Params:
    """A node is judged on hosts where at least ``min_pages`` different pages have it, and removed
    with its branch below ``threshold``; gamma weighs a node's content against its own presentation."""

    min_pages: int = 8
    threshold: float = 0.1
    gamma: float = 0.9


def _noise(tag: str, attrs: str, inside: bool) -> tuple[bool, str]:
    """Whether an element is marked as something else than the article, and its label in paths."""
    if tag in DROPPED or (tag == "header" and not inside):
        return True, tag
    if not attrs or attrs.isspace():
        return False, tag
    label = tag
    for name, value in ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, tag
        if name == "role" and value in NOISE_ROLES:
            return True, tag
        if name in ("class", "id"):
            marks = NOISE_NAMES - INSIDE_OK if inside else NOISE_NAMES
            if tag not in UNMARKED and any((w := WORD.findall(t)) and marks.issuperset(w) for t in value.split()):
                return True, tag
            if name == "class":
                label = f"{tag}.{'.'.join(sorted(set(value.split())))}"
    return False, label


def parse(html: str) -> tuple[list[tuple[str, bool, str]], list[tuple[str, str]]]:
    """Blocks (path, in an article or main element, text) in page order, and nodes (path, labels of
    its child blocks, equal neighbours once).

    Paths list block elements with their classes; inline elements don't count. Marked branches and
    raw elements give nothing. Unclosed, misnested and cut-off markup is read as browsers do in the
    common cases; a tag cut off by the end of the page is no text.
    """
    blocks, children, order = [], {}, []
    stack: list[tuple[str, str, bool, bool]] = []  # tag, path, noise, in a landmark
    text: list[str] = []

    def flush() -> None:
        if text:
            t = " ".join(unescape("".join(text)).split())
            text.clear()
            if t:
                top = stack[-1] if stack else ("", "", False, False)
                blocks.append((top[1], top[3], t))

    def close(upto: int) -> None:
        flush()
        del stack[upto:]

    pos, n = 0, len(html)
    while pos < n:
        m = TOKEN.search(html, pos)
        noisy = bool(stack) and stack[-1][2]
        if not noisy:
            chunk = html[pos : m.start() if m else n]
            if chunk:
                text.append(chunk)
        if not m:
            break
        pos = m.end()
        if m[0].startswith("<![CDATA[") and not noisy:
            text.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
        if not m[2]:
            continue
        if not m[4]:
            break  # the page ends within this tag
        tag = m[2].lower()
        if m[1]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if at >= 0:
                close(at)
            elif tag in BLOCK or tag == "br":
                flush_or_space(text, tag, flush)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, pos)
            pos = end.end() if end else n
            continue
        if tag == "br" or tag == "wbr":
            if not noisy and tag == "br":
                text.append(" ")
            continue
        if tag in CLOSES_P:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), -1)
            if at >= 0 and not any(s[0] in ("td", "th", "li", "article", "section", "div") for s in stack[at:]):
                close(at)
        if tag in CLOSES_SELF:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in CLOSES_SELF[tag]:
                    close(i)
                    break
                if stack[i][0] in SCOPE[tag]:
                    break
        above = stack[-1] if stack else ("", "", False, False)
        noise, label = _noise(tag, m[3], above[3])
        noise = noise or above[2]
        if tag not in BLOCK and not noise:
            if tag == "hr":
                flush()
            continue  # inline
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if not (tag not in BLOCK and noise and tag not in DROPPED):
            flush()
        elif text:
            text.append("")
        path = f"{above[1]}>{label}" if above[1] else label
        if not noise:
            kids = children.get(above[1])
            if kids is None:
                kids = children[above[1]] = []
                order.append(above[1])
            if not kids or kids[-1] != label:
                kids.append(label)
        stack.append((tag, path, noise, above[3] or (tag in LANDMARK and not noise)))
    flush()
    return blocks, [(p, " ".join(children[p])) for p in order if p]


def flush_or_space(text: list[str], tag: str, flush) -> None:
    """A stray end tag: a block's ends the block before it, a br's is a line break."""
    if tag == "br":
        text.append(" ")
    else:
        flush()


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _hosts(url: pd.Series) -> pd.Series:
    return pd.Series([host(u) for u in url], dtype=object)


def _outline(html: pd.Series, url: pd.Series) -> pd.DataFrame:
    """What the style tree needs of each page: host, digest of the text, distinct (path, hash of the
    text) items, distinct paths with their ancestors, and the nodes' child sequences."""
    out = []
    for h, u in zip(html, url, strict=True):
        blocks, nodes = parse(h or "")
        hashes = [xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) - (1 << 63) for _, _, t in blocks]
        digest = xxhash.xxh3_64_intdigest(np.array(hashes, np.int64).tobytes()) - (1 << 63)
        items = sorted({(p, x) for (p, _, _), x in zip(blocks, hashes, strict=True)})
        branches = sorted({">".join(p.split(">")[:i]) for p, _, _ in blocks for i in range(1, p.count(">") + 2)})
        out.append((host(u), digest, [{"path": p, "text": x} for p, x in items], branches, [{"path": p, "style": s} for p, s in nodes]))
    return pd.DataFrame(out, columns=["host", "digest", "items", "branches", "nodes"])


OUTLINE = "struct<host: string, digest: long, items: array<struct<path: string, text: long>>, branches: array<string>, nodes: array<struct<path: string, style: string>>>"


def unimportant(pages: DataFrame, url_col: str, html_col: str, p: Params) -> DataFrame:
    """(host, low): the node paths to remove on a host, written.

    Pages of one host are merged by node path, pages of equal text counting once. Content: a block
    text on k of a node's m pages has the entropy log_m k, and the node's content importance is 1
    minus the mean over its texts, so what every page repeats is near 0. Presentation: the entropy of
    the node's child sequences over its pages. A node weighs (1 - gamma) presentation + gamma
    content, content being the mean over the blocks of its branch; a leaf is its content. Everything
    is sums per (host, path, text), and only paths and hashes move: a host with a third of all pages
    is partial sums on every task.
    """
    outline = F.pandas_udf(_outline, OUTLINE)
    rows = pages.select(outline(F.col(html_col).cast("string"), F.col(url_col).cast("string")).alias("t")).select("t.*")
    chosen = written(rows.groupBy("host", "digest").agg(*[F.first(c).alias(c) for c in ("items", "branches", "nodes")]), "page-outlines")
    texts = chosen.select("host", F.explode("items").alias("b")).groupBy("host", "b.path", "b.text").agg(F.count(F.lit(1)).alias("k"))
    leaf = texts.groupBy("host", "path").agg(F.sum(F.log("k")).alias("spread"), F.count(F.lit(1)).alias("texts"))
    ancestors = F.transform(
        F.sequence(F.lit(1), F.size(F.split("path", ">"))), lambda i: F.array_join(F.slice(F.split("path", ">"), 1, i), ">")
    )
    content = leaf.select("host", F.explode(ancestors).alias("path"), "spread", "texts").groupBy("host", "path")
    content = content.agg(F.sum("spread").alias("spread"), F.sum("texts").alias("texts"))
    on_page = chosen.select("host", F.explode("branches").alias("path")).groupBy("host", "path").agg(F.count(F.lit(1)).alias("m"))
    styles = chosen.select("host", F.explode("nodes").alias("s")).groupBy("host", "s.path", "s.style").agg(F.count(F.lit(1)).cast("double").alias("n"))
    style = styles.groupBy("host", "path").agg((F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")).alias("style"))
    nodes = on_page.where(F.col("m") >= p.min_pages).join(content, ["host", "path"]).join(style, ["host", "path"], "left")
    inner = 1 - F.col("spread") / F.col("texts") / F.log("m")
    weight = F.when(F.col("style").isNull(), inner).otherwise((1 - p.gamma) * F.least(F.lit(1.0), F.col("style") / F.log("m")) + p.gamma * inner)
    judged = nodes.select("host", "path", weight.alias("importance"))
    # a host whose pages as a whole repeat each other says nothing about single branches
    whole = judged.withColumn("top", F.max("importance").over(Window.partitionBy("host")))
    low = whole.where((F.col("importance") < p.threshold) & (F.col("top") >= 0.5))
    return written(low.groupBy("host").agg(F.collect_set("path").alias("low")), "low-branches")


def extract(pages: DataFrame, id_col: str, url_col: str, html_col: str, p: Params = Params()) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The text of the blocks left, in page order, joined by one space; null or empty html and pages
    without blocks give an empty text. Rows without a readable host share the empty host. Repeated
    rows each get their text.
    """
    low = unimportant(pages, url_col, html_col, p)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.withColumn("host", F.pandas_udf(_hosts, "string")(F.col("url").cast("string")))
    # hosts with such branches are few: their table is broadcast if it measures small, else the pages move
    rows = rows.join(low.withColumnRenamed("host", "_h"), F.col("host") == F.col("_h"), "left")

    def text_of(html: pd.Series, low: pd.Series) -> pd.Series:
        out = []
        for h, cut in zip(html, low, strict=True):
            blocks, _ = parse(h or "")
            if cut is not None and len(cut):
                gone = set(cut)
                blocks = [b for b in blocks if not any(">".join(b[0].split(">")[:i]) in gone for i in range(1, b[0].count(">") + 2))]
            out.append(" ".join(t for _, _, t in blocks))
        return pd.Series(out)

    text_of.__annotations__ = {"html": pd.Series, "low": pd.Series, "return": pd.Series}
    out = rows.select("page_id", "url", F.pandas_udf(text_of, "string")("html", "low").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
