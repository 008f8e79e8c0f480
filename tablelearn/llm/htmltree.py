"""HTML main text with a site style tree.

All pages of a host are merged into one tree of element paths with the texts as leaves.
For every node the entropy of its presentation (which child sequences it shows) and of its
content (on how many pages each text under it stands) give an importance between 0 and 1;
branches and texts whose importance is low are the site's template and are cut from each
of its pages, inside <article> and <main> as anywhere else. What the markup itself
declares as not content (navigation, forms, scripts, adverts, reader comments ...) is cut
as well. On a page that names its article or main element, the text beside it stays if its
importance, averaged with one more page of importance 0, is not low: on a single page the
element alone decides, on many its statistics do.

Defined results: a null or empty html gives an empty text; a null url is a host of its
own; a null page id stays null; repeated rows give equal rows and count once in the
statistics (pages with equal html do); an empty table gives an empty result; extra
columns are ignored. Unclosed or stray tags never lose text, except that an open script or
style ends with the page, an open title or textarea with the next tag, and a tag that the
page's end cuts off is dropped. Very long pages are parsed whole, in linear time.

Scale: pages are parsed twice and never shuffled unless the cut branches outgrow the
broadcast bound; the statistics are partial counts per (host, path, value hash).
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, materialise, text_bytes_conf

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg select object canvas title".split())
#: Raw elements that, left open, end only with the page, and those that end with the next tag.
RAW_TO_END, RAW_TO_TAG = frozenset(("script", "style")), frozenset(("title", "textarea"))
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul caption option button legend".split())
#: Elements that are never main text, and words of class, id or role that say the same.
NOISE_TAGS = frozenset("nav aside form button head dialog menu fieldset".split())
PAGE_NOISE_TAGS = frozenset("header footer".split())
NOISE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "form gdpr header masthead menu modal nav navbar navigation newsletter notice pagination popup promo promotion "
    "related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
CONTENT_TAGS = frozenset(("article", "main"))
#: Closing rules: an opening tag ends these open elements (up to the nearest container).
_ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("table ul ol dl body html article section div td th select".split())
_OPEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP, _VALUE = re.compile("[>\"']"), {"\"": re.compile("[\"<]"), "'": re.compile("['<]")}
_ATTR = re.compile(r"""(?:^|[\s/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: Depth to which paths are told apart in the statistics.
MAX_DEPTH = 12
#: Share of a node's importance that its content has; the rest is its presentation's.
GAMMA = 0.9
BROADCAST_BYTES = 32 << 20


class _Node:
    __slots__ = ("tag", "path", "noise", "content", "children")

    def __init__(self, tag: str, path: str, noise: bool, content: bool):
        self.tag, self.path, self.noise, self.content = tag, path, noise, content
        self.children: list[str] = []


def _tag_end(text: str, at: int) -> int:
    """Where the tag whose name ends at ``at`` ends (its ``>``), or -1. A quoted value may
    hold ``>`` but no ``<``; other quotes are characters. Linear: a quote is looked at again
    only if no other of its kind stands before the next ``<``."""
    while m := _STOP.search(text, at):
        at = m.end()
        if m[0] == ">":
            return m.start()
        end = _VALUE[m[0]].search(text, at)
        if end and end[0] == m[0]:
            at = end.end()
    return -1


def parse(text: str | None):
    """Blocks as (path, text, declared noise, in the article), and every element's
    (path, child sequence)."""
    blocks: list[tuple[str, str, bool, bool]] = []
    styles: list[tuple[str, str]] = []
    stack = [_Node("", "", False, False)]
    buf: list[str] = []
    open_ended: set[str] = set()  # raw elements with no end tag further on

    def flush() -> None:
        if buf:
            s = " ".join(_html.unescape("".join(buf)).split())
            if s:
                top = stack[-1]
                blocks.append((top.path, s, top.noise, top.content))
            buf.clear()

    def pop() -> None:
        node = stack.pop()
        seen = []
        for c in node.children:
            if not seen or seen[-1] != c:
                seen.append(c)
        styles.append((node.path, " ".join(seen)))

    def close_to(k: int) -> None:
        flush()
        while len(stack) > k:
            pop()

    pos, n, text = 0, len(text or ""), text or ""
    while pos < n:
        lt = text.find("<", pos)
        if lt < 0:
            buf.append(text[pos:])
            break
        if lt > pos:
            buf.append(text[pos:lt])
        if text.startswith("<!--", lt):
            end = text.find("-->", lt + 4)
            pos = n if end < 0 else end + 3
            continue
        if text.startswith(("<!", "<?"), lt):
            end = text.find(">", lt)
            pos = n if end < 0 else end + 1
            continue
        m = _OPEN.match(text, lt)
        if not m:
            buf.append("<")
            pos = lt + 1
            continue
        end_at = _tag_end(text, m.end())
        if end_at < 0:  # the page was cut off inside a tag
            break
        pos = end_at + 1
        attrs = text[m.end():end_at]
        closing, tag, empty = m[1], m[2].lower(), attrs.endswith("/")
        if tag == "br":
            buf.append(" ")
        elif closing:
            if tag in BLOCK:
                flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close_to(k)
                        break
        elif tag in RAW:
            if not empty or tag in RAW_TO_END:
                end = None if tag in open_ended else re.compile(rf"</{tag}\b[^>]*>", re.I).search(text, pos)
                if end:
                    pos = end.end()
                else:  # looked for once a page
                    open_ended.add(tag)
                    if tag in RAW_TO_END:
                        pos = n
                    elif tag in RAW_TO_TAG:
                        pos = at if (at := text.find("<", pos)) >= 0 else n
        elif tag in BLOCK:
            flush()
            if tag not in ("html", "body"):
                for k in range(len(stack) - 1, 0, -1):
                    t = stack[k].tag
                    if t == "p" or t in _ENDS.get(tag, ()):
                        close_to(k)
                        break
                    if t in _SCOPE:
                        break
            if tag in VOID:
                continue
            up = stack[-1]
            names = " ".join(a or b or c for k, a, b, c in _ATTR.findall(attrs)) if attrs else ""
            said = {w for w in re.split(r"[^a-z]+", names.lower()) if w}
            sign = tag + "".join("." + w for w in sorted(said))
            noise = (up.noise or tag in NOISE_TAGS or (tag in PAGE_NOISE_TAGS and not up.content)
                     or (tag not in ("html", "body") and bool(said & NOISE_WORDS)))
            content = up.content or (tag in CONTENT_TAGS and not noise)
            up.children.append(sign)
            path = up.path if up.path.count(">") >= MAX_DEPTH else f"{up.path}>{sign}"
            stack.append(_Node(tag, path, noise, content))
    close_to(1)
    return blocks, styles


def _h64(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


def main_text(text: str | None, marks: frozenset[str] = frozenset()) -> str:
    """The page's main text, given the host's marks: ``-path`` cuts a branch, ``+path``
    keeps a node beside a named element, ``-path<tab>hash`` cuts a text everywhere and
    ``~path<tab>hash`` beside a named element."""
    blocks, _ = parse(text)
    named = any(c for _, _, _, c in blocks)
    leaves = {m[1:m.index("\t")] for m in marks if "\t" in m}
    low: dict[str, bool] = {}

    def cut(path: str) -> bool:
        if path not in low:
            up = path.rpartition(">")[0]
            low[path] = "-" + path in marks or (bool(up) and cut(up))
        return low[path]

    out = []
    for path, s, noise, content in blocks:
        beside = named and not content
        if noise or (beside and "+" + path not in marks) or (marks and cut(path)):
            continue
        if path in leaves:
            leaf = f"{path}\t{_h64(s)}"
            if "-" + leaf in marks or (beside and "~" + leaf in marks):
                continue
        out.append(s)
    return "\n\n".join(out)


def host_of(url: Column) -> Column:
    """The host in lower case, without user and port."""
    authority = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")


def _counts(pages: DataFrame) -> DataFrame:
    """host, path, kind, h, k, chars: the number of different pages that have, at a path,
    a text (kind 0), a child sequence (1), the node at all (2), text beside a named
    element (3)."""
    schema = "host string, path string, kind int, h bigint, page bigint, chars bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for host, t in zip(b["host"], b["html"]):
                blocks, styles = parse(t)
                page = _h64(t or "")
                named = any(c for _, _, _, c in blocks)
                rows += {(host, p, 0, _h64(s), page, len(s)) for p, s, noise, content in blocks if not noise}
                rows += {(host, p, 1, _h64(s), page, 0) for p, s in styles}
                rows += {(host, p, 2, 0, page, 0) for p in {"", *(p for p, _ in styles)}}
                rows += {(host, p, 3, 0, page, 0) for p, _, noise, content in blocks if named and not (noise or content)}
            if rows:
                yield pd.DataFrame(rows, columns=["host", "path", "kind", "h", "page", "chars"])

    text_bytes_conf(pages.sparkSession)
    once = pages.mapInPandas(run, schema).groupBy("host", "path", "kind", "h", "page").agg(F.max("chars").alias("chars"))
    seen = once.groupBy("host", "path", "kind", "h").agg(F.count(F.lit(1)).alias("k"), F.max("chars").alias("chars"))
    return materialise(seen)


def _same_node(a: str, b: str) -> Column:
    return F.col(f"{a}.host").eqNullSafe(F.col(f"{b}.host")) & (F.col(f"{a}.path") == F.col(f"{b}.path"))


def _texts(seen: DataFrame) -> DataFrame:
    """host, path, h, k, chars, pages, importance of every text."""
    have = seen.where("kind = 2").select("host", "path", F.col("k").alias("m"))
    imp = F.when(F.col("m") > 1, F.greatest(F.lit(0.0), 1 - F.log("k") / F.log("m"))).otherwise(1.0)
    return (seen.where("kind = 0").alias("t").join(have.alias("s"), _same_node("t", "s"))
            .select("t.host", "t.path", "h", "k", "chars", F.col("m").alias("pages"), imp.alias("importance")))


def node_importance(pages: DataFrame, gamma: float = GAMMA, seen: DataFrame | None = None) -> DataFrame:
    """host, path, pages, importance for every element path of a host's merged tree.

    A text on k of the m pages that have its node has importance 1 - log_m k (all pages:
    0, one page: 1); a node's content importance is their mean by length over everything
    below it. Its presentation importance is the entropy, to base m, of its child
    sequences. One-page nodes have importance 1. The path "" stands for the text outside
    every element only."""
    seen = _counts(pages) if seen is None else seen
    leaf = _texts(seen).select("host", "path", (F.col("k") * F.col("chars")).alias("w"), "importance")
    leaf = leaf.groupBy("host", "path").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("importance")).alias("wi"))
    parts = F.split("path", ">")
    above = F.when(F.col("path") == "", F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(parts))),
                    lambda i: F.array_join(F.slice(parts, 1, i), ">")))
    branch = (leaf.select("host", F.explode(above).alias("path"), "w", "wi").groupBy("host", "path")
              .agg((F.sum("wi") / F.sum("w")).alias("content")))
    k, shown, lnm = F.col("k"), F.col("shown"), F.log(F.col("shown"))
    style = (seen.where("kind in (1, 2)").groupBy("host", "path")
             .agg(F.max(F.when(F.col("kind") == 2, k)).alias("m"), F.sum(F.when(F.col("kind") == 1, k)).alias("shown"),
                  F.sum(F.when(F.col("kind") == 1, k * F.log("k"))).alias("klogk")))
    style = style.select("host", "path", "m", F.when((F.col("m") > 1) & (shown > 1), (lnm - F.col("klogk") / shown) / lnm)
                         .otherwise(1.0).alias("show"))
    return (branch.alias("b").join(style.alias("s"), _same_node("b", "s"))
            .select("s.host", "s.path", F.col("m").alias("pages"),
                    (gamma * F.col("content") + (1 - gamma) * F.col("show")).alias("importance")))


def _marks(seen: DataFrame, min_importance: float, min_pages: int) -> DataFrame:
    """host, marks: what ``main_text`` takes, for the hosts that have any."""
    nodes = node_importance(None, seen=seen)
    low = (F.col("pages") >= min_pages) & (F.col("importance") < min_importance)
    low_beside = F.col("importance") * (F.col("pages") - 1) / F.col("pages") < min_importance
    beside = seen.where("kind = 3").select("host", "path")
    texts = _texts(seen.where("kind <> 0 or k > 1"))  # a text on one page is never low
    key = F.concat("path", F.lit("\t"), F.col("h").cast("string"))
    here = beside.alias("b")
    rows = [nodes.where(low).select("host", F.concat(F.lit("-"), "path").alias("mark")),
            texts.where(low).select("host", F.concat(F.lit("-"), key).alias("mark")),
            nodes.where(~low_beside).alias("n").join(here, _same_node("n", "b"), "left_semi")
            .select("host", F.concat(F.lit("+"), "path").alias("mark")),
            texts.where(low_beside & ~low).alias("n").join(here, _same_node("n", "b"), "left_semi")
            .select("host", F.concat(F.lit("~"), key).alias("mark"))]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.groupBy("host").agg(F.sort_array(F.collect_set("mark")).alias("cut"))


def extract(pages: DataFrame, min_importance: float = 0.2, min_pages: int = 8, id_col: str = "page_id",
            url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars for every row. Branches on fewer than ``min_pages``
    different pages of a host are never cut by statistics, except beside an article or
    main element that the page names."""
    text_bytes_conf(pages.sparkSession)
    d = keyed(pages, "page_id", page_id=id_col, url=url_col, html=html_col).withColumn("host", host_of(F.col("url")))
    cut = materialise(_marks(_counts(d.select("host", "html")), min_importance, min_pages))
    size = cut.agg(F.sum(F.octet_length(F.array_join("cut", " ")) + 64)).first()[0] or 0
    side = cut.select(F.col("host").alias("__host"), "cut")
    d = d.join(F.broadcast(side) if size <= BROADCAST_BYTES else side,
               F.col("host").eqNullSafe(F.col("__host")), "left").select("page_id", "url", "html", "cut")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [main_text(t, frozenset(() if c is None else c)) for t, c in zip(b["html"], b["cut"])]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts})

    out = d.mapInPandas(run, "page_id string, url string, text string")
    return out.select(F.col("page_id").cast(pages.schema[id_col].dataType).alias(id_col), F.col("url").alias(url_col), "text",
                      F.length("text").cast("bigint").alias("n_chars"))
