"""Main text of web pages by consensus host paths.

Every page's containers are scored: which share of the page's running text a container
holds, times the share of its own text that is running text (no menus, adverts, links and
so on); of nested containers that hold the same only the innermost counts. A container is named by its generalised tag-class path: tags and classes from the
root, digits replaced. Spark adds up the scores of every path over the pages of a host,
and the path with most votes is where that host keeps its articles. Each page is then
extracted again from the containers at its host's winning path, so a page whose advert is
longer than its article follows its neighbours. A page that has no such container, or no
host, falls back on its own best container.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import stored

# Elements by their role in HTML, and words that name what is no article.
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
              "span strike strong sub sup time tt u var".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style title textarea noscript iframe noembed noframes xmp template svg math select".split())
_NO_CONTAINER = set("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption summary".split()) | _INLINE
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}),
           "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"datalist"})}
_NOISE_TAGS = set("nav footer aside form button fieldset dialog menu object canvas audio video datalist".split())
_NOISE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                   "toolbar status".split())
_COMMENTS = set("comment comments commentlist reply replies respond responses discussion disqus feedback".split())
_NOISE_WORDS = _COMMENTS | set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promos promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs masthead topbar footer sidebar aside rail widget widgets related "
    "recommended recommendations share sharing social cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login search form toolbar pagination pager paywall legal "
    "copyright disclaimer".split())
_KEPT_TAGS = {"html", "body", "main", "article"}

_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"                                                     # a comment
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]+|=\s*(?>\"[^\"]*\"|'[^']*'|))*+)(?:>|\Z)"        # a tag, or one cut off
    r"|<[!?/](?:[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NO_WORDS: frozenset = frozenset()
_DIGITS = re.compile(r"\d+")


@dataclass
class Page:
    """Elements in page order, parents first, and blocks (element, text, link characters)."""
    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["html"])
    path: list[str] = field(default_factory=lambda: [""])
    words: list[frozenset] = field(default_factory=lambda: [frozenset()])
    noise: list[int] = field(default_factory=lambda: [0])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _step(up: str, tag: str, classes: str, known: dict) -> str:
    """Digest of the path: its length doesn't grow with the nesting."""
    key = (up, tag, classes)
    if key not in known:
        names = sorted({_DIGITS.sub("#", c) for c in classes.lower().split()})
        known[key] = hashlib.blake2b("\0".join((up, tag, *names)).encode("utf-8", "replace"), digest_size=12).hexdigest()
    return known[key]


def _element_noise(tag: str, words: frozenset, attributes: dict, inside_article: bool) -> int:
    """0 text, 1 noise, 2 header of an article (its headings count), 3 noise by class only."""
    if tag in _NOISE_TAGS or attributes.get("role", "").lower() in _NOISE_ROLES or "hidden" in attributes \
            or attributes.get("aria-hidden", "").lower() == "true" \
            or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return 0 if tag in ("html", "body") else 1
    if tag == "header" or ("header" in words and tag not in _KEPT_TAGS and tag not in _HEADINGS):
        return 2 if inside_article else (1 if tag == "header" else 3)
    if tag in _KEPT_TAGS:
        return 1 if tag == "article" and words & _COMMENTS else 0
    return 3 if words & _NOISE_WORDS else 0


def parse_page(html: str, known: dict) -> Page:
    """One pass over the tags; an element that is not closed ends with its parent."""
    page, stack, article = Page(), [0], 0
    buffer: list[str] = []
    linked, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(buffer).split())
        if text:
            page.blocks.append((stack[-1], text, min(linked, len(text))))
        buffer.clear()
        linked = 0

    def leave(level: int) -> None:
        nonlocal article
        for node in stack[level:]:
            article -= page.tag[node] in ("article", "main")
        del stack[level:]

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = unescape(piece) if "&" in piece else piece
            buffer.append(piece)
            if in_link:
                linked += len(" ".join(piece.split()))

    length = len(html)
    for m in _TAG.finditer(html):
        start, end = m.span()
        if start < at:  # inside an element whose content is no markup
            continue
        if start > at:
            text(html[at:start])
        at = end
        closing, tag, rest = m.groups()
        if not tag or (at == length and html[at - 1] != ">"):
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                in_link = False
            elif tag == "br":
                buffer.append(" ")
            elif tag in _INLINE:
                if page.tag[stack[-1]] == tag:  # an inline element that was kept because it is noise
                    flush()
                    leave(len(stack) - 1)
            elif tag not in ("html", "body", "head"):
                flush()
                level = next((k for k in range(len(stack) - 1, 0, -1) if page.tag[stack[k]] == tag), 0)
                if level:
                    leave(level)
            continue
        if tag in _VOID:
            if tag in ("br", "hr", "wbr", "img"):
                buffer.append("" if tag == "wbr" else " ")
            if tag == "hr":
                flush()
            continue
        if tag in _RAW:
            last = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            buffer.append(" ")
            at = last.end() if last else length
            continue
        if tag in ("html", "head"):
            continue
        if tag == "a":
            in_link = True
        classes, words = "", _NO_WORDS
        attributes = {}
        if rest:
            for a in _ATTRIBUTE.finditer(rest):
                attributes.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
            classes = attributes.get("class", "")
            if classes or "id" in attributes:
                words = frozenset(w.lower() for w in _WORD.findall(f"{classes} {attributes.get('id', '')}"))
        if attributes or tag == "header":
            noise = _element_noise(tag, words, attributes, article > 0)
        else:
            noise = 1 if tag in _NOISE_TAGS else 0
        if tag in _INLINE and not noise:
            continue
        flush()
        if tag not in _INLINE:
            level = next((k for k in range(len(stack) - 1, 0, -1) if page.tag[stack[k]] == "p"), 0)
            if level:
                leave(level)
        if tag in _CLOSES:
            ends, scope = _CLOSES[tag]
            level = 0
            for k in range(len(stack) - 1, 0, -1):
                if page.tag[stack[k]] in scope:
                    break
                level = k if page.tag[stack[k]] in ends else level
            if level:
                leave(level)
        up = stack[-1]
        stack.append(len(page.tag))
        page.parent.append(up)
        page.tag.append(tag)
        page.path.append(_step(page.path[up], tag, "" if tag == "body" else classes, known))
        page.words.append(words)
        page.noise.append(noise)
        article += tag in ("article", "main")
    text(html[at:])
    flush()
    return page


def _settle(page: Page) -> None:
    """Noise is handed down; a class alone makes no noise of what holds the article."""
    n = len(page.tag)
    holds = [t in ("article", "main", "h1") for t in page.tag]
    for e in range(n - 1, 0, -1):
        holds[page.parent[e]] |= holds[e]
    for e in range(1, n):
        if page.noise[e] == 3:
            page.noise[e] = 0 if holds[e] and not page.words[e] & _COMMENTS else 1
        page.noise[e] = page.noise[page.parent[e]] or page.noise[e]


def _is_text(page: Page, e: int) -> bool:
    return not page.noise[e] or (page.noise[e] == 2 and page.tag[e] in _HEADINGS)


def container_scores(page: Page) -> dict[str, tuple[float, int]]:
    """{path: (score, depth)} of the page's containers. One whose score an inner container
    matches is left out: it holds no running text besides."""
    n = len(page.tag)
    running, whole, depth = [0] * n, [0] * n, [0] * n
    for e, text, linked in page.blocks:
        whole[e] += len(text)
        if _is_text(page, e) and 2 * linked <= len(text):
            running[e] += len(text) - linked
    for e in range(1, n):
        depth[e] = depth[page.parent[e]] + 1
    for e in range(n - 1, 0, -1):
        running[page.parent[e]] += running[e]
        whole[page.parent[e]] += whole[e]
    if not running[0]:
        return {}
    sums: dict[str, list] = defaultdict(lambda: [0, 0, 0])
    for e in range(n):
        if running[e] and not page.noise[e] and page.tag[e] not in _NO_CONTAINER:
            s = sums[page.path[e]]
            s[0] += running[e]
            s[1] += whole[e]
            s[2] = depth[e]
    scores = {p: (min(1.0, r / running[0]) * r / w, d) for p, (r, w, d) in sums.items()}
    inner, kept = [0.0] * n, {}
    for e in range(n - 1, -1, -1):
        own = scores.get(page.path[e]) if running[e] and not page.noise[e] and page.tag[e] not in _NO_CONTAINER else None
        if own and inner[e] < 0.999 * own[0]:
            kept[page.path[e]] = own
        if e:
            inner[page.parent[e]] = max(inner[page.parent[e]], inner[e], own[0] if own else 0.0)
    return kept


def best_path(scores: dict[str, tuple[float, int]]) -> str | None:
    return max(scores, key=lambda p: (round(scores[p][0], 9), scores[p][1], p)) if scores else None


def page_text(page: Page, path: str | None) -> str:
    """Blocks of the containers at ``path``, else of the page's own best."""
    if path is None or path not in page.path:
        path = best_path(container_scores(page))
    inside = [False] * len(page.tag)
    for e in range(len(page.tag)):
        inside[e] = page.path[e] == path or (e > 0 and inside[page.parent[e]])
    return "\n".join(t for e, t, _ in page.blocks if inside[e] and _is_text(page, e))


def _parsed(html: str | None, known: dict) -> Page:
    if len(known) > 100_000:
        known.clear()
    page = parse_page(html or "", known)
    _settle(page)
    return page


def _votes(batches):
    """``host, path, depth, vote``: a page's containers that score half of its best or more."""
    known: dict = {}
    for batch in batches:
        out = {"host": [], "path": [], "depth": [], "vote": []}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            scores = container_scores(_parsed(html.as_py(), known))
            least = 0.5 * max((s for s, _ in scores.values()), default=0)
            for path, (score, depth) in scores.items():
                if score >= least:
                    for name, value in zip(out, (host, path, depth, score)):
                        out[name].append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["host"], pa.string()), pa.array(out["path"], pa.string()),
             pa.array(out["depth"], pa.int32()), pa.array(out["vote"], pa.float64())], list(out))


@F.pandas_udf(StringType())
def _extract(html: pd.Series, path: pd.Series) -> pd.Series:
    known: dict = {}
    return pd.Series([page_text(_parsed(h, known), p) for h, p in zip(html, path)], dtype=object)


def _host(url):
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.nullif(F.regexp_replace(host, r"\.$", ""), F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, path, votes, pages``: the winning container path of every host. Votes are
    added up before they are shuffled, so a host with very many pages is no large group."""
    cast = pages.select(_host(F.col("url")).alias("host"), "html").where(F.col("host").isNotNull()) \
        .mapInArrow(_votes, "host string, path string, depth int, vote double")
    sums = cast.groupBy("host", "path").agg(F.sum(F.round(F.col("vote") * 1_000_000).cast("long")).alias("votes"),
                                            F.max("depth").alias("depth"), F.count(F.lit(1)).alias("pages"))
    return sums.groupBy("host").agg(F.max_by(F.struct("path", "votes", "pages"), F.struct("votes", "depth", "path")).alias("w")) \
        .select("host", "w.path", "w.votes", "w.pages")


def extract_pages(pages: DataFrame, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """``page_id, url, text, n_chars, host_path`` for every row of ``pages``.

    Blocks are the text between block elements, with character references decoded and
    white space (``br`` too) turned into one space. A null or empty page gives an empty
    text; pages of any length are read whole; repeated rows are extracted each, and equal
    pages of a host get equal texts. A page without url or host uses its own best container
    (``host_path`` is null). Equal votes go to the deeper, then the greater path. An empty
    table gives no rows; other columns are ignored."""
    winners = stored(host_paths(pages), "html-paths")
    size = winners.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 64), F.lit(0))).first()[0]
    paths = winners.select("host", F.col("path").alias("host_path"))
    if size <= broadcast_bytes:
        paths = F.broadcast(paths)
    rows = pages.select("page_id", "url", "html", _host(F.col("url")).alias("host")).join(paths, "host", "left")
    return rows.select("page_id", "url", _extract("html", "host_path").alias("text"), "host_path") \
        .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "host_path")
