"""Main text of web pages by consensus host paths.

Every page scores its containers and votes for their generalised paths of tags and classes.
Votes are summed per host in Spark, and every page of a host is read again at the path that
won. A page that has nothing there is read at its own best path.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_spark.llm.url_rules import url_host
from access_spark.session import cut_lineage, parallelism

# Roles of HTML elements and usual names of what is not main text.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "th", "table", "tbody", "thead", "tfoot", "tr", "center", "details", "fieldset"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg", "canvas", "audio", "video", "map", "head", "datalist", "annotation", "annotation-xml"}
#: Never text of the page, whatever they hold.
UNSEEN = {"button", "select", "svg", "canvas", "audio", "video", "map", "head", "datalist", "annotation", "annotation-xml"}
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "figure", "figcaption", "address", "summary", "caption", "hgroup"}
BLOCKS = CONTAINERS | ASIDE - {"button", "select", "svg", "annotation", "annotation-xml"} | TEXT_BLOCKS
#: What an opening tag ends, if it is open inside the element given last.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
NOT_MAIN = set(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored sidebar side nav navbar "
    "navigation menu submenu breadcrumb breadcrumbs header masthead topbar toolbar footer comment comments commentlist reply replies "
    "respond discussion disqus cookie cookies consent gdpr notice notices notification alert modal popup overlay lightbox newsletter "
    "subscribe subscription signup login signin share sharing social related recommended recommendations widget pagination pager "
    "search form skip hidden".split()
)
#: Of these, names of what visitors, advertisers and the site's own dialogs say.
FOREIGN = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored comment comments commentlist reply replies respond "
    "discussion disqus cookie cookies consent gdpr modal popup overlay lightbox newsletter subscribe subscription signup login signin".split()
)
#: A class name that begins so tells of a wrapper's layout, not what it is.
LAYOUT = {"has", "no", "with", "without", "overflow"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "alertdialog", "menu", "menubar"}
MAIN = set("content article post entry story main text articlebody body".split())

_MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>]|\Z)", re.I)
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I | re.A) for tag in RAW}
_NAME = re.compile(r"[a-z]+|\d+")
_DIGITS = re.compile(r"\d+")


class Mark(NamedTuple):
    """Why an element may not be main text: a name shared by all elements marked for the same
    reason, whether its tag or role says so, and how much more text than the rest of its page
    shows that the mark is wrong (0: no amount)."""

    name: str
    aside: bool
    times: int


@dataclass
class Node:
    """An open element: its tag, generalised path, whether it is never text, the container
    paths from the outermost to it, the marks around it, and the article (its number; -1 for
    `main`) inside the last of these."""

    tag: str
    path: str
    out: bool
    inside: tuple[str, ...]
    main: bool
    marks: tuple[Mark, ...] = ()
    article: int = 0


class Block(NamedTuple):
    """Text, characters in links, container paths around it, marks and article as in Node, and
    whether it is a heading of the first level."""

    text: str
    linked: int
    inside: tuple[str, ...]
    marks: tuple[Mark, ...]
    article: int
    title: bool

    @property
    def own(self) -> int:
        """Characters that are not links; none if most are."""
        return len(self.text) - self.linked if 2 * self.linked <= len(self.text) else 0


@dataclass
class Page:
    """Blocks of kept text, in order."""

    blocks: list[Block] = field(default_factory=list)


def _label(tag: str, given: dict[str, str]) -> str:
    """Tag with generalised class and id names: numbers are one, order of classes none."""
    names = sorted(set(_DIGITS.sub("0", given.get("class", "").lower()).split()))
    ident = _DIGITS.sub("0", given.get("id", "").lower())
    return tag + "".join(f".{n}" for n in names) + (f"#{ident}" if ident else "")


def _mark(tag: str, given: dict[str, str], in_main: bool) -> Mark | bool:
    """True for what is never text, False for what may be, else the mark of the element."""
    if tag in UNSEEN:
        return True
    if tag == "header" and in_main:
        return False
    if tag == "form":
        return Mark(tag, False, 1)
    if tag in ASIDE:
        return Mark(tag, True, 0)
    if tag in ("html", "body", "main", "article"):
        names = set(_NAME.findall(given.get("class", "").lower())) if tag == "article" else set()
        return Mark("article.comment", False, 0) if names & {"comment", "comments", "reply", "replies"} else False
    if not given:
        return False
    role = given.get("role", "").lower()
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return True
    if "none" in given.get("style", "") and re.search(r"display\s*:\s*none", given["style"], re.I):
        return True
    if role in ROLES:
        return Mark(f"role={role}", role != "form", role == "form")
    names = {n: _NAME.findall(n) for n in f"{given.get('class', '')} {given.get('id', '')}".lower().split()}
    found = {n: NOT_MAIN & set(words) for n, words in names.items() if words and words[0] not in LAYOUT}
    found = {n: words for n, words in found.items() if words}
    if not found:
        return False
    if any(words & FOREIGN for words in found.values()):
        times = 4 * any(n in MAIN - {"text", "body"} for n in names)
    else:
        times = 1 if any(words and words[-1] in MAIN for words in names.values()) else 4
    return Mark(_DIGITS.sub("0", min(found, key=lambda n: (len(n), n))), False, times)


def _kept(blocks: list[Block]) -> list[Block]:
    """The blocks without those whose marks are right.

    Blocks with the same marks are judged together, those with most text first. The marks are
    wrong if `main` lies inside them, or an article with more text than all that is kept, or
    if they hold more than `times` as much text as is kept: then they name a wrapper of the
    main text. If nothing is kept, only tags and roles count, not names.
    """
    sums: dict[tuple[Mark, ...], list] = {}
    plain = 0
    for b in blocks:
        if not b.marks:
            plain += b.own
        elif b.own:
            group = sums.setdefault(b.marks, [False, 0, {}])
            group[0] |= b.article < 0
            group[1] += b.own
            group[2][b.article] = group[2].get(b.article, 0) + b.own
    right = {b.marks for b in blocks if b.marks}
    for marks, (main, own, articles) in sorted(sums.items(), key=lambda g: (-g[1][0], -g[1][1], g[0])):
        times = max(m.times for m in marks)
        if any(not m.times and not m.aside for m in marks):
            continue
        article = max((n for a, n in articles.items() if a), default=0)
        if main or article > plain or not any(m.aside for m in marks) and own > times * plain:
            plain += own
            right -= {marks[:k] for k in range(1, len(marks) + 1)}
    if not right:
        return blocks
    kept = [b for b in blocks if b.marks not in right]
    if not kept and any(b.own and not any(m.aside for m in b.marks) for b in blocks):
        kept = [b for b in blocks if not any(m.aside for m in b.marks)]
    return kept


def parse(html: str, wanted: str | None = None) -> Page:
    """Blocks of a page; what holds the path `wanted` is not left out. Broken markup is read as browsers do, as far as blocks go: a block
    ends an open paragraph, an end tag without its start is passed over, and what is open at
    the end is closed."""
    page = Page()
    stack = [Node("", "", False, (), False)]
    held: list[str] = []
    linked = links = articles = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                # what is held stood before the elements never text that are open
                top = next(n for n in reversed(stack) if not n.out)
                page.blocks.append(Block(text, min(linked, len(text)), top.inside, top.marks, top.article, top.tag == "h1"))
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if not stack[-1].out:
            text = unescape(text) if "&" in text else text
            held.append(text)
            if links:
                linked += len(text)

    at = 0
    while True:
        found = _MARKUP.search(html, at)
        if found is None:
            add(html[at:])
            break
        if found.start() > at:
            add(html[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if tag is None:
            if found["cdata"]:
                add(found["cdata"].replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if found["end"]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag == "br" or tag == "p" and not any(n.tag == "p" for n in stack):
                held.append(" ")
            elif tag in BLOCKS or tag in ASIDE:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        if not stack[k].out:
                            flush()
                        del stack[k:]
                        break
                    if tag in TEXT_BLOCKS and stack[k].tag in CONTAINERS:
                        break
            continue
        if tag in RAW:
            end = _RAW_ENDS[tag].search(html, at)
            close = html.find(">", end.end()) if end else -1
            at = close + 1 if close >= 0 else len(html)
            continue
        if tag == "a":
            links += 1
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                held.append(" " if tag == "br" else "")
            continue
        if tag not in BLOCKS and tag not in ASIDE:
            continue
        if tag in BLOCKS:
            if not stack[-1].out:
                flush()
            links = 0
            if stack[-1].tag == "p":
                stack.pop()
            closes, within = ENDS.get(tag, ((), ()))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes:
                    if not stack[k].out:
                        flush()
                    del stack[k:]
                    break
                if stack[k].tag in within or not closes:
                    break
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(found["rest"])} if found["rest"].strip(" /") else {}
        top = stack[-1]
        path = f"{top.path}>{_label(tag, given)}"
        mark = top.out or _mark(tag, given, top.main)
        out, marks, article = mark is True, top.marks, top.article
        if isinstance(mark, Mark) and not (wanted and f"{wanted}>".startswith(f"{path}>")):
            marks, article = (*marks, mark), 0
        if tag == "main" or tag == "article" and article == 0:
            articles += 1
            article = -1 if tag == "main" else articles
        inside = (*top.inside, path) if tag in CONTAINERS and not out else top.inside
        stack.append(Node(tag, path, out, inside, top.main or tag in ("article", "main"), marks, article))
    flush()
    page.blocks = _kept(page.blocks)
    return page


def container_scores(page: Page) -> dict[str, float]:
    """Score of each container path: characters of its blocks that are not links, less with
    each level between, more for elements and names that stand for main text."""
    scores: dict[str, float] = {}
    for block in page.blocks:
        own = block.own
        for depth, path in enumerate(reversed(block.inside)):
            if own:
                scores[path] = scores.get(path, 0.0) + own * 0.8**depth
    for path in scores:
        tag, named = _stands_for_main(path)
        if tag in ("article", "main"):
            scores[path] *= 1.6
        elif named:
            scores[path] *= 1.3
    return scores


def _stands_for_main(path: str) -> tuple[str, bool]:
    """Tag of the last element of a path, and whether that or its names stand for main text."""
    last = path.rsplit(">", 1)[1]
    tag = re.split(r"[.#]", last, maxsplit=1)[0]
    return tag, tag in ("article", "main") or bool(MAIN & set(_NAME.findall(last[len(tag) :])))


def best_path(scores: dict[str, float]) -> str | None:
    return min(scores, key=lambda p: (-scores[p], len(p), p)) if scores else None


def _whole(page: Page, path: str) -> str:
    """The highest path above, or the path itself, that is main text as a whole.

    The enclosing article or main is. Other elements are whose further blocks are not mostly
    links, if they or their names stand for main text or a title is among those blocks; html
    and body are not.
    """
    chain = next(b.inside[: b.inside.index(path) + 1] for b in page.blocks if path in b.inside)
    length, linked, titles = ([0] * (len(chain) + 1) for _ in range(3))
    for b in page.blocks:
        # paths the block shares with the chain: the first ones
        shared = bisect_left(range(min(len(chain), len(b.inside))), True, key=lambda d: chain[d] != b.inside[d])
        length[shared] += len(b.text)
        linked[shared] += b.linked
        titles[shared] += b.title
    best = len(chain) - 1
    more = links = heads = 0
    enclosed = _stands_for_main(path)[0] in ("article", "main")
    for at in range(best - 1, -1, -1):
        more, links, heads = more + length[at + 1], links + linked[at + 1], heads + titles[at + 1]
        tag, named = _stands_for_main(chain[at])
        if tag in ("html", "body"):
            continue
        enclosing = tag in ("article", "main") and not enclosed
        if enclosing or 2 * links <= more and (named or heads):
            best, more, links, heads = at, 0, 0, 0
        enclosed |= tag in ("article", "main")
    return chain[best]


def text_at(page: Page, path: str | None, scores: dict[str, float]) -> str:
    """Text of the blocks under a path and under what it is the body of; under the page's own
    best one where the given path has less than a fifth of its score; all blocks kept if no
    container scores."""
    own = best_path(scores)
    if path is None or scores.get(path, 0.0) < 0.2 * scores.get(own or "", 0.0) or path not in scores:
        path = own
    if path is not None:
        path = _whole(page, path)
    return "\n".join(b.text for b in page.blocks if path is None or path in b.inside)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's scores as shares of a thousand, so that every page has one voice."""
    for batch in batches:
        sums: dict[tuple[str, str], int] = {}
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            scores = container_scores(parse(html or ""))
            total = sum(scores.values())
            for path, score in scores.items():
                sums[host, path] = sums.get((host, path), 0) + round(1000 * score / total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in sums], pa.string()), pa.array([p for _, p in sums], pa.string()), pa.array(list(sums.values()), pa.int64())],
            ["host", "path", "votes"],
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = parse(html or "", path)
            texts.append(text_at(page, path, container_scores(page)))
        added = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns[2:], *added], [*batch.schema.names[2:], "text", "n_chars"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, weight): the path of most votes on each host and the host's votes; ties
    go to the shorter path."""
    rows = pages.select(url_host(F.col("url")).alias("host"), "html")
    votes = rows.mapInArrow(_votes, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = F.max_by("path", F.struct("votes", -F.length("path"), "path"))
    return votes.groupBy("host").agg(best.alias("path"), F.sum("votes").alias("weight"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): page_id, url, text and n_chars.

    Blocks of the main text, each with white space turned into single spaces and trimmed, are
    joined by line feeds in page order. A null or empty html gives an empty text. Pages whose
    url is null or has no host vote together under an empty host. Repeated rows vote as often
    as they occur. Other columns are ignored; no rows give none.

    A host may hold any share of the pages. Hosts with more than a partition's share of the
    votes, of which there are fewer than partitions, meet their pages by a broadcast; only
    the pages of the others are shuffled by host.
    """
    rows = pages.select("html", url_host(F.col("url")).alias("host"), "page_id", "url")
    paths = cut_lineage(host_paths(pages))
    total = paths.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    large = F.col("weight") * parallelism(pages.sparkSession) > total
    hot, others = F.broadcast(paths.filter(large).select("host", "path")), paths.filter(~large).select("host", "path")
    placed = rows.join(hot, "host").unionByName(rows.join(hot, "host", "left_anti").join(others, "host", "left"))
    placed = placed.select("html", "path", "page_id", "url")
    kinds = dict(placed.dtypes)
    return placed.mapInArrow(_extract, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
