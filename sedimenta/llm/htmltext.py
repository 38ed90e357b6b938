"""Operator 5: main text of web pages by a conditional random field over blocks.

A page is read into its leaf blocks in order: runs of text between block-level
tags, with the tags, class and id words of their ancestors.  A linear chain
with features of ancestors and text labels each block article or not, decoded
by Viterbi.

The chain is trained on labelled pages: pages composed of known parts
(``compose``), filled with sentences of up to ``SAMPLE`` pages of the table,
and these pages themselves, labelled by their own ``article`` elements.
"""

from __future__ import annotations

import html
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import crf
from sedimenta.llm.store import column

# Pages of the table that training uses, and composed pages.
SAMPLE = 200
COMPOSED = 500

# A quote opens a value only behind ``=``; elsewhere it is a character like any other.
_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)|[^>=]|=)*+)>|<(?:/?[a-zA-Z!?][^>]*)?\Z", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|data-part)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_BLANK = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# No text of these counts; the first are raw text up to their closing tag, the others nest.
RAW = frozenset("script style noscript title iframe textarea".split())
SILENT = RAW | frozenset("template svg object select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub "
    "sup time tt u var".split())
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split())
#: one feature per group of ancestor tags
TAGS = ("article", "main", "section", "nav", "header", "footer", "aside", "form fieldset button", "figure figcaption", "table",
        "ul ol dl", "li dd dt", "h1", "h2 h3 h4 h5 h6", "p", "blockquote", "pre", "div", "address", "label")
#: one feature per group of words in class, id and role of ancestors
NAMES = (
    "ad ads advert advertisement advertising sponsor sponsored promo promotion banner",
    "nav navigation navbar menu breadcrumb breadcrumbs crumbs pagination pager tabs toc skip",
    "sidebar side aside widget complementary rail",
    "related recommended recommendations trending popular more teaser",
    "comment comments reply replies respond discussion disqus thread",
    "cookie cookies notice consent gdpr alert popup modal overlay warning message",
    "newsletter subscribe signup login search form contact",
    "footer foot copyright legal contentinfo colophon bottom",
    "header head masthead logo branding top",
    "share social follow tags tag meta author bio byline",
    "content article post entry main story text body")
TAG_AT = {t: i for i, group in enumerate(TAGS) for t in group.split()}
NAME_AT = {t: i for i, group in enumerate(NAMES) for t in group.split()}
TEXT = 9
WIDTH = len(TAGS) * 2 + len(NAMES) + TEXT


def blocks(page: str) -> list[tuple[str, tuple, tuple, float, str | None]]:
    """(text, ancestor tags, name groups, share of text in links, part) per leaf block."""
    out, stack, buffer, linked = [], [], [], [0]

    def flush():
        text = _BLANK.sub(" ", html.unescape("".join(buffer))).strip()
        buffer.clear()
        if text:
            tags = tuple(e[0] for e in stack)
            names = frozenset(n for e in stack for n in e[1])
            part = next((e[2] for e in reversed(stack) if e[2] is not None), None)
            out.append((text, tags, names, min(1.0, linked[0] / len(text)), part))
        linked[0] = 0

    def say(text):
        if text:
            buffer.append(text)
            if any(e[0] == "a" for e in stack):
                linked[0] += len(text)

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in SILENT:
            if not closing:
                at = _after(page, at, tag, m[3])
                buffer.append(" " if tag in ("textarea", "select") else "")
            continue
        if tag == "br" or tag == "img" or tag == "wbr":
            if tag == "br":
                buffer.append(" ")
            continue
        if tag in INLINE:
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i]
                        break
                    if stack[i][0] not in INLINE:
                        break
            else:
                stack.append((tag, *_named(m[3])))
            continue
        flush()
        if tag in VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag in ENDS_P:
            _close(stack, ("p",))
        elif tag in ("li", "dd", "dt", "td", "th", "tr", "option"):
            _close(stack, {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"),
                           "tr": ("tr", "td", "th"), "option": ("option",)}[tag])
        stack.append((tag, *_named(m[3])))
    flush()
    return out


def _after(page: str, at: int, tag: str, attributes: str) -> int:
    """Where a silent element that opens before ``at`` ends."""
    if tag in RAW:
        close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
        return close.end() if close else len(page)
    if tag in ("svg", "object") and attributes.endswith("/"):
        return at
    begin, depth = at, 1
    while depth:
        m = _TAG.search(page, at)
        if m is None:
            # Never closed: only the tag is left out.
            return begin
        at = m.end()
        inner = (m[2] or "").lower()
        if inner in RAW and not m[1] and not (tag == "svg" and m[3].endswith("/")):
            at = _after(page, at, inner, m[3])
        elif inner == tag and m[1]:
            depth -= 1
        elif inner == tag and not (m[3].endswith("/") and tag in ("svg", "object")):
            depth += 1
    return at


_STOP = frozenset("ul ol dl table article section div main aside nav header footer form body td th".split())


def _close(stack: list, tags: tuple) -> None:
    """End an open element of these kinds, unless another container is open inside it."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in tags:
            del stack[i:]
            return
        if stack[i][0] in _STOP:
            return


def _named(attributes: str) -> tuple[tuple, str | None]:
    if "=" not in attributes:
        return (), None
    groups, part = [], None
    for m in _ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "data-part":
            part = value
            continue
        groups += [NAME_AT[w] for w in map(str.lower, _NAME.findall(value)) if w in NAME_AT]
    return tuple(groups), part


def features(found: list) -> np.ndarray:
    x = np.zeros((len(found), WIDTH))
    wide = len(TAGS)
    for row, (text, tags, names, links, _) in zip(x, found):
        for t in tags:
            if t in TAG_AT:
                row[TAG_AT[t]] = 1
        near = next((t for t in reversed(tags) if t in TAG_AT and t not in INLINE), None)
        if near is not None:
            row[wide + TAG_AT[near]] = 1
        for n in names:
            row[2 * wide + n] = 1
        n = text.count(" ") + 1
        row[-TEXT:] = (
            np.log1p(n), links, text[-1] in ".!?\"'»”", text[0].isupper(), n < 4, "©" in text or "(c)" in text,
            text.count("|") > 1, sum(c in ".,;" for c in text) / n, len(text) / n / 10)
    return x


def article_text(found: list, labels: np.ndarray) -> str:
    return "\n\n".join(b[0] for b, y in zip(found, labels) if y == 1)


def compose(sentences: list[str], seed: int) -> str:
    """A labelled page: ``data-part`` is 1 on article parts and 0 elsewhere."""
    rng = np.random.Generator(np.random.PCG64(seed))
    pick = lambda options: options[int(rng.integers(len(options)))]
    chance = lambda p: rng.random() < p
    some = lambda lo, hi: " ".join(pick(sentences) for _ in range(int(rng.integers(lo, hi + 1))))
    words = lambda lo, hi: " ".join(some(2, 3).split()[:int(rng.integers(lo, hi + 1))]) or "x"
    link = lambda: f'<a href="/{words(1, 1)}">{words(1, 4)}</a>'

    def box(part, tags, names, inner):
        tag = pick(tags)
        mark = f' {pick(("class", "class", "id"))}="{pick(names)}"' if names and (tag == "div" or chance(0.5)) else ""
        return f'<{tag}{mark} data-part="{part}">{inner}</{tag}>'

    def listing(n):
        return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>"

    def prose(n):
        return "".join(f"<p>{some(1, 4)}</p>" for _ in range(n))

    extras = {
        "nav": lambda: box(0, ("nav", "div"), ("nav", "menu", "navbar", "main-menu", "breadcrumbs", "navigation"), listing(int(rng.integers(3, 9)))),
        "header": lambda: box(0, ("header", "div"), ("header", "masthead", "site-header", "logo", "top"), pick((
            f"<p>{words(2, 8)}</p>", f"<div>{words(1, 4)}</div>{listing(3)}", f"<h1>{words(1, 4)}</h1><p>{some(1, 1)}</p>"))),
        "ad": lambda: box(0, ("div", "aside", "section"), ("ad", "ads", "advert", "advertisement", "sponsored", "banner", "promo"), pick((
            some(1, 3), prose(1), f"<p>{words(3, 9)}</p>{link()}", f"<h3>{words(2, 5)}</h3><p>{some(1, 2)}</p>"))),
        "side": lambda: box(0, ("aside", "div"), ("sidebar", "side", "widget", "related", "recommended", "popular", "trending"), pick((
            f"<h3>{words(1, 4)}</h3>{listing(5)}", f"<h4>{words(1, 3)}</h4>{prose(1)}", prose(2), listing(4)))),
        "notice": lambda: box(0, ("div", "section", "aside"), ("cookie", "cookie-notice", "notice", "consent", "alert", "popup", "modal"), pick((
            some(1, 2), f"<p>{some(1, 2)}</p><button>{words(1, 2)}</button>"))),
        "form": lambda: box(0, ("form",), ("newsletter", "search", "login", "contact", "subscribe", "signup"),
                            f"<label>{words(1, 3)}</label><input name=q><p>{some(1, 1)}</p><button>{words(1, 2)}</button>"),
        "share": lambda: box(0, ("div", "ul"), ("share", "social", "tags", "meta"), link() + " " + link()),
        "comments": lambda: box(0, ("section", "div", "aside"), ("comments", "comment-list", "discussion", "replies"), (
            f"<h3>{words(1, 3)}</h3>" + "".join(
                box(0, ("div", "article", "li", "p"), ("comment", "reply", "comment-body"), pick((some(1, 3), f"<b>{words(1, 2)}</b> {some(1, 2)}")))
                if chance(0.6) else prose(1) for _ in range(int(rng.integers(1, 6)))))),
        "footer": lambda: box(0, ("footer", "div"), ("footer", "site-footer", "copyright", "legal"), pick((
            f"&copy; {words(1, 3)} &middot; {some(1, 1)}", f"<p>{some(1, 2)}</p>{listing(3)}", some(1, 2)))),
    }

    def article():
        parts = [f"<h1>{words(2, 12)}</h1>"] if chance(0.85) else []
        if chance(0.2):
            parts = [f'<header>{"".join(parts)}</header>']
        for _ in range(int(rng.integers(1, 14))):
            parts.append(pick((
                f"<p>{some(1, 6)}</p>", f"<p>{some(1, 6)}</p>", f"<p>{some(1, 6)}</p>", f"<p>{words(1, 6)}</p>", f"<p><b>{some(1, 1)}<br>",
                f"<h2>{words(1, 8)}</h2>", f"<h3>{words(1, 6)}</h3>", f"<blockquote>{some(1, 3)}</blockquote>", f"<pre>{some(1, 1)}</pre>",
                "<ul>" + "".join(f"<li>{some(1, 1)}</li>" for _ in range(3)) + "</ul>", f"<div>{some(1, 4)}</div>",
                f"<p>{some(1, 2)} {link()} {some(1, 2)}</p>", f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>")))
            if chance(0.12):
                parts.append(extras[pick(("ad", "side", "share", "form", "notice"))]())
        if chance(0.1):
            parts.append(extras["comments"]())
        inner = "".join(parts)
        return box(1, ("article", "article", "main", "div", "section"), ("content", "post", "entry-content", "article-body", "story", "main"), inner)

    order = [k for k in ("header", "nav", "notice", "ad", "side") if chance(0.5)]
    after = [k for k in ("share", "ad", "side", "form", "comments") if chance(0.4)] + ["footer"] * chance(0.8)
    body = "".join(extras[k]() for k in order) + article() + "".join(extras[k]() for k in after)
    if chance(0.3):
        body = f'<div class="{pick(("wrapper", "page", "container", "site"))}">{body}</div>'
    return f"<html><head><title>{words(1, 6)}</title></head><body>{body}</body></html>"


def train(pages: list[str]) -> crf.Chain:
    """Chain from composed pages and from given pages with ``article`` elements."""
    sentences = [s for p in pages for b in blocks(p) for s in re.findall(r"[^.!?]+[.!?]+", b[0])[:20]][:20_000]
    sentences = [s.strip() for s in sentences if s.strip()] or ["Some words stand here.", "More of them follow, as they do."]
    x, y, first = [], [], [0]
    composed = [blocks(compose(sentences, seed)) for seed in range(COMPOSED)]
    given = [[(*b[:4], "1" if "article" in b[1] else "0") for b in blocks(p)] for p in pages if "<article" in p]
    for found in composed + given:
        if found:
            x.append(features(found))
            y += [int(b[4] == "1") for b in found]
            first.append(first[-1] + len(found))
    return crf.train(np.concatenate(x), np.array(y), np.array(first), rounds=200)


def _extract(batches, shared):
    chain = shared.value
    for batch in batches:
        text, size = [], []
        for i in range(batch.num_rows):
            found = blocks(batch.column(2)[i].as_py() or "")
            labels = chain.decode(features(found), np.array([0, len(found)])) if found else []
            text.append(article_text(found, labels))
            size.append(len(text[-1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(size, pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages(page_id, url, html)``.

    Blocks of the article in page order, white space folded to one space,
    joined by two line breaks.  NULL and empty pages, and pages without an
    article, give an empty text.  Pages are read one by one: repeated rows and
    NULL ids or addresses are passed on; other columns are ignored.
    """
    rows = pages.select(
        column(pages, "page_id", "long").alias("page_id"), column(pages, "url", "string").alias("url"),
        column(pages, "html", "string").alias("html"))
    # A bounded sample; very long pages would not teach more.
    ids = rows.filter("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    known = rows.join(F.broadcast(ids), "page_id", "left_semi").select("page_id", F.substring("html", 1, 50_000).alias("html"))
    seen = dict((r.page_id, r.html) for r in known.orderBy("page_id", "html").collect() if r.html)
    shared = pages.sparkSession.sparkContext.broadcast(train([seen[k] for k in sorted(seen)]))
    return rows.mapInArrow(partial(_extract, shared=shared), "page_id long, url string, text string, n_chars long")
