"""Main text of web pages by a tree-structured graphical model.

A page's block elements and its blocks of text are the nodes of a tree; each is main text or not.
The model has a potential between each parent and child (main text tends to stay inside its
element) and one between each node and what is seen of it: its tag, the words of its class, id and
role, and for a block of text its length, the share of it that is links, its ending and the class words
of the elements around it.  Sum-product
message passing, once from the leaves up and once from the root down, gives the exact marginal of
every node; blocks whose marginal is at least one half are the main text.

All potentials are frequencies from labelled pages.  Two kinds are counted: labelled pages written
for this module (``labelled_pages``), which show the parts that pages have, and up to about
``LABELLED_ROWS`` rows of the table itself (the documented bound of the sample, picked by a hash of
the page) whose markup says where the article is.  The counts are summed in Spark; what
reaches the driver is one row for each tag and class word of that sample.

Markup that never is text (scripts, styles, form controls, the head) is left out beforehand.
Character references are decoded, white space inside a block becomes one space, blocks are joined
in page order by a line feed.

Null html is empty; a page without main text gives an empty text.  Null ids and repeated rows are
ordinary pages.  Other columns of the input are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .registry import named, table

LABELLED_ROWS = 500
#: How many occurrences a page of this module counts for beside one of the table.
SEED_WEIGHT = 5
# Tags of the HTML standard by what they do to text.
UNREAD = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video select option optgroup "
    "button textarea datalist label legend".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul caption".split()
)
#: Start tags that end an open element of these tags.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
}
#: Where the search for such an element stops.
_SCOPE = frozenset("html body table ul ol dl td th article section div main nav aside header footer form blockquote".split())
#: Elements that leave the head of a page open; any other element, and text, ends it.
HEAD = frozenset("html head title base basefont link meta script style noscript template object".split())
#: Words of class names: runs of letters, cut where a capital follows a small letter.
_CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: How many named elements around it a block of text is seen with.
SCOPE = 3
_COMMENT_NAMES = (
    "comments comment-list commentlist disqus_thread respond replies responses discussion reader-comments "
    "user-comments feedback fb-comments commentsSection post-comments"
).split()


def class_words(names: str) -> list[str]:
    """The distinct words of names, without a plural's ending."""
    words = [w.lower() for w in _CLASS_WORD.findall(names)]
    return list(dict.fromkeys(w[:-3] + "y" if w.endswith("ies") and len(w) > 4 else w[:-1] if w.endswith("s") and len(w) > 3 else w for w in words))


class Page(HTMLParser):
    """The tree of a page: for each node its parent, what is seen of it, and its text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parents, self.seen, self.texts, self.labels = [-1], [["tag=#page"]], [None], [0]
        self.scopes: list[tuple[list[str], ...]] = [()]  # class words of the nearest ``SCOPE`` named elements
        self.open: list[tuple[str, int]] = [("#page", 0)]  # tags, and the node that holds their text
        self.unread = 0
        self.buffer: list[str] = []
        self.linked = self.links = 0
        self.feed(html)
        self.close()
        self.flush()

    def flush(self) -> None:
        """End a block of text."""
        raw = "".join(self.buffer)
        text = " ".join(raw.split())
        if text:
            n, ratio = len(text.split()), self.linked / max(1, len(raw))
            scope = self.scopes[self.open[-1][1]]
            self.parents.append(self.open[-1][1])
            self.scopes.append(scope)
            self.seen.append(
                [
                    *dict.fromkeys(f"in={w}" for words in scope for w in words),
                    f"words={min(6, n.bit_length())}",
                    f"linked={0 if ratio < 0.1 else 1 if ratio < 0.6 else 2}",
                    f"stop={int(text[-1] in '.!?:;…')}",
                ]
            )
            self.texts.append(text)
            self.labels.append(self.labels[self.open[-1][1]])
        self.buffer, self.linked = [], 0

    def end_head(self) -> None:
        """A head that was never closed ends with the first thing that cannot be in it."""
        if len(self.open) < 4 and self.open[-1][0] == "head":
            self.pop_to(len(self.open) - 1)

    def pop_to(self, depth: int) -> None:
        """Close the open elements from ``depth`` on."""
        if any(t in BLOCK for t, _ in self.open[depth:]):
            self.flush()
        for t, _ in self.open[depth:]:
            self.unread -= t in UNREAD
            self.links -= t == "a"
        del self.open[depth:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.buffer.append(" ")
        if tag in VOID:
            if tag in BLOCK:
                self.flush()
            return
        if tag not in HEAD:
            self.end_head()
        closes = ENDS.get(tag, {"p"} if tag in BLOCK else ())
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in closes:
                self.pop_to(i)
                break
            if self.open[i][0] in _SCOPE:
                break
        node = self.open[-1][1]
        if tag in BLOCK:
            self.flush()
            own = dict(attrs)
            words = class_words(" ".join(str(own.get(k) or "") for k in ("class", "id", "role")))
            label = own.get("data-main")
            self.parents.append(node)
            self.scopes.append((words, *self.scopes[node][: SCOPE - 1]) if words else self.scopes[node])
            self.seen.append([f"tag={tag}", *[f"class={w}" for w in words]])
            self.texts.append(None)
            self.labels.append(self.labels[node] if label is None else int(label))
            node = len(self.parents) - 1
        self.unread += tag in UNREAD
        self.links += tag == "a"
        self.open.append((tag, node))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.pop_to(i)
                return
            if tag not in BLOCK and self.open[i][0] in BLOCK:
                return

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self.end_head()
        if not self.unread:
            self.buffer.append(data)
            if self.links:
                self.linked += len(data)

    def relabel(self) -> bool:
        """Label the nodes by the page's own markup: inside the one article, but for what is marked
        as something else.  False if the markup does not say."""
        article = [i for i, s in enumerate(self.seen) if s[0] in ("tag=article", "tag=main")]
        article = [i for i in article if not any(self.inside(i, j) for j in article if j != i)]
        if len(article) != 1:
            return False
        other = {"tag=nav", "tag=aside", "tag=footer", "tag=form"}
        for i, s in enumerate(self.seen):
            p = self.parents[i]
            self.labels[i] = int(i == article[0] or (p >= 0 and self.labels[p] and s[0] not in other))
        return True

    def inside(self, node: int, other: int) -> bool:
        while node > other:
            node = self.parents[node]
        return node == other


def page_counts(page: Page) -> Counter:
    """How often each label, parent-child pair of labels, and label with what is seen occur."""
    found: Counter = Counter()
    for i, seen in enumerate(page.seen):
        y, kind = page.labels[i], "text" if page.texts[i] is not None else "element"
        found[f"{kind} {y}"] += 1
        if i:
            found[f"{kind} {page.labels[page.parents[i]]}>{y}"] += 1
        for s in seen:
            found[f"{s} {y}"] += 1
    return found


class Model:
    """Potentials, as logarithms, from the counts."""

    def __init__(self, counts: dict[str, float]):
        get = lambda k: counts.get(k, 0.0)
        self.pair = {
            kind: [
                [math.log((get(f"{kind} {p}>{y}") + 1) / (sum(get(f"{kind} {p}>{z}") for z in (0, 1)) + 2)) for y in (0, 1)]
                for p in (0, 1)
            ]
            for kind in ("text", "element")
        }
        self.node: dict[str, tuple[float, float]] = {}
        for s in {k.rsplit(" ", 1)[0] for k in counts if "=" in k}:
            kind = "element" if s.startswith(("tag=", "class=")) else "text"
            self.node[s] = tuple(math.log((get(f"{s} {y}") + 0.2) / (get(f"{kind} {y}") + 2)) for y in (0, 1))

    def marginals(self, page: Page) -> list[float]:
        """Each node's probability to be main text, by messages up and then down the tree."""
        n = len(page.parents)
        up = [[0.0, 0.0] for _ in range(n)]  # what is seen below and at a node, for each of its labels
        sent = [[0.0, 0.0] for _ in range(n)]  # its message to its parent, for each label of that
        pair = [self.pair["text" if t is not None else "element"] for t in page.texts]
        for i in range(n - 1, -1, -1):
            a, b = up[i]
            for s in page.seen[i]:
                if s in self.node:
                    x, y = self.node[s]
                    a, b = a + x, b + y
            up[i] = [a, b]
            if i:
                p = up[page.parents[i]]
                sent[i] = [_add(t[0] + a, t[1] + b) for t in pair[i]]
                p[0] += sent[i][0]
                p[1] += sent[i][1]
        down = [[0.0, 0.0] for _ in range(n)]
        out = [0.0] * n
        down[0] = [math.log(0.99), math.log(0.01)]  # the page as a whole is not main text
        for i in range(n):
            if i:
                p = page.parents[i]
                rest = [down[p][y] + up[p][y] - sent[i][y] for y in (0, 1)]
                down[i] = [_add(rest[0] + pair[i][0][y], rest[1] + pair[i][1][y]) for y in (0, 1)]
            a, b = down[i][0] + up[i][0], down[i][1] + up[i][1]
            out[i] = 1 / (1 + math.exp(min(700.0, a - b)))
        return out

    def text(self, html: str | None) -> str:
        page = Page(html or "")
        main = self.marginals(page)
        return "\n".join(t for t, m in zip(page.texts, main, strict=True) if t is not None and m >= 0.5)


def _add(a: float, b: float) -> float:
    """Logarithm of a sum."""
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a))


def labelled_pages() -> list[str]:
    """Small pages with the parts that pages have; data-main says what is main text."""
    long = "The words of an article run on for a while, with commas and a full stop at the end of it. " * 4
    mid = "A shorter paragraph of the article, still a whole sentence."
    title = "What the article is about"
    article = (
        f"<h1>{title}</h1><p>{long}</p><h2>Part</h2><p>{mid}</p><ul><li>{mid}</li><li>Point</li></ul><blockquote>{long}"
        f"</blockquote><p>Short.</p><pre>code line</pre><table><tr><td>1</td><td>Two words.</td></tr></table><p>{long}</p>"
    )
    links = "".join(f"<li><a href=x>{w}</a></li>" for w in ("Home", "News", "About us", "Contact", "More of it"))
    wraps = [
        f"<article data-main=1>{article}</article>",
        f"<main data-main=1>{article}</main>",
        f"<main data-main=1><article>{article}</article></main>",
        f'<div id=content class="main content" data-main=1>{article}</div>',
        f'<div class="post entry article" data-main=1><div class="body text story">{article}</div></div>',
        f'<article data-main=1><header><h1>{title}</h1></header><section>{article}</section></article>',
        f"<section data-main=1>{article}</section>",
    ]
    tops = [
        f"<header data-main=0><h1>The site</h1><p>News every day.</p><nav><ul>{links}</ul></nav></header>",
        f'<nav data-main=0><ul>{links}</ul></nav><div class="ad ads advert advertisement banner" data-main=0>Buy now. {mid}</div>',
        f'<div id=header class="top masthead site" data-main=0><ul class="menu navigation">{links}</ul></div>',
        f'<div class="cookie notice consent alert banner" data-main=0><p>We use cookies. {mid}</p></div>'
        f'<div class="menu navbar breadcrumb breadcrumbs" data-main=0><ul>{links}</ul></div>',
    ]
    ends = [
        f"<footer data-main=0><p>Copyright. All rights reserved. {mid}</p><ul>{links}</ul></footer>",
        f'<aside data-main=0><h3>Related</h3><ul>{links}</ul><p>{mid}</p></aside><footer data-main=0>&copy; a site. {mid}</footer>',
        f'<div id=comments class="comments comment list" data-main=0><h3>Comments</h3><div class="comment reply"><p>{long}</p></div>'
        f'<div class="comment"><p>{mid}</p></div><form><p>Leave a reply</p></form></div><footer data-main=0>Imprint</footer>',
        f'<section class="comments discussion responses" data-main=0><article class=comment><p>{long}</p></article><ol><li class=comment><p>{mid}</p></li></ol></section>'
        f'<div id=footer class="bottom legal copyright" data-main=0><p>{mid}</p></div>',
        f'<div id=sidebar class="sidebar widget related promo sponsored" data-main=0><h3>Popular</h3><p>{mid}</p><ul>{links}</ul></div>'
        f'<form class="newsletter subscribe search login signup" data-main=0><p>Subscribe to our letter. {mid}</p></form>',
        f'<div class="share social tags author meta pagination pager" data-main=0><ul>{links}</ul></div>'
        f'<div class="popup modal overlay disclaimer notice" role=dialog data-main=0><p>{long}</p></div>',
    ]
    said = f"<p>{mid}</p>", f"<p>{long}</p>", f"<h3>3 comments</h3><div class=comment><b>A reader</b><p>{mid}</p><a href=x>Reply</a></div><p>{long}</p>"
    comments = []
    for i, name in enumerate(_COMMENT_NAMES):
        text = said[i % 3]
        comments += [
            f"<div id={name} data-main=0>{text}</div>",
            f'<section class="{name}" data-main=0>{text}</section>',
            f'<div class="{name}" data-main=0><ol><li class="comment-body">{text}</li><li>{said[(i + 1) % 3]}</li></ol></div>',
            f'<div class="{name}" data-main=0>{text}</div><footer data-main=0>Imprint. {mid}</footer>',
        ]
    pages = [f"<html><body>{a}{m}{e}</body></html>" for a, m, e in product(tops, wraps, ends)]
    pages += [f"<html><body>{tops[i % 5 - 1] if i % 5 else ''}{m}{c}</body></html>" for i, (c, m) in enumerate(product(comments, wraps))]
    pages += [f"<html><body><article data-main=1>{article}{c}</article></body></html>" for c in comments]
    pages += [f'<html><body>{tops[i % 4]}<div class="main content" data-main=1>{article}{c}</div></body></html>' for i, c in enumerate(comments)]
    pages += [f"<html><body>{m}{e}</body></html>" for m, e in product(wraps, ends)]
    inner = (
        '<div class="ad advert promo" data-main=0><p>Buy now.</p></div><aside data-main=0><p>{0}</p></aside><nav data-main=0><ul>{1}</ul></nav>'
        '<form data-main=0><p>Sign up</p></form><footer data-main=0><p>Filed under news</p></footer>'
        '<div class="comments" data-main=0><p>{0}</p></div><div class="share related" data-main=0><ul>{1}</ul></div>'
    ).format(mid, links)
    pages += [f"<html><body>{a}<article data-main=1>{article}{inner}<p>{long}</p></article>{e}</body></html>" for a, e in product(tops, ends)]
    pages += [f"<html><body><div data-main=1>{article}</div></body></html>", f"<html><body data-main=1>{article}</body></html>"] * 12
    return pages


def count_labelled(df: DataFrame, page_id: str, html: str, rows: int) -> dict[str, float]:
    """Counts over the labelled pages of this module and a sample of the table."""
    total: Counter = Counter()
    for page in labelled_pages():
        for k, v in page_counts(Page(page)).items():
            total[k] += v * SEED_WEIGHT / 10
    n = df.count()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for x in batch.column(0).to_pylist():
                page = Page(x)
                if page.relabel():
                    found += page_counts(page)
        yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array(list(found.values()), pa.int64())], ["what", "n"])

    share = min(1_000_000, int(1_000_000 * rows / max(1, n)))
    # The hash is of the whole row, so that it bounds the sample also where ids are null or repeated; equal rows count once.
    drawn = df.filter(F.col(html).isNotNull()).select(F.xxhash64(page_id, html).alias("drawn"), F.col(html).cast("string").alias("html"))
    sample = drawn.filter(F.pmod("drawn", F.lit(1_000_000)) < share).dropDuplicates(["drawn"])
    counted = sample.select("html").mapInArrow(count, "what string, n long").groupBy("what").agg(F.sum("n").alias("n"))
    for r in counted.collect():
        total[r["what"]] += r["n"]
    return dict(total)


def extract(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    model = Model(count_labelled(df, page_id, html, labelled_rows))
    pages = df.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    schema = T.StructType([*pages.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                schema.names,
            )

    return pages.mapInArrow(read, schema)


@named("op2_extract")
def op2_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
