import html as entities
import re

from ledgerloom.llm import extraction
from ledgerloom.llm.catalog import QUERIES

SCHEMA = "page_id long, url string, html string, text string"


def expected(page):
    """What the generated pages say, by their fixed form."""
    article = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S).group(1).replace("<br>", " ")
    blocks = re.split(r"</?(?:h1|p|div|ul|li)[^>]*>", article)
    return "\n".join(x for x in (" ".join(entities.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks) if x)


def test_all_pages(spark, folder):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op2_extract"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == expected(pages[r["page_id"]])
        assert r["n_chars"] == len(r["text"])


def test_labelled_pages_come_back():
    """Trained on three quarters of the labelled pages, the model finds the main text of the rest."""
    pages = [extraction.Page(p) for p in extraction.labelled_pages()]
    total = extraction.Counter()
    for i, p in enumerate(pages):
        if i % 4:
            total += extraction.page_counts(p)
    model, right, n = extraction.Model(total), 0, 0
    for p in pages[::4]:
        for t, y, m in zip(p.texts, p.labels, model.marginals(p)):
            if t is not None:
                n += 1
                right += (m >= 0.5) == bool(y)
    assert right / n > 0.98


def test_marginals_are_exact():
    """Against the sum over all labellings of a small tree."""
    from itertools import product
    from math import exp, isclose, log

    page = extraction.Page("<body><nav><p>Menu</p></nav><article><p>Words of it.</p></article></body>")
    model = extraction.Model(dict(extraction.page_counts(extraction.Page(extraction.labelled_pages()[0]))))
    n, total, ones = len(page.parents), 0.0, [0.0] * len(page.parents)
    for y in product((0, 1), repeat=n):
        s = log((0.99, 0.01)[y[0]])
        for i in range(n):
            s += sum(model.node[x][y[i]] for x in page.seen[i] if x in model.node)
            if i:
                s += model.pair["text" if page.texts[i] is not None else "element"][y[page.parents[i]]][y[i]]
        total += exp(s)
        for i in range(n):
            ones[i] += exp(s) * y[i]
    assert all(isclose(a / total, b, rel_tol=1e-9) for a, b in zip(ones, model.marginals(page)))


def test_odd_pages(spark):
    body = "<p>" + "A sentence of the article, long enough to be one. " * 5 + "</p>"
    pages = [
        (1, None),
        (2, ""),
        (3, f"<article><h1>T &amp; U</h1>{body}<p>x &lt;b&gt;\n\n y&nbsp;z<br>w</p></article><script>var a='<p>no</p>'</script>"),
        (4, f"<div class='content'>{body}</div><div class='comments'><p>A reader says a thing.</p></div>"),
        (5, "<<<>>> & <p"),
        (6, "<div>" * 3000 + "deep"),
        (None, f"<main>{body}</main><form><p>Mail</p><input><button>Go</button></form>"),
    ]
    df = spark.createDataFrame([(i, "u", h, "clash") for i, h in pages], SCHEMA)
    got = {r["page_id"]: r["text"] for r in extraction.extract(df).collect()}
    assert got[1] == got[2] == "" and len(got) == 7
    assert got[3].split("\n")[0] == "T & U" and got[3].endswith("x <b> y z w")
    assert "reader" not in got[4] and got[4].startswith("A sentence")
    assert "Mail" not in got[None] and "Go" not in got[None]
    assert extraction.extract(df.filter("false")).count() == 0


SENTENCE = "A sentence of the article, long enough to be one. "
WHOLE = f"<p>{SENTENCE * 5}</p><p>{SENTENCE * 3}</p>"
SAID = "<p>A reader says a thing, and goes on about it.</p>"


def test_reader_comments_go():
    """By many names, with and without an article element, by the pages of the module alone."""
    total = extraction.Counter()
    for p in extraction.labelled_pages():
        total += extraction.page_counts(extraction.Page(p))
    model = extraction.Model(total)
    for name in ("comments", "disqus_thread", "replies", "commentlist", "reader-comments", "userComments", "reply-list", "feedback"):
        for main in (f"<article>{WHOLE}</article>", f"<div class=content>{WHOLE}</div>", f"<div id=main><h2>Title</h2>{WHOLE}</div>"):
            for said in (f"<div id='{name}'>{SAID}</div>", f"<section class='{name}'><ol><li>{SAID}</li></ol></section>"):
                text = model.text(f"<html><body>{main}{said}</body></html>")
                assert "reader" not in text and text.endswith(SENTENCE.strip())


def test_pages_without_body_and_long_or_repeated_pages(spark):
    open_head = f"<html><head><title>T</title><meta charset=utf-8>{WHOLE}"
    loose = f"<head><title>x</title>Some words that come without any element, long enough to be read as a sentence. {WHOLE}"
    long = f"<article>{WHOLE * 3000}</article><footer>Imprint</footer>"
    rows = [(1, open_head), (2, loose), (3, long), (3, long), (None, open_head), (4, f"<body><!-- <head> --><article>{WHOLE}</article></body>")]
    df = spark.createDataFrame([(i, "u", h, "clash") for i, h in rows], SCHEMA)
    got = sorted(((r["page_id"], r["text"]) for r in extraction.extract(df).collect()), key=str)
    texts = dict(got)
    assert len(got) == 6 and all(SENTENCE.strip() in t for t in texts.values())
    assert texts[1] == texts[None] and "T" not in texts[1].split("\n")
    assert texts[3].count("A sentence") == 24_000 and "Imprint" not in texts[3] and got.count((3, texts[3])) == 2
