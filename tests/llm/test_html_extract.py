"""Main text of pages: the page reader by cases, the host's suffix array against a test of every pair of suffixes."""

import random

import pytest
from tests.llm import brute

from faunatally.llm import html_extract as he
from faunatally.llm.page_parse import blocks

PAGES = "page_id long, url string, html string, host string, start int, content string, found string"


def words(draw, n, prefix=""):
    return " ".join(prefix + "".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n))


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("no markup at all\n\n here", "no markup at all here"),
        ("<article><h1>T &amp; u</h1><p>a<b>b</b>\n c<br>d<p>e&nbsp;f &#233;&eacute &am</article>", "T & u\n\nab c d\n\ne f éé &am"),
        ("<nav>n</nav><article><p><b>x<br><p>y</p></article><footer>f", "x\n\ny"),
        ("<article><p>one<aside>no</aside><form><p>no</form><script>'<p>'</script><style>p{}</style><p>two</article>", "one\n\ntwo"),
        ("<article><p>one</p><div class='ad-slot'>no</div><section id=comments><article><p>no</article></section></article>", "one"),
        ("<article class=post><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\n\nb\n\nc\n\nd"),
        ("<body class='has-sidebar menu'><div id=header>no</div><div class='cookie-notice'>no</div><main><p>m</main><p>no", "m"),
        ("<div role=navigation>no</div><div class='entry-content'><p>c</div><p>outside", "c"),
        ("<P HIDDEN>no</P><p style='Display: none'>no</p><p>yes<!-- no --><![CDATA[ too]]>", "yes too"),
        ("<a href=\"x>y\">t</a> u <i title='v", "t u"),
        ("<p>5 < 6 & 7 > 2", "5 < 6 & 7 > 2"),
        ("<textarea>no</textarea><noscript>no</noscript><select><option>no</select><p>x<script>never closed <p>no", "x"),
        ("</p></div></article>stray<article>in</div></article>", "in"),
    ],
)
def test_page_reader(page, text):
    assert he.Page("http://h/", page).text() == text


def test_page_reader_is_linear_in_hostile_pages():
    for page in ("<div>" * 100_000 + "x</p>" * 100_000, "<p a='b" * 30_000, "<" * 200_000, "<!--" * 50_000, "<b>" * 100_000 + "x"):
        blocks(page)


def test_hosts():
    urls = {"http://A.example.com:80/x": "a.example.com", "https://u:p@b.org?q": "b.org", " ftp://c#d": "c", "nothing": "", "": "", None: ""}
    assert {u: he.host_of(u) for u in urls} == urls


def template_pages(seed, pages=30):
    """Pages of two hosts without telling markup, with what their main text is."""
    draw = random.Random(seed)
    out = []
    for host in ("one.example", "two.example"):
        notice, tail = words(draw, 14, host[0]), words(draw, 100, host[1])
        menu = "".join(f"<li>{words(draw, 1)} {words(draw, 1)}" for _ in range(6))
        for k in range(pages):
            paragraphs = [words(draw, draw.randint(3, 90)) for _ in range(draw.randint(1, 5))]
            body = "".join(f"<p>{p}</p>" for p in paragraphs)
            html = f"<div>{notice}</div><ul>{menu}</ul>{body}<div>by <b>{words(draw, 1)}</b> <i>{tail}</i></div>"
            out.append((f"http://{host}/{k}", html, "\n\n".join(paragraphs), f"by {html.split('<b>')[1].split('<')[0]}"))
    return out


def test_template_text_without_telling_markup(spark):
    made = template_pages(3)
    rows = [(k, url, html, "h", 1, "c", "f") for k, (url, html, _, _) in enumerate(made)]
    got = {r.page_id: r for r in he.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for k, (_, _, text, author) in enumerate(made):
        assert got[k].text == f"{text}\n\n{author}" and got[k].n_chars == len(got[k].text)


def brute_runs(pages):
    """(url, html, start): length, by the definition in the module's text."""
    kept = [p for p in pages if p.words]
    hosts = {h: {(p.article, p.content) for p in kept if p.host == h} for h in {p.host for p in kept}}
    out = {}
    for p in kept:
        for s in p.starts:
            others = [q for q in kept if q.host == p.host]
            share = lambda n: {(q.article, q.content) for q in others for t in q.starts if q.words[t : t + n] == p.words[s : s + n]}  # noqa: E731, B023
            n, size = len(share(he.LEAST)), len(hosts[p.host])
            need = max(he.ARTICLE_PAGES, he.ARTICLE_SHARE * size) if p.article else max(he.LEAST_PAGES, he.SHARE * size)
            if n >= need:
                longest = max(m for m in range(he.LEAST, min(he.DEPTH, len(p.words) - s) + 1) if len(share(m)) >= he.LEAST_PAGES)
                out[p.content, s] = longest
    return out


@pytest.mark.parametrize("article", [False, True])
def test_covered_runs(spark, article):
    draw = random.Random(5)
    shared = [words(draw, n) for n in (8, 9, 20, 70, 130)]
    rows = []
    for k in range(24):
        parts = [draw.choice(shared) + " " * draw.randint(0, 1) + words(draw, draw.randint(0, 12)) for _ in range(4)]
        parts.insert(draw.randrange(4), shared[2])
        html = "".join(f"<p>{p[: draw.randint(40, 900)]}</p>" for p in parts)
        rows.append((k, f"http://h{k % 8 // 7}/", f"<article>{html}</article>" if article else html, "", 0, "", ""))
    rows += [rows[0], (90, rows[1][1], rows[0][2], "", 0, "", "")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = he.covered_runs(he._identified(spark.createDataFrame(rows, PAGES).select("page_id", "url", "html")))
        named = he._identified(spark.createDataFrame(rows, PAGES))
        got = found.join(named, ["page", "check"]).select("url", "html", found["start"], "length").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    pages = [he.Page(r[1], r[2]) for r in rows]
    assert {(he.Page(r.url, r.html).content, r.start): r.length for r in got} == brute_runs(pages) != {}


def test_shared_lengths():
    draw = random.Random(9)
    rows = sorted((draw.randrange(2), tuple(draw.choice([1, 2]) for _ in range(draw.randint(8, 12))), draw.randrange(9)) for _ in range(300))
    got = he.shared_lengths([(h, c, list(w)) for h, w, c in rows])
    for (h, w, c), length in zip(rows, got):
        want = [n for n in range(he.LEAST, len(w) + 1) if len({d for g, v, d in rows if g == h and v[:n] == w[:n]}) >= he.LEAST_PAGES]
        assert length == max(want, default=0)


def test_marked_articles_stay_whole_and_copies_too(spark):
    draw = random.Random(11)
    line, copy = words(draw, 12), "".join(f"<p>{words(draw, 30)}</p>" for _ in range(3))
    bodies = [f"<p>{words(draw, 40)}</p><p>{line}</p>" if k % 2 else f"<p>{words(draw, 40)}</p>" for k in range(20)]
    rows = [(k, "http://h/", f"<nav>m</nav><article>{b}</article>") for k, b in enumerate(bodies)]
    rows += [(100 + k, "http://h/", copy) for k in range(9)]
    rows += [(200, None, None), (201, "http://h/", ""), (202, None, "<p>x" + "  long" * 300_000), (203, "u", "<p>short"), (None, "u", "<p>n")]
    given = spark.createDataFrame([(*r, "", 0, "", "") for r in rows], PAGES)
    got = {r.page_id: r for r in he.extract(given).collect()}
    assert len(got) == len(rows)
    for k, body in enumerate(bodies):
        assert got[k].text == "\n\n".join(body.replace("</p>", "").split("<p>")[1:])
    assert {got[100 + k].text for k in range(9)} == {"\n\n".join(copy.replace("</p>", "").split("<p>")[1:])}
    assert got[200].text == "" == got[201].text and got[202].n_chars == 1 + 5 * 300_000 and got[203].text == "short"


def test_no_pages(spark):
    assert he.extract(spark.createDataFrame([], PAGES)).columns == ["page_id", "url", "text", "n_chars"]
    assert he.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_query(spark, folder):
    from faunatally.llm.queries import QUERIES

    given = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = QUERIES["op13_html_extract"](spark, folder).collect()
    assert len(got) == len(given)
    for row in got:
        assert (row.url, row.text, row.n_chars) == (given[row.page_id].url, *brute.article_text(given[row.page_id].html))


def brute_cover(pages):
    """content: places of the words that windows at any word cover, by the definition in the module's text."""
    kept = {p.content: p for p in pages if p.words}.values()
    out = {}
    for p in kept:
        others = [q for q in kept if q.host == p.host]
        streams = [" ".join(("", *q.words, "")) for q in others]
        have = lambda s, n: sum(" ".join(("", *p.words[s : s + n], "")) in t for t in streams)  # noqa: E731, B023
        need = max(he.ARTICLE_PAGES, he.ARTICLE_SHARE * len(others)) if p.article else max(he.LEAST_PAGES, he.SHARE * len(others))
        covered = set()
        for s in range(len(p.words) - he.LEAST + 1):
            if have(s, he.LEAST) >= need:
                longest = max(m for m in range(he.LEAST, min(he.DEPTH, len(p.words) - s) + 1) if have(s, m) >= he.LEAST_PAGES)
                covered.update(range(s, s + longest))
        out[p.content] = covered
    return out


@pytest.mark.parametrize("article, pack_bytes", [(False, 1 << 22), (True, 1 << 22), (False, 8000), (True, 8000)])
def test_template_runs_begin_at_any_word(spark, monkeypatch, article, pack_bytes):
    monkeypatch.setattr(he, "PACK_BYTES", pack_bytes)
    draw = random.Random(7)
    shared = [words(draw, n) for n in (8, 11, 30)]
    rows = []
    for k in range(26):
        some = [shared[2], *(draw.choice(shared) for _ in range(2))]
        parts = [f"{words(draw, draw.randint(1, 20))} {t[: draw.randint(55, 400)].rsplit(' ', 1)[0]} {words(draw, 2)}" for t in some]
        html = "".join(f"<p>{p}</p>" for p in (*parts, f"{words(draw, 3)} {shared[2]}"))
        rows.append((k, f"http://h{k % 13 // 10}/", f"<article>{html}</article>" if article else html))
    rows += [(90, rows[1][1], rows[0][2]), (91, rows[0][1] + "copy", rows[0][2]), (92, *rows[0][1:])]
    named = he._identified(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {}
    for r in he.template_runs(named).join(named, ["page", "check"]).select("url", "html", "start", "length").collect():
        got.setdefault(he.Page(r.url, r.html).content, set()).update(range(r.start, r.start + r.length))
    pages = [he.Page(url, html) for _, url, html in rows]
    want = {c: covered for c, covered in brute_cover(pages).items() if covered}
    assert {c: v for c, v in got.items()} == want != {}


def test_template_text_inside_blocks_goes(spark):
    draw = random.Random(13)
    notice = words(draw, 12)
    own = [(words(draw, 9), words(draw, 5)) for _ in range(10)]
    rows = [(k, f"http://h/{k}", f"<div><p>{a} {notice} {b}</p></div>") for k, (a, b) in enumerate(own)]
    got = {r.page_id: r.text for r in he.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"{a} {b}" for k, (a, b) in enumerate(own)}
