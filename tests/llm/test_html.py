"""Main text: page by page against what the page was made from, and templates of a site."""

import math
import random
from collections import Counter, defaultdict

from eventbase.llm import html

SCHEMA = "page_id long, url string, html string, text string, host int"


def one(page):
    return html.main_text(page, set())


def test_blocks_and_noise():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header>Site</header><nav><ul><li><a href="/a">A</a></ul></nav><!-- <p>no</p> --><div class="ad slot">Buy</div>
    <div id="cookie-notice">OK?</div><article><header><h1>Head &amp; line</h1></header><p><b>One <i>two</i>
      three<br><p>Fo&uuml;r&nbsp;x &#33;</p><ul><li>a<li>b</ul><form>f<input></form><aside>s</aside>
    <section class="comments"><article>reader</article></section></article><footer>&copy; x</footer></body></html>"""
    assert one(page) == "Head & line\nOne two three\nFoür x !\na\nb"


def test_odd_pages():
    assert one(None) == one("") == one("<div></div>") == ""
    assert one("plain  text") == "plain text"
    assert one("a < b <p>c") == "a < b\nc"
    assert one("<p>a</div></p><p title='x > y'>b</p>") == "a\nb"
    assert one("<nav>menu<article>kept</article>") == "kept"
    assert one("<p>a<script>never closed <p>b") == "a"
    assert one("<div>out</div><main><p>in</p></main><div>out</div>") == "in"
    assert one("<p>x" * 3000).count("\n") == 2999
    assert one("<div>" * 3000 + "deep") == "deep"
    assert one('<div class="has-sidebar with-menu"><p>in</p><div class="sidebar">out</div></div>') == "in"
    assert one("<article><p>a<div class=ad>x</div>b</p><div id=comments><p>c</article>") == "a\nb"
    assert one('<p style="display: none">no</p><p>&lt;b&gt;</p>') == "<b>"


def test_templates_of_a_site_go(spark):
    pages = []
    for i in range(40):
        body = f"<div class=top1>Always the same line</div><p>text {i} of its own</p><div class=end><span>Read more</span></div>"
        pages.append((i, "http://a.example/" + str(i), body, None, 0))
    pages += [(100, "http://b.example/x", "<div class=top1>Always the same line</div>", None, 0), (101, None, None, None, 0), (102, "", "<p>p</p>", None, 0)]
    got = {r.page_id: r for r in html.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert all(got[i].text == f"text {i} of its own" for i in range(40))
    assert got[100].text == "Always the same line" and got[101].text == "" and got[102].text == "p"
    assert all(r.n_chars == len(r.text) for r in got.values()) and len(got) == 43
    assert html.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_article_text_is_no_template(spark):
    cells = "<table>" + "".join(f"<tr><td>{'Yes' if i % 2 else 'No'}</td></tr>" for i in range(40)) + "</table>"
    pages = [(0, "http://one.example/", cells, None, 0)]
    for i in range(60):
        marked = f"<article><h3>Summary</h3><p>first {i}</p><h3>Details</h3><p>second {i}</p></article>"
        copies = "".join(f"<p>paragraph {k}</p>" for k in range(5)) + f"<nav>{i}</nav>"
        few = f"<h4>{'Note' if i < 7 else 'Always'}</h4><p>own {i}</p>"
        pages += [(100 + i, f"http://marked.example/{i}", marked, None, 0), (200 + i, f"http://copies.example/{i}", copies, None, 0)]
        pages += [(300 + i, f"http://few.example/{i}", few, None, 0)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert got[0].split("\n") == ["No", "Yes"] * 20
    for i in range(60):
        assert got[100 + i] == f"Summary\nfirst {i}\nDetails\nsecond {i}"
        assert got[200 + i] == "\n".join(f"paragraph {k}" for k in range(5))
        assert got[300 + i] == (f"Note\nown {i}" if i < 7 else f"own {i}")


def test_names_in_part_lower_the_importance_only():
    for name in ('class="related-work"', 'id="social-history"', 'class="ad-hoc"', 'class="section-header"'):
        assert one(f"<div {name}>prose that stays</div>") == "prose that stays"
        assert one(f"<div {name}><a href=/>only</a> <a href=/>links</a></div><p>x</p>") == "x"
    for name in ("reader-feedback", "buy-now", "cookie_notice", "ad-slot-3", "comment-list", "site-header top"):
        assert one(f"<div class='{name}'>gone</div><p>kept</p>") == "kept"
    marked = '<article><p>a</p><div class="reader-feedback">I like it</div><div class="buy-now">Buy</div><p>x <math><mi>y</mi></math></p></article>'
    assert one(marked) == "a\nx y"
    assert one("<article>teaser</article><article>teaser two</article><main><p>the text</p></main>") == "the text"
    assert one("<main><p>a</p><article><p>b</p></article></main>") == "a\nb"


def test_the_tree_decides_inside_the_mark(spark):
    pages = []
    for i in range(30):
        links = "<ul class=more><li><a href=/1>All stories</a></li><li><a href=/2>Write to us</a></li></ul>"
        doubt = f"<div class=share-price>{'Prices of the day' if i % 2 else 'Prices of the night'}</div>"
        body = f"<article><h3>Summary</h3><p>text {i}</p>{links}{doubt}<p><a href=/{i}>source {i}</a></p></article>"
        pages += [(i, f"http://a.example/{i}", body, None, 0), (100 + i, f"http://{i}.example/", body, None, 0)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    for i in range(30):
        assert got[i] == f"Summary\ntext {i}\nsource {i}"
        assert got[100 + i] == f"Summary\ntext {i}\nAll stories\nWrite to us\nPrices of the {'day' if i % 2 else 'night'}\nsource {i}"


def brute_force(pages):
    """The template looks of one host, by entropies over a tree in memory."""
    texts, counts, of_path = {}, defaultdict(Counter), Counter()
    for page in pages:
        blocks, looks = html.parse(page)
        texts.setdefault("\n".join(t for _, t, _ in html.article(blocks)), []).append(looks)
    for copies in texts.values():
        looks = min(copies, key=sorted)
        for path, look in looks:
            counts[path][look] += 1
        of_path.update({path for path, _ in looks})
    importance = {}
    for path, seen in counts.items():
        m = sum(seen.values())
        entropy = -sum(n / m * math.log(n / m) for n in seen.values())
        own = (entropy / math.log(m) if m > 1 else 1.0) * (html.NAME_WEIGHT if html.DOUBTFUL in path else 1.0)
        importance[path] = own if of_path[path] >= html.LEAST_PAGES else 1.0
    low = {p for p in counts if max(v for q, v in importance.items() if q == p or q.startswith(p + "/")) < html.LOW_IMPORTANCE}
    return {look for path in low for look, n in counts[path].items() if n >= html.LEAST_PAGES}


def test_tree_against_brute_force(spark):
    rnd = random.Random(5)
    names = ["", " class=a", " class=b", " class=related-work", " id=ad-hoc", " class='a b'"]
    found = 0
    for _ in range(3):
        parts = []
        for _ in range(8):
            tag, name, few = rnd.choice(["div", "p", "h3", "ul", "section"]), rnd.choice(names), rnd.choice([1, 2, 3, 1000])
            parts.append((tag, name, few, rnd.random() < 0.3))
        pages = []
        for i in range(40):
            body = ""
            for k, (tag, name, few, link) in enumerate(parts):
                if rnd.random() < 0.9:
                    text = f"text {k} {rnd.randrange(few)}"
                    body += f"<{tag}{name}>" + (f"<a href=/>{text}</a>" if link else text) + f"</{tag}>"
            pages += [f"<article>{body}</article>" if rnd.random() < 0.3 else body] * rnd.choice([1, 1, 3])
        frame = spark.createDataFrame([("h", x) for x in pages], "host string, html string")
        got = html.template_looks(frame).collect()
        wanted = brute_force(pages)
        found += len(wanted)
        assert set(got[0].dull if got else []) == wanted
    assert found


def test_given_pages_give_their_documents(spark):
    at = "/root/testdata/sf0.001/"
    docs = {"\n".join(" ".join(x.split()) for x in r.text.split("\n") if x.split()) for r in spark.read.parquet(at + "documents.parquet").collect()}
    found = html.extract(spark.read.parquet(at + "pages.parquet")).collect()
    assert found and all(r.text.split("\n", 1)[1] in docs for r in found)
