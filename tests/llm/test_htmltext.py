import random
from collections import Counter, defaultdict

from transpark.llm import htmltext as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header><a href=/>Site</a></header>
<nav><ul><li>Menu</ul></nav><div class="cookie-notice">We use cookies</div><main><div id="content"><article><header><h1>Head {n}</h1></header>
<p>First  of &lt;{n}&gt; <b>bold</b>
text<p>Second <a href="x">link</a> {n}.<div class=ad>Buy</div><ul><li>a {n}<li>b {n}</ul><p>Share this page</article>
<div class="comments"><p>Nice post {n}</div></div></main><aside>Other</aside><form><input>Send</form><script>"<p>no</p>"</script><footer>&copy; x</footer></body></html>"""


def page_text(n):
    return f"Head {n}\n\nFirst of <{n}> bold text\n\nSecond link {n}.\n\na {n}\n\nb {n}\n\nShare this page"


def texts(spark, rows):
    return {r.page_id: r.text for r in h.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_article_only():
    assert h.extract_text(PAGE.format(n=7)) == page_text(7)
    assert h.extract_text(None) == h.extract_text("") == h.extract_text("<!-- x") == ""
    assert h.extract_text("plain &amp; text<p>more") == "plain & text\n\nmore"
    assert h.extract_text("<p><b>Title<br><p>Body</p>") == "Title\n\nBody"
    long = "<p>" + "w " * 200_000
    assert h.extract_text(long) == ("w " * 200_000).strip()


def test_template_over_host(spark):
    rows = [(i, "http://A.example/%d" % i, PAGE.format(n=i), "x") for i in range(6)]
    rows += [(10, None, None, "x"), (11, "no scheme", "", "x"), (12, "http://b/", "<div>only</div>", "x"), (12, "http://b/", "<div>only</div>", "x"), (None, "http://b/", "<div>only</div>", "x")]
    # A mirror: the pages of another host under one of its own.
    rows += [(20 + i, "http://mirror/%d" % i, PAGE.format(n=i), "x") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumnsRenamed({"text": "host"}).selectExpr("*", "'z' article", "'z' drop", "1 key", "2 path")
    got = sorted(((r.page_id, r.text) for r in h.main_texts(pages).collect()), key=str)
    want = [(i + shift, page_text(i)) for i in range(6) for shift in (0, 20)] + [(10, ""), (11, ""), (12, "only"), (12, "only"), (None, "only")]
    assert got == sorted(want, key=str)
    assert h.main_texts(pages.limit(0)).count() == 0


WORDS = "sol mar luz rio voz pan sal fin"


def prose(rng, n):
    return " ".join(rng.choice(WORDS.split()) + str(rng.randint(0, 99)) for _ in range(n))


def bare(rng, n):
    """Nothing but divs: links, a notice that is longer than many articles, the article, a line."""
    notice = "This site stores things on your device and tells others about it. " * 8
    article = "".join(f"<p>{prose(rng, n)}</p>" for _ in range(rng.randint(1, 2)))
    links = "".join(f"<a href=/{i}>section {i}</a> " for i in range(9))
    return f"<html><body><div>{links}</div><div>{notice}</div><div><div><h2>About {prose(rng, 2)}</h2>{article}</div></div><div>All rights</div></body></html>", article


def test_the_template_alone_finds_the_article(spark):
    """No article element and no telling names; short articles aren't found without the template."""
    rng = random.Random(3)
    made = [bare(rng, 4 if i % 4 == 0 else 200) for i in range(12)]
    got = texts(spark, [(i, f"http://bare/{i}", m[0]) for i, m in enumerate(made)])
    for i, (page, article) in enumerate(made):
        own = [x.split("</p>")[0] for x in article.split("<p>")[1:]]
        assert got[i].split("\n\n")[1:] == own and got[i].startswith("About "), i
        if i % 4 == 0:
            assert "stores things" in h.extract_text(page)


def test_copies_of_an_article_stay_whole(spark):
    rng = random.Random(4)
    article = "".join(f"<p>{prose(rng, 30)}</p>" for _ in range(4))
    page = "<html><body><nav><a href=/>Home</a></nav><div id=a{i}>{article}<p>Licence: free</p></div><footer>page {i}</footer></body></html>"
    rows = [(i, f"http://copies/{i}", page.format(i=i, article=article)) for i in range(5)] + [(9, "http://alone/", page.format(i=9, article=article))]
    rows += [(20 + i, "http://equal/" if i < 5 else None, PAGE.format(n=1 if i < 5 else 2)) for i in range(10)]
    got = texts(spark, rows)
    whole = "\n\n".join(x.split("</p>")[0] for x in article.split("<p>")[1:]) + "\n\nLicence: free"
    assert all(got[i] == whole for i in (0, 1, 2, 3, 4, 9))
    assert all(got[20 + i] == page_text(1 if i < 5 else 2) for i in range(10))


def test_names_are_one_feature(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for i in range(6):
        parts = [prose(rng, 60) for _ in range(5)]
        body = f'<p>{parts[0]}</p><div class="side-by-side">{parts[1]}</div><div class="share-price">up {i}</div><div id="related-work">{parts[2]}</div><div class="notice">{parts[3] * 3}</div>'
        body += f'<div class="ad-slot">buy {i}</div><ul class="related-posts"><li><a href=x>{parts[4]}</a></ul>'
        rows.append((i, f"http://named/{i}", f'<body><div class="wrap"><div class="post">{body}</div><section id="feedback"><p>{prose(rng, 90)}</section></div></body>'))
        want[i] = "\n\n".join([parts[0], parts[1], f"up {i}", parts[2], parts[3] * 3])
    assert texts(spark, rows) == want


def plain_templates(pages):
    """Per host: vectors of occurrences written out, page by page, over distinct pages."""
    hosts = defaultdict(dict)
    for host, page in pages:
        hosts[host][page] = h.Page(page)
    out = {}
    for host, own in hosts.items():
        stats = [p.statistics() for p in own.values()]
        slots = []
        for path in sorted({x for s in stats for x in s}):
            has = [s[path] for s in stats if path in s]
            if len(has) >= h.SUPPORT * len(stats):
                opens, shuts = [tuple(s[path][k] if path in s else 0 for s in stats) for k in (0, 1)]
                slots.append(h.Slot(path, len(has), opens, opens == shuts, max(opens) == 1, sum(x[2] for x in has), sum(x[3] for x in has), len(has) > 1 and len({x[4] for x in has}) == 1, max(x[5] for x in has)))
        out[host] = (*h.verdicts(slots), {p: s.klass for p, s in ((s.path, s) for s in slots)})
    return out


def test_deduction_brute_force(spark):
    rng = random.Random(6)
    pages = []
    for host in "abcdefgh":
        shape = rng.sample(["<div>%s</div>", "<div class=ad>%s</div>", "<div class=main>%s</div>", "<section>%s</section>", "<article>%s</article>", "<nav>%s</nav>"], 4)
        for i in range(rng.randint(1, 6)):
            page = "".join(x % "".join(f"<p>{'same' if rng.random() < 0.4 else prose(rng, rng.choice([1, 5, 60]))}</p>" for _ in range(rng.randint(1, 3))) for x in shape if rng.random() < 0.9)
            pages += [(host, page)] * rng.choice([1, 1, 2])
    rows = spark.createDataFrame(sorted(set(pages)), "host string, html string").selectExpr("*", "xxhash64(html) key")
    want = plain_templates(pages)
    got = {r.host: r for r in h.deduce_templates(rows).collect()}
    assert set(got) == set(want)
    for host, (article, drop, keep, _) in want.items():
        assert (got[host].article, got[host].drop, got[host].keep) == (article, drop, keep), host
    assert len(Counter(a for a, *_ in want.values())) > 2
    # Classes by the order-free sums are those by the vectors.
    sums = defaultdict(lambda: defaultdict(set))
    for r in rows.mapInArrow(h._statistics, "host string, path string, " + ", ".join(f"{f} long" for f in h.FIELDS)).groupBy("host", "path").agg({"low": "bit_xor", "high": "bit_xor"}).collect():
        if r.path in want[r.host][3]:
            sums[r.host][r[2], r[3]].add(r.path)
    for host, (*_, classes) in want.items():
        by = defaultdict(set)
        for path, vector in classes.items():
            by[vector].add(path)
        assert sorted(map(sorted, by.values())) == sorted(map(sorted, sums[host].values()))


def framed(rng, i):
    """A page whose whole body is in a form, with an advert, a notice and comments."""
    article = [prose(rng, 60) for _ in range(3)]
    advert = " ".join(f"Buy {prose(rng, 12)} now!" for _ in range(9))
    body = f'<h1>Head {i}</h1><p>{article[0]}</p><div class="advertisement"><p>{advert}</p></div><p>{article[1]}</p><p>{article[2]}</p>'
    comments = f'<ol id="commentlist"><li>I say {prose(rng, 30)}</li></ol><div class="user-comment"><p>Me too {prose(rng, 30)}</p></div>'
    page = f'<html><title>Page {i}</title><body><form id="aspnetForm" action="/x"><input type=hidden value=1><div class="menu"><a href=/>Home</a></div><div id="main">{body}{comments}</div><div class="cookie-notice">{"We store things. " * 35}{i}</div></form><form><label>Name</label><input><p>Send us a word {i}</p></form></body></html>'
    return page, "\n\n".join([f"Head {i}", *article])


def test_forms_adverts_notices_and_comments(spark):
    rng = random.Random(8)
    made = [framed(rng, i) for i in range(8)]
    got = texts(spark, [(i, f"http://framed/{i}", m[0]) for i, m in enumerate(made)] + [(9, "http://alone/", made[0][0])])
    assert got == {**{i: m[1] for i, m in enumerate(made)}, 9: made[0][1]}


def test_notices_beside_a_short_article_on_a_lone_page():
    notice = "We and our partners store things on your device. " * 12
    assert h.extract_text(f'<title>T</title><body><div class="cookie-notice">{notice}</div><article><p>A short article.</p></article></body>') == "A short article."
    assert h.extract_text(f"<title>Name</title><p>{notice}</p>") == notice.strip()
    # What is all that a page has stays, whatever its name is.
    assert h.extract_text(f'<div class="sponsored"><p>{notice}</p></div>') == notice.strip()
    # A form that holds little prose, or fields only, goes.
    assert h.extract_text(f"<form><p>Write to us</p><label>Name</label></form><div><p>{notice}</p></div>") == notice.strip()


def test_markup_without_end_is_read_once():
    """Times are bounded by what a scan takes; quadratic ones would be hours."""
    import time

    began = time.perf_counter()
    for part in ('<p a="', "<p a='", "<p a", "<script ", "<!doctype ", "<!-- ", "</", "<b <i ", '"<a b="c>', "<script></script "):
        h.extract_text("<p>start</p>" + part * (1_000_000 // len(part)))
    assert h.extract_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert h.extract_text("if a <b") == "if a <b" and h.extract_text("x<p title=\"open>y") == "x"
    assert time.perf_counter() - began < 60

