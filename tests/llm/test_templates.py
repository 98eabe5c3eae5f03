import html
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from spendlens.llm import templates
from spendlens.llm.templates import judge_classes, main_text, read, text_of


def text(page, template=frozenset()):
    return text_of(read(page)[1], set(template))


def test_what_is_left_out():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{a>b}</style>
    <script>if (a<b) document.write("<p>no</p>")</script></head><body class="home">
    <header><h1>Site</h1></header><nav><ul><li><a href="/">Menu</a></ul></nav>
    <div id=cookie-notice>We use cookies</div><div class="ad">Buy</div>
    <article class='post'><header><h1>Head&amp;line</h1><p>by X</p></header>
    <p>One <b>bo</b>ld&nbsp;word<br>next   line<p>Two &lt;tags&gt; &copy; 5 < 6
    <aside>Aside</aside><form><p>Mail</p></form><ul><li>a<li>b</ul><!-- no > no -->
    <div class="post-comments"><article><p>Nice!</p></article></div>
    <footer>Share</footer></article><div class="sidebar"><p>Side</p></div>
    <footer>&copy; Site</footer></body></html>"""
    assert text(page) == "Head&line One bold word next line Two <tags> © 5 < 6 a b"


def test_damaged_pages():
    assert text("") == "" and text("plain  text") == "plain text"
    assert text("<p>a<p>b</p></div></p>c") == "a b c"
    assert text("<article><p>a <b>b<p>c") == "a b c"
    assert text("<p>a<") == "a<" and text("<p>a</p><div") == "a" and text("<p title=\"x>y\">a</p>") == "a"
    assert text("<nav><ul><li>menu<article><p>body</article><footer>f") == "body"
    assert text("<script>never closed <p>a") == "" and text("<!-- never closed <p>a") == ""
    assert text("<form><div><article><p>x</p></article>") == "x"
    assert text("<main><h1>a</h1><p>b</main><p>c") == "a b" and text("<p>a</p>\x00퟿") == "a \x00퟿"
    assert text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    long = "<p>" + "word &amp; " * 200_000
    assert text(long) == " ".join(["word &"] * 200_000)


def page(r, i, extra=""):
    words = lambda n: " ".join("".join(r.choice("abcdef") for _ in range(4)) for _ in range(n))
    body = "".join(f"<p>{words(12)}</p>" for _ in range(r.randrange(1, 6)))
    links = "".join(f"<li><a>{words(1)}</a></li>" for _ in range(r.randrange(2, 5)))
    return (f"<html><body><ul>{links}</ul><h1>{words(3)}</h1><div class=box><span>Posted in News</span>"
            f"</div>{body}{extra}<div class=box>Read our other stories</div></body></html>")


def plain_templates(pages):
    """Classes of equal occurrence vectors, compared as whole vectors."""
    skeleton = [read(p)[0] for p in pages]
    vectors = defaultdict(lambda: [0] * len(pages))
    for i, tokens in enumerate(skeleton):
        for t, n in Counter(tokens).items():
            vectors[t][i] = n
    classes = defaultdict(list)
    for t, v in vectors.items():
        held = sum(n > 0 for n in v)
        if held >= 2 and held >= templates.SUPPORT * len(pages):
            classes[tuple(v)].append(t)
    rank = sorted(classes, key=lambda v: (-sum(n > 0 for n in v), -len(classes[v])))
    number = {v: i for i, v in enumerate(rank)}
    class_of = {t: number[v] for v, ts in classes.items() for t in ts}
    verdicts = defaultdict(set)
    for tokens in skeleton:
        for c, seen in judge_classes(tokens, class_of, {i: i for i in number.values()}).items():
            verdicts[c].add(seen)
    return {frozenset(classes[v]) for v, c in number.items()
            if len(verdicts[c]) == 1 and min(verdicts[c])[0] and min(verdicts[c])[1]}


def test_templates_equal_brute_force(spark):
    r = random.Random(3)
    pages = [page(r, i, "<table><tr><td>x</table>" * (i % 3)) for i in range(40)]
    rows = [(i, f"http://A.example/{i}", p) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    skeleton = (templates.skeletons(df, "page_id", "url", "html")
                .withColumnRenamed("host", "site"))
    sites = skeleton.groupBy("site").agg(F.count("*").alias("n"))
    got = {frozenset(t % (1 << 64) for t in x["tokens"]) for x in
           templates.deduce_templates(skeleton, sites).collect()}
    want = plain_templates(pages)
    assert got == want and len(want) >= 3
    said = [t for t in want for t in t]
    assert any(n[0] in said for n in read(pages[0])[1] if "Posted in News" in n[1])


def test_order_and_nesting():
    judge = lambda tokens, classes: judge_classes(
        tokens, {t: c for c, ts in enumerate(classes) for t in ts}, dict(enumerate(range(len(classes)))))
    good = judge([1, 5, 6, 5, 6, 2, 3], [[1, 2, 3], [5, 6]])
    assert all(order and nested for order, nested in good.values())
    assert judge([1, 5, 2, 6, 3], [[1, 2, 3], [5, 6]])[1][1] == 0      # stands across the first
    assert judge([1, 5, 2, 5, 3], [[1, 2, 3], [5]])[1][1] == 0         # stands in two slots
    assert judge([1, 2, 2, 1], [[1, 2]])[0] == (0, 0)                  # not in one order
    assert judge([1, 2, 1, 2], [[1, 2]])[0][0] == judge([1, 2], [[1, 2]])[0][0] != judge([2, 1], [[1, 2]])[0][0]


def test_template_text_goes_and_copies_stay(spark):
    r = random.Random(9)
    rows = [(i, f"https://one.example/{i}", page(r, i)) for i in range(30)]
    copy = page(r, 0)
    rows += [(100 + i, f"https://copies.example/{i}", copy) for i in range(8)]
    rows += [(200 + i, f"https://h{i}.example/", page(r, i)) for i in range(6)]
    rows += [(300, None, "<p>no host</p>"), (301, "https://one.example/x", None), (302, "", ""),
             (None, "https://one.example/y", "<p>only this</p>"), (3, "https://one.example/3", rows[3][2])]
    df = spark.createDataFrame([(*x, 1, "h", "t") for x in rows],
                               "page_id long, url string, html string, site int, host string, template string")
    got = main_text(df.repartition(3)).collect()
    assert len(got) == len(rows) and all(x["n_chars"] == len(x["text"]) for x in got)
    by = {x["page_id"]: x["text"] for x in got}
    whole = lambda p: " ".join(" ".join(html.unescape(b).split()) for b in re.split("<[^>]*>", p) if b.strip())
    for i, _, p in rows[:30]:
        want = whole(p).replace("Posted in News ", "").replace(" Read our other stories", "")
        assert by[i] == want
    assert by[100] == whole(copy) and by[200] == whole(rows[38][2])
    assert (by[300], by[301], by[302], by[None]) == ("no host", "", "", "only this")


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {x["page_id"]: x["text"] for x in main_text(pages).collect()}
    for x in pages.collect():
        inner = re.search("(?s)<article>(.*?)</article>", x["html"])[1]
        blocks = (html.unescape(re.sub("</?b>", "", b)) for b in re.split("<(?!/?b>)[^>]*>", inner))
        assert got[x["page_id"]] == " ".join(" ".join(b.split()) for b in blocks if b.strip())


def test_empty_table(spark):
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
