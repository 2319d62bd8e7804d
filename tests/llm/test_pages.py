from vendorlens.llm import pages


def text(page, winners=()):
    return pages.extract(page, list(winners))[0]


def test_article_without_boilerplate():
    page = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
            '<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- x <p>no</p> --><div class="ad-1">Buy</div>'
            '<article><h1>A &amp; B</h1><p><b>First<br>line.<p>Second   one\n here.</p><form><p>Name</p></form>'
            '<div class="comments"><p>I think</p></div></article><aside>side</aside><footer>&copy; x</footer>')
    assert text(page) == "A & B\n\nFirst line.\n\nSecond one here."


def test_broken_markup():
    assert text("") == "" and text("   ") == ""
    assert text("plain < text & more") == "plain < text & more"
    assert text("<p>a<p>b</i></div><p>c") == "a\n\nb\n\nc"
    assert text('<p title="a > b">x</p><p title="open>y</p>') .startswith("x")
    assert text("<p>x<!-- never closed <p>y") == "x"
    assert text("<script>never closed <p>y</p>") == ""
    assert text("<div>" * 3000 + "deep" + "</div>" * 10) == "deep"
    assert text("<p>1&nbsp;2&#x20AC;&#8364;&bogus;") == "1 2€€&bogus;"


def test_articles_in_boilerplate_count_if_nothing_else_does():
    assert text('<div class="widget"><article><p>only this</p></article></div>') == "only this"


SCHEMA = "page_id long, url string, html string, host string, key string, path string"


def test_hosts_vote(spark):
    good = "<body><div class='post-{i}'><p>{t}</p></div><div class='box'><p>{b}</p></div></body>"
    rows = [(i, f"https://u@Site.example:80/p/{i}", good.format(i=i, t="the article, with text, " * 6, b="short"), "h", "k", "p") for i in range(20)]
    # on one page the box is longer, but the host's path wins
    rows.append((20, "http://site.example/x", good.format(i=99, t="brief but real", b="long box, not the article, " * 20), "h", "k", "p"))
    rows += [(21, None, "<p>no host</p>", "h", "k", "p"), (22, "http://site.example/y", None, "h", "k", "p"), (None, "x", "", "h", "k", "p"),
             (23, "http://other.example", "<main><p>other</p></main>", "h", "k", "p")]
    out = pages.main_text(spark.createDataFrame(rows + rows[:1], SCHEMA).repartition(3)).collect()
    got = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows) + 1
    assert got[20] == "brief but real" and got[21] == "no host" and got[22] == "" and got[None] == "" and got[23] == "other"
    assert got[0] == ("the article, with text, " * 6).strip()
    assert pages.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_driver_pages(spark, sf_dir):
    out = pages.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    raw = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    import html
    import re
    for r in out:  # the pages' articles, cut out by hand
        inner = re.search(r"<article>(.*)</article>", raw[r["page_id"]], re.S).group(1)
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        want = [" ".join(html.unescape(p).split()) for p in parts]
        assert r["text"] == "\n\n".join(w for w in want if w)


def test_article_in_several_containers():
    long, short = "the first part, longer " * 20, "the second part " * 20
    parts = f"{long.strip()}\n\n{short.strip()}"
    assert text(f'<body><div id=c><div class=a><p>{long}</div><div class=b><p>{short}</div></div><div class=menu>x</div>') == parts
    items = "".join(f"<li>item {i} of a long list" for i in range(60))
    got = text(f"<body><div><p>before the list</p><ul>{items}</ul><p>and after it</p></div>")
    assert got.startswith("before the list") and got.endswith("and after it") and "item 59" in got
    links = "".join(f"<li><a href=x>link {i} elsewhere</a>" for i in range(60))
    assert text(f"<body><ul>{links}</ul><div class=post><p>{long}</div>") == long.strip()
    assert text(f"<p>{short}</p><p>more</p><div>small</div>").startswith(short.strip())


def test_classes_that_only_mention_boilerplate():
    long = "the article itself, with text " * 20
    for name in ("page has-sidebar", "layout-sidebar-right", "mainWithSidebar"):
        page = f"<body><div class='{name}'><div class=post><p>{long}</p></div><div class=sidebar>links</div></div><div>legal</div>"
        assert text(page) == long.strip(), name
    for name in ("site-footer", "cookie-banner", "ad-1", "comment-list", "sidebar"):
        assert text(f"<body><div class=post><p>{long}</p><div class='{name}'>no part of it</div></div>") == long.strip(), name


def test_parts_of_articles_stay():
    para = "a paragraph of the paper with its own words " * 8
    page = (f"<article><p>{para}</p><section class='discussion'><p>we discuss</p></section><div class='related work'><p>others did</p></div>"
            f"<p class='alert'>mind the gap</p><aside>by the way</aside><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> here</p>"
            f"<object>drawn <canvas>so</canvas></object><div class='related'><a href=x>more of this</a> <a href=y>and that</a></div>"
            f"<aside><a href=z>all our offers</a></aside><div class='comments'>first!</div><form>mail</form><div class='ad'>buy</div></article>")
    assert text(page) == f"{para.strip()}\n\nwe discuss\n\nothers did\n\nmind the gap\n\nby the way\n\nEnergy is E=m here\n\ndrawn\n\nso"
    assert text(f"<div class=post><p>{para}</p><section class=discussion><p>we discuss</p></section></div><div class=related>x</div>") == f"{para.strip()}\n\nwe discuss"
    assert text(f"<body><div class=post><p>{para}</p></div><div class=notice>cookies</div><aside>side</aside>") == para.strip()


def test_winner_must_hold_the_article(spark):
    story = "the story of this page, told at length " * 60
    post = "<body><div class=post><p>{}</p></div></body>"
    rows = [(i, "http://a.example/", post.format(f"post {i}, with text " * 20)) for i in range(20)]
    rows.append((50, "http://a.example/", f"<body><div class=story><p>{story}</p></div><div class=post><p>a teaser here</p></div></body>"))
    got = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[50] == story.strip() and got[3] == ("post 3, with text " * 20).strip()


def test_host_without_articles_in_several_layouts(spark):
    """Pages of one host in three layouts, none with an article element, against text cut by hand."""
    def words(i, n):
        return " ".join(f"word{i}x{k}" for k in range(n))
    rows, want = [], {}
    for i in range(45):
        a, b, c = words(i, 60), words(100 + i, 30), words(200 + i, 8)
        layout = [f"<div id=wrap><div class='entry e{i}'><h2>{c}</h2><p>{a}<p>{b}</div><div class=sidebar>{words(7, 40)}</div></div>",
                  f"<table><tr><td class=menu><a href=x>{words(8, 20)}</a></td><td class=text><p>{a}</p><ul><li>{b}<li>{c}</ul></td></tr></table>",
                  f"<section class=story><p>{a}</p><blockquote>{b}</blockquote><p>{c}</p></section><section class=teasers><a href=y>{words(9, 30)}</a></section>"][i % 3]
        rows.append((i, "https://mixed.example/p", f"<html><body><header>{words(1, 9)}</header>{layout}<footer>{words(2, 30)}</footer></body></html>"))
        want[i] = "\n\n".join([[c, a, b], [a, b, c], [a, b, c]][i % 3])
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r["page_id"]: r["text"] for r in pages.main_text(docs).collect()} == want


def test_long_pages(spark):
    para = "a long article with many words " * 30
    page = "<body><div class=post>" + f"<p>{para}</p>" * 6000 + "</div></body>"
    assert len(page) > 4 << 20
    rows = [(1, "http://l.example/", page), (2, "http://l.example/", "<p>" + "x" * (5 << 20)), (3, "http://l.example/", "<div>" * 200_000 + "deep")]
    got = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "\n\n".join([para.strip()] * 6000) and got[2] == "x" * (5 << 20) and got[3] == "deep"
