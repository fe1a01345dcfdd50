from rastercube.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>if (a<b) "</p>";</script></head>
<body><header><h2>Site</h2></header><nav><ul><li><a href=/a>Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy <b>now</b></div>
<div class="layout"><div class="post-body{n}"><h1>Title &amp; more</h1><p>First&nbsp;para<b>graph</b>
 goes  on<br>here<p>Second &lt;b&gt; one <a href="x>y">link</a> &#233;<ul><li>item one<li>item two</ul>
<table><tr><td>cell a<td>cell b<tr><td>cell c</table><blockquote>Quoted words here</blockquote>{more}</div>
<aside>Side</aside><div id="comments"><article><p>A reader writes a very long comment that goes on and on and on for ever and ever
and has many more words than the article itself could have, and on, and on, and on.</p></article></div></div>
<form><input value=x><button>Go</button></form><footer>&copy; 2020</footer></body></html>"""
WANT = ("Title & more\n\nFirst paragraph goes on here\n\nSecond <b> one link é\n\nitem one\n\nitem two\n\ncell a\n\ncell b\n\n"
        "cell c\n\nQuoted words here")


def test_pages(spark, pages_schema):
    rows = [(i, f"https://www.host.example/{i}", PAGE.format(n=i, more="<p>Extra text.</p>" * (i % 2))) for i in range(8)]
    rows += [(8, "http://u@other.example:80/x", "<article><h1>Only</h1><p>A <i>short</i> one.</article><div class=sidebar>no</div>"),
             (9, None, "plain text a < b & c"), (10, "bad url", None), (11, "http://e.example/", ""), (12, "http://e.example/", "<p"),
             (None, "http://e.example/", "<div>no id</div>"), (8, "http://u@other.example:80/x", "<p>twice</p>"),
             (13, "http://x.example", "<html><head><meta a><body><div><main><p>In main.</p></main></div>")]
    df = spark.createDataFrame([(*r, "t", "d", "h") for r in rows], pages_schema).repartition(3)
    got = html_text.main_text(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    text = {}
    for r in got:
        text.setdefault(r.page_id, []).append(r.text)
    for i in range(8):
        assert text[i] == [WANT + "\n\nExtra text." * (i % 2)]
    assert sorted(text[8]) == ["Only\n\nA short one.", "twice"]
    assert text[9] == ["plain text a < b & c"] and text[10] == [""] and text[11] == [""] and text[12] == [""]
    assert text[None] == ["no id"] and text[13] == ["In main."]


def test_a_host_agrees_on_one_path(spark, pages_schema):
    """A page whose sidebar text outweighs its article gets the article by its host's vote."""
    page = "<body><div class=box{k}><p>{article}</p></div><div class=list><p>{other}</p></div></body>"
    rows = [(i, "http://h.example/", page.format(k=i, article="word " * 60, other="x")) for i in range(9)]
    rows.append((9, "http://h.example/", page.format(k=9, article="short article", other="other " * 90)))
    df = spark.createDataFrame([(*r, "t", "d", "h") for r in rows], pages_schema)
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert got[9] == "short article"


def test_hosts(spark):
    df = spark.createDataFrame([("HTTP://User:p@WWW.A.example:8/x",), ("https://b.example?q",), (None,), ("x",)], "u string")
    assert [r[0] for r in df.select(html_text.host_of(df["u"])).collect()] == ["a.example", "b.example", "", ""]


def test_empty(spark, pages_schema):
    assert html_text.main_text(spark.createDataFrame([], pages_schema)).count() == 0


def test_deep_nesting_loses_no_text():
    """Thousands of levels, closed or not, are read; text behind them is still the page's."""
    for n in (3, 400, 3000):
        for end in ("</div>" * n, ""):
            root = html_text.parse("<body>" + "<div>" * n + "<p>deep</p><b>er</b>" + end + "<p>after</p>")
            assert html_text.text_blocks(root) == ["deep", "er", "after"]
            assert max(html_text.container_scores(root).values()) > 0
    root = html_text.parse("<body>" + "<span>x " * 3000)
    assert html_text.extract(root, ["html>body"]) == " ".join("x" * 3000)


def test_heading_lead_and_sections_beside_the_core_are_kept():
    """Parts of an article outside its best container are text too, however long that container is."""
    core = "<div class=entry-content>" + "<p>" + "long text " * 400 + "</p></div>"
    parts = "<h1>The title</h1><p class=lead>A lead.</p>" + core + "<section><p>Part two.</p></section>"
    want = ["The title", "A lead.", ("long text " * 400).strip(), "Part two."]
    for page in ("<body><article>%s</article></body>", "<body><div class=page>%s</div></body>", "<body>%s</body>",
                 "<body><main><div><div>%s</div></div></main><div class=x>Other words</div></body>"):
        root = html_text.parse("<nav>Menu words</nav>" + page % parts + "<footer>Foot words</footer>")
        assert html_text.extract(root, [html_text.best_path(root)]).split("\n\n") == want


def test_wrappers_with_names_of_boilerplate_keep_the_article():
    """A part of a name, or a form around the page, does not drop the page's text; real boilerplate still goes."""
    text = "<h1>Title here</h1>" + "<p>A paragraph of the article.</p>" * 5
    want = "\n\n".join(["Title here"] + ["A paragraph of the article."] * 5)
    for top in ('<div id=page class="no-sidebar">', '<div class="content with-sidebar">', '<div id=wrapper class="nav-open">',
                '<section class="search-result">', '<div class="widget-text">', "<form action=/x>"):
        end = f"</{top[1:].split()[0].rstrip('>')}>"
        for extra in ("", '<div class="sidebar"><p>Side words.</p></div>'):
            for page in (f"<body>{top}{text}{extra}{end}", f"<body>{top}{text}{end}{extra}"):
                root = html_text.parse(page + "<nav>Menu words</nav><div class=comments><p>" + "A reader writes. " * 90 + "</p></div>")
                assert html_text.extract(root, [html_text.best_path(root)]) == want
    # many parts, none of which holds most of the text
    root = html_text.parse("<body>" + '<div class="widget-text"><p>Part of it.</p></div>' * 7 + "<footer>Foot</footer>")
    assert html_text.extract(root, [html_text.best_path(root)]) == "\n\n".join(["Part of it."] * 7)


def test_a_rarer_layout_keeps_its_article(spark, pages_schema):
    """A teaser at the majority's path does not replace the article; pages without a host have no vote in common."""
    most = "<body><div class=box><p>" + "word " * 60 + "</p></div></body>"
    rare = "<body><div class=box><p>One teaser sentence.</p></div><div class=story><p>" + "tale " * 200 + "</p></div></body>"
    rows = [(i, "http://h.example/", most) for i in range(30)] + [(30, "http://h.example/", rare)]
    rows += [(40 + i, None, most) for i in range(9)] + [(50, "/relative", rare)]
    df = spark.createDataFrame([(*r, "t", "d", "h") for r in rows], pages_schema)
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    for i in (30, 50):
        assert ("tale " * 200).strip() in got[i]
    assert all(got[i] == ("word " * 60).strip() for i in (0, 29, 40, 48))


def test_a_word_in_a_name_does_not_drop_text():
    """Parts whose names only contain a word of boilerplate stay; parts that are named so, or are mostly links, go."""
    text = "A long paragraph of the article that goes on for some while and has its own words. " * 4
    body = "<p>%s</p>" % text
    for part, want in (
            ('<p class="ad-free">Kept words.</p>', "Kept words."),
            ('<section class="social-history"><p>Kept words.</p></section>', "Kept words."),
            ('<section id="legal-background"><p>Kept words.</p></section>', "Kept words."),
            ('<div class="title-banner"><h1>Kept words.</h1></div>', "Kept words."),
            ('<figure class="widget-photo"><figcaption>Kept words.</figcaption></figure>', "Kept words."),
            ('<section id="comment-on-results"><p>Kept words.</p></section>', "Kept words."),
            ('<p class="tags-explained">Kept words.</p>', "Kept words."),
            ("<p>Where <math><mi>x</mi><annotation>tex</annotation></math> is.</p>", "Where x is."),
            ("<xmp>a <b> &amp; c</xmp>", "a <b> &amp; c"),
            ("<svg><path d=x><p>Kept words.</p>", "Kept words."),
            ("<svg><title>No</title></svg><p>Kept words.</p>", "Kept words."),
            ('<div class="ad-box">Buy</div>', None), ('<div class="cookie-notice">Buy</div>', None),
            ('<div class="share-this-story"><a href=x>Share it</a></div>', None), ('<div id="relatedPosts">More</div>', None)):
        root = html_text.parse(f"<body><article>{part}{body}</article><div class=sidebar><p>Side</p></div></body>")
        got = html_text.extract(root, [html_text.best_path(root)]).split("\n\n")
        assert got == [want] * (want is not None) + [text.strip()], part


def test_an_article_within_a_link_is_the_text():
    text = "A long paragraph of the article that goes on for some while and has its own words. " * 4
    root = html_text.parse(f"<body><a href=x><div class=story><h1>Title</h1><p>{text}</p></div></a><div>Short words</div></body>")
    assert text.strip() in html_text.extract(root, [html_text.best_path(root)])
