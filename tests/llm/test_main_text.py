from access_spark.llm import main_text
from access_spark.llm.main_text import container_scores, parse, text_at

LONG = ["The first paragraph is long enough to be text, with <b>bold</b> and <a href='x'>a link</a>.", "A second&nbsp;paragraph &amp; more &lt;text&gt;\n\t  in it,<br>and a line.", "Third: &#233;t&eacute; &#x1F600; &copy 2020 &am"]
PLAIN = ["The first paragraph is long enough to be text, with bold and a link.", "A second paragraph & more <text> in it, and a line.", "Third: été 😀 © 2020 &am"]
PARAS = "".join(f"<p>{p}</p>" for p in LONG)
OPEN = "<p><b>".join(["", *LONG])


def own_text(html):
    page = parse(html)
    return text_at(page, None, container_scores(page))


FRAMES = {
    "article": "<html><head><title>T</title><style>p{}</style><script>if (a<b) '<p>no</p>'</script></head><body><nav><ul><li><a href=/>Menu</a></ul></nav><article>%s</article><footer>Foot</footer></body></html>",
    "divs": "<body><div id=header><h1>Site</h1></div><div class='main-content'>%s</div><div class=sidebar><p>Side text that is not main at all, though it is rather long.</p></div><div id=footer>Foot</div>",
    "comments": "<body><main><div class='post post-123'>%s</div><div id=comments><div class=comment><p>I think that this is wrong, and I say so at length here.</p></div></div></main>",
    "notices": "<body><div class=cookie-notice>We use cookies.</div><article><div class=ad>Buy!</div>%s<form><label>Mail</label><input value=x><button>Go</button></form><aside>Aside</aside></article>",
    "hidden": "<body><article><div hidden>no</div><div style='display: none'>no</div><!-- no --><noscript>no</noscript><template><p>no</p></template>%s</article><div role=complementary>no</div>",
    "cut": "<!DOCTYPE html><body><header>Head</header><div class=entry>%s",
}


def test_frames():
    for name, frame in FRAMES.items():
        for body in (PARAS, OPEN):
            assert own_text(frame % body) == "\n".join(PLAIN), (name, own_text(frame % body))


WRAPPERS = [
    "<body><div class='content has-sidebar'>%s</div><p>Foot</p>",
    "<body><div class='no-sidebar overflow-hidden'><div class=text>%s</div></div>",
    "<body><div class='elementor-widget elementor-widget-theme-post-content'>%s</div><p>Foot</p>",
    "<body><form id=aspnetForm><div id=sidebar><p>Side</p></div><div class=c>%s</div><form class=search>Find</form></form>",
    "<body><p>Head</p><div class='social-page'><article>%s</article></div><div class=social-links><p>Follow us</p></div>",
    "<body><aside><main>%s</main></aside><div class=c><p>Elsewhere</p></div>",
    "<body><div class=comments-open>%s</div>",
]


def test_wrappers_with_names_of_what_is_left_out():
    for wrapper in WRAPPERS:
        for body in (PARAS, OPEN):
            assert own_text(wrapper % body) == "\n".join(PLAIN), (wrapper, own_text(wrapper % body))
    # long comments, dialogs and asides with articles do not oust a short text
    for beside in ("<div class=comments>%s</div>", "<div id=cookie-consent>%s</div>", "<aside><p>%s</p></aside>", "<footer>%s</footer>", "<article class=comment>%s</article>"):
        assert own_text("<body><div class=c><p>A short text.</p></div>" + beside % ("Long. " * 99)) == "A short text."
    assert own_text("<body><nav>a</nav><footer>b</footer></body>") == ""
    assert own_text("<article><p>Say <button><div>no</div></button>so <svg><text>no</text></svg>here.</p><li>a<svg>no<li>b</article>") == "Say so here.\na\nb"
    assert own_text("<article><p>So <math><mi>x</mi><mo>=</mo><annotation>x=1</annotation></math> and <label>y</label> <object>z</object>.</p></article>") == "So x= and y z."


def test_a_host_tells_a_page_what_wraps_its_text(spark):
    frame = "<body><div class=c>%s</div><div class=widget><p>%s</p></div>"
    rows = [(i, "http://h.net/x", frame % ("", PLAIN[0])) for i in range(9)] + [(9, "http://h.net/y", frame % ("<p>Side</p>", "Short text"))]
    out = main_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in out.collect()} == {**dict.fromkeys(range(9), PLAIN[0]), 9: "Short text"}


BODY = "".join(f"<p>{p}</p>" for p in [PLAIN[0]] * 60)
HEADS = [
    "<body><div class=post><h1>Title</h1><p>Lead</p><div class=entry-content>%s</div><div class=part><p>More</p></div></div>",
    "<body><article><h1>Title</h1><p>Lead</p><div class=entry-content>%s</div><p>More</p></article>",
    "<body><main><div class=c1><div><h1>Title</h1></div><p>Lead</p></div><div class=c2><div>%s</div></div><div><p>More</p></div></main>",
    "<body><div id=page><div><h1>Title</h1><p>Lead</p><div class=text>%s</div><p>More</p></div><ul><li><a href=x>Links of the page</a></ul></div>",
]


def test_title_and_lead_beside_the_body(spark):
    want = "\n".join(["Title", "Lead", *[PLAIN[0]] * 60, "More"])
    for head in HEADS:
        assert own_text(head % BODY) == want, head
    rows = [(i, f"http://h{i % 4}.net/x", HEADS[i % 4] % BODY) for i in range(40)]
    out = main_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.text for r in out.collect()} == {want}
    # what is mostly links, or beside a container without a name or title, is not the same text
    links = "<li><a href=x>A link to another page</a>" * 3
    assert own_text(f"<body><div class=main><ul>{links}</ul><div class=text>{PARAS}</div></div>") == "\n".join(PLAIN)
    assert own_text(f"<body><div class=text>{PARAS}</div><p>Foot</p>") == "\n".join(PLAIN)
    assert own_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_scripts_after_letters_whose_lower_case_is_longer():
    part = "<p>" + "İstanbul'da İyi " * 5 + "</p><script>if (a) '<p>no</p>'</SCRIPT><script>x='</scripts>'</script ><title>no</TİTLE></title>"
    assert own_text(f"<article>{part * 20}<p>End</p></article>") == "\n".join([("İstanbul'da İyi " * 5).strip()] * 20 + ["End"])


def test_broken_and_odd_markup():
    assert own_text("") == own_text("   \n") == own_text("<br><img src=x>") == ""
    assert own_text("just text\n here") == "just text here"
    assert own_text("<article>a</b></p></span></div> b</article>") == "a b"
    assert own_text("<article><p>a<p>b<ul><li>c<li>d</ul>e</article>") == "a\nb\nc\nd\ne"
    assert own_text("<article><p>x < y and y > z</p></article>") == "x < y and y > z"
    assert own_text("<article><p title='a>b'>c</p><script>never closed <p>no") == "c"
    assert own_text("<article><![CDATA[a &amp; b]]></article>") == "a &amp; b"
    long = "word " * 200_000
    assert own_text(f"<article><p>{long}</p></article>") == long.strip()
    assert own_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_votes_give_a_host_one_path(spark):
    """A page whose own best container is wrong is read at the path of its host."""
    frame = "<body><div class=story-%d>%s</div><div class=teasers><p>%s</p></div></body>"
    rows = [(i, "http://h.net/x", frame % (i, PARAS, "short")) for i in range(30)]
    rows += [(40, "http://h.net/y", frame % (40, "<p>The main text of this page is a short one.</p>", "A long teaser about another page. " * 5))]
    rows += [(41, "http://h.net/z", "<body><article><p>Another layout altogether.</p></article></body>"), (42, None, frame % (1, PARAS, "s")), (43, "http://h.net/", None), (44, "http://h.net/", ""), (None, "x", "<p>t</p>"), (45, "http://one.net/", "<article>é</article>"), (45, "http://one.net/", "<article>é</article>")]
    pages = spark.createDataFrame([(*r, "h", "t") for r in rows], "page_id long, url string, html string, host string, text string")
    out = main_text.extract_pages(pages).collect()
    assert len(out) == len(rows)
    by_id = {r.page_id: r for r in out}
    assert all(by_id[i].text == "\n".join(PLAIN) for i in (*range(30), 42))
    assert by_id[40].text == "The main text of this page is a short one."
    assert by_id[41].text == "Another layout altogether."
    assert by_id[43].text == by_id[44].text == "" and by_id[44].n_chars == 0
    assert by_id[45].n_chars == 1 and by_id[None].text == "t"
    paths = {r.host: r.path for r in main_text.host_paths(pages).collect()}
    assert paths["h.net"] == ">body>div.story-0"
    assert main_text.extract_pages(pages.limit(0)).collect() == []
