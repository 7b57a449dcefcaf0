import time

from grainmill.llm.html_text import extract_pages, main_text

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav>'
    '<!-- c --><div class="ad">Buy, buy, buy</div><div id="cookie-notice">We use cookies, many, of them</div><article><h1>Head &amp; line</h1><p><b>One  two<br>three<p>Four&nbsp;five, &lt;six'
    '</p><div class="comments"><p>Nice, article, indeed, I like it</p></div></article><aside>Side</aside><footer>&copy; x</footer></body></html>'
)


def test_keeps_the_article_alone():
    assert main_text(PAGE) == "Head & line One two three Four five, <six"


def test_short_article_beats_long_menu_and_cut_pages_are_read():
    page = "<body><nav>" + "<a href=x>link, link</a>" * 50 + "</nav><div class='ad'>x, y, z</div><article><h1>A.</h1><p>B c.</p></article><footer>f"
    assert main_text(page) == "A. B c."
    assert main_text("<article><p>cut &am") == "cut &am"
    assert main_text("plain words") == "plain words"


def test_siblings_and_link_boxes():
    para = "<p>" + "long sentence, with commas, " * 8 + "</p>"
    page = f"<body><div><div id=x>{para * 3}</div><p>{'a closing paragraph of some length ' * 4}</p><ul><li><a href=1>{'link, ' * 40}</a></li></ul></div></body>"
    text = main_text(page)
    assert text.count("long sentence") == 24 and "closing" in text and "link" not in text


def test_parts_beside_the_largest_are_kept():
    big = "<section>" + "<p>a long, long, sentence, with commas, and more</p>" * 9 + "</section>"
    links = "<div><a href=1>elsewhere, one</a> <a href=2>elsewhere, two</a></div>"
    small = "<section><h2>Small part</h2><p>short one</p><p>short two</p></section>"
    page = f"<body><div><h1>Title</h1><p>Lead.</p>{big}<ul><li>item</li></ul><table><tr><td>cell</td></tr></table>{small}loose <b>words</b>{links}</div></body>"
    text = main_text(page)
    assert text.startswith("Title Lead. a long,") and text.endswith("item cell Small part short one short two loose words") and "elsewhere" not in text


def test_article_text_one_level_up_is_kept():
    para = "<p>a long, long, sentence, with commas, and more</p>"
    page = f"<body><div><div><section>{para * 9}</section></div><div><h2>Next</h2><section>{para * 6}</section></div></div><div><a href=1>elsewhere</a></div></body>"
    text = main_text(page)
    assert text.count("a long") == 15 and "Next" in text and "elsewhere" not in text


def test_comments_and_adverts_are_left_whatever_else_their_names_say():
    article = "<article><h1>Head</h1><p>A short article.</p></article>"
    for box in ('section class="post-comments"', 'div class="comment-body"', "div id=commentList", 'div class="sidebar-content"', 'div class="text-ad main"', "ol class=comment-list", 'div class="entry-cookie-notice"', "div class=mainNav"):
        noise = f"<{box}>" + "<p>I, for one, like it, really, and so on, and on</p>" * 12 + f"</{box.split()[0]}>"
        assert main_text(f"<body>{article}{noise}</body>") == "Head A short article.", box
        assert main_text(f"<body><div><div><h1>Head</h1><p>A short article.</p></div>{noise}</div></body>") == "Head A short article.", box
        assert main_text(f"<body><article><h1>Head</h1><p>A short article.</p>{noise}</article></body>") == "Head A short article.", box
    replies = '<article class="comment">' + "<p>a, b, c, d, e, f</p>" * 9 + "</article>"
    assert main_text(f"<body>{article}{replies * 3}</body>") == "Head A short article."
    assert main_text(f'<body><div class="has-sidebar no-comments"><div class="entry-header"><h1>Head</h1></div><p>Text.</p></div></body>') == "Head Text."


def test_an_article_is_kept_whole():
    para = "<p>" + "a long, long sentence, with commas. " * 6 + "</p>"
    page = f"<main><article><header><h1>T</h1></header><section>{para * 5}</section>loose <b>text</b><section><h2>End</h2><p>Brief.</p></section><ul><li><a href=1>source</a></li></ul></article><div>More from us</div></main>"
    text = main_text(f"<body><header>Site</header>{page}<div><p>Call us</p></div></body>")
    assert text.startswith("T a long") and text.endswith("loose text End Brief. source") and "Site" not in text


def test_attributes_are_read_one_by_one():
    assert main_text("<article><p title='the class=ad case'>Kept words?</p><p data-x=\"id='ad'\" CLASS=intro>And?</p><p class = 'x  ad-slot'>Gone</p></article>") == "Kept words? And?"
    assert main_text("<article><p class=\"a>b\">One</p><p a='\"'>two</p><img alt='>'/>three<p class=\"open>four</p></article>") == "One two three four"
    assert main_text("<article><p hidden>x</p><p style='color:red;display : NONE'>y</p><p aria-hidden=true>z</p>w</article>") == "w"


def test_long_odd_pages_take_time_in_proportion():
    for part in ("<div>x", "<a ", "<b>", "<blockquote>x, ", "<li><p>x", "</b><i>", "<table><tr><td>", "<p class='", "<!--", "<dd>x</dt>"):
        page = "<body><p>Some text here, and more.</p>" + part * (1_000_000 // len(part)) + "\"</body>"
        began = time.process_time()
        assert main_text(page).startswith("Some text here") or part == "<p class='"
        assert time.process_time() - began < 6, part


def test_rows(spark, tiny):
    rows = spark.createDataFrame([(1, "u", None, 1), (1, "u", "", 1), (2, None, "<p>x</p>" * 20000, 1), (None, "v", "<script>x", 1)], "page_id long, url string, html string, text int")
    got = extract_pages(rows).collect()
    assert len(got) == 4 and sorted(r.n_chars for r in got) == [0, 0, 0, 39999]
    assert extract_pages(rows.limit(0)).count() == 0
    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    import re, html

    for r in extract_pages(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert " ".join(r.text.split()) == want
