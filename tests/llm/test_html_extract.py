import random

from yarnscope.llm import html_extract as he

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu one</a></li><li>two</li></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy now now.</div>
<article><h1>A &amp; B&nbsp;title</h1><p>First   <b>bold</b>
line.<br>next<p>Second &eacute;&#233;.<div class="notice">Cookie words here that are long long long long long long</div><form><input>Sign</form><p>x</p></article>
<div class="comments"><p>Reader words</p></div><footer>&copy; site</footer>"""


def test_page():
    assert he.main_text(PAGE, {}) == "A & B title\nFirst bold line. next\nSecond éé.\nx"


def test_raw_text_ends_at_its_own_end_tag_only():
    article = "<article><p>First words.</p>{}<p>Last words.</p></article>"
    for raw in ("<script>for(i=0;i<n;i++)f()</script>", "<SCRIPT src=/a/>if(a<b)c('</p>')</Script >", "<style>a<b{}</style>", "<textarea>x <y and z</textarea>",
                "<script>s='<!--'</script>", "<svg><style>a<b{}</style></svg>", "<template><script>a<b</script></template>", '<script src="x"/>',
                "<datalist><option>a<option>b</datalist>", "<noscript><img src='a'></noscript>"):
        assert he.main_text("<html><head></head><body>" + article.format(raw) + "</body></html>", {}) == "First words.\nLast words.", raw


def test_head_without_end_tag():
    head = "<!DOCTYPE html><html><head><meta charset=utf-8><title>T <x</title><script>if(a<b)c()</script><template><p>no</p></template>\n"
    for body in ("<body><p>Some words here.</p>", "<p>Some words here.</p>", "<div>Some words here.</div></body></html>", "Some words here.", "<b>Some</b> words here."):
        assert he.main_text(head + body, {}) == "Some words here.", body
        assert he.main_text(head + "</head>" + body, {}) == "Some words here.", body


def test_best_region_is_the_maximum():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.uniform(-1, 1) for _ in range(rng.randrange(0, 12))]
        a, b = he.best_region(s)
        best = max([0.0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])
        assert abs(sum(s[a:b]) - best) < 1e-9


def test_rows_and_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain words only"), (4, "u", "<p>"), (5, "u", "<"), (6, "u", "<script>x"), (7, "u", PAGE), (7, "u", PAGE), (None, "u", PAGE),
            (8, "u", "<article>" + "<p>word " * 50_000 + "</article>"), (9, "u", "<p>a < b &lt; c <3</p>")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text) for r in he.extract(df).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert by[1] == by[2] == by[4] == by[6] == "" and by[3] == "plain words only" and by[9] == "a < b < c <3"
    assert by[7] == by[None] == "A & B title\nFirst bold line. next\nSecond éé.\nx"
    assert by[8] == "\n".join(["word"] * 50_000)
    assert he.extract(df.where("page_id > 100")).count() == 0


def test_class_names_do_not_decide_alone(spark):
    story = "<p>" + "</p><p>".join(f"Some words of the story number {k}." for k in range(6)) + "</p>"
    want = "\n".join(f"Some words of the story number {k}." for k in range(6))
    wrapped = f'<body><div class="share-price-story">{story}</div><footer>foot words</footer></body>'
    board = f'<article><p class="notice-board">First words here.</p>{story}</article>'
    reader = f'<article>{story}</article><div class="kommentare"><p>Reader words are many here.</p></div>'
    for weights in ({}, {"|p": 0.9, "article|p": 0.9}):
        assert he.main_text(wrapped, weights) == want
        assert he.main_text(board, weights) == "First words here.\n" + want
        assert he.main_text(reader, weights) == want
    assert he.main_text(f'<article>{story}<div class="cookie-notice">Cookie words</div><p class="ad">Buy<p>Last words.</article>', {}) == want + "\nLast words."
    # what an unknown name means is learned from pages that mark their article
    noise = '<div class="meinungen"><p>Words of readers who say a lot of things here.</p></div>'
    rows = [(k, "u", f'<body><article><div class="share">{story}</div></article>{noise}<footer>page {k}</footer></body>') for k in range(8)]
    rows.append((100, "u", f'<body><div class="share">{story}</div>{noise}</body>'))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    weights = he.learn_weights(df)
    assert weights[".share"] > 0 and weights[".meinungen"] <= he.NEVER
    assert {r.text for r in he.extract(df).collect()} == {want}


def test_broken_and_deep_pages_are_quick():
    import time
    words = "<article><p>First words here.</p></article>"
    for page in ("<a " * 300_000, words + "<a " * 300_000, 'x <y and "q ' * 90_000 + ">", "<a" * 400_000 + '"', "<! " * 300_000, "<a '\"" * 200_000 + ">",
                 "<div>" * 50_000 + "deep" + "</div>" * 50_000, "<div>" * 50_000 + "</p>" * 50_000 + "deep", "<b>" * 50_000 + "<td>x</td>" * 50_000,
                 "<b><div>" * 40_000 + "deep" + "</b>" * 40_000, '<i class="ad x">' * 40_000 + "<p>x" * 40_000, "<script>" * 100_000, "<!--" * 100_000):
        t = time.time()
        he.main_text(page, {})
        assert time.time() - t < 5, page[:40]


def test_tags_equal_the_pattern():
    import re
    pattern = re.compile(r"<(/?)([a-zA-Z][^\s/>\"']*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
    rng = random.Random(5)
    for _ in range(20_000):
        page = "".join(rng.choice(["<", "<a", "</b", ">", '"', "'", " ", "/", "x="]) for _ in range(rng.randrange(16)))
        if re.search(r"<\/?[a-z][^\s/>]*[\"']", page):
            continue  # a quote in a name belongs to the name
        tags = he.Tags(page)
        for at in (k for k, c in enumerate(page) if c == "<"):
            m = pattern.match(page, at)
            got = tags.tag_at(at)
            assert (got and (got[0], got[1], got[3])) == (m and (m.end(), bool(m[1]), page[m.end(2):m.end() - 1])), (page, at)
