import html
import math
import re
import time

import pytest

from driftloom.llm import html_text

PARA = "<p>Plain words of an article that go on for a while, as they do.</p>"


@pytest.mark.parametrize(
    "source,want",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("just text", "just text"),
        ("a &amp; b&nbsp;&#233;<br>c", "a & b é c"),
        ("<p>one<p>two<ul><li>x<li>y</ul>", "one\ntwo\nx\ny"),
        ("<article><h1>T</h1><p>  a\n b </p></article>", "T\na b"),
        ("<article><p>a<script>if (x < 1) '</p>'</script><style>p{}</style></p><p>b", "a\nb"),
        ("<article><p>cut off here &am", "cut off here &am"),
        ("<article><p>cut off here</p><p cla", "cut off here"),
        ("<article><p>x<!-- <p>no</p> --></p></article>", "x"),
        ("<p title='a > b'>x</p>", "x"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ],
)
def test_small_pages(source, want):
    assert html_text.main_text(source) == want


def test_surroundings_are_left_out():
    page = (
        '<html><head><title>T</title></head><body><header>Site</header><nav><ul><li><a href="/">Home</a></ul></nav>'
        '<div class="cookie-notice"><p>We use cookies, a great many of them, on this site and others.</p></div>'
        '<div id="content"><h2>Head</h2>' + PARA * 3 + "<form><p>Name</p><input></form></div>"
        '<div class="sidebar"><p>Other things</p></div><section id="comments"><p>' + "great post " * 40 + "</p></section>"
        '<div class="ad">Buy</div><footer>&copy;</footer></body></html>'
    )
    text = "Plain words of an article that go on for a while, as they do."
    assert html_text.main_text(page) == "\n".join(["Head", text, text, text])


def test_density_tells_text_from_links_without_names():
    links = "<div>" + "".join(f'<p><a href="/{i}">link number {i} with some words in it</a></p>' for i in range(30)) + "</div>"
    page = f"<body>{links}<div><div>{PARA * 3}</div><div>{PARA}</div></div>{links}</body>"
    got = html_text.main_text(page)
    assert "link number" not in got
    assert got.count("Plain words") >= 3


def test_several_subtrees_are_kept():
    text = "Plain words of an article that go on for a while, as they do."
    links = "<ul>" + "".join(f'<li><a href="/{i}">link number {i}</a>' for i in range(9)) + "</ul>"
    several = f"<body><main><h1>Head</h1>{links}<article>{PARA * 3}</article><article>{PARA}</article></main>{links}</body>"
    assert html_text.main_text(several) == "\n".join(["Head", *[text] * 4])
    teaser = f"<body><article><p>Short.</p></article><div><h2>Head</h2>{PARA * 4}</div>{links}</body>"
    assert html_text.main_text(teaser) == "\n".join(["Head", *[text] * 4])
    beside = f"<body>{links}<article>{PARA * 3}</article><div>{PARA * 2}</div></body>"
    assert html_text.main_text(beside) == "\n".join([text] * 5)
    loose = f"<body>Words that stand <b>right</b> in the body, a whole long sentence of them at least.<div>{PARA * 3}</div>{links}</body>"
    assert html_text.main_text(loose).startswith("Words that stand right in") and "link number" not in html_text.main_text(loose)


@pytest.mark.parametrize("name", ['class="layout has-sidebar"', 'id="content-sidebar-wrap"', 'class="no-sidebar"', 'class="elementor-widget-container"', 'class="discussion"'])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_layout_names_do_not_drop_the_text(name, tag):
    text = "Plain words of an article that go on for a while, as they do."
    page = f"<body><nav><a href='/'>Home</a></nav><div {name}><{tag}><header><h1>Head</h1></header>{PARA * 3}</{tag}><div class='ad'>Buy</div></div><footer>F</footer></body>"
    head = ["Head"] if tag == "article" else []
    assert html_text.main_text(page) == "\n".join([*head, text, text, text])


def test_names_of_many_small_wrappers_and_of_true_boilerplate():
    wrapped = "".join(f'<div class="elementor-widget-container"><p>Part {i} of a text that is dealt to many small wrappers.</p></div>' for i in range(12))
    got = html_text.main_text(f'<body><div id="page">{wrapped}<div class="ad">Buy</div><div class="sidebar-inner"><p>Other</p></div></div></body>')
    assert got == "\n".join(f"Part {i} of a text that is dealt to many small wrappers." for i in range(12))


WORDS = "Plain words of an article that go on for a while, as they do."


def test_hidden_is_an_attribute_not_a_word():
    assert html_text.main_text(f'<body><div class="x hidden y">{PARA}</div></body>') == WORDS
    assert html_text.main_text(f"<body><div class=hidden title='a hidden b'>{PARA}</div></body>") == WORDS
    for hidden in ("hidden", 'class="a" hidden', 'hidden=""', "HIDDEN", "id='x'hidden"):
        assert html_text.main_text(f"<body><div {hidden}><p>Not shown to anyone who reads.</p></div><div>{PARA}</div></body>") == WORDS


def test_forms_go_unless_they_wrap_the_page():
    fields = "<form><p>Tell us your name and your address and whatever else there is to tell.</p><input></form>"
    assert html_text.main_text(f'<body><form id="aspnetForm"><div>{PARA * 3}</div></form></body>') == "\n".join([WORDS] * 3)
    assert html_text.main_text(f'<body><form id="aspnetForm"><nav>N</nav><article>{PARA}</article></form></body>') == WORDS
    assert html_text.main_text(f"<body><article>{PARA * 2}{fields}</article></body>") == "\n".join([WORDS] * 2)
    assert html_text.main_text(f"<body><article><p>One short sentence.</p></article>{fields * 3}</body>") == "One short sentence."
    assert html_text.main_text(f"<body><div>{PARA * 4}</div>{fields}</body>") == "\n".join([WORDS] * 4)


@pytest.mark.parametrize("name", ['class="comments"', 'id="comments"', 'class="comment-list"', 'class="ugc"', 'id="disqus_thread"', 'class="user-comments"', 'class="x" id="respond"'])
@pytest.mark.parametrize("tag", ["div", "section", "ul", "article"])
def test_reader_comments_go_whatever_their_size(name, tag):
    many = "<p>I have read this and think that it is very good indeed, thank you.</p>" * 8
    assert html_text.main_text(f"<body><article><p>One short sentence.</p></article><{tag} {name}>{many}</{tag}></body>") == "One short sentence."
    assert html_text.main_text(f"<body><article><p>One short sentence.</p><{tag} {name}>{many}</{tag}></article></body>") == "One short sentence."


def test_wrappers_named_after_comments_stay():
    for name in ('class="has-comments"', 'class="no-comments layout"', 'id="comments-open"'):
        assert html_text.main_text(f"<body><div {name}>{PARA * 3}</div></body>") == "\n".join([WORDS] * 3)


def test_cookie_notices_without_a_name():
    notice = "<div><p>We use cookies to give you the best of this site.</p></div>"
    assert html_text.main_text(f"<body>{notice}<div>{PARA * 9}</div></body>") == "\n".join([WORDS] * 9)
    baked = "<article><p>Two cookies a day are enough.</p></article>"
    assert html_text.main_text(f"<body>{baked}</body>") == "Two cookies a day are enough."


def test_references_are_decoded_within_a_text_node():
    assert html_text.main_text("<article><p>&am<b>p;</b> &amp;lt; &lt;b&gt; &#x41;&eacute;</p></article>") == "&amp; &lt; <b> Aé"


@pytest.mark.parametrize(
    "page",
    [
        "<article><p>x</p>" + "<b>" * 20_000 + "</i>" * 20_000,
        "<article><p>x</p><i><table><tr><td>" + "<b>" * 20_000 + "</i>" * 20_000,
        "<article><p>x</p>" + "<b><li>" * 20_000,
        "<article><p>x</p>" + "<span>" * 20_000 + "<div><span>" * 20_000,
        "<b>" * 300_000 + "x",
        "<table>" + "<tr><td>x" * 50_000,
    ],
)
def test_time_grows_with_the_page(page):
    began = time.process_time()
    assert "x" in html_text.main_text(page)
    assert time.process_time() - began < 6


def plain_densities(root):
    """Composite text density and sums, each node from its own subtree alone."""
    out = {}

    def parts(node):
        kids = [c for c in node.children if isinstance(c, html_text.Node) and not c.drop]
        chars = sum(len(c) for c in node.children if isinstance(c, str) and not c.isspace())
        tags = links = link_tags = 0
        for kid in kids:
            c, t, x, y = parts(kid)
            chars, tags, links, link_tags = chars + c, tags + t + 1, links + x, link_tags + y + (kid.tag in ("a", "button"))
        return chars, tags, chars if node.tag == "a" else links, link_tags

    whole = parts(root)
    share = whole[2] / max(whole[0], 1)

    def density(node):
        chars, tags, links, link_tags = parts(node)
        tags = max(tags, 1)
        if not links:
            return chars / tags
        base = math.log(chars / max(chars - links, 1) * links + share * chars + math.e)
        value = chars / links * tags / max(link_tags, 1)
        return chars / tags * (math.log(value) / math.log(base) if value > 0 and base > 1 + 1e-9 else 1.0)

    stack = [root]
    while stack:
        node = stack.pop()
        kids = [c for c in node.children if isinstance(c, html_text.Node) and not c.drop]
        out[id(node)] = (density(node), sum(density(k) for k in kids) + sum(len(c) for c in node.children if isinstance(c, str) and not c.isspace()))
        stack += kids
    return out


def test_densities_of_pages_against_plain_ones(spark):
    """Every page of the smallest table: densities, sums, core and threshold from their definition."""
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        root = html_text.parse(r.html or "")
        html_text.drop_named(root)
        nodes, want = html_text.measure(root), plain_densities(root)
        assert len(nodes) == len(want)
        for node in nodes:
            assert (node.density, node.density_sum) == pytest.approx(want[id(node)], rel=1e-9, abs=1e-9)
        core = max((n for n in nodes if n.chars), key=lambda n: n.density_sum)
        low, node = core.density, core
        while node is not None and node.tag not in ("html", "#root"):
            low, node = min(low, want[id(node)][0]), node.parent
        # all text of the core is in the result, and what is chosen outside of article and main reaches the threshold
        chosen = html_text.select(root)
        kept = {id(n) for c in chosen for n in html_text._post_order(c)}
        assert id(core) in kept
        for node in chosen:
            if not node.in_main and node.tag != "#run":
                assert any(want[id(n)][0] >= low for n in html_text._post_order(node) if id(n) in want)


def test_all_pages(spark):
    """The pages of the table keep their text in one article element; any text outside of it is not the article's."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r.page_id: r for r in html_text.extract_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1])
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner))
        want = "\n".join(p for p in parts if p)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_awkward_rows(spark):
    rows = [(1, "u", None, "x", 5), (None, None, "<p>a</p>", "x", 5), (2, "u", "", None, None), (2, "u", "", None, None)]
    out = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, Text string, n_chars int"))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in out.collect()) == [(0, "a", 1), (1, "", 0), (2, "", 0), (2, "", 0)]
    assert html_text.extract_text(out.limit(0).withColumn("html", out.url)).count() == 0
