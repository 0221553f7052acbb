import html
import re

import pytest

from strata.llm.html_extract import LABELLED, extract, grow, judge, main_text, op7_html_extract

TREE = grow(LABELLED[:, :-1], LABELLED[:, -1])


def test_tree_learns_its_table():
    assert all(judge(TREE, r[:-1]) == r[-1] for r in LABELLED)
    # leave one out
    right = sum(judge(grow(x[:, :-1], x[:, -1]), r[:-1]) == r[-1]
                for i, r in enumerate(LABELLED) for x in [LABELLED[[k for k in range(len(LABELLED)) if k != i]]])
    assert right / len(LABELLED) >= 0.85


def test_articles_of_the_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = {r.page_id: r for r in op7_html_extract(spark, "/root/testdata/sf0.01").collect()}
    assert set(got) == set(pages)
    for i, h in pages.items():
        body = h[h.index("<article>") + 9:h.index("</article>")]
        parts = [" ".join(html.unescape(re.sub(r"<b>|<br>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[i].text == "\n".join(p for p in parts if p)
        assert got[i].n_chars == len(got[i].text)


PAGES = [
    ("<body><nav><ul><li><a href=/>Home</a></ul></nav><article><header><h1>Title</h1></header><p>First&nbsp; <i>para</i>\n graph &amp;amp; &#233;&lt;<p>Second.</article><footer>end</footer>",
     "Title\nFirst para graph &amp; é<\nSecond."),
    ("<div class='cookie-notice'>We use cookies and we would like you to know about it in detail</div><main><p>Text of the page itself that matters.</p>"
     "<section id=comments><p>I liked this article very much, thanks for writing it</p></section></main>", "Text of the page itself that matters."),
    ("<article><p>One.</p><aside><p>Read also this long story about something else</p></aside><form><label>Your name</label></form><p>Two.</p>"
     "<script>if (a<b) document.write('<p>no</p>')</script><!-- <p>no</p> --></article>", "One.\nTwo."),
    ("<article><p>Cut off in the mid<a hre", "Cut off in the mid"),
    ("<article><p title='a>b'>Quoted</p><style>p{}</style></article>", "Quoted"),
    ("", ""), (None, ""), ("plain < text", None), ("<<<>>><p", None), ("<article>" + "<p>x</p>" * 20000 + "</article>", "\n".join("x" * 20000)),
]


LONG_A = "The council met on Tuesday to discuss the new bridge over the river and its likely cost to the town."
LONG_B = "Work is expected to begin in the spring, when the water is low enough for the first piers to be set."
BOTH = f"{LONG_A}\n{LONG_B}"
TWO = f"<p>{LONG_A}</p><p>{LONG_B}</p>"
TEASER = "<article class='teaser'><a href=/x>Ten other stories that you may want to read next</a></article>"

#: pages of ordinary layouts; the main text of each is BOTH, with a heading where given
ORDINARY = [
    (f"<div class='layout has-sidebar'><article>{TWO}</article><div class=sidebar><p>Weather today is fine and warm</p></div></div>", BOTH),
    (f"<div class='wrap no-sidebar'><article>{TWO}</article></div>", BOTH),
    (f"<div id='legal-news'><article>{TWO}</article></div>", BOTH),
    (f"<section class='social-policy'><article>{TWO}</article></section>", BOTH),
    (f"<main><div class='story share'>{TWO}</div></main>", BOTH),
    (f"<div class='content-sidebar-wrap'><main class=content>{TWO}</main><aside class='sidebar sidebar-primary'><p>{LONG_A}</p></aside></div>", BOTH),
    (f"<article><p class=\"a\"\">{LONG_A}</p><p title=it's>{LONG_B}</p></article>", BOTH),
    (f"<article><p data-x='1'' class=b>{LONG_A}</p><p a=\"1\"b=\"2\">{LONG_B}</p></article>", BOTH),
    (f"<article>{TWO}</article><section id=comments><article class=comment><p>{LONG_A}</p></article></section>", BOTH),
    (f"<article>{TWO}<section class='comments-area'><h2>3 comments</h2><ol class=comment-list><li><p>{LONG_B}</p></li></ol></section></article>", BOTH),
    (f"<article class='hentry has-comments'>{TWO}</article>", BOTH),
    (f"<article>{TWO}</article><div class='related-posts'>{TEASER}{TEASER}</div>", BOTH),
    (f"<article>{TWO}<div class='post-share'><a href=#>Share this</a> <a href=#>Mail it</a></div></article>", BOTH),
    (f"<div role=navigation aria-label='Main navigation'><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></div><main>{TWO}</main>", BOTH),
    (f"<div id=page class='site'><div id=content class='site-content'><div id=primary class='content-area'><main id=main class=site-main><article id=post-7 class='post-7 post type-post'><header class=entry-header><h1 class=entry-title>The bridge</h1></header><div class=entry-content>{TWO}</div><footer class=entry-footer>Posted in <a href=#>Town</a></footer></article></main></div></div><footer id=colophon class=site-footer>&copy; 2024 The Paper, all rights are reserved</footer></div>", f"The bridge\n{BOTH}"),
    (f"<div id=header><h1><a href=/>The Daily Paper</a></h1></div><div id=main>{TWO}</div><div id=footer><p>Imprint and contact of the paper and its owners</p></div>", BOTH),
    (f"<table><tr><td class=menu><a href=/a>A</a><br><a href=/b>B</a></td><td class=content>{TWO}</td></tr></table>", BOTH),
    (f"<div id=cookie-banner class='cookie-consent overlay'><p>We and our partners store information on your device, see the list of partners</p><button>OK</button></div><main>{TWO}</main>", BOTH),
    (f"<article><p>{LONG_A}</p><div class='ad-slot' id=ad1><p>Buy two bicycles and pay for one, only this week in our shop</p></div><p>{LONG_B}</p></article>", BOTH),
    (f"<article><p>{LONG_A}</p><figure><img src=a><figcaption>The old bridge in 1950</figcaption></figure><p>{LONG_B}</p></article>", f"{LONG_A}\nThe old bridge in 1950\n{LONG_B}"),
    (f"<article><p>{LONG_A} <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p><p>{LONG_B} <video src=v>Your browser shows no video</video></p></article>", f"{LONG_A} x=2\n{LONG_B} Your browser shows no video"),
    (f"<article><svg><title>Logo</title><path d='M0'/></svg>{TWO}</article>", BOTH),
    (f"<body class='single sidebar-right'><div class=container><div class=row><div class='col post'>{TWO}</div><div class='col sidebar'><ul><li><a href=#>One</a></ul></div></div></div>", BOTH),
    (f"<main><form class=search><input name=q><label>Search the whole site</label></form>{TWO}<form id=respond><label>Leave a reply to this story</label><textarea>x</textarea></form></main>", BOTH),
    (f"<nav class=breadcrumbs><a href=/>Home</a> &gt; <a href=/t>Town</a></nav><div class=articleBody>{TWO}</div>", BOTH),
    (f"<article><blockquote>{LONG_A}</blockquote><ul><li>{LONG_B}</li></ul></article>", BOTH),
    (f"<article><h2>Costs</h2>{TWO}<div class='newsletter signup'><p>Get the news of the town by mail every morning, free of charge</p></div></article>", f"Costs\n{BOTH}"),
    (f"<div class=masthead><p>Founded in 1890, the oldest paper of the whole valley</p></div><div class='story-body'>{TWO}</div><div class=copyright>All rights reserved by the paper and its writers</div>", BOTH),
    (f"<main><p>{LONG_A}<p>{LONG_B}<div id=disqus_thread><p>{LONG_A}</p></div></main>", BOTH),
    (f"<div class='td-comments-title'><p>{LONG_B}</p></div><article>{TWO}</article>", BOTH),
    (f"<div class='pagination links'><a href=1>1</a> <a href=2>2</a></div><div class=post>{TWO}</div><div class='tags list'><a href=#>bridge</a></div>", BOTH),
    (f"<ARTICLE CLASS=Main><P>{LONG_A}</P><P ID='Share'>{LONG_B}</P></ARTICLE>", BOTH),
    (f"<article><p>{LONG_A}</p><noscript><img src=p></noscript><template><p>no</p></template><p>{LONG_B}</p><iframe src=x>no</iframe></article>", BOTH),
    (f"<div class='widget widget-text'><p>About us: we write about the town since 1890 and like it</p></div><div id=story>{TWO}</div>", BOTH),
]


@pytest.mark.parametrize("page, want", ORDINARY)
def test_ordinary_layouts(page, want):
    assert main_text(page, TREE) == want


def test_odd_attributes_take_linear_time():
    for page in ("<p " + "a='" * 50_000, "<p " + "=" * 50_000 + ">x", "<p " + "a=b " * 50_000, "<article><p>" + "<i x=\"" * 20_000):
        main_text(page, TREE)


@pytest.mark.parametrize(("page", "want"), PAGES)
def test_layouts(page, want):
    got = main_text(page, TREE) if page else ""
    assert want is None or got == want


def test_rows(spark):
    df = spark.createDataFrame([(i, None, h, "t") for i, (h, _) in enumerate(PAGES + PAGES[:1])], "page_id long, url string, html string, text string")
    rows = extract(df).collect()
    assert len(rows) == len(PAGES) + 1 and all(r.n_chars == len(r.text) for r in rows)
    assert extract(df.limit(0)).count() == 0
