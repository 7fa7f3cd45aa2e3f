"""HTML extraction: no part of an article is lost to templates, container choice or skip words."""

from txnscore.llm import html_extract

LONG = "This sentence is a part of the long text of the article and says a thing or two. " * 8


def page(body):
    return f"<html><head><title>t</title></head><body><nav><a href='/'>Home</a></nav>{body}<footer>Foot</footer></body></html>"


def test_a_template_with_a_small_share_of_the_page_is_not_used(spark):
    usual = page(f"<div class='content'><p>{LONG}</p></div>")
    rare = page(f"<div class='content'><p>A short teaser.</p></div><div class='story'><p>{LONG}</p></div>")
    assert html_extract.extract(rare, [html_extract.best_path(usual)]) == LONG.strip()
    rows = [(k, "http://a.example/p", usual) for k in range(9)] + [(9, "http://a.example/q", rare)]
    got = html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert [r.text for r in got.filter("page_id = 9").collect()] == [LONG.strip()]


def test_a_page_of_another_layout_keeps_both_parts_and_no_side_part(spark):
    usual = page(f"<div class='content'><p>{LONG}</p></div><div class='voices'><p>Well said, I think.</p></div>")
    teaser, story = LONG[:250].strip(), " ".join([LONG.strip()] * 2)
    rare = page(f"<div class='content'><p>{teaser}</p></div><div class='feature'><p>{story}</p></div>"
                "<div class='voices'><p>So do I.</p></div>")
    # the voices of readers are longer than the article here, but stand beside the winner elsewhere
    loud = page(f"<div class='content'><p>{LONG}</p></div><div class='voices'>{f'<p>{LONG}</p>' * 4}</div>")
    rows = [(k, "http://a.example/p", usual) for k in range(18)] + [(18, "http://a.example/q", rare), (19, "http://a.example/r", loud)]
    got = {r.page_id: r.text for r in html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == got[19] == LONG.strip()
    assert got[18] == f"{teaser}\n\n{story}"


def test_headline_and_lead_beside_the_content_are_kept():
    post = page(f"<div class='wrap'><div class='post'><h1>Title</h1><p>The lead.</p><div class='content'><p>{LONG}</p></div></div></div>")
    assert html_extract.extract(post, []) == f"Title\n\nThe lead.\n\n{LONG.strip()}"
    # the page's own template is the content alone
    plain = page(f"<div class='wrap'><div class='post'><div class='content'><p>{LONG}</p></div></div></div>")
    assert html_extract.extract(post, [html_extract.best_path(plain)]) == f"Title\n\nThe lead.\n\n{LONG.strip()}"


def test_skip_words_do_not_reach_headings_paragraphs_and_heading_ids():
    body = (f"<article><div class='article-header'><h1>Life</h1></div><h2 id='search-for-life'>Search for life</h2><p class='notice'>{LONG}</p>"
            f"<section id='comment-on-life'><h3>A comment on life</h3><p>Inside.</p></section>"
            "<div class='share-buttons'>Share</div><div id='comments'><h3>Comments</h3><p>Nice.</p></div></article>")
    assert html_extract.extract(page(body), []) == f"Life\n\nSearch for life\n\n{LONG.strip()}\n\nA comment on life\n\nInside."
