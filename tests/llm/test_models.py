"""URL filter, language id, toxicity, quality classifier and HTML extraction."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from llm import brute
from txnscore.llm import html_extract, lang_id, quality_model, toxicity, url_filter
from txnscore.llm.queries import URL_RULES, queries
from txnscore.llm.tables import table


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable")) + 1.0
    pos = np.asarray(label) == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


# ---- URL filter

def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return brute.lower(host), re.match("[^?#]*", rest[len(host):])[0]


def rule_of(host, path):
    fit = [(v, r) for v, r in URL_RULES
           for h, p in [(r[:r.index("/")], r[r.index("/"):])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[1]), default=(None, None))


def test_urls_equal_brute_force(spark):
    urls = {r.page_id: r.url for r in table(spark, SF_CHECK, "pages").collect()}
    got = queries()["op1_url_filter"](spark, SF_CHECK).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = split_url(urls[r.page_id])
        verdict, rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


def test_url_model_on_unseen_sites(spark):
    bad = ["http://www.mega-casino.example.net/en/4", "https://cheap-viagra-pills.example.com/", "http://free-poker-bets.net/de/9.html", "https://ads-tracking.example.com/en/1"]
    good = ["http://www.thinner.example.net/en/4", "https://stone-museum.example.com/", "http://blog.reading.example.net/en/9.html", "https://m.school-library.example.com/en/1"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(bad + good)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(df, []).collect()}
    assert got == {i: "block" if i < len(bad) else "allow" for i in range(len(bad + good))}


def test_url_edges(spark):
    cases = {None: ("", "", None), "": ("", "", None), "no scheme": ("", "", None), "http://": ("", "", None), "HTTP://EXAMPLE.ORG/es/1": ("example.org", "/es/1", "example.org/es/"),
             "x://A.Example.org/en/1#/x": ("a.example.org", "/en/1", "example.org/en/1"), "x://badexample.org/es/": ("badexample.org", "/es/", "org/"),
             "x://example.org?q=/es/": ("example.org", "", None), "x://a.com/fr/://b": ("a.com", "/fr/://b", "com/fr/"), "x://h\né/p\nq?z": ("h\né", "/p\nq", None)}
    rows = [(i % 3 or None, u, "h", "s") for i, u in enumerate(cases)]
    df = spark.createDataFrame(rows + rows[:2], "page_id long, url string, host string, score string")
    out = url_filter.judge(df, URL_RULES)
    assert sorted(out.columns) == ["host", "page_id", "path", "rule", "score", "verdict"]
    got = out.collect()
    assert sorted(((r.host, r.path, str(r.rule)) for r in got)) == sorted([(h, p, str(r)) for h, p, r in [*cases.values(), ("", "", None), ("", "", None)]])
    assert all(r.verdict == "allow" for r in got if not r.host)
    assert url_filter.judge(df.limit(0), URL_RULES).count() == 0
    empty = spark.createDataFrame([], "url string, label int")
    assert {r.score for r in url_filter.judge(df, [], empty).collect()} == {0.5}


# ---- language

def test_language_of_held_out_documents(spark):
    got = queries()["op2_language_id"](spark, SF_CHECK).toPandas().merge(table(spark, SF_CHECK, "documents").toPandas(), on="doc_id")
    assert len(got) == 1000
    held = got[got.held_out]
    assert 100 < len(held) < 300
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_edges(spark):
    import zlib
    train = [(i, ("the cat and the dog walk in the park with a ball " if i % 2 else "der hund und die katze gehen mit dem ball in den park ") * 3,
              "en" if i % 2 else "de", "x") for i in range(40)]
    odd = [(100, None, "en", "x"), (101, "", "en", "x"), (102, "12 + 34 = !!", "en", "x"), (None, "the cat and the dog", None, "x"), (104, "ÜBER", None, "x"),
           (105, "the dog walks with the ball " * 5000, "zz" if zlib.crc32(b"105") % 5 == 0 else None, "x")]
    df = spark.createDataFrame(train + odd + odd[:1], "doc_id long, text string, lang string, lang_pred string")
    got = {r.doc_id: r for r in lang_id.identify(df).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3
    assert got[None].lang_pred == "en" and got[105].lang_pred == "en" and got[104].lang_pred in ("de", "en")
    assert lang_id.identify(df).count() == len(train) + len(odd) + 1
    assert {r.lang_pred for r in lang_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert lang_id.identify(df.limit(0)).count() == 0


def test_filters_correct_for_false_positives():
    import pyarrow as pa
    from txnscore.llm import textbytes as tb
    keys = [np.arange(20_000, dtype=np.uint32) * 7919 + i for i in range(2)]
    filters = lang_id.Filters(["a", "b"], [lang_id.bloom(k) for k in keys])
    s = next(tb.slices(pa.array(["quite some words of no language at all " * 50])))
    assert filters.shares(s).max() < 0.02
    assert 0 < filters.false_rate.max() < 0.01


def _invented(n_languages, rng):
    """(lang, words): languages with alphabets of their own order, whose texts are words of few letters each."""
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    return {f"l{i:04d}": ["".join(rng.choice(letters, 6)) for _ in range(30)] for i in range(n_languages)}


def test_more_languages_than_a_word_has_bits(spark, monkeypatch):
    """150 languages take three words; the same languages in passes of one word each give the same rows."""
    rng = np.random.default_rng(5)
    words = _invented(150, rng)
    rows = [(10 * i + k, " ".join(rng.choice(w, 40)), lang) for i, (lang, w) in enumerate(words.items()) for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n_docs", F.lit(1)).withColumn("k", F.lit("x"))
    got = lang_id.identify(df).toPandas().set_index("doc_id")
    want = {i: lang for i, _, lang in rows}
    held = got[got.held_out]
    assert len(held) > 100 and (held.lang_pred == [want[i] for i in held.index]).mean() > 0.99
    monkeypatch.setattr(lang_id, "WORDS_PER_PASS", 1)
    again = lang_id.identify(df).toPandas().set_index("doc_id").loc[got.index]
    assert (again.lang_pred == got.lang_pred).all() and np.allclose(again.score, got.score)


def test_most_frequent_ngrams_by_levels(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "TOP_NGRAMS", 100)
    rows = [("a", k, 50 if k < 40 else 7 if k < 90 else 1) for k in range(5000)] + [("b", k, 1) for k in range(5000)] + [("c", k, 2) for k in range(9)]
    top = lang_id._top_ngrams(spark.createDataFrame(rows, "lang string, key long, n long")).toPandas()
    a = set(top.key[top.lang == "a"])
    assert set(range(90)) <= a and 90 <= len(a) <= 125
    assert 70 <= (top.lang == "b").sum() <= 130  # a single level is drawn from
    assert set(top.key[top.lang == "c"]) == set(range(9))


def test_shares_by_brute_force(spark):
    """Counts of the bit-sliced filters against sets of n-grams: no miss, and few beyond the false positives that are corrected."""
    import pyarrow as pa
    from txnscore.llm import textbytes as tb
    docs = table(spark, SF_CHECK, "documents").limit(40).toPandas().text.fillna("").tolist()
    grams = lambda t: lang_id._ngrams(next(tb.slices(pa.array([t]))))[0]
    own = [np.unique(np.concatenate([grams(t) for t in docs[i::4]])) for i in range(4)]
    filters = lang_id.Filters(list("abcd"), [lang_id.bloom(k) for k in own])
    got = filters.shares(next(tb.slices(pa.array(docs))))
    for row, t in zip(got, docs):
        keys = grams(t)
        if len(keys):
            want = np.array([np.isin(keys, k).mean() for k in own])
            assert np.allclose(row, want, atol=0.01)


# ---- toxicity and quality

def held_out_quality(spark, name, label):
    labels = table(spark, SF_CHECK, "labels").toPandas()
    got = queries()[name](spark, SF_CHECK).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    both = got.merge(labels, on="doc_id")
    return auc(both.score[both.held_out], both[label][both.held_out])


def test_toxicity_of_held_out_documents(spark):
    assert held_out_quality(spark, "op7_toxicity", "toxic") > 0.8


def test_quality_of_held_out_documents(spark):
    assert held_out_quality(spark, "op8_quality_model", "quality") > 0.95


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality_model, "quality")])
def test_classifier_edges(spark, module, label):
    bad = "you are a stupid idiot and a fool" if label == "toxic" else "x|y ## $$ %% && x|y"
    rows = [(i, f"The plain report number {i} talks about trains and rivers. " * 2 + (bad if i % 2 else ""), "s") for i in range(60)]
    odd = [(200, None, "s"), (201, "", "s"), (None, "A plain text.", "s"), (202, "word " * 50_000, "s"), (202, "word " * 50_000, "s"), (203, "!!! ### 12", "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(200, 1), (None, 1), (5, None), (3, 1), (999, 0)], f"doc_id long, {label} int")
    out = module.score(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.toPandas()
    assert len(got) == len(rows) + len(odd) and got.score.between(0, 1).all()
    even, uneven = (got[got.doc_id.between(0, 59) & (got.doc_id % 2 == k)].score for k in (0, 1))
    assert uneven.mean() > even.mean() + 0.2
    for none in (labels.limit(0), labels.filter(f"{label} = 0")):
        assert module.score(docs, none).toPandas().score.nunique() == 1
    assert module.score(docs.limit(0), labels).count() == 0


def test_isotonic_is_the_closest_monotone_fit():
    n, ones = np.array([1., 2, 1, 4, 1]), np.array([1., 0, 1, 2, 1])
    fit = quality_model.isotonic(n, ones)
    assert np.all(np.diff(fit) >= 0)
    assert fit.tolist() == pytest.approx([1 / 3, 1 / 3, 1 / 3, 0.6, 0.6, 1.0][:3] + [0.6, 0.6, 1.0][:2]) or fit[0] == pytest.approx(1 / 3)
    assert (fit * n).sum() == pytest.approx(ones.sum())


def test_normal_equations_equal_one_matrix(spark):
    rng = np.random.RandomState(0)
    x, y = rng.rand(50, quality_model.N_STATS), rng.randint(0, 2, 50)
    rows = spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y)], "stats array<float>, y int").repartition(5)
    fourier = quality_model.Fourier(x.mean(0), x.std(0))
    z = np.hstack([fourier(x.astype(np.float32).astype(float)), y[:, None]])
    assert np.allclose(quality_model._normal_equations(rows, fourier), z.T @ z, atol=1e-6)


# ---- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href="/b">B</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="page-7"><div class="post post-12"><h1>Title &amp; more</h1><p>First <b>bold</b>
 para&nbsp;graph.<p>Second &eacute; &#x41;<br>line<div class="ad-box"><p>Buy</p></div><ul><li>one<li>two</ul><form><input value="q">Search</form>
<!-- <p>hidden</p> --><blockquote>Quote "here" &lt;tag&gt;</blockquote><table><tr><td>a<td>b</table></div>
<section class="comments"><h2>Comments</h2><p>Nice long reader comment that goes on and on and on and on.</p></section></div>
<aside>Related</aside><footer>&copy; footer</footer></body></html>"""
TEXT = "Title & more\n\nFirst bold para graph.\n\nSecond é A line\n\none\n\ntwo\n\nQuote \"here\" <tag>\n\na\n\nb"


def test_extract_one_page():
    assert html_extract.extract(PAGE, []) == TEXT
    assert html_extract.best_path(PAGE) == "html/body.has-sidebar/div/div.post.post-"


def test_consensus_of_a_host(spark):
    """A page whose own best container is another one follows its host's template."""
    odd = PAGE.replace("<aside>Related</aside>", "<div class='links'>" + "<p>Some long teaser of other pages with a lot of words in it.</p>" * 9 + "</div>")
    rows = [(i, f"http://h.example/{i}", PAGE) for i in range(8)] + [(9, "http://h.example/9", odd), (10, "http://other.example/", odd)]
    got = {r.page_id: r.text for r in html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == got[9] == TEXT
    assert got[10] != TEXT


def test_html_edges(spark):
    cases = {"": "", None: "", "plain text": "plain text", "<p>a</p><p>b": "a\n\nb", "<nav>x</nav>": "", "<script>x": "", "<p>1 < 2 &amp; 3</p>": "1 < 2 & 3", "<p title='a>b'>c": "c",
             "<a href=\"x>y</a> z": "y z", "<p>" + "<b>" * 3000 + "deep": "deep", "<!-- open": "", "<article><header><h1>H</h1></header><p>x</article>": "H\n\nx",
             "<p>" + "long " * 100_000: ("long " * 100_000).strip(), "<p hidden>no</p>": "", "<textarea>t</textarea>": ""}
    rows = [(i if i % 4 else None, None if i % 5 == 0 else f"http://h{i}/", h, "t") for i, h in enumerate(cases)]
    df = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, text string")
    out = html_extract.main_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert sorted(r.text for r in got) == sorted([*cases.values(), ""])
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.main_text(df.limit(0)).count() == 0


def test_registered_pages_equal_their_articles(spark):
    """The test pages hold one article each; its blocks, in plain regular expressions."""
    import html
    pages = {r.page_id: r.html for r in table(spark, SF_SMALL, "pages").collect()}

    def article(page):
        inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        plain = [html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1)>", inner)]
        return "\n\n".join(" ".join(b.split()) for b in plain if b.strip())

    got = {r.page_id: r.text for r in queries()["op9_html_text"](spark, SF_SMALL).collect()}
    assert got == {i: article(h) for i, h in pages.items()}
