"""PII, language ID, quality rules and main text of pages."""

from __future__ import annotations

import random
import re
import zipfile  # noqa: F401

import pytest
from brute import personal, sha, statistics
from hypothesis import given, settings
from hypothesis import strategies as st

from culvert.llm import html_text, langid, pii, quality


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+% 0123456789()4é\n", max_size=60))
def test_base_spans_follow_the_patterns(t):
    assert [s for s in pii.find(t) if s[0] in pii.BASE_KINDS] == personal(t)


def test_base_spans_of_cards_and_phones():
    r = random.Random(2)
    for _ in range(300):
        t = " x ".join("".join(r.choice("0123456789 -+.()") for _ in range(r.randint(5, 40))) for _ in range(4)) + " 4111-1111 1111 1111 +49 (30) 123.456"
        assert [s for s in pii.find(t) if s[0] in pii.BASE_KINDS] == personal(t)


def test_added_spans_and_masking():
    t = 'see https://u:p@host.example.com/a?b=c. IBAN: DE89 3704 0044 0532 0130 00, token = "11acdfb36bb72224148e6160", account no. 12345678'
    assert [k for k, *_ in pii.find(t) if k not in pii.BASE_KINDS] == ["url", "iban", "account", "secret"]
    masked = pii.redact(t)
    assert not any(x in masked for x in ("host.example", "3704", "11acdf", "12345678")) and masked.startswith("see [url]. IBAN: [iban], token")
    assert pii.redact("plain prose, nothing else.") == "plain prose, nothing else."


def test_pii_frame(spark, edge, nothing):
    got = pii.with_spans(edge, "found")
    for r in got.collect():
        assert [tuple(s) for s in r["found"] if s["kind"] in pii.BASE_KINDS] == personal(r["text"])
        assert r["doc"] == "x"
    assert pii.with_spans(nothing, "found").count() == 0
    texts = {r["doc_id"]: r["text"] for r in pii.masked(edge).collect()}
    assert texts[1] is None and texts[2] == "" and "example.org" not in texts[16] and "[card]" in texts[16]


def _langs(rows_of, spark):
    words = {"aa": "the and with from hello".split(), "bb": "der und mit von hallo".split(), "cc": "que los para con hola".split()}
    r = random.Random(1)
    rows, langs = [], []
    for i in range(300):
        lang = r.choice(sorted(words))
        rows.append((i, " ".join(r.choice(words[lang]) for _ in range(r.randint(3, 60)))))
        langs.append(lang)
    return rows_of(spark, rows, lang=lambda i: langs[i] if i % 9 else None), langs


def test_language_id_learns_and_handles_edges(spark, rows_of, edge, nothing):
    docs, langs = _langs(rows_of, spark)
    got, model = langid.language_id(docs)
    rows = got.collect()
    assert sum(r["_lang_id"]["lang"] == langs[r["doc_id"]] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["_lang_id"]["score"] <= 1 for r in rows) and model.code.shape == (3, 3)
    for r in langid.predict(edge, model, "p").collect():
        letters = bool(re.search(r"[^\W\d_]", r["text"] or ""))
        assert (r["p"]["lang"] == "und") == (not letters) and (letters or r["p"]["score"] == 0)
    none = langid.fit(nothing)
    assert {r["p"]["lang"] for r in langid.predict(edge, none, "p").collect()} == {"und"}
    one = langid.fit(rows_of(spark, [(1, "abc def")], lang=lambda i: "aa"))
    assert {(r["p"]["lang"], r["p"]["score"]) for r in langid.predict(docs, one, "p").collect()} == {("aa", 1.0)}


def test_held_out_rows_never_train_and_other_columns_never_predict(spark, rows_of):
    docs, _ = _langs(rows_of, spark)
    a, _ = langid.language_id(docs)
    b, _ = langid.language_id(docs.withColumn("lang", __import__("pyspark").sql.functions.when(langid.held_out(), "zz").otherwise(docs["lang"])))
    key = lambda rows: sorted((r["doc_id"], tuple(r["_lang_id"])) for r in rows)
    assert key(a.collect()) == key(b.collect())


def test_codewords_are_distinct_and_apart():
    for k in (2, 3, 4, 5, 9, 30):
        c = langid.codewords(k)
        assert len({tuple(r) for r in c}) == k
        assert min((c[i] != c[j]).sum() for i in range(k) for j in range(i)) >= 1


def test_statistics(spark, edge, nothing):
    want = sorted(((r["doc_id"] or -1), *statistics(r["text"])) for r in edge.collect())
    got = sorted(((r["doc_id"] or -1), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality.statistics(edge).collect())
    assert got == want
    assert quality.statistics(nothing).count() == 0


def test_repeat_words_on_repetitive_texts(spark, rows_of):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randint(0, 25)))) for i in range(120)]
    got = {x["doc_id"]: x["n_repeat_words"] for x in quality.statistics(rows_of(spark, rows)).collect()}
    assert got == {i: statistics(t)[4] for i, t in rows}


def test_decision_list_finds_junk_and_keeps_clean(spark, rows_of):
    r = random.Random(4)
    rows, bad = [], {}
    for i in range(600):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(r.randint(60, 120))]
        bad[i] = i % 4 == 0
        rows.append((i, " ".join(w + "$$$" for w in words) if bad[i] else " ".join(words)))
    docs = rows_of(spark, rows)
    labels = spark.createDataFrame([(i, None if i % 7 == 0 else int(not b)) for i, b in bad.items()], "doc_id long, quality int")
    got = {x["doc_id"]: (x["kept"], x["rule"]) for x in quality.judged(docs, labels).collect()}
    assert all(got[i][0] != b for i, b in bad.items())
    unlabelled = quality.judged(docs, labels.limit(0)).collect()
    assert all(x["kept"] for x in unlabelled)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<nav><ul><li><a href="/a">Home page</a></li></ul></nav><div class="ad">Buy now a very long advert text that goes on and on and on with many words inside it</div>
<div class="cookie-notice">We use cookies and so on to make this site work as well as it can for you</div>
<article><header><h1>Title &amp; more</h1></header><p>First   paragraph with <b>bold</b> and <a href="x">link</a>.<br>Next &lt;line&gt;<p>Unclosed
<div class="comments"><p>Reader says something that is long enough to look like an article paragraph, yes.</p></div><form>Name <input></form><p>Last.</p></article>
<aside>Side</aside><footer>&copy; site</footer></body></html>"""


def test_main_text_of_a_page():
    tree = html_text.train()
    assert html_text.main_text(PAGE, tree) == "Title & more First paragraph with bold and link. Next <line> Unclosed Last."
    assert all(html_text.decide(tree, x) == y for x, y in html_text.LABELLED)


def test_main_text_without_article_element_and_broken_markup():
    tree = html_text.train()
    para = "words of a longer paragraph that is plainly part of the text of the page and nothing else at all here"
    page = f"<body><ul><li><a href=1>One</a><li><a href=2>Two</a></ul><div><p>{para}</p><p>Short.</p><p>{para}</p></div><div id=footer>{para}</div>"
    assert html_text.main_text(page, tree) == f"{para} Short. {para}"
    for broken in ("", "<", "<p", "<!--", "<article><p>a < b and c > d</article", "</p></div>", "<script>never closed", "<p>" * 5000 + "x", "&#0;&bogus;&#xZZ;"):
        html_text.main_text(broken, tree)


def test_main_text_frame(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "c"), (2, None, None, "c"), (3, "u", "", "c")], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in html_text.extracted(pages).collect()}
    assert got[2] == "" and got[3] == "" and got[1].startswith("Title")
    assert html_text.extracted(pages.limit(0)).count() == 0
    assert sha("")


MORE = "It goes on with many more words than any menu would have, so that it is the main text of the page."


@pytest.mark.parametrize("page, want", [
    (f"<article><p>Here a long paragraph <a title=it's href=x>with a link</a> and so on. </p><p>It doesn't end. {MORE}", f"Here a long paragraph with a link and so on. It doesn't end. {MORE}"),
    (f"<p>{MORE}<script src=a />var x=1; secret();</script> after", f"{MORE} after"),
    (f"<p title=\"a > b\">{MORE}", MORE), (f"<p a='x>y' b=\"it's\">{MORE}", MORE), (f"<p>{MORE}<svg/> end", f"{MORE} end"),
    ("<p>Hello world", "Hello world"), ("<body>Short text</body>", "Short text"), ("<div><p>A single paragraph page only</p></div>", "A single paragraph page only"),
    ("<nav>Home</nav>", ""), ("<a href=x>link</a>", ""),
])
def test_quotes_scripts_and_short_pages(page, want):
    assert html_text.main_text(page, html_text.train()) == want


def test_articles_equal_a_standard_parser():
    """Random articles with odd attributes, read by the standard library's parser."""
    from html.parser import HTMLParser

    class Text(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.skip = [], 0

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style")
            self.out.append(" " if tag == "p" else "")

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style")
            self.out.append(" " if tag == "p" else "")

        def handle_data(self, data):
            self.out.append("" if self.skip else data)

    r = random.Random(6)
    tree = html_text.train()
    word = lambda: r.choice(["alpha", "it's", "&amp;", "x&lt;y", "&eacute;t\u00e9", "caf&#233;", "\u6771\u4eac", "5", "\"said\"", "end."])
    tag = lambda: r.choice(["<b>{}</b>", "<i title='a>b'>{}</i>", "<em data-x=\"it's > 3\">{}</em>", "<a href=x title=it's>{}</a>", "{}", "{}", "{}<script>var a = '<p>';</script>", "<span lang=en>{}</span>"])
    for _ in range(200):
        page = "<html><body><article>" + "".join("<p>" + " ".join(tag().format(word()) for _ in range(r.randint(20, 60))) + "</p>" for _ in range(r.randint(1, 5))) + "</article></body></html>"
        p = Text()
        p.feed(page)
        p.close()
        assert html_text.main_text(page, tree) == " ".join("".join(p.out).split())
