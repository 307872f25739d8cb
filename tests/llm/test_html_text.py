import random
import time

import pytest

from corvane.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<!-- ad --><div class="ad">Buy</div><article><h1>Ti&amp;tle</h1><p>One <b>bo<i>ld</i></b> two<br>three&nbsp;four
 five<p>six &lt;tag&gt; &eacute;</p><aside>side</aside><form>Search <input></form><p></p></article>
<section id="comments"><p>Nice!</p></section><footer>&copy; host</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame([(*row, "x") for row in rows], "page_id bigint, url string, html string, host string")


def texts(frame):
    return {row.page_id: row.text for row in frame.collect()}


def test_article_text(spark):
    row = html_text.main_text(pages(spark, [(1, "http://a.b/c", PAGE)])).first()
    assert row.text == "Ti&tle One bold two three four five six <tag> é"
    assert (row.url, row.n_chars) == ("http://a.b/c", len(row.text))


def test_hosts_decide_what_markup_leaves_open(spark):
    shared = "<div>All rights of this host are kept for ever</div>"
    page = lambda at: f"<html><body>{shared}<div>Story {at} tells of {'x' * at} and more of {at}</div><p>Call us on the phone for advice today friend</p></body></html>"
    rows = [(at, "https://One.example/p", page(at)) for at in range(1, 5)] + [(9, "https://two.example/", page(9))]
    found = texts(html_text.main_text(pages(spark, rows)))
    for at in range(1, 5):
        assert found[at] == f"Story {at} tells of {'x' * at} and more of {at}"
    assert found[9].startswith("All rights of this host") and found[9].endswith("today friend")


def test_runs_between_covered_tokens_stay(spark):
    lead = "read more news from our city desk now"
    rows = [(at, "http://h/", f"<div>{lead} own {at} words of page {at}</div>") for at in range(1, 4)]
    assert texts(html_text.main_text(pages(spark, rows))) == {at: f"{at} words of page {at}" for at in range(1, 4)}


def test_repeated_runs_against_plain_search(spark):
    rows = [(1, "http://h/", "<p>a b c d e f g</p>"), (2, "http://h/", "<p>z b c d e f g</p>"), (3, "http://i/", "<p>a b c d e f g</p>")]
    found = html_text.parsed(pages(spark, rows), "page_id", "url", "html")
    assert [row.host for row in html_text.repeated_runs(found).collect()] == ["h"]
    assert html_text.repeated_runs(found, 5).count() == 2


def test_equal_pages_are_no_evidence(spark):
    rows = [(at, "http://h/", "<div>the very same page of many words here</div>") for at in (1, 2, 2)]
    assert [row.text for row in html_text.main_text(pages(spark, rows)).collect()] == ["the very same page of many words here"] * 3


def test_cases(spark):
    rows = [(1, None, None), (2, "http://h/", ""), (3, "no url", "plain text only"), (4, "http://h/", "<article>cut off <b"),
            (None, "http://h/", "<article>x</article>"), (6, "http://h/", "<article>" + "word " * 50_000 + "</article>"),
            (7, "http://h/", "<p title=\"a>b\">q</p><p title='unclosed>r</p>"), (8, "http://h/", "<main>m</main><p>o</p>"),
            (9, "http://h/", "<article class='has-sidebar'>kept</article>")]
    found = texts(html_text.main_text(pages(spark, rows)))
    assert [found[at] for at in (1, 2, 3, 4, None)] == ["", "", "plain text only", "cut off", "x"]
    assert len(found[6]) == 5 * 50_000 - 1
    assert found[7].startswith("q") and found[8] == "m o" and found[9] == "kept"
    assert html_text.main_text(pages(spark, [])).count() == 0


def test_words_shared_by_articles_stay(spark):
    for count in (6, 13, 20):
        shared = " ".join(f"shared{at}" for at in range(count))
        rows = [(at, "http://h/", f"<div>Story{at} {shared} ends at {at}</div><div>Yes.</div>") for at in (1, 2)]
        rows += [(at, "http://h/", f"<div>Other {at} text</div>") for at in range(3, 9)]
        found = texts(html_text.main_text(pages(spark, rows)))
        for at in (1, 2):
            assert found[at] == f"Story{at} {shared} ends at {at} Yes."


def test_long_substrings_go_and_all_unique_words_stay(spark):
    long = " ".join(f"terms{at}" for at in range(30))
    rows = [(at, "http://h/", f"<div>A{at} {long} z{at}</div><div>{long}</div>") for at in (1, 2)]
    rows += [(at, "http://h/", f"<div>Other {at} text</div>") for at in range(3, 9)]
    found = texts(html_text.main_text(pages(spark, rows)))
    assert found[1] == "A1 z1" and found[2] == "A2 z2" and found[5] == "Other 5 text"


def test_class_words_do_not_hide_articles():
    text = lambda source: [text for kind, text in html_text.blocks_of(source) if kind == html_text.TEXT]
    for name in ("post-12 post type-post tag-news", "post search-result", "entry social-policy", "related-1"):
        assert text(f"<article class='{name}'><p>kept</p></article>") == ["kept"]
        assert text(f"<div class='{name}'><div class='alert-x'><article>kept</article></div></div>") == ["kept"]
        assert text(f"<main class='{name}'>kept</main>") == text(f"<div role=main class='{name}'>kept</div>") == ["kept"]
    page = "<div class='post tag-news'><h1>Title</h1><article>kept<p class='tags'>tag</p><div class='share'>x</div></article></div>"
    page += "<div class='social'>follow</div><section id='comments'><article>Nice!</article></section>"
    page += "<div class='related'><article>other</article></div>"
    assert html_text.blocks_of(page) == [
        ("open", "Title"), ("text", "kept"), ("chrome", "tag"), ("chrome", "x"), ("chrome", "follow"), ("chrome", "Nice!"), ("chrome", "other"),
    ]
    assert text("<nav><article>menu</article></nav><article hidden>x</article>") == []


@pytest.mark.parametrize("piece", ["<a ", '<p title="', "<p '\">", "<div>", "</p>", "<!--", "<script>", "<b title='x>"])
def test_a_page_of_one_megabyte_takes_linear_time(piece):
    started = time.process_time()
    html_text.blocks_of((piece * (1 + 10**6 // len(piece)))[: 10**6])
    assert time.process_time() - started < 15


def test_deep_pages_with_unmatched_ends():
    started = time.process_time()
    assert html_text.blocks_of("<div>" * 50_000 + "</p>" * 50_000 + "text") == [("open", "text")]
    assert time.process_time() - started < 15


def test_tags_end_outside_quotes():
    page = "<p title='a > b'>one</p><p title='c>two</p><!-- > --><script>a > b</script><a href=\">\">three</a> 1 < 2"
    assert [text for _, text in html_text.blocks_of(page)] == ["one", "two", "three 1 < 2"]


def test_the_host_array_is_sorted_and_counts_pages_as_plain_search_does(spark):
    draw = random.Random(5)
    passage = lambda: " ".join(draw.choice("abc") for _ in range(draw.choice((1, 2, 3, 5, 9, 14, 30))))
    rows = [(at, f"http://h{at % 3}/", "".join(f"<p>{passage()}</p>" for _ in range(4))) for at in range(60)]
    found = html_text.parsed(pages(spark, rows + rows[:7]), "page_id", "url", "html")
    length, long = 3, 3 * html_text.LONG
    array = html_text.host_array(found, length)
    for part in array.rdd.glom().collect():
        keys = [(row.host, bytes(row.suffix), row.whole) for row in part]
        assert keys == sorted(keys)
    expected = {}
    for at, _, source in rows:
        host, blocks = f"h{at % 3}", [tuple(text.split()) for _, text in html_text.blocks_of(source)]
        for block in blocks:
            for wide, size in ((True, length), (False, long)):
                runs = {block[begin : begin + size] for begin in range(len(block) - size + 1)}
                if len(block) < size and (wide or len(block) >= length):
                    runs.add(block)
                for run in runs:
                    expected.setdefault((host, wide, run), set()).add(at)
    counts = sorted((host, wide, len(held)) for (host, wide, _), held in expected.items() if len(held) > 1)
    assert sorted((row.host, row.wide, row.pages) for row in html_text.repeated_runs(found, length).collect()) == counts
