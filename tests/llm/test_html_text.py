import re
from collections import Counter
from html.parser import HTMLParser

import cases  # noqa: F401
import oracle
import pytest

from tallyframe.llm import html_text

PARA = "This is the story of the house that was on the hill and of the people who lived in it for many years, and it is told here as they would have told it to you in the evening when the day was done and the work was over."
MORE = "There are many who say that it was not so, but they were not there and we were, so that you can take it from us that it is as true as any story that has been told in this town by the people who live in it."


def text(page):
    return html_text.main_text(page)


def test_article_in_a_full_page():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style><script>var t="</p><p>not text {PARA}";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="ad">{MORE}</div>
    <article><h1>The house</h1><p>{PARA}</p><p>Short one.</p><p>A &amp; B &lt;c&gt; &#233;\n   spaced</p><p>{MORE}</p></article>
    <aside>{MORE}</aside><section id="comments"><p>{MORE}</p></section><form><p>{MORE}</p></form><footer>&copy; {MORE}</footer></body></html>"""
    assert text(page) == f"The house\n{PARA}\nShort one.\nA & B <c> é spaced\n{MORE}"


def test_page_without_article():
    page = f"<body><div id=nav><a href=x>One</a> <a href=y>Two</a></div><div class='content'><h2>Head</h2><div>{PARA}</div><p>Yes.</p><div>{MORE}</div></div><div class=footer><p>{PARA}</p></div></body>"
    assert text(page) == f"Head\n{PARA}\nYes.\n{MORE}"


def test_plain_page_by_density_alone():
    links = " ".join(f"<a href='/{i}'>link number {i} of the list</a>" for i in range(12))
    page = f"<html><body><div>{links}</div><div>{PARA}</div><div>Not long.</div><div>{MORE}</div><div>{links}</div><div>Imprint</div></body></html>"
    assert text(page) == f"{PARA}\nNot long.\n{MORE}"


def test_unclosed_tags_and_breaks():
    assert text(f"<article><h1>Head</h1><p><b>{PARA}<br><p>{MORE}<p>End") == f"Head\n{PARA}\n{MORE}\nEnd"
    assert text(f"<article><p>{PARA}<br>next line<br><br>{MORE}</p></article>") == f"{PARA} next line\n{MORE}"


def test_cut_off_page():
    assert text(f"<article><p>{PARA}</p><p>{MORE}</p><p cla") == f"{PARA}\n{MORE}"
    assert text(f"<article><p>{PARA}</p><script>var x = 1;") == PARA
    assert text(f"<article><p>{PARA}</p><!-- never closed {MORE}") == PARA


@pytest.mark.parametrize("page", [None, "", " ", "<", "<>", "</p>", "<p", "<!--", "<script>", "&", "</article></div>", "<nav><p>menu</p></nav>"])
def test_nothing_to_extract(page):
    assert text(page) in ("", "<", "<>", "&")


def test_regions_by_name():
    for name in ("cookie-notice", "sidebar", "newsletter", "share-buttons", "related-posts", "comment-list", "breadcrumb", "advert"):
        assert text(f"<body><div class='{name}'><p>{MORE}</p></div><main><p>{PARA}</p></main></body>") == PARA
    # a name that only contains such a word is no region
    assert text(f"<body><main><div class='headline shadow'><p>{PARA}</p></div></main></body>") == PARA


def test_second_pass_takes_the_neighbours_label():
    def block(label):
        return html_text.Block(label=label, text=label)

    def kept(*labels):
        found = [block(x) for x in labels]
        return [i for i, b in enumerate(found) if any(b is k for k in html_text.second_pass(found))]

    assert kept("good", "short", "good") == [0, 1, 2]
    assert kept("bad", "short", "near", "bad") == []
    assert kept("good", "near", "short", "bad") == [0, 1]
    assert kept("short", "good", "short") == [0, 1, 2]


def test_table(spark):
    pages = [(1, "u", f"<article><p>{PARA}</p></article>", "x"), (1, None, f"<article><p>{PARA}</p></article>", "x"), (None, "v", None, None), (2, "w", "", ""), (3, "z", f"<article><p>{PARA}</p></article>" * 300, "")]
    got = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string, text string")).collect()
    assert sorted(((r.page_id or 0, r.url or "", r.n_chars) for r in got)) == sorted([(1, "u", len(PARA)), (1, "", len(PARA)), (0, "v", 0), (2, "w", 0), (3, "z", 301 * 0 + 300 * len(PARA) + 299)])
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_odd_attributes():
    assert text(f"<article><p data-x=it's title='a > b'>{PARA}</p><p class=\"x>{MORE}</p></article>") == f"{PARA}\n{MORE}"
    assert text(f"<article><a name='top'/><p>{PARA} <a href=http://x.example/a/>link</a></p></article>") == f"{PARA} link"
    assert text("<article>" + "<p a=\"" * 3000 + f"><p>{PARA}</p></article>") .endswith(PARA)


def test_names_are_evidence_and_no_gate():
    assert text(f"<body><div class='post'><p>{PARA}</p></div><div><p>{MORE}</p><p>{PARA}</p></div></body>") == f"{PARA}\n{MORE}\n{PARA}"
    assert text(f"<body><div>{MORE}</div><article><p>{PARA}</p></article><div>Short beside it.</div></body>") == f"{MORE}\n{PARA}"
    assert text(f"<body><main><div class='side-by-side'><p>{PARA}</p></div><div class='side'><p>{MORE}</p></div><div class='side-nav'><p>{MORE}</p></div></main></body>") == PARA


def test_a_lone_link_and_a_menu_in_an_article():
    link = "<p><a href='/x'>The whole report that was written on it</a></p>"
    assert text(f"<article><p>{PARA}</p>{link}<p>{MORE}</p></article>") == f"{PARA}\nThe whole report that was written on it\n{MORE}"
    assert text(f"<article><p>{PARA}</p>{link * 3}<p>{MORE}</p></article>") == f"{PARA}\n{MORE}"


def test_a_language_without_stop_words_in_the_list():
    first = "Старый дом стоял на холме над рекой, и люди, которые жили в нём много лет, рассказывали эту историю своим детям по вечерам. " * 2
    links = "".join(f"<a href='/{i}'>ссылка номер {i}</a> " for i in range(9))
    assert text(f"<body><div>{links}</div><div>{first}</div><div>Да.</div><div>{first}</div><div>{links}</div></body>") == f"{first.strip()}\nДа.\n{first.strip()}"


def test_stop_words_decide(monkeypatch):
    keywords = "cheap hotel booking flight travel deal price city beach luxury resort package discount " * 4
    page = f"<body><div>{PARA}</div><div>{MORE}</div><div>{keywords}</div></body>"
    assert text(page) == f"{PARA}\n{MORE}"
    monkeypatch.setattr(html_text, "STOP_WORDS", frozenset())
    assert text(page) == f"{PARA}\n{MORE}\n{keywords.strip()}"


class Article(HTMLParser):
    """All text of the article elements, by the standard library's parser."""

    def __init__(self, page):
        super().__init__()
        self.depth, self.parts = 0, []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.parts.append(" " if tag in html_text.BLOCKS or tag == "br" else "")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.parts.append(" " if tag in html_text.BLOCKS else "")

    def handle_data(self, data):
        self.parts.append(data if self.depth else "")


def given_pages():
    return [r[0] for r in oracle.duck(oracle.SF).execute("SELECT html FROM pages ORDER BY page_id").fetchall()]


def test_given_pages_against_another_parser():
    for page in given_pages():
        assert text(page).split() == "".join(Article(page).parts).split()


def test_given_pages_without_names():
    """Every element a div and no names left: the two passes alone find the article."""

    def characters(blocks):
        return sum(len(b) * n for b, n in blocks.items())

    found = wanted = both = 0
    for page in given_pages():
        bare = re.sub(r"<(/?)(?:nav|article|footer|ul|li|p|h1)(?=[\s>])", r"<\1div", page)
        bare = re.sub(r"""\s(?:class|id|role)=("[^"]*"|'[^']*'|[^\s>]+)""", "", bare)
        got, want = (Counter(text(p).split("\n")) for p in (bare, page))
        found, wanted, both = found + characters(got), wanted + characters(want), both + characters(got & want)
    assert both >= 0.9 * wanted and both >= 0.9 * found, (both / wanted, both / found)
