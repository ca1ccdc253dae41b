"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block-level tags. In the first pass each block is classed by its
stop-word density, its length and its link density: good, bad, near-good or short. In the second
pass, the ambiguous ones (near-good and short) inherit the label of the nearest decided neighbours:
between two good ones they are good, between two bad ones bad, and between a good and a bad one they
are good only if they are near-good or a heading of what follows.

Every block goes through both passes. An article element, or a name such as post or content, is evidence:
its blocks are taken for near-good where stop words are few, its lone link stays ambiguous where it would be
bad elsewhere, and its ambiguous blocks are good unless all around is bad. Beside an article
element a block has to be good by itself. Regions whose tag or class names say what they are (menus, headers and
footers of the page, sidebars, notices, adverts, forms, comments) never give text.

Stop words are the frequent short words of four languages, a fixed list. A page with hardly any of them is
in another language: there stop words say nothing, and length and link density decide. On a page without a good block the
near-good ones are good.

Defined cases: null html counts as empty and gives an empty text; unclosed and mismatched tags close
at the next block or region end; a page cut off in a tag or a region ends there; character references
are decoded once; very long pages are read in one linear pass; repeated rows are extracted alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

# Stop words of the four languages, and HTML's element names by their role.
STOP_WORDS = frozenset(
    """
    a about all also an and are as at be been but by can for from had has have he her his i if in into is it its more no not of on one or our she so
    than that the their them there they this to was we were what when which who will with would you your
    der die das den dem des ein eine einer eines und oder ist sind war auf aus bei bis durch für gegen im in mit nach nicht ohne sich sie er es über um von vor wie zu zum zur auch dass
    le la les un une des du de et ou est sont dans par pour sur avec sans qui que quoi ce cette ces il elle ils elles nous vous ne pas plus se au aux en être
    el los las unos unas y o es son por para con sin sobre que quien como más su sus lo al del se no una un en de
    """.split()
)
HIDDEN = frozenset("script style noscript template svg math iframe object video audio canvas head title select textarea button datalist".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option "
    "p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|banner|promo\w*|sponsor\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side-?(?:col\w*|nav|menu|panel)|footer\w*|header|masthead|cookie\w*|consent|notice\w*|newsletter|subscribe|"
    r"signup|login|popup|modal|overlay|share\w*|sharing|social\w*|related|recommend\w*|widget\w*|comments?|comment-?list|disqus|replies|respond|pagination|pager|toolbar|copyright|legal|"
    r"disclaimer|gdpr|alert|skip)(?:$|[\s_-])|(?:^|\s)side(?:$|\s)",
    re.IGNORECASE,
)

#: Characters of a block below which it is short, and from which it can be good by itself.
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.15, 0.25
MOST_LINKS = 0.4
#: Share of stop words in a page's unlinked text below which its language is none of the list's.
OTHER_LANGUAGE = 0.03

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)|[^<]+|<", re.DOTALL)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN_ATTRIBUTE = re.compile(r"""(?:^|\s)hidden(?:\s|=|$|/)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
# a slash at the end of a tag, but not of an unquoted value
_CLOSED = re.compile(r"""(?:^|[\s"'])/\s*$""")
_SPACES = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+")
BREAK = "\n"
# Weight of an article element among the open articles; more than elements can be nested.
ELEMENT = 1 << 40


@dataclass
class Block:
    """A run of text without a block-level tag inside."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0
    heading: bool = False
    article: bool = False
    element: bool = False
    label: str = ""
    text: str = ""


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, those in outside regions left out."""
    out: list[Block] = []
    block = Block()
    stack: list[tuple[str, bool, int]] = []  # open elements: name, whether they hide, 1 for an article by name and ELEMENT for an article element
    hidden = links = articles = headings = 0

    def close() -> None:
        nonlocal block
        text = _SPACES.sub(" ", "".join(block.parts)).strip()
        if text:
            block.text = text
            out.append(block)
        block = Block(heading=headings > 0, article=articles > 0, element=articles >= ELEMENT)

    skip_to = 0
    for m in _TOKEN.finditer(page):
        if m.start() < skip_to:
            continue
        name = m[2]
        if name is None:
            raw = m[0]
            if raw[0] != "<" or raw == "<":
                if not hidden and not (block.parts and block.parts[-1] == BREAK and raw.isspace()):
                    text = html.unescape(raw)
                    block.parts.append(text)
                    if links:
                        block.linked += len(text.strip())
            continue
        name = name.lower()
        if name == "br":
            # one break is white space; two with nothing between them end a block
            if block.parts and block.parts[-1] == BREAK:
                close()
            elif not hidden:
                block.parts.append(BREAK)
            continue
        if name in BLOCKS:
            close()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is None:
                continue
            # an inline end tag doesn't close a block that was opened inside it
            if name not in BLOCKS and name not in HIDDEN and any(n in BLOCKS for n, _, _ in stack[depth + 1 :]):
                gone = [stack.pop(depth)]
            else:
                gone = stack[depth:]
                del stack[depth:]
            for other, hides, article in gone:
                hidden -= hides
                articles -= article
                links -= other == "a"
                headings -= other in HEADINGS
        elif name not in VOID and not _CLOSED.search(m[3]):
            if name in HIDDEN and name in ("script", "style", "noscript", "textarea", "title", "iframe", "template"):
                end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, m.end())
                skip_to = end.end() if end else len(page)
                continue
            if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack:
                # these end where the next one of their kind begins
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        for other, hides, article in stack[i:]:
                            hidden -= hides
                            articles -= article
                            links -= other == "a"
                            headings -= other in HEADINGS
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCKS:
                        break
            attributes = m[3]
            named = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if attributes else ""
            article = name in ("article", "main") or bool(re.search(r"(?:^|[\s_-])(?:article|post|entry|main|content|story)(?:$|[\s_-])", named, re.IGNORECASE))
            inside = name not in ("html", "body", "article", "main")
            hides = name in HIDDEN or (name in OUTSIDE and not (name == "header" and articles)) or bool(attributes and inside and (OUTSIDE_NAMES.search(named) or _HIDDEN_ATTRIBUTE.search(attributes)))
            article = 0 if hides or not article else ELEMENT if name in ("article", "main") else 1
            stack.append((name, hides, article))
            hidden += hides
            articles += article
            links += name == "a"
            headings += name in HEADINGS
        if name in BLOCKS:
            block = Block(heading=headings > 0, article=articles > 0, element=articles >= ELEMENT)
    close()
    return out


def first_pass(found: list[Block]) -> None:
    """Label every block by its stop words, length and links."""
    words = [_WORD.findall(b.text.lower()) for b in found]
    stops = [sum(w in STOP_WORDS for w in ws) for ws in words]
    linked = [b.linked > MOST_LINKS * len(b.text) for b in found]
    plain = [i for i in range(len(found)) if not linked[i]]
    known = sum(stops[i] for i in plain) >= OTHER_LANGUAGE * sum(len(words[i]) for i in plain)
    for i, b in enumerate(found):
        length, density = len(b.text), stops[i] / max(1, len(words[i])) if known else STOP_HIGH
        if linked[i]:
            # links in a row are a menu wherever they stand
            lone = not any(linked[max(0, i - 1) : i] + linked[i + 1 : i + 2])
            b.label = "short" if b.article and lone else "bad"
        elif b.text.startswith(("©", "Copyright")):
            b.label = "bad"
        elif length < SHORT:
            b.label = "short"
        elif density >= STOP_HIGH:
            b.label = "good" if length >= LONG else "near"
        elif density >= STOP_LOW or b.article:
            b.label = "near"
        else:
            b.label = "bad"
    if not any(b.label == "good" for b in found):
        # the best that such a page has
        for b in found:
            b.label = "good" if b.label == "near" else b.label


def second_pass(found: list[Block]) -> list[Block]:
    """The good blocks after ambiguous ones have taken their neighbours' labels."""
    n = len(found)
    has_element = any(b.element for b in found)
    before, after = [""] * n, [""] * n
    last = ""
    for i in range(n):
        before[i] = last
        last = found[i].label if found[i].label in ("good", "bad") else last
    last = ""
    for i in range(n - 1, -1, -1):
        after[i] = last
        last = found[i].label if found[i].label in ("good", "bad") else last
    out = []
    for b, x, y in zip(found, before, after, strict=True):
        label = b.label
        if label in ("near", "short"):
            around = {x, y} - {""}
            if b.article:
                # the article's own short lines and headings follow it, unless all around is bad
                label = "bad" if around == {"bad"} and label == "short" and not b.heading else "good"
            elif has_element:
                label = "bad"
            elif around == {"good"}:
                label = "good"
            elif around == {"bad"}:
                label = "bad"
            else:
                label = "good" if b.label == "near" or b.heading and y == "good" else "bad"
        if label == "good":
            out.append(b)
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    first_pass(found)
    return "\n".join(b.text for b in second_pass(found))


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per row of ``pages``: its id, url, text and n_chars."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page) for page in batch["html"]]
            yield batch[["id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    light = pages.selectExpr(f"cast(`{id_column}` AS string) AS id", f"`{url_column}` AS url", f"cast(`{html_column}` AS string) AS html")
    kinds = dict(pages.dtypes)
    out = light.mapInPandas(run, f"id string, url {kinds[url_column]}, text string, n_chars long")
    return out.select(out["id"].cast(kinds[id_column]).alias(id_column), out["url"].alias(url_column), "text", "n_chars")
