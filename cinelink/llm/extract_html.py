"""HTML extraction: line-block distribution.

Markup is stripped to lines, one per block of text. Scripts, styles, menus, headers,
footers, sidebars, notices, adverts, forms and reader comments are known by tag, role or
class and become empty lines outside the article; no other element parts lines. Text
lengths, without the text of links, are summed over a sliding window of lines. A surge is a
line where the sums rise from nothing, a dive one where they fall back to nothing; the text
between surge and dive is a run.

The run with the most text is the main one. Where article or main elements hold text of
their own, only their text counts for that, and every line of the outermost of these
elements that the main run touches is kept, whatever links it holds. Else the main run is
kept with every run inside the innermost container around it; sections, lists and tables
are parts of their container. Lines of an article that is nothing but links are kept besides.

Pages are read in linear time, well-formed or not. An opening bracket with no closing one
behind it is text. Where quotes of a tag don't end, they count no longer. A head ends at the
first tag that can't stand in it, an unclosed button at the next block, an unclosed title at
the next tag; unclosed comments, scripts, styles and text fields run to the end. A form that
holds an article, a main element or a headline frames the page and is no noise.

Character references are decoded, white space inside a block becomes one space, blocks are
joined by one line feed.

Defined results: null or empty html and pages without text give the empty text; repeated
rows give equal rows; an empty table gives no rows; other columns are not looked at. Pages
are read whole.
"""

import bisect
import html as references
import re
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelink.llm.texts import text_or_empty

WINDOW = 3
NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
REST = re.compile(r"""(?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")
# Elements skipped with their content; what becomes of them without an end.
TO_THE_END = frozenset("script style textarea iframe".split())
SKIPPED = TO_THE_END | frozenset("noscript template select svg math object title".split())
ENDS = {name: re.compile(rf"</{name}\b[^>]*+>", re.IGNORECASE) for name in SKIPPED}
BUTTON = re.compile(r"<(/?)button\b[^>]*+>", re.IGNORECASE)
FRAMED = re.compile(r"<(?:(article|main|h1)|/form)\b", re.IGNORECASE)
METADATA = frozenset("base basefont bgsound link meta".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav header footer aside form menu dialog head button".split())
CONTAINERS = frozenset("div body html article main".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe subscription signup sidebar side nav navbar navigation menu breadcrumb "
    "breadcrumbs pagination pager footer header masthead comment comments respond replies disqus share sharing social related "
    "recommended widget toolbar skip login search".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar".split())
ATTRIBUTE = re.compile(r"""(class|id|role|aria-hidden|hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
ALWAYS_OPEN = frozenset("html body main".split())
# An article element may be a comment or a teaser of its own, but its class may also tell the layout of its page.
ARTICLE_NOISE = frozenset("ad ads advert advertisement sponsored promo comment comments replies related recommended".split())
# Names of parts of the article itself.
PARTS = {"header": frozenset("entry post article story content".split()), "comment": frozenset("author editor".split())}


def _names_noise(value, noise):
    for token in value.split():
        words = set(re.split(r"[_-]+", token))
        if any(PARTS.get(word, words).isdisjoint(words) or word not in PARTS for word in words & noise):
            return True
    return False


def _is_noise(name, rest):
    if name in DROPPED:
        return True
    if not rest or name in ALWAYS_OPEN:
        return False
    for m in ATTRIBUTE.finditer(rest):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key in ("class", "id") and _names_noise(value, ARTICLE_NOISE if name == "article" else NOISE_WORDS):
            return True
        if key == "role" and value in NOISE_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
    return False


def tags(page):
    """(start, end, name, closing, rest) of every tag; the name is empty for what is skipped whole."""
    at, last, quotes, endless = 0, page.rfind(">"), True, set()
    while 0 <= (start := page.find("<", at)) < last:
        m = NAME.match(page, start)
        if m is None:
            if page.startswith("<!--", start):
                at = page.find("-->", start + 4) + 3
                at = at if at > 2 else len(page)
            elif page[start + 1] in "!?":
                at = page.find(">", start) + 1
            else:
                at = start + 1
                continue
            yield start, at, "", False, ""
            continue
        rest = REST.match(page, m.end()) if quotes else None
        if rest is None:
            quotes = False
        at = rest.end() if rest else page.find(">", m.end()) + 1
        name, closing, inside = m[2].lower(), m[1] == "/", page[m.end():at - 1]
        if not closing and (name in SKIPPED or name == "button") and not (name in ("svg", "math") and inside.endswith("/")):
            if name == "button":
                end = BUTTON.search(page, at)
                end = end if end and end[1] else None
            else:
                end = None if name in endless else ENDS[name].search(page, at)
            if end:
                at, name = end.end(), ""
            elif name in TO_THE_END:
                at, name = len(page), ""
            elif name != "button":
                endless.add(name)
                if name == "title":
                    at = page.find("<", at)
                    at = at if at >= 0 else len(page)
                name = ""
        yield start, at, name, closing, inside


def lines_of(page):
    """List of (text, length without links, article), '' for an empty line; (first line, end) of containers.

    `article` numbers the outermost article or main element around the line, 0 for none.
    """
    lines, open_tags, words, containers = [], [], [], []
    is_open = Counter()
    noise = article = anchor = linked = at = roots = 0
    frames = [(m.start(), bool(m[1])) for m in FRAMED.finditer(page)]

    def end_line():
        nonlocal linked
        text = " ".join(references.unescape("".join(words)).split())
        words.clear()
        if text:
            lines.append((text, 0 if linked >= len(text) else len(text) - linked, roots if article else 0))
        linked = 0

    def gap():
        if not article:
            lines.extend([("", 0, 0)] * WINDOW)

    def add(text):
        nonlocal linked
        if text and not noise:
            words.append(text)
            if anchor:
                linked += len(" ".join(references.unescape(text).split()))

    def close(name):
        """A closing tag ends what stands open inside its element, but no container around it."""
        nonlocal noise, article, anchor
        while True:
            tag, was_noise, was_article, first = open_tags.pop()
            is_open[tag] -= 1
            noise -= was_noise
            article -= was_article
            anchor -= tag == "a"
            if tag in CONTAINERS:
                containers.append((first, len(lines)))
            if was_noise:
                gap()
            if tag == name:
                return

    def frames_page(start):
        place = bisect.bisect_left(frames, (start,))
        return place < len(frames) and frames[place][1]

    for start, end, name, closing, rest in tags(page):
        add(page[at:start])
        at = end
        if not name:
            continue
        if name not in INLINE:
            end_line()
            if is_open["button"]:
                close("button")
        if closing:
            if is_open[name]:
                close(name)
            continue
        if is_open["head"] and name not in METADATA:
            close("head")
        if name in VOID or rest.endswith("/"):
            continue
        if name == "p":  # a paragraph ends the one before it
            while open_tags and open_tags[-1][0] in INLINE | {"p"}:
                tag, was_noise, *_ = open_tags.pop()
                is_open[tag] -= 1
                noise -= was_noise
                anchor -= tag == "a"
                if tag == "p":
                    break
        own = int(_is_noise(name, rest) and not (article and name == "header") and not (name == "form" and frames_page(start)))
        inside = int(name in ("article", "main") and not noise and not own)
        if own:
            gap()
        roots += inside and not article
        open_tags.append((name, own, inside, len(lines)))
        is_open[name] += 1
        noise += own
        article += inside
        anchor += name == "a"
    add(page[at:])
    end_line()
    containers += [(first, len(lines)) for tag, _, _, first in open_tags if tag in CONTAINERS]
    return lines, containers


def main_text(page):
    """The text between surges and dives of the line-block distribution."""
    lines, containers = lines_of(page)
    lengths = [n for _, n, _ in lines]
    sums = [sum(lengths[max(0, i - WINDOW + 1):i + 1]) for i in range(len(lines))]
    runs, start = [], None
    for i, s in enumerate([*sums, 0]):
        if s and start is None:
            start = i
        elif not s and start is not None:
            runs.append((start, i))
            start = None
    own = [n if article else 0 for _, n, article in lines]
    told = own if any(own) else lengths
    around, articles = (0, 0), set()
    if runs:
        low, high = max(runs, key=lambda r: sum(told[r[0]:r[1]]))
        texts = [i for i in range(low, high) if lines[i][0]]
        articles = {lines[i][2] for i in texts if own[i]}
        around = max((c for c in containers if c[0] <= texts[0] and texts[-1] < c[1]), key=lambda c: (c[0], -c[1]), default=(0, len(lines)))
    if articles:
        return "\n".join(t for t, _, article in lines if article in articles)
    kept = {i for a, b in runs if around[0] <= a < around[1] for i in range(a, b)}
    return "\n".join(t for i, (t, _, article) in enumerate(lines) if t and (article or i in kept))


@F.pandas_udf(T.StringType())
def extract(pages: pd.Series) -> pd.Series:
    return pages.map(main_text)


def extract_pages(pages, html="html", keep=("page_id", "url")):
    """`keep` columns and `text` of every row."""
    return pages.select(*keep, extract(text_or_empty(F.col(html))).alias("text"))
