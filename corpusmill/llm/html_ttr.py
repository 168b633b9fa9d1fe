"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The parser of the standard library streams tags and text. Block tags end lines; each line has the length of its
text outside of page furniture (menus, footers, scripts and the like) over the number of its tags. The smoothed ratios are split in
two clusters by their mean distance. If most of what is above the threshold stands in elements that the page marks as
articles, these are the region; else it is the smallest element that holds all lines above the threshold, or the element around
their block if they stand in one, and what reads like sentences elsewhere. Every line of the region that isn't furniture is the text, the
short ones too. Classes, roles and forms are evidence only: an element that holds nearly all of a page's text is never furniture for them.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from corpusmill.llm.batches import map_rows

#: Elements by what they do to text.
SILENT = frozenset("script style template noscript title svg object iframe canvas audio video select textarea button datalist".split())
FURNITURE = frozenset("nav footer aside menu dialog".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math q rp rt ruby s samp small span strike strong sub sup time tt u var wbr mi mn mo ms mtext mrow msup msub mfrac msqrt".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that can stand in a page's head; any other one, or text, ends it.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Elements that an opening tag of the same group ends.
SIBLINGS = {"p": "p", "li": "li", "dt": "d", "dd": "d", "tr": "tr", "td": "t", "th": "t", "option": "o"}
#: Parts of a class or id that name furniture, and parts that say nothing on their own: share-buttons is furniture, share-price isn't.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promos promotion nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer masthead cookie cookies consent notice notices popup modal newsletter subscribe subscription share sharing social related recommended recommendations comment comments disqus reply replies respond".split()
)
NEUTRAL = frozenset("area bar block bottom box btn button buttons content container form group holder icons inner item items left link links list main outer page panel posts right row section site slot text thread top unit widget widgets wrap wrapper".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NO_DISPLAY = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)
SIGMA = 2.0
#: A line of so many words and characters a tag, at most a third of it links, reads like sentences.
SENTENCE_WORDS, SENTENCE_RATIO = 5, 6
#: What an element's own marks make of its text.
PLAIN, EVIDENCE, AWAY, MUTE = range(4)


def is_marked(named: str) -> bool:
    """Whether a class or id is made of words that name furniture, and of neutral ones besides."""
    for token in named.lower().split():
        parts = re.split(r"[-_]+", token)
        if any(x in MARKS for x in parts) and all(not x or x in MARKS or x in NEUTRAL or x.isdigit() for x in parts):
            return True
    return False


class LineParser(HTMLParser):
    """Lines of a page: text, number of tags, the element that it stands in, characters in links.

    Elements are numbered as they open. Open ones are counted by name, inline ones since the last block as well, so that an end tag
    without a start is dismissed at once and none is looked for through a stack.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.names, self.parents, self.marks, self.article = ["#page"], [-1], [PLAIN], [False]
        self.open, self.mute, self.links = [0], 0, 0
        self.counts: Counter = Counter()
        self.inline: list[Counter] = [Counter()]
        self.lines: list[tuple[str, int, int, int]] = []
        self.text: list[str] = []
        self.tags = self.linked = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.open[-1], self.linked))
            self.tags = self.linked = 0
        self.text = []

    def _pop(self) -> None:
        node = self.open.pop()
        tag = self.names[node]
        self.counts[tag] -= 1
        self.mute -= self.marks[node] == MUTE
        self.links -= tag == "a"
        if tag in INLINE:
            self.inline[-1][tag] -= 1
        else:
            self.inline.pop()

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if self.names[self.open[-1]] == "head" and tag not in IN_HEAD:
            self._pop()
        if tag in VOID:
            if tag == "br" or tag == "hr":
                self.text.append("\n")
            return
        group = SIBLINGS.get(tag)
        if group or tag not in INLINE:
            self.end_line()
            if tag not in INLINE:
                while len(self.open) > 1 and self.names[self.open[-1]] in INLINE:  # an unclosed inline element ends before a block
                    self._pop()
            if group and len(self.open) > 1 and SIBLINGS.get(self.names[self.open[-1]]) == group:
                self._pop()
        inside = self.article[self.open[-1]]
        mark = self._mark(tag, dict(attrs), inside)
        self.names.append(tag)
        self.parents.append(self.open[-1])
        self.marks.append(mark)
        self.article.append(inside or tag in ("article", "main") and mark == PLAIN)
        self.open.append(len(self.names) - 1)
        self.counts[tag] += 1
        self.mute += mark == MUTE
        self.links += tag == "a"
        if tag in INLINE:
            self.inline[-1][tag] += 1
        else:
            self.inline.append(Counter())

    def _mark(self, tag: str, given: dict, inside: bool) -> int:
        if tag in SILENT:
            return MUTE
        if tag in FURNITURE or "hidden" in given or given.get("style") and NO_DISPLAY.search(given["style"]):
            return AWAY
        if tag == "header" and not (inside and self.counts["article"]):
            return AWAY
        if tag == "form" or (given.get("role") or "").lower() in ROLES:
            return EVIDENCE
        if tag in ("html", "body", "article", "main") or tag in INLINE:
            return PLAIN
        return EVIDENCE if any(given.get(k) and is_marked(given[k]) for k in ("class", "id")) else PLAIN

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in INLINE:
            self.end_line()
        if self.counts[tag] < 1 or tag in INLINE and self.inline[-1][tag] < 1:
            return  # it has no start, or belongs to an element that ended before
        while self.names[self.open[-1]] != tag:
            self._pop()
        self._pop()

    def handle_data(self, data):
        if not self.mute:
            if self.names[self.open[-1]] == "head" and not data.isspace():
                self._pop()
            self.text.append(data)
            if self.links:
                self.linked += len(data.strip())

    def furniture(self) -> np.ndarray:
        """For each line whether it is furniture.

        Evidence doesn't count where the element holds two thirds of what isn't away for certain, all of the page's articles included.
        """
        n = len(self.names)
        away = [False] * n
        for i in range(1, n):
            away[i] = away[self.parents[i]] or self.marks[i] == AWAY
        held, told = [0] * n, [0] * n  # characters, and those in articles
        for text, _, node, _ in self.lines:
            if not away[node]:
                held[node] += len(text)
                told[node] += len(text) * self.article[node]
        for i in range(n - 1, 0, -1):
            held[self.parents[i]] += held[i]
            told[self.parents[i]] += told[i]
        for i in range(1, n):
            page = 3 * held[i] > 2 * held[0] and told[i] == told[0]
            away[i] = away[self.parents[i]] or self.marks[i] == AWAY or self.marks[i] == EVIDENCE and not page
        return np.array([away[node] for _, _, node, _ in self.lines], bool)


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; the ends are weighted by what there is."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    cut = slice(reach, reach + len(values))
    return np.convolve(values, kernel)[cut] / np.convolve(np.ones(len(values)), kernel)[cut]


def cluster(ratios: np.ndarray) -> np.ndarray:
    """Two clusters of ratios by a threshold between their means; true for the higher one (all, if they are equal)."""
    limit = ratios.mean()
    for _ in range(50):
        high = ratios > limit
        if not high.any() or high.all():
            break
        new = (ratios[high].mean() + ratios[~high].mean()) / 2
        if abs(new - limit) < 1e-9:
            break
        limit = new
    high = ratios > limit
    return high if high.any() else np.ones(len(ratios), bool)


def content_lines(parser: LineParser) -> np.ndarray:
    """Which lines are the main text: those of the region that aren't furniture."""
    lines = parser.lines
    usable = ~parser.furniture()
    if not usable.any():
        return usable
    own = np.array([len(text) / max(1, tags) for text, tags, *_ in lines])
    content = np.zeros(len(lines), bool)
    content[usable] = cluster(smooth(own[usable]))
    sizes = np.array([len(text) for text, *_ in lines], np.int64)
    place = np.array([node for _, _, node, _ in lines], np.int64)
    marked = usable & np.array([parser.article[node] for node in place.tolist()], bool)
    if 2 * sizes[content & marked].sum() >= sizes[content].sum():
        return marked  # the content is in articles: all of them count
    # the smallest element that holds all content lines, or what a single block of them stands in; elements are numbered
    # as they open, so what holds the first and the last holds all
    parents = parser.parents
    first, last = int(place[content].min()), int(place[content].max())
    region, other = first, last
    while other != region:  # parents have smaller numbers than what they hold
        region, other = (region, parents[other]) if other > region else (parents[region], other)
    alone = first == last
    while region > 0 and (alone or parser.names[region] in INLINE or parser.names[region] in SIBLINGS):
        region, alone = parents[region], False
    inside = np.zeros(len(parents), bool)
    inside[region] = True
    for node in range(region + 1, len(parents)):
        inside[node] = inside[parents[node]]
    words = np.array([text.count(" ") + 1 for text, *_ in lines])
    linked = np.array([x for *_, x in lines])
    sentences = (words >= SENTENCE_WORDS) & (own >= SENTENCE_RATIO) & (3 * linked <= sizes)
    return usable & (inside[place] | sentences)


#: A tag from its name on: characters, or an equals sign and a value that may be quoted; and the parts of it that count.
TAG = re.compile(r"""(?:[^>=]|=\s*(?:"[^"]*"|'[^']*')?)*+>""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""([^\s=/>"'][^\s=/>]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
READ = frozenset("class id role hidden style".split())


def plain_markup(html: str) -> str:
    """The page with nothing but text and whole, simple tags, in time that grows with its length whatever it holds.

    The standard parser looks for the end of a comment, declaration or tag again from each place where one begins. Here ends are
    looked for once: comments, declarations and the content of scripts and styles are left out, tags keep the attributes that are
    read, and a sign that begins nothing is written as text. An unended comment's mark is left out and what follows it is read.
    Once a tag's quotes go wrong to the end of the page, tags end at the next sign.
    """
    out: list[str] = []
    at, quotes, comments = 0, True, True
    last = html.rfind(">")
    while (begin := html.find("<", at)) >= 0:
        out.append(html[at:begin])
        after = html[begin + 1 : begin + 2]
        if begin > last:
            out.append(html[begin:].replace("<", "&lt;"))
            return "".join(out)
        if html.startswith("<!--", begin):
            end = html.find("-->", begin + 2) if comments else -1
            comments = end >= 0
            at = end + 3 if comments else begin + 4
        elif after in ("!", "?"):
            at = html.find(">", begin) + 1
        elif after == "/" and (name := NAME.match(html, begin + 2)):
            out.append(f"</{name[0]}>")
            at = html.find(">", begin) + 1
        elif name := NAME.match(html, begin + 1):
            found = TAG.match(html, name.end()) if quotes else None
            quotes = found is not None
            at = found.end() if found else html.find(">", begin) + 1
            out.append(_tag(name[0], html[name.end() : at - 1]))
            low = name[0].lower()
            if low in ("script", "style"):
                ends = re.compile(rf"</{low}(?=[\s/>])", re.IGNORECASE).search(html, at)
                at = ends.start() if ends else len(html)
                if not ends:
                    out.append(f"</{low}>")
        else:
            out.append("&lt;")
            at = begin + 1
    out.append(html[at:])
    return "".join(out)


def _tag(name: str, rest: str) -> str:
    kept = ""
    if rest and not rest.isspace():
        for key, value in ATTRIBUTE.findall(rest):
            if key.lower() in READ:
                kept += f' {key.lower()}="{re.sub(r"[^\w:;.-]+", " ", value)}"'
    return f"<{name}{kept}{'/' if rest.endswith('/') else ''}>"


def main_text(html: str | None) -> str:
    """The main text of a page: its blocks in page order, joined by one space; empty if there is none."""
    parser = LineParser()
    parser.feed(plain_markup(html or ""))
    parser.close()
    parser.end_line()
    kept = content_lines(parser) if parser.lines else ()
    return " ".join(line[0] for line, keep in zip(parser.lines, kept, strict=True) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of each page: id, url, text, n_chars (code points).

    A null or empty page, or one of furniture only, has an empty text. Pages of any length and depth are read whole,
    in time that grows with the length. All of a page's articles are its text; without one, blocks with equal ratios are content alike. Repeated rows give repeated results, an empty table none; ids and URLs may be
    null; other columns are ignored, whatever their names.
    """
    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

    def run(column):
        texts = [main_text(h) for h in column]
        return [texts, [len(t) for t in texts]]

    return map_rows(pages.select(F.col(id_col), F.col(url_col), F.col(html_col).alias("_html")), [id_col, url_col, "_html"], 2, fields, lambda: run)
