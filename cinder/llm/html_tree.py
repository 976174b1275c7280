"""Main text of web pages by tree scoring.

The page is read into a tree (open paragraphs, list items and cells end where the next one
begins, as browsers do). Subtrees that are never article text are left out: scripts,
styles, menus, forms, footers, asides, and elements whose class, id or role names a menu,
advert, notice, share bar or comment section as a whole word of its list (``cookie-notice`` and
``ad-box``, not ``no-ads``, ``has-sidebar`` or ``related-work``; ids of headings and inline
elements say nothing). Such a name alone does not drop an element that holds the page's
article or main, or over half of its text without links; a comment section may be longer than the
article if there is text besides. A list word at the start or end of a longer name (``sticky-nav``,
``related-stories``, ``cookie-law-info-bar``) is a penalty, weighed against the element's text: it is left out if a
quarter of its characters or more are link text, or if its other text is under a fifth of the
page's; a section that begins with a heading is not penalised for its id or for a first word. Comment
words at either end of a name mark a comment section. If nothing is left, names do not count. Every remaining block of text earns points
for its commas and length and passes them to the element that holds it, half to the next
one up and a falling share to further ancestors. An element's points are discounted by the
share of its characters that are link text. The best container, raised to the ``article``
or ``main`` element around it, and those siblings that read like it are kept; without an
``article`` or ``main``, so are all siblings of few links between these and directly after
them. The text in them is taken in page order.

Defined results: a null or empty html, or a page without text, gives ''. Unclosed tags,
comments and quotes end where the page ends. White space (also from character references)
becomes one space between words. Null or repeated page_ids keep their rows; other input
columns are ignored. Pages are read whole, in linear time.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame

from cinder.llm.common import map_rows

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_HINTS = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_PARTS = re.compile(r"[A-Za-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
DROPPED = frozenset("head script style noscript template nav aside footer form iframe object svg math canvas audio video map button "
                    "select textarea title xmp noembed noframes menu dialog datalist fieldset label input".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr img".split())
#: A start tag of these ends an open paragraph.
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                           "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd".split())
#: A start tag ends an open one of the second set, unless one of the third stands between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
        "option": ({"option"}, {"select"})}
#: Words in class, id and role that mark what is no article text.
BOILERPLATE = frozenset("ad ads adv advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
                        "notice notification alert newsletter subscribe subscription signup comment comments commentlist disqus replies reply "
                        "respond sidebar widget menu nav navbar navigation breadcrumb breadcrumbs footer masthead share sharing social related "
                        "recommended recommendations popup modal overlay pagination pager toolbar login search complementary contentinfo "
                        "topbar paywall skip adsbygoogle".split())
#: Marks that only stand for page furniture outside an article.
OUTSIDE = frozenset("header banner".split())
#: Words that may stand beside a mark within one class, id or role, as in ad-box or share-buttons.
NEUTRAL = frozenset("area article bar block body bottom box btn button buttons col column container content entry form group header icon icons "
                    "inner item items js large left link links list main mobile module outer page panel post posts primary right row "
                    "secondary section site slot small text title to top unit wrap wrapper".split())
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: Words of a name that tell of something else than the element: has-sidebar, no-ads, comments-open, category-social.
ELSEWHERE = frozenset("has no not with without non open closed enabled disabled off count category tag type status format".split())
#: Marks that also count where they begin or end a word written without a sign between its parts.
LONG_MARKS = tuple(sorted(m for m in BOILERPLATE if len(m) > 7)) + ("sidebar",)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KEPT = frozenset("html body article main".split())
#: Why an element is left out: never article text, or only by its name; comment sections apart.
#: A mark that ends a longer name (its head noun, as in mega-menu) weighs more than one elsewhere in it or in an id.
NEVER, NAMED, COMMENTED, ENDED, TOUCHED = 1, 2, 3, 4, 5
#: What a penalised element must have to stay: the greatest share of link text, the least share of the page's other text.
LINKED, SHARE = 0.25, 0.2


def _marks(value: str, marks: frozenset) -> set[str]:
    """The marks of the words of a class, id or role that hold nothing but marks and neutral parts."""
    out = set()
    for word in value.split():
        parts = {x for x in _PARTS.findall(word) if len(x) > 1}
        if parts & marks and parts <= BOILERPLATE | OUTSIDE | NEUTRAL:
            out |= parts & marks
    return out


def _penalty(value: str, tag: str, is_id: bool, in_article: bool) -> int:
    """The heaviest penalty of the words of a class, id or role that hold a mark at their start or end, and other parts.

    Ids in an article are mostly anchors named by their headings: there only comment words count.
    """
    worst = 0
    for word in value.split():
        parts = _PARTS.findall(word)
        if not parts or not ELSEWHERE.isdisjoint(parts):
            continue
        ends = {m for x in (parts[0], parts[-1]) for m in (x, *(m for m in LONG_MARKS if x != m and (x.startswith(m) or x.endswith(m))))} & BOILERPLATE
        if ends & COMMENTS:
            return COMMENTED
        if tag == "article" or is_id and in_article:
            continue
        if not is_id and (parts[-1] in BOILERPLATE or parts[-1].endswith(LONG_MARKS)):
            worst = ENDED
        elif ends or len(BOILERPLATE.intersection(parts)) > 1 or "banner" in parts:
            worst = worst or TOUCHED
    return worst


def _boilerplate(tag: str, attributes: str, in_article: bool) -> int:
    if tag in DROPPED:
        return NEVER
    if tag == "header" and not in_article:
        return NEVER
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return 0
    named = penalty = 0
    for name, value in _HINTS.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return NEVER
        if name == "style":
            if "display:none" in value.replace(" ", ""):
                return NEVER
        elif name != "aria-hidden" and tag not in ("html", "body", "main") and not (name == "id" and (tag in HEADINGS or tag in INLINE)):
            words = _marks(value, BOILERPLATE)
            if words and not (tag == "article" and not words & {"comment", "comments", "reply", "ad", "advert"}):
                named = COMMENTED if words & COMMENTS else named or NAMED
            if not named and not in_article and tag != "article" and _marks(value, OUTSIDE):
                named = NAMED
            if not named and tag not in INLINE:
                found = _penalty(value, tag, name == "id", in_article)
                penalty = COMMENTED if COMMENTED in (found, penalty) else min(found, penalty) or found or penalty
    return named or penalty


class Page:
    """Elements by number (parents before children) and text in page order."""

    def __init__(self, html: str):
        self.parent, self.tag, self.why, self.dropped = [-1], [""], [0], [False]
        self.text: list[tuple[int, str]] = []  # (element, decoded text); "\n" ends a block
        self._read(html)
        if any(w > NEVER for w in self.why):
            self._judge_names()
        else:
            self._drop(self.why)

    def _read(self, html: str) -> None:
        stack, open_tags, at, n, quotes = [0], {}, 0, len(html), True
        articles = 0

        def add_text(raw: str) -> None:
            if raw:
                self.text.append((stack[-1], unescape(raw) if "&" in raw else raw))

        def pop() -> None:
            nonlocal articles
            tag = self.tag[stack.pop()]
            open_tags[tag] -= 1
            articles -= tag in ("article", "main")
            if tag not in INLINE:
                self.text.append((stack[-1], "\n"))

        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                add_text(html[at:])
                break
            name = _NAME.match(html, lt + 1)
            if not name:
                mark = html[lt + 1:lt + 2]
                if mark and mark in "!?/":
                    add_text(html[at:lt])
                    if html.startswith("<!--", lt):
                        end = html.find("-->", lt + 2)
                        at = n if end < 0 else max(end + 3, lt + 4)
                    else:
                        end = html.find(">", lt)
                        at = n if end < 0 else end + 1
                else:  # a plain sign
                    add_text(html[at:lt + 1])
                    at = lt + 1
                continue
            add_text(html[at:lt])
            rest = _REST.match(html, name.end()) if quotes else None
            end = rest.end() if rest else html.find(">", name.end()) + 1
            if not rest and quotes:
                quotes = False  # an unclosed quote: from here on a tag ends at its first >
            if end <= 0:
                break
            tag, attributes, at = name[0].lower(), html[name.end():end - 1], end
            if tag[0] == "/":
                tag = tag[1:]
                if open_tags.get(tag):
                    while self.tag[stack[-1]] != tag:
                        pop()
                    pop()
                elif tag in ("p", "br"):
                    self.text.append((stack[-1], "\n"))
                continue
            if tag in VOID:
                if tag not in INLINE:
                    self.text.append((stack[-1], "\n"))
                continue
            if tag in ENDS_PARAGRAPH and open_tags.get("p"):
                while self.tag[stack[-1]] != "p":
                    pop()
                pop()
            if tag in ENDS:
                ended, stops = ENDS[tag]
                if any(open_tags.get(t) for t in ended):
                    k = len(stack) - 1
                    while k and self.tag[stack[k]] not in ended and self.tag[stack[k]] not in stops:
                        k -= 1
                    while k and self.tag[stack[k]] in ended and self.tag[stack[k - 1]] in ended:
                        k -= 1
                    if k and self.tag[stack[k]] in ended:
                        while len(stack) > k:
                            pop()
            up = stack[-1]
            self.parent.append(up)
            self.tag.append(tag)
            self.why.append(_boilerplate(tag, attributes, articles > 0))
            if tag not in INLINE:
                self.text.append((up, "\n"))
            if tag in RAW:
                close = re.compile(f"</{tag}", re.I).search(html, at)
                after = html.find(">", close.end()) if close else -1
                at = n if after < 0 else after + 1
                continue
            stack.append(len(self.parent) - 1)
            open_tags[tag] = open_tags.get(tag, 0) + 1
            articles += tag in ("article", "main")

    def _drop(self, why: list[int]) -> None:
        self.dropped = [False] * len(self.parent)
        for e in range(1, len(self.parent)):
            self.dropped[e] = self.dropped[self.parent[e]] or why[e] > 0

    def _judge_names(self) -> None:
        """Which elements are left out by their name."""
        size = len(self.parent)
        self._drop([w == NEVER for w in self.why])
        marked, in_link, article, chars = [False] * size, [False] * size, [0] * size, [0] * size
        for e in range(1, size):
            up = self.parent[e]
            marked[e] = marked[up] or self.why[e] > NEVER
            in_link[e] = in_link[up] or self.tag[e] == "a"
            article[e] = e if self.tag[e] in ("article", "main") and not self.dropped[e] else article[up]
        links = [0] * size
        clear = rest = 0  # characters without links outside all named elements: in articles, in all
        for e, text in self.text:
            if self.dropped[e]:
                continue
            n = len(text.strip())
            if in_link[e]:
                links[e] += n
            else:
                chars[e] += n
                if not marked[e]:
                    rest += n
                    clear += n if article[e] else 0
        holds = [article[e] == e and e > 0 for e in range(size)]
        for e in range(size - 1, 0, -1):
            chars[self.parent[e]] += chars[e]
            links[self.parent[e]] += links[e]
            holds[self.parent[e]] = holds[self.parent[e]] or (holds[e] and chars[e] > 0)
        why = list(self.why)
        for e in range(1, size):
            if why[e] > NEVER:
                main = holds[e] and clear < (1 if why[e] == COMMENTED else chars[e])
                most = 2 * chars[e] > chars[0] and not (rest if why[e] == COMMENTED else clear and not article[self.parent[e]])
                if main or most:
                    why[e] = 0
                elif why[e] in (ENDED, TOUCHED) and links[e] < LINKED * (links[e] + chars[e]):
                    headed = why[e] == TOUCHED and e + 1 < size and self.parent[e + 1] == e and self.tag[e + 1] in HEADINGS
                    if headed or chars[e] >= SHARE * rest:
                        why[e] = 0
        self._drop(why)

    def holder(self, element: int) -> int:
        """The nearest element around that is no inline one."""
        while self.tag[element] in INLINE:
            element = self.parent[element]
        return element

    def scores(self) -> tuple[list[float], list[int], list[int]]:
        """Points, characters and link characters by element."""
        size = len(self.parent)
        points, chars, links = [0.0] * size, [0] * size, [0] * size
        in_link = [False] * size
        for e in range(1, size):
            in_link[e] = in_link[self.parent[e]] or self.tag[e] == "a"

        def give(held: int, block: str, linked: int) -> None:
            block = " ".join(block.split())
            if not block:
                return
            chars[held] += len(block)
            links[held] += min(linked, len(block))
            earned = (1 + block.count(",") + min(len(block) // 100, 3)) * (1 - min(1.0, linked / len(block)))
            # a paragraph passes its points up; an element with text of its own keeps them
            to, share, steps = held if self.tag[held] in ("div", "body", "article", "main", "section", "") else self.parent[held], 1.0, 1
            while to >= 0 and steps <= 5:
                points[to] += earned * share
                to, steps = self.parent[to], steps + 1
                share = 1 / 2 if steps == 2 else 1 / (3 * (steps - 1))

        held, parts, linked = 0, [], 0
        for element, text in [*self.text, (0, "\n")]:
            if text == "\n":
                give(held, "".join(parts), linked)
                parts, linked = [], 0
            elif not self.dropped[element]:
                held = self.holder(element)
                parts.append(text)
                linked += len(text.strip()) if in_link[element] else 0
        for e in range(size - 1, 0, -1):
            chars[self.parent[e]] += chars[e]
            links[self.parent[e]] += links[e]
        return points, chars, links

    def main(self) -> set[int]:
        """The best container and the siblings kept with it."""
        points, chars, links = self.scores()
        worth = [p * (1 - k / c) if c else 0.0 for p, c, k in zip(points, chars, links)]
        best = max(range(len(worth)), key=worth.__getitem__)
        if worth[best] <= 0:
            return {0}
        top = worth[best]
        up = best
        while up > 0:
            if self.tag[up] in ("article", "main"):
                best = up
                break
            up = self.parent[up]
        kept = {best}
        if best:
            among = [e for e in range(1, len(worth)) if self.parent[e] == self.parent[best] and (e == best or chars[e])]
            plain = {e for e in among if e == best or links[e] / chars[e] < 0.25}
            for e in plain - {best}:
                like = self.tag[e] == self.tag[best] or self.tag[e] in ("p", "section", "div")
                if like and (worth[e] >= 0.2 * top or (self.tag[e] == "p" and chars[e] > 80)):
                    kept.add(e)
            if self.tag[best] not in ("article", "main"):
                first, last, follows = min(kept), max(kept), True
                for e in among:
                    follows = follows and (e <= last or e in plain)
                    if e in plain and (first < e < last or (e > last and follows)):
                        kept.add(e)
        return kept

    def main_text(self) -> str:
        out = self._main_text()
        if not out and any(w > NEVER for w in self.why):
            self._drop([w == NEVER for w in self.why])
            out = self._main_text()
        return out

    def _main_text(self) -> str:
        chosen = self.main()
        inside = [False] * len(self.parent)
        inside[0] = 0 in chosen
        for e in range(1, len(self.parent)):
            inside[e] = inside[self.parent[e]] or e in chosen
        return " ".join("".join([t for e, t in self.text if t == "\n" or (inside[e] and not self.dropped[e])]).split())


def main_text(html: str | None) -> str:
    return Page(html).main_text() if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``."""
    def run(ids, urls, htmls):
        for page_id, url, html in zip(ids, urls, htmls):
            text = main_text(html)
            yield page_id, url, text, len(text)
    return map_rows(pages.select("page_id", "url", "html"), "page_id bigint, url string, text string, n_chars bigint", lambda: run)
