"""Main text of web pages by scoring the containers of their paragraphs."""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxlake.llm.common import pin

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("title meta link style script base noscript template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Blocks that are paragraphs of their parent.
PARAGRAPHS = HEADINGS | frozenset("p pre td th blockquote li dt dd figcaption caption summary address".split())
#: Elements without text of the article.
NO_TEXT = frozenset(
    "script style noscript template iframe frame object svg math canvas audio video map nav footer aside select button textarea datalist "
    "menu dialog head search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist".split())
#: An open element of the first names ends when the key starts, if it is not outside one of the second names.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}),
}
#: Words of classes and ids of what is not the article.
OTHER_WORDS = re.compile(
    r"(?:ad|ads|adv|advert\w*|adslot|adbox|adunit|adsense|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|gdpr|notice\w*|notification\w*|alert\w*|"
    r"popup|modal|overlay|newsletter\w*|subscri\w*|signup|signin|login|register|menu\w*|nav|navbar|navi|navigation|breadcrumb\w*|pagination|pager|"
    r"paging|sidebar\w*|sidenav|aside|rail|footer\w*|header\w*|masthead|toolbar|topbar|widget\w*|share|shares|sharing|social\w*|related\w*|recommend\w*|"
    r"copyright|skip|outbrain|taboola|form|search\w*|side|secondary|hidden|paywall|donate|cta)")
COMMENT_WORDS = re.compile(r"(?:comment|comments|commentlist|commenter|commentary|disqus|respond|reply|replies|responses|discussion|thread)")
#: Of these, words that never name a part with the article in it, and words that do name it.
STRONG_WORDS = re.compile(
    r"(?:ad|ads|adv|advert\w*|adslot|adbox|adunit|adsense|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice\w*|notification\w*|alert\w*|popup|modal|"
    r"newsletter\w*|footer\w*|copyright|hidden|paywall)")
ARTICLE_WORDS = frozenset("content article main post entry story body text page wrapper container".split())
HEADER_WORDS = re.compile(r"header\w*")

#: Levels above a paragraph that get points, shares of the best score and of the page's points, link densities.
LEVELS, SIBLING_SHARE, MOST_POINTS, NEARLY_ALL = 5, 0.2, 0.5, 0.9
LINK_LIST, PLAIN_LINKS = 0.66, 0.33


#: Elements whose content is not markup.
RAW = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE) for tag in "script style textarea title iframe noframes noembed xmp".split()}
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"[\s/]*([^\s=>/][^\s=>/]*)(?:\s*=\s*(?=[^\s>])([^\s>\"'][^\s>]*)?)?")
SPACE = re.compile(r"[\s/]*")
END = re.compile(r"[\s/]*>")


def tokens(html: str):
    """("text", text), ("start", name, attributes) and ("end", name), each character looked at a bounded number of times."""
    at, size = 0, len(html)
    last = {q: html.rfind(q) for q in "\"'"}
    while at < size:
        tag = html.find("<", at)
        if tag < 0:
            tag = size
        if tag > at:
            yield "text", unescape(html[at:tag]), None
        if tag + 1 >= size:
            if tag < size:
                yield "text", "<", None
            return
        if html.startswith("<!--", tag):
            at = html.find("-->", tag + 2) + 3
            if at < 3:
                return
            continue
        closing = html[tag + 1] == "/"
        name = NAME.match(html, tag + 1 + closing)
        if not name:
            if html[tag + 1] not in "!?/":
                yield "text", "<", None
                at = tag + 1
                continue
            at = html.find(">", tag) + 1
            if not at:
                return
            continue
        tag, at, values = name[0].lower(), name.end(), {}
        while True:
            end = END.match(html, at)
            if end:
                at = end.end()
                break
            found = ATTRIBUTE.match(html, at)
            if not found:
                at = SPACE.match(html, at).end() + 1  # a lone equals sign
                if at > size:
                    return
                continue
            at, value = found.end(), found[2] or ""
            if found[2] is None and at < size and html[at] in last and html[found.end(1) : at].strip() == "=":
                if at >= last[html[at]]:
                    return  # a quote that nothing closes: the rest is inside the tag
                close = html.index(html[at], at + 1)
                at, value = close + 1, html[at + 1 : close]
            values.setdefault(found[1].lower(), value)
        if closing:
            yield "end", tag, None
            continue
        yield "start", tag, values
        if tag in RAW:
            end = RAW[tag].search(html, at)
            if not end:
                return
            at = end.start()


class _Page:
    """Elements of a page, and its runs of text between block boundaries."""

    def __init__(self):
        self.tags, self.parents, self.names, self.roles = ["html"], [-1], [frozenset()], [""]
        self.stack = [0]
        self.open = {"html": 1}
        self.hidden = 0
        self.links = 0
        self.runs: list[tuple[int, str, int, int]] = []
        self.text: list[str] = []
        self.linked = self.anchors = 0
        self.unseen: set[int] = set()

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                own = next(n for n in reversed(self.stack) if self.bounds(n))
                self.runs.append((own, text, min(self.linked, len(text)), self.anchors))
            self.text, self.linked, self.anchors = [], 0, 0

    def bounds(self, node: int) -> bool:
        """Whether text inside and outside the element are different blocks."""
        return self.tags[node] in BLOCKS or bool(self.names[node])

    def pop(self, node: int) -> None:
        """Close the open elements down to this one."""
        while True:
            last = self.stack[-1]
            if self.bounds(last):
                self.flush()
            self.stack.pop()
            tag = self.tags[last]
            self.open[tag] -= 1
            if tag == "a":
                self.links -= 1
            if last in self.unseen:
                self.unseen.discard(last)
                self.hidden -= 1
            if last == node:
                return

    def nearest(self, tags, limits) -> int | None:
        """The innermost open element of these names that is not outside one of the limits."""
        if not any(self.open.get(t) for t in tags):
            return None
        for node in reversed(self.stack):
            if self.tags[node] in tags:
                return node
            if self.tags[node] in limits or not node:
                return None
        return None

    def start(self, tag: str, values: dict[str, str]) -> None:
        if tag == "br":
            if not self.hidden:
                self.text.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag == "html" or (tag == "body" and self.open.get("body")):
            return
        if tag not in HEAD and self.open.get("head"):
            self.pop(self.nearest({"head"}, ()))
        if tag in BLOCKS:
            paragraph = self.nearest({"p"}, {"td", "th", "caption", "table", "button", "object"})
            if paragraph is not None:
                self.pop(paragraph)
        if tag in ENDED_BY:
            ended = self.nearest(*ENDED_BY[tag])
            if ended is not None:
                self.pop(ended)
        if tag == "a":
            outer = self.nearest({"a"}, {"td", "th", "table"})
            if outer is not None and self.bounds(self.stack[-1]) is False:
                self.pop(outer)
        words = frozenset(re.split(r"[^a-z]+", f"{values.get('class', '')} {values.get('id', '')}".lower())) - {""}
        role = values.get("role", "").lower()
        hints = {"other" for w in words if OTHER_WORDS.fullmatch(w)} | {"comment" for w in words if COMMENT_WORDS.fullmatch(w)}
        if any(HEADER_WORDS.fullmatch(w) for w in words) or tag == "header":
            hints.add("header")
        if tag == "form" or role in ROLES:
            hints.add("other")
        if any(STRONG_WORDS.fullmatch(w) for w in words):
            hints.add("strong")
        if words & ARTICLE_WORDS or tag == "form":
            hints |= {"maybe"} if hints & {"other", "header"} else set()
        if tag in ("html", "body", "main") or role == "main":
            hints = set()
        if tag == "article":
            hints = {"comment"} if words & {"comment", "reply"} else set()
        if tag in ("article", "main") or role in ("main", "article") or values.get("itemprop") == "articleBody":
            hints.add("article")
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self.stack[-1])
        self.names.append(frozenset(hints))
        self.roles.append(f"{tag} {values.get('class', '')}")
        if self.bounds(node):
            self.flush()
        self.stack.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1
        if tag == "a":
            self.links += 1
            self.anchors += 1
        style = values.get("style", "").replace(" ", "").lower()
        gone = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
        if tag in NO_TEXT or gone:
            self.flush()
            self.hidden += 1
            self.unseen.add(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        if tag in ("html", "body") or not self.open.get(tag):
            return
        limits = {"td", "th", "caption"} - {tag} if tag not in ("table", "tbody", "thead", "tfoot", "tr") else set()
        found = self.nearest({tag}, limits if tag in BLOCKS else BLOCKS)
        if found is not None:
            self.pop(found)

    def add(self, data: str) -> None:
        if not self.hidden:
            self.text.append(data)
            if self.links:
                self.linked += len(" ".join(data.split()))


def _parsed(html: str) -> _Page:
    page = _Page()
    for kind, text, values in tokens(html):
        if kind == "text":
            page.add(text)
        elif kind == "start":
            page.start(text, values)
        else:
            page.end(text)
    page.flush()
    return page


def _points(text: str, linked: int) -> float:
    return (1 + sum(text.count(c) for c in ",،、，") + len(text) / 100) * (1 - linked / len(text))


def _below(page: _Page, marked: set[int]) -> list[bool]:
    """For each element whether it or one that holds it is marked."""
    out = [False] * len(page.tags)
    for node, parent in enumerate(page.parents):
        out[node] = node in marked or (parent >= 0 and out[parent])
    return out


def _total(page: _Page, values: list[float]) -> list[float]:
    """Sums over each element and all in it; an element comes after the one that holds it."""
    for node in range(len(values) - 1, 0, -1):
        values[page.parents[node]] += values[node]
    return values


def _other_parts(page: _Page, own: list[float]) -> set[int]:
    """Elements named as something other than the article.

    The name does not count if the element holds an article element. Where the page has none, a name that can be that of a
    frame of the page does not count if the element holds nearly all points left, or over half and is named as the article, too.
    """
    articles = _total(page, [float("article" in h and "comment" not in h) for h in page.names])
    out = {
        node for node, hints in enumerate(page.names)
        if "comment" in hints and (not articles[node] or articles[node] < articles[0]) or "strong" in hints and not (articles[node] or "article" in hints)}
    gone = _below(page, out)
    points = _total(page, [0.0 if g else p for p, g in zip(own, gone)])
    for node, hints in enumerate(page.names):
        if hints & {"other", "header"} and not (articles[node] or gone[node]):
            share = MOST_POINTS if "maybe" in hints else NEARLY_ALL
            if articles[0] or points[node] <= share * points[0]:
                out.add(node)
    return out


def main_blocks(html: str | None) -> list[str]:
    """Blocks of the article of a page, in page order."""
    page = _parsed(html or "")
    n = len(page.tags)
    own = [0.0] * n
    for node, text, linked, _ in page.runs:
        own[node] += _points(text, linked)
    others = _other_parts(page, own)
    gone = _below(page, others)
    in_article = _below(page, {i for i in range(n) if "article" in page.names[i]})
    # Of a header inside an article only its headings belong to the text.
    headers = _below(page, {i for i in others if "header" in page.names[i] and not page.names[i] & {"other", "comment"} and in_article[i]}
                     | {i for i in others if page.tags[i] == "header" and in_article[i]})
    outside = _below(page, {i for i in others if not headers[i]})
    runs = [r for r in page.runs if not gone[r[0]]
            or (headers[r[0]] and not outside[r[0]] and page.tags[r[0]] in HEADINGS)]
    chars, linked, anchors, scores = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for node, text, links, count in runs:
        chars[node] += len(text)
        linked[node] += links
        anchors[node] += count
        if page.tags[node] in HEADINGS:
            continue
        worth, up = _points(text, links), page.parents[node] if page.tags[node] in PARAGRAPHS else node
        for level in range(LEVELS):
            if up < 0:
                break
            scores[up] += worth / (1, 2, 6, 9, 12)[level]
            up = page.parents[up]
    _total(page, chars), _total(page, linked), _total(page, anchors)
    density = [a / b if b else 0.0 for a, b in zip(linked, chars)]
    scores = [s * (1 - d) for s, d in zip(scores, density)]
    best = max(range(n), key=scores.__getitem__)
    if scores[best] <= 0:
        best = next((i for i in range(n) if "article" in page.names[i] and chars[i]), None)
        if best is None:
            return []
    kept = _with_siblings(page, best, scores, chars, density, runs)
    inside = _below(page, kept)
    above, up = set(), best
    while up >= 0:
        above.add(up)
        up = page.parents[up]
    lists = _below(page, {
        i for i in range(n) if i not in kept and i not in above and density[i] >= LINK_LIST and anchors[i] >= 2
        and page.tags[i] in ("ul", "ol", "dl", "table", "div", "section")})
    return [text for node, text, _, _ in runs if inside[node] and not lists[node]]


def _with_siblings(page: _Page, best: int, scores, chars, density, runs) -> set[int]:
    """The best container, or the article element around it, and the siblings that belong to it."""
    up, article = best, None
    while up > 0 and article is None:
        article = up if "article" in page.names[up] else None
        up = page.parents[up]
    box = best if article is None else article
    parent = page.parents[box]
    kept = {box}
    if parent < 0:
        return kept
    least = max(scores[box], scores[best]) * SIBLING_SHARE
    sentences = [0.0] * len(page.tags)
    for node, text, _, _ in runs:
        sentences[node] += bool(re.search(r"[.!?:…。！？][\"'»”)]*$", text))
    _total(page, sentences)
    children = [i for i in range(parent + 1, len(page.tags)) if page.parents[i] == parent]
    for i in children:
        if i == box or not chars[i]:
            continue
        if article is not None:
            if page.tags[i] == page.tags[box] and "article" in page.names[i] and scores[i] >= least:
                kept.add(i)
            continue
        same = page.roles[i] == page.roles[box] and (page.roles[i].strip() != page.tags[i] or page.tags[i] == "section")
        prose = chars[i] > 80 or sentences[i] > 0
        if density[i] <= PLAIN_LINKS and (scores[i] >= least and prose or same):
            kept.add(i)
        elif page.tags[i] == "p":
            if (chars[i] > 80 and density[i] < 0.25) or (not density[i] and sentences[i]):
                kept.add(i)
    waiting: list[int] = []
    for i in children:
        if page.tags[i] in HEADINGS and not density[i]:
            waiting.append(i)
        elif i in kept:
            kept.update(waiting)
            waiting = []
        elif chars[i]:
            waiting = []
    return kept


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``row``, a struct of the row's columns without ``html``, and ``article``, the main text of the page.

    Paragraphs pass points for their length and commas, less their share of linked text, to what holds them: all to the
    first level, a half to the second, less above. The container with the most points after its own share of links, or the
    article element around it, is the article; siblings with a fifth of its points, of its class, or paragraphs
    of sentences belong to it, and headings before them. Menus, headers, footers, sidebars, forms, notices, adverts and
    comments are told by element, role, class and id and go before; so do lists that are mostly links. Of a header inside the
    article its headings stay.

    Blocks are joined by an empty line, their white space (of any kind) is one space, ends trimmed; ``br`` is white space.
    Character references are decoded. Null, empty or wholly hidden pages: an empty text. Text outside of elements
    is a paragraph of the page. Broken markup: open paragraphs, list items and cells end where the next begins, stray end
    tags are ignored. Repeated rows are answered each; no rows: no rows.
    """
    pin(pages.sparkSession)
    others = [c for c in pages.columns if c != html]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(None).alias("none"))
    kept = pages.select(row.alias("row"), F.col(html).cast("string").alias("html"))
    schema = f"row {kept.schema['row'].dataType.simpleString()}, article string"

    def articles(batches):
        for batch in batches:
            texts = ["\n\n".join(main_blocks(page.as_py())) for page in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "article"])

    return kept.mapInArrow(articles, schema)
