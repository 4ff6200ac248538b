"""Main text of web pages by the maximum-scoring subsequence.

A page is read as words and tags. Words score positive, tags negative, with weights learnt from a bounded sample of pages that
mark their main part themselves (`article`, `main`): the log odds of lying inside it, by tag name and by kind of
word (linked or not). One linear scan finds the contiguous stretch with the highest sum. The stretch is then set to
the borders of the smallest element that holds it, and boilerplate inside (menus, forms, adverts, notices, reader comments, scripts) is left
out. Boilerplate are whole containers only: by their tag, by a class, id or role that says nothing but that (`NAMES`, with `PLAIN` words
beside them), or by a class or id that the labelled pages have outside their main part only (`learn`).

Blocks are joined by one line feed; white space, `br` included, inside a block is one space. Reading is linear in the page's length, however
its tags nest or fail to end.

Defined results: null is empty; a page without words gives an empty text; a tag that never ends is text, and after one whose quotes never end
quotes no longer count; a comment, script or style that never ends takes the rest. Of stretches with the same score the first counts. Rows that
repeat a page_id are pages of their own. A page of any length is read whole. Only page_id, url and html are read; other columns, whatever
their names, play no part.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import map_rows, materialise, read, small_text_batches, texts

#: Bound of the labelled sample: pages with the smallest hash of their id.
SAMPLE = 1000
TAG = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
REST = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>")
#: Elements whose content is no text of the page; the first three take the rest of the page if they never end.
RAW = ("script", "style", "textarea", "title", "iframe", "noscript", "template", "svg")
ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"[^\S\xa0]+|\xa0+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MATH = frozenset("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mtable mtr mtd semantics annotation".split())
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
DROP = frozenset("nav footer aside form button select option dialog menu head object canvas audio video fieldset noscript".split())
MAIN = frozenset(("article", "main"))
#: Words of a class, id or role that name what isn't main text.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget complementary contentinfo search alert".split()
)
#: Words that may stand beside them.
PLAIN = frozenset("area bar block box bottom container content entry first form global group inner item items last left link links list main middle mobile outer page post primary right row section secondary site sticky story template top wrap wrapper".split())
#: What names count on: containers, never a heading, paragraph, cell or inline element.
CONTAINERS = frozenset("div section aside header footer nav ul ol dl table form article main center figure blockquote".split())
CLOSES = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Weights before any page is labelled.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote table thead tbody tr td th figure figcaption hr".split())
DEFAULT = {"word": 1.0, "link": -1.0, "tag": -2.0, "boiler": -1.0} | dict.fromkeys(FLOW | INLINE, -0.5)
#: A class or id is boilerplate by learning if so many labelled pages have it on a container, each outside its main part only.
SUPPORT = 20


#: What an article or main inside can't be the page's own: teasers and the like.
HIDES = (DROP | {"header"}) - {"form", "fieldset"}


def marks(attrs: str) -> list[str]:
    """The single classes, ids and roles of a tag."""
    return [x for found in ATTR.finditer(attrs) for x in (found[2] or found[3] or found[4] or "").split()]


def named(mark: str) -> bool:
    """A class, id or role that says nothing but what isn't main text."""
    words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", mark).lower())) - {""}
    return bool(NAMES & words) and words <= NAMES | PLAIN


def tokens(source: str):
    """(start, end, closing, name, attributes) of each tag; name is empty for what is no text: comments, scripts and the like."""
    at, quotes, endless, end = 0, True, set(), source.rfind(">")
    while (start := source.find("<", at)) >= 0:
        if source.startswith("<!--", start):
            stop = source.find("-->", start)
            at = len(source) if stop < 0 else stop + 3
            yield start, at, "", "", ""
            continue
        if start > end:  # no tag ends from here on
            return
        if source[start + 1 : start + 2] in ("!", "?"):
            at = source.find(">", start) + 1
            yield start, at, "", "", ""
            continue
        found = TAG.match(source, start + 1)
        if not found:
            at = start + 1
            continue
        rest = REST.match(source, found.end()) if quotes else None
        quotes = rest is not None
        at = rest.end() if rest else source.find(">", found.end()) + 1
        name, attrs = found[2].lower(), source[found.end() : at - 1]
        if not found[1] and name in RAW and not (name == "svg" and attrs.endswith("/")):
            stop = None
            if name not in endless:
                stop = re.compile(rf"</{name}\s*>", re.I).search(source, at)
                if not stop:
                    endless.add(name)
            if stop or name in RAW[:3]:
                at = stop.end() if stop else len(source)
                yield start, at, "", "", ""
                continue
        yield start, at, found[1], name, attrs


class Page:
    """Pieces of text with their block and element, in page order; elements as (name, parent, first piece, piece after the last, boilerplate, named so)."""

    def __init__(self, source: str, learnt: frozenset[str] = frozenset()):
        self.elements: list[list] = [["", -1, 0, 0, False, False]]
        self.marks: dict[int, list[str]] = {}  # of containers
        self.pieces: list[tuple[str, int, int]] = []  # text, element, number of the block
        self.tags: list[tuple[int, str]] = []  # (pieces before it, tag name)
        self.stack, self.blocks, self.opened = [0], [0], Counter()  # open elements; where in the stack block elements stand; open names
        stack, at, block = self.stack, 0, 0
        for start, end, closing, name, attrs in tokens(source):
            if start > at:
                self.pieces.append((source[at:start], stack[-1], block))
            at = end
            if not name:
                continue
            self.tags.append((len(self.pieces), name))
            if name not in INLINE:
                block += 1
            elif name == "br":
                self.pieces.append((" ", stack[-1], block))
            if closing:
                if self.opened[name]:
                    while self.elements[stack[-1]][0] != name:
                        self.close()
                    self.close()
                continue
            if name in VOID or (attrs.endswith("/") and name in ("svg", "path", "math")):
                continue
            if name in CLOSES:  # a paragraph ends where a block begins
                if self.elements[stack[self.blocks[-1]]][0] == "p":
                    while self.elements[stack[-1]][0] != "p":
                        self.close()
                    self.close()
            elif name == "li" and self.elements[stack[-1]][0] == "li":
                self.close()
            found = marks(attrs) if attrs and name in CONTAINERS else []
            so = any(named(x) or x in learnt for x in found)
            if found:
                self.marks[len(self.elements)] = found
            drop = name in DROP or (name == "header" and not (self.opened["article"] or self.opened["main"]))
            self.elements.append([name, stack[-1], len(self.pieces), 0, drop, so])
            if name not in INLINE:
                self.blocks.append(len(stack))
            self.opened[name] += 1
            stack.append(len(self.elements) - 1)
        if at < len(source):
            self.pieces.append((source[at:], stack[-1], block))
        while len(stack) > 1:
            self.close()
        self.elements[0][3] = len(self.pieces)
        self.mark()

    def mark(self) -> None:
        """Settle what is boilerplate, from the elements' own tags and names; it goes on to all inside.

        A name doesn't count on an element that holds an article or main (an outermost one without such a name), nor, if all of these
        are within named elements, on one that holds most of the page's unlinked words. Such an article or main is no boilerplate
        for what is around it, unless that is a menu, footer or the like.
        """
        elements = self.elements
        hidden, linked, within, marked, outer = ([False] * len(elements) for _ in range(5))
        for i, (name, parent, _, _, drop, _) in enumerate(elements):
            up = parent if parent >= 0 else i
            hidden[i] = hidden[up] or (drop and name in HIDES)
            linked[i] = linked[up] or name == "a"
            outer[i] = name in MAIN and not elements[i][5] and not hidden[i] and not marked[up]
            marked[i] = marked[up] or outer[i]
            within[i] = within[up] or (elements[i][5] and name not in MAIN)
        holds = [False] * len(elements)
        for i in range(len(elements) - 1, 0, -1):
            if outer[i] or holds[i]:
                holds[elements[i][1]] = True
        words = [0]
        for text, element, _ in self.pieces:
            words.append(words[-1] + (0 if hidden[element] or linked[element] else len(text.split())))
        unmarked = not any(outer[i] and not within[i] for i in range(len(elements)))
        for i, e in enumerate(elements):
            name, parent, first, after, drop, so = e[:6]
            so = so and name not in MAIN and not holds[i] and not (unmarked and 2 * (words[after] - words[first]) > words[-1])
            e[4] = drop or so or (parent >= 0 and elements[parent][4] and not outer[i])

    def close(self) -> None:
        if self.blocks[-1] == len(self.stack) - 1:
            self.blocks.pop()
        e = self.elements[self.stack.pop()]
        e[3] = len(self.pieces)
        self.opened[e[0]] -= 1

    def main(self) -> int | None:
        """The element that the page itself marks as its main part, if there is just one."""
        n = len(self.elements)
        inside, within, outer = [False] * n, [False] * n, []  # an unhidden article or main; a named element
        for i, (name, parent, _, _, drop, _) in enumerate(self.elements):
            if parent >= 0:
                up = self.elements[parent]
                inside[i] = inside[parent] or (up[0] in MAIN and not up[4])
                within[i] = within[parent] or up[5]
            if name in MAIN and not drop and not inside[i]:
                outer.append(i)
        if len(outer) > 1:
            outer = [i for i in outer if not within[i]]
        return outer[0] if len(outer) == 1 else None

    def parents(self, i: int):
        while (i := self.elements[i][1]) >= 0:
            yield i

    def kinds(self) -> list[tuple[int, str, int]]:
        """(piece, kind, how many) in page order: tags before the piece, then its words."""
        out, t = [], 0
        linked = [False] * len(self.elements)
        for i, e in enumerate(self.elements):
            linked[i] = e[0] == "a" or (e[1] >= 0 and linked[e[1]])
        for i, (text, element, _) in enumerate(self.pieces):
            while t < len(self.tags) and self.tags[t][0] <= i:
                out.append((i, self.tags[t][1], 1))
                t += 1
            n = len(text.split())
            if n:
                out.append((i, ("link" if linked[element] else "word"), n))
        return out

    def region(self, weights: dict[str, float]) -> tuple[int, int]:
        """The maximum-scoring stretch, as pieces from..to (exclusive)."""
        best, best_at, total, start = 0.0, (0, 0), 0.0, 0
        other = weights.get("tag", DEFAULT["tag"])
        for piece, kind, n in self.kinds():
            if total <= 0:
                total, start = 0.0, piece
            if self.elements[self.pieces[piece][1]][4] and kind == "word":
                kind = "boiler"
            total += n * weights.get(kind, other)
            if total > best:
                best, best_at = total, (start, piece + 1)
        return best_at

    def text(self, weights: dict[str, float]) -> str:
        first, after = self.region(weights)
        if first == after:
            return ""
        inside = [i for i in range(first, after) if self.pieces[i][0].strip() and not self.elements[self.pieces[i][1]][4]]
        if not inside:
            return ""
        # The smallest block element that holds the stretch; one that the page marks as main wins over what is around it.
        around = self.pieces[inside[0]][1]
        while self.elements[around][0] in INLINE or self.elements[around][0] in FLOW or not (self.elements[around][2] <= inside[0] and inside[-1] < self.elements[around][3]):
            around = self.elements[around][1]
        held = next((p for p in [around, *self.parents(around)] if self.elements[p][0] in MAIN), None)
        if held is None:
            low, high = self.elements[around][2:4]
            mains = [i for i, e in enumerate(self.elements) if e[0] in MAIN and not e[4] and i > around and low <= e[2] and e[3] <= high and e[2] < after and e[3] > first]
            held = max(mains, key=lambda i: self.elements[i][3] - self.elements[i][2], default=None)
        around = around if held is None else held
        whole = self.elements[around][0] not in ("", "html", "body") or held is not None
        low, high = (self.elements[around][2], self.elements[around][3]) if whole else (first, after)
        if not whole:  # no container: whole blocks of the stretch
            blocks = {self.pieces[i][2] for i in inside}
            while low > 0 and self.pieces[low - 1][2] in blocks:
                low -= 1
            while high < len(self.pieces) and self.pieces[high][2] in blocks:
                high += 1
        out, parts, block = [], [], None
        for text, element, number in self.pieces[low:high]:
            if self.elements[element][4]:
                continue
            if number != block and parts:
                out.append("".join(parts))
                parts = []
            block = number
            parts.append(text)
        out.append("".join(parts))
        clean = (" ".join(html.unescape(x).split()) for x in out)
        return "\n".join(x for x in clean if x)


def learn(pages: list[str]) -> tuple[dict[str, float], frozenset[str]]:
    """Log odds of words and tags to lie inside the marked main part, and the classes and ids that are boilerplate; pages without one say nothing."""
    seen = [Counter(), Counter()]
    where = [Counter(), Counter()]  # pages by class or id of a container, outside and inside
    for source in pages:
        page = Page(source)
        main = page.main()
        if main is None:
            continue
        low, high = page.elements[main][2:4]
        for piece, kind, n in page.kinds():
            seen[low <= piece < high][kind] += n
        found = (set(), set())
        for i, names in page.marks.items():
            first, after = page.elements[i][2:4]
            found[first < high and after > low].update(names)  # what holds the main part isn't outside
        for n, names in zip(where, found, strict=True):
            n.update(names)
    weights = dict(DEFAULT)
    total = [sum(c.values()) + 1 for c in seen]
    for kind in seen[0] | seen[1]:
        odds = math.log((seen[1][kind] + 1) / total[1]) - math.log((seen[0][kind] + 1) / total[0])
        if kind == "word":
            weights[kind] = min(3.0, max(0.2, odds))
        elif kind == "link":
            weights[kind] = max(-3.0, min(-0.2, odds))
        else:  # tags are costs: more so where they are rare inside
            weights[kind] = -min(8.0, max(0.2, 1.0 - odds))
    return weights, frozenset(x for x, n in where[0].items() if n >= SUPPORT and not where[1][x])


def train(pages: DataFrame, size: int = SAMPLE) -> tuple[dict[str, float], frozenset[str]]:
    rows = pages.select("page_id", "html").where("html is not null and page_id is not null")
    ids = materialise(rows.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(size), "html-sample")
    # Ids first, so that tasks send ids alone to the driver; pages of the chosen ids follow, `size` at most.
    return learn([r["html"] for r in rows.join(F.broadcast(ids.distinct()), "page_id", "left_semi").limit(size).collect()])


def extract(pages: DataFrame, model: tuple[dict[str, float], frozenset[str]]) -> DataFrame:
    small_text_batches(pages.sparkSession)
    weights, learnt = model

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [Page(t, learnt).text(weights) if t else "" for t in texts(batch, "html")]
            return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

        return step

    return map_rows(pages.select("page_id", "url", "html"), "page_id long, url string, text string, n_chars long", make)


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return extract(pages, train(pages))
