"""Main text of web pages by the maximum-scoring stretch of tokens (operator 2).

A page becomes a row of words and tags. Elements that are never the article (menus, footers, forms,
scripts, and elements whose class, id or role says so) are cut out first. If the markup names the
article, all of it scores positive and all else negative; otherwise every word scores positive and
every tag negative, with weights learned from the labelled pages below. One linear scan finds the
contiguous stretch of the highest sum, and its text is the page's text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import slices

#: Labelled pages: the main text stands between the two marks. Weights are learned from them alone.
LABELLED = (
    "<html><body><div><a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport</a></div><!--main--><article><h1>Rain "
    "ends the long dry spell</h1><p>Farmers in the valley welcomed the first rain since March. Reservoirs rose by a "
    "hand's breadth within a day.</p><p>More is expected <b>on Friday</b>, the weather office said in its bulletin."
    "</p></article><!--/main--><div><ul><li><a href=/1>Ten recipes</a></li><li><a href=/2>Quiz</a></li><li><a href=/3>"
    "Horoscope</a></li></ul></div></body></html>",
    "<html><body><table><tr><td><a href=/>Index</a></td><td><a href=/a>Archive</a></td></tr></table><div><span>Share</span>"
    "<span>Print</span></div><!--main--><div><h2>How the bridge was built</h2><p>Work began in spring and the piers stood "
    "by autumn.<br>Stone came from the old quarry across the river.</p><p>The span was closed in the second year, and "
    "the road opened to carts <i>before</i> the snow.</p><blockquote>Nobody believed it would last a winter.</blockquote>"
    "</div><!--/main--><div><a href=/p>Previous</a><a href=/q>Next</a><img src=x><div>2020</div></div></body></html>",
    "<html><body><div><div><a href=/l>Log in</a></div><div><a href=/j>Join</a></div></div><!--main--><main><p>The committee "
    "met twice. Its report names three causes, and <a href=/r>the second</a> was known for years before the accident.</p>"
    "<ul><li>The valve had been repaired with the wrong part.</li><li>No one read the gauge on the night shift.</li></ul>"
    "<p>It asks for yearly inspections from now on.</p></main><!--/main--><section><div><a href=/t>Top</a></div><div>"
    "<a href=/m>Map</a></div><div><a href=/u>Us</a></div></section></body></html>",
)
#: Elements that never belong to the main text.
NEVER = frozenset(
    "head title script style noscript template nav footer aside form button select textarea iframe object svg canvas "
    "menu dialog audio video math option input label".split()
)
#: One of these as a class, id or role marks an element that does not belong to it either, whatever its size.
MARKS = frozenset(
    "ad ads adv advert advertisement adverts banner promo promotion sponsor sponsored sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead topbar comment comments disqus reply replies respond cookie cookies notice notices consent "
    "gdpr popup modal overlay newsletter subscribe signup login share sharing social related recommended widget "
    "pagination pager toolbar search form contentinfo complementary alert skip hidden".split()
)
#: Joined to marks by hyphens or underscores, these leave a class a mark, as in ``comment-list``.
NEUTRAL = frozenset(
    "list area section wrap wrapper container box block bar item items thread holder inner outer left right top bottom site "
    "page user reader buttons button links icons primary secondary global module panel region unit slot row column col text title".split()
)
#: Elements that a mark does not cut.
UNMARKED = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
#: Least score of a token inside the article that the page names, and highest outside it.
INSIDE, OUTSIDE = 0.01, -0.5
#: Elements whose content is no markup.
RAW = ("script", "style", "textarea", "title", "iframe", "noscript")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their end tag may be missing; the next one of their kind, or the end of what holds them, closes them.
OPEN_ENDED = frozenset("p li dt dd td th tr option".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub "
    "sup time tt u var wbr img".split()
)
#: An unclosed element that does not belong is taken to end before one of these.
RESUME = frozenset("article main h1".split())

TOKEN = re.compile(
    r"<!--(?P<note>.*?)(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")(?P<rawattr>(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)


class Token(NamedTuple):
    """A tag (``name``, ``close``), or the text between two tags (``name`` empty)."""

    name: str
    close: bool
    text: str
    out: bool  # opens an element that does not belong
    note: str = ""
    marks: frozenset[str] = frozenset()  # of the element it opens


def tokenise(page: str) -> list[Token]:
    found = []
    for match in TOKEN.finditer(page):
        text = match["text"]
        if text is not None:
            found.append(Token("", False, text, False))
        elif match["name"]:
            name, attr = match["name"].lower(), match["attr"] or ""
            opens = not match["close"]
            found.append(Token(name, not opens, "", opens and name in NEVER, marks=marks_of(attr) if opens and name not in UNMARKED else frozenset()))
        elif match["note"] is not None:
            found.append(Token("", False, "", False, match["note"]))
        # raw elements are never text: left out here
    return found


def marks_of(attr: str) -> frozenset[str]:
    if "=" not in attr:
        return frozenset()
    names = [name for value in ATTRIBUTE.findall(attr) for name in value.strip("\"'").lower().split()]
    return frozenset(part for name in names if (parts := set(re.split("[-_]+", name))) <= MARKS | NEUTRAL for part in parts & MARKS)


def end_of(tokens: list[Token], start: int) -> int:
    """Where the element that ``start`` opens ends, its end tag included."""
    name, depth = tokens[start].name, 0
    if name in VOID:
        return start + 1
    holders: list[str] = []
    for at in range(start, len(tokens)):
        token = tokens[at]
        if not token.name or token.name in VOID:
            continue
        if name in OPEN_ENDED and at > start:
            if token.name == name and not token.close and not holders:
                return at
            if token.close and token.name not in holders and token.name != name and token.name not in INLINE:
                return at
            if token.name != name and token.name not in INLINE:
                if not token.close:
                    holders.append(token.name)
                else:
                    holders.remove(token.name)
        if token.name == name:
            depth += -1 if token.close else 1
            if depth == 0:
                return at + 1
    for at in range(start + 1, len(tokens)):
        if tokens[at].name in RESUME and not tokens[at].close:
            return at
    return len(tokens)


def spans_of(tokens: list[Token], wanted: list[int]) -> dict[int, int]:
    """Start and end of those elements that are closed."""
    ends: dict[int, int] = {}
    open_at: dict[str, list[int]] = {}
    for at, token in enumerate(tokens):
        if token.close and open_at.get(token.name):
            ends[open_at[token.name].pop()] = at + 1
        elif token.name and not token.close:
            open_at.setdefault(token.name, []).append(at)
    found = {}
    for at in wanted:
        end = end_of(tokens, at) if tokens[at].name in OPEN_ENDED or tokens[at].name in VOID else ends.get(at)
        if end:
            found[at] = end
    return found


def marked(tokens: list[Token]) -> dict[int, int]:
    """Start and end of the marked elements that are cut: those closed and without an article in them; none if no
    word would be left."""
    wanted = [at for at, token in enumerate(tokens) if token.marks]
    if not wanted:
        return {}
    resumes, words = [0], [0]
    for token in tokens:
        resumes.append(resumes[-1] + (token.name in RESUME and not token.close))
        words.append(words[-1] + bool(token.text.strip()))
    found = {at: end for at, end in spans_of(tokens, wanted).items() if resumes[end] == resumes[at]}
    left, covered = words[-1], 0
    for at, end in sorted(found.items()):
        left -= max(0, words[end] - words[max(at, covered)])
        covered = max(covered, end)
    return found if left else {}


def belonging(tokens: list[Token]) -> list[Token]:
    """The tokens without the elements that never belong; a header counts only inside an article."""
    kept, at, inside = [], 0, 0
    while at < len(tokens):
        token = tokens[at]
        if token.name in ("article", "main"):
            inside = max(0, inside + (-1 if token.close else 1))
        if token.out or token.name == "header" and not token.close and not inside:
            at = end_of(tokens, at)
            continue
        kept.append(token)
        at += 1
    cut = marked(kept)
    rest, at = [], 0
    while at < len(kept):
        if at in cut:
            at = cut[at]
        else:
            rest.append(kept[at])
            at += 1
    return rest


def article_of(tokens: list[Token]) -> tuple[int, int] | None:
    """The page's article, if its markup names one: the only ``article``, else the only ``main``, else the
    ``article`` whose best stretch scores highest."""
    places: dict[str, list[tuple[int, int]]] = {"article": [], "main": []}
    for name, found in places.items():
        depth, start = 0, 0
        for at, token in enumerate(tokens):
            if token.name != name:
                continue
            if not token.close:
                start = at if not depth else start
                depth += 1
            elif depth:
                depth -= 1
                if not depth:
                    found.append((start, at + 1))
        if depth:
            found.append((start, len(tokens)))
    for found in places.values():
        if len(found) == 1:
            return found[0]
    if not places["article"]:
        return None

    def score(place: tuple[int, int]) -> float:
        scores = scored(tokens[place[0] : place[1]], learned())
        start, end = best_stretch(scores)
        return sum(scores[start:end])

    return max(places["article"], key=score)


def scored(tokens: list[Token], weights: dict[str, float]) -> list[float]:
    """The score of every token; a text scores for each of its words."""
    scores, linked = [], 0
    for token in tokens:
        if token.name:
            if token.name == "a":
                linked = max(0, linked + (-1 if token.close else 1))
            scores.append(weights.get(token.name, weights["other tag"]))
        else:
            scores.append(len(token.text.split()) * weights["linked word" if linked else "word"])
    return scores


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous stretch of the highest sum; empty if none is positive. The first
    of equal ones counts."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for at, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, span = total, (start, at + 1)
    return span


@lru_cache(maxsize=1)
def learned() -> dict[str, float]:
    """Weights from the labelled pages: how much likelier a kind of token is inside than outside.

    Tags stay below zero and words outside links above, whatever so few pages say.
    """
    counts = {True: Counter(), False: Counter()}
    for page in LABELLED:
        inside, linked = False, 0
        for token in belonging(tokenise(page)):
            if token.note in ("main", "/main"):
                inside = token.note == "main"
            elif token.name:
                if token.name == "a":
                    linked += -1 if token.close else 1
                counts[inside][token.name] += 1
            else:
                counts[inside]["linked word" if linked else "word"] += len(token.text.split())
    sizes = {side: sum(c.values()) for side, c in counts.items()}
    odds = {
        kind: math.log((counts[True][kind] + 0.5) / sizes[True]) - math.log((counts[False][kind] + 0.5) / sizes[False])
        for kind in counts[True].keys() | counts[False].keys()
    }
    weights = {kind: min(-0.05, max(-3.0, value)) for kind, value in odds.items()}
    weights["word"] = max(0.5, odds["word"])
    weights["linked word"] = min(0.1, odds["linked word"])
    weights |= {kind: -0.05 for kind in ("p", "br", "b", "i", "em", "strong", "span", "article", "main")}
    weights |= {kind: -0.1 for kind in ("table", "thead", "tbody", "tr", "td", "th")}
    return weights | {"other tag": -0.2}


def blocks(tokens: list[Token]) -> Iterator[str]:
    """The text of each block, decoded, its white space turned into single spaces."""
    held: list[str] = []
    for token in tokens:
        if not token.name:
            held.append(token.text)
        elif token.name not in INLINE:
            yield " ".join(unescape("".join(held)).split())
            held = []
    yield " ".join(unescape("".join(held)).split())


def main_text(page: str | None) -> str:
    if not page:
        return ""
    tokens = belonging(tokenise(page))
    scores, place = scored(tokens, learned()), article_of(tokens)
    if place:
        # Whatever stands in the article the page names is inside, all else is outside.
        scores = [max(s, INSIDE) if place[0] <= at < place[1] else min(s, OUTSIDE) for at, s in enumerate(scores)]
    start, end = best_stretch(scores)
    return " ".join(filter(None, blocks(tokens[start:end])))


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, from the whole html.

    A null or empty html gives an empty text. Null ids and urls and repeated rows are kept as they
    are. Other columns are not read. An empty table gives an empty one.
    """
    kinds = {name: pages.schema[name].dataType.simpleString() for name in (key, url)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["key", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    found = rows.mapInArrow(run, f"key {kinds[key]}, url {kinds[url]}, text string, n_chars long")
    return found.withColumnRenamed("key", key).withColumnRenamed("url", url)
