"""Main text of web pages by tag-path ratios.

A page is cut into blocks, each with the path of block elements from the root to it.  Over all
blocks of a path, text length and punctuation are summed and divided by the number of blocks.  Both
ratios are smoothed over the page and multiplied; paths whose fused score reaches a threshold
are content.  The element that holds the content is then taken as a whole, without the parts that
their tags, roles, ids or classes name as menus, headers, footers, sidebars, notices, adverts, forms
or reader comments.

Names are weaker evidence than text.  Words that often name a topic count only if they are all that
a class says, an article's own classes count only if they name readers' or other pages' texts, and an
element that a name excludes comes back if it holds most of the page's score.
"""

from __future__ import annotations

import functools
import html
import itertools
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dispatchlens.llm import words
from dispatchlens.llm.frames import tidy

MADE = ("main_text", "n_chars", "n_blocks")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCKS = set(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main
    menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead
    tr ul""".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: elements that are never part of an article
OUTSIDE = set(
    """aside button datalist dialog fieldset footer form head header iframe input label menu nav
    noscript object optgroup option script search select style svg template textarea title
    canvas audio video map""".split()
)
ROLES = set(
    """alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
    status toolbar""".split()
)
#: words in ids and classes that tell what an element is for
_NAMES = re.compile(
    r"""(?x)^(?:
    ads? | advert\w* | adsense | adsby\w* | adslot | adbox | adunit | sponsor\w* | promo\w*
    | banners?
    | menu\w* | nav | navi | navbar | navigation | topbar | toolbar | breadcrumbs? | crumbs?
    | sidebar\w* | side | aside | widgets? | rail | footer | foot | header | masthead | topnav | subnav
    | cookie\w* | consent | gdpr | notices? | notifications? | alerts? | popup | modal | overlay
    | newsletter | subscri\w+ | signup | login | signin | paywall | disclaimer
    | comments? | comment(?:s|list|box|form|area|thread|section) | disqus | discussion | respond | repl(?:y|ies) | feedback | reactions?
    | share | sharing | social | related | recommend\w* | pagination | pager | copyright | legal
    | form | search\w* | skip | byline | meta | tags?
    )$"""
)
#: those of them that are as often a topic or a state: they must be the whole name, but for parts
#: of a page
_TOPICS = re.compile(
    r"""(?x)^(?:
    side | aside | rail | foot | notices? | alerts? | consent | overlay | legal | copyright | disclaimer
    | discussion | respond | repl(?:y|ies) | feedback | reactions? | share | sharing | social | related
    | promo\w* | recommend\w* | form | search\w* | skip | byline | meta | tags? | ads?
    )$"""
)
_PARTS = re.compile(
    r"""(?x)^(?:
    post | entry | article | story | content | page | pages | site | blog | news | main | the | my
    | lists? | links? | items? | box | bar | block | wrap | wrapper | container | section | area | group
    | panel | row | col | column | inner | outer | top | bottom | left | right | body | cloud | text | info
    | data | media | network | networks | buttons? | btns? | icons? | label | title | heading | field
    | input | results? | posts | articles | stories | reading | topics | to | by | of | and | us | on | this
    | \d+
    )$"""
)
#: those that are as often said of a page's layout as of an element
_LAYOUT = re.compile(
    r"""(?x)^(?:
    sidebar\w* | widgets? | menu\w* | nav | navi | navbar | navigation | topbar | toolbar | topnav | subnav
    | banners? | footer | header | masthead | breadcrumbs? | crumbs? | paywall | subscri\w+
    )$"""
)
#: texts of readers, of other pages and of advertisers
_OTHERS = re.compile(
    r"""(?x)^(?:
    comment\w* | disqus | respond | repl(?:y|ies) | related | recommend\w* | promo\w* | sponsor\w*
    | advert\w* | ads? | widgets?
    )$"""
)
#: before such a word they say what an element is about
_ABOUT = set("tag tags category cat format type status topic genre author".split())
#: words for an element that is a post
_POST = set("post hentry h-entry entry article story type-post type-page status-publish".split())
#: after "comments" they say whether a page takes them
_STATES = {"open", "opened", "closed", "enabled", "disabled", "on", "off", "allowed"}
#: what a name says: the word tells of a layout, of a part of the page, of texts by others
_PART, _WHOLE, _FOREIGN = 1, 2, 3
#: shares of the score that an element must have so that its name does not count
_MOST, _ALL = 0.5, 0.9
#: characters outside it that are an article of their own
_SOME_TEXT = 250
#: before such a word they say that something else has or lacks one
_NOT_ITSELF = {"has", "with", "no", "without", "is", "not", "hide", "show", "js", "non"}
#: before "header" they say that it is the article's own
_ARTICLE = {"article", "post", "entry", "story", "content", "news", "blog", "text"}
_TOKEN = re.compile(
    r"""(?xs)
    <!--(?:>|->|.*?(?:--!?>|\Z))
    | <!\[CDATA\[(?P<raw>.*?)(?:\]\]>|\Z)
    | <[!?][^>]*+(?:>|\Z)
    | </(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)
    | <(?P<start>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>
    | <(?P<torn>[a-zA-Z][^\s/>]*+)(?P<tail>[^>]*+)(?:>|\Z)
    """
)
_ATTRIBUTE = re.compile(
    r"""(?xs)([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?"""
)
_PUNCTUATION = str.maketrans("", "", string.punctuation + "。，、；：？！…“”„«»¿¡·—–")
_CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}


@dataclass(eq=False)
class Element:
    tag: str
    path: int  # number of the path of block elements to it
    depth: int  # block elements on that path
    place: int  # number of the element in page order
    up: "Element | None"
    why: str = ""  # "tag" or "head" if the element is no part of an article
    named: int = 0  # _PART, _WHOLE or _FOREIGN if a name says so
    marked: "Mark | None" = None  # the elements so named that it is in, itself included
    heading: bool = False
    link: bool = False
    article: bool = False  # whether it is, or is in, an article or the main element
    post: "Element | None" = None  # the innermost article without such a name that it is or is in
    text: int = 0  # characters of content in it

    def line(self) -> Iterator["Element"]:
        at = self
        while at:
            yield at
            at = at.up


@dataclass(eq=False)
class Mark:
    """A named element, and the named one around it; with sums over the blocks in it."""

    element: Element
    around: "Mark | None"
    top: int  # place of the outermost element of these
    within: list["Mark"] = field(default_factory=list)
    value: float = 0.0  # score of all blocks in it
    inside: float = 0.0  # of those in an article in it
    # of the blocks that no named element in it holds: score, characters, whether in an article
    own: list = field(default_factory=lambda: [0.0, 0, False])


@dataclass
class Block:
    inside: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@functools.lru_cache(1 << 14)
def _named(bits: tuple[str, ...], post: bool, article: bool) -> int:
    """What the parts of a word say that is no article, or 0."""
    names = [b for b in (bits[0], bits[-1]) if _NAMES.match(b)]
    if not names or (len(bits) > 1 and bits[-1] in _STATES):
        return 0
    if bits[0] in _ABOUT and len(bits) > 1:
        rest = bits[1:]
        if post or not (_LAYOUT.match(rest[-1]) or all(_PARTS.match(b) for b in rest)):
            return 0
    plain = all(_NAMES.match(b) or _PARTS.match(b) for b in bits)
    foreign = any(_OTHERS.match(b) for b in names)
    if article:
        return _FOREIGN if plain and foreign else 0
    if not plain and all(_TOPICS.match(b) for b in names):
        return 0
    if foreign:
        return _FOREIGN
    return _PART if not plain and any(_LAYOUT.match(b) for b in names) else _WHOLE


def _purpose(tag: str, rest: str, up: Element) -> tuple[str, int]:
    """Why an element is no part of an article by its tag or role, and what its names say."""
    if tag in OUTSIDE:
        return "head" if tag == "header" and up.article else "tag", 0
    if not rest or tag in ("html", "body", "main"):
        return "", 0
    named, article = 0, tag == "article"
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), html.unescape("".join(values))
        if name == "role" and value.strip().lower() in ROLES:
            return "tag", 0
        if name in ("class", "id"):
            post = article or not _POST.isdisjoint(value.lower().split())
            for word in value.split():
                bits = re.sub("([a-z0-9])([A-Z])", r"\1-\2", word).lower()
                bits = [b for b in re.split("[-_:]+", bits) if b]
                if not bits or bits[0] in _NOT_ITSELF:
                    continue
                if not named and not article and bits[-1] == "header":
                    if bits[0] in _ARTICLE or up.article:
                        return "head", 0
                named = max(named, _named(tuple(bits), post, article))
    return "", named


def blocks(page: str) -> list[Block]:
    """The blocks of a page with text, in order; character references are decoded, white space
    is one blank."""
    root = Element("", 0, 0, 0, None)
    stack, out, at, count = [root], [Block(root)], 0, 0
    # paths by the path around them and a tag; open elements by tag, so that none is looked for in vain
    paths: dict[tuple[int, str], int] = {}
    opened: Counter[str] = Counter()

    def put(raw: str) -> None:
        if not raw:
            return
        block = out[-1]
        text = html.unescape(raw) if "&" in raw else raw
        block.parts.append(text)
        if opened["a"]:
            block.linked += len(text.strip())

    def close(upto: int) -> None:
        opened.subtract(e.tag for e in stack[upto:])
        del stack[upto:]

    def new_block() -> None:
        if out[-1].parts:
            out.append(Block(stack[-1]))
        else:
            out[-1] = Block(stack[-1])

    while True:
        found = _TOKEN.search(page, at)
        put(page[at : found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        if found["raw"] is not None:
            put(found["raw"])
            continue
        if found["end"]:
            tag = found["end"].lower()
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                # an inline end tag does not reach out of its block
                if tag not in BLOCKS and stack[i].tag in BLOCKS:
                    break
            if tag in BLOCKS or tag == "br":
                new_block()
            continue
        tag = (found["start"] or found["torn"] or "").lower()
        if not tag:
            continue
        rest = found["rest"] or found["tail"] or ""
        if tag in VOID:
            if tag in ("br", "hr"):
                new_block()
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            if end:
                at = page.find(">", at) + 1 or len(page)
            if tag in ("textarea", "iframe", "title", "xmp"):
                new_block()
            continue
        if tag in _CLOSED_BY:
            closes, scope = _CLOSED_BY[tag]
            for i in range(len(stack) - 1, 0, -1) if any(opened[t] for t in closes) else ():
                if stack[i].tag in scope:
                    break
                if stack[i].tag in closes:
                    close(i)
                    break
        elif tag in BLOCKS:
            for i in range(len(stack) - 1, 0, -1) if opened["p"] else ():
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in BLOCKS:
                    break
        if tag in ("main", "article"):
            # neither begins inside a menu, header or form that somebody forgot to close
            around = ("nav", "header", "form", "menu", "head")
            for i in range(1, len(stack)) if any(opened[t] for t in around) else ():
                if stack[i].tag in around:
                    close(i)
                    break
        up = stack[-1]
        count += 1
        path, depth = up.path, up.depth
        if tag in BLOCKS:
            path, depth = paths.setdefault((up.path, tag), len(paths) + 1), depth + 1
        own = Element(tag, path, depth, count, up)
        own.why, own.marked = up.why, up.marked
        if up.why != "tag":
            why, own.named = _purpose(tag, rest, up)
            own.why = why or up.why
        if tag == "main":  # the names spoke of the layout around it
            own.marked = None
        elif own.named:
            own.marked = Mark(own, up.marked, up.marked.top if up.marked else count)
        own.article = up.article or tag in ("article", "main")
        own.post = own if tag == "article" and not own.named else up.post
        own.heading = up.heading or tag in HEADINGS
        own.link = tag == "a"
        if not rest.endswith("/") or tag in BLOCKS:
            stack.append(own)
            opened[tag] += 1
        if tag in BLOCKS:
            new_block()
    kept = []
    for block in out:
        block.text = " ".join("".join(block.parts).split())
        if block.text:
            kept.append(block)
    return kept


def path_scores(found: list[Block]) -> np.ndarray:
    """The fused score of each block's path: mean text length and mean punctuation, both smoothed
    over neighbouring blocks, multiplied.  Text in links does not count."""
    sums: dict[int, list[float]] = {}
    for b in found:
        own = sums.setdefault(b.inside.path, [0.0, 0.0, 0.0])
        bare = len(b.text.translate(_PUNCTUATION))
        own[0] += max(0, len(b.text) - b.linked)
        own[1] += len(b.text) - bare if not b.linked else 0
        own[2] += 1
    ratios = np.array([[sums[b.inside.path][i] / sums[b.inside.path][2] for i in (0, 1)]
                       for b in found])
    kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    weight = np.convolve(np.ones(len(found)), kernel, "same")
    smooth = [np.convolve(ratios[:, i], kernel, "same")[: len(found)] / weight[: len(found)]
              for i in (0, 1)]
    fused = np.sqrt(ratios[:, 0] * smooth[0]) * np.sqrt((1 + ratios[:, 1]) * (1 + smooth[1]))
    return fused


def _marks(found: list[Block]) -> list[Mark]:
    """The marks that the blocks are in, each after those around it."""
    known: dict[int, Mark] = {}
    for b in found:
        mark = b.inside.marked
        while mark and mark.element.place not in known:
            known[mark.element.place] = mark
            mark = mark.around
    return [known[place] for place in sorted(known)]


def _wrongly_named(found: list[Block]) -> set[int]:
    """The places of elements that hold most of the score, so that their names don't count.

    Half of the score is enough for an element whose name may be its layout's, or that is around an
    article, if no article is left outside.  Others need nearly all, and little text outside; texts by
    others come back only where there is no other text.  Outer elements come first; names in them
    count on their own.
    """
    marks = _marks(found)
    if not marks:
        return set()
    scores = path_scores(found)
    free = [0.0, 0, False]
    for b, score in zip(found, scores):
        value, mark = score if b.linked * 2 < len(b.text) else 0.0, b.inside.marked
        own = mark.own if mark else free
        own[0] += value
        own[1] += len(b.text) - b.linked if value else 0
        own[2] = own[2] or (value > 0 and b.inside.article)
        if mark:
            mark.value += value
            post = b.inside.post
            if post and post.marked and post.place > mark.top:
                post.marked.inside += value
    for mark in reversed(marks):
        if mark.around:
            mark.around.within.append(mark)
            mark.around.value += mark.value
            mark.around.inside += mark.inside
    # the outermost marks whose names count
    outer, cleared = [mark for mark in marks if not mark.around], set()
    while True:
        for mark in sorted(outer, key=lambda m: (m.element.named, -m.value, m.element.place)):
            named, value = mark.element.named, mark.value
            around = named == _WHOLE and 2 * mark.inside > value
            if (named == _PART or around) and not free[2]:
                most = value > _MOST * (free[0] + value)
            else:
                most = value > _ALL * (free[0] + value) and free[1] < (_SOME_TEXT if named == _WHOLE else 1)
            if most:
                cleared.add(mark.element.place)
                outer.remove(mark)
                outer += mark.within
                free = [free[0] + mark.own[0], free[1] + mark.own[1], free[2] or mark.own[2]]
                break
        else:
            return cleared


def main_blocks(page: str | None) -> list[str]:
    """The texts of the blocks of a page's article, in page order."""
    found = blocks(page or "")
    found = [b for b in found if not b.inside.why or (b.inside.why == "head" and b.inside.heading)]
    cleared = _wrongly_named(found)
    counts: dict[int, bool] = {}  # whether a name counts that the element is in
    for mark in _marks(found):
        outside = mark.around and counts[mark.around.element.place]
        counts[mark.element.place] = bool(outside) or mark.element.place not in cleared
    usable = [b for b in found if not (b.inside.marked and counts[b.inside.marked.element.place])]
    if not usable:
        return []
    scores = path_scores(usable)
    limit = min(scores.std(), 0.5 * scores.max())
    content = [b for b, s in zip(usable, scores) if s >= limit and b.linked * 2 < len(b.text)]
    total = sum(len(b.text) for b in content)
    if not total:
        return []
    elements: dict[int, Element] = {}
    for b in content:
        b.inside.text += len(b.text)
        for e in itertools.takewhile(lambda e: e.place not in elements, b.inside.line()):
            elements[e.place] = e
    for place in sorted(elements, reverse=True):  # inner elements come after those around them
        if elements[place].up:
            elements[place].up.text += elements[place].text
    # the article with most of the content; else the innermost element with nearly all of it
    named = [e for e in elements.values() if e.tag in ("article", "main") and 2 * e.text >= total]
    if named:
        holder = min(named, key=lambda e: (-e.text, -e.depth))
        deeper = [e for e in named if e.tag == "article" and 10 * e.text >= 9 * holder.text]
        holder = max(deeper, key=lambda e: e.depth) if deeper else holder
    else:
        tags = (BLOCKS | {""}) - HEADINGS - {"p", "li", "td", "pre"}
        whole = [e for e in elements.values() if 10 * e.text >= 9 * total and e.tag in tags]
        holder = max(whole, key=lambda e: (e.depth, -e.place)) if whole else None
    loose = holder is None or holder.tag not in ("article", "main")
    lists = ("li", "div", "ul", "section", "td", "")
    out, held = [], {0: holder is None or holder.up is None}
    if holder is not None:
        held[holder.place] = True
    for b in usable:
        line = list(itertools.takewhile(lambda e: e.place not in held, b.inside.line()))
        around = line[-1].up if line else b.inside
        held |= dict.fromkeys((e.place for e in line), held[around.place])
        if not held[b.inside.place]:
            continue
        # without an element that is the article, lists of links are menus
        if loose and b.linked * 2 >= len(b.text) and b.inside.tag in lists:
            continue
        out.append(b.text)
    return out


def extract_main_text(pages: DataFrame, page: str = "html") -> DataFrame:
    """Adds ``main_text`` string, ``n_chars`` long (its code points) and ``n_blocks`` int.

    Blocks are joined by line feeds in page order.  Null and empty pages, and pages without an
    article, give the empty text.  Equal pages give equal texts.  An empty table gives an empty
    result.  Input columns named like the added ones are replaced.
    """
    pages = tidy(pages, [page], MADE)
    added = T.StructType.fromDDL("main_text string, n_chars long, n_blocks int")
    schema = T.StructType(pages.schema.fields + added.fields)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, page):
                found = [main_blocks(p) for p in piece[page].to_pylist()]
                texts = ["\n".join(x) for x in found]
                made = {
                    "main_text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    "n_blocks": pa.array([len(x) for x in found], pa.int32()),
                }
                yield pa.RecordBatch.from_pydict({c: piece[c] for c in piece.schema.names} | made)

    return pages.mapInArrow(extract, schema)
