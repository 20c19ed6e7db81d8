"""Main text of HTML pages by scoring the element tree.

Each page becomes a list of elements in page order; an element's subtree is a
range of that list. Paragraphs score points for their length and commas and
pass them to their ancestors, the nearer the more; a container's points are
discounted by the share of its text that stands in links. The best container,
and siblings that score like it or aren't mostly links, are kept; the blocks of
their text are joined in page order. Elements that never belong to an article
are left out before. A page on which nothing scores gives all other text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructType

#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't markup.
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never part of the article.
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg canvas nav footer header aside form button select "
    "textarea input fieldset dialog menu map audio video title xmp noembed noframes datalist".split()
)
PARAGRAPHS = frozenset(["p", "pre", "td", "blockquote"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that don't count as paragraphs where text stands in them directly; all others do.
LABELS = HEADINGS | frozenset("dt th caption figcaption legend summary option".split())
#: Elements that a new element of this kind ends.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr"}, "tbody": {"tr", "thead"}, "tfoot": {"tr", "tbody"},
}
#: Beyond these an implied end isn't looked for.
BARRIERS = frozenset("ul ol dl table select article section div body html td th".split())
ARTICLES = frozenset(["article", "main"])
#: First or last words of a class or id that say what an element is, and that it isn't the article: no matter how long it is.
OTHER_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsors sponsored sidebar sidebars comment comments commentlist "
    "disqus reply replies respond cookie cookies consent gdpr notice notices notification notifications menu menus nav navbar navigation "
    "footer masthead breadcrumb breadcrumbs".split()
)
#: Those that an article's own container may have as well: out only where the page's best paragraphs stand elsewhere.
DOUBTFUL = frozenset(
    "header promo promoted share sharing social related recommended popup modal newsletter subscribe widget widgets login signup search "
    "toolbar pagination pager skip copyright".split()
)
#: Before such a word these make it a remark on the layout: has-sidebar, content-with-sidebar.
LAYOUT = frozenset("has have no not with without show hide".split())
#: With these a header is the article's own.
OWN_HEADER = frozenset("article content entry post story".split())
#: Words in an element's class or id that speak for it.
CONTENT = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text)(?:[\s_-]|$)", re.I)

#: Ancestors that a paragraph passes points to, and the divisor at each step.
SHARES = (1.0, 2.0, 6.0, 9.0, 12.0)
#: A sibling of the best container is kept from this part of its score on.
SIBLING_SHARE = 0.2
SIBLING_LEAST = 10.0
#: Any other sibling with text is kept, unless more than this part of it stands in links.
SIBLING_LINKS = 0.25

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAIL = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
OWN_NAMES = re.compile(r"(?:^|\s)(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


NEVER_DOUBTED = frozenset(["html", "body"]) | ARTICLES | HEADINGS


def _doubt(names: str) -> int:
    """How much an element's names speak against it; of a compound name the first and the last word count."""
    worst = 0
    for name in names.lower().split():
        words = re.split(r"[-_]+", name)
        for word in (words[0], words[-1]):
            level = 2 if word in OTHER_PARTS else 1 if word in DOUBTFUL else 0
            before = words[: words.index(word)]
            if level and not LAYOUT.intersection(before) and not (word == "header" and OWN_HEADER.intersection(before)):
                worst = max(worst, level)
    return worst


@dataclass
class Tree:
    """Elements in page order; ``end`` is one past the last element inside."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    #: 2 for an element named like OTHER_PARTS, 1 like DOUBTFUL, else 0.
    doubted: list[int] = field(default_factory=list)
    dropped: list[bool] = field(default_factory=list)
    #: (element, text) and, with None for the text, the places where a block starts or ends.
    flow: list[tuple[int, str | None]] = field(default_factory=list)


def parse(page: str) -> Tree:
    """Reads any text as HTML: unclosed, misnested and cut-off markup included."""
    t = Tree()
    stack: list[int] = []
    open_: dict[str, int] = {}

    def push(tag: str, names: str) -> int:
        i = len(t.tag)
        up = stack[-1] if stack else -1
        t.tag.append(tag)
        t.parent.append(up)
        t.end.append(i + 1)
        t.names.append(names)
        t.doubted.append(_doubt(names) if names and tag not in NEVER_DOUBTED else 0)
        # an article's own header holds its title
        out = tag in DROPPED and not (tag == "header" and open_.get("article"))
        t.dropped.append(out or (up >= 0 and t.dropped[up]))
        if tag in BLOCKS:
            t.flow.append((i, None))
        return i

    def pop() -> None:
        i = stack.pop()
        open_[t.tag[i]] -= 1
        t.end[i] = len(t.tag)
        if t.tag[i] in BLOCKS:
            t.flow.append((i, None))

    def pop_to(tags) -> None:
        """Ends the nearest of these elements, unless a barrier stands before it."""
        for k in range(len(stack) - 1, -1, -1):
            tag = t.tag[stack[k]]
            if tag in tags:
                while len(stack) > k:
                    pop()
                return
            if tag in BARRIERS:
                return

    push("html", "")
    stack.append(0)
    open_["html"] = 1
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            t.flow.append((stack[-1], page[at:lt]))
        if lt == n:
            break
        after = page[lt + 1 : lt + 2]
        if after in ("!", "?"):
            if page.startswith("<!--", lt):
                close = page.find("-->", lt + 4)
                at = n if close < 0 else close + 3
            else:
                close = page.find(">", lt)
                at = n if close < 0 else close + 1
            continue
        ending = after == "/"
        name = NAME.match(page, lt + 1 + ending)
        if not name:
            if ending and page[lt + 2 : lt + 3]:  # a comment, as browsers read it
                close = page.find(">", lt)
                at = n if close < 0 else close + 1
            else:
                t.flow.append((stack[-1], "<"))
                at = lt + 1
            continue
        tail = TAIL.match(page, name.end())
        close = tail.end() if tail else page.find(">", name.end()) + 1
        if not close:
            break  # the page ends inside a tag
        tag, attributes = name.group().lower(), page[name.end() : close - 1]
        at = close
        if ending:
            if tag == "p" and not open_.get("p"):
                continue
            if open_.get(tag) and tag not in ("html", "body"):
                while t.tag[stack[-1]] != tag:
                    pop()
                pop()
            continue
        if tag in ("html", "body") and open_.get(tag):
            continue
        if tag in BLOCKS and open_.get("p"):
            for k in range(len(stack) - 1, -1, -1):
                if t.tag[stack[k]] == "p":
                    while len(stack) > k:
                        pop()
                    break
                if t.tag[stack[k]] in BLOCKS:
                    break
        if tag in CLOSES:
            pop_to(CLOSES[tag])
        names = " ".join(filter(None, (x for m in OWN_NAMES.findall(attributes) for x in m))) if attributes else ""
        i = push(tag, names)
        if tag in VOID:
            if tag == "br":
                t.flow.append((i, " "))
            continue
        if tag in RAW:
            found = re.compile(f"</{tag}[\\s/>]", re.I).search(page, at)
            if not found:
                break  # the rest of the page is its content
            close = page.find(">", found.start())
            at = n if close < 0 else close + 1
            continue
        if not attributes.endswith("/") or tag in BLOCKS:
            stack.append(i)
            open_[tag] = open_.get(tag, 0) + 1
    while stack:
        pop()
    if any(t.doubted):
        _drop_doubted(t)
    return t


def _drop_doubted(t: Tree) -> None:
    """Leaves out the elements whose names say that they are another part of the page.

    A doubtful one stays if it holds the container with the best paragraphs.
    One named like another part stays if no paragraph stands outside such
    parts, or if it is a frame around the page: with the best paragraphs and
    the page's main element or title inside.
    """
    n = len(t.tag)
    mass = _own_points(t)
    frames = [i for i in range(n) if t.tag[i] in ("main", "h1") and not t.dropped[i]]

    def best(without: list[bool]) -> int:
        return max((i for i in mass if not without[i]), key=lambda i: (mass[i], -i), default=-1)

    at = best(t.dropped)
    if at < 0:
        return

    def spread(out: list[bool]) -> list[bool]:
        for i in range(1, n):
            out[i] = out[i] or out[t.parent[i]]
        return out

    def frame(i: int) -> bool:
        return i <= at < t.end[i] and any(i < f < t.end[i] for f in frames)

    out = spread([t.dropped[i] or (t.doubted[i] == 2 and not frame(i)) for i in range(n)])
    inner = best(out)
    if inner < 0:
        out, inner = list(t.dropped), at
    t.dropped = spread([out[i] or (t.doubted[i] == 1 and not i <= inner < t.end[i]) for i in range(n)])


def _own_points(t: Tree) -> dict[int, float]:
    """Points that containers get from paragraphs right below them, less those for text in links."""
    n = len(t.tag)
    length, link, commas = [0] * n, [0] * n, [0] * n
    for i, text in t.flow:
        if text and not t.dropped[i]:
            length[i] += len(text.strip())
            commas[i] += text.count(",")
    for i in range(n - 1, 0, -1):
        if t.tag[i] == "a":
            link[i] = length[i]
        if t.tag[i] not in BLOCKS:
            p = t.parent[i]
            length[p] += length[i]
            link[p] += link[i]
            commas[p] += commas[i]
    mass: dict[int, float] = {}
    for i in range(n):
        if t.tag[i] in BLOCKS and t.tag[i] not in LABELS and length[i] and not t.dropped[i]:
            holder = max(t.parent[i], 0) if t.tag[i] in PARAGRAPHS else i
            mass[holder] = mass.get(holder, 0.0) + (commas[i] + length[i] / 100) * (1 - link[i] / length[i])
    return mass


def _scores(t: Tree) -> tuple[dict[int, float], list[int], list[int]]:
    """Points of every container, discounted by its share of links, and every element's text and text in links."""
    n = len(t.tag)
    length, link, commas = [0] * n, [0] * n, [0] * n
    own, own_commas = [0] * n, [0] * n
    in_link = [False] * n
    for i in range(n):
        in_link[i] = t.tag[i] == "a" or (t.parent[i] >= 0 and in_link[t.parent[i]])
    for i, text in t.flow:
        if text and not t.dropped[i]:
            size = len(text.strip())
            length[i] += size
            commas[i] += text.count(",")
            if in_link[i]:
                link[i] += size
            else:
                own[i] += size
                own_commas[i] += text.count(",")
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = t.parent[i]
        if t.tag[i] not in BLOCKS:  # inline text is its block's own
            own[p] += own[i]
            own_commas[p] += own_commas[i]
        length[p] += length[i]
        link[p] += link[i]
        commas[p] += commas[i]
    points: dict[int, float] = {}
    for i in range(n):
        if t.dropped[i] or not length[i]:
            continue
        if t.tag[i] in PARAGRAPHS:
            worth = 1 + commas[i] + min(length[i] / 100, 3.0)
        elif t.tag[i] in BLOCKS and t.tag[i] not in LABELS and own[i]:
            worth = 1 + own_commas[i] + min(own[i] / 100, 3.0)
        else:
            continue
        up = t.parent[i]
        for share in SHARES:
            if up < 0:
                break
            if up not in points:
                points[up] = (
                    (25.0 if t.tag[up] in ARTICLES else 5.0 if t.tag[up] in ("div", "section") else 0.0)
                    + (25.0 if CONTENT.search(t.names[up]) else 0.0)
                    - (25.0 if t.doubted[up] else 0.0)
                )
            points[up] += worth / share
            up = t.parent[up]
    return {i: s * (1 - link[i] / length[i]) for i, s in points.items() if length[i] and not t.dropped[i]}, length, link


def _without(t: Tree, i: int, gone: list[int]) -> list[tuple[int, int]]:
    """The range of an element less those of some elements in it."""
    out, at = [], i
    for g in sorted(gone):
        if g >= at:
            out.append((at, g))
            at = t.end[g]
    return [*out, (at, t.end[i])]


def _kept(t: Tree) -> list[tuple[int, int]]:
    """Ranges of elements whose text is the article."""
    scores, length, link = _scores(t)
    whole = [i for i in range(len(t.tag)) if t.tag[i] in ARTICLES and not t.dropped[i]]
    if not scores:
        return [(i, t.end[i]) for i in whole[:1] or [0]]
    best = inner = max(scores, key=lambda i: (scores[i], -i))
    up = best
    while up >= 0:  # sections of one article belong together
        if t.tag[up] in ARTICLES:
            best = up
        up = t.parent[up]
    if t.tag[best] in ARTICLES:  # these say themselves what belongs to them; other articles in it are other stories
        if t.tag[best] == "main":
            held = [i for i in whole if best < i < t.end[best] and t.tag[i] == "article"]
            # without one around the best paragraphs, the first of those that score best
            own = [i for i in held if i <= inner < t.end[i]] or sorted(held, key=lambda i: (-scores.get(i, 0.0), i))[:1]
            return _without(t, best, [i for i in held if not any(i == o or o < i < t.end[o] or i < o < t.end[i] for o in own)])
        return [(best, t.end[best])]
    if t.parent[best] < 0 or t.tag[best] == "body":
        return [(best, t.end[best])]
    least = max(SIBLING_LEAST, SIBLING_SHARE * scores.get(best, 0.0))
    p = t.parent[best]
    children = []
    i = p + 1
    while i < t.end[p]:
        children.append(i)
        i = t.end[i]
    loose = sum(len(text.strip()) for i, text in t.flow if i == p and text)
    inline = [i for i in children if t.tag[i] not in BLOCKS and not t.dropped[i]]
    run, run_links = loose + sum(length[i] for i in inline), sum(link[i] for i in inline)
    out = []
    if run and run_links <= SIBLING_LINKS * run:  # text that stands between the siblings
        out += [(p, p + 1), *((i, t.end[i]) for i in inline)]
    for i in children:
        if i == best or (not t.dropped[i] and scores.get(i, 0.0) >= least):
            out.append((i, t.end[i]))
        elif not t.dropped[i] and not t.doubted[i] and t.tag[i] in BLOCKS and length[i]:
            if t.tag[i] == "h1" or link[i] <= SIBLING_LINKS * length[i]:
                out.append((i, t.end[i]))
    return out


def main_text(page: str | None) -> str:
    """The article's blocks, one a line; empty for a null or empty page or one without an article.

    Character references are decoded, white space inside a block becomes one
    space, and blocks without text are left out. Nothing is cut off.
    """
    if not page:
        return ""
    t = parse(page)
    ranges = _kept(t)
    blocks, run = [], []

    def flush():
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            blocks.append(text)
        run.clear()

    inside = bytearray(len(t.tag))
    for a, b in ranges:
        inside[a:b] = b"\x01" * (b - a)
    for i, text in t.flow:
        if not inside[i] or t.dropped[i]:
            if text is None and run:
                flush()
        elif text is None:
            flush()
        else:
            run.append(text)
    flush()
    return "\n".join(blocks)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per page: the columns of ``keep``, text and n_chars.

    Repeated rows stay; an empty table gives none; other columns aren't read.
    """
    rows = pages.select(*keep, html_col)

    def run(batches):
        for batch in batches:
            texts = [main_text(p) for p in batch.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    schema = StructType([*pages.select(*keep).schema.fields]).add("text", StringType()).add("n_chars", LongType())
    return rows.mapInArrow(run, schema)
