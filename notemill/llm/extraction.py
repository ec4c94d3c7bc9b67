"""Main text of web pages by composite text density.

Every DOM node gets its characters per tag, adjusted for links (the composite
text density of Sun, Song and Liao): text that is mostly link text scores low,
long plain text high. Each node also gets the sum of its children's densities;
the node of the largest sum below the body is where the article lies. The
smallest density on the way from there up to the body is the threshold: every
node at or above it gives its own subtree of largest sum as content.

Before any counting, subtrees that are no article by what they are go: scripts,
styles, menus, page headers, footers, sidebars, forms, adverts, notices and
reader comments, told by tag, role or the words of class and id. A subtree
that holds an ``article``, ``main`` or ``h1`` is never dropped for its name.

A page is one value and is read in time linear in its length; pages are
independent, so the operator is one pass without a shuffle.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill.llm.common import map_batches

# Fixed values of HTML: elements by how they are parsed and laid out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main "
    "menu nav ol p pre search section summary table ul".split()
)
#: A start tag closes an open element of these names, up to the names after it.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])), "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "thead": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])), "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])), "body": (frozenset(["head"]), frozenset(["html"])),
    "a": (frozenset(["a"]), frozenset(["td", "th", "table"])),
}
IN_HEAD = frozenset("base link meta title style script noscript template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_P_AT = frozenset(["td", "th", "table", "button", "caption", "object", "body", "html"])

#: Elements that are never part of an article.
NOISE_TAGS = frozenset(
    "head script style noscript template nav footer aside form button select textarea input iframe object embed canvas svg dialog menu noembed noframes "
    "audio video map datalist title".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tooltip".split())
#: Words of class and id names that mark what surrounds an article.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors promo promos promotion banner banners "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager toolbar topbar masthead sidebar sidebars aside rail footer footers "
    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay paywall newsletter subscribe subscription signup login signin "
    "share sharing social related recommended recommendations outbrain taboola skip".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
SITE_HEADER = re.compile(r"(?:site|page|global|main|top|blog)[-_]?header|^header$", re.IGNORECASE)
#: Names of a heading over reader comments, in the languages of the pages.
COMMENT_HEADING = re.compile(
    r"(?:\d+\s+)?(?:(?:reader|user|visitor)\s+)?(?:comments?|responses?|replies|leave a (?:comment|reply)|kommentare?|leserkommentare|commentaires?|comentarios?)(?:\s*[(:\d].*)?",
    re.IGNORECASE,
)

TOKEN = re.compile(
    r"<!--(?:(?!-?>).*?(?:--!?>|\Z)|-?>)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)"
    r"|<(?:[!?]|/[^a-zA-Z])[^>]*+(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """A parsed page: nodes in document order, node 0 the root, and pieces of text with the node they lie in."""

    tags: list[str] = field(default_factory=lambda: ["#root"])
    parents: list[int] = field(default_factory=lambda: [-1])
    attrs: list[str] = field(default_factory=lambda: [""])
    #: (node, text or None): None is the border of a block.
    pieces: list[tuple[int, str | None]] = field(default_factory=list)


def parse(source: str) -> Page:
    """The DOM of a page: implied end tags, raw text and stray tags as browsers treat them, in linear time."""
    page, stack, at = Page(), [0], 0
    open_count: dict[str, int] = {}
    pieces = page.pieces

    def leave(depth: int) -> None:
        while len(stack) > depth:
            tag = page.tags[stack.pop()]
            open_count[tag] -= 1
            if tag not in INLINE:
                pieces.append((stack[-1], None))

    def close(names: frozenset[str], stop: frozenset[str]) -> None:
        if any(open_count.get(n) for n in names):
            for depth in range(len(stack) - 1, 0, -1):
                tag = page.tags[stack[depth]]
                if tag in names:
                    return leave(depth)
                if tag in stop:
                    return None
        return None

    def text(value: str) -> None:
        if value:
            if open_count.get("head") and not value.isspace():
                close(frozenset(["head"]), frozenset())
            pieces.append((stack[-1], html.unescape(value) if "&" in value else value))

    while True:
        found = TOKEN.search(source, at)
        text(source[at:found.start()] if found else source[at:])
        if not found:
            break
        at = found.end()
        tag = found.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if found.group("end"):
            if tag in ("body", "html"):  # what follows still belongs to the body
                pieces.append((stack[-1], None))
                continue
            if tag in ("p", "br") and not open_count.get(tag):
                pieces.append((stack[-1], None))
            elif open_count.get(tag):
                for depth in range(len(stack) - 1, 0, -1):
                    own = page.tags[stack[depth]]
                    if own == tag:
                        leave(depth)
                        break
                    if tag in INLINE and own not in INLINE:
                        break
            continue
        if tag in ("body", "html") and open_count.get(tag):
            continue
        if open_count.get("head") and tag not in IN_HEAD:
            close(frozenset(["head"]), frozenset())
        if tag in HEADINGS:
            close(HEADINGS, ENDS_P - HEADINGS)
        if tag in ENDS_P:
            close(frozenset(["p"]), ENDS_P_AT)
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag not in INLINE:
            pieces.append((stack[-1], None))
        node = len(page.tags)
        page.tags.append(tag)
        page.parents.append(stack[-1])
        page.attrs.append(found.group("attrs"))
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(source, at)
            stop = end.start() if end else len(source)
            if tag in ("textarea", "title"):
                pieces.append((node, html.unescape(source[at:stop])))
            after = source.find(">", stop)
            at = after + 1 if after >= 0 else len(source)
            continue
        stack.append(node)
        open_count[tag] = open_count.get(tag, 0) + 1
    return page


def _attributes(raw: str) -> dict[str, str]:
    return {m.group(1).lower(): html.unescape(m.group(2) or m.group(3) or m.group(4) or "") for m in ATTRIBUTE.finditer(raw)}


def _named_noise(attrs: dict[str, str], most_text: bool) -> bool:
    """Whether role, class or id say that the element is no article.

    A name like ``has-sidebar`` on the element that holds most of the page's
    text tells of its layout; there only the words for comments count.
    """
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    words = {w.lower() for n in names for w in NAME_WORD.findall(n)}
    if words & COMMENT_WORDS:
        return True
    if "hidden" in attrs or re.search(r"display\s*:\s*none", attrs.get("style", ""), re.IGNORECASE):
        return True
    if NOISE_ROLES & set(attrs.get("role", "").lower().split()) or attrs.get("aria-hidden", "").lower() == "true":
        return True
    return not most_text and (bool(words & NOISE_WORDS) or any(SITE_HEADER.search(n) for n in names))


def kept_nodes(page: Page) -> list[bool]:
    """Which nodes may belong to an article."""
    size = len(page.tags)
    holds_article = [t in ("article", "main", "h1", "body", "html") for t in page.tags]
    inside_article = [False] * size
    for node in range(1, size):
        parent = page.parents[node]
        inside_article[node] = inside_article[parent] or page.tags[parent] in ("article", "main")
    for node in range(size - 1, 0, -1):
        holds_article[page.parents[node]] |= holds_article[node]
    keep = [True] * size
    under_comments = _comment_sections(page)
    text = [0] * size
    for node, piece in page.pieces:
        if piece and page.tags[node] not in RAW:
            text[node] += sum(map(len, piece.split()))
    for node in range(size - 1, 0, -1):
        text[page.parents[node]] += text[node]
    for node in range(1, size):
        tag = page.tags[node]
        keep[node] = keep[page.parents[node]] and tag not in NOISE_TAGS
        if not keep[node]:
            continue
        if tag == "header" and not inside_article[node]:
            keep[node] = False
        elif not holds_article[node]:
            raw = page.attrs[node]
            named = bool(raw.strip(" /")) and _named_noise(_attributes(raw), 2 * text[node] > text[0])
            keep[node] = not named and node not in under_comments
    return keep


def _comment_sections(page: Page) -> set[int]:
    """Containers whose first text is a heading over reader comments."""
    found: set[int] = set()
    text: dict[int, str] = {}
    for node, piece in page.pieces:
        if piece and page.tags[node] in HEADINGS:
            text[node] = text.get(node, "") + piece
    seen: set[int] = set()
    for node, piece in page.pieces:
        if not piece or piece.isspace():
            continue
        above = page.parents[node]
        # Only the first text of a container counts; a container is left once any text was seen in it.
        comment = node in text and COMMENT_HEADING.fullmatch(" ".join(text[node].split())) is not None
        if comment and above > 0 and above not in seen and page.tags[above] in ("section", "div", "ol", "ul"):
            found.add(above)
        walk = node
        while walk > 0 and walk not in seen:
            seen.add(walk)
            walk = page.parents[walk]
    return found


@dataclass
class Densities:
    """Per node: characters, composite density, sum of its children's densities."""

    chars: list[int]
    density: list[float]
    sums: list[float]


def densities(page: Page, keep: list[bool], body: int) -> Densities:
    """Composite text density of every kept node; the rest counts as not there."""
    size = len(page.tags)
    chars, link_chars, tags, link_tags = [0] * size, [0] * size, [0] * size, [0] * size
    linked = [False] * size
    for node in range(1, size):
        linked[node] = linked[page.parents[node]] or page.tags[node] == "a"
    for node, piece in page.pieces:
        if piece and keep[node]:
            count = sum(map(len, piece.split()))
            chars[node] += count
            if linked[node]:
                link_chars[node] += count
    for node in range(size - 1, 0, -1):
        if not keep[node]:
            continue
        parent = page.parents[node]
        chars[parent] += chars[node]
        link_chars[parent] += link_chars[node]
        tags[parent] += tags[node] + 1
        link_tags[parent] += link_tags[node] + linked[node]
    ratio = link_chars[body] / (chars[body] or 1)
    density, sums = [0.0] * size, [0.0] * size
    for node in range(size - 1, -1, -1):
        count = chars[node]
        if keep[node] and count:
            links, plain = link_chars[node] or 1, count - link_chars[node] or 1
            tag_count, link_tag_count = tags[node] or 1, link_tags[node] or 1
            base = math.log(math.log(count / plain * links + ratio * count + math.e))
            density[node] = count / tag_count * math.log(count / links * tag_count / link_tag_count) / base
        if node and keep[node]:
            sums[page.parents[node]] += density[node]
    return Densities(chars, density, sums)


def _best_below(page: Page, found: Densities, keep: list[bool]) -> list[int]:
    """For every node, the node of largest sum in its subtree; the outermost and first of equal ones."""
    best = list(range(len(page.tags)))
    for node in range(len(page.tags) - 1, 0, -1):
        parent = page.parents[node]
        if keep[node] and (found.sums[best[node]], -best[node]) > (found.sums[best[parent]], -best[parent]):
            best[parent] = best[node]
    return best


def content_nodes(page: Page) -> tuple[list[bool], list[bool]]:
    """(kept, content): which nodes survive, and which belong to the main text."""
    keep = kept_nodes(page)
    size = len(page.tags)
    body = next((i for i, t in enumerate(page.tags) if t == "body"), 0)
    found = densities(page, keep, body)
    content = [False] * size
    if not found.chars[body]:
        return keep, content
    best = _best_below(page, found, keep)
    top = best[body]
    if not found.sums[top]:  # text lies in the body alone
        top = body
    threshold, walk = found.density[top], top
    while walk != body:
        walk = page.parents[walk]
        threshold = min(threshold, found.density[walk])
    inside = [False] * size
    inside[body] = True
    for node in range(body + 1, size):
        inside[node] = inside[page.parents[node]]
    for node in range(body, size):
        if inside[node] and keep[node] and found.chars[node] and found.density[node] >= threshold:
            content[best[node] if found.sums[best[node]] else node] = True
    content[top] = True
    above, walk = [], top
    while walk >= 0:
        above.append(walk)
        walk = page.parents[walk]
    # Where the text lies in an article (or main) element, content is looked for in such elements alone; an article is whole.
    within = next((name for name in ("article", "main") if any(page.tags[i] == name for i in above)), None)
    if within:
        owner = [-1] * size
        for node in range(1, size):
            owner[node] = node if page.tags[node] == within else owner[page.parents[node]]
        marked = [node for node in range(size) if content[node] and owner[node] >= 0]
        content = [False] * size
        for node in marked:
            content[owner[node] if within == "article" else node] = True
    # The heading may stand beside the text instead of in it.
    above = set(above)
    for node in range(body + 1, top):
        if page.tags[node] == "h1" and keep[node]:
            parent = page.parents[node]
            while parent not in above and found.chars[parent] == found.chars[node]:
                parent = page.parents[parent]
            if parent in above:
                content[node] = True
    for node in range(1, size):
        content[node] = keep[node] and (content[node] or content[page.parents[node]])
    return keep, content


def main_text(source: str | None) -> str:
    """The main text of a page; empty for NULL, empty and textless pages."""
    if not source:
        return ""
    page = parse(source.replace("\x00", ""))
    keep, content = content_nodes(page)
    parts = []
    for node, piece in page.pieces:
        if piece is None:
            parts.append(" ")
        elif content[node]:
            parts.append(piece)
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    NULL and empty html, and pages without text, give an empty text. Markup of
    any length is read whole. Repeated rows and NULL ids are rows of their own;
    an empty table gives an empty table. Other columns are left out.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))

    def run(batch: pa.RecordBatch) -> dict:
        texts = [main_text(t) for t in batch.column(2).to_pylist()]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    return map_batches(rows, run, "page_id bigint, url string, text string, n_chars bigint")
