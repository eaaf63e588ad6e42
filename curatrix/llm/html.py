"""HTML extraction by tag-path ratios.

Each text node belongs to a root-to-leaf tag path, inside and outside articles. Over the
nodes of a path, text length (without link texts) and punctuation are summed; a path's
ratios are its length a node, and its punctuation a node. Both are smoothed: half of the
path's own, half of all paths of its container, so a short heading or paragraph between
long ones is not judged alone. They are fused as their geometric mean, weighed by what the
path's tags, classes and ids say of its role, and held against a share of the page's best
path. Where a page has an article element, one more weight is the share of the page's text
on the path's side of it, inside or outside, so that an element which holds a teaser only
does not outweigh the story beside it. Text of paths above the threshold is kept block by
block, in page order.

Roles: elements that never hold an article (menus, footers, forms, ...), and elements one
of whose class, id or role tokens consists of such words, weigh nothing. A token that such
a word is only a part of (``login-guide``) is a hint: its path needs ratios three times
as high.

The scanner looks at each character a few times at most, whatever is left unclosed. A page
is one row and is worked on alone; nothing is shuffled.
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without end tags (fixed values of the HTML standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
#: Elements of phrasing content: they neither break blocks nor name paths.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that an opening block ends, if they are open (p), and elements ended by one of their own kind.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th")}
SCOPE = frozenset("article aside body div footer form header main nav ol section table td th ul".split())
#: Elements whose text is never an article's.
BOILERPLATE = frozenset("head nav header footer aside form button select dialog menu svg canvas object audio video script style noscript template iframe".split())
#: Words in classes, ids and roles that name boilerplate.
WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "pagination popup promo promoted related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget complementary contentinfo alert skip".split()
)
#: Elements that hold a page's article.
HOLDERS = ("article", "main")
#: What a path weighs whose tokens only hint at boilerplate.
HINT = 0.33
#: How much of a path's smoothed ratios is its container's.
SMOOTH = 0.5
#: Share of the best path's score that a path needs.
THRESHOLD = 0.08
#: Elements that a path names; deeper ones are open and weigh like others, but share the path of the last that is named.
DEPTH = 512
#: What text outside holders weighs on pages that have them.
OUTSIDE = 0.25

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_ROLE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？；：、|]")


def tags(page: str):
    """The page's tags in order, as (start, end, name, is an end tag, attributes); comments, declarations and raw elements have no name."""
    last, at = page.rfind(">"), page.find("<")
    unclosed = {'"': len(page), "'": len(page)}  # from where a quote has no partner
    while 0 <= at < last:
        start = at
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            yield start, end, "", False, ""
        elif page[at + 1] in "!?":
            end = page.index(">", at) + 1
            yield start, end, "", False, ""
        elif m := _NAME.match(page, at + (2 if page[at + 1] == "/" else 1)):
            name, end = m[0].lower(), m.end()
            while stop := _STOP.search(page, end):
                if stop[0] == ">":
                    break
                partner = page.find(stop[0], stop.end()) if stop.start() < unclosed[stop[0]] else -1
                if partner < 0:
                    unclosed[stop[0]] = min(unclosed[stop[0]], stop.start())
                    stop = None
                    break
                end = partner + 1
            close = stop.start() if stop else page.find(">", m.end())
            end, closing = close + 1, page[at + 1] == "/"
            attributes = page[m.end() : close]
            if name in _RAW_END and not closing:
                found = _RAW_END[name].search(page, end)
                end, name = found.end() if found else len(page), ""
            yield start, end, name, closing, attributes
        else:
            end = at + 1
        at = page.find("<", end)


def role_weight(tag: str, attrs: str, holder_above: bool) -> float:
    """What an element's text weighs by its tag and its class, id and role words: 0, ``HINT`` or 1."""
    if tag in BOILERPLATE and not (tag == "header" and holder_above):
        return 0.0
    if tag in ("body", "html", *HOLDERS) or not attrs:
        return 1.0
    if _HIDDEN.search(attrs):
        return 0.0
    weight = 1.0
    for value in _ROLE.findall(attrs):
        for token in value.lower().strip("\"'").split():
            words = [w for w in _SPLIT.split(token) if w]
            n = sum(w in WORDS for w in words)
            if n and n == len(words):
                return 0.0
            if n:
                weight = HINT
    return weight


def text_blocks(page: str) -> list[tuple[str, str, int, float, int, str]]:
    """The page's blocks in order: tag path, its container's, number of the article around it (0: none), weight, characters outside links, text."""
    out: list[tuple[str, str, int, float, int, str]] = []
    stack: list[tuple[str, str, float, int]] = [("", "", 1.0, 0)]  # tag, path, weight, number of the article or main around it
    places: dict[str, list[int]] = defaultdict(list)  # of each tag's open elements in the stack
    scopes = [0]  # places of those that others do not close
    pieces: list[tuple[bool, str]] = []
    holders, at, links = 0, 0, 0

    def close_to(k: int) -> None:
        while len(stack) > k:
            places[stack.pop()[0]].pop()
            if scopes[-1] == len(stack):
                scopes.pop()

    def flush() -> None:
        if pieces:
            text = " ".join(_html.unescape("".join(x for _, x in pieces)).split())
            if text:
                own = text if not any(linked for linked, _ in pieces) else " ".join(_html.unescape("".join(x for linked, x in pieces if not linked)).split())
                _, path, weight, holder = stack[-1]
                out.append((f"{path}|{weight}", stack[-2][1] if len(stack) > 1 else "", holder, weight, len(own), text))
            pieces.clear()

    for start, end, tag, closing, attrs in tags(page):
        if start > at:
            pieces.append((links > 0, page[at:start]))
        at = end
        if not tag:
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag in INLINE and not (tag not in VOID and attrs and role_weight(tag, attrs, True) == 0):
            if tag == "br":
                pieces.append((False, " "))
            if not closing or not places[tag]:
                continue
        flush()
        if closing:
            if places[tag] and (tag in SCOPE or places[tag][-1] > scopes[-1]):
                close_to(places[tag][-1])
            continue
        if tag in VOID:
            continue
        closes = OWN_KIND.get(tag, ()) + (("p",) if tag in ENDS_P else ())
        while closes and (k := max((places[x][-1] for x in closes if places[x]), default=0)) and k >= scopes[-1]:
            close_to(k)
        _, path, above, holder = stack[-1]
        weight = min(above, role_weight(tag, attrs, bool(holder)))
        if tag in HOLDERS and weight:
            holders += 1
            holder = holder or holders
        if not (attrs.rstrip().endswith("/") and tag in ("svg", "path")):
            places[tag].append(len(stack))
            if tag in SCOPE:
                scopes.append(len(stack))
            stack.append((tag, f"{path}/{tag}" if len(stack) < DEPTH else path, weight, holder))
    pieces.append((links > 0, page[at:]))
    flush()
    return out


def path_scores(blocks: list[tuple[str, str, int, float, int, str]]) -> list[float]:
    """Each block's score: its path's smoothed and fused ratios, weighed."""
    by_path: dict[tuple, list[float]] = defaultdict(lambda: [0, 0, 0])
    by_container: dict[tuple, list[float]] = defaultdict(lambda: [0, 0, 0])
    sides = [0, 0]  # characters outside and inside holders
    keys = []
    for path, container, holder, weight, n, text in blocks:
        key = (path, holder), ("", holder) if holder else (container, 0), weight  # all paths of an article smooth each other
        keys.append(key)
        if not weight:
            continue
        sides[bool(holder)] += len(text)
        for sums in (by_path[key[0]], by_container[key[1]]):
            sums[0] += n
            sums[1] += len(_PUNCTUATION.findall(text)) + 1
            sums[2] += 1
    share = sides[1] / (sum(sides) or 1)
    weights = (OUTSIDE * (1 - share) ** 2, share**2) if share else (1.0, 1.0)
    scores: dict[tuple, float] = {}
    for key in keys:
        if key not in scores:
            path, container, weight = key
            own, around = by_path[path], by_container[container]
            if not weight or not own[0] and own[2] > 1:  # several nodes of nothing but links are a menu, whatever is around
                scores[key] = 0.0
                continue
            part = SMOOTH if weight == 1 else 0  # what is only hinted at has to stand for itself
            smooth = [(1 - part) * own[k] / own[2] + part * around[k] / around[2] for k in (0, 1)]
            scores[key] = (smooth[0] * smooth[1]) ** 0.5 * weight * weights[bool(path[1])]
    return [scores[key] for key in keys]


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The main text of one page: kept blocks joined by newlines; empty if there is none."""
    blocks = text_blocks(page or "")
    scores = path_scores(blocks)
    least = threshold * max(scores, default=0)
    return "\n".join(text for score, (*_, text) in zip(scores, blocks, strict=True) if score > 0 and score >= least)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    A null or empty html, and a page of boilerplate only, give an empty text. Rows are
    independent, so repeated rows, null ids and urls, and other columns do not matter;
    an empty table gives no rows.
    """
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))

    def each(batches):
        for b in batches:
            n = b.num_rows
            for i in range(0, n, 500):
                part = b.slice(i, 500)
                texts = [main_text(x, threshold) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(each, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
