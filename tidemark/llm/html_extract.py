"""Operator 5, main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at block-level tags. Each has its words and link density (share of words in links),
those of the blocks before and after it, and what the markup around it says, as numbers that the tree may outweigh:
elements for main text or for its frame, how far class names sound like a frame, and how much of the text (of main
elements, if it is in one) the element that looks like a frame holds. A decision tree, grown here from ``PAGES``, small pages whose blocks are
labelled, says of each block whether it is main text. One narrow pass over the pages.

The parser goes through a page once: it never looks again for something that an earlier search found missing.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import record_batch, slices

SCHEMA = "page_id long,url string,text string,n_chars long"
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "in_main", "page_main", "in_frame", "named", "frame_share", "heading")
#: Labelled pages. {n} stands for n words; the blocks that begin with + are main text.
PAGES = (
    # an article element beside menus, adverts, notices, sidebars and footers
    "<nav><ul><li><a>{1}</a><li><a>{1}</a><li><a>{2}</a></ul></nav><div class=ad>{8}</div><article><h1>+{9}</h1><p>+{12}<p>+{70}</p><p>+{2}</p><p>+{33}</p></article><footer>{11}</footer>",
    "<nav><a>{1}</a> <a>{1}</a></nav><div class=ad>{30}</div><article><h1>+{1}</h1><p>+{1}</article><footer>{25}</footer>",
    "<div class=ad>{1}</div><article><h1>+{4}</h1><p>+{3}</p></article><footer>{2}</footer>",
    "<header><h1>{2}</h1><a>{1}</a></header><div class=cookie-notice>{35} <a>{2}</a></div><main><h1>+{6}</h1><p>+{45}<p>+{5}<p>+{80}</main><div class=sidebar><h3>{2}</h3><ul><li><a>{5}</a><li><a>{6}</a></ul><p>{25}</p></div><footer><p>{14}</p></footer>",
    "<article class='post social-share-enabled'><h1>+{5}</h1><p>+{60}<p>+{90}<div class=share>{3} <a>{1}</a></div></article>",
    "<nav><a>{2}</a></nav><div class='layout with-sidebar'><article class=post><h2>+{7}</h2><p>+{55}</p><ul><li>+<a>{4}</a><li>+<a>{3}</a><li>+<a>{6}</a></ul><p>+{40}</p></article></div>",
    "<article><header><h1>+{8}</h1><p>+{4}</p></header><p>+{50}</p><aside>{20}</aside><p>+{65}</p><figure><figcaption>+{9}</figcaption></figure><form><label>{3}</label></form><p>+{30}</p></article>",
    "<article><h1>+{6}</h1><table><tr><th>+{1}<th>+{2}<tr><td>+{1}<td>+{3}<tr><td>+{2}<td>+{1}</table><p>+{35}</p><ol><li>+{4}<li>+{7}</ol></article><section class=comments><h2>{1}</h2><p>{30}</p><p>{55}</p></section>",
    "<article><p>+{40}</p><blockquote>+{20}</blockquote><pre>+{12}</pre><h3>+{3}</h3><p>+<a>{6}</a></p><p>+{3} <a>{8}</a></p><div class=comment-list><div class=comment>{22}</div><div class=comment>{70}</div></div><div class=related-posts><a>{5}</a></div></article>",
    "<article><h1>+{3}</h1><p>+{2}</p><div class=newsletter-signup>{24}</div><p>+{6}</p><div class=advert>{12}</div><p>+{1}</p><nav><a>{1}</a> <a>{1}</a></nav></article><div class=banner>{40}</div>",
    "<main><div class=menu>{3}</div><nav><a>{2}</a></nav><article><h1>+{4}</h1><p>+{75}</p></article><aside><h2>{2}</h2><p>{40}</p><a>{7}</a></aside></main>",
    "<div role=main><h1>+{5}</h1><p>+{28}</p><p>+{8}</p></div><div class=widget>{18}</div><div>{6}</div><div>{30}</div>",
    "<div>{12}</div><main><p>+{5}</p><p>+{140}</p></main><div>{45}</div><p>{9}</p>",
    "<aside><article><h3><a>{6}</a></h3><p>{15}</p></article><article><h3><a>{5}</a></h3><p>{18}</p></article></aside><article><h1>+{6}</h1><p>+{90}</p><p>+{60}</p></article>",
    "<form><nav><a>{1}</a> <a>{1}</a></nav><article><h1>+{5}</h1><p>+{80}</p><p>+{60}</p><p>+{10}</p></article></form>",
    "<article><h1>+{5}</h1><p>+<a>{4}</a></p><ul><li>+<a>{2}</a><li>+<a>{1}</a></ul><p>+{3}</p><p>+<a>{9}</a></p></article>",
    "<article><p>+<a>{2}</a></p><p>+{3}</p><p>+<a>{3}</a></p></article><footer><a>{1}</a></footer>",
    "<nav><a>{1}</a></nav><div class=ad>{6} <a>{2}</a></div><article><h1>+<a>{6}</a></h1><p>+{2}</p><p>+<a>{5}</a></p></article><div><a>{2}</a></div>",
    "<div>{20}</div><main><h1>+{3}</h1><ul><li>+<a>{4}</a> {2}<li>+<a>{3}</a></ul><p>+{20}</p><p>+<a>{7}</a> {1}</p></main><div>{3}</div>",
    "<div><a>{1}</a></div><article><p>+{6}</p></article><div><a>{1}</a></div><div>{60}</div><p>{30}</p>",
    "<nav><a>{1}</a></nav><article class='sponsored post'><h1>+{6}</h1><p>+{60}</p><p>+{8}</p></article><footer>{10}</footer>",
    "<article class=promotion><h1>+{4}</h1><p>+{30}</p><p>+{55}</p></article><aside>{15}</aside>",
    "<div class=sidebar-layout><article><h1>+{4}</h1><p>+{66}</p><p>+{72}</p></article></div><footer>{12}</footer>",
    # no article or main element; containers with telling names
    "<div class=header><a>{2}</a><a>{1}</a></div><div class=content><h1>+{5}</h1><p>+{50}</p><p>+{7}</p><p>+{35}</p></div><div class=footer>{16}</div>",
    "<div id=nav><a>{1}</a><a>{2}</a></div><div class='main-content with-sidebar'><p>+{45}</p><p>+{90}</p></div><div id=sidebar><p>{30}</p><ul><li><a>{3}</a><li><a>{4}</a></ul></div>",
    "<div class=post><h2>+{6}</h2><p>+{30}</p><p>+{4}</p><p>+{26}</p><div class=share-buttons><a>{1}</a><a>{1}</a></div></div><div class=comments><p>{20}</p><p>{45}</p></div>",
    "<div id=main><div class=breadcrumb><a>{1}</a><a>{2}</a></div><h1>+{7}</h1><p>+{62}</p><p>+{41}</p><div class=advertisement>{15}</div><p>+{33}</p></div>",
    "<div class=content-sidebar-wrap><div class=text><h1>+{4}</h1><p>+{60}</p><p>+{44}</p><p>+{5}</p></div><div class=sidebar><a>{3}</a> <a>{4}</a></div></div>",
    "<div class=page-with-comments><p>+{70}</p><p>+{55}</p><p>+{6}</p></div><div class=cookies>{20}</div>",
    # no main text at all
    "<nav><a>{1}</a><a>{2}</a></nav><footer><p>{20}</p><p>{60}</p></footer>", "<form><label>{2}</label><p>{24}</p></form>", "<header><p>{12}</p></header>",
    "<div class=comments><p>{60}</p><p>{25}</p></div>", "<aside><p>{50}</p></aside>", "<div class=cookie-notice>{45}</div><div class=footer>{12}</div>", "<nav><a>{2}</a> <a>{3}</a></nav>",
    # frames of few words beside much text without a main element
    "<div class=ad>{1}</div><p>+{200}</p><p hidden>{1}</p><p>+{90}</p><div class=footer>{2}</div>", "<header>{1}</header><p>+{120}</p><p>+{150}</p><aside>{2}</aside><p>+{60}</p><p class=sponsor>{1}</p><footer>{1}</footer>",
    "<h1>+{5}</h1><p>+{180}</p><div class=share><a>{1}</a></div><p>+{90}</p><div class='comments open'>{3}</div>",
    # plain containers: the text's own shape decides
    "<ul><li><a>{1}</a><li><a>{2}</a><li><a>{1}</a><li><a>{2}</a></ul><h1>+{6}</h1><p>+{55}</p><p>+{60}</p><p>+{38}</p><p><a>{2}</a> <a>{3}</a></p><p><a>{1}</a> | <a>{2}</a> {2}</p>",
    "<table><tr><td><a>{2}</a><td><a>{1}</a></table><table><tr><td>+{80}</td></tr><tr><td>+{60}</td></tr></table><div><a>{3}</a> <a>{2}</a></div>",
    "<div><a>{1}</a> <a>{1}</a> <a>{2}</a></div><div><h2>+{5}</h2><div>+{70}</div><div>+{9}</div><div>+{50}</div></div><div><a>{6}</a></div><div><a>{5}</a></div><div><a>{7}</a></div>",
    "<p>+{48}</p>",
    "<p>+{20}</p><p>+{75}</p><p>+{15}</p>",
    "<h1>+{4}</h1><p>+{30}</p><h2>+{2}</h2><p>+{44}</p><h2>+{3}</h2><p>+{36}</p>",
    "<h1>+{5}</h1><p>+{60}</p><ul><li>+{5}<li>+{6} <a>{2}</a><li>+{4}</ul><p>+{50}</p>",
    "<div><a>{2}</a></div><div><a>{3}</a></div><h1>+{6}</h1><p>+{42} <a>{3}</a> {20}</p><p>+{30} <a>{2}</a></p><p>+{25}</p><div><a>{1}</a> <a>{1}</a></div>",
    "<div><h3>{2}</h3><a>{4}</a></div><div><h3>{1}</h3><a>{5}</a></div><div><h3>{3}</h3><a>{6}</a></div><p>{2} <a>{4}</a></p>",
    "<ul><li><a>{3}</a> {1}<li><a>{4}</a> {2}<li><a>{6}</a> {1}<li><a>{3}</a></ul><div>{3}</div><div><a>{4}</a></div>",
    "<div><a>{1}</a></div><div>{4}</div><div><a>{2}</a></div><h1>+{7}</h1><p>+{66}</p><p>+{3}</p><p>+{51}</p><div><a>{2}</a></div><div>{5}</div><div><a>{1}</a></div>",
    "<dl><dt>+{2}<dd>+{30}<dt>+{1}<dd>+{44}<dt>+{3}<dd>+{26}</dl><p><a>{3}</a></p>",
    "<div><a>{5}</a> {2} <a>{6}</a></div><div>+{90}</div><div>+{85} <a>{4}</a></div><div><a>{3}</a> <a>{4}</a> {1}</div>",
)
#: Each page is seen at these sizes.
SCALES = (0.4, 1.0, 2.5)
DEPTH, LEAF = 12, 1

_FLOW = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that the next of their kind closes.
_SELF_CLOSED = _HEADINGS | {"li", "td", "th", "dd", "dt", "option"}
#: Elements across which an end tag of another kind does not reach.
_CELLS = frozenset("td th caption".split())
#: Elements whose content is raw text, none of it the page's; and others whose content is not shown as text.
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in "script style noscript iframe noembed noframes title textarea xmp".split()}
_UNSEEN = frozenset("template svg math object select button canvas audio video datalist".split())
_FRAME_TAGS = frozenset("nav footer aside form dialog menu".split())
_FRAME_NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu navbar navigation nav breadcrumb breadcrumbs footer header masthead topbar sidebar aside cookie cookies consent notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist reply replies disqus respond discussion widget toolbar pagination pager".split())
_MAIN_NAMES = frozenset("article main content post entry story".split())
#: Words of a class name that say nothing of what is inside, and those by which it speaks of something else.
_NEUTRAL = frozenset("list box wrap wrapper container block area section inner outer left right top bottom item items buttons bar".split())
_ABOUT = frozenset("with without has no not is enabled disabled free hide hidden show layout page".split())
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""=\s*["']|>""")
_LONG_REFERENCE = re.compile(r"&#(?:[xX]0*([0-9a-fA-F]{7,})|0*([0-9]{8,}));?")


@lru_cache(maxsize=4096)
def _names(attributes: str) -> tuple[float, bool, bool]:
    """How far class names and ids sound like a frame (0 to 1), whether one is a word for main text, role main."""
    named, main, role = 0.0, False, False
    for key, value in _NAMED.findall(attributes):
        if key.lower() == "role":
            role |= "main" in value.lower()
            continue
        for token in value.strip("\"'").split():
            words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
            if words and not _ABOUT.intersection(words):
                named = max(named, sum(w in _FRAME_NAMES for w in words) / max(1, sum(w not in _NEUTRAL for w in words)))
                main |= not _FRAME_NAMES.intersection(words) and not _MAIN_NAMES.isdisjoint(words)
    return min(1.0, named), main, role


def _unescape(text: str) -> str:
    return html.unescape(_LONG_REFERENCE.sub("�", text)) if "&" in text else text


def _tag_end(page: str, at: int, last: dict[str, int]) -> tuple[int, int]:
    """Where a tag's attributes end and its text goes on, quoted values skipped; (-1, -1) for a tag that never ends."""
    i = at
    while (m := _STOP.search(page, i)) is not None:
        if m[0] == ">":
            return m.start(), m.end()
        quote = m[0][-1]
        if last[quote] < m.end():  # a quote that is not closed counts as none
            i = m.end()
        else:
            i = page.index(quote, m.end()) + 1
    return -1, -1


def flat_blocks(page: str) -> list[tuple]:
    """(text, words, words in links, in_main, in_frame, named, heading, holder) of each block with text, in page order.

    holder: number of the outermost element that looks like a frame, 0 for none. Unclosed comments, tags and raw
    elements end with the page; other unclosed elements with the one around them.
    """
    out: list[tuple] = []
    parts: list[str] = []
    linked: list[str] = []
    # of each open element: tag, in_main, in_frame, named, holder, unseen
    top = ("", 0.0, 0, 0.0, 0, False)
    stack = [top]
    opened: dict[str, list[int]] = defaultdict(list)  # places of open elements in the stack
    cells: list[int] = []
    last = {q: page.rfind(q) for q in ("'", '"', ">", "-->")}
    link, heading, own, holders, at, n = 0, False, (0, 0.0, 0), 0, 0, len(page)  # own: marks of an open p

    def end_block():
        nonlocal parts, linked, own
        words = "".join(parts).split()
        if words:
            _, main, frame, named, holder, _ = stack[-1]
            frame, named, holder = frame or own[0], max(named, own[1]), holder or own[2]
            out.append((" ".join(words), len(words), len("".join(linked).split()), main, frame, named, heading, holder))
        parts, linked = [], []
        own = (0, 0.0, 0)

    def pop(to: int):
        nonlocal link
        for tag, *_ in reversed(stack[to:]):
            opened[tag].pop()
            if tag in _CELLS:
                cells.pop()
        del stack[to:]
        if link > len(stack):
            link = 0

    while at < n:
        lt = page.find("<", at)
        if lt != at:
            raw = page[at:] if lt < 0 else page[at:lt]
            if not stack[-1][5]:
                parts.append(raw := _unescape(raw))
                if link:
                    linked.append(raw)
            if lt < 0:
                break
        if page.startswith("<!--", lt):
            at = n if last["-->"] < lt + 2 else page.index("-->", lt + 2) + 3
            continue
        if page[lt + 1 : lt + 2] in ("!", "?"):
            at = n if last[">"] < lt else page.index(">", lt) + 1
            continue
        m = _TAG.match(page, lt + 1)
        if m is None:  # a plain character
            if not stack[-1][5]:
                parts.append("<")
            at = lt + 1
            continue
        closing, tag = m[1], m[2].lower()
        end, at = _tag_end(page, m.end(), last)
        if end < 0:
            break
        attributes = page[m.end() : end]
        if tag in _RAW and not closing:
            found = _RAW[tag].search(page, at)
            at = _tag_end(page, found.end(), last)[1] if found else n
            if at < 0:
                break
        elif tag == "a":
            link = 0 if closing else len(stack)
            linked.append(" ")
        elif tag == "br":
            parts.append(" ")
        elif tag in _UNSEEN:
            if closing:
                if opened[tag]:
                    pop(opened[tag][-1])
            elif not attributes.endswith("/"):
                opened[tag].append(len(stack))
                stack.append((tag, *stack[-1][1:5], True))
        elif tag in _FLOW:
            end_block()
            heading = tag in _HEADINGS and not closing
            if tag == "hr":
                continue
            named, main_name, role = _names(attributes) if attributes and tag not in ("html", "body") else (0.0, False, False)
            if tag == "p":
                hidden = int(bool(attributes and _HIDDEN.search(attributes)))
                if not closing and (hidden or named):
                    holders += 1
                    own = (hidden, named, holders)
                continue
            if closing:
                if opened[tag] and (tag in _CELLS or tag in ("table", "tr", "tbody") or not cells or opened[tag][-1] > cells[-1]):
                    pop(opened[tag][-1])
                continue
            if tag in _SELF_CLOSED and (stack[-1][0] == tag or tag in _HEADINGS and stack[-1][0] in _HEADINGS or tag in ("td", "th") and stack[-1][0] in ("td", "th") or tag in ("dd", "dt") and stack[-1][0] in ("dd", "dt")):
                pop(len(stack) - 1)
            _, main, frame, around, holder, unseen = stack[-1]
            frame = int(frame or tag in _FRAME_TAGS or tag == "header" and main < 1 or bool(attributes and _HIDDEN.search(attributes)))
            main = max(main, 1.0 if tag in ("article", "main") or role else 0.5 if main_name else 0.0)
            around = max(around, named)
            if not holder and (frame or around):
                holders += 1
                holder = holders
            opened[tag].append(len(stack))
            if tag in _CELLS:
                cells.append(len(stack))
            stack.append((tag, main, frame, around, holder, unseen))
    end_block()
    return out


def features(blocks: list[tuple]) -> list[tuple]:
    page_main = max((b[3] for b in blocks if not b[4]), default=0.0)
    flat = [(0, 0.0), *((b[1], min(1.0, b[2] / b[1])) for b in blocks), (0, 0.0)]
    plain, held = defaultdict(int), defaultdict(int)  # of blocks in a main element, and of all
    for b in blocks:
        for main in {False, b[3] > 0}:
            plain[main] += max(0, b[1] - b[2])
            held[main, b[7]] += max(0, b[1] - b[2])
    share = lambda b: held[b[3] > 0, b[7]] / total if b[7] and (total := plain[b[3] > 0]) else 0.0
    return [(*flat[i + 1], *flat[i], *flat[i + 2], b[3], page_main, int(b[4]), b[5], share(b), int(b[6])) for i, b in enumerate(blocks)]


def labelled() -> list[tuple]:
    """The blocks of ``PAGES``: their features, then 1 for main text."""
    rows = []
    for page in PAGES:
        for scale in SCALES:
            blocks = flat_blocks(re.sub(r"\{(\d+)\}", lambda m, s=scale: " ".join(["w"] * max(1, round(int(m[1]) * s))), page))
            rows += [(*f, int(b[0].startswith("+"))) for f, b in zip(features(blocks), blocks, strict=True)]
    return rows


def grow(rows, depth: int = DEPTH):
    """A decision tree by Gini impurity: a leaf's label, or (feature, threshold, tree up to it, tree above it)."""
    ones = sum(r[-1] for r in rows)
    if depth == 0 or ones in (0, len(rows)) or len(rows) <= LEAF:
        return int(2 * ones >= len(rows))
    best = None
    for f in range(len(rows[0]) - 1):
        order = sorted((r[f], r[-1]) for r in rows)
        left = 0
        for i, ((low, label), (high, _)) in enumerate(zip(order, order[1:], strict=False), 1):
            left += label
            if low != high:
                a, b = left / i, (ones - left) / (len(order) - i)
                score = a * (1 - a) * i + b * (1 - b) * (len(order) - i)
                if best is None or score < best[0] - 1e-12:
                    best = score, f, (low + high) / 2
    if best is None:
        return int(2 * ones >= len(rows))
    _, f, cut = best
    return f, cut, grow([r for r in rows if r[f] <= cut], depth - 1), grow([r for r in rows if r[f] > cut], depth - 1)


def classify(tree, row) -> int:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@lru_cache(maxsize=1)
def default_tree():
    return grow(labelled())


def main_text(page: str, tree=None) -> str:
    tree = default_tree() if tree is None else tree
    blocks = flat_blocks(page)
    return "\n\n".join(b[0] for b, row in zip(blocks, features(blocks), strict=True) if classify(tree, row))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text (blocks of main text joined by two line ends), n_chars for each page.

    Null or empty html, and a page without main text, give ''. Null ids and urls and equal rows are kept; an empty
    table gives none; other columns are not read. Time and memory are in proportion to a page's length.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = list(map(main_text, part.column(2).to_pylist()))
                yield record_batch([part.column(0), part.column(1), texts, list(map(len, texts))], SCHEMA)

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")).mapInArrow(run, SCHEMA.replace(",", ", "))
