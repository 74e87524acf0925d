"""Main text of HTML pages by the distribution of text over line blocks."""

import re
from collections import defaultdict
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Lines of a sliding window.
LINES = 3
#: A line of which more than this share is link text counts as empty.
LINKS = 0.6
#: A stretch of lines, outside article and main elements, whose fullest window holds less than this share of the page's fullest is left out.
FAINT = 0.1

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
#: Elements whose content is not markup; it ends at their end tag only.
RAW = {x: re.compile(rf"</{x}\b[^>]*(?:>|\Z)", re.I) for x in ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp")}
DROPPED = {"head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg", "canvas", "object", "audio", "video"}
#: Of these, those that may be around a whole page: a form, or a head without an end tag.
WRAPPERS = {"head", "form"}
#: Elements within which a header or footer belongs to the text's own parts.
MAIN = {"article", "main"}
BLOCKS = {
    "address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html", "legend", "li", "main", "ol", "option", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
} | DROPPED
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Whole names in a class, id or role that name what is not the article.
OTHER = re.compile(
    r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|respond|replies|consent|cookies?|disqus|footer|masthead|menu|modal|nav|navbar|navigation|"
    r"newsletter|notice|notification|alert|pagination|popup|promo\w*|related|recommend\w*|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|"
    r"complementary|contentinfo|search|widget)\d*", re.I,
)


#: In names of several parts (site-footer, adSlot): the last part that names such an element, or a first one before parts that only say
#: that it is a box. Names of a state (with-sidebar, has-ads) are not names of the element.
LAST_PART = re.compile(
    r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|"
    r"notification|pagination|popup|promo\w*|replies|sharing|sidebar|sponsor\w*|toolbar)\d*", re.I,
)
FIRST_PART = re.compile(r"(?:ads?|advert\w*|comments?|cookies?|disqus|footer|menu|nav|newsletter|popup|promo\w*|related|share|sharing|sidebar|social|sponsor\w*)", re.I)
BOX_PART = re.compile(r"(?:area|bar|block|bottom|box|button|buttons|container|form|icons?|inner|items?|left|links?|list|panel|right|row|section|slot|thread|top|unit|wrap|wrapper|)\d*", re.I)
STATE_PART = {"has", "is", "no", "not", "with", "without"}
READERS = re.compile(r"(?:comments?|respond|replies|disqus)\d*", re.I)
PART = re.compile(r"[-_]+|(?<=[a-z0-9])(?=[A-Z])")


def other_kind(name):
    """What a class, id or role names: 0 nothing to be dropped, 1 a part that is not the article, 2 comments of readers."""
    parts = [x for x in PART.split(name) if x]
    if not parts or len(parts) > 1 and parts[0].lower() in STATE_PART:
        return 0
    boxed = len(parts) > 1 and FIRST_PART.fullmatch(parts[0]) and all(map(BOX_PART.fullmatch, parts[1:]))
    if not (OTHER.fullmatch(name) or len(parts) > 1 and LAST_PART.fullmatch(parts[-1]) or boxed):
        return 0
    return 2 if READERS.fullmatch(parts[0] if boxed else parts[-1]) else 1


def lines_of(html):
    """(text, share of it in links, in an article or main element, number of the innermost element named to be dropped or -1) of
    each block with text; and those elements: [number of the one around it or -1, may hold the page, holds an article or main]."""
    lines, parts, links, open_tags, named, around = [], [], [], [], [], [-1]
    # Where the open elements of each name are, so that an end tag finds its own at once, however many others are open.
    places = defaultdict(list)
    main = link = 0
    at, end = 0, len(html)

    def close():
        text = " ".join(unescape("".join(parts)).split())
        linked = sum(map(len, links))
        if text:
            lines.append((text, linked / max(1, sum(map(len, parts))), main > 0, around[-1]))
        parts.clear()
        links.clear()

    while at < end:
        tag = TOKEN.search(html, at)
        stop = tag.start() if tag else end
        if stop > at:
            parts.append(html[at:stop])
            if link:
                links.append(html[at:stop])
        if not tag:
            break
        at = tag.end()
        if not tag[2]:
            continue
        name, closing = tag[2].lower(), bool(tag[1])
        if name in BLOCKS:
            close()
        if not closing and name in RAW:
            found = RAW[name].search(html, at)
            at = found.end() if found else end
            continue
        if closing:
            if places[name]:
                first = places[name][-1]
                gone = open_tags[first:]
                del open_tags[first:]
                ended = sum(x[1] for x in gone)
                if ended:
                    close()
                    del around[-ended:]
                for x, _ in gone:
                    places[x].pop()
                main -= sum(x[0] in MAIN for x in gone)
                link -= sum(x[0] == "a" for x in gone)
        elif name not in EMPTY and not tag[0].endswith("/>"):
            kind = 0
            if name not in ("html", "body") and name not in MAIN:
                names = [y for x in NAMES.findall(tag[3] or "") for y in (x[0] or x[1] or x[2]).split()]
                kind = max(map(other_kind, names), default=0)
            drop = kind > 0 or name in DROPPED
            if name in ("p", "li", "td", "th", "tr", "option", "dt", "dd") and open_tags and open_tags[-1][0] == name and not open_tags[-1][1]:
                open_tags.pop()
                places[name].pop()
            if drop:
                close()
                named.append([around[-1], kind < 2 and (name not in DROPPED or name in WRAPPERS), False if kind < 2 else None])
                around.append(len(named) - 1)
            places[name].append(len(open_tags))
            open_tags.append((name, drop))
            if name in MAIN:
                main += 1
                if around[-1] >= 0 and named[around[-1]][2] is False:
                    named[around[-1]][2] = True
            link += name == "a"
    close()
    return lines, named


def dropped(lines, named):
    """Whether each element of ``named`` goes. One that holds most of the page's text, or the page's only articles, stays; readers' comments never do."""
    sizes, holds = [0] * len(named), [bool(x[2]) for x in named]
    for text, _, _, k in lines:
        if k >= 0:
            sizes[k] += len(text)
    for k in range(len(named) - 1, -1, -1):
        around = named[k][0]
        if around >= 0:
            sizes[around] += sizes[k]
            holds[around] |= holds[k] and named[around][2] is not None
    total, elsewhere = sum(len(x[0]) for x in lines), any(x[2] and x[3] < 0 for x in lines)
    gone = []
    for k, (around, wraps, _) in enumerate(named):
        stays = wraps and 2 * sizes[k] > total or holds[k] and not elsewhere
        gone.append(not stays or around >= 0 and gone[around])
    return gone


def stretches(length, window=LINES, faint=FAINT):
    """[first, last) lines of the stretches between a surge and the dive that follows it, by sums over ``window`` neighbouring lines.

    A surge is where the sums rise from 0, a dive where they are back at it. A stretch whose greatest sum is below the
    share ``faint`` of the page's greatest is none.
    """
    # Sum i is that of the lines up to i, so a stretch of sums begins with its first line and ends ``window`` - 1 lines after its last.
    blocks = np.convolve(length, np.ones(window, np.int64))
    full = np.r_[False, blocks > 0, False]
    surges, dives = np.flatnonzero(full[1:] & ~full[:-1]), np.flatnonzero(~full[1:] & full[:-1])
    least = faint * blocks.max(initial=0)
    return [(a, b - window + 1) for a, b in zip(surges.tolist(), dives.tolist()) if blocks[a:b].max() >= least]


def main_text(html, window=LINES, links=LINKS, faint=FAINT):
    """The text of all stretches of the line-block distribution, blocks joined by one space."""
    lines, named = lines_of(html or "")
    if not lines:
        return ""
    gone = dropped(lines, named)
    stays = [k < 0 or not gone[k] for _, _, _, k in lines]
    inside = any(m and s for (_, _, m, _), s in zip(lines, stays))
    length = np.array([len(t) if s and (m if inside else share <= links) else 0 for (t, share, m, _), s in zip(lines, stays)])
    # What an article or main element holds is the text, however short its parts; elsewhere the distribution decides.
    kept = stretches(length, window, 0 if inside else faint)
    return " ".join(lines[i][0] for a, b in kept for i in range(a, b) if length[i])


def extract(pages, id_col="page_id", url_col="url", html_col="html"):
    """page_id, url, text, n_chars (code points) of every page.

    Markup is stripped to lines, one per block; scripts, styles, forms, menus, headers, footers, sidebars, notices, adverts
    and comments, known by element or by a name in class, id or role (a whole one, or one of several parts that ends with
    such a name, or begins with it and goes on with names of boxes), count as lines without text, unless such an element
    holds most of the page's text or its only articles; readers' comments always do. So do lines mostly of links outside article and main elements. Lengths
    are summed over sliding windows of LINES lines; text is kept from each point where the sums rise from 0 (surge) to that where they
    fall back to it (dive). Of a page with article or main elements that is their text. Of another, stretches that are
    faint against its fullest window (FAINT) are left out: single words between menus, marks of time, captions of buttons.

    A null or empty page, or one without text, gives an empty text. A page cut short is read as far as it goes. Null ids
    and urls stay null, repeated rows stay, other columns are not looked at; an empty table gives no row. Pages are read
    one by one as wholes, however long.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
