"""Main text of web pages from flat text blocks and a small decision tree.

A page is cut into flat blocks of text at its block-level tags. A block is described by its number
of words and its share of words in links, the same of the block before and after it, and by where it
stands: inside an article; in a part whose class, id or tag often is not the article (``outside``); in
a part that never is (``barred``: a menu, a footer, reader comments and the like). A decision tree,
trained on the labelled page shapes below, tells blocks of the article from the rest. The classes of
real pages mislead in both ways, and many parts have none; there the densities of a block and its
neighbours decide.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adledger.llm.common import slices, small_batches

FEATURES = "words links words_before links_before words_after links_after inside outside barred heading".split()

# The labelled table. A line is the shape of a page: its blocks in order, + for the article and - for
# the rest, as words/share of words in links, then i inside, o outside, b barred, h heading.
LABELLED = """
-1/1b -1/1b -1/1b -12/0b +8/0hi +60/0i +2/0i +45/.1i +3/0i +120/.05i -14/0b
-6/1b -7/1b -6/1b -9/0b +11/0hi +90/0i +12/1i +70/0i +35/.2i -8/.3b
-2/1b -3/.7b -25/0o +5/0hi +1/0i +2/0i +4/0i -30/0b -60/0b -40/0b
-1/1 -1/1 -2/1 -1/1 +8/0h +70/0 +40/.05 +12/1 +55/0 -3/1 -2/1 -4/1 -6/0
-7/1 -6/1 -7/1 -6/1 -8/1 +9/0h +35/0 +60/.1 +80/0 -7/1 -6/1 -8/.9 -7/1
-4/1 -3/0 -4/1 -3/1 +6/0h +30/0 +5/0 +45/0 +9/.2 +50/0 -4/0 -5/1 -4/1 -7/0
-2/1 -2/1 -2/0 -2/1 +7/0h +20/0 +25/0 +3/0h +60/0 +4/0h +30/0 -3/0 -3/1 -2/1 -9/0
+8/0h +80/0 +45/0 +6/0 +60/0
+5/0h +20/0 +12/0
+3/0 +4/0
+2/0
+70/0
+25/0 +1/0 +30/0 +2/0 +28/0
-1/1b -2/1b +8/0 +4/0 +6/0 -3/0b
+14/0i
+3/0i +2/0i
+40/0i +5/1i +6/1i +7/1i +8/1i +9/1i +30/0i
+60/0i +6/1i +5/1i +12/1i +7/1i
-1/1b -1/1b -12/0b +6/0hi +11/0i +9/0i +30/0i +7/0i -5/0b
-1/1b -10/0b +14/0hi +80/0i +13/0i -4/0b
-2/1b -8/0b +3/0hi +5/0i +16/0i -1/0b
-1/1b +20/0hi +8/0i -30/0b
-12/0b +9/0hi +26/0i +110/0i +10/0i -2/1b -3/1b
-1/0b -6/1b +40/0 -12/1b -5/.6b +30/0 -40/.6b +50/0i -7/1b +60/0i -9/1b -15/1b +35/0i -4/.9b -20/.7b
-1/1ib -2/1ib -3/1ib +9/0hi +60/0i -6/1ib -8/1ib -12/1ib -30/0ib +50/0i -40/0ib +45/0i -5/.8ib +30/0i -20/1ib
-4/1ib -5/1ib -7/1ib -6/1ib +40/0i -9/1ib -3/1ib +60/0i -2/0ib -5/1ib
+50/0 -6/1b -11/1b +70/0i -5/1b -6/1b -14/.8b +45/0i -9/1b
+30/0i +5/.8i +45/0i +11/1i +50/0i +9/1i
-3/1i -4/1i -3/1i -4/1i +9/0hi +60/0i +50/0i -2/1i -3/1i -2/1i
-2/1b -2/1b +9/0ho +80/0o +95/0o +70/.02o +110/0o +75/0o -3/1o -6/0o
-3/1o -4/1o +60/0o +80/0o +65/.1o +90/0o -12/0o -3/1o
-2/1b +10/0h +60/0 +85/0o +70/0o +90/0 +40/0 -20/0o -5/1o -4/1o
-15/0o +8/0h +40/0 +60/0 -12/0o -25/.1o -3/1o -2/1o
-20/0o -2/1 -2/1 +30/0 +25/0 -18/0o -10/0o
+12/0h +45/0 -16/0o +50/0 +35/0 -9/0o +40/0 -5/.5o
-6/0o +9/0i -7/0o +60/0i -30/0o +12/0i -14/.2o
-80/0b -90/0b -70/0b -65/0b
+60/0i -40/0b +70/0i -90/0b +3/0i -1/0b +4/0i
-5/0hb -50/0b -3/0hb -35/0b -8/.4b
-3/0ho -6/1o -7/1o -5/1o -6/1o
+12/0hi -2/.5o +30/0i -5/0ho -4/1o -6/1o
-1/1b -1/1b +4/0hi +6/.5i +1/0i -7/0b -13/0b +1/0i +1/0i +6/0i -5/0b -9/0b
-1/1b +4/0hi +7/.4i +1/0i -8/0b +2/0i -7/1b -5/.6o +4/0i -2/1b
-2/1 -3/1 +4/0h +40/0 +12/1 +50/0 -1/1 -1/1 -4/0
-1/1 -2/1 +3/0h +15/.3 +30/0 -9/0 -2/1 -3/1 -12/0 -2/1
-2/1 -14/0 -2/1 -3/1 +11/0h +9/.4 +60/0 -10/0 -1/1 -2/1
-1/1b +2/0hi +9/.45i +20/.6i +14/.3i +50/0i -2/1i -3/1i
-3/1b +6/0h +10/.5 +25/.35 +40/.2 -3/1 -8/.9 -5/.7
+5/0hi +8/.7i +30/0i +3/1i +40/0i
-2/1 -2/1 +2/0h +18/.4 +6/0 -2/1 -1/1
-3/1 -2/.5 -4/.6 +5/0h +22/.5 +30/.4 +18/.3 -4/.5 -3/.6 -2/1
-3/1i -2/.5i -4/1i +5/0hi +22/.5i +6/.4i +18/.3i -4/1i -3/.6i -2/1i
"""


LEAST = 8  # blocks in a leaf that is not pure


def shapes(table: str, scales: tuple[float, ...] = (1.0, 0.6, 0.8, 1.3, 1.7)) -> tuple[np.ndarray, np.ndarray]:
    """FEATURES of all blocks of a table of page shapes, and whether they are of the article. Shapes
    count at several sizes, so that no cut hangs on a number of words in the table."""
    rows, labels = [], []
    for scale in scales:
        for line in table.strip().splitlines():
            blocks = []
            for sign, words, links, flags in re.findall(r"([+-])(\d+)/([\d.]+)([iobh]*)", line):
                labels.append(sign == "+")
                count = max(1, round(int(words) * scale))
                blocks.append(("", count, float(links) * count, *(f in flags for f in "iobh")))
            rows.append(describe(blocks))
    return np.concatenate(rows), np.array(labels, float)


# Fixed values of the HTML vocabulary.
_RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template svg math object canvas".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option "
    "p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Start tags that end an open element of their own kind.
_SIBLING = frozenset("p li dt dd tr td th option".split())
_BARRED_TAGS = frozenset("nav aside footer dialog menu search button select fieldset head".split())
_BARRED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
_COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
_COMMENT_CLASSES = frozenset("comment reply".split())  # of an article that is itself one
_BARRED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored banner menu menus nav navbar navigation "
    "breadcrumb breadcrumbs masthead footer sidebar sidebars cookie cookies consent gdpr popup modal overlay "
    "newsletter subscribe subscription signup login pager pagination notice notices promo promotion widget widgets "
    "teaser teasers".split()
)
_OUTSIDE_WORDS = frozenset(
    "header share sharing social related recommended recommendations copyright toolbar tags".split()
)
_INSIDE_WORDS = frozenset("article content main post entry story articlebody".split())
# Words that end a compound class without saying what it is, and words that begin one about something else.
_GENERIC = frozenset(
    "container wrapper wrap inner outer box list area block section bar group row col column left right top bottom "
    "links link items item buttons title text body content panel module slot zone region holder grid card cards".split()
)
_ABOUT = frozenset("has with without no is hide show".split())
_MORE = frozenset("related recommended popular recent latest trending more".split())
_OTHERS = frozenset("posts articles stories news reading entries topics".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/][^a-zA-Z>][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
# Attributes one after the other, each with the whole of its value.
_ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+("[^"]*+"?|'[^']*+'?|[^\s>]++))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _nouns(value: str) -> set[str]:
    """What the names of a class or id call a thing: the last word of each that is not a generic one,
    as in ``site-header``, ``footerLinks`` or ``social-science``."""
    found = set()
    for name in value.split():
        words = [w.lower() for part in re.split(r"[^A-Za-z]+", name) for w in _WORD.findall(part)]
        if not words or words[0] in _ABOUT:
            continue
        found.add("".join(words))
        if words[0] in _MORE and words[-1] in _OTHERS:
            found.add("related")
        while len(words) > 1 and words[-1] in _GENERIC:
            words.pop()
        found.add(words[-1])
    return found


def _kind(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, bool]:
    """Whether an element makes its content inside an article, outside of it, or barred from it."""
    nouns, classes, role, gone = set(), [], "", False
    if attributes:
        seen = set()
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"' ")
            if name in seen:  # the first one counts
                continue
            seen.add(name)
            if name in ("class", "id"):
                if name == "class":
                    classes = value.lower().split()
                nouns |= _nouns(value)
            elif name == "role":
                role = value.lower()
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                gone = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                gone = True
    if gone or role in _BARRED_ROLES or tag in _BARRED_TAGS:
        return False, False, True
    # What holds the page or its article is not a comment because a class says that there are some.
    if tag in ("html", "body"):
        return False, False, False
    if tag == "main" or role == "main":
        return True, False, False
    article = tag == "article" or role == "article"
    if article and not inside and not _COMMENT_CLASSES.intersection(classes):
        return True, False, False
    if nouns & _COMMENT_WORDS:
        return False, False, True
    if article:
        return True, False, False
    if tag == "header":
        return False, False, not inside
    if tag == "form" or role == "form":
        return False, True, inside
    if nouns & _BARRED_WORDS:
        return False, False, not (inside and tag in _HEADING)
    if nouns & _OUTSIDE_WORDS:
        return False, not (inside and (tag in _HEADING or nouns & _OUTSIDE_WORDS == {"header"})), False
    return bool(nouns & _INSIDE_WORDS), False, False


def blocks_of(page: str) -> list[tuple[str, int, int, bool, bool, bool, bool]]:
    """(text, words, words in links, inside, outside, barred, heading) of every block with text."""
    out, pieces = [], []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, inside, outside, barred
    inside = outside = barred = heading = False
    links = 0

    def close() -> None:
        text = " ".join("".join(t for t, _ in pieces).split())
        if text:
            count = text.count(" ") + 1
            linked = sum(len(t.split()) for t, in_link in pieces if in_link)
            out.append((text, count, min(linked, count), inside, outside, barred, heading))
        pieces.clear()

    at, end = 0, len(page)
    while at < end:
        match = _TOKEN.search(page, at)
        text = page[at : match.start() if match else end]
        if text:
            pieces.append((html.unescape(text) if "&" in text else text, links > 0))
        if not match:
            break
        at = match.end()
        slash, tag, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            if tag in _BLOCK:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    inside, outside, barred = stack[-1][1:] if stack else (False, False, False)
                    heading = any(s[0] in _HEADING for s in stack)
                    links = sum(s[0] == "a" for s in stack)
                    break
                if stack[i][0] in ("article", "main", "body") and tag not in ("html", "body"):
                    break
            continue
        if tag == "br":
            pieces.append((" ", False))
            continue
        if tag in _BLOCK:
            close()
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCK:
            continue
        if tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?![a-zA-Z0-9-])[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in _SIBLING or tag == "a" or tag in _BLOCK:
            # A paragraph ends where a block begins; a link where another begins.
            own = "p" if tag in _BLOCK and tag not in _SIBLING else tag
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == own:
                    del stack[i:]
                    inside, outside, barred = stack[-1][1:] if stack else (False, False, False)
                    links = sum(s[0] == "a" for s in stack)
                    break
                if stack[i][0] in _BLOCK:
                    break
        kind = _kind(tag, attributes, inside) if tag in _BLOCK or attributes or tag == "button" else (False, False, False)
        if tag not in _BLOCK and (kind[1] and not outside or kind[2] and not barred):
            close()
        inside, outside, barred = inside or kind[0], outside or kind[1], barred or kind[2]
        stack.append((tag, inside, outside, barred))
        heading = heading or tag in _HEADING
        links += tag == "a"
    close()
    return out


def describe(blocks: list[tuple]) -> np.ndarray:
    """FEATURES of the blocks of one page, in order."""
    if not blocks:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b[1] for b in blocks], float)
    links = np.array([b[2] for b in blocks], float) / words
    pad = lambda x, before: np.concatenate([[0.0], x[:-1]] if before else [x[1:], [0.0]])
    flags = np.array([b[3:7] for b in blocks], float)
    return np.column_stack([words, links, pad(words, True), pad(links, True), pad(words, False), pad(links, False), flags])


def train(rows: np.ndarray, labels: np.ndarray, depth: int = 9) -> tuple | float:
    """A tree of (feature, threshold, below, above); leaves are the share of label 1. Gini impurity."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0) or len(rows) < LEAST:
        return float(share)
    best = (2 * share * (1 - share) - 1e-9, None)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= cut
            a, b = labels[low].mean(), labels[~low].mean()
            impurity = low.mean() * 2 * a * (1 - a) + (~low).mean() * 2 * b * (1 - b)
            if impurity < best[0] - 1e-12:
                best = (impurity, (feature, float(cut)))
    if best[1] is None:
        return float(share)
    feature, cut = best[1]
    low = rows[:, feature] <= cut
    return feature, cut, train(rows[low], labels[low], depth - 1), train(rows[~low], labels[~low], depth - 1)


def classify(tree: tuple | float, rows: np.ndarray) -> np.ndarray:
    """True for rows of the article."""
    if not isinstance(tree, tuple):
        return np.full(len(rows), tree >= 0.5)
    feature, cut, below, above = tree
    low = rows[:, feature] <= cut
    out = np.empty(len(rows), bool)
    out[low], out[~low] = classify(below, rows[low]), classify(above, rows[~low])
    return out


@lru_cache(maxsize=1)
def fitted() -> tuple | float:
    return train(*shapes(LABELLED))


def main_text(page: str) -> str:
    """The article's blocks, one per line."""
    blocks = blocks_of(page)
    chosen = classify(fitted(), describe(blocks))
    return "\n".join(b[0] for b, take in zip(blocks, chosen) if take)


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """All columns but ``page``, and ``text`` and ``n_chars`` (code points).

    A null or empty page has the empty text. Columns named ``text`` or ``n_chars`` are replaced.
    Repeated rows are extracted each; nothing is shuffled.
    """
    small_batches(pages.sparkSession)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = []
            for part in slices(pa.RecordBatch.from_arrays([batch], ["page"]), "page"):
                texts += [main_text(p or "") for p in part.column(0).to_pylist()]
            yield pa.array(texts, pa.string())

    return pages.withColumn("text", run(F.col(page))).withColumn("n_chars", F.char_length("text").cast("long")).drop(page)
