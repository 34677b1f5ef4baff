"""HTML extraction: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks with the word count and link density of the block and
its neighbours, and whether it lies in page furniture (by tag) or in an
article, or in an element named as furniture.  A decision tree, fitted to the small labelled table below, keeps or drops each block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import rows_of

# Element names of HTML by their part here.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object canvas audio video select".split())
FURNITURE = frozenset("nav footer aside form menu dialog button fieldset head title".split())
ARTICLE = frozenset("article main".split())
#: Words of class, id and role that name page furniture.
NAMES = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent contentinfo "
                  "cookie cookies disqus dialog footer header login menu nav navbar navigation newsletter notice notices "
                  "pagination popup promo promoted related replies reply search share sharing sidebar signup social "
                  "sponsor sponsored subscribe tags toolbar widget".split())
#: Words that may stand beside them in one value; any other word makes it another name ("related-work").
BESIDE = frozenset("area articles bar block bottom box button buttons container form global inner left links list main page "
                   "policy posts primary right row secondary section side site stories top wrapper".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
                   r"((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*+)(>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
#: Letters of scripts without spaces between words; two count as a word.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "furniture", "article", "named")

#: Labelled blocks: the features in the order of FEATURES, then 1 for main text.
LABELLED = (
    (60, 0.0, 45, 0.0, 80, 0.0, 0, 1, 0, 1), (12, 0.0, 3, 1.0, 90, 0.0, 0, 1, 0, 1), (1, 0.0, 40, 0.0, 30, 0.0, 0, 1, 0, 1),
    (2, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (30, 0.4, 20, 0.0, 20, 0.0, 0, 1, 0, 1), (8, 1.0, 50, 0.0, 60, 0.0, 0, 1, 0, 1),
    (5, 0.0, 12, 1.0, 6, 0.0, 0, 1, 0, 1), (200, 0.0, 4, 0.0, 3, 1.0, 0, 1, 0, 1), (3, 0.0, 60, 0.0, 9, 0.5, 0, 1, 0, 1),
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (12, 0.0, 1, 1.0, 10, 0.0, 1, 0, 0, 0),
    (40, 0.0, 60, 0.0, 30, 0.0, 1, 0, 0, 0), (15, 0.1, 70, 0.0, 0, 0.0, 1, 0, 0, 0), (25, 0.0, 80, 0.0, 20, 0.0, 1, 1, 0, 0),
    (6, 0.5, 90, 0.0, 40, 0.0, 1, 1, 0, 0), (90, 0.0, 30, 0.0, 25, 0.0, 1, 0, 0, 0), (120, 0.0, 90, 0.0, 70, 0.0, 1, 1, 0, 0),
    (3, 0.0, 5, 1.0, 8, 0.0, 1, 0, 0, 0), (2, 0.0, 1, 1.0, 60, 0.0, 1, 0, 0, 0), (7, 0.0, 200, 0.0, 1, 1.0, 1, 1, 0, 0),
    (55, 0.0, 8, 0.0, 70, 0.0, 0, 0, 0, 1), (80, 0.05, 55, 0.0, 60, 0.0, 0, 0, 0, 1), (35, 0.0, 80, 0.0, 4, 1.0, 0, 0, 0, 1),
    (25, 0.1, 40, 0.0, 45, 0.1, 0, 0, 0, 1), (70, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (9, 0.0, 30, 0.0, 60, 0.0, 0, 0, 0, 1),
    (14, 0.0, 25, 0.0, 35, 0.0, 0, 0, 0, 1), (6, 0.0, 2, 1.0, 55, 0.0, 0, 0, 0, 1), (40, 0.2, 3, 1.0, 30, 0.0, 0, 0, 0, 1),
    (2, 1.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (4, 1.0, 30, 0.0, 2, 1.0, 0, 0, 0, 0), (5, 0.9, 1, 1.0, 40, 0.0, 0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (10, 0.8, 6, 1.0, 7, 0.9, 0, 0, 0, 0), (4, 0.0, 4, 0.5, 3, 0.0, 0, 0, 0, 0),
    (6, 0.3, 50, 0.0, 0, 0.0, 0, 0, 0, 0), (30, 0.9, 10, 0.9, 20, 0.8, 0, 0, 0, 0), (5, 0.0, 3, 0.0, 2, 0.0, 0, 0, 0, 0),
    (18, 0.7, 60, 0.0, 12, 0.9, 0, 0, 0, 0),
    (2, 1.0, 2, 1.0, 3, 1.0, 0, 1, 0, 1), (4, 1.0, 30, 0.0, 2, 1.0, 0, 1, 0, 1), (5, 0.9, 1, 1.0, 40, 0.0, 0, 1, 0, 1),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 1, 0, 1), (10, 0.8, 6, 1.0, 7, 0.9, 0, 1, 0, 1), (4, 0.0, 4, 0.5, 3, 0.0, 0, 1, 0, 1),
    (6, 0.3, 50, 0.0, 0, 0.0, 0, 1, 0, 1), (30, 0.9, 10, 0.9, 20, 0.8, 0, 1, 0, 1), (5, 0.0, 3, 0.0, 2, 0.0, 0, 1, 0, 1),
    (18, 0.7, 60, 0.0, 12, 0.9, 0, 1, 0, 1), (10, 0.0, 50, 0.0, 2, 0.0, 0, 1, 0, 1), (35, 0.0, 9, 0.0, 1, 0.0, 0, 1, 0, 1),
    (3, 0.0, 2, 1.0, 60, 0.0, 0, 0, 0, 1), (2, 0.0, 50, 0.0, 45, 0.0, 0, 0, 0, 1), (5, 0.0, 70, 0.0, 90, 0.0, 0, 0, 0, 1),
    (1, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 1), (4, 0.0, 60, 0.0, 25, 0.0, 0, 0, 0, 1), (3, 0.0, 60, 0.0, 4, 0.0, 0, 0, 0, 0),
    (20, 0.5, 60, 0.0, 50, 0.0, 0, 0, 0, 1), (30, 0.4, 40, 0.0, 45, 0.1, 0, 0, 0, 1), (15, 0.6, 45, 0.0, 80, 0.0, 0, 0, 0, 1),
    (25, 0.5, 35, 0.1, 40, 0.0, 0, 0, 0, 1), (3, 1.0, 60, 0.0, 50, 0.0, 0, 0, 0, 0), (5, 1.0, 70, 0.0, 80, 0.0, 0, 0, 0, 0),
    (40, 0.0, 60, 0.0, 50, 0.0, 0, 1, 1, 1), (8, 0.0, 40, 0.0, 30, 0.0, 0, 1, 1, 1), (3, 0.0, 40, 0.0, 60, 0.0, 0, 1, 1, 1),
    (20, 0.2, 5, 0.0, 30, 0.0, 0, 1, 1, 1), (4, 1.0, 6, 1.0, 5, 1.0, 0, 1, 1, 0), (12, 0.9, 50, 0.0, 8, 1.0, 0, 1, 1, 0),
    (3, 1.0, 60, 0.0, 40, 0.0, 0, 1, 1, 0), (9, 0.8, 2, 0.0, 60, 0.0, 0, 1, 1, 0),
    (40, 0.0, 60, 0.0, 50, 0.0, 0, 0, 2, 0), (9, 0.0, 2, 0.0, 3, 0.0, 0, 1, 2, 0), (3, 0.0, 40, 0.0, 60, 0.0, 0, 0, 2, 0),
    (25, 0.0, 80, 0.0, 20, 0.0, 0, 1, 2, 0), (90, 0.0, 30, 0.0, 25, 0.0, 0, 0, 2, 0), (2, 0.0, 0, 0.0, 0, 0.0, 0, 1, 2, 0),
    (60, 0.0, 45, 0.0, 80, 0.0, 0, 1, 2, 0), (5, 1.0, 3, 1.0, 4, 1.0, 0, 0, 2, 0), (12, 0.0, 3, 1.0, 90, 0.0, 0, 1, 2, 0),
    (7, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (9, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 1),
    (14, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (8, 0.1, 30, 0.0, 2, 1.0, 0, 0, 0, 1),
    (6, 0.0, 30, 0.0, 3, 0.0, 0, 0, 0, 1), (7, 0.2, 60, 0.0, 1, 1.0, 0, 0, 0, 1),
    (12, 0.1, 8, 0.0, 4, 0.0, 0, 0, 0, 1), (9, 0.0, 90, 0.0, 0, 0.0, 0, 0, 0, 1),
    (6, 0.2, 8, 0.0, 9, 0.0, 0, 0, 0, 1), (6, 0.0, 0, 0.0, 8, 0.0, 0, 0, 0, 1),
    (14, 0.2, 2, 1.0, 9, 1.0, 0, 0, 0, 1), (4, 0.0, 3, 0.0, 8, 0.0, 0, 0, 0, 0),
    (5, 0.0, 8, 0.0, 9, 0.0, 0, 0, 0, 0), (1, 0.0, 30, 0.0, 8, 0.0, 0, 0, 0, 0),
    (3, 0.0, 4, 0.0, 12, 0.0, 0, 0, 0, 0), (2, 0.0, 0, 0.0, 8, 0.0, 0, 0, 0, 0),
    (4, 0.2, 90, 0.0, 9, 1.0, 0, 0, 0, 0), (5, 0.1, 0, 0.0, 0, 0.0, 0, 0, 0, 0),
    (8, 0.5, 4, 0.5, 6, 0.5, 0, 0, 0, 0), (12, 0.5, 8, 0.0, 9, 0.0, 0, 0, 0, 0),
    (9, 0.4, 6, 1.0, 7, 1.0, 0, 0, 0, 0), (7, 0.3, 40, 0.0, 3, 0.0, 0, 0, 0, 0),
    (14, 0.4, 8, 0.0, 12, 0.0, 0, 0, 0, 0), (3, 0.0, 30, 0.0, 60, 1.0, 0, 0, 0, 0),
    (2, 0.1, 5, 1.0, 40, 0.9, 0, 0, 0, 0),
    (9, 0.5, 60, 0.0, 50, 0.0, 0, 0, 0, 1), (8, 0.4, 45, 0.0, 70, 0.0, 0, 0, 0, 1), (12, 0.5, 80, 0.0, 40, 0.0, 0, 0, 0, 1),
    (25, 0.5, 6, 0.5, 8, 1.0, 0, 0, 0, 0), (40, 0.4, 4, 0.0, 3, 1.0, 0, 0, 0, 0), (30, 0.5, 8, 0.6, 12, 0.5, 0, 0, 0, 0),
    (12, 1.0, 30, 0.0, 60, 0.0, 0, 0, 0, 0), (8, 0.9, 5, 0.0, 50, 0.0, 0, 0, 0, 0), (20, 0.8, 60, 0.0, 50, 0.0, 0, 0, 0, 0),
    (10, 1.0, 2, 1.0, 90, 0.0, 0, 0, 0, 0), (16, 0.9, 45, 0.0, 70, 0.0, 0, 0, 0, 0), (7, 0.8, 70, 0.0, 40, 0.0, 0, 0, 0, 0),
)


def fit_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 5):
    """A decision tree by the Gini gain of axis-parallel cuts: (feature, cut, below, above) or the share of label 1.
    Of equal cuts the first feature and the lowest cut win."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best, gini = None, len(labels) * share * (1 - share)
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] <= cut
            cost = sum(len(x) * x.mean() * (1 - x.mean()) for x in (labels[low], labels[~low]))
            if cost < gini - 1e-9:
                best, gini = (f, float(cut), low), cost
    if best is None:
        return share
    f, cut, low = best
    return f, cut, fit_tree(rows[low], labels[low], depth - 1), fit_tree(rows[~low], labels[~low], depth - 1)


def keeps(tree, row) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree >= 0.5


def count(text: str) -> int:
    """Words of a text."""
    return len(text.split()) + (0 if text.isascii() else len(UNSPACED.findall(text)) // 2)


def named(attributes: str) -> bool:
    """Whether a whole value of class, id or role names page furniture."""
    for name, value in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for v in value.strip("\"'").lower().split():
                parts = {w for w in re.split(r"[^a-z]+", v) if w}
                if not NAMES.isdisjoint(parts) and parts <= NAMES | BESIDE:
                    return True
    return False


def blocks(page: str) -> list[tuple[str, int, int, bool, bool, int]]:
    """The text blocks of a page in order: text, words, linked words, in furniture, in an article,
    and in an element named as furniture: 0 no, 1 inside the article, 2 outside.

    A block ends at any tag that isn't inline.  An end tag closes the nearest open element of its
    name, and what is still open inside; without one it is ignored.  A tag cut off at the end of
    the page is markup."""
    out, stack, opened = [], [], Counter()
    parts: list[str] = []
    linked, in_link = 0, 0

    def flush():
        nonlocal parts, linked
        words = "".join(parts).split()
        if words:
            text = " ".join(words)
            n = count(text)
            out.append((text, n, min(linked, n), *(stack[-1][1:] if stack else (False, False, 0))))
        parts, linked = [], 0

    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        text = html.unescape(page[at:m.start() if m else len(page)])
        if text:
            parts.append(text)
            if in_link:
                linked += count(text)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if name in RAW and not m[1]:
            if name not in ("svg", "math", "object", "audio", "video") or not m[3].endswith("/"):
                end = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            flush()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        if m[1]:
            if opened[name]:
                while stack:
                    gone = stack.pop()[0]
                    opened[gone] -= 1
                    in_link -= gone == "a"
                    if gone == name:
                        break
        elif not m[3].endswith("/"):
            _, furniture, article, name_of = stack[-1] if stack else ("", False, False, 0)
            own = name in FURNITURE or (name == "header" and not article)
            if m[3] and name not in ("html", "body", *ARTICLE) and named(m[3]):
                name_of = max(name_of, 1 if article else 2)
            stack.append((name, furniture or own, article or name in ARTICLE, name_of))
            opened[name] += 1
            in_link += name == "a"
    flush()
    return out


def features(found: list[tuple[str, int, int, bool, bool, int]]) -> list[tuple]:
    """The FEATURES of each block; before the first and after the last there are no words."""
    edge = (0, 0.0)
    near = [edge, *((n, linked / n) for _, n, linked, *_ in found), edge]
    return [(*near[i], *near[i - 1], *near[i + 1], int(f), int(a), x) for i, (_, _, _, f, a, x) in enumerate(found, 1)]


def main_text(page: str | None, tree) -> str:
    """The kept blocks of a page, joined by one space."""
    found = blocks(page or "")
    return " ".join(b[0] for b, row in zip(found, features(found), strict=True) if keeps(tree, row))


def fitted():
    table = np.array(LABELLED, float)
    return fit_tree(table[:, :-1], table[:, -1], depth=8)


def extract(pages: DataFrame, source: str = "html") -> DataFrame:
    """One row per page: page_id, url, text and n_chars (code points).

    * NULL or empty html, and pages without main text: empty text, 0.  NULL ids and urls stay.
    * White space in a block becomes one space; character references are decoded; nothing else of
      a kept block is changed or cut, whatever its length.  Repeated rows give repeated results.
    * Only page_id, url and the html are read; other columns may have any name.  Empty tables give no rows.
    """
    tree = fitted()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for (source_text,) in rows_of([b], "html"):
                texts = [main_text(x, tree) for x in source_text]
            yield pa.record_batch([*[b.column(b.schema.get_field_index(c)) for c in ("page_id", "url")], pa.array(texts, pa.string()),
                                   pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col(source).alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")
