"""Column expressions for text cleaning, ids, choices and decoding (all JVM-side, codegen-able).

Unicode notes (the behaviour to match is Python's ``str`` methods):

* Python ``str.strip()``/``split()`` use ``str.isspace()``: the Unicode separators (category Z),
  the ASCII controls TAB..CR, the information separators U+001C..U+001F and NEL (U+0085).
  ``F.trim`` strips only U+0020, so a regex class is used instead.
* Python's ``\\w`` is Unicode letters, numbers and underscore; Java's ``\\w`` is ASCII only, so
  the word class is spelled ``\\p{L}\\p{N}_``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python treats as whitespace, as a Java regex class body.
WS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"
_STRIP_RE = rf"^[{WS}]+|[{WS}]+\z"
_NON_WORD_RE = rf"[^\p{{L}}\p{{N}}_{WS}]"
_SPLIT_RE = rf"[{WS}]+"
_EDGE_RE = rf"^[{WS}]$"

# English articles dropped by answer normalisation.
ARTICLES = ["a", "an", "the"]

# Fixed value: end-of-reasoning marker some model servers leave in the reply text
# (the marker is followed by a lowercase hex id and two underscores).
REASONING_MARKER = "__LM_STUDIO_INTERNAL_LSEP_SYNTHETIC_REASONING_END_"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace.

    The regex runs only when the first or last character is whitespace, so the common case
    costs two one-character checks instead of a scan of the whole (possibly very long) text.
    """
    x = col_(c)
    edge = F.substring(x, 1, 1).rlike(_EDGE_RE) | F.substring(x, -1, 1).rlike(_EDGE_RE)
    return F.when(edge, F.regexp_replace(x, _STRIP_RE, "")).otherwise(x)


def normalise(c: Column | str) -> Column:
    """Answer normalisation: lower-case, drop punctuation (anything but letters, numbers,
    underscore, whitespace), split on whitespace, drop the articles, re-join with one space."""
    cleaned = F.regexp_replace(F.lower(col_(c)), _NON_WORD_RE, "")
    words = F.split(cleaned, _SPLIT_RE)
    kept = F.filter(words, lambda w: (w != F.lit("")) & ~w.isin(*ARTICLES))
    return F.array_join(kept, " ")


def strip_reasoning(c: Column | str, marker: str = REASONING_MARKER) -> Column:
    """Delete everything up to and including the *last* reasoning marker, then strip.

    The pattern is anchored at the start, so a text without a marker costs one linear scan
    (an unanchored ``.*marker`` would retry from every position: quadratic on long texts).
    """
    pattern = "(?s)^.*" + re.escape(marker) + "[0-9a-f]+__"
    return strip(F.regexp_replace(col_(c), pattern, ""))


def question_id(category: Column | str, question: Column | str) -> Column:
    """First 16 hex digits of SHA-256 of ``category::question`` (UTF-8)."""
    return F.substring(F.sha2(F.concat(col_(category), F.lit("::"), col_(question)), 256), 1, 16)


def json_answers(c: Column | str) -> Column:
    """JSON array text -> array of stripped, non-blank strings."""
    arr = F.from_json(col_(c), "array<string>")
    return F.filter(F.transform(arr, strip), lambda x: x != F.lit(""))


def choices(qid: Column | str, incorrect_json: Column | str, correct: Column | str) -> Column:
    """Wrong answers (stripped, blanks dropped) plus the right answer, in an order fixed by the
    question id: sorted by SHA-256 of ``id::choice``.  Same multiset as the input, the same
    order on every run and every partitioning."""
    items = F.concat(json_answers(incorrect_json), F.array(strip(correct)))
    keyed = F.transform(
        items, lambda x: F.struct(F.sha2(F.concat(col_(qid), F.lit("::"), x), 256).alias("k"), x.alias("v"))
    )
    return F.transform(F.array_sort(keyed), lambda s: s["v"])


def b64decode(c: Column | str) -> Column:
    """Base64 text -> UTF-8 text; NULL for malformed base64 or UTF-8 instead of failing the job."""
    return F.try_validate_utf8(F.try_to_binary(col_(c), F.lit("base64")).cast("string"))


def b64encode(c: Column | str) -> Column:
    return F.base64(F.encode(col_(c), "UTF-8"))
