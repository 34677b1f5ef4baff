"""Quality rules: hashed n-gram log-likelihood ratio, beside fixed word and line counts.

Word unigrams and bigrams are hashed into cells, whose number follows the size of the corpus.  Two
multinomials are counted over them: one of the trusted target documents (all that are labelled good
and not toxic) and one of the raw corpus (every n-gram of every document).  A document's score is the
mean of log p_target / p_raw over its n-grams.

The trusted documents are two folds, and a document is scored by the fold that it isn't in, so one with
a label scores like one without.  The threshold is a low quantile of the trusted documents' scores,
found on all labels of the run; then it decides on every document.

Everything is DataFrame code.  Each document is one row throughout.  The shuffles are the partial
aggregate over the bounded number of cells and the distinct trusted ids, so none grows with a hot source
or a hot word.  Texts are shuffled once, to meet the trusted ids, only where these are more than ``BROADCAST_IDS``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import SPACE, materialise
from benchlake.operators.order_stats import kth_smallest_rows

#: Fewest and most cells of the n-gram hash.
BUCKETS = (1 << 14, 1 << 15)
#: Up to so many trusted ids are broadcast; more meet the documents by a shuffle (the result is the same).
BROADCAST_IDS = 1 << 20
#: Share of held-out trusted documents that may score below the threshold.
LOSS = 0.001
#: Up to so many repeated windows a lookup is used, beyond it a sort (the result is the same).
FEW = 32
#: Base rules: fewest words, and the highest percentage of words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept")


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator, which the optimiser doesn't inline into later lambdas
    (there they would be computed again for every element)."""
    names = list(columns)
    row = F.explode(F.array(F.struct(*[columns[n].alias(n) for n in names]))).alias("__held")
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, row).select(*kept, *[F.col(f"__held.{n}").alias(n) for n in names])


def words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text; none of NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__words`` and the counts n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words.

    NULL and empty texts have no words and all counts 0.  A window of three words is compared by
    a 64-bit hash; positions of equal windows come from one sort per document, so a text that
    repeats itself costs n log n, not n squared.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(raw, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    df = _held(docs, __words=words(F.col(text)), __lines=lines)
    joined = F.array_join("__words", "")
    df = _held(
        df,
        n_words=F.size("__words").cast("long"),
        word_chars=F.char_length(joined).cast("long"),
        n_symbols=F.regexp_count(joined, F.lit("[#*$%&|<>]")).cast("long"),
        n_dup_lines=(F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        __windows=F.slice(F.transform("__words", lambda w, i: F.xxhash64(
            w, F.get("__words", i + 1), F.get("__words", i + 2))), 1, F.greatest(F.size("__words") - 2, F.lit(0))),
    ).drop("__lines")
    # Hashes found twice or more.  Where they are few, a window looks itself up among them; else hash and
    # place are sorted together.  Both give the places of all repeated windows.
    df = _held(df, __ordered=F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.sort_array("__windows"))
               .otherwise(F.slice("__windows", 1, 0)))
    df = _held(df, __twice=F.array_distinct(F.filter("__ordered", lambda h, i: F.coalesce(F.get("__ordered", i + 1) == h, F.lit(False))))).drop("__ordered")
    few = F.filter(F.transform("__windows", lambda h, i: F.when(F.array_contains("__twice", h), i)), lambda i: i.isNotNull())
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = _held(df, __few=F.when(F.size("__twice").between(1, FEW), few).otherwise(F.array().cast("array<int>")),
               __sorted=F.when(F.size("__twice") > FEW, placed)).drop("__windows", "__twice")
    repeated = F.filter("__sorted", lambda x, k: (
        F.coalesce(F.when(k > 0, F.get("__sorted", k - 1)["h"]) == x["h"], F.lit(False))
        | F.coalesce(F.get("__sorted", k + 1)["h"] == x["h"], F.lit(False))))
    starts = F.coalesce(F.sort_array(F.transform(repeated, lambda x: x["i"])), F.col("__few"))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n"), (i + 3).alias("end")),
        lambda a: a["n"].cast("long"))
    return _held(df, n_repeat_words=covered).drop("__sorted", "__few")


def trusted(labels: DataFrame) -> DataFrame:
    """The distinct ids of all documents labelled good and not toxic, as ``__id``."""
    clean = F.col("toxic").eqNullSafe(0) if "toxic" in labels.columns else F.lit(True)
    return labels.where((F.col("quality") == 1) & clean & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__id")).distinct()


def _marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``__id``: the doc_id of a trusted document, NULL for all others."""
    good, on = trusted(labels), F.col("doc_id") == F.col("__id")
    if good.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(good), on, "left")
    # Rows without an id are left where they are; in the join they would all meet in one task.
    rest = docs.where("doc_id is null").withColumn("__id", F.lit(None).cast(good.schema["__id"].dataType))
    return docs.where("doc_id is not null").join(good, on, "left").unionByName(rest)


def _fold(doc_id: Column) -> Column:
    """Which half of the target a trusted document belongs to: 0 or 1."""
    return F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(2)).cast("int")


def cells_for(n_bytes: int) -> int:
    """Cells of the n-gram hash for a corpus of ``n_bytes``: a power of two, about one for 1 KB of text, within BUCKETS."""
    least, most = BUCKETS
    return min(most, max(least, 1 << max(0, n_bytes >> 10).bit_length()))


def log_ratios(docs: DataFrame, labels: DataFrame, text: str = "text", buckets: int | None = None,
               smoothing: float = 1.0) -> np.ndarray:
    """log p_target / p_raw of each cell, gathered on the driver: two rows of ``buckets`` numbers.

    Row f is for documents of fold f: its target are the trusted documents of the other fold, so that
    no document is scored by a model that holds its own label.  The raw counts cover every n-gram of
    ``docs``.  Both sides are smoothed by ``smoothing`` per cell.  Without a trusted document in one
    fold the other's target is used for both, and without any all ratios are 0.
    """
    src = docs.select("doc_id", F.col(text).alias("__text"))
    if buckets is None:
        buckets = cells_for(src.agg(F.coalesce(F.sum(F.octet_length("__text").cast("long")), F.lit(0))).first()[0])
    df = _marked(src, labels)
    df = _held(df.select(F.when(F.col("__id").isNotNull(), _fold(F.col("__id"))).alias("__fold"), "__text"), __words=words(F.col("__text")))
    pairs = df.select("__fold", F.explode(F.arrays_zip(F.col("__words").alias("w"), F.slice("__words", 2, 2147483647).alias("x"))).alias("p"))
    one, two = _cell(buckets, F.col("p.w")), F.when(F.col("p.x").isNotNull(), _cell(buckets, F.col("p.w"), F.col("p.x")))
    cells = pairs.select("__fold", F.explode(F.array(one, two)).alias("cell")).where("cell is not null")
    counted = cells.groupBy("cell").agg(*[F.count(F.when(F.col("__fold") == f, 1)).alias(f"t{f}") for f in (0, 1)], F.count(F.lit(1)).alias("r"))
    found = counted.toArrow()  # one row per cell, at most ``buckets``
    target, raw = np.zeros((2, buckets)), np.zeros(buckets)
    at = found["cell"].to_numpy()
    raw[at] = found["r"].to_numpy()
    for f in (0, 1):
        target[f, at] = found[f"t{1 - f}"].to_numpy()
    if not target.sum():
        return np.zeros((2, buckets))
    for f in (0, 1):
        if not target[f].sum():
            target[f] = target[1 - f]
    return (np.log((target + smoothing) / (target.sum(1, keepdims=True) + smoothing * buckets))
            - np.log((raw + smoothing) / (raw.sum() + smoothing * buckets)))


def _cell(buckets: int, *w: Column) -> Column:
    return F.pmod(F.xxhash64(*w), F.lit(buckets)).cast("int")


def _ratio_table(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """The ratios as two rows (__fold, __ratios), written to the checkpoint folder.

    They are joined by a broadcast.  As a literal they stood in the text of every plan, and the driver builds,
    logs and keeps those texts.  (A subquery isn't allowed inside lambdas.)"""
    rows = [(f, [float(f"{x:.6g}") for x in own]) for f, own in enumerate(ratios.tolist())]
    return materialise(docs.sparkSession.createDataFrame(rows, "__fold int, __ratios array<double>").coalesce(1))


def _with_score(docs: DataFrame, table: DataFrame, buckets: int) -> DataFrame:
    """``with_counts`` and the score of every row (doc_id, __text, ...)."""
    df = _held(with_counts(docs, "__text"), __f=F.coalesce(_fold(F.col("doc_id")), F.lit(0)))
    df = df.join(F.broadcast(table), F.col("__f") == F.col("__fold")).drop("__f", "__fold")

    def ratio(w: Column, i: Column) -> Column:
        x, r = F.get("__words", i + 1), F.col("__ratios")
        return F.get(r, _cell(buckets, w)) + F.when(x.isNotNull(), F.get(r, _cell(buckets, w, x))).otherwise(F.lit(0.0))

    n, total = F.col("n_words"), F.aggregate(F.transform("__words", ratio), F.lit(0.0), lambda a, x: a + x)
    failed = (n < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * n)
    return _held(df, score=F.when(n > 0, total / (F.lit(2) * n - 1)), base_failed=failed).drop("__words", "__ratios")


def _trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are trusted documents."""
    return _marked(docs, labels).where("__id is not null").drop("__id")


def threshold_of(scored: DataFrame) -> float | None:
    """The score that all but ``LOSS`` of the rows reach which pass the base rules, from all trusted
    documents (score by the other fold, base_failed); None without one.

    An exact quantile, interpolated between its two neighbours, which are found by counting in buckets:
    no task holds all scores."""
    values = materialise(scored.where(~F.col("base_failed")).select(F.col("score").alias("_v")))
    n, least, most = values.agg(F.count("_v"), F.min("_v"), F.max("_v")).first()
    if not n:
        return None
    at = (n - 1) * LOSS
    found = kth_smallest_rows(values, [], [(i, r, least, most, n) for i, r in enumerate((math.floor(at), math.ceil(at)))])
    low, high = (value for _, value, *_ in sorted(found))
    return low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", buckets: int | None = None,
          threshold: float | None = None,
          carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, the ``carry`` columns, the counts, score, base_failed and kept.

    * ``base_failed``: fewer than 50 words, or over half of the words in repeated windows.
    * ``score``: mean log ratio of the document's unigrams and bigrams; NULL without words.
    * ``kept``: not base_failed and score at least ``threshold`` (default: from held-out labels, see
      ``threshold_of``; without trusted documents the base rules alone decide).  For the default,
      rows that carry nothing are written to the checkpoint folder once with their scores.
    * NULL or empty text: no words, so base_failed.  A NULL doc_id is judged by its text and is
      never a trusted document.  Repeated rows are judged alike.  Only doc_id, the text and
      ``carry`` are read; other columns may have any name, and carried ones go under their own.
      A carried name that is also a result's is refused.  Empty tables give no rows.
    """
    if taken := set(carry) & {"doc_id", *RESULTS}:
        raise ValueError(f"carried columns named like results: {sorted(taken)}")
    carried = [F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)]
    src = docs.select("doc_id", F.col(text).alias("__text"), *carried)
    ratios = log_ratios(src, labels, "__text", buckets)
    scores = (_ratio_table(src, ratios), ratios.shape[1])
    df = _with_score(src, *scores).drop("__text")
    if threshold is None and carry:  # texts may be carried, so trusted rows are scored again rather than all written
        threshold = threshold_of(_with_score(_trusted_rows(src.select("doc_id", "__text"), labels), *scores))
    elif threshold is None:
        df = materialise(df)  # scored once, for the threshold and for the result
        threshold = threshold_of(_trusted_rows(df, labels))
    good = F.lit(True) if threshold is None else F.coalesce(F.col("score") >= threshold, F.lit(False))
    return df.select("doc_id", *[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)], *RESULTS[:-1], (~F.col("base_failed") & good).alias("kept"))
