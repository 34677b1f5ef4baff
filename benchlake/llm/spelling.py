"""Spelling variant grouping by reduced-alphabet generation.

1. Words are counted: per batch of documents, then by a partial aggregate.
2. Letters are hashed to a few symbols, so that a word becomes a reduced word.  Words one edit apart
   have reduced words at most one edit apart.
3. The full one-edit neighbourhood of every distinct reduced word (deletions, replacements,
   insertions and itself) is generated and joined with the reduced vocabulary.  Members are
   64-bit polynomial hashes, which a member's place and symbol change by one term, so a reduced word
   of L letters costs L times the symbols, not its square.  A bit array of fixed size, sent to every
   task, stops most members that no word has before they are shuffled; it never stops another.
4. Words of joined reduced words are verified on the original strings, inside the join.

The alphabet grows with the vocabulary (``symbols_for``): 5-letter words, the shortest ones, always
have at least as many reduced forms as there are words, so few words share one.

All joined tables grow with the vocabulary, and Spark sizes them too low: neighbourhoods by the words they
come from, written tables by their compressed files.  So every join is a merge join (``merged``) and none
is broadcast through the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import materialise

#: A run whose hash this number divides loses a letter; shortest word; fewest occurrences.
DIVISOR, MIN_LENGTH, MIN_COUNT = 97, 5, 3
#: Fewest and most symbols of the reduced alphabet, hashes generated at once.
SYMBOLS, HASHES_AT_ONCE = (4, 32), 1 << 19
#: log2 of the bits that say which hashes the reduced vocabulary has (4 MB).
PRESENT_BITS = 25
#: Base of the polynomial hash (odd, so that it has an inverse mod 2**64), and the step of the symbols' values.
BASE, STEP = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): runs of letters, some with a letter deleted, of at least MIN_LENGTH and MIN_COUNT."""
    src = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}")
        for b in batches:
            found: Counter = Counter()
            texts = pc.ascii_lower(pc.fill_null(b.column(b.schema.get_field_index("text")), ""))
            for key, lowered in zip(b.column(b.schema.get_field_index("doc_id")).to_pylist(), texts.to_pylist(), strict=True):
                start = zlib.crc32(f"{key or ''}:".encode())
                for run, n in Counter(runs.findall(lowered)).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % DIVISOR == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < MIN_LENGTH:
                            continue
                    found[run] += n
            yield pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    return src.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def symbols_for(words: int) -> int:
    """Symbols of the reduced alphabet: the fewest that give MIN_LENGTH letters ``words`` reduced forms."""
    least, most = SYMBOLS
    return next((s for s in range(least, most) if s ** MIN_LENGTH >= words), most)


def symbol(code: np.ndarray, symbols: int) -> np.ndarray:
    """The symbol of each code point: a multiplicative hash."""
    return (code.astype(np.uint64) * np.uint64(STEP) >> np.uint64(40)) % np.uint64(symbols)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time: their places, and their code points as a matrix."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    first = np.cumsum(size) - size
    for length in np.unique(size).tolist():
        at = np.flatnonzero(size == length)
        yield at, code[first[at][:, None] + np.arange(length)]


def powers(n: int) -> np.ndarray:
    """BASE ** 0, ..., BASE ** (n - 1) mod 2**64."""
    return np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), BASE, np.uint64)]).cumprod(dtype=np.uint64)


def values(symbols: int) -> np.ndarray:
    """The hash value of each symbol, odd numbers of 64 bits."""
    return (np.arange(1, symbols + 1, dtype=np.uint64) * np.uint64(STEP)) | np.uint64(1)


def keys(reduced: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of reduced words (a row of symbols each)."""
    return (values(symbols)[reduced] * powers(reduced.shape[1])).sum(1, dtype=np.uint64)


def neighbourhood(reduced: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of each reduced word itself and all strings one edit from it, row by row (some repeat)."""
    value, length = values(symbols), reduced.shape[1]
    power = powers(length + 1)
    term = value[reduced] * power[:length]
    before = np.concatenate([np.zeros((len(term), 1), np.uint64), term.cumsum(1, dtype=np.uint64)], 1)
    whole, after = before[:, -1:], before[:, -1:] - before
    inverse = np.uint64(pow(BASE, -1, 1 << 64))
    removed = before[:, :-1] + after[:, 1:] * inverse
    replaced = (whole - term)[:, :, None] + (power[:length, None] * value)[None]
    inserted = (before + after * np.uint64(BASE))[:, :, None] + (power[:, None] * value)[None]
    flat = len(reduced), -1
    return np.concatenate([whole, removed, replaced.reshape(flat), inserted.reshape(flat)], 1)


def with_keys(words: DataFrame, symbols: int) -> DataFrame:
    """``words`` (word, n) with the hash of each reduced word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, key = b.column(0).to_pylist(), np.zeros(b.num_rows, np.uint64)
            for at, code in by_length(texts):
                key[at] = keys(symbol(code, symbols), symbols)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(key.view(np.int64))], names=["word", "n", "key"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, key long")


def present(words: DataFrame, bits: int = PRESENT_BITS) -> np.ndarray:
    """A bit for the upper ``bits`` bits of each key, as 64-bit words (2 ** bits / 64 at most reach the driver)."""
    place = F.shiftrightunsigned("key", 64 - bits)
    found = words.groupBy(F.shiftright(place, 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("held")).toArrow()
    out = np.zeros(max(1, (1 << bits) >> 6), np.uint64)
    out[found["at"].to_numpy()] = found["held"].to_numpy().view(np.uint64)
    return out


def neighbours(reduced: DataFrame, symbols: int, held: np.ndarray) -> DataFrame:
    """(key, near_key): the neighbourhoods of the reduced words of ``reduced`` (word: one word of each),
    without members that ``held`` (see ``present``) rules out."""
    sent = reduced.sparkSession.sparkContext.broadcast(held)
    unused = np.uint64(65 - (len(held) << 6).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, code in by_length(b.column(0).to_pylist()):
                step = max(1, HASHES_AT_ONCE // (2 * symbols * (code.shape[1] + 1)))
                for k in range(0, len(code), step):
                    own = symbol(code[k:k + step], symbols)
                    near = neighbourhood(own, symbols)
                    place = near >> unused
                    kept = (sent.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
                    row, near = np.nonzero(kept)[0], near[kept]
                    pairs = np.unique(np.stack([keys(own, symbols)[row].view(np.int64), near.view(np.int64)], 1), axis=0)
                    yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["key", "near_key"])

    return reduced.select("word").mapInArrow(run, "key long, near_key long")


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a join's side that is sorted and merged, however small Spark takes it to be."""
    return df.hint("merge")


def near_words(words: DataFrame, symbols: int) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words that differ by one code point inserted,
    deleted or replaced; ``words`` has (word, n, key)."""
    variants = neighbours(words.groupBy("key").agg(F.min("word").alias("word")), symbols, present(words))
    left = words.select("word", "n", F.col("key").alias("own_key"))
    right = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("key").alias("other_key"))
    reached = variants.join(merged(right), F.col("near_key") == F.col("other_key")).select("key", "near", "near_n")
    return (left.join(merged(reached), (F.col("own_key") == F.col("key")) & (F.levenshtein("word", "near", 1) == 1))
            .select("word", "n", "near", "near_n"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) for (word, form) rows: forms followed to the last, by doubling the steps.

    A form is at least twice as frequent as its word, and ``most`` is the highest count, so a chain
    has at most log2(most) steps and log2 of that many rounds reach its end.
    """
    up = materialise(forms.select("word", F.col("form").alias("root")))
    for _ in range(max(1, most.bit_length()).bit_length()):
        ahead = up.select(F.col("word").alias("at"), F.col("root").alias("further"))
        up = materialise(up.join(merged(ahead), F.col("root") == F.col("at"), "left")
                         .select("word", F.coalesce("further", "root").alias("root")))
    return up


def group_variants(docs: DataFrame, text: str = "text", symbols: int | None = None) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    * Words: runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased; if 97 divides the CRC-32 h of
      ``<doc_id>:<run>``, the code point h % length goes.  Of those, the ones of at least 5 code
      points and 3 occurrences.
    * ``n_near``: words one edit apart; ``form``: the most frequent of them (ties: the smallest) if it is
      at least twice as frequent as the word; ``form_n``: its count; ``root``: the end of the forms.
    * NULL and empty texts have no words; a NULL doc_id counts as ''.  Repeated rows count again.
    * Only doc_id and the text are read; other columns may have any name.  Empty tables give no rows.
    """
    counted = materialise(count_words(docs, text))
    size, most = counted.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    chosen = symbols or symbols_for(size)
    words = materialise(with_keys(counted, chosen))
    best = (near_words(words, chosen).groupBy("word", "n")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    judged = materialise(best.select(F.col("word").alias("of"), "n_near", F.when(-F.col("best.less") >= 2 * F.col("n"), F.struct(
        F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("chosen"))
        .select("of", "n_near", "chosen.form", "chosen.form_n"))
    ends = roots(judged.where("form IS NOT NULL").select(F.col("of").alias("word"), "form"), most).withColumnRenamed("word", "end_of")
    return (words.join(merged(judged), F.col("word") == F.col("of"), "left")
            .join(merged(ends), F.col("word") == F.col("end_of"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
