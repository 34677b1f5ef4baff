"""Cross-tokenizer alignment: the token ends of two tokenizers merged by merge-path pieces.

Both tokenizers cut the bytes of space + text.  Offsets where tokens of both end cut the tokens into
groups; tokens of A and B in one group are linked.

1. Encoding.  Chunks between single spaces are encoded once and kept, because both tokenizers cut
   before every single space.  Texts with other runs of white space are encoded as a whole.
2. Merging.  The ends of A and B, of some 2 MB of documents at a time, are two sorted lists.  Binary
   searches along diagonals divide their merge into pieces of equal work.  Each piece finds the
   ends that A and B share inside it; a shared end that a border separates is stitched.
3. Counts.  Distinct pairs per document are counted over the corpus (partial aggregates).  The pairs
   of most documents, at most ``hot_pairs`` of them, and the highest count of each A id travel to
   the tasks as arrays; every other pair is in few documents, so its rows are joined without a hot key.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from benchlake.llm.common import materialise, worker_cache

#: Ends merged by one piece, text and links handled at once, entries of a worker's cache.
WORK, BYTES_AT_ONCE, LINKS_AT_ONCE, KEPT = 1 << 16, 2 << 20, 1 << 21, 300_000
#: Pairs of most documents that travel to every task (16 bytes each).
HOT_PAIRS = 1 << 18
#: Bits of an id in a pair's key.
BITS = 20
ALIGNED = ("doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<long>")
PLAIN, DIFFERS, WHOLE = 0, 1, 2


def byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the
    others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Pair:
    """Tokens of both tokenizers: ids of texts, and the bytes of every id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(map(letters.__getitem__, token)) if all(c in letters for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.size_a = np.array(list(map(len, self.bytes_a)))
        self.size_b = np.array(list(map(len, self.bytes_b)))
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << BITS:
            raise ValueError(f"ids of more than {BITS} bits")
        inside = any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.by_chunk = not inside  # no piece of B goes on after a space, so a single space is a cut
        seps = (",", "|", ";", "")
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.most, self.shown = most, np.array([f"{i}{s}" for s in seps for i in range(most)], object)
        self.chunks: dict[str, tuple[int, bytes, bytes]] = {}

    def encode(self, texts: list[str]) -> list[tuple[int, bytes, bytes]]:
        """(state, ids of A, ids of B as 32-bit bytes) of space + text; DIFFERS if bytes are not kept."""
        out = []
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        for t, a, b in zip(texts, ids_a, self.b.encode(texts, num_threads=1), strict=True):
            raw = (" " + t).encode()
            same = b"".join([self.bytes_a[i] for i in a]) == raw == b"".join([self.bytes_b[i] for i in b])
            out.append((PLAIN, np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes()) if same else (DIFFERS, b"", b""))
        return out

    def learn(self, new: list[str]) -> None:
        if len(self.chunks) + len(new) > KEPT:
            self.chunks = {}
        alone = [c for c in new if self.by_chunk and c and c[0] != " " and c[0].isprintable() and c[-1].isprintable()]
        self.chunks.update(zip(alone, self.encode(alone), strict=True))
        for c in new:
            self.chunks.setdefault(c, (WHOLE, b"", b""))

    def tokens(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B over all texts, and the number of each in every text (none: 0)."""
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        unique, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().copy()
        kept = self.chunks
        if new := [c for c in unique if c not in kept]:
            kept = dict.fromkeys(unique)
            kept.update((c, self.chunks[c]) for c in unique if c in self.chunks)
            self.learn(new)
            kept.update((c, self.chunks[c]) for c in new)
        entries = [kept[c] for c in unique]
        starts = split.offsets.to_numpy() - split.offsets[0].as_py()
        doc = np.repeat(np.arange(len(texts)), np.diff(starts))
        state = np.maximum.reduceat(np.array([e[0] for e in entries], np.int8)[at], starts[:-1])
        use = state[doc] == PLAIN
        whole = [k for k in np.flatnonzero(state == WHOLE).tolist() if texts[k].as_py()]
        for k in whole:  # one entry stands for the whole text
            at[starts[k]], use[starts[k]] = len(entries), True
            entries += self.encode([texts[k].as_py()])
        at, doc = at[use], doc[use]
        out = []
        for side in (1, 2):
            ids = [e[side] for e in entries]
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            first, flat = np.cumsum(size) - size, np.frombuffer(b"".join(ids), "<u4")
            own = size[at]
            ends = np.cumsum(own)
            total = int(ends[-1]) if len(ends) else 0
            out.append(flat[np.repeat(first[at] - ends + own, own) + np.arange(total)].astype(np.int64))
            out.append(np.bincount(doc, own, len(texts)).astype(np.int64))
        return out[0], out[2], out[1], out[3]


def diagonals(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j), i + j a multiple of ``work``, where the merge of the sorted ``a`` and ``b`` (on
    ties ``a`` first) is divided: a binary search along every diagonal, all of them at once."""
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        before = np.zeros(len(d), bool)
        before[open_] = a[mid[open_]] <= b[d[open_] - 1 - mid[open_]]
        low, high = np.where(before, mid + 1, low), np.where(open_ & ~before, mid, high)
    return low, d - low


def shared_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One piece: the places in ``a`` and ``b`` of the ends that both hold."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(b, a)
    found = np.flatnonzero(b[np.minimum(at, len(b) - 1)] == a)
    return found, at[found]


def cuts(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tokens of A and of B up to each shared end, from the pieces, stitched."""
    i, j = diagonals(a, b, work)
    in_a, in_b = [], []
    for k in range(len(i) - 1):
        x, y = shared_ends(a[i[k]:i[k + 1]], b[j[k]:j[k + 1]])
        in_a.append(x + i[k])
        in_b.append(y + j[k])
        # the border separates equal ends: A's is the last of this piece, B's the first of the next
        if 0 < i[k + 1] and j[k + 1] < len(b) and a[i[k + 1] - 1] == b[j[k + 1]]:
            in_a.append(i[k + 1:k + 2] - 1)
            in_b.append(j[k + 1:k + 2])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(none + in_a) + 1, np.concatenate(none + in_b) + 1


def _counted(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.zeros(len(key), np.int64)
    np.add.at(n, at, np.concatenate(times))
    return key, n


def linked(a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, A id, B id) of all links as sorted keys, and the number of links of each.

    Links are made ``LINKS_AT_ONCE`` at a time.  A group with more is reduced to its distinct ids first.
    """
    start_a, start_b = end_a - np.diff(end_a, prepend=0), end_b - np.diff(end_b, prepend=0)
    n_a, n_b = end_a - start_a, end_b - start_b
    size = n_a * n_b
    keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    small = np.flatnonzero(size <= LINKS_AT_ONCE)
    block = np.cumsum(size[small]) // LINKS_AT_ONCE
    for at in np.split(small, np.flatnonzero(np.diff(block)) + 1) if len(small) else ():
        per_a = np.repeat(n_b[at], n_a[at])  # links of each token of A
        token_a = np.repeat(start_a[at] - np.cumsum(n_a[at]) + n_a[at], n_a[at]) + np.arange(len(per_a))
        ends = np.cumsum(per_a)
        token_b = np.repeat(np.repeat(start_b[at], n_a[at]) - ends + per_a, per_a) + np.arange(int(ends[-1]))
        first = np.repeat(np.repeat(doc[at], n_a[at]) << 2 * BITS | a[token_a] << BITS, per_a)
        key, n = np.unique(first | b[token_b], return_counts=True)
        keys.append(key)
        times.append(n)
    for g in np.flatnonzero(size > LINKS_AT_ONCE).tolist():
        ids_a, of_a = np.unique(a[start_a[g]:end_a[g]], return_counts=True)
        ids_b, of_b = np.unique(b[start_b[g]:end_b[g]], return_counts=True)
        step = max(1, LINKS_AT_ONCE // len(ids_b))
        for k in range(0, len(ids_a), step):
            keys.append(((doc[g] << 2 * BITS | ids_a[k:k + step] << BITS)[:, None] | ids_b).ravel())
            times.append((of_a[k:k + step, None] * of_b).ravel())
    return _counted(keys, times)


def digests(pair: Pair, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, last: np.ndarray,
            tokens: np.ndarray) -> list[str]:
    """SHA-256 of every text's groups, written 'a1,a2|b1;a3|b2,b3'; '' without tokens.

    ``last``: whether a group is its text's last; ``tokens``: tokens of A and B of every text."""
    start_a, start_b = end_a - np.diff(end_a, prepend=0), end_b - np.diff(end_b, prepend=0)
    code = np.zeros(len(a) + len(b), np.int64)
    code[np.arange(len(a)) + np.repeat(start_b, end_a - start_a)] = a
    code[np.arange(len(b)) + np.repeat(end_a, end_b - start_b)] = b
    code[end_a + start_b - 1] += pair.most  # '|' after the last of A
    code[end_a + end_b - 1] += np.where(last, 3, 2) * pair.most  # ';', or nothing at the text's end
    shown, out, at = pair.shown.take(code).tolist(), [], 0
    for n in tokens.tolist():
        out.append(hashlib.sha256("".join(shown[at:at + n]).encode()).hexdigest() if n else "")
        at += n
    return out


def align_texts(pair: Pair, texts: pa.StringArray, work: int = WORK) -> list[pa.Array]:
    """Columns n_a, n_b, n_groups, n_links, groups_sha256, pairs, times of ``texts`` (none NULL)."""
    a, b, n_a, n_b = pair.tokens(texts)
    end_a, end_b = cuts(np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b]), work)
    doc = np.searchsorted(np.cumsum(n_a), end_a)  # of each group
    groups = np.bincount(doc, minlength=len(texts))
    links = np.bincount(doc, np.diff(end_a, prepend=0) * np.diff(end_b, prepend=0), len(texts)).astype(np.int64)
    sha = digests(pair, a, b, end_a, end_b, np.diff(doc, append=len(texts)) > 0, n_a + n_b)
    key, times = linked(a, b, end_a, end_b, doc)
    bounds = np.searchsorted(key, np.arange(len(texts) + 1) << 2 * BITS).astype(np.int32)
    values = key & ((1 << 2 * BITS) - 1)
    return [pa.array(n_a), pa.array(n_b), pa.array(groups), pa.array(links), pa.array(sha),
            *[pa.ListArray.from_arrays(pa.array(bounds), pa.array(v)) for v in (values, times)]]


def slices(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Row ranges of about BYTES_AT_ONCE bytes each."""
    total, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BYTES_AT_ONCE, side="right")))
        yield at, upto
        at = upto


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Counts, digest and distinct pairs of every row (doc_id, row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = worker_cache(("pair", path_a, path_b), lambda: Pair(path_a, path_b))
        for batch in batches:
            doc_id, row, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "row", "text"))
            texts = pc.fill_null(texts, "")
            for at, upto in slices(texts):
                yield pa.record_batch([doc_id[at:upto], row[at:upto], *align_texts(pair, texts[at:upto])], names=[
                    "doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return docs.mapInArrow(run, ALIGNED)


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    * ``n_links``: all pairs of an A and a B token of one group, repeated ids included.
    * A pair of ids counts the rows that hold it linked; rows that repeat a doc_id or a text count
      each.  ``count_sum`` adds the counts of a row's links; ``n_best`` is the number of links whose
      count is the highest of their A id, ties included.
    * NULL and empty texts, and texts whose bytes a tokenizer doesn't keep, have no tokens: zeros and ''.
    * A NULL doc_id is a row like others.  Only doc_id and the text are read; other columns may have
      any name.  Empty tables give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    table = materialise(aligned(rows, path_a, path_b))
    counts = materialise(table.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    # The bound of the hot pairs' counts: a power of two that at most ``hot_pairs`` pairs reach.
    levels = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    least, room = 62, hot_pairs
    for level, pairs in sorted(levels, reverse=True):
        if pairs > room:
            break
        least, room = level, room - pairs
    hot = counts.where(F.col("n") >= (1 << least)).orderBy("pair").toArrow()
    best = counts.groupBy(F.shiftright("pair", BITS).alias("a")).agg(F.max("n").alias("most")).toArrow()  # a row per A id
    top = np.zeros(max([0, *best["a"].to_pylist()]) + 1, np.int64)
    top[best["a"].to_numpy()] = best["most"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast((hot["pair"].to_numpy(), hot["n"].to_numpy(), top))
    kept = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, most = sent.value
        for batch in batches:
            pairs, times = (batch.column(batch.schema.get_field_index(c)) for c in ("pairs", "times"))
            bounds = pairs.offsets.to_numpy() - pairs.offsets[0].as_py()
            pair, times = pairs.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.minimum(np.searchsorted(keys, pair), max(0, len(keys) - 1))
            found = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            count = np.where(found, n[at] if len(n) else 0, 0)
            is_best = found & (count == most[pair >> BITS])
            summed = [np.diff(np.concatenate([[0], np.cumsum(v)])[bounds]) for v in (times * is_best, times * count)]
            rest = np.concatenate([[0], np.cumsum(~found)])[bounds].astype(np.int32)
            cold = [pa.ListArray.from_arrays(pa.array(rest), pa.array(v[~found])) for v in (pair, times)]
            yield pa.record_batch([*[batch.column(batch.schema.get_field_index(c)) for c in kept], *map(pa.array, summed), *cold],
                                  names=[*kept, "hot_best", "hot_sum", "pairs", "times"])

    judged = materialise(table.mapInArrow(score, ALIGNED.replace("groups_sha256 string,", "groups_sha256 string, hot_best long, hot_sum long,")))
    cold = judged.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    highest = F.broadcast(docs.sparkSession.createDataFrame(best.to_pandas(), "a long, most long"))
    few = counts.where(F.col("n") < (1 << least)).withColumnRenamed("pair", "own")
    few = few.join(highest, F.shiftright("own", BITS) == F.col("a"))
    sums = (cold.join(few, F.col("pairs") == F.col("own")).groupBy(F.col("row").alias("of"))
            .agg(F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("cold_best"),
                 F.sum(F.col("times") * F.col("n")).alias("cold_sum")))
    zero = F.lit(0).cast("long")
    return judged.join(sums, F.col("row") == F.col("of"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("hot_best") + F.coalesce("cold_best", zero)).alias("n_best"),
        (F.col("hot_sum") + F.coalesce("cold_sum", zero)).alias("count_sum"), "groups_sha256")
