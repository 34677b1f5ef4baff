"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A text is a sequence of words (lower-cased, without signs).  An item of w words is found in a
document when some passage is within ``max_edit`` * w word edits of it.

1. An item of more than ``PIECE`` words is searched by pieces of equal size, as the walk below
   loses step with length.  Of a passage within the bound at least one piece is within it too.
   Windows of each piece size start at every word.  A window within the bound has at most that
   many words that no item has, and holds a few of its piece's rarest words, as each edit
   removes one at most; windows that fail either are dropped (none within the bound is).
2. The CGK random walk reads a window: at each step it writes the current word and moves on if a
   random bit of (repetition, step, word) says so.  Edit distance becomes Hamming distance.  Each
   repetition samples a few steps of its own walk as the LSH key; pieces are embedded alike, and
   equal keys are candidates.  The number of repetitions follows from the target recall.
3. Each candidate is verified by the exact edit distance of the whole item to the best passage
   around it.

A document is handled whole in one row, so nothing is shuffled and hot sources or passages
don't matter.  The items are the query set: they are sent to the tasks in blocks of bounded size.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import by_slices, worker_cache

MAX_EDIT, RECALL, SAMPLES = 0.2, 0.99, 2
#: Chance that a sampled step agrees for a pair at the edit bound, of at most PIECE words (the
#: tests measure the recall that follows, by size and kind of edit).
AGREE, PIECE = 0.45, 32
#: Anchors of an item that its edits can't all remove, see Index.
ANCHORS = 3
#: Items of a block, text handled at once, and words kept by a worker.
BLOCK_ITEMS, BYTES_AT_ONCE, KEPT = 4000, 4 << 20, 400_000
_SIGNS = re.compile(r"[\W_]+")


def word(chunk: str) -> str:
    """A chunk between white space without signs, lower-cased; '' if nothing is left."""
    return chunk if chunk.isalpha() and chunk.islower() else _SIGNS.sub("", chunk.lower())


def words(text: str | None) -> list[str]:
    return [w for w in map(word, (text or "").split()) if w]


def repetitions(recall: float, agree: float, samples: int) -> int:
    """Repetitions after which a pair at the edit bound has shared a key with chance ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agree ** samples))


class Index:
    """The pieces of a block's items by size, with the keys of their embeddings."""

    def __init__(self, items: list[tuple[int, str]], max_edit: float, recall: float, samples: int):
        self.max_edit, self.samples = max_edit, samples
        self.reps = repetitions(recall, AGREE, samples)
        self.vocab: dict[str, int] = {}
        self.items = []  # (item_id, word numbers)
        for key, text in items:
            if w := words(text):
                self.items.append((key, np.array([self.vocab.setdefault(x, len(self.vocab) + 1) for x in w], np.uint32)))
        self.pieces = []  # (place in items, first word, word numbers)
        for k, (_, w) in enumerate(self.items):
            bounds = np.linspace(0, len(w), -(-len(w) // PIECE) + 1).astype(int).tolist()
            self.pieces += [(k, lo, w[lo:hi]) for lo, hi in zip(bounds, bounds[1:])]
        self.by_size = defaultdict(list)
        for k, (_, _, w) in enumerate(self.pieces):
            self.by_size[len(w)].append(k)
        self.widest = max(self.by_size, default=0)
        self._choose_anchors()
        self.sizes = np.array(sorted(self.by_size), np.int64)
        flat = np.concatenate([w for _, _, w in self.pieces]) if self.pieces else np.zeros(0, np.uint32)
        width = np.array([len(w) for _, _, w in self.pieces], np.int64)
        starts, kinds = np.cumsum(width) - width, np.searchsorted(self.sizes, width)
        self.walks = [self._walk(rep) for rep in range(self.reps)]
        self.keys = []
        for rep in range(self.reps if self.items else 0):
            keys = self.embed(flat, starts, kinds, rep)
            order = np.argsort(keys, kind="stable")
            self.keys.append((keys[order], order))

    def _choose_anchors(self) -> None:
        """By size: which words are anchors, and how many a window must hold.

        Of a piece's k + m rarest words, k edits leave at least m in place, so a window with
        fewer than m anchors of its size's pieces is beyond the bound."""
        used, length = np.zeros(len(self.vocab) + 1, np.int64), np.array([0, *map(len, self.vocab)])
        for _, w in self.items:
            used[np.unique(w)] += 1
        self.any_anchor, self.anchors = np.zeros(len(used), bool), {}
        for size, own in self.by_size.items():
            mark, least = np.zeros(len(used), bool), ANCHORS
            for k in own:
                distinct = np.unique(self.pieces[k][2])
                rarest = distinct[np.lexsort((-length[distinct], used[distinct]))][:self.allowed(size) + ANCHORS]
                mark[rarest] = True
                least = min(least, len(rarest) - self.allowed(size))
            if least < 1:  # a piece that repeats few words: every window may hold it
                mark[:], least = True, 1
            self.anchors[size] = mark, least
            self.any_anchor |= mark

    def allowed(self, size: int) -> int:
        return int(self.max_edit * size + 1e-9)

    def _walk(self, rep: int) -> tuple[np.ndarray, ...]:
        """The random choices of a repetition: hash factors by step, and the sampled steps by size."""
        rng = np.random.default_rng(rep)
        steps = 2 * max(self.widest, 1)
        factor = rng.integers(0, 1 << 31, steps, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        shift = rng.integers(0, 1 << 32, steps, dtype=np.uint32)
        sampled = [np.sort(rng.choice(2 * n, min(self.samples, 2 * n), replace=False)) for n in self.sizes]
        return factor, shift, np.array([np.resize(x, self.samples) for x in sampled]).reshape(-1, self.samples)

    def embed(self, flat: np.ndarray, starts: np.ndarray, kinds: np.ndarray, rep: int) -> np.ndarray:
        """The sampled steps of the walk over each window, as one key; ``kinds`` number the sizes."""
        factor, shift, sampled = self.walks[rep]
        last = sampled[kinds].max(axis=1, initial=0)
        order = np.argsort(-last, kind="stable")  # windows whose samples are all taken drop off the end
        at, kinds, last = starts[order], kinds[order], last[order]
        end, taken = at + self.sizes[kinds], sampled[kinds]
        key = kinds.astype(np.uint64)
        for step in range(int(last[0]) + 1 if len(last) else 0):
            n = int(np.searchsorted(-last, -step, "right"))
            inside = at[:n] < end[:n]
            sign = np.where(inside, flat[np.minimum(at[:n], len(flat) - 1)], np.uint32(0xFFFFFFFF))
            write = np.flatnonzero((taken[:n] == step).any(axis=1))
            new = (key[write] ^ sign[write]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step)
            key[write] = new ^ (new >> np.uint64(31))
            mixed = (sign ^ shift[step]) * factor[step]
            at[:n] += inside & (((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(31)).astype(bool)
        out = np.empty_like(key)
        out[order] = key
        return out

    def candidates(self, flat: np.ndarray) -> Iterator[tuple[int, int]]:
        """(piece, start) of the windows of ``flat`` that share a key with a piece.

        ``flat``: word numbers, 0 for words that no item has, and between documents at least as
        many zeros as the widest piece may have edits."""
        missed = np.concatenate([[0], np.cumsum(flat == 0, dtype=np.int32)])
        rare = np.flatnonzero(self.any_anchor[flat])
        every, kinds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for kind, size in enumerate(self.sizes.tolist()):
            anchors, least = self.anchors[size]
            starts = self._windows(rare[anchors[flat[rare]]], size, least, len(flat))
            starts = starts[missed[starts + size] - missed[starts] <= self.allowed(size)]
            every.append(starts)
            kinds.append(np.full(len(starts), kind))
        starts, kinds = np.concatenate(every), np.concatenate(kinds)
        found = set()
        for rep, (keys, owners) in enumerate(self.keys):
            own = self.embed(flat, starts, kinds, rep)
            lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            for hit in np.flatnonzero(hi > lo).tolist():
                found.update((int(k), int(starts[hit])) for k in owners[lo[hit]:hi[hit]])
        return iter(sorted(found))

    @staticmethod
    def _windows(at: np.ndarray, size: int, least: int, total: int) -> np.ndarray:
        """Starts of the windows of ``size`` words that hold ``least`` of the sorted places ``at``."""
        if len(at) < least:
            return np.zeros(0, np.int64)
        lo, hi = np.maximum(at[least - 1:] - size + 1, 0), np.minimum(at[:len(at) - least + 1], total - size)
        lo = np.maximum(lo, np.concatenate([[0], hi[:-1] + 1]))  # both rise, so this is their union
        n = np.maximum(hi - lo + 1, 0)
        return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def best_passage(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the passage of ``text`` nearest to ``item``; of equal ones the
    first to end, then the longest."""

    def last_row(a: np.ndarray, b: np.ndarray, anywhere: bool) -> np.ndarray:
        steps = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, np.int64) if anywhere else steps.copy()
        for i, x in enumerate(a, 1):
            new = np.empty_like(row)
            new[0] = i
            new[1:] = np.minimum(row[:-1] + (b != x), row[1:] + 1)
            row = np.minimum.accumulate(new - steps) + steps
        return row

    row = last_row(item, text, True)
    end = int(np.argmin(row))
    back = last_row(item[::-1], text[:end][::-1], False)
    start = end - int(len(back) - 1 - np.argmin(back[::-1]))
    return int(row[end]), start, end


def _numbers(index: Index, texts: pa.StringArray, known: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all chunks of all texts (-1: no word), and the chunk bounds of the texts."""
    split = pc.utf8_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    unique, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    if len(known) > KEPT:
        known.clear()
    vocab = index.vocab
    for c in [c for c in unique if c not in known]:
        w = word(c)
        known[c] = vocab.get(w, 0) if w else -1
    number = np.array([known[c] for c in unique], np.int32)
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    return (number[at] if len(at) else np.zeros(0, np.int32)), bounds


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The unions of touching spans, in order."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def search(index: Index, texts: pa.StringArray, known: dict[str, int]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, n_words) of each text's best passage for each item found in it.
    ``start`` counts the text's words from 0."""
    numbers, bounds = _numbers(index, texts, known)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    real = numbers >= 0
    numbers, owner = numbers[real], owner[real]
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    gap = index.allowed(index.widest) + 1
    place = np.arange(len(numbers)) + gap * (owner + 1)  # zeros before, between and after the texts
    flat = np.zeros(len(numbers) + gap * (len(texts) + 1), np.uint32)
    flat[place] = numbers
    begin = first[:-1] + gap * (np.arange(len(texts)) + 1)
    spans: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for piece, start in index.candidates(flat):
        k, offset, w = index.pieces[piece]
        item, near = index.items[k][1], index.allowed(len(w)) + 1  # a window may start so far off
        slack = index.allowed(len(item)) + (near if len(w) < len(item) else 1)
        d = int(np.searchsorted(begin, start + near, "right")) - 1
        for text in {max(d, 0), max(int(np.searchsorted(begin, start, "right")) - 1, 0)}:
            lo = max(start - offset - slack - int(begin[text]), 0)
            hi = min(start - offset + len(item) + slack - int(begin[text]), int(first[text + 1] - first[text]))
            if lo < hi:
                spans[text, k].append((lo, hi))
    out, seen = [], {}
    for (text, k), own in sorted(spans.items()):
        item, best = index.items[k][1], None
        for lo, hi in _merged(own):
            passage = numbers[first[text] + lo:first[text] + hi]
            asked = (k, passage.tobytes())
            if asked not in seen:
                seen[asked] = best_passage(item, passage)
            edits, start, end = seen[asked]
            if edits <= index.allowed(len(item)) and (best is None or (edits, start + lo) < best[:2]):
                best = (edits, start + lo, end - start)
        if best:
            out.append((text, index.items[k][0], *best))
    return out


def _slices(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Row ranges of about BYTES_AT_ONCE bytes each."""
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BYTES_AT_ONCE, side="right")))
        yield at, upto
        at = upto


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", max_edit: float = MAX_EDIT,
                 recall: float = RECALL, samples: int = SAMPLES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document row and item found in it: doc_id, item_id, edits, start_word, n_words
    (of the nearest passage) and item_words.

    * NULL and empty texts, and items without a word, match nothing.  Items of equal text are all
      reported; a NULL item_id or doc_id is reported as NULL.  Repeated rows are reported each.
    * Texts of any length are searched whole, as are items.  Of equally near passages the first counts.
    * Only the ids and texts are read; other columns may have any name.  Empty tables give no rows.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col(text).alias("text"))
    blocks = max(1, -(-items.count() // block_items))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    found = [_search_block(src, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k), max_edit, recall, samples)
             for k in range(blocks)]
    return reduce(DataFrame.unionByName, found)


def _search_block(src: DataFrame, items: DataFrame, max_edit: float, recall: float, samples: int) -> DataFrame:
    rows = [(r["item_id"], r["text"]) for r in items.collect()]  # a block of the query set
    sent = src.sparkSession.sparkContext.broadcast(rows)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("benchmark", hash(tuple(sent.value)), max_edit, recall, samples)
        index, known = worker_cache(key, lambda: (Index(sent.value, max_edit, recall, samples), {}))
        sizes = {i: len(w) for i, w in index.items}
        for b in batches:
            ids, texts = b.column(b.schema.get_field_index("doc_id")), b.column(b.schema.get_field_index("text"))
            for at, upto in _slices(texts):
                hits = search(index, texts[at:upto], known) if index.items else []
                if hits:
                    doc, item, edits, start, n = zip(*hits, strict=True)
                    yield pa.record_batch([ids.take(pa.array([d + at for d in doc], pa.int64())),
                                           pa.array(item, pa.int64()), pa.array(edits, pa.int32()), pa.array(start, pa.int64()),
                                           pa.array(n, pa.int64()), pa.array([sizes[i] for i in item], pa.int64())],
                                          names=["doc_id", "item_id", "edits", "start_word", "n_words", "item_words"])

    return src.mapInArrow(by_slices(find), "doc_id long, item_id long, edits int, start_word long, n_words long, item_words long")
