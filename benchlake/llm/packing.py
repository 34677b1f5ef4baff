"""Best-fit packing by patterns and non-negative least squares.

Documents become token ids and an end id; longer ones are cut into pieces of ``capacity``.  Only
the histogram of piece lengths (at most ``capacity`` numbers) reaches the driver:

1. Lengths are rounded up to a grid of ``unit`` tokens.  Patterns are all ways to fill a sequence
   exactly with one, two or three grid lengths.
2. Non-negative least squares fits repeat counts of the patterns to the histogram; the counts
   are rounded down and filled with real lengths, the last place of a pattern with the longest
   piece that fits.
3. The residual pieces go, longest first, into the tightest gap that holds them, else into a new
   sequence.

Steps 2 and 3 handle runs of equal sequences, so they cost by distinct lengths, not by pieces.
Pieces are then numbered inside their length in parallel (no length is sorted in one task), and
the number decides the place: each length has ranges of numbers that belong to one place of a run.
"""

from __future__ import annotations

import bisect
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from benchlake.llm.common import by_slices, gapless_rank, materialise, worker_cache

CAPACITY, END_ID, UNIT = 4096, 1, 16
#: Text handled at once, and entries of a worker's caches; the chunks kept have 8 ids each on average at most.
BYTES_AT_ONCE, KEPT, KEPT_PIECES = 2 << 20, 600_000, 200_000
#: Fixed value: how the tokenizer file splits a normalised text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Kinds of bytes: white space, ASCII letters and digits, and signs that begin a piece after them.  No sign is
#: part of a special token or composes with another character.
SPACES, WORD, SIGN = 1, 2, 3
KIND = np.zeros(256, np.uint8)
KIND[[*b" \t\n\x0b\x0c\r"]], KIND[[*b".,!?;:#*$%&"]] = SPACES, SIGN
KIND[[c for c in range(128) if chr(c).isalnum()]] = WORD
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


class _Pieces(dict):
    """Token ids of pieces, as little-endian 32-bit bytes: the merges run on a piece's bytes written as letters."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {}  # of every byte that UTF-8 uses
        for c in map(chr, [*range(0x800), 0x800, *range(0x1000, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x10000)]):
            self.letters.update(zip(c.encode(), shown.pre_tokenize_str(c)[0][0], strict=True))

    def ids(self, piece: str) -> bytes:
        shown = piece if piece.isascii() and piece.isprintable() else "".join([self.letters[b] for b in piece.encode()])
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        self[piece] = ids = self.ids(piece)
        return ids


def _runs(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``flat[start:start + size]`` of every run, one after the other."""
    return flat[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())]


def _chunks(texts: pa.StringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The chunks of all texts, and the number of those before each text and in all.

    A chunk ends at white space, and where a sign follows an ASCII letter or digit or a letter of Latin-1.
    ASCII letters become lower-case, unless a special token's mark or a combining one is there, which
    could make a difference.
    """
    large = texts.cast(pa.large_binary())
    offsets = np.frombuffer(large.buffers()[1], np.int64)[large.offset:large.offset + len(large) + 1]
    data = np.frombuffer(large.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    kind = KIND[data]
    kept, first = kind != SPACES, np.zeros(len(data) + 1, bool)
    word = kind == WORD
    word[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    first[1:-1] = ~kept[:-1] | word[:-1] & (kind[1:] == SIGN)
    first[offsets - offsets[0]] = True
    first = first[:-1] & kept
    if not ((data == 0xCC).any() or ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any()):
        data = LOWER[data]
    data = data[kept]
    ends = np.append(np.flatnonzero(first[kept]), len(data))
    chunks = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data))
    return chunks, np.searchsorted(np.flatnonzero(first), offsets - offsets[0])


class Ids:
    """Token ids of whole texts.

    The tokenizer drops white space and splits at it, so a text's ids are those of its chunks
    (see ``_chunks``), one after the other, and each chunk's are those of its pieces, the runs that
    the tokenizer's own pattern splits off.  Both are kept.  A chunk is a number, which gives its ids in
    one array.  Chunks with other white space or a special token's mark are tokenized as they are.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.pieces = _Pieces(self.tokenizer.model)
        self._forget()

    def _forget(self) -> None:
        self.chunks: dict[str, int] = {}
        self.flat, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _normal(self, chunks: list[str]) -> list[str]:
        """The chunks as the tokenizer normalises them."""
        out = self.tokenizer.normalizer.normalize_str(" ".join(chunks)).split(" ") if chunks else []
        if len(out) != len(chunks):
            raise RuntimeError("the normaliser moved a space")
        return out

    def _learn(self, new: list[str]) -> None:
        """Number the chunks and keep their ids."""
        joined, odd = " ".join(new), []
        if "<|" in joined or joined.split() != new:
            odd = [c for c in new if "<|" in c or c.split() != [c]]
            new = list(set(new).difference(odd))
        plain, other = [], []
        for c in new:  # up to U+00FF nothing is composed, and lower case is one letter
            (plain if c.isascii() or max(c) <= "\xff" else other).append(c)
        pieces, alone = self.pieces, self.pieces.ids
        ids = [alone(c) if c.isalpha() else b"".join([pieces[p] for p in PIECES.findall(c)])
               for c in [*" ".join(plain).lower().split(), *self._normal(other)]]
        ids += map(self._whole, odd)
        first = len(self.chunks)
        self.chunks.update(zip(plain + other + odd, range(first, first + len(ids)), strict=True))
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
        self.size = np.concatenate([self.size, np.fromiter(map(len, ids), np.int64, len(ids)) // 4])

    def of(self, texts: pa.StringArray) -> list[np.ndarray]:
        """The ids of each text (none NULL)."""
        if not len(texts):
            return []
        if len(self.chunks) > KEPT or len(self.flat) > 8 * KEPT:
            self._forget()
        if len(self.pieces) > KEPT_PIECES:
            self.pieces.clear()
        chunks, bounds = _chunks(texts)
        coded = chunks.dictionary_encode()
        unique = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.chunks.get
        number = np.array([known(c, -1) for c in unique], np.int64)
        if len(new := np.flatnonzero(number < 0)):
            names = [unique[k] for k in new.tolist()]
            self._learn(names)
            number[new] = [known(c) for c in names]
        at = number[coded.indices.to_numpy()]
        own = self.size[at]
        taken = _runs(self.flat, (np.cumsum(self.size) - self.size)[at], own)
        bounds = np.append(0, np.cumsum(own))[bounds].tolist()
        return [taken[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _slices(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Row ranges of about BYTES_AT_ONCE bytes each."""
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, done + BYTES_AT_ONCE, side="right")))
        yield at, upto
        at = upto


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = worker_cache(("ids", tokenizer), lambda: Ids(tokenizer))
        for b in batches:
            keys = b.column(b.schema.get_field_index("doc_id")).to_pylist()
            texts = pc.fill_null(b.column(b.schema.get_field_index("text")), "")
            for at, upto in _slices(texts):
                out = []
                for key, own in zip(keys[at:upto], ids.of(texts[at:upto]), strict=True):
                    raw = own.tobytes() + end
                    for k, start in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[start:start + 4 * capacity]
                        out.append((key, k, start // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(by_slices(cut), "doc_id long, piece int, start long, length long, ids_crc32 long")


def patterns(cells: int) -> list[tuple[int, ...]]:
    """All non-increasing one-, two- and three-place fillings of ``cells`` grid cells."""
    two = [(cells - b, b) for b in range(1, cells // 2 + 1)]
    three = [(cells - b - c, b, c) for c in range(1, cells // 3 + 1) for b in range(c, (cells - c) // 2 + 1)]
    return [(cells,), *two, *three]


def nnls(a: np.ndarray, y: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """Non-negative least squares by an active set that grows by the steepest column.

    At most as many columns as ``a`` has rows are active, and only those are solved for: the matrix
    of all pairs of columns is never formed."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    small = 1e-9 * max(1.0, float(np.abs(y @ a).max(initial=0)))
    for _ in range(rounds):
        slope = (y - a[:, active] @ x[active]) @ a
        slope[active] = 0
        best = int(np.argmax(slope))
        if slope[best] <= small:
            break
        active[best] = True
        while True:
            own = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, own], y, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[own] = z
                break
            bad = z <= 0
            step = np.min(x[own][bad] / np.maximum(x[own][bad] - z[bad], 1e-300))
            x[own] += step * (z - x[own])
            active[own[bad & (x[own] <= 1e-9)]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


class _Lengths:
    """Counts of lengths that are left, with the longest one up to a limit."""

    def __init__(self, histogram: dict[int, int]):
        self.count = dict(histogram)
        self.sorted = sorted(k for k, n in histogram.items() if n)

    def longest(self, upto: int, least: int = 1) -> int | None:
        at = bisect.bisect_right(self.sorted, upto) - 1
        return self.sorted[at] if at >= 0 and self.sorted[at] >= least else None

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            self.sorted.pop(bisect.bisect_left(self.sorted, length))


def plan(histogram: dict[int, int], capacity: int = CAPACITY, unit: int = UNIT) -> list[tuple[tuple[int, ...], int]]:
    """Runs (lengths of the places, number of sequences) that hold every piece of the histogram."""
    left, runs = _Lengths(histogram), []
    cells = capacity // unit
    forms = patterns(cells)
    matrix = np.zeros((cells, len(forms)))
    for k, form in enumerate(forms):
        for c in form:
            matrix[c - 1, k] += 1
    grid = np.zeros(cells)
    for length, n in histogram.items():
        grid[min(cells, -(-length // unit)) - 1] += n
    repeats = np.floor(nnls(matrix, grid) + 1e-6).astype(np.int64)
    for k in np.argsort(-repeats, kind="stable"):
        todo = int(repeats[k])
        while todo > 0:
            chosen, room = [], capacity
            for i, c in enumerate(forms[k]):
                # a middle place takes its own cell; the last takes the longest piece that fits
                upto = room if i == len(forms[k]) - 1 else min(room, c * unit)
                free = left.longest(upto, (c - 1) * unit + 1)
                while free is not None and left.count[free] <= chosen.count(free):
                    free = left.longest(free - 1, (c - 1) * unit + 1)
                if free is None:
                    break
                chosen.append(free)
                room -= free
            if len(chosen) < len(forms[k]):
                break
            n = min([todo, *(left.count[x] // chosen.count(x) for x in set(chosen))])
            for x in set(chosen):
                left.take(x, n * chosen.count(x))
            runs.append((tuple(chosen), n))
            todo -= n
    return _best_fit(runs, left, capacity)


def _best_fit(runs, left: _Lengths, capacity: int):
    """Residual pieces, longest first, into the tightest gap or a new sequence."""
    gaps: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for lengths, n in runs:
        gaps[capacity - sum(lengths)][lengths] += n
    order = sorted(gaps)
    for length in reversed(left.sorted):
        todo = left.count[length]
        while todo:
            at = bisect.bisect_left(order, length)
            if at == len(order):  # new sequences, as full as this length makes them
                fit = capacity // length
                for size, n in ((fit, todo // fit), (todo % fit, 1)):
                    if size and n:
                        gap = capacity - size * length
                        if gap not in gaps:
                            bisect.insort(order, gap)
                        gaps[gap][(length,) * size] += n
                break
            gap = order[at]
            lengths, n = gaps[gap].popitem()
            used = min(n, todo)
            if used < n:
                gaps[gap][lengths] = n - used
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            if gap - length not in gaps:
                bisect.insort(order, gap - length)
            gaps[gap - length][(*lengths, length)] += used
            todo -= used
    return [(lengths, n) for gap in sorted(gaps) for lengths, n in sorted(gaps[gap].items())]


def places(runs: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length: rows (first number, first sequence, sequences, offset) of the ranges of numbers, in order."""
    out, used, first = defaultdict(list), defaultdict(int), 0
    for lengths, n in runs:
        offset = 0
        for x in lengths:
            out[x].append((used[x], first, n, offset))
            used[x] += n
            offset += x
        first += n
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
         unit: int = UNIT) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    * A document is its token ids and ``end_id``; a NULL or empty text is the end id alone.
    * Documents longer than ``capacity`` are cut into pieces of it, the last may be shorter.
    * Sequences hold whole pieces, without gaps from offset 0.  Pieces of one length are
      interchangeable, so ties and repeated rows have no effect on the number of sequences.
    * Only doc_id and the text are read; other columns may have any name.  Empty tables give no rows.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    cut = materialise(token_pieces(src, tokenizer, capacity, end_id))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = cut.sparkSession.sparkContext.broadcast(places(plan(histogram, capacity, unit)) if histogram else {})
    ranked = gapless_rank(cut, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "rank")
    names = cut.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = where.value
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                ranges = table[int(x)]
                k = np.searchsorted(ranges[:, 0], rank[at], side="right") - 1
                sequence[at] = ranges[k, 1] + rank[at] - ranges[k, 0]
                offset[at] = ranges[k, 3]
            yield pa.record_batch([*[b.column(b.schema.get_field_index(c)) for c in names], pa.array(sequence), pa.array(offset)],
                                  names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, cut.schema.add("sequence_id", "long").add("offset", "long"))
