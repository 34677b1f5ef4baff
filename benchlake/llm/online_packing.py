"""Bounded-space online packing: a fixed number of open windows a partition, merged at the end.

Documents arrive one after the other.  Each partition keeps at most ``windows`` open windows:

1. A document goes whole into the window that it leaves fullest (best fit); a window that is full is
   emitted.
2. If none has room and fewer than ``windows`` are open, it opens a new one.
3. Otherwise the fullest window is emitted.  Tokens may be cut freely, so the head of the arriving
   document first fills the gap of that window, which then needs no padding; the rest goes on with 1.

What a partition leaves open, at most ``windows`` windows of ids, is merged in rounds: groups of
``fan_in`` neighbours pack their leftover windows, largest first, by the same rules and leave
``windows`` open ones again.  The last group joins its few windows and cuts them at ``capacity``; the
rest, shorter than a sequence, goes into sequences whose lengths are powers of two, which need no
padding either.  Nothing is sorted, and no task holds more than ``fan_in * windows`` windows.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import materialise, worker_cache
from benchlake.llm.packing import END_ID, Ids, _slices

CAPACITY, WINDOWS, FAN_IN = 2048, 32, 8
#: Rows of the result, and of what is still open: those carry their ids, by partition and window.
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
SCHEMA = PIECE + ", part long, ids binary"
TYPES = [pa.int64()] * 8 + [pa.binary()]
NAMES = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]

#: (doc_id, first token, ids as little-endian 32-bit bytes (a view, so that cutting copies nothing), tokens of the document)
Part = tuple[int | None, int, memoryview, int]


def split(parts: list[Part], tokens: int) -> tuple[list[Part], list[Part]]:
    """The first ``tokens`` tokens of a run of parts, and the rest."""
    head, at = [], 0
    for doc, start, ids, size in parts:
        n = len(ids) // 4
        if n <= tokens:
            head.append((doc, start, ids, size))
            tokens, at = tokens - n, at + 1
            continue
        if not tokens:
            break
        head.append((doc, start, ids[:4 * tokens], size))
        return head, [(doc, start + tokens, ids[4 * tokens:], size), *parts[at + 1:]]
    return head, parts[at:]


class Windows:
    """At most ``limit`` open windows; ``done`` collects the rows of emitted ones."""

    def __init__(self, capacity: int, limit: int, first_id: int):
        self.capacity, self.limit, self.next_id = capacity, limit, first_id
        self.gaps: list[tuple[int, int]] = []  # (gap, window), sorted
        self.parts: dict[int, list[Part]] = {}
        self.opened = 0
        self.done: list[tuple] = []

    def emit(self, parts: list[Part]) -> None:
        offset = 0
        for doc, start, ids, size in parts:
            n = len(ids) // 4
            self.done.append((doc, start, n, zlib.crc32(ids), size, self.next_id, offset, None, None))
            offset += n
        self.next_id += 1

    def add(self, parts: list[Part], size: int) -> None:
        """Place a run of parts of ``size`` tokens."""
        while size >= self.capacity:
            head, parts = split(parts, self.capacity)
            self.emit(head)
            size -= self.capacity
        while size:
            at = bisect.bisect_left(self.gaps, (size, -1))
            if at < len(self.gaps):
                gap, window = self.gaps.pop(at)
                self.parts[window] += parts
                if gap == size:
                    self.emit(self.parts.pop(window))
                else:
                    bisect.insort(self.gaps, (gap - size, window))
                return
            if len(self.gaps) < self.limit:
                bisect.insort(self.gaps, (self.capacity - size, self.opened))
                self.parts[self.opened] = list(parts)
                self.opened += 1
                return
            gap, window = self.gaps.pop(0)
            head, parts = split(parts, gap)
            self.emit(self.parts.pop(window) + head)
            size -= gap

    def finish(self) -> None:
        """Join the open windows: whole sequences, then lengths that are powers of two."""
        parts = [p for _, w in self.gaps for p in self.parts[w]]
        left = sum(len(p[2]) // 4 for p in parts)
        while left:
            n = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            head, parts = split(parts, n)
            self.emit(head)
            left -= n
        self.gaps, self.parts = [], {}

    def leftover(self, part: int) -> list[tuple]:
        """Rows of the open windows of partition ``part``; sequence_id numbers the window."""
        rows = []
        for window, parts in self.parts.items():
            offset = 0
            for doc, start, ids, size in parts:
                rows.append((doc, start, len(ids) // 4, None, size, window, offset, part, bytes(ids)))
                offset += len(ids) // 4
        return rows


def table(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(NAMES)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], names=NAMES)


def first_pass(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, windows: int) -> DataFrame:
    """Every partition's emitted pieces, and its leftover windows with their ids."""
    end = int(end_id).to_bytes(4, "little")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = worker_cache(("ids", tokenizer), lambda: Ids(tokenizer))
        part = TaskContext.get().partitionId()
        own = Windows(capacity, windows, part << 32)
        for b in batches:
            keys = b.column(b.schema.get_field_index("doc_id")).to_pylist()
            texts = pc.fill_null(b.column(b.schema.get_field_index("text")), "")
            for at, upto in _slices(texts):
                for key, found in zip(keys[at:upto], ids.of(texts[at:upto]), strict=True):
                    size = len(found) + 1
                    own.add([(key, 0, memoryview(found.tobytes() + end), size)], size)
                yield table(own.done)
                own.done = []
        yield table(own.leftover(part))

    return docs.mapInArrow(place, SCHEMA)


def merge(left: DataFrame, parts: int, capacity: int, windows: int, fan_in: int, level: int) -> DataFrame:
    """One round: leftover windows of ``fan_in`` neighbouring partitions packed together."""
    last, base = parts <= fan_in, level << 56

    def together(key: tuple, group: pa.Table) -> pa.Table:
        into = key[0].as_py()
        own = Windows(capacity, windows, base + (into << 32))
        runs: dict[tuple[int, int], list[Part]] = {}
        rows = group.sort_by([("part", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        for doc, start, size, part, window, ids in zip(*(rows.column(c).to_pylist() for c in (
                "doc_id", "start", "doc_tokens", "part", "sequence_id", "ids")), strict=True):
            runs.setdefault((part, window), []).append((doc, start, memoryview(ids), size))
        sized = sorted(((sum(len(p[2]) // 4 for p in run), at) for at, run in runs.items()), key=lambda x: (-x[0], x[1]))
        for size, at in sized:
            own.add(runs[at], size)
        if last:
            own.finish()
        return pa.Table.from_batches([table(own.done + own.leftover(into))])

    dealt = left.withColumn("into", F.floor(F.col("part") / fan_in).cast("long")).repartition(-(-parts // fan_in), "into")
    return dealt.groupBy("into").applyInArrow(together, SCHEMA)


def pack(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
         windows: int = WINDOWS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    * A document is its token ids and ``end_id``; a NULL or empty text is the end id alone.
    * Every token lies in one piece.  A sequence holds ``capacity`` tokens; only the last ones of the
      whole table are shorter, and their lengths are different powers of two.
    * A document is cut if it is longer than ``capacity``, if it finds no room in any open window (it
      then completes the fullest), or among the last leftovers.
    * Documents are placed in the order of their partition; which sequence one shares depends on it.
      Ties go to the window opened first.  Repeated rows are packed like others.
    * Only doc_id and the text are read; other columns may have any name.  Empty tables give no rows.
    """
    if windows < 1 or fan_in < 2:
        raise ValueError("windows must be at least 1 and fan_in at least 2")
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    packed = materialise(first_pass(src, tokenizer, capacity, end_id, windows))
    names, level = NAMES[:-2], 1
    out, left = packed.where("ids IS NULL").select(*names), packed.where("ids IS NOT NULL")
    top = left.agg(F.max("part")).first()[0]
    parts = 0 if top is None else top + 1
    while parts:
        merged = materialise(merge(left, parts, capacity, windows, fan_in, level))
        out, left = out.unionByName(merged.where("ids IS NULL").select(*names)), merged.where("ids IS NOT NULL")
        parts, level = 0 if parts <= fan_in else -(-parts // fan_in), level + 1
    return out
