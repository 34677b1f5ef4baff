"""Line dedup: sharded minimal perfect hash over distinct line hashes, probed by the documents.

A line's key is the line stripped of [\\x20\\x09-\\x0D] at both ends and with A-Z lower-cased.
Keys of at least ``min_chars`` code points that occur in at least ``min_docs`` documents lose
all their lines, except in the largest doc_id that holds them.

1. Each document gives the distinct 128-bit hashes of its eligible lines; one aggregate counts
   the documents of a hash and finds the largest.  A line that a third of all documents share is
   reduced in every map task first.
2. Hashes that occur often enough are dealt to shards by hash.  Each shard is indexed by a
   minimal perfect hash (levels of bit arrays: a key settles on the first level where its bit is
   its own; the rank of the bit is its slot), with three compact arrays by slot: fingerprint (the
   second half of the hash, which also turns away every line that is not indexed), count and the
   largest doc_id.
3. The documents are read again and their lines probe the arrays.  No line is joined and no text
   is shuffled.

The arrays are broadcast only while they take at most ``max_array_bytes``, which is checked by
their summed size.  Beyond it the narrow probes (row, doc_id, hash) travel to the arrays instead: they are
dealt by shard, a shard that gets more than ``PROBES`` of them is copied to several tasks, each task
holds one shard's arrays, and the hashes that lose their lines go back by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import by_slices, materialise, rows_of

STRIP = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3
#: Broadcast bound of the arrays, and keys of a shard on average.
MAX_ARRAY_BYTES, SHARD_KEYS = 64 << 20, 100_000
#: Probes that one task holds, on average, when they travel to the shards.
PROBES = 1 << 20
#: The signed key that stands for a missing doc_id, below all others.
LOWEST = -(1 << 63)
#: Bits of a level per key that is left.
GAMMA = 2.0


def line_hashes(raw: bytes, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text and the 16-byte hash of each line's key; None for short keys."""
    lines, hashes = raw.split(b"\n"), []
    for line in lines:
        key = line.strip(STRIP)
        if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
            hashes.append(None)
        else:
            hashes.append(xxhash.xxh3_128_digest(key.lower()))  # bytes.lower() changes A-Z only
    return lines, hashes


def _halves(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(hashes), dtype="<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _mix(first: np.ndarray, second: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash for a level: even levels take one half of the line hash, odd ones the other."""
    with np.errstate(over="ignore"):
        x = (second if level % 2 else first) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build_levels(first: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
    """Bit arrays (as 0/1 bytes) of a minimal perfect hash over distinct 128-bit hashes."""
    levels = []
    while len(first):
        size = max(64, int(len(first) * GAMMA))
        at = (_mix(first, second, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone.astype(np.uint8))
        first, second = first[~alone[at]], second[~alone[at]]
    return levels


class Shards:
    """The shards' arrays laid end to end, so that lines of every shard are probed together."""

    def __init__(self, rows: list, n_shards: int):
        by = {r["shard"]: r for r in rows}
        sizes = [[len(x) * 8 for x in by[s]["levels"]] if s in by else [] for s in range(n_shards)]
        self.n_shards, self.depth = n_shards, max(map(len, sizes), default=0)
        self.size = np.zeros((self.depth, n_shards), np.int64)
        self.start = np.zeros((self.depth, n_shards), np.int64)
        bits, bit_at, rank_at, ranks, slots = [], 0, 0, [], 0
        self.arrays = {k: [] for k in ("fingerprints", "counts", "holders")}
        for s in range(n_shards):
            if s not in by:
                continue
            for k, packed in enumerate(by[s]["levels"]):
                one = np.unpackbits(np.frombuffer(packed, np.uint8))
                self.size[k, s], self.start[k, s] = by[s]["sizes"][k], bit_at
                bits.append(one)
                ranks.append(rank_at + np.cumsum(one) - one)
                bit_at, rank_at = bit_at + len(one), rank_at + int(one.sum())
            for k, kind in (("fingerprints", "<u8"), ("counts", "<i8"), ("holders", "<i8")):
                self.arrays[k].append(np.frombuffer(by[s][k], kind))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.bits, self.rank = join(bits, np.uint8), join(ranks, np.int64).astype(np.int64)
        self.fingerprints, self.counts, self.holders = (join(self.arrays[k], kind) for k, kind in (
            ("fingerprints", np.uint64), ("counts", np.int64), ("holders", np.int64)))

    def slots(self, first: np.ndarray, second: np.ndarray, check: bool = True) -> np.ndarray:
        """Slot of each hash, -1 where it isn't indexed."""
        out = np.full(len(first), -1, np.int64)
        left = np.arange(len(first))
        shard = (first % np.uint64(self.n_shards)).astype(np.int64)
        for k in range(self.depth):
            size = self.size[k][shard[left]]
            left = left[size > 0]
            if not len(left):
                break
            s = shard[left]
            at = self.start[k][s] + (_mix(first[left], second[left], k) % self.size[k][s].astype(np.uint64)).astype(np.int64)
            hit = self.bits[at] == 1
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        found = out >= 0
        if not check:
            return out
        found[found] = self.fingerprints[out[found]] == second[found]
        return np.where(found, out, -1)


def line_counts(docs: DataFrame, min_chars: int, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(h1, h2, ids...) of each document's distinct eligible lines; the ids are whole numbers."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *owners, texts in rows_of(batches, *ids, "raw"):
            at, found = [], []
            for i, raw in enumerate(texts):
                own = {h for h in line_hashes(raw or b"", min_chars)[1] if h is not None}
                found.extend(own)
                at.extend([i] * len(own))
            if found:
                first, second = _halves(found)
                yield pa.record_batch([pa.array(first.view(np.int64)), pa.array(second.view(np.int64)),
                                       *[pa.array(x, pa.int64()).take(pa.array(at)) for x in owners]], names=["h1", "h2", *ids])

    return docs.mapInArrow(by_slices(hashes), ", ".join(f"{c} long" for c in ("h1", "h2", *ids)))


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(h1, h2, n_docs, holder) of the line hashes found in at least ``min_docs`` documents.

    Rows with one doc_id are one document; rows without a doc_id are one document together,
    smaller than every other."""
    each = line_counts(docs, min_chars)
    return (each.groupBy("h1", "h2").agg(
                (F.countDistinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("n_docs"),
                F.max("doc_id").alias("holder"))
            .where(F.col("n_docs") >= min_docs))


def shard_of(n_shards: int) -> Column:
    """The shard of a hash: its first half, read without sign, modulo the number of shards."""
    return F.expr(f"cast(pmod(pmod(h1, {n_shards}) + if(h1 < 0, {(1 << 64) % n_shards}, 0), {n_shards}) as int)")


def build_shards(keys: DataFrame, n_shards: int) -> DataFrame:
    """One row per shard: the packed levels and the arrays by slot."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        first, second = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        levels = build_levels(first, second)
        one = {"shard": int(pdf["shard"].iloc[0]), "levels": [np.packbits(x).tobytes() for x in levels],
               "sizes": [len(x) for x in levels]}
        blank = {k: bytes(8 * len(pdf)) for k in ("fingerprints", "counts", "holders")}
        slots = Shards([one | blank | {"shard": 0}], 1).slots(first, second, check=False)
        back = np.argsort(slots)
        return pd.DataFrame([one | {
            "fingerprints": second[back].astype("<u8").tobytes(),
            "counts": pdf["n_docs"].to_numpy(np.int64)[back].astype("<i8").tobytes(),
            "holders": pdf["holder"].to_numpy(np.int64)[back].astype("<i8").tobytes()}])

    return (keys.withColumn("holder", F.coalesce("holder", F.lit(LOWEST).cast("long"))).withColumn("shard", shard_of(n_shards))
            .groupBy("shard").applyInPandas(
                build, "shard int, levels array<binary>, sizes array<long>, fingerprints binary, counts binary, holders binary"))


def dedup_lines(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                max_array_bytes: int = MAX_ARRAY_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``carry`` columns, n_lines (before dropping),
    n_dropped and ``kept``, the text that stays.

    * NULL or empty text: one empty line, kept as the empty text.
    * Documents are told apart by doc_id: rows that repeat a doc_id are one document, each keeps
      or loses its lines alike; rows with a NULL doc_id are together one document below all others.
    * Keys are compared by 128-bit hashes; a text may be of any length.
    * Only doc_id, the text and ``carry`` are read; other columns may have any name.
    * Empty tables give no rows.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("raw"),
                      *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    keys = materialise(repeated_lines(src.select("doc_id", "raw"), min_chars, min_docs))
    n_keys = keys.count()
    schema = ", ".join(["doc_id long", *[f"c{i} {src.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(carry))],
                        "n_lines long, n_dropped long, kept string"])
    names = ["doc_id", *[f"c{i}" for i in range(len(carry))]]
    if n_keys * 25 <= max_array_bytes:  # 24 bytes of arrays and about 3 bits of levels a key
        out = _probe_broadcast(src, keys, n_keys, min_chars, min_docs, schema, names)
    else:
        out = _probe_sharded(src, keys, n_keys, min_chars, min_docs, schema, names)
    return out.select("doc_id", *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "n_lines", "n_dropped", "kept")


def _probe_broadcast(src, keys, n_keys, min_chars, min_docs, schema, names):
    n_shards = max(1, -(-n_keys // SHARD_KEYS))
    rows = [r.asDict() for r in build_shards(keys, n_shards).collect()]  # bounded by the check above
    table = src.sparkSession.sparkContext.broadcast(rows)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(table.value, n_shards)
        for b in batches:
            ids = b.column(b.schema.get_field_index("doc_id")).to_pylist()
            parts = [line_hashes(raw or b"", min_chars) for raw in b.column(b.schema.get_field_index("raw")).to_pylist()]
            flat = [(d, h) for d, (_, hashes) in enumerate(parts) for h in hashes if h is not None]
            gone = np.zeros(len(flat), bool)
            if flat:
                first, second = _halves([h for _, h in flat])
                slot = shards.slots(first, second)
                owner = np.array([LOWEST if ids[d] is None else ids[d] for d, _ in flat], np.int64)
                hit = slot >= 0
                gone[hit] = (shards.counts[slot[hit]] >= min_docs) & (shards.holders[slot[hit]] != owner[hit])
            flags = iter(gone.tolist())
            done = []
            for lines, hashes in parts:
                kept = [x for x, h in zip(lines, hashes, strict=True) if h is None or not next(flags)]
                done.append((len(lines), len(lines) - len(kept), b"\n".join(kept).decode("utf-8", "replace")))
            yield _batch(b, names, done)

    return src.mapInArrow(by_slices(probe), schema)


def lost_lines(probes: DataFrame, shards: DataFrame, n_shards: int, min_docs: int, most: int) -> DataFrame:
    """(row, h1, h2) of the probes (row, doc_id, h1, h2) whose lines go; a task holds one shard's arrays and,
    on average, at most ``most`` of its probes, so a line that a third of all rows hold meets many tasks."""
    probes = probes.withColumn("shard", shard_of(n_shards))
    copies = probes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("copies"))
    dealt = probes.join(copies, "shard").withColumn("salt", F.pmod(F.xxhash64("row"), F.col("copies")).cast("int")).drop("copies")
    laid = shards.join(copies, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")

    def probe(arrays: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if arrays.empty or asked.empty:
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("row", "h1", "h2")})
        one = Shards([arrays.iloc[0].to_dict() | {"shard": 0}], 1)
        first, second = (asked[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        slot = one.slots(first, second)
        gone = slot >= 0
        gone[gone] = (one.counts[slot[gone]] >= min_docs) & (one.holders[slot[gone]] != asked["doc_id"].to_numpy(np.int64)[gone])
        return asked.loc[gone, ["row", "h1", "h2"]]

    return laid.groupBy("shard", "salt").cogroup(dealt.groupBy("shard", "salt")).applyInPandas(probe, "row long, h1 long, h2 long")


def _probe_sharded(src, keys, n_keys, min_chars, min_docs, schema, names):
    n_shards = max(1, -(-n_keys // SHARD_KEYS))
    shards = materialise(build_shards(keys, n_shards))
    # Written with its row numbers, so that they are the same in every later read.
    src = materialise(src.withColumn("row", F.monotonically_increasing_id()))
    probes = line_counts(src.select("row", F.coalesce("doc_id", F.lit(LOWEST).cast("long")).alias("doc_id"), "raw"),
                         min_chars, ("row", "doc_id"))
    # A row's list holds its own lines only.
    gone = (lost_lines(probes, shards, n_shards, min_docs, PROBES)
            .groupBy("row").agg(F.collect_list(F.struct("h1", "h2")).alias("gone")))
    joined = src.join(gone, "row", "left")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = []
            for raw, drop in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("raw", "gone")), strict=True):
                lost = {np.array([x["h1"], x["h2"]], "<i8").tobytes() for x in drop or []}
                lines, hashes = line_hashes(raw or b"", min_chars)
                kept = [x for x, h in zip(lines, hashes, strict=True) if h not in lost]
                done.append((len(lines), len(lines) - len(kept), b"\n".join(kept).decode("utf-8", "replace")))
            yield _batch(b, names, done)

    return joined.mapInArrow(by_slices(apply), schema)


def _batch(b: pa.RecordBatch, names: list[str], done: list[tuple[int, int, str]]) -> pa.RecordBatch:
    n, dropped, kept = zip(*done, strict=True) if done else ((), (), ())
    return pa.record_batch([*[b.column(b.schema.get_field_index(c)) for c in names], pa.array(n, pa.int64()),
                            pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                           names=[*names, "n_lines", "n_dropped", "kept"])
