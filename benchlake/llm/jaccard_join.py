"""N-gram Jaccard join: a MinHash LSH forest with exact verification.

1. Every text becomes its set of word shingles (64-bit hashes of ``n`` words).  Texts with one
   set are one *class of copies*, found by a 128-bit hash of the set; the smallest doc_id stands
   for the class.  Copies are never expanded into pairs.
2. A signature has ``trees`` paths of ``max_depth`` minima.  Two sets share the first d minima of a
   tree with probability J ** d.  The shallowest depth is the longest at which the forest
   finds a pair at the threshold with probability ``recall``; the nodes of that depth are
   the roots of the prefix tries, and their members, sorted by the rest of their paths, are the tries.
3. A trie is walked from its longest shared prefixes to its root.  A node compares the whole
   signatures (one byte a minimum) of members that no deeper node has compared, and chains those whose
   estimate may reach the threshold by a spanning forest: never a row per pair.  The matched prefix of
   a subtree is shortened only while its members aren't one group yet: from then on shorter prefixes
   can find nothing new there.  The connected chains are the candidate groups.
4. The texts of each group meet again and every pair of sets in a group is verified exactly.
   Large buckets and groups are split into blocks, and each pair of blocks is its own piece of
   work, so no group has to fit into one task.  A block returns the number of links of each member
   and a spanning forest of its links.  The components of the verified forests are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import SPACE, by_slices, components, materialise, rows_of, worker_cache

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.99
TREES, MAX_DEPTH = 24, 10
#: Members of a block at most on average, of a bucket and of a candidate group.
BUCKET_BLOCK, GROUP_BLOCK = 512, 128
#: Bits of the filter of members at most (2 million words of 64).
FILTER_BITS = 1 << 27
#: Word hashes kept by a worker before it starts anew, and the longest word that is kept.
KEPT_WORDS, KEPT_CHARS = 200_000, 64
_SPLIT = str.maketrans(dict.fromkeys(SPACE, " "))


class _WordHash(dict):
    def __missing__(self, word):
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = h
        return h


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``n`` words.

    Words are runs without [\\x20\\x09-\\x0D].  A text of fewer words is one shingle of all of
    them; a text without words has none.
    """
    known = worker_cache("word hashes", _WordHash)
    words = [known[w] for w in (text or "").translate(_SPLIT).split(" ") if w]
    if not words:
        return np.zeros(0, np.uint64)
    h, k = np.array(words, np.uint64), min(n, len(words))
    mixed = np.full(len(h) - k + 1, np.uint64(k))
    with np.errstate(over="ignore"):
        for i in range(k):
            mixed = (mixed ^ h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def forest_depth(trees: int, threshold: float, recall: float, max_depth: int) -> int:
    """The shallowest prefix that has to be matched: the longest, at most ``max_depth``, at which
    ``trees`` tries find a pair at the threshold with probability ``recall``."""
    for depth in range(max_depth, 0, -1):
        if 1 - (1 - threshold ** depth) ** trees >= recall:
            return depth
    raise ValueError("even one matching minimum doesn't reach the recall: take more trees")


def _minima(sets: np.ndarray, count: int) -> np.ndarray:
    """``count`` 32-bit minima of a set of hashes."""
    rng = np.random.default_rng(7)
    mask = rng.integers(0, 1 << 32, count, dtype=np.uint32)
    odd = rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    x = (sets ^ (sets >> np.uint64(32))).astype(np.uint32)
    out = np.full(count, np.iinfo(np.uint32).max, np.uint32)
    h = np.empty((min(len(x), 256), count), np.uint32)  # stays in the processor's cache
    for at in range(0, len(x), 256):
        part = x[at:at + 256, None]
        now = h[:len(part)]
        np.bitwise_xor(part, mask, out=now)
        np.multiply(now, odd, out=now)
        np.minimum(out, now.min(axis=0), out=out)
    return out ^ (out >> np.uint32(15))


def signatures(docs: DataFrame, n: int, trees: int, depth: int, max_depth: int) -> DataFrame:
    """(doc_id, set_hash, labels, sketch) per row: the trie root by tree, a 64-bit hash of its
    ``depth`` minima, and a byte per minimum, the paths of the trees one after the other."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "doc_id", "text"):
            hashes, labels, sketches = [], [], []
            for text in texts:
                s = shingles(text, n)
                if not len(s):
                    hashes.append(None), labels.append(None), sketches.append(None)
                    continue
                low = _minima(s, trees * max_depth)
                hashes.append(xxhash.xxh3_128_digest(s.tobytes()))
                labels.append([xxhash.xxh3_64_intdigest(x.tobytes(), seed=t) - (1 << 63)
                               for t, x in enumerate(low.reshape(trees, max_depth)[:, :depth])])
                sketches.append((low >> np.uint32(7)).astype(np.uint8).tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(hashes, pa.binary()),
                                   pa.array(labels, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                                  names=["doc_id", "set_hash", "labels", "sketch"])

    return docs.mapInArrow(by_slices(sign), "doc_id long, set_hash binary, labels array<long>, sketch binary")


def _blocked(members: DataFrame, key: list[str], size: str, block: int) -> DataFrame:
    """Deal the members of each key to hash blocks and copy them to every pair of blocks (i <= j)
    they are in: columns ``i``, ``j`` and ``own``, the member's block."""
    n = F.ceil(F.col(size) / F.lit(block)).cast("int")
    dealt = members.withColumn("n", n).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda x: F.struct(
        F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j")))
    return dealt.withColumn("p", F.explode(pair)).select("*", "p.i", "p.j").drop("p", "n")


def _runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[dict[str, list]]:
    """Groups of equal keys of sorted batches, as lists by column."""
    held, last = None, None
    for b in batches:
        cols = {c: b.column(i).to_pylist() for i, c in enumerate(b.schema.names)}
        keys = list(zip(*(cols[k] for k in key), strict=True))
        at = 0
        while at < len(keys):
            end = at + 1
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            if keys[at] != last:
                if held:
                    yield held
                held, last = {c: [] for c in cols}, keys[at]
            for c, v in cols.items():
                held[c].extend(v[at:end])
            at = end
    if held:
        yield held


def _forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric 0/1 matrix."""
    n, edges = len(adjacent), []
    todo = np.ones(n, bool)
    for root in range(n):
        if not todo[root]:
            continue
        todo[root] = False
        front = [root]
        while front:
            u = front.pop()
            new = np.flatnonzero(adjacent[u] & todo)
            todo[new] = False
            edges.extend((u, int(v)) for v in new)
            front.extend(new.tolist())
    return edges


def trie_links(paths: np.ndarray, sketches: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Spanning forest of the members of one trie whose signatures agree in ``least`` or more.

    ``paths`` (a byte per level below the root) are sorted.  Levels are taken from the deepest up;
    a node compares members of different children only, and none once it is one group."""
    n, levels = paths.shape
    shared = np.cumprod(paths[1:] == paths[:-1], axis=1).sum(axis=1)
    group, child, edges = np.arange(n), np.arange(n), []
    for level in range(levels, -1, -1):
        opens = np.concatenate([[True], shared < level])
        starts = np.flatnonzero(opens)
        for lo, hi in zip(starts, [*starts[1:], n], strict=True):
            for u in range(lo, hi):
                if (group[lo:hi] == group[lo]).all():
                    break  # nothing is left to find: the prefix isn't shortened for these
                other = lo + np.flatnonzero((group[lo:hi] != group[u]) & (child[lo:hi] != child[u]))
                for v in other[(sketches[other] == sketches[u]).mean(axis=1) >= least]:
                    if group[v] != group[u]:
                        edges.append((u, int(v)))
                        group[group == group[v]] = group[u]
        child = np.cumsum(opens)
    return edges


def candidate_links(classes: DataFrame, threshold: float, depth: int, max_depth: int) -> DataFrame:
    """Forest edges (a, b) of the classes that meet in a trie with a high enough estimate.

    A pair is let go only when its estimate from all minima is five standard deviations below
    the threshold."""
    each = classes.select("rep", F.posexplode("labels").alias("tree", "label"))
    full = (each.groupBy("tree", "label").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
            .withColumnRenamed("tree", "t").withColumnRenamed("label", "l"))
    met = each.join(full, (F.col("tree") == F.col("t")) & (F.col("label") == F.col("l"))).select("tree", "label", "rep", "size")
    sketched = met.join(classes.select(F.col("rep").alias("r"), "sketch"), F.col("rep") == F.col("r")).drop("r")
    key, levels = ["tree", "label", "i", "j"], max_depth - depth
    dealt = _blocked(sketched, key, "size", BUCKET_BLOCK)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for g in _runs(batches, key):
            reps = g["rep"]
            if len(reps) < 2:
                continue
            s = np.frombuffer(b"".join(g["sketch"]), np.uint8).reshape(len(reps), -1)
            width = s.shape[1]
            least = threshold - 5 * (threshold * (1 - threshold) / width) ** 0.5
            if len(reps) == 2:
                edges = [(0, 1)] if (s[0] == s[1]).mean() >= least else []
            else:
                at = g["tree"][0] * max_depth + depth
                edges = trie_links(s[:, at:at + levels], s, least)
            a.extend(reps[u] for u, _ in edges)
            b.extend(reps[v] for _, v in edges)
            if len(a) > 10_000:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    path = F.substring("sketch", F.col("tree") * max_depth + depth + 1, F.lit(levels))
    return (dealt.select(*key, "rep", "sketch", path.alias("path")).repartition(*key)
            .sortWithinPartitions(*key, "path").drop("path").mapInArrow(by_slices(link), "a long, b long"))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over slices of the
    shingles that two sets or more have."""
    n = len(sets)
    if n == 2:
        one = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), one], [one, len(sets[1])]])
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[at] > 1
    owner, at = owner[shared], at[shared]
    rank = np.cumsum(count > 1) - 1
    at = rank[at]
    out, width = np.zeros((n, n)), 8192
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        lo, hi = np.searchsorted(at, (start, start + width))
        m = np.zeros((n, width), np.float32)
        m[owner[lo:hi], at[lo:hi] - start] = 1
        out += m @ m.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out.round().astype(np.int64)


def verified(texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """(a, b, links) over groups (root, size, rep, copies, text): rows with b are edges of a
    spanning forest of the links in a block pair, rows without b carry the links of a."""
    key = ["root", "i", "j"]
    dealt = _blocked(texts, key, "size", GROUP_BLOCK)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _runs(batches, key):
            reps, own = g["rep"], np.array(g["own"])
            if len(reps) < 2:
                continue
            sets = [shingles(t, n) for t in g["text"]]
            common = _overlaps(sets)
            sizes = np.array([len(s) for s in sets])
            linked = common >= threshold * (sizes[:, None] + sizes - common) - 1e-9
            np.fill_diagonal(linked, False)
            if g["i"][0] != g["j"][0]:  # pairs inside a block are counted where i = j
                linked &= own[:, None] != own
            links = linked @ np.array(g["copies"], np.int64)
            edges = _forest(linked)
            a = [reps[u] for u, _ in edges] + [r for r, x in zip(reps, links, strict=True) if x]
            b = [reps[v] for _, v in edges] + [None] * (len(a) - len(edges))
            x = [None] * len(edges) + [int(x) for x in links if x]
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(x, pa.int64())],
                                  names=["a", "b", "links"])

    rows = dealt.select(*key, "own", "rep", "copies", "text").repartition(*key).sortWithinPartitions(*key)
    return rows.mapInArrow(by_slices(verify), "a long, b long, links long")


def _perhaps(rows: DataFrame, key: str, wanted: DataFrame, of: str) -> DataFrame:
    """Rows whose ``key`` may be among the ids ``wanted``: all that are, and few others.

    A bit array of 16 bits an id, at most ``FILTER_BITS``, is broadcast and looked up where the rows
    are read, so that texts of other rows aren't shuffled.  A full array lets more rows pass."""
    bits = 1024
    while bits < min(16 * wanted.count(), FILTER_BITS):
        bits *= 2
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = (wanted.select(place(of).alias("p")).groupBy(F.floor(F.col("p") / 64).alias("__w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("__bits")))
    marked = rows.select(*rows.columns, place(key).alias("__p"))
    hit = marked.join(F.broadcast(words), F.floor(F.col("__p") / 64) == F.col("__w"))
    return hit.where(F.expr("getbit(__bits, cast(__p % 64 as int)) = 1")).select(*rows.columns)


def near_duplicates(docs: DataFrame, text: str = "text", n: int = WORDS, threshold: float = THRESHOLD,
                    trees: int = TREES, max_depth: int = MAX_DEPTH, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id and n_links.

    * ``class_id``: the smallest doc_id connected by links (Jaccard of the shingle sets at least
      ``threshold``).  ``n_links``: rows that the document is linked with, copies included.
    * NULL and empty texts have no shingles: no links, a class of their own.  A NULL doc_id has
      the class_id NULL and isn't linked.  Rows that repeat a doc_id count as copies when
      their texts agree; when they differ, the smallest set hash stands for the doc_id in
      later steps, and every row gets its own text's class.
    * Only doc_id and the text are read; other columns may have any name.  Empty tables give no rows.
    """
    depth = forest_depth(trees, threshold, recall, max_depth)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = materialise(signatures(src, n, trees, depth, max_depth))
    real = signed.where(F.col("doc_id").isNotNull() & F.col("set_hash").isNotNull())
    sets = materialise(real.groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    # one set for an id: only rows that repeat an id with another text make a difference here
    copies = sets.groupBy("rep").agg(F.min("set_hash").alias("set_hash"), F.sum("copies").alias("copies"))
    stands = copies.select(F.col("rep"), F.col("copies"), F.col("set_hash").alias("h"))
    classes = (real.select(F.col("doc_id"), F.col("set_hash"), "labels", "sketch")
               .join(stands, (F.col("doc_id") == F.col("rep")) & (F.col("set_hash") == F.col("h")))
               .dropDuplicates(["rep"]).select("rep", "copies", "labels", "sketch"))
    groups = components(candidate_links(classes, threshold, depth, max_depth).distinct())
    sizes = groups.groupBy(F.col("root").alias("g")).agg(F.count(F.lit(1)).alias("size"))
    member = materialise(groups.join(sizes, F.col("root") == F.col("g")).select("root", "size", F.col("node").alias("rep"))
                         .join(stands.select(F.col("rep").alias("r"), "copies"), F.col("rep") == F.col("r")).drop("r"))
    texts = (_perhaps(src, "doc_id", member, "rep").join(member, F.col("doc_id") == F.col("rep")).dropDuplicates(["rep"])
             .select("root", "size", "rep", "copies", "text"))
    found = materialise(verified(texts, n, threshold))
    roots = components(found.where(F.col("b").isNotNull()).select("a", "b"))
    links = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("x")).agg(F.sum("links").alias("links"))
    judged = (copies.join(roots, F.col("rep") == F.col("node"), "left").join(links, F.col("rep") == F.col("x"), "left")
              .select(F.col("rep").alias("r"), F.coalesce("root", "rep").alias("class_id"),
                      (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    classed = sets.join(judged, F.col("rep") == F.col("r")).select(F.col("set_hash").alias("h"), "class_id", "n_links")
    out = signed.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("set_hash")).alias("set_hash")).join(
        classed, F.col("set_hash") == F.col("h"), "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
