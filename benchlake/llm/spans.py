"""Spans in texts: their order, digest and written form, shared by the secret and PII scans."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import rows_of

#: (start, number of the kind, end), offsets in code points, end exclusive.
Span = tuple[int, int, int]


def written(found: Sequence[Span], kinds: Sequence[str]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join([f"{kinds[k]}:{start}:{end}" for start, k, end in sorted(found)])


class Taken:
    """Taken stretches of a text, kept disjoint and in order, so that a text with very many spans
    costs a binary search per candidate."""

    def __init__(self, found: Sequence[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, _, end in sorted(found):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, span: Span) -> bool:
        """Whether a span overlaps no taken stretch."""
        i = bisect_right(self.ends, span[0])
        return i == len(self.starts) or self.starts[i] >= span[2]

    def take(self, span: Span) -> None:
        """Add a free span."""
        i = bisect_right(self.ends, span[0])
        self.starts.insert(i, span[0])
        self.ends.insert(i, span[2])


def scan(docs: DataFrame, text: str, kinds: Sequence[str], n_base: int,
         base: Callable[[str], list[Span]], added: Callable[[str, list[Span]], list[Span]]) -> DataFrame:
    """One row per document: doc_id, n_<kind> of the first ``n_base`` kinds, base_sha256, spans.

    ``base`` finds the base spans of a text and ``added`` the method's, given the base ones."""
    counted = [f"n_{k}" for k in kinds[:n_base]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "doc_id", "text"):
            counts: list[list[int]] = [[] for _ in counted]
            digests, spans = [], []
            for t in texts:
                found = base(t) if t else []
                for k, out in enumerate(counts):
                    out.append(sum(x[1] == k for x in found))
                digests.append(hashlib.sha256(written(found, kinds).encode()).hexdigest())
                spans.append(written(found + (added(t, found) if t else []), kinds))
            yield pa.record_batch([pa.array(ids, pa.int64()), *[pa.array(c, pa.int64()) for c in counts],
                                   pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                                  names=["doc_id", *counted, "base_sha256", "spans"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = ", ".join(["doc_id long", *[f"{c} long" for c in counted], "base_sha256 string", "spans string"])
    return src.mapInArrow(run, schema)
