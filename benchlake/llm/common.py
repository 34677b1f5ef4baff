"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from benchlake.session import ensure_checkpoint_dir

#: White space of the word and line rules, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
#: Bytes of a batch that a Python worker takes at once; a longer row is taken by itself.
BYTES_AT_ONCE = 4 << 20


def worker_cache(key, build: Callable):
    """An object that a Python worker keeps across its tasks, until another one is asked for: a
    worker that serves one operator after the other holds the last one's only."""
    module = sys.modules.setdefault("_benchlake_worker", types.ModuleType("_benchlake_worker"))
    if getattr(module, "key", None) != key:
        module.kept = None  # freed before the next one is built
        give_back()
        module.kept, module.key = build(), key
    return module.kept


def _halved(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if b.num_rows < 2 or b.nbytes <= BYTES_AT_ONCE:
        yield b
        return
    half = b.num_rows // 2
    yield from _halved(b.slice(0, half))
    yield from _halved(b.slice(half))


def give_back() -> None:
    """Hand freed memory back to the system: the allocators of a worker that waits for its next task keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)


def by_slices(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` for mapInArrow, with every batch cut into slices of at most ``BYTES_AT_ONCE`` (or one row), so
    that a worker never holds a whole batch as Python objects; at its end freed memory goes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(part for b in batches for part in _halved(b))
        finally:
            give_back()

    return run


def fresh(df: DataFrame, *columns: str) -> DataFrame:
    """Only ``columns``, so that extra columns of the input can't clash with helper columns."""
    return df.select(*columns)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the session's checkpoint folder and read it back: it is
    computed once, survives lost executors, and later reads take only the columns they need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[list[list]]:
    """The named columns of each batch as Python lists."""
    for b in batches:
        yield [b.column(b.schema.get_field_index(n)).to_pylist() for n in names]


def same(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of column pairs."""
    return reduce(lambda x, y: x & y, (a[p].eqNullSafe(b[q]) for p, q in pairs))


def gapless_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, cells: int = 256) -> DataFrame:
    """Numbers 0, 1, 2 ... without gaps inside each ``group``, as column ``out``.

    A group isn't sorted in one task: its rows are dealt to ``cells`` hash cells, the cells are
    counted (a partial aggregate), a running sum over the bounded cell table gives each cell its
    first number, and rows are numbered inside their cell.  Rows equal in ``order`` are
    interchangeable.
    """
    dealt = df.withColumn("__cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    counts = dealt.groupBy(*group, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__cell").alias("__c"),
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(*group, "__cell").orderBy(*order)
    numbered = dealt.withColumn("__rn", F.row_number().over(inside) - 1)
    on = [numbered[g] == first[f"__g{i}"] for i, g in enumerate(group)] + [numbered["__cell"] == first["__c"]]
    return (numbered.join(first, reduce(lambda x, y: x & y, on))
            .withColumn(out, F.col("__first") + F.col("__rn"))
            .select(*df.columns, out))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge list ``(a long, b long)``.

    Returns ``(node, root)``, root the smallest node of the component, for every node of an edge.
    Large-star and small-star rounds; each is two aggregates and two joins, written to the
    checkpoint folder, and nothing but a count and a checksum reaches the driver.  A node with
    very many neighbours is reduced by partial aggregates and its join is split by AQE.
    """
    seen = None
    e = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where(F.col("u") != F.col("v")).distinct())
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        least = least.select("w", F.least("w", "m").alias("m"))
        # large star: neighbours above u point to the least around u
        e = (both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("w"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())
        # small star: u and its smaller neighbours point to the least of them
        low = e.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        hung = e.join(low, F.col("u") == F.col("w"))
        e = materialise(hung.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                                     F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                        .select("x.u", "x.v").where(F.col("u") != F.col("v")).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
