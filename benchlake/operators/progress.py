"""Running totals in a total order without one task that sees all rows.

1. Rows equal in the order and the value are counted into one (a partial aggregate), so a key on a
   third of all rows is one row from here on.
2. The rest is dealt into ranges of the order and written; each range knows its rows and its sum.
3. A running sum over the ranges (a few numbers per range) gives each range its start; rows
   are then summed inside their range.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from benchlake.operators.order_stats import join_null_safe
from benchlake.session import ensure_checkpoint_dir


def running_mean(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, every: int = 10,
                 ranges: int | None = None) -> DataFrame:
    """``keys``, n, mean: after every ``every``-th row of a key's rows in ``order``, and after its last.

    * ``n``: rows so far; ``mean``: mean of ``value`` over them, without NULLs (NULL while there are
      only NULLs; they count in ``n``).  Rows that tie in ``order`` come in the order of the value, NULLs first.
    * ``ranges``: parts that the order is divided into (default: the session's shuffle partitions).
    * An empty table gives no rows.
    """
    if every < 1:
        raise ValueError("every must be at least 1")
    spark = df.sparkSession
    by = [f"_k{i}" for i in range(len(keys))]
    at = [f"_o{i}" for i in range(len(order))]
    rows = df.select(*[F.col(k).alias(a) for k, a in zip(keys, by, strict=True)], *[F.col(o).alias(a) for o, a in zip(order, at, strict=True)],
                     F.col(value).cast("double").alias("_v"))
    runs = rows.groupBy(*by, *at, "_v").agg(F.count(F.lit(1)).alias("_n"))
    parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{ensure_checkpoint_dir(spark)}/ranges-{uuid.uuid4().hex}"
    runs.repartitionByRange(parts, *by, *at, "_v").withColumn("_range", F.spark_partition_id()).write.parquet(path)
    runs = spark.read.parquet(path)
    set_rows = F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)
    total = F.coalesce(F.col("_v"), F.lit(0.0)) * F.col("_n")
    sizes = runs.groupBy(*by, "_range").agg(F.sum("_n").alias("_rows"), F.sum(set_rows).alias("_set"), F.sum(total).alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = sizes.select(*by, F.col("_range"), F.coalesce(F.sum("_rows").over(before), zero).alias("_rows"),
                          F.coalesce(F.sum("_set").over(before), zero).alias("_set"),
                          F.coalesce(F.sum("_sum").over(before), F.lit(0.0)).alias("_sum"),
                          (F.col("_range") == F.max("_range").over(Window.partitionBy(*by))).alias("_final"))
    inside = Window.partitionBy(*by, "_range").orderBy(*at, "_v")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = join_null_safe(runs.withColumns({
        "_rows_in": F.coalesce(F.sum("_n").over(upto), zero), "_set_in": F.coalesce(F.sum(set_rows).over(upto), zero),
        "_sum_in": F.coalesce(F.sum(total).over(upto), F.lit(0.0)), "_next": F.lead(F.lit(1)).over(inside)}), starts, [*by, "_range"])
    first = F.col("_rows") + F.col("_rows_in")
    last = first + F.col("_n")
    multiple = (F.floor(first / every) + 1) * every  # the first row number reported in this run of equal rows
    hits = F.when(multiple <= last, F.sequence(multiple, last, F.lit(every).cast("long"))).otherwise(F.array().cast("array<long>"))
    ends = F.when(F.col("_final") & F.col("_next").isNull() & (last % every != 0), F.concat(hits, F.array(last))).otherwise(hits)
    shown = placed.select(*by, "_v", first.alias("_first"), (F.col("_set") + F.col("_set_in")).alias("_set"),
                          (F.col("_sum") + F.col("_sum_in")).alias("_sum"), F.explode(ends).alias("n"))
    more = F.when(F.col("_v").isNotNull(), F.col("n") - F.col("_first")).otherwise(0)
    return shown.select(*[F.col(a).alias(k) for k, a in zip(keys, by, strict=True)], "n", F.when(
        F.col("_set") + more > 0, (F.col("_sum") + F.coalesce(F.col("_v"), F.lit(0.0)) * more) / (F.col("_set") + more)).alias("mean"))
