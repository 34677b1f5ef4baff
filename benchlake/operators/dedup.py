"""Keep-first de-duplication without a window.

"Keep the first row of each key" is order dependent, and a distributed scan has no order, so
the order is an explicit ingest ordinal column.  The survivor of each key is chosen by
``min((ordinal, row))``: a partial (map-side) aggregate whose buffer is one row, so a key that
holds a third of all rows is reduced in every map task before the shuffle instead of being
sorted inside one task as a ``row_number()`` window would do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], ordinal: str, count_col: str | None = None,
               extra_aggs: list | None = None, short_keys: bool = False, partitioned: bool = False) -> DataFrame:
    """One row per ``keys``: the one with the smallest ``ordinal`` (ties: smallest row).

    With ``count_col`` the number of rows of the key is added (to report duplicates);
    ``extra_aggs`` are further aggregate columns computed over the key's rows.  ``short_keys``
    groups by the keys alone, so the result stays partitioned on them, and orders by the
    ordinal alone, which must then be unique.  ``partitioned`` groups by the keys alone as well, and keeps
    the order of ties.
    """
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    # The order of ties includes the row, so the least pair is the row itself: its texts are held once.
    first = F.min_by(packed, F.col(ordinal)) if short_keys else F.min(F.struct(F.col(ordinal).alias("o"), packed.alias("row")))["row"]
    aggs = [first.alias("__row")]
    added = []
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
        added.append(count_col)
    for a in extra_aggs or []:
        aggs.append(a)
    # An aggregate over a struct with strings has a variable-length buffer, so Spark aggregates by
    # sorting; a leading 64-bit hash of the keys makes that sort compare longs instead of long
    # texts.  Grouping stays exact: the real keys are still part of the grouping.
    grouped = keys if short_keys or partitioned else [F.xxhash64(*keys).alias("__kh"), *keys]
    out = df.groupBy(*grouped).agg(*aggs).drop("__kh")
    added += [c for c in out.columns if c not in keys and c != "__row" and c not in added]
    cols = [F.col(k) for k in keys] + [F.col(f"__row.{c}").alias(c) for c in others]
    return out.select(*cols, *added).select(*df.columns, *added)


def duplicate_report(df: DataFrame, keys: list[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their row count (the failing rows of a declarative ``unique`` test)."""
    if len(keys) == 1:  # single-column uniqueness ignores NULLs
        df = df.filter(F.col(keys[0]).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)
