"""Deterministic stratified sampling.

Stratum sizes follow the reference rule: with ``frac = n / N``, a stratum of ``len`` rows keeps
``k = min(len, max(1, round_half_even(len * frac)))`` rows; if the strata together keep more than
``n`` rows, the union is cut to ``n``.  ``n`` missing or ``>= N`` returns the input unchanged.

Which rows are kept is decided by a seeded hash of the row id (SHA-256 of ``seed:id``, first 60
bits), not by a random generator: results do not change with retries, partitioning or executor
loss.  A stratum keeps its ``k`` smallest hashes; the cut keeps the ``n`` smallest of the union.

No stratum is ever sorted in one task: the ``k``-th smallest hash of every stratum is found with
the bucket-refinement order statistic (partial aggregates only), then a plain filter
``hash <= threshold`` keeps the rows.  Only when a threshold hash is shared by several rows
(duplicated ids) are those tied rows ordered by id, with a window over the tied rows alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from benchlake.operators.order_stats import (
    collect_bounded,
    join_null_safe,
    kth_smallest,
    kth_smallest_rows,
    rows_frame,
)
from benchlake.session import materialize


def sample_hash(seed: int, id_col: str) -> F.Column:
    """First 60 bits of SHA-256(``seed:id``) as a non-negative BIGINT (same order as the hex)."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")), 256)
    # Never NULL (15 hex digits always convert); saying so lets Catalyst drop the inferred
    # ``isnotnull`` filter, which would otherwise be pushed below and hash every row twice.
    return F.coalesce(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(0).cast("long"))


def _keep_smallest(df: DataFrame, keys: list[str], tiebreak: str, thresholds: list) -> DataFrame:
    """Rows with ``_h`` below their group's threshold, plus the first tied rows by ``tiebreak``.

    ``thresholds``: ``(keys..., t, r, eq)`` = keep ``_h < t`` and the first ``r + 1`` of the ``eq``
    rows with ``_h == t``.
    """
    spark = df.sparkSession
    schema = StructType([df.schema[k] for k in keys] + [
        StructField("_t", LongType()), StructField("_tr", LongType()), StructField("_teq", LongType())])
    thr = rows_frame(spark, thresholds, schema)
    # The threshold table has one row per group and at most LOCAL_ROWS rows: a proven bound.
    cand = join_null_safe(df, thr, keys, broadcast_right=True)
    nk = len(keys)
    if all(t[nk + 1] + 1 == t[nk + 2] for t in thresholds):  # every tied row is kept
        return cand.filter(F.col("_h") <= F.col("_t")).drop("_t", "_tr", "_teq")
    below = cand.filter(F.col("_h") < F.col("_t"))
    ties = cand.filter(F.col("_h") == F.col("_t")).withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(tiebreak))
    ).filter(F.col("_rn") <= F.col("_tr") + 1).drop("_rn")
    return below.unionByName(ties).drop("_t", "_tr", "_teq")


def _stratified_sample_many(hashed: DataFrame, n: int, strata: list[str], id_col: str) -> DataFrame:
    """The same sample when there are more strata than driver-side metadata may hold: sizes,
    per-stratum k and thresholds stay in (checkpointed) DataFrames; the threshold join is a
    shuffle join on the strata keys (AQE splits a hot stratum)."""
    sizes = materialize(hashed.groupBy(*strata).agg(
        F.count(F.lit(1)).alias("_len"), F.min("_h").alias("_lo"), F.max("_h").alias("_hi")))
    total = sizes.agg(F.sum("_len")).first()[0]
    if n >= total:
        return hashed.drop("_h")
    frac = n / total
    k = F.least(F.col("_len"), F.greatest(F.lit(1), F.rint(F.col("_len") * F.lit(frac)).cast("long")))
    ks = materialize(sizes.withColumn("_k", k))
    kept = ks.agg(F.sum("_k")).first()[0]
    targets = ks.select(*strata, F.lit(0).alias("_tid"), (F.col("_k") - 1).alias("_r"), "_lo", "_hi",
                        F.col("_len").alias("_cnt"))
    values = hashed.select(*strata, F.col("_h").alias("_v"))
    thr = materialize(kth_smallest(values, strata, targets).select(
        *strata, F.col("_val").alias("_t"), F.col("_r").alias("_tr")))
    cand = join_null_safe(hashed, thr, strata)
    below = cand.filter(F.col("_h") < F.col("_t"))
    ties = cand.filter(F.col("_h") == F.col("_t")).withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*strata).orderBy(id_col))
    ).filter(F.col("_rn") <= F.col("_tr") + 1).drop("_rn")
    picked = below.unionByName(ties).drop("_t", "_tr")
    if kept > n:
        one = materialize(picked.withColumn("_all", F.lit(0)))
        b = one.agg(F.min("_h").alias("lo"), F.max("_h").alias("hi"), F.count(F.lit(1)).alias("c")).first()
        vals = one.select("_all", F.col("_h").alias("_v"))
        t = kth_smallest_rows(vals, ["_all"], [(0, 0, n - 1, b["lo"], b["hi"], b["c"])])[0]
        picked = _keep_smallest(one, ["_all"], id_col, [(0, t[2], t[3], t[4])]).drop("_all")
    return picked.drop("_h")


def stratified_sample(df: DataFrame, n: int | None, seed: int = 42,
                      strata: tuple[str, ...] = ("category", "difficulty"),
                      id_col: str = "question_id") -> DataFrame:
    """Sample ``n`` rows of ``df`` stratified by ``strata`` (see module doc)."""
    if n is None:
        return df
    strata = list(strata)
    df = df.dropna(subset=strata)  # a row without a stratum belongs to no group
    hashed = df.withColumn("_h", sample_hash(seed, id_col))
    sizes = collect_bounded(hashed.groupBy(*strata).agg(
        F.count(F.lit(1)).alias("_len"), F.min("_h").alias("_lo"), F.max("_h").alias("_hi")))
    if sizes is None:
        return _stratified_sample_many(hashed, n, strata, id_col)
    total = sum(r["_len"] for r in sizes)
    if n >= total:
        return df
    frac = n / total
    ns = len(strata)
    targets, kept = [], 0
    for r in sizes:
        k = min(r["_len"], max(1, round(r["_len"] * frac)))
        kept += k
        targets.append((*[r[c] for c in strata], 0, k - 1, r["_lo"], r["_hi"], r["_len"]))
    values = hashed.select(*strata, F.col("_h").alias("_v"))
    thresholds = [(*t[:ns], t[ns + 1], t[ns + 2], t[ns + 3]) for t in kth_smallest_rows(values, strata, targets)]
    picked = _keep_smallest(hashed, strata, id_col, thresholds)
    if kept > n:
        # Cut the union to the n smallest hashes: one more order statistic on a single group.
        one = picked.withColumn("_all", F.lit(0))
        b = one.agg(F.min("_h").alias("lo"), F.max("_h").alias("hi"), F.count(F.lit(1)).alias("c")).first()
        vals = one.select("_all", F.col("_h").alias("_v"))
        t = kth_smallest_rows(vals, ["_all"], [(0, 0, n - 1, b["lo"], b["hi"], b["c"])])[0]
        picked = _keep_smallest(one, ["_all"], id_col, [(0, t[2], t[3], t[4])]).drop("_all")
    return picked.drop("_h")
