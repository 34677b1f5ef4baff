"""Anti join of a bounded increment against a table that only grows.

Resuming work (questions x variants minus answered keys) and merging new answers (new rows
minus stored keys) both subtract a large, ever-growing key set (the response history) from a
comparatively small one (this run's work or this micro-batch).  A plain anti join shuffles
the large side on every run.  When the small side's row count is proven to be within a bound,
its keys are broadcast and the large side is first reduced to the keys they share (a map-side
semi join: the large table is scanned with its key columns only, never shuffled); the anti
join then runs against that small result.  Beyond the bound both sides are shuffled on the key
and AQE splits a skewed key.  While the large side is itself within the broadcast threshold
(by the planner's estimate) the plain anti join is used and the planner broadcasts it.

``skew_join`` joins a fact with hot keys to a dimension that is too large to broadcast: the hot
keys are found by a mergeable sketch, their dimension rows are broadcast, the rest is shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to this many small-side rows have their keys broadcast (about 20 MB of short keys).
BROADCAST_KEYS = 250_000


def fits_broadcast(df: DataFrame) -> bool:
    """Catalyst's size estimate of ``df`` is within the session's broadcast threshold."""
    try:
        spark = df.sparkSession
        value = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b").strip()
        limit = -1 if value.startswith("-") else int(
            spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value))
        if limit <= 0:
            return False
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit
    except Exception:  # noqa: BLE001 - no plan statistics available: assume it does not fit
        return False


def anti_join_growing(small: DataFrame, large: DataFrame, keys: list[str],
                      broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Rows of ``small`` whose ``keys`` do not occur in ``large``.

    ``small`` is evaluated twice (size check, join): pass a materialised frame when it is
    expensive to recompute.  Duplicate keys in ``large`` are harmless (no ``distinct``).
    """
    stored = large.select(*keys)
    if fits_broadcast(stored):
        # The history itself is small: the planner broadcasts it, no extra job is needed.
        return small.join(stored, keys, "left_anti")
    probe = small.select(*keys)
    if probe.limit(broadcast_keys + 1).count() <= broadcast_keys:
        stored = stored.join(F.broadcast(probe), keys, "left_semi")
    return small.join(stored, keys, "left_anti")


# Hot keys at most (they travel in the plan), keys that the sketch tracks, and dimension rows of the
# hot keys that are broadcast at most.
HOT_KEYS, TRACKED_KEYS, HOT_ROWS = 1024, 65_536, 100_000


class HotKeys(NamedTuple):
    keys: list
    rows: int  # rows with a key


def hot_keys(fact: DataFrame, key: str, share: float) -> HotKeys:
    """Keys that hold at least ``share`` of the rows with a key, by a frequent-items sketch.

    One scan of the key column; each task keeps at most ``TRACKED_KEYS`` counts, which merge.  The
    sketch's error is some ``rows / (0.75 * TRACKED_KEYS)``, far below any useful share."""
    if share <= 1 / HOT_KEYS:
        raise ValueError(f"a share must be above 1 / {HOT_KEYS}")
    row = fact.agg(F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED_KEYS})").alias("top"), F.count(key).alias("n")).first()
    return HotKeys([t[0] for t in row["top"] or [] if t[0] is not None and t[1] >= share * row["n"]], row["n"])


def skew_join(fact: DataFrame, dim: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """Inner join on ``key`` in which no hot key of the fact meets in one task.

    Rows of hot keys (at least ``share`` of all; default: half an average shuffle partition's) stay in
    the partitions they were read in and meet the broadcast dimension rows of their keys; all other
    rows are shuffled.  Which keys are called hot decides the plan only, never the result.  NULL keys
    match nothing.  If the hot keys have more than ``HOT_ROWS`` dimension rows, the plain join is
    left to AQE.
    """
    if share is None:
        partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = max(0.5 / partitions, 2 / HOT_KEYS)
    hot = hot_keys(fact, key, share).keys
    if not hot:
        return fact.join(dim, key, "inner")
    of_hot = F.col(key).isin(hot)
    few = dim.where(of_hot)
    if few.limit(HOT_ROWS + 1).count() > HOT_ROWS:
        return fact.join(dim, key, "inner")
    return (fact.where(of_hot).join(F.broadcast(few), key, "inner")
            .unionByName(fact.where(~of_hot).join(dim.where(~of_hot), key, "inner")))
