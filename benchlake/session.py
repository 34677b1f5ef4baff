"""Session helpers: local session for tests/bench and checkpoint-directory resolution."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "benchlake") -> SparkSession:
    """A local session for tests and the bench (the cluster supplies its own session)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; it is read from the
    session and used as is.  Only a *local* session without that setting (tests, the
    local bench) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="benchlake-ckpt-", dir=os.environ.get("BENCHLAKE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def materialize(df, eager: bool = True):
    """Cut lineage of a (small, derived) DataFrame through the reliable checkpoint dir.

    Never a local checkpoint: a lost executor must not lose the data.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def spread(df, *keys: str, min_tasks: int | None = None):
    """Give CPU-heavy per-row work (long-text regexes, hashing, model calls) enough tasks.

    A scan yields one task per Parquet row group, so a table stored as a few large row groups
    is processed by a few cores however many the session has.  When the scan has fewer input
    partitions than ``min_tasks`` (default: the session's parallelism) the rows are
    hash-partitioned on ``keys`` (deterministic on retry, no sort, balanced on a unique key).
    A large table already has many more splits than that: then this is a no-op and adds no
    shuffle.  Column pruning and filters still reach the scan through the repartition.
    """
    try:
        target = min_tasks or df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - a session without RDD access (Spark Connect): leave as is
        return df
    if splits >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)


# Derived tables with at most this many rows (per-group metadata such as counts, bounds or
# thresholds, never fact rows) are settled as local relations instead of checkpoints.
LOCAL_ROWS = 2048


def settle(df, max_rows: int = LOCAL_ROWS):
    """Materialise a small *derived* table and cut its lineage.

    At most ``max_rows`` rows (a bound checked here, not assumed) become a local relation that
    travels inside the plan; anything larger goes to the reliable checkpoint directory.
    Returns ``(dataframe, row_count)``.
    """
    from pyspark.sql import functions as F

    # One job: the limit bounds what is gathered (a bare limit-collect would scan incrementally).
    packed = df.limit(max_rows + 1).agg(F.collect_list(F.struct(*[F.col(c) for c in df.columns])).alias("r"))
    rows = packed.first()["r"]
    if len(rows) <= max_rows:
        return df.sparkSession.createDataFrame(rows, df.schema), len(rows)
    ck = materialize(df)
    return ck, ck.count()
