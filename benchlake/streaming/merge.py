"""Idempotent merge of new answers into the response table, in batch or incremental form.

Semantics: the response table holds at most one answer per logical key
``(question_id, prompt_variant, model_name)``; the *first* answer of a key wins and is never
rewritten.  New rows are reduced to the first row per key (by an explicit arrival ordinal,
never ``dropDuplicates``), then anti-joined against the keys already stored and appended.
Replaying the same input adds nothing, so a retried micro-batch or job is harmless.

The incremental form is a Structured Streaming query over the JSON response-log directory with
``trigger(availableNow=True)`` and ``foreachBatch``.  The log rows carry no event time, so a
watermark-bounded dedup state is impossible; the anti-join against the stored table keeps the
streaming state empty instead.  The query's checkpoint lies beside the target table unless a
location is given.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from benchlake.operators.dedup import keep_first
from benchlake.operators.joins import BROADCAST_KEYS, anti_join_growing
from benchlake.schemas import AI_RESPONSES, RESPONSE_KEY
from benchlake.sources.history import Appended, History


def has_key() -> Column:
    """Whether a row names its question, variant and model.  Rows that don't are no answers to
    anything: the merge leaves them out, ``where(~has_key())`` finds them in the log."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(k).cast("string") != "", F.lit(False)) for k in RESPONSE_KEY])


def first_per_key(new: DataFrame, ordinal: str | None = None) -> DataFrame:
    """First row of every response key (``ordinal`` orders arrivals; default: the row itself)."""
    if ordinal is None:
        new = new.withColumn("_arrival", F.lit(0))
        ordinal = "_arrival"
    return keep_first(new, RESPONSE_KEY, ordinal, partitioned=True).drop("_arrival")


def new_answers(existing: DataFrame, new: DataFrame, ordinal: str | None = None,
                broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet (first per key).

    The stored table grows without bound while an increment is small: ``anti_join_growing``
    reads the stored keys without shuffling them while the increment's key count is bounded.
    Answers are shuffled once: the first rows stay partitioned on their keys for the join.
    ``new`` is evaluated twice (size check, merge): pass a materialised increment when it is
    expensive to recompute (model replies).
    """
    fresh = first_per_key(new, ordinal)
    return anti_join_growing(fresh, existing, RESPONSE_KEY, broadcast_keys)


def merge_responses(existing: DataFrame, new: DataFrame, ordinal: str | None = None) -> DataFrame:
    """Stored rows plus the new keys' first answers (old answers are never replaced)."""
    cols = AI_RESPONSES.fieldNames()
    added = new_answers(existing, new, ordinal).select(*cols)
    return existing.select(*cols).unionByName(added)


def _table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_target(spark: SparkSession, target_path: str) -> DataFrame:
    """The response table (partitioned by ``model_name``), read with its explicit schema."""
    if _table_exists(spark, target_path):
        return spark.read.schema(AI_RESPONSES).parquet(target_path)
    return spark.createDataFrame([], AI_RESPONSES)


# A micro-batch naming more models than this is merged against the whole table (no pruning).
PRUNE_MODELS = 256


def append_new(batch: DataFrame, target_path: str, ordinal: str | None = None) -> int:
    """Append the batch's unseen keys to the Parquet table at ``target_path``; returns rows added.

    The table is partitioned by ``model_name``: the anti-join reads only the partitions of the
    models present in the batch (a small, checked set), not the whole history.  Rows without a
    complete key are left out.
    """
    spark = batch.sparkSession
    batch = batch.where(has_key())
    existing = read_target(spark, target_path)
    models = batch.select("model_name").distinct().limit(PRUNE_MODELS + 1).collect()
    if len(models) <= PRUNE_MODELS:
        existing = existing.filter(F.col("model_name").isin([r["model_name"] for r in models]))
    added = new_answers(existing, batch, ordinal).select(*AI_RESPONSES.fieldNames())
    # One job reads the target and appends to it.  That is safe: the target's files are listed
    # when ``existing`` is created, and appended files appear only at the job's commit.  A
    # replayed batch finds its rows already stored and adds nothing.  The added rows are
    # counted while they are written (an observation), not by a second pass.
    seen = Observation("merged")
    added.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").option("compression", "zstd").partitionBy(
        "model_name").parquet(target_path)
    return int(seen.get["n"])


def _log_stream(spark: SparkSession, log_dir: str) -> DataFrame:
    """The log's rows with ``_arrival``, which orders the rows of a micro-batch."""
    schema = StructType([*AI_RESPONSES.fields, StructField("row", LongType()), StructField("increment", LongType())])
    return (spark.readStream.schema(schema).json(log_dir)
            .withColumn("_arrival", F.struct(
                F.coalesce("increment", F.lit(0)).alias("increment"), F.when(F.col("increment").isNull(), F.struct(
                    F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_name").alias("name"))).alias("file"),
                F.coalesce("row", F.lit(0)).alias("row"))).drop("row", "increment"))


def stream_into_history(spark: SparkSession, log_dir: str, store: History, checkpoint_location: str,
                        name: str = "log") -> list[Appended]:
    """``stream_merge`` into an indexed history: a micro-batch opens only files that may hold its keys.

    A batch is the increment ``<name>-<epoch>``, so one that is replayed after a failure adds
    nothing; streams with checkpoints of their own need names of their own."""
    done = []

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        done.append(store.append(batch.where(has_key()), f"{name}-{epoch_id}", "_arrival"))

    q = (_log_stream(spark, log_dir).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return done


def stream_merge(spark: SparkSession, log_dir: str, target_path: str,
                 checkpoint_location: str | None = None) -> int:
    """Incrementally merge every log file not processed yet (``availableNow``), then stop.

    The first answer of a key wins.  Rows of one micro-batch are ordered by arrival: increment and
    row as ``append_response_log`` wrote them; files without those come first, by
    modification time and name.  The stream's checkpoint lies beside the target unless a location is
    given, so a later application goes on where this one ended.
    """
    if checkpoint_location is None:
        checkpoint_location = f"{target_path.rstrip('/')}-checkpoint"
    stream = _log_stream(spark, log_dir)
    added = {"rows": 0}

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # Read twice (model list, merge): keep the micro-batch for its duration only; a lost
        # block is recomputed from the log files.
        batch.persist()
        try:
            added["rows"] += append_new(batch, target_path, ordinal="_arrival")
        finally:
            batch.unpersist()

    q = (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return added["rows"]
