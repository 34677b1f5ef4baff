"""Durable inference: replies become permanent while a run goes on, a slice of calls at a time.

The questions with something pending are written once, dealt to slices by a hash of their id.  Each
slice is a job of its own: it calls the model and writes the replies as one folder of the reply
store, which Spark's committer makes visible as a whole.  ``in_flight`` slices run at a time, so a
slow one doesn't hold up the others.  From its folder a slice's answers go into the response log
(one slice after the other, as Spark's committer takes one writer per folder), then the folder is
marked as applied.

What a run that dies loses are the calls of the slices in flight.  The next run first applies folders
that were written but not marked (keys that reached the log are left out), then plans what is
neither in the log nor failed for good, and calls only that.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from benchlake.operators import inference, worklist
from benchlake.operators.joins import anti_join_growing
from benchlake.schemas import AI_RESPONSES, RESPONSE_KEY
from benchlake.session import ensure_checkpoint_dir
from benchlake.sources import files

#: Calls of a slice, by default, and slices that run at a time.
SLICE_CALLS, IN_FLIGHT = 10_000, 2
APPLIED = "_APPLIED"


def _fs(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def reply_folders(spark: SparkSession, store: str, applied: bool) -> list[str]:
    """Complete reply folders of the store, those whose answers are marked as logged or the others."""
    folder, fs = _fs(spark, store)
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        path = status.getPath().toString()
        has = lambda name, path=path: fs.exists(_fs(spark, f"{path}/{name}")[0])
        if has("_SUCCESS") and has(APPLIED) == applied:
            out.append(path)
    return sorted(out)


def apply_folder(spark: SparkSession, folder: str, log_dir: str, recovering: bool = False) -> None:
    """Append a folder's successful answers to the log and mark the folder.

    When recovering, keys that the log already has are left out: the run may have died between
    the two steps.  Otherwise the keys are new by construction."""
    new = inference.answers(spark.read.parquet(folder)).select(*AI_RESPONSES.fieldNames())
    if recovering:
        new = anti_join_growing(new, files.read_response_log(spark, log_dir), RESPONSE_KEY)
    files.append_response_log(new, log_dir)
    path, fs = _fs(spark, f"{folder}/{APPLIED}")
    fs.create(path, True).close()


def recover(spark: SparkSession, store: str, log_dir: str) -> int:
    """Apply the folders that an earlier run wrote but did not log; returns how many."""
    folders = reply_folders(spark, store, applied=False)
    for folder in folders:
        apply_folder(spark, folder, log_dir, recovering=True)
    return len(folders)


def plan_slices(questions: DataFrame, variants: list[str], model_name: str, log: DataFrame, slice_calls: int) -> tuple[str, int, int]:
    """Write the questions with pending variants, by slice; returns the folder, slices and calls.

    A question's text is written once, however many variants are pending."""
    spark = questions.sparkSession
    keys = worklist.pending_worklist(questions.select("question_id"), variants, model_name, log)
    root = f"{ensure_checkpoint_dir(spark)}/pending-{uuid.uuid4().hex}"
    pending = keys.groupBy(F.col("question_id").alias("of")).agg(F.sort_array(F.collect_set("prompt_variant")).alias("pending"))
    pending.write.parquet(f"{root}/keys")  # at most one entry per variant in a row
    pending = spark.read.parquet(f"{root}/keys")
    calls = pending.agg(F.coalesce(F.sum(F.size("pending")), F.lit(0))).first()[0]
    slices = -(-calls // slice_calls)
    if slices:
        rows = questions.select("question_id", *worklist.TEMPLATE_FIELDS, "correct_answer").join(pending, F.col("question_id") == F.col("of"))
        (rows.drop("of").withColumn("slice", F.pmod(F.xxhash64("question_id"), F.lit(slices)).cast("int"))
         .write.partitionBy("slice").parquet(f"{root}/questions"))
    return f"{root}/questions", slices, calls


def run_slices(questions: DataFrame, variants: list[str], model_name: str, client_factory: Callable[[], object], store: str,
               log_dir: str, slice_calls: int = SLICE_CALLS, in_flight: int = IN_FLIGHT, concurrency: int | None = None,
               on_progress: Callable[[dict], None] | None = None) -> dict:
    """Recover, then call the model for everything pending; returns the run's counts.

    ``questions`` has the template fields and correct_answer, each question_id once.  ``concurrency``
    clients work on a slice at a time.  After each slice ``on_progress`` gets the counts so far
    (slices, calls, failed, mean_seconds_per_call).  If a slice fails, slices not yet started are
    dropped, those in flight finish, and the error is raised; what was stored stays."""
    if slice_calls < 1 or in_flight < 1:
        raise ValueError("slice_calls and in_flight must be at least 1")
    spark = questions.sparkSession
    recovered = recover(spark, store, log_dir)
    folder, slices, calls = plan_slices(questions, variants, model_name, files.read_response_log(spark, log_dir), slice_calls)
    so_far = {"slices": 0, "calls": 0, "failed": 0, "seconds": 0.0}
    lock, run = threading.Lock(), uuid.uuid4().hex

    def one(k: int) -> None:
        path = f"{folder}/slice={k}"
        if not files._exists(spark, path):  # a slice may be empty
            return
        work = spark.read.parquet(path).withColumn("prompt_variant", F.explode("pending")).withColumn("model_name", F.lit(model_name))
        raw = inference.infer(worklist.with_prompts(work, variants), client_factory, concurrency)
        replies = f"{store.rstrip('/')}/{run}-{k:06d}"
        seen = Observation(f"slice {k}")
        raw.observe(seen, F.count(F.lit(1)).alias("calls"), F.count("error").alias("failed"), F.coalesce(
            F.sum(F.when(F.col("error").isNull(), F.col("response_time"))), F.lit(0.0)).alias("seconds")).write.parquet(replies)  # the durable step
        with lock:  # two jobs that append to one folder at a time would remove each other's temporary files
            apply_folder(spark, replies, log_dir)
            for name, x in {"slices": 1, **seen.get}.items():
                so_far[name] += x
            if on_progress:
                ok = so_far["calls"] - so_far["failed"]
                on_progress({k: so_far[k] for k in ("slices", "calls", "failed")}
                            | {"mean_seconds_per_call": so_far["seconds"] / ok if ok else None})

    with ThreadPoolExecutor(in_flight) as pool:
        started = [pool.submit(one, k) for k in range(slices)]
        done, _ = wait(started, return_when=FIRST_EXCEPTION)
        broken = next((f.exception() for f in done if f.exception()), None)
        if broken:
            pool.shutdown(wait=True, cancel_futures=True)
            raise broken
    ok = so_far["calls"] - so_far["failed"]
    return {"recovered_slices": recovered, "slices": slices, "pending": calls, "added": ok, "failed": so_far["failed"],
            "mean_seconds_per_call": so_far["seconds"] / ok if ok else None}
