"""End-to-end flows: the steps of the reference's scripts as Spark jobs.

* ``bronze_from_payloads``: captured payloads -> raw batch archive + flat bronze CSV.
* ``bronze_to_silver``:     bronze CSV -> silver questions Parquet + load metrics.
* ``enrich``:               sample -> pending work (resume) -> prompts -> model -> graded
                            answers appended to the response log; failures stay pending.
* ``compact_responses``:    response log -> a *new* Parquet responses table.
* ``silver_to_gold``:       staging models + marts materialised, quality checks run.
* ``enrich_durably``:       like ``enrich``, but replies are stored slice by slice during the run.
* ``publish_gold``:         staging models + marts staged, audited, published as one version.
* ``publish_responses``:    response log -> next version of the published responses table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from benchlake.functions.prompts import validate_variants
from benchlake.operators import durable, gates, inference, marts, quality, sampling, views, worklist
from benchlake.plans import silver
from benchlake.schemas import AI_RESPONSES, QUESTIONS_RAW_COLUMNS
from benchlake.session import materialize
from benchlake.sources import bronze, files, versions


def utc_now_iso() -> str:
    """Load timestamp: the current UTC time as ISO-8601 text (taken once per load, on the driver)."""
    return datetime.now(timezone.utc).isoformat()


def bronze_from_payloads(payloads: DataFrame, raw_dir: str, csv_path: str, scraped_at: str | None = None,
                         payload_col: str = "payload", category_col: str | None = None,
                         batch_col: str | None = None, load_id: str = "1") -> DataFrame:
    """Archive decoded batches and write the flat bronze CSV; returns the dead letters.

    Every row of the load carries the same ``scraped_at`` (default: now, UTC); pass one to make
    a re-run reproducible.  ``batch_col`` orders the payloads (default: their order in the scan);
    batch and place go into the CSV, where keep-first de-duplication reads them.  A load that is
    run again replaces its own archive folder, and the CSV holds this load's rows only.
    """
    scraped_at = scraped_at or utc_now_iso()
    batches = bronze.decode_batches(payloads, payload_col, category_id=category_col, batch=batch_col)
    archive = bronze.load_path(raw_dir, load_id)
    bronze.write_raw_batches(batches, archive)
    flat = bronze.flatten_batches(bronze.read_raw_batches_lines(payloads.sparkSession, archive), scraped_at, "batch")
    files.write_bronze_csv(flat.select(*QUESTIONS_RAW_COLUMNS, F.col("_batch").alias("batch"), F.col("_pos").alias("pos")),
                           csv_path)
    return bronze.failed_payloads(payloads, payload_col)


def bronze_to_silver(spark: SparkSession, csv_path: str, out_path: str) -> DataFrame:
    """Clean the bronze CSV into silver Parquet; returns the one-row load metrics."""
    raw = files.read_bronze_csv(spark, csv_path, ordinal=True)
    return silver.write_silver(silver.clean_with_counts(raw), out_path)


def enrich(spark: SparkSession, questions: DataFrame, model_name: str, variants: list[str],
           client_factory: Callable[[], object], log_dir: str, sample_size: int | None = 300,
           seed: int = 42, concurrency: int | None = None) -> dict:
    """One enrichment run of a model, which must be named.

    Returns the counts {'added', 'failed', 'done_before'}, the mean seconds per successful call of
    this run ('mean_seconds_per_call', None when nothing was added), and of the log afterwards the
    rows and the model's accuracy ('total', 'accuracy').  ``concurrency`` clients call the model
    at a time (default: the session's parallelism)."""
    if not (model_name or "").strip():
        raise ValueError("a model name is required")
    variants = validate_variants(variants)  # fail before reading anything
    qs = sampling.stratified_sample(questions, sample_size, seed) if sample_size is not None else questions
    log = files.read_response_log(spark, log_dir)
    done_before = log.filter(F.col("model_name") == model_name).select("question_id", "prompt_variant").distinct().count()
    work = worklist.pending_worklist(qs, variants, model_name, log,
                                     keep=worklist.TEMPLATE_FIELDS + ["correct_answer"])
    raw = inference.infer(worklist.with_prompts(work, variants), client_factory,
                          concurrency or spark.sparkContext.defaultParallelism)
    # Persist the model replies once (calls are expensive); lineage is cut in the checkpoint dir.
    raw = materialize(raw)
    # The work list holds each key once and none that is stored, so every successful reply is a
    # new key: no second pass over the log.  The replies come from the checkpoint, not from the
    # log they are appended to.  Rows added and mean seconds per call are observed during the
    # append (its final stage, so a retried task does not count twice).
    new = inference.answers(raw, qs).select(*AI_RESPONSES.fieldNames())
    seen = Observation("run")
    files.append_response_log(
        new.observe(seen, F.count(F.lit(1)).alias("n"), F.avg("response_time").alias("s")), log_dir)
    summary = seen.get
    after = views.run_accuracy(files.read_response_log(spark, log_dir), model_name).first()
    return {"added": summary["n"], "failed": inference.dead_letters(raw).count(), "done_before": done_before,
            "mean_seconds_per_call": summary["s"], "total": after["n_total"], "accuracy": after["accuracy"]}


def compact_responses(spark: SparkSession, log_dir: str, out_path: str) -> DataFrame:
    """Rewrite the responses table (old + new answers) from the log into ``out_path``."""
    return files.compact_log(spark, log_dir, out_path)


def silver_to_gold(questions: DataFrame, responses: DataFrame, out_root: str) -> dict:
    """Materialise staging models and marts, then run the quality checks on them.

    Returns ``{'tables': {name: path}, 'failures': {check: failing rows}}``.
    """
    spark = questions.sparkSession
    paths = files.write_tables(marts.build_gold(responses, questions), out_root)
    t = {name: spark.read.parquet(p) for name, p in paths.items()}
    checks = {
        "unique_question_id": quality.unique(t["stg_questions"]),
        "not_null": quality.not_null({k: t[k] for k in quality.NOT_NULL}, failing_only=True),
        "accepted_values": quality.accepted_values(t["stg_questions"]),
        "orphan_responses": quality.orphans(t["stg_ai_responses"], t["stg_questions"]),
        "duplicate_response_keys": quality.response_keys(t["stg_ai_responses"]),
    }
    return {"tables": paths, "failures": {k: v.count() for k, v in checks.items()}}


def enrich_durably(spark: SparkSession, questions: DataFrame, model_name: str, variants: list[str],
                   client_factory: Callable[[], object], log_dir: str, store: str, sample_size: int | None = 300,
                   seed: int = 42, **run) -> dict:
    """One enrichment run whose replies survive its death (``operators.durable``); ``run`` are the
    options of ``durable.run_slices``.  Calling it again goes on where the last run stopped."""
    if not (model_name or "").strip():
        raise ValueError("a model name is required")
    variants = validate_variants(variants)
    qs = sampling.stratified_sample(questions, sample_size, seed) if sample_size is not None else questions
    done = durable.run_slices(qs, variants, model_name, client_factory, store, log_dir, **run)
    after = views.run_accuracy(files.read_response_log(spark, log_dir), model_name).first()
    return done | {"total": after["n_total"], "accuracy": after["accuracy"]}


def publish_gold(questions: DataFrame, responses: DataFrame, root: str, keep: int = 2) -> tuple[versions.Version, list]:
    """Build all gold tables, audit the staging models as written and publish them as one version.
    A failing check raises ``gates.GateFailed`` and leaves the version in force."""
    return gates.publish_checked(questions.sparkSession, marts.build_gold(responses, questions), root, keep=keep)


def publish_responses(spark: SparkSession, log_dir: str, root: str, keep: int = 2) -> versions.Version:
    """Rewrite the responses table from the log and swap it in; readers keep the version they opened."""
    done = versions.publish(spark, {"ai_responses": files.read_response_log(spark, log_dir)}, root)
    versions.retain(spark, root, keep)
    return done
