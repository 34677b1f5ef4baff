"""Bronze ingestion: captured API payloads and raw batch documents -> flat question rows.

The HTTP client of the scraper is not part of this engine; its payloads are data.  Decoding is
native: ``from_json`` with an explicit schema, ``inline``/``posexplode`` of the question array,
and base64 -> UTF-8 with ``try_to_binary`` (a malformed field becomes NULL, not a failed job).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.functions.text import b64decode
from benchlake.schemas import API_ENVELOPE, QUESTIONS_RAW_COLUMNS, RAW_BATCH

# API response codes (fixed values of the quiz API).
RC_SUCCESS = 0
RC_NO_RESULTS = 1

SCALAR_FIELDS = ["category", "type", "difficulty", "question", "correct_answer"]


def decode_question(q: Column) -> list[Column]:
    """Base64-decoded fields of one question struct."""
    return [b64decode(q[f]).alias(f) for f in SCALAR_FIELDS] + [
        F.transform(q["incorrect_answers"], b64decode).alias("incorrect_answers")
    ]


def _undecodable(q: Column) -> Column:
    """Whether a decoded question lacks a field (malformed base64 or UTF-8, or absent)."""
    lost = q["incorrect_answers"].isNull() | F.exists(q["incorrect_answers"], lambda x: x.isNull())
    for f in SCALAR_FIELDS:
        lost = lost | q[f].isNull()
    return lost


def _judged(payloads: DataFrame, payload_col: str, keep: list) -> DataFrame:
    """``keep`` columns, ``_qs``, the decoded questions of a successful payload, and ``_reason``,
    why it failed (NULL: it didn't).

    A question that can't be decoded fails its whole payload.  The parse, the decoding and the
    verdict are one projection each, and callers explode the verdict instead of filtering on it: a
    Filter would be pushed below with ``from_json`` inlined into every condition.
    """
    env = payloads.select(*keep, F.from_json(F.col(payload_col), API_ENVELOPE).alias("_env"))
    code = F.col("_env.response_code")
    decoded = F.transform("_env.results", lambda q: F.struct(*decode_question(q)))
    env = env.withColumn("_qs", F.when(code == RC_SUCCESS, decoded))
    reason = (F.when(F.col("_env").isNull() | code.isNull(), F.lit("malformed"))
              .when(code != RC_SUCCESS, F.concat(F.lit("response_code="), code.cast("string")))
              .when(F.coalesce(F.size("_qs"), F.lit(0)) <= 0, F.lit("empty"))
              .when(F.exists("_qs", _undecodable), F.lit("undecodable")))
    return env.withColumn("_reason", reason).drop("_env")


def decode_payloads(payloads: DataFrame, payload_col: str = "payload",
                    carry: list[str] | None = None) -> DataFrame:
    """Payload JSON text -> one row per question of a successful payload that decodes as a whole.

    ``carry`` columns (e.g. a payload id) are kept; ``_pos`` is the question's position.
    """
    carry = carry or []
    rows = _judged(payloads, payload_col, carry).select(
        *carry, F.posexplode(F.when(F.col("_reason").isNull(), F.col("_qs"))).alias("_pos", "q"))
    return rows.select(*carry, "_pos", "q.*")


def read_raw_batches(spark, path: str) -> DataFrame:
    """Scan raw batch documents (one pretty-printed JSON document per file)."""
    return (
        spark.read.option("multiLine", True).schema(RAW_BATCH).json(path)
        .withColumn("_file", F.col("_metadata.file_name"))
    )


def flatten_batches(batches: DataFrame, scraped_at: str | Column, batch_col: str = "_file") -> DataFrame:
    """Raw batches -> bronze rows (T3) plus the ingest ordinal ``(_batch, _pos)``.

    ``batch_col`` names the batch: its number, or its file's name where a file is one document.

    Wrong answers are JSON-encoded (a separator join would break answers containing it).
    ``scraped_at`` is passed in, so re-running a load is reproducible.
    """
    ts = F.lit(scraped_at) if isinstance(scraped_at, str) else scraped_at
    exploded = batches.select(F.col(batch_col).alias("_batch"), F.posexplode("questions").alias("_pos", "q"))
    return exploded.select(
        *[F.col(f"q.{f}").alias(f) for f in SCALAR_FIELDS],
        F.to_json(F.col("q.incorrect_answers")).alias("incorrect_answers"),
        ts.alias("scraped_at"),
        "_batch", "_pos",
    ).select(*QUESTIONS_RAW_COLUMNS, "_batch", "_pos")


def decode_batches(payloads: DataFrame, payload_col: str = "payload", carry: list[str] | None = None,
                   category_id: str | Column | None = None, batch: str | Column | None = None) -> DataFrame:
    """Payload JSON text -> one decoded raw-batch row per payload that succeeded
    (``category, difficulty, type, questions, batch``), the shape archived by ``write_raw_batches``.

    ``batch`` orders the payloads of the load (default: their order in the scan)."""
    carry = carry or []
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    cat = F.lit(None) if category_id is None else as_col(category_id)
    number = F.monotonically_increasing_id() if batch is None else as_col(batch)
    judged = _judged(payloads, payload_col, [*carry, cat.cast("int").alias("_cat"), number.cast("long").alias("_batch")])
    first = F.col("_qs").getItem(0)
    doc = F.struct(F.col("_cat").alias("category"), first["difficulty"].alias("difficulty"), first["type"].alias("type"),
                   F.col("_qs").alias("questions"), F.col("_batch").alias("batch"))
    return judged.select(*carry, F.explode(F.when(F.col("_reason").isNull(), F.array(doc))).alias("_b")).select(*carry, "_b.*")


def failed_payloads(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Dead letters: payloads that are not JSON envelopes, report an API error, are empty or hold
    a question that can't be decoded.

    A failed request loses only its own rows; everything else of the load goes on.
    """
    failed = F.explode(F.when(F.col("_reason").isNotNull(), F.array("_reason"))).alias("reason")
    return _judged(payloads, payload_col, payloads.columns).select(*payloads.columns, failed)


def load_path(raw_dir: str, load_id: str) -> str:
    """Folder of one load's batches: running a load again replaces it and no other."""
    return f"{raw_dir.rstrip('/')}/load-{load_id}"


def write_raw_batches(batches: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Archive decoded batches as JSON (non-ASCII kept as is), one document per line."""
    batches.write.mode(mode).json(path)


def read_raw_batches_lines(spark, path: str) -> DataFrame:
    """Read an archive written by ``write_raw_batches`` (one document per line)."""
    return spark.read.schema(RAW_BATCH).json(path).withColumn("_file", F.col("_metadata.file_name"))
