"""Work planning: questions x prompt variants for one model, minus the keys already answered.

The fan-out over variants is a ``explode`` of the (validated, tiny) variant list, so the plan
has no cross join; resuming is an anti join on the logical response key against the response
history (``joins.anti_join_growing``: the history is scanned, not shuffled, while this run's
work list is within a proven bound).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.functions.prompts import prompt_expr, validate_variants
from benchlake.operators.joins import anti_join_growing
from benchlake.schemas import RESPONSE_KEY

TEMPLATE_FIELDS = ["question", "category", "difficulty", "type"]


def done_keys(responses: DataFrame, model_name: str | None = None) -> DataFrame:
    """Distinct response keys already stored (optionally of one model)."""
    keys = responses.select(*RESPONSE_KEY)
    if model_name is not None:
        keys = keys.filter(F.col("model_name") == model_name)
    return keys.distinct()


def done_counts(responses: DataFrame) -> DataFrame:
    """Per model: number of distinct (question, variant) keys already answered."""
    return responses.groupBy("model_name").agg(
        F.count_distinct("question_id", "prompt_variant").alias("n_done")
    )


def pending_worklist(questions: DataFrame, variants: list[str], model_name: str,
                     responses: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """Pending ``(question_id, prompt_variant, model_name)`` work items (+ ``keep`` columns)."""
    variants = validate_variants(variants)
    keep = [c for c in (keep or []) if c in questions.columns and c != "question_id"]
    work = questions.select(
        "question_id", *keep,
        F.explode(F.array(*[F.lit(v) for v in variants])).alias("prompt_variant"),
        F.lit(model_name).alias("model_name"),
    )
    if responses is not None:
        done = responses.select(*RESPONSE_KEY).filter(F.col("model_name") == model_name)
        work = anti_join_growing(work, done, RESPONSE_KEY)
    return work


def with_prompts(work: DataFrame, variants: list[str] | None = None) -> DataFrame:
    """Add the prompt text of each work item (needs the template fields on ``work``)."""
    return work.withColumn("prompt", prompt_expr("prompt_variant", variants))
