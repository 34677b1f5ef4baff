"""Data-quality checks.  Each returns the *failing* rows (empty = pass).

Reproduces the declarative checks of the staging models (unique, not_null, accepted_values,
with NULLs ignored by unique/accepted_values) plus the load-time warnings (choice counts, id
collisions), orphan responses hidden by the inner join, and duplicate response keys.
Every check is one aggregate pass (partial aggregation), never a collect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.operators.dedup import duplicate_report
from benchlake.schemas import DIFFICULTIES, QUESTION_TYPES, RESPONSE_KEY

# Declarative checks of the staging models: table -> not-null columns.
NOT_NULL = {
    "stg_questions": ["question_id", "category", "question_type", "difficulty"],
    "stg_ai_responses": ["question_id", "model_name", "prompt_variant"],
    "stg_responses_enriched": ["question_id"],
}
ACCEPTED = {"question_type": QUESTION_TYPES, "difficulty": DIFFICULTIES}


def unique(df: DataFrame, column: str = "question_id") -> DataFrame:
    """Values of ``column`` occurring more than once (NULLs ignored)."""
    return duplicate_report(df, [column])


def not_null(tables: dict[str, DataFrame], spec: dict[str, list[str]] = NOT_NULL,
             failing_only: bool = False) -> DataFrame:
    """``table_name, column_name, n_nulls``: one aggregate pass per table for all its columns."""
    parts = []
    for name, cols in spec.items():
        df = tables[name]
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in cols])
        stacked = counts.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("n_nulls"))
            for c in cols
        ])).alias("s")).select("s.*")
        parts.append(stacked)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("n_nulls") > 0) if failing_only else out


def accepted_values(df: DataFrame, spec: dict[str, list[str]] = ACCEPTED) -> DataFrame:
    """``column_name, value, n_rows`` for values outside the accepted domain (NULLs ignored)."""
    # One scan for all checked columns: each row yields one (column, value, bad) item per column.
    items = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                 (F.col(c).isNotNull() & ~F.col(c).isin(allowed)).alias("bad"))
        for c, allowed in spec.items()
    ])
    bad = df.select(F.explode(items).alias("_i")).filter(F.col("_i.bad"))
    return bad.groupBy("_i.column_name", "_i.value").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "column_name", "value", "n_rows")


def wrong_choice_count(kind: str) -> Column:
    """Whether the number of choices does not fit the type in column ``kind`` (4 multiple, 2 boolean)."""
    n = F.size("choices")
    return ((F.col(kind) == "multiple") & (n != 4)) | ((F.col(kind) == "boolean") & (n != 2))


def choice_count(questions: DataFrame) -> DataFrame:
    """Questions whose number of choices does not fit their type."""
    return questions.filter(wrong_choice_count("type")).select("question_id", "type", F.size("choices").alias("n_choices"))


def orphans(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """Responses whose question is missing (the inner join would drop them): per question id."""
    # Count per question first (partial aggregation: a hot question is reduced map-side), then
    # the anti join sees one row per question and reuses the aggregate's partitioning.
    per_question = responses.groupBy("question_id").agg(F.count(F.lit(1)).alias("n_responses"))
    return per_question.join(questions.select("question_id"), "question_id", "left_anti")


def response_keys(responses: DataFrame) -> DataFrame:
    """Logical response keys stored more than once."""
    return duplicate_report(responses, RESPONSE_KEY)
