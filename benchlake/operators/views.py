"""Parameterised dashboard views over staging tables and marts.

Filters are arguments: ``None`` means "all values" (no predicate), an empty selection is an
error (nothing to show, and ``IN ()`` is not valid SQL).  Filters are plain ``isin`` predicates,
so Catalyst pushes them into the Parquet scan (``PushedFilters: In(...)``) and prunes columns.
Aggregation stays on the executors; only the (tiny) aggregated result ever reaches the driver.
Page-level rates are unrounded averages over the filtered rows, NULL ``ai_correct`` counting as
incorrect like in the marts.  Rows without a grouping key belong to no group and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benchlake.functions.prompts import registry_frame
from benchlake.operators.marts import accuracy, dimension_aggregate
from benchlake.schemas import DIFFICULTIES

# Colour palette assigned to entities in sorted order (slot = position mod 8).
PALETTE = ["#2a78d6", "#eb6834", "#1baf7a", "#eda100", "#e87ba4", "#008300", "#4a3aa7", "#e34948"]


def _selection(values: list[str] | None, what: str) -> list[str] | None:
    if values is None:
        return None
    values = list(values)
    if not values:
        raise ValueError(f"select at least one {what}")
    return values


def filter_selection(df: DataFrame, models: list[str] | None = None,
                     variants: list[str] | None = None) -> DataFrame:
    """``model_name IN models AND prompt_variant IN variants`` (``None`` = no predicate)."""
    models = _selection(models, "model")
    variants = _selection(variants, "prompt variant")
    if models is not None:
        df = df.filter(F.col("model_name").isin(models))
    if variants is not None:
        df = df.filter(F.col("prompt_variant").isin(variants))
    return df


def _rank(order: list[Column], name: str) -> Column:
    """Display position on an aggregated (small) result: ``row_number`` cast to BIGINT."""
    return F.row_number().over(Window.orderBy(*order)).cast("long").alias(name)


def overview_kpis(responses: DataFrame, models=None, variants=None) -> DataFrame:
    """Response count, accuracy and mean latency over the current selection (one row)."""
    df = filter_selection(responses, models, variants)
    return df.agg(
        F.count(F.lit(1)).alias("n_responses"),
        accuracy(ndigits=None).alias("accuracy"),
        F.avg("response_time").alias("latency_mean_s"),
    )


def overview_by_model(responses: DataFrame, models=None, variants=None) -> DataFrame:
    """Per model: accuracy, count and mean latency, with the two chart orders."""
    df = filter_selection(responses, models, variants).dropna(subset=["model_name"])
    agg = df.groupBy("model_name").agg(
        accuracy(ndigits=None).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
        F.avg("response_time").alias("latency_mean_s"),
    )
    return agg.select(
        "*",
        _rank([F.col("accuracy"), F.col("model_name")], "accuracy_order"),
        _rank([F.col("latency_mean_s"), F.col("model_name")], "latency_order"),
    )


def _by_dim(responses: DataFrame, questions: DataFrame, dim: str, models, variants) -> DataFrame:
    """Accuracy and count per (dim, model), rolled up from the aggregate that the marts use: beyond
    the broadcast size the responses are counted per question before they are joined."""
    df = filter_selection(responses, models, variants).dropna(subset=["model_name"])
    counts = dimension_aggregate(df, questions.dropna(subset=[dim]), [dim]).groupBy(dim, "model_name").agg(
        F.sum("n_responses").alias("n"), F.sum("_ok").alias("_ok"))
    return counts.select(dim, "model_name", (F.col("_ok") / F.col("n")).alias("accuracy"), "n")


def category_by_model(responses: DataFrame, questions: DataFrame, models=None, variants=None) -> DataFrame:
    """Per (category, model): accuracy and count; table order = accuracy descending."""
    agg = _by_dim(responses, questions, "category", models, variants)
    return agg.select(
        "*", _rank([F.col("accuracy").desc(), F.col("category"), F.col("model_name")], "display_order")
    )


def difficulty_rank(c: Column | str) -> Column:
    """Domain order easy < medium < hard; other values after them."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for i, d in enumerate(DIFFICULTIES, start=1):
        expr = F.when(col == d, F.lit(i)) if expr is None else expr.when(col == d, F.lit(i))
    return expr.otherwise(F.lit(len(DIFFICULTIES) + 1))


def difficulty_by_model(responses: DataFrame, questions: DataFrame, models=None, variants=None) -> DataFrame:
    """Per (difficulty, model): accuracy and count, with the domain order of the difficulty."""
    agg = _by_dim(responses, questions, "difficulty", models, variants)
    return agg.withColumn("difficulty_rank", difficulty_rank("difficulty"))


def category_order(responses: DataFrame, questions: DataFrame, models=None, variants=None) -> DataFrame:
    """Categories ranked by the unweighted mean over models of their per-model accuracy."""
    per_model = _by_dim(responses, questions, "category", models, variants)
    per_cat = per_model.groupBy("category").agg(F.avg("accuracy").alias("mean_accuracy"))
    return per_cat.select("*", _rank([F.col("mean_accuracy"), F.col("category")], "category_rank"))


def prompt_comparison(responses: DataFrame, models=None, spark: SparkSession | None = None) -> DataFrame:
    """Per (variant, model): accuracy, count and mean latency, with the variant's registry label."""
    df = filter_selection(responses, models, None).dropna(subset=["prompt_variant", "model_name"])
    agg = df.groupBy("prompt_variant", "model_name").agg(
        accuracy(ndigits=None).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
        F.avg("response_time").alias("latency_mean_s"),
    )
    reg = registry_frame(spark or responses.sparkSession).select(
        F.col("key").alias("prompt_variant"), F.col("label").alias("variant_label")
    )
    # The registry is a handful of rows: a broadcast of a proven size.
    return agg.join(F.broadcast(reg), "prompt_variant", "left")


def home_kpis(questions: DataFrame, model_perf: DataFrame) -> DataFrame:
    """Question count, number of models, total responses and best accuracy (one row)."""
    # The question count is a scalar subquery of the one-row mart aggregate: no join at all.
    n_questions = questions.agg(F.count(F.lit(1))).scalar()
    return model_perf.agg(
        F.count(F.lit(1)).alias("n_models"),
        F.sum("n_responses").cast("long").alias("n_responses"),
        F.max("accuracy").alias("best_accuracy"),
    ).select(n_questions.alias("n_questions"), "n_models", "n_responses", "best_accuracy")


def model_leaderboard(model_perf: DataFrame) -> DataFrame:
    """Model-performance mart for display: accuracy in percent, ranked by accuracy."""
    return model_perf.select(
        "*",
        (F.col("accuracy") * F.lit(100.0)).alias("accuracy_pct"),
        _rank([F.col("accuracy").desc(), F.col("model_name")], "leaderboard_rank"),
    )


def universes(responses: DataFrame) -> DataFrame:
    """Complete (unfiltered) sorted universes of models and variants: ``kind, value, position``."""
    # One scan for both universes: every row names its model and its variant; the distinct is a
    # partial aggregate, so each map task ships at most (models + variants) rows.
    pairs = F.array(
        F.struct(F.lit("model").alias("kind"), F.col("model_name").alias("value")),
        F.struct(F.lit("prompt_variant").alias("kind"), F.col("prompt_variant").alias("value")),
    )
    both = responses.select(F.explode(pairs).alias("_u")).select("_u.kind", "_u.value").distinct()
    pos = F.row_number().over(Window.partitionBy("kind").orderBy("value")).cast("long")
    return both.select("kind", "value", pos.alias("position"))


def entity_slots(responses: DataFrame) -> DataFrame:
    """Stable colour slot of every entity: its position in the full sorted universe, mod 8.

    Built from the unfiltered universe, so filtering a page never re-colours an entity.
    """
    u = universes(responses)
    slot = ((F.col("position") - 1) % F.lit(len(PALETTE))).cast("int")
    palette = F.array(*[F.lit(c) for c in PALETTE])
    return u.select("kind", "value", slot.alias("slot"), F.element_at(palette, slot + 1).alias("color"))


def run_accuracy(responses: DataFrame, model_name: str) -> DataFrame:
    """Run summary: rows in the table, rows of the model and the model's accuracy (one row)."""
    is_model = F.col("model_name") == F.lit(model_name)
    return responses.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count(F.when(is_model, F.lit(1))).alias("n_model"),
        F.avg(F.when(is_model, F.when(F.col("ai_correct"), F.lit(1.0)).otherwise(F.lit(0.0)))).alias("accuracy"),
    )


def display_kpis(kpis: DataFrame) -> DataFrame:
    """Display strings for the home KPIs: thousands separated by a space, rate as ``12.3%``."""
    return kpis.select(
        F.regexp_replace(F.format_number(F.col("n_questions"), 0), ",", " ").alias("questions"),
        F.col("n_models").cast("string").alias("models"),
        F.col("n_responses").cast("string").alias("responses"),
        F.format_string("%.1f%%", F.col("best_accuracy") * F.lit(100.0)).alias("best_accuracy"),
    )
