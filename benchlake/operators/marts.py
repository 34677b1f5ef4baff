"""Staging models and the five gold marts.

Marts follow the SQL semantics of the reference models: a NULL ``ai_correct`` counts as
incorrect, rates are averages of DOUBLE literals rounded to 4 places (a decimal literal would
round twice), latencies are rounded to 2 places, medians are exact and interpolated.

Plan shape at scale: every mart is a hash aggregate with a partial (map-side) phase, so a hot
model/variant group never reaches one task as rows; exact medians come from the order-statistic
operator (a bracket, then exact counts inside it) instead of Spark's per-group value map.  The category/difficulty
marts broadcast the question dimension when it fits the broadcast threshold; otherwise they
pre-aggregate responses per (question, model, variant) before the shuffle join, so a hot
question reaches the join as a few rows.  ``build_gold`` computes two small shared aggregates
and rolls every mart up from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.operators.joins import fits_broadcast, skew_join
from benchlake.operators.order_stats import exact_median, join_null_safe
from benchlake.session import settle

RESPONSE_COLUMNS = ["question_id", "model_name", "prompt_variant", "ai_answer", "ai_correct", "response_time"]


def correct_flag(col: str = "ai_correct") -> Column:
    """1.0 for a correct answer, 0.0 otherwise (NULL counts as incorrect). DOUBLE on purpose."""
    return F.when(F.col(col), F.lit(1.0)).otherwise(F.lit(0.0))


def accuracy(col: str = "ai_correct", ndigits: int | None = 4) -> Column:
    rate = F.avg(correct_flag(col))
    return F.round(rate, ndigits) if ndigits is not None else rate


def n_correct(col: str = "ai_correct") -> Column:
    return F.sum(F.when(F.col(col), F.lit(1)).otherwise(F.lit(0))).cast("long")


# ---------------------------------------------------------------- staging models

def stg_questions(questions: DataFrame) -> DataFrame:
    """Staging projection of silver questions (``type`` -> ``question_type``)."""
    return questions.select(
        "question_id", "category", F.col("type").alias("question_type"), "difficulty",
        "question", "correct_answer",
    )


def stg_ai_responses(responses: DataFrame) -> DataFrame:
    """Staging projection of the responses; a missing contract column is an error."""
    return responses.select(*RESPONSE_COLUMNS)


def responses_enriched(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """Responses joined to their question's category/type/difficulty (inner: orphans vanish).

    The question dimension is broadcast by the planner when its size estimate is under the
    broadcast threshold.  Otherwise hot questions are joined where they were read and only the
    rest is shuffled with its answers (``joins.skew_join``).
    """
    q = questions.select("question_id", "category", "question_type", "difficulty")
    r = stg_ai_responses(responses)
    return r.join(q, "question_id", "inner") if fits_broadcast(q) else skew_join(r, q, "question_id")


# ---------------------------------------------------------------- marts

def _with_median(base: DataFrame, responses: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the exact median of response_time to a per-group aggregate."""
    return join_null_safe(base, exact_median(responses, keys, "response_time", "_median"), keys, "left")


def _latency_bounds() -> list[Column]:
    return [F.count("response_time").alias("_n"), F.min("response_time").alias("_lo"),
            F.max("response_time").alias("_hi")]


def key_aggregate(responses: DataFrame, keys: tuple[str, ...] = ("model_name", "prompt_variant")) -> DataFrame:
    """Every decomposable measure of the model-level marts per (model, variant): count, correct,
    latency sum, non-null latency count, min and max.  A handful of rows, from one partial
    aggregation; the per-model and per-(model, variant) marts roll up from it.
    """
    return responses.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_cnt"), F.sum(correct_flag()).alias("_ok"),
        F.sum("response_time").alias("_lat_sum"), *_latency_bounds(),
    )


def _rollup(pre: DataFrame, keys: list[str]) -> DataFrame:
    """Roll a key aggregate up to ``keys``: count, correct, latency sum, non-null count, min, max."""
    return pre.groupBy(*keys).agg(
        F.sum("_cnt").alias("n_responses"), F.sum("_ok").alias("_ok"), F.sum("_lat_sum").alias("_lat_sum"),
        F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
    )


def _rolled_rates() -> list[Column]:
    """Accuracy and mean latency of a roll-up (the same quotients ``avg`` computes)."""
    return [F.round(F.col("_ok") / F.col("n_responses"), 4).alias("accuracy"),
            F.round(F.col("_lat_sum") / F.col("_n"), 2).alias("latency_mean_s")]


def _model_base(responses: DataFrame, pre: DataFrame | None) -> DataFrame:
    keys = ["model_name"]
    if pre is None:
        return responses.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n_responses"),
            n_correct().alias("n_correct"),
            accuracy().alias("accuracy"),
            F.round(F.avg("response_time"), 2).alias("latency_mean_s"),
            *_latency_bounds(),
        )
    return _rollup(pre, keys).select(*keys, "n_responses", F.col("_ok").cast("long").alias("n_correct"),
                                     *_rolled_rates(), "_n", "_lo", "_hi")


def _model_finish(with_median: DataFrame) -> DataFrame:
    return with_median.select("model_name", "n_responses", "n_correct", "accuracy", "latency_mean_s",
                              F.round("_median", 2).alias("latency_median_s"))


def model_rates(responses: DataFrame) -> DataFrame:
    """Per model: responses, correct answers, accuracy and mean latency, without the median."""
    return _model_base(responses, None).drop("_n", "_lo", "_hi")


def model_performance(responses: DataFrame, pre: DataFrame | None = None) -> DataFrame:
    """Per model: responses, correct answers, accuracy, mean and median latency.

    ``pre`` (a ``key_aggregate`` of ``responses``) replaces the scan for everything but the median.
    """
    return _model_finish(_with_median(_model_base(responses, pre), responses, ["model_name"]))


def prompt_performance(responses: DataFrame, pre: DataFrame | None = None) -> DataFrame:
    """Per (model, variant): responses, accuracy, mean latency."""
    keys = ["model_name", "prompt_variant"]
    if pre is not None:
        return _rollup(pre, keys).select(*keys, "n_responses", *_rolled_rates())
    return responses.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_responses"),
        accuracy().alias("accuracy"),
        F.round(F.avg("response_time"), 2).alias("latency_mean_s"),
    )


def _latency_base(responses: DataFrame, pre: DataFrame | None) -> DataFrame:
    keys = ["model_name", "prompt_variant"]
    if pre is None:
        return responses.groupBy(*keys).agg(
            F.round(F.min("response_time"), 2).alias("latency_min_s"),
            F.round(F.avg("response_time"), 2).alias("latency_mean_s"),
            F.round(F.max("response_time"), 2).alias("latency_max_s"),
            *_latency_bounds(),
        )
    return _rollup(pre, keys).select(
        *keys, F.round("_lo", 2).alias("latency_min_s"), _rolled_rates()[1],
        F.round("_hi", 2).alias("latency_max_s"), "_n", "_lo", "_hi")


def _latency_finish(with_median: DataFrame) -> DataFrame:
    return with_median.select("model_name", "prompt_variant", "latency_min_s", "latency_mean_s",
                              F.round("_median", 2).alias("latency_median_s"), "latency_max_s")


def response_time(responses: DataFrame, pre: DataFrame | None = None) -> DataFrame:
    """Per (model, variant): min / mean / median / max latency."""
    keys = ["model_name", "prompt_variant"]
    return _latency_finish(_with_median(_latency_base(responses, pre), responses, keys))


def _per_question(responses: DataFrame) -> DataFrame:
    """Pre-aggregate responses per (question, model, variant) before the dimension join."""
    return responses.groupBy("question_id", "model_name", "prompt_variant").agg(
        F.count(F.lit(1)).alias("_cnt"), F.sum(correct_flag()).alias("_ok")
    )


def dimension_aggregate(responses: DataFrame, questions: DataFrame, dims: list[str]) -> DataFrame:
    """Responses joined to their question (inner: orphans vanish), counted per
    ``dims + (model, variant)``: ``n_responses`` and ``_ok`` (correct answers)."""
    q = questions.select("question_id", *dims)
    if fits_broadcast(q):
        # Small dimension: broadcast join, then one aggregate with a map-side partial phase.
        pre = responses.join(F.broadcast(q), "question_id", "inner").select(
            *dims, "model_name", "prompt_variant", F.lit(1).cast("long").alias("_cnt"), correct_flag().alias("_ok"))
    else:
        # Large dimension: partial-aggregate the fact per (question, model, variant) before the
        # shuffle join, so a hot question reaches the join as a few rows, not a third of the data.
        pre = _per_question(responses).join(q, "question_id", "inner")
    return pre.groupBy(*dims, "model_name", "prompt_variant").agg(
        F.sum("_cnt").alias("n_responses"), F.sum("_ok").alias("_ok"))


def _accuracy_by(responses: DataFrame, questions: DataFrame, dim: str, pre: DataFrame | None = None) -> DataFrame:
    """``pre``: a ``dimension_aggregate`` whose dimensions include ``dim`` (rolled up here)."""
    if pre is None:
        agg = dimension_aggregate(responses, questions, [dim])
    else:
        agg = pre.groupBy(dim, "model_name", "prompt_variant").agg(
            F.sum("n_responses").alias("n_responses"), F.sum("_ok").alias("_ok"))
    return agg.select(dim, "model_name", "prompt_variant", "n_responses",
                      F.round(F.col("_ok") / F.col("n_responses"), 4).alias("accuracy"))


def category_accuracy(responses: DataFrame, questions: DataFrame, pre: DataFrame | None = None) -> DataFrame:
    """Per (category, model, variant) on responses joined to questions."""
    return _accuracy_by(responses, questions, "category", pre)


def difficulty_accuracy(responses: DataFrame, questions: DataFrame, pre: DataFrame | None = None) -> DataFrame:
    """Per (difficulty, model, variant) on responses joined to questions."""
    return _accuracy_by(responses, questions, "difficulty", pre)


def build_gold(responses: DataFrame, questions: DataFrame) -> dict[str, DataFrame]:
    """All staging models and marts, keyed by table name (materialise with ``sinks.write_tables``).

    Two small aggregates are computed once and settled: per (model, variant) over all responses
    (three model-level marts roll up from it), and per (category, difficulty, model, variant)
    over the joined responses (the two accuracy marts).  Each median adds two scans of two columns.
    """
    stq = stg_questions(questions)
    by_variant, _ = settle(key_aggregate(responses))
    by_dims, _ = settle(dimension_aggregate(responses, questions, ["category", "difficulty"]))
    return {
        "stg_questions": stq,
        "stg_ai_responses": stg_ai_responses(responses),
        "stg_responses_enriched": responses_enriched(responses, stq),
        "fct_model_performance": model_performance(responses, pre=by_variant),
        "fct_prompt_performance": prompt_performance(responses, pre=by_variant),
        "fct_category_accuracy": category_accuracy(responses, questions, pre=by_dims),
        "fct_difficulty_accuracy": difficulty_accuracy(responses, questions, pre=by_dims),
        "fct_response_time": response_time(responses, pre=by_variant),
    }
