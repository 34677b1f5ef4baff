"""Batch inference: send work-item prompts to a model, one client per Python worker partition.

``infer`` runs a user-supplied client inside ``mapInPandas`` (Arrow batches in and out).  Each
prompt is sent on its own and timed around the call; a failing call yields an ``error`` and no
answer, so the item stays pending and is retried by the next run (``answers``/``dead_letters``
split the two).  Cleaning and grading happen afterwards in native expressions.

The client factory must be picklable; it is called once per task, not per row.  Calls are
at-least-once (a retried task calls the model again); rows are exactly-once because merging
into the response table is keyed (``streaming.merge``).
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from benchlake.functions.grading import grade
from benchlake.functions.text import strip_reasoning
from benchlake.schemas import RESPONSE_KEY

# Task closures reference this module (the offline client, for one): ship it by value, so the
# Python workers need no installed copy of the package (any working directory, any executor).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Deterministic settings of a model call (fixed values).
MAX_TOKENS = 400
TEMPERATURE = 0.0


class EchoClient:
    """Deterministic offline model for tests and the driver query: replies with the whole prompt
    (no network, no randomness)."""

    def __init__(self, max_tokens: int = MAX_TOKENS, temperature: float = TEMPERATURE):
        self.config = {"maxTokens": max_tokens, "temperature": temperature}

    def ask(self, prompt: str) -> str:
        if not prompt:
            raise ValueError("empty prompt")
        return prompt


def _output_schema(work: DataFrame, carry: list[str]) -> StructType:
    return StructType([
        work.schema["question_id"],
        StructField("model_name", StringType()),
        StructField("prompt_variant", StringType()),
        StructField("ai_answer", StringType()),
        StructField("response_time", DoubleType()),
        StructField("error", StringType()),
    ] + [work.schema[c] for c in carry])


def infer(work: DataFrame, client_factory: Callable[[], object] = EchoClient, concurrency: int | None = None) -> DataFrame:
    """``work`` (question_id, prompt_variant, model_name, prompt) -> raw answers with latency.

    With ``concurrency`` the items are dealt by their key to that many tasks, each with a client
    of its own; without it the tasks are those of ``work``.

    A ``correct_answer`` column on the work items is carried through, so grading needs no
    join back to the questions.
    """
    carry = [c for c in ("correct_answer",) if c in work.columns]
    schema = _output_schema(work, carry)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for pdf in batches:
            answers, seconds, errors = [], [], []
            for prompt in pdf["prompt"]:
                start = time.perf_counter()
                try:
                    answers.append(client.ask(prompt))
                    errors.append(None)
                except Exception as exc:  # noqa: BLE001 - isolate one failing item
                    answers.append(None)
                    errors.append(f"{type(exc).__name__}: {exc}")
                seconds.append(time.perf_counter() - start)
            out = {
                "question_id": pdf["question_id"], "model_name": pdf["model_name"],
                "prompt_variant": pdf["prompt_variant"], "ai_answer": answers,
                "response_time": seconds, "error": errors,
            }
            for c in carry:
                out[c] = pdf[c]
            yield pd.DataFrame(out)

    cols = work.select("question_id", "model_name", "prompt_variant", "prompt", *carry)
    if concurrency:
        cols = cols.repartition(concurrency, *RESPONSE_KEY)
    return cols.mapInPandas(run, schema)


def answers(raw: DataFrame, questions: DataFrame | None = None) -> DataFrame:
    """Successful calls, reasoning stripped and graded against the question's correct answer
    (carried on ``raw``, or looked up in ``questions``)."""
    ok = raw.filter(F.col("error").isNull()).drop("error")
    ok = ok.withColumn("ai_answer", strip_reasoning("ai_answer"))
    if "correct_answer" in ok.columns:
        joined = ok
    else:
        joined = ok.join(questions.select("question_id", "correct_answer"), "question_id", "inner")
    graded = grade(joined, "ai_answer", "correct_answer", "ai_correct")
    return graded.select("question_id", "model_name", "prompt_variant", "ai_answer", "ai_correct", "response_time")


def dead_letters(raw: DataFrame) -> DataFrame:
    """Failed calls: they are not written to the response log, so they stay pending."""
    return raw.filter(F.col("error").isNotNull())
