"""Answer grading as native Column expressions.

Rule: both texts are normalised.  When the expected answer normalises to ``true`` or ``false``
the reply is correct if *any* of its words belongs to the matching equivalence set (word level).
Otherwise the reply is correct if the normalised expected answer is non-empty and occurs in the
normalised reply as a substring (``art`` is found in ``party``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.functions.text import normalise

# Accepted equivalents for true/false questions.
TRUE_WORDS = ["true", "vrai", "oui", "yes"]
FALSE_WORDS = ["false", "faux", "non", "no"]


def _lit_array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def grade_normalised(norm_answer: Column, norm_correct: Column) -> Column:
    """Grade already-normalised texts (never NULL: a NULL reply is incorrect)."""
    a = F.coalesce(norm_answer, F.lit(""))
    c = F.coalesce(norm_correct, F.lit(""))
    words = F.split(a, " ")
    return (
        F.when(c == "true", F.arrays_overlap(words, _lit_array(TRUE_WORDS)))
        .when(c == "false", F.arrays_overlap(words, _lit_array(FALSE_WORDS)))
        .otherwise((c != F.lit("")) & (F.instr(a, c) > 0))
    )


def is_correct(answer: Column, correct: Column) -> Column:
    return grade_normalised(normalise(answer), normalise(correct))


def grade(df: DataFrame, answer: str = "ai_answer", correct: str = "correct_answer",
          out: str = "ai_correct") -> DataFrame:
    """Add ``out``; the normalised texts are projected once and reused by the three branches."""
    tmp = df.withColumn("__na", normalise(answer)).withColumn("__nc", normalise(correct))
    return tmp.withColumn(out, grade_normalised(F.col("__na"), F.col("__nc"))).drop("__na", "__nc")


def regrade(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """Recompute ``ai_correct`` of stored responses from their raw answers (after a grader change)."""
    q = questions.select("question_id", "correct_answer")
    return grade(responses.drop("ai_correct").join(q, "question_id", "inner")).drop("correct_answer")
