"""Coverage of the scrape grid: every (category, difficulty, type) with its question count.

One scan and one partial aggregate: per observed category, a conditional count for every cell
of the fixed difficulty x type domain (a pivot), then the cells are exploded into rows.  Empty
combinations show up with 0; values outside the domains are not counted.  No join, no cross
join: the domains are literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.schemas import DIFFICULTIES, QUESTION_TYPES


def coverage_grid(questions: DataFrame, difficulties: list[str] = DIFFICULTIES,
                  types: list[str] = QUESTION_TYPES) -> DataFrame:
    """``category, difficulty, type, n_questions`` for the full grid."""
    cells = [(d, t) for d in difficulties for t in types]
    counts = questions.groupBy("category").agg(*[
        F.count(F.when((F.col("difficulty") == d) & (F.col("type") == t), F.lit(1))).alias(f"_c{i}")
        for i, (d, t) in enumerate(cells)
    ])
    grid = F.array(*[
        F.struct(F.lit(d).alias("difficulty"), F.lit(t).alias("type"), F.col(f"_c{i}").alias("n_questions"))
        for i, (d, t) in enumerate(cells)
    ])
    return counts.select("category", F.explode(grid).alias("_g")).select(
        "category", "_g.difficulty", "_g.type", F.col("_g.n_questions").cast("long").alias("n_questions"))


def first_categories(categories: DataFrame, n: int | None, order_col: str = "id") -> DataFrame:
    """Quick runs: only the first ``n`` categories by id (the limit is the feature; ``None`` = all)."""
    if n is None:
        return categories
    return categories.orderBy(order_col).limit(n)
