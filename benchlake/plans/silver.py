"""Bronze -> silver questions: strip, keep-first de-duplication, stable ids, ordered choices.

Steps (one Spark plan, one exchange of the texts, no window over a key):

1. strip the six text columns (Unicode whitespace, like Python ``str.strip``);
2. ``question_id`` = first 16 hex of SHA-256(``category::question``);
3. keep the first row of each id by ingest ordinal (``min_by``).  Exact duplicates on (category,
   type, difficulty, question, correct_answer) share their id, so this one step drops them and
   the id collisions (same category and question, other content);
4. ``choices`` = wrong answers + right answer in an id-seeded order.

How many rows and exact keys lie behind each id is counted beside it, over hashes of fixed
width, and joined on the id: the texts are already partitioned on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from benchlake.functions.text import choices, question_id, strip
from benchlake.operators.dedup import keep_first
from benchlake.operators.quality import wrong_choice_count
from benchlake.schemas import CLEAN_METRICS, QUESTIONS_CLEAN, QUESTIONS_RAW_COLUMNS

TEXT_COLUMNS = [c for c in QUESTIONS_RAW_COLUMNS if c != "scraped_at"]
EXACT_KEY = [c for c in TEXT_COLUMNS if c != "incorrect_answers"]
SILVER_COLUMNS = QUESTIONS_CLEAN.fieldNames()


def strip_columns(bronze: DataFrame, columns: list[str] = TEXT_COLUMNS) -> DataFrame:
    return bronze.select(*[strip(c).alias(c) if c in columns else F.col(c) for c in bronze.columns])


def dedupe_exact(bronze: DataFrame, ordinal: str = "_ordinal") -> DataFrame:
    """Stripped rows, first of each exact-duplicate key, with ``_n_raw`` rows of the key."""
    return keep_first(strip_columns(bronze), EXACT_KEY, ordinal, count_col="_n_raw")


def _with_id(bronze: DataFrame) -> DataFrame:
    """Stripped rows with ``question_id``, and ``_key``, the id with '' for NULL."""
    rows = strip_columns(bronze).withColumn("question_id", question_id("category", "question"))
    return rows.withColumn("_key", F.coalesce("question_id", F.lit("")))


def dedupe_id(bronze: DataFrame, ordinal: str = "_ordinal") -> DataFrame:
    """Stripped rows with ``question_id``, first of each id; ``ordinal`` is unique."""
    return keep_first(_with_id(bronze), ["_key"], ordinal, short_keys=True)


def id_counts(bronze: DataFrame) -> DataFrame:
    """Per id (``_of``): ``_n_raw`` rows and ``_n_keys`` distinct exact keys, counted over hashes."""
    parts = [x for c in EXACT_KEY for x in (F.col(c), F.col(c).isNull())]
    keys = (_with_id(bronze).groupBy(F.col("_key").alias("_of"), F.xxhash64(*parts).alias("_k1"), F.hash(*parts).alias("_k2"))
            .agg(F.count(F.lit(1)).alias("_n")))
    return keys.groupBy("_of").agg(F.sum("_n").alias("_n_raw"), F.count(F.lit(1)).alias("_n_keys"))


def dedupe_id_with_counts(bronze: DataFrame, ordinal: str = "_ordinal") -> DataFrame:
    """``dedupe_id`` plus the counts of each id."""
    first, counts = dedupe_id(bronze, ordinal), id_counts(bronze)
    return first.join(counts, first["_key"] == counts["_of"]).drop("_key", "_of")


def _with_choices(deduped: DataFrame) -> DataFrame:
    return deduped.withColumn("choices", choices("question_id", "incorrect_answers", "correct_answer"))


def clean_with_counts(bronze: DataFrame, ordinal: str = "_ordinal") -> DataFrame:
    """Silver columns plus the ``_n_raw``/``_n_keys`` counters used by the metrics."""
    return _with_choices(dedupe_id_with_counts(bronze, ordinal)).select(*SILVER_COLUMNS, "_n_raw", "_n_keys")


def clean_questions(bronze: DataFrame, ordinal: str = "_ordinal") -> DataFrame:
    """Silver questions (T4)."""
    return _with_choices(dedupe_id(bronze, ordinal)).select(*SILVER_COLUMNS)


def metric_columns() -> list:
    """Load metrics as aggregate expressions over ``clean_with_counts`` rows."""
    return [
        F.sum("_n_raw").cast("long").alias("rows_read"),
        (F.sum("_n_raw") - F.sum("_n_keys")).cast("long").alias("exact_duplicates"),
        (F.sum("_n_keys") - F.count(F.lit(1))).cast("long").alias("id_collisions"),
        F.count(F.when(wrong_choice_count("type"), F.lit(1))).cast("long").alias("bad_choice_counts"),
        F.count(F.lit(1)).cast("long").alias("rows_written"),
    ]


def clean_metrics(cleaned_with_counts: DataFrame) -> DataFrame:
    """One row: rows read, exact duplicates, id collisions, bad choice counts, rows written."""
    return cleaned_with_counts.agg(*metric_columns())


def write_silver(cleaned_with_counts: DataFrame, path: str) -> DataFrame:
    """Write the silver questions and return the load metrics (one row) of that same write.

    The metrics are observed while the rows are written (no second pass, no intermediate
    table).  The observation sits in the write's final stage, whose accumulator updates Spark
    applies once per partition, so a retried task does not count twice.
    """
    seen = Observation("load_metrics")
    (cleaned_with_counts.observe(seen, *metric_columns()).select(*SILVER_COLUMNS)
     .write.mode("overwrite").parquet(path))
    values = seen.get
    spark = cleaned_with_counts.sparkSession
    return spark.createDataFrame([tuple(values[f] for f in CLEAN_METRICS.fieldNames())], CLEAN_METRICS)
