"""Explicit schemas of every table in the medallion (never inferred)."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

S = StringType()

# One question inside an API payload or a raw batch (text fields; base64 in payloads).
QUESTION_STRUCT = StructType(
    [
        StructField("category", S),
        StructField("type", S),
        StructField("difficulty", S),
        StructField("question", S),
        StructField("correct_answer", S),
        StructField("incorrect_answers", ArrayType(S)),
    ]
)

# T1: API envelope.
API_ENVELOPE = StructType(
    [StructField("response_code", IntegerType()), StructField("results", ArrayType(QUESTION_STRUCT))]
)

# T2: one raw batch document (decoded questions).  ``batch`` numbers the documents of a load; an
# archive with one document per file has none, its file names order it.
RAW_BATCH = StructType(
    [
        StructField("category", IntegerType()),
        StructField("difficulty", S),
        StructField("type", S),
        StructField("questions", ArrayType(QUESTION_STRUCT)),
        StructField("batch", LongType()),
    ]
)

# T3: bronze flat table, all strings.
QUESTIONS_RAW_COLUMNS = [
    "category",
    "type",
    "difficulty",
    "question",
    "correct_answer",
    "incorrect_answers",
    "scraped_at",
]
QUESTIONS_RAW = StructType([StructField(c, S) for c in QUESTIONS_RAW_COLUMNS])
# Where a bronze row comes from: the batch's number and the place in it, written after the columns of T3.
ARRIVAL = StructType([StructField("batch", LongType()), StructField("pos", LongType())])

# T4: silver questions.
QUESTIONS_CLEAN = StructType(
    [
        StructField("question_id", S),
        StructField("category", S),
        StructField("type", S),
        StructField("difficulty", S),
        StructField("question", S),
        StructField("correct_answer", S),
        StructField("choices", ArrayType(S)),
        StructField("scraped_at", S),
    ]
)

# T5: silver responses / response-log row.
AI_RESPONSES = StructType(
    [
        StructField("question_id", S),
        StructField("model_name", S),
        StructField("prompt_variant", S),
        StructField("ai_answer", S),
        StructField("ai_correct", BooleanType()),
        StructField("response_time", DoubleType()),
    ]
)

RESPONSE_KEY = ["question_id", "prompt_variant", "model_name"]

# Registry of prompt variants as a table.
PROMPT_VARIANTS = StructType(
    [StructField("key", S), StructField("label", S), StructField("description", S)]
)

# Load metrics of the bronze -> silver step.
CLEAN_METRICS = StructType(
    [
        StructField("rows_read", LongType()),
        StructField("exact_duplicates", LongType()),
        StructField("id_collisions", LongType()),
        StructField("bad_choice_counts", LongType()),
        StructField("rows_written", LongType()),
    ]
)

# Fixed domains (values of the reference data model).
DIFFICULTIES = ["easy", "medium", "hard"]
QUESTION_TYPES = ["multiple", "boolean"]
