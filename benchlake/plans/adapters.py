"""Adapters: the domain tables expressed over the driver's parquet tables.

The driver ships TPC-H-like tables plus text tables, not quiz data.  Every operator is therefore
exercised on these relations, which are valid both as Spark DataFrames and as DuckDB SQL
(``*_SQL`` strings are the oracle side of the same definitions):

* responses (R)  <- lineitem: two "models" (line status), three "variants" (return flag),
  correctness from the discount, whole-number latencies from the quantity.
* questions (Q)  <- part: 25 brands as categories, 6 types as difficulties.
* bronze questions (B) <- documents: long multilingual texts with exact and near copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.session import spread

# Fixed mapping of the return flag onto the prompt-variant keys of the registry.
VARIANT_OF_FLAG = {"N": "naive", "A": "strict_format", "R": "role_expert"}


# Long-text tables and their row keys: per-row work on them (regexes, hashes, base64, prompts,
# model calls) is CPU-heavy, so their scans are spread over the session's cores (see ``spread``).
TEXT_TABLES = {"documents": "doc_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, TEXT_TABLES[name]) if name in TEXT_TABLES else df


def _variant(flag: Column) -> Column:
    expr = F.when(flag == "N", "naive")
    for k in ("A", "R"):
        expr = expr.when(flag == k, VARIANT_OF_FLAG[k])
    return expr.otherwise(flag)


def responses(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """R: ``question_id, model_name, prompt_variant, ai_answer, ai_correct, response_time``, and
    ``more`` columns of the table."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("question_id"),
        F.col("l_linestatus").alias("model_name"),
        _variant(F.col("l_returnflag")).alias("prompt_variant"),
        F.col("l_linenumber").cast("string").alias("ai_answer"),
        (F.col("l_discount") <= F.lit(0.03)).alias("ai_correct"),
        F.col("l_quantity").alias("response_time"),
        *more,
    )


VARIANT_SQL = """case l_returnflag when 'N' then 'naive' when 'A' then 'strict_format'
         when 'R' then 'role_expert' else l_returnflag end"""
RESPONSES_SQL = f"""(select l_partkey as question_id, l_linestatus as model_name, {VARIANT_SQL} as prompt_variant,
    cast(l_linenumber as varchar) as ai_answer, (l_discount <= 0.03) as ai_correct, l_quantity as response_time from lineitem)"""


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q: silver-like questions ``question_id, category, type, difficulty, question, correct_answer``."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("question_id"),
        F.col("p_brand").alias("category"),
        F.when(F.col("p_size") <= 25, "multiple").otherwise("boolean").alias("type"),
        F.col("p_type").alias("difficulty"),
        F.col("p_name").alias("question"),
        F.element_at(F.split(F.col("p_name"), " "), -1).alias("correct_answer"),
    )


QUESTIONS_SQL = """(select p_partkey as question_id, p_brand as category,
    case when p_size <= 25 then 'multiple' else 'boolean' end as type,
    p_type as difficulty, p_name as question,
    string_split(p_name, ' ')[-1] as correct_answer from part)"""


def answer_words() -> Column:
    """Stand-in answers of a document: the right one, then three wrong ones."""
    return F.array("source", "lang", F.sha2("text", 256), F.lit(" "))


ANSWERS_SQL = "[source, lang, sha256(text), ' ']"


def bronze_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B: bronze rows (all text) from ``documents`` plus the ingest ordinal ``_ordinal``.

    category <- source, difficulty <- lang, question <- text, correct answer <- source,
    incorrect answers <- JSON array of the language, the whole text's digest and a blank one
    (which exercises the drop rule).
    """
    docs = table(spark, sf_dir, "documents")
    words = answer_words()
    return docs.select(
        F.col("source").alias("category"),
        F.when(F.col("n_chars") < 1000, "boolean").otherwise("multiple").alias("type"),
        F.col("lang").alias("difficulty"),
        F.col("text").alias("question"),
        F.element_at(words, 1).alias("correct_answer"),
        F.to_json(F.slice(words, 2, 3)).alias("incorrect_answers"),
        F.lit("2024-01-01T00:00:00+00:00").alias("scraped_at"),
        F.col("doc_id").alias("_ordinal"),
    )


BRONZE_SQL = f"""(select source as category,
    case when n_chars < 1000 then 'boolean' else 'multiple' end as type,
    lang as difficulty, text as question, {ANSWERS_SQL}[1] as correct_answer,
    to_json({ANSWERS_SQL}[2:4]) as incorrect_answers,
    '2024-01-01T00:00:00+00:00' as scraped_at, doc_id as _ordinal from documents)"""


DONE_MODEL = "model-a"


def done_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Already-stored responses (response-log shape) derived from ``labels``: one key per label."""
    lab = table(spark, sf_dir, "labels")
    return lab.select(
        F.col("doc_id").alias("question_id"),
        F.lit(DONE_MODEL).alias("model_name"),
        F.when(F.col("quality") == 1, "naive").otherwise("strict_format").alias("prompt_variant"),
        F.lit(None).cast("string").alias("ai_answer"),
        (F.col("toxic") == 0).alias("ai_correct"),
        F.lit(None).cast("double").alias("response_time"),
    )


DONE_SQL = f"""(select doc_id as question_id, '{DONE_MODEL}' as model_name,
    case when quality = 1 then 'naive' else 'strict_format' end as prompt_variant,
    cast(null as varchar) as ai_answer, (toxic = 0) as ai_correct, cast(null as double) as response_time
    from labels)"""
