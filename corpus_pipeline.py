"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's documents.  All but the last
return the columns of documents.  Each stage works on everything that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.llm import decontam, jaccard_join, line_dedup, packing, quality
from benchlake.llm.common import SPACE, materialise

#: No stage can be written in SQL as a whole: trained model, sampled hashes, tokenizer.
ORACLE_SQL = None


def inside(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with all columns but ``used`` under positional names, so that they can't clash with
    the columns that a stage adds."""
    return docs.toDF(*[c if c in used else f"__in{i}" for i, c in enumerate(docs.columns)])


def outside(out: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of ``docs`` again, from a stage's result over ``inside(docs, *used)``."""
    return out.select(*[F.col(c if c in used else f"__in{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, unchanged."""
    own = inside(docs, "doc_id", "text")
    judged = quality.judge(own, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=tuple(c for c in own.columns if c != "doc_id"))
    return outside(judged.where("kept"), docs, "doc_id", "text")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat across documents; n_chars follows the text."""
    own = inside(docs, "doc_id", "text", "n_chars")
    rest = tuple(c for c in own.columns if c not in ("doc_id", "text", "n_chars"))
    out = line_dedup.dedup_lines(own, carry=rest).withColumnRenamed("kept", "text")
    return outside(out.withColumn("n_chars", F.char_length("text").cast("long")), docs, "doc_id", "text", "n_chars")


def keyed(docs: DataFrame) -> DataFrame:
    """``inside(docs, "doc_id", "text")`` with a key of each row, ``__row``, written with it: a doc_id may be
    missing or repeat."""
    return materialise(inside(docs, "doc_id", "text").withColumn("__row", F.monotonically_increasing_id()))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of a ``keyed`` table whose key is not in ``gone``."""
    return docs.join(gone.select(F.col("__row").alias("__gone")), F.col("__row") == F.col("__gone"), "left_anti").drop("__row")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near-duplicates.

    Every row is judged by its own text, so rows that repeat a doc_id with another text both stay.
    Of the rows of a class without a doc_id one stays as well.  Rows without a word are no
    near-duplicates; those that repeat doc_id and text stay once."""
    rows = keyed(docs)
    ids = rows.select(F.col("__row"), "doc_id")
    classes = jaccard_join.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"))
    linked = materialise(classes.where("n_links > 0").withColumnRenamed("doc_id", "__member")
                         .join(ids, F.col("__member") == F.col("__row")).select("__row", "doc_id", "class_id"))
    first = linked.groupBy("class_id", F.col("doc_id").isNull()).agg(F.min(F.struct("doc_id", "__row")).alias("least"))
    blank = rows.where(F.translate(F.coalesce("text", F.lit("")), SPACE, "") == "").select("__row", "doc_id", "text")
    once = blank.groupBy("doc_id", "text").agg(F.min("__row").alias("__kept"))
    kept = first.select(F.col("least.__row").alias("__kept")).unionByName(once.select("__kept"))
    judged = linked.select("__row").unionByName(blank.select("__row"))
    return outside(without(rows, judged.join(kept, F.col("__row") == F.col("__kept"), "left_anti")), docs, "doc_id", "text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item; every row is judged by its own text."""
    rows = keyed(docs)
    found = decontam.contaminated(rows.select(F.col("__row").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return outside(without(rows, found.select(F.col("doc_id").alias("__row")).distinct()), docs, "doc_id", "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
