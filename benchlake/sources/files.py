"""File readers and writers for every table format of the medallion (explicit schemas only).

* CSV bronze table: header, all strings, RFC-4180 quoting (quotes doubled, embedded newlines),
  blanks kept as ``''`` (Spark reads an empty field as NULL, hence the ``coalesce``).
* JSONL response log: one JSON object per line, blank lines ignored, a missing log is empty.
* Parquet silver/gold tables.
* Named sources: ``{root}/{name}.parquet`` like the external-location template of the models.

Multi-line CSV/JSON is not splittable: ingest many files and compact to Parquet once.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from benchlake.schemas import AI_RESPONSES, ARRIVAL, QUESTIONS_RAW

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}


def read_bronze_csv(spark: SparkSession, path: str, schema: StructType = QUESTIONS_RAW,
                    ordinal: bool = False) -> DataFrame:
    """Bronze CSV as all-string columns with blanks kept.

    ``ordinal`` adds ``_ordinal`` for keep-first de-duplication: batch number and place in the
    batch where the file has them (``write_bronze_csv`` with ``arrival``), then the file's name
    and the row's place in it, which alone order files without them."""
    df = spark.read.schema(StructType(schema.fields + ARRIVAL.fields)).options(**CSV_OPTIONS).csv(path)
    extra = []
    if ordinal:
        extra = [F.struct(*ARRIVAL.fieldNames(), F.col("_metadata.file_name").alias("file"),
                          F.monotonically_increasing_id().alias("row")).alias("_ordinal")]
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in schema.fieldNames()], *extra)


def write_bronze_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header + every field quoted, quotes doubled: reads back identically (Spark or Python csv)."""
    # The CSV writer trims leading/trailing whitespace unless told not to: keep texts exact.
    (df.write.mode(mode).options(**CSV_OPTIONS).option("quoteAll", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("emptyValue", "").csv(path))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_response_log(spark: SparkSession, path: str, schema: StructType = AI_RESPONSES) -> DataFrame:
    """JSONL response log; an absent log reads as an empty table (first run)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


#: Rows of a compressed log file at most: such a file is read by one task.
LOG_FILE_ROWS = 1 << 15


def append_response_log(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Append-only log: one JSON object per line, never rewriting earlier answers.

    Rows also carry when their increment was appended (``increment``, nanoseconds of the driver's
    clock) and their position in it (``row``); the merge orders arrivals by both.  With ``compression`` (such as
    gzip) files hold at most ``LOG_FILE_ROWS`` rows; readers tell them by their names."""
    w = (df.select(*AI_RESPONSES.fieldNames())
         .withColumn("increment", F.lit(time.time_ns())).withColumn("row", F.monotonically_increasing_id())
         .write.mode("append"))
    if compression:
        w = w.option("compression", compression).option("maxRecordsPerFile", LOG_FILE_ROWS)
    w.json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def compact_log(spark: SparkSession, log_path: str, out_path: str) -> DataFrame:
    """Rewrite the whole response table from the log into a *new* path (never the one read)."""
    df = read_response_log(spark, log_path)
    write_parquet(df, out_path)
    return spark.read.parquet(out_path)


class Catalog:
    """Named sources (``source(name)`` -> ``{root}/{name}.parquet``) and temp views of models."""

    def __init__(self, spark: SparkSession, root: str, template: str = "{root}/{name}.parquet"):
        self.spark, self.root, self.template = spark, root.rstrip("/"), template

    def path(self, name: str) -> str:
        return self.template.format(root=self.root, name=name)

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def register(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(name)
        return df

    def sql(self, query: str, args: list | dict | None = None) -> DataFrame:
        """Parameterised read (positional ``?`` or named ``:x`` markers); no args allowed."""
        return self.spark.sql(query, args=args) if args else self.spark.sql(query)


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> dict[str, str]:
    """Materialise models as Parquet tables (``{root}/{name}``); returns the paths written."""
    out = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(path)
        out[name] = path
    return out
