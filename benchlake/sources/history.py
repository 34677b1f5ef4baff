"""A growing table with one row per key, and an index that says which files may hold a key.

A store is a folder on any Hadoop file system:

* ``data/increment=<name>-<id>/bucket=<b>/``: the rows that an increment added, dealt to buckets by
  the 64-bit hash of their key and sorted by it;
* ``index/<name>/files``: one row per data file; ``index/<name>/words``: its Bloom filter, a row
  per 64-bit word (16 bits a key, four of them in one word);
* ``buckets=<n>``: how many buckets the store was made with.

``append`` looks the increment's key hashes up in the filters, reads only the files that may hold
one of them, and adds the first row of each key that isn't stored.  A stored key is in one file, so
the files read follow the increment's stored keys (and a few false finds), not the history; of the
history itself only the index grows in each append, some three bytes a key.

An increment is there once its index folder has its final name, one rename after everything was
written.  A run that dies before leaves data that nobody reads, and appending an increment that is
there adds nothing, so retries are harmless.  One writer at a time.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from benchlake.operators.dedup import keep_first
from benchlake.operators.joins import anti_join_growing
from benchlake.session import materialize
from benchlake.sources.versions import Conflict, _path

BUCKETS, FILE_ROWS = 64, 1_000_000
#: Beyond so many files an increment reads the whole history: their names go through the driver.
MAX_FILES = 10_000
FILES = "file string, folder string, bucket int, rows long, n_words long"
WORDS = "file string, word long, mask long"


class Appended(NamedTuple):
    rows: int  # rows added
    files_read: int  # data files opened to find stored keys
    files: int  # data files of the history before


def _mask(h: Column) -> Column:
    """Four bits of a word, by the hash of the hash."""
    mixed = F.xxhash64(h, F.lit(1))
    bits = [F.pmod(F.shiftright(mixed, 6 * i), F.lit(64)).cast("int") for i in range(4)]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", F.lit(1).cast("long"), b) for b in bits])


def _word(h: Column, n_words: Column) -> Column:
    return F.pmod(F.xxhash64(h, F.lit(2)), n_words)


class History:
    """The store at ``root``: rows of ``schema``, one per ``keys``.

    Helper columns start with ``__``; no column of the schema may.  Rows with a NULL in a key are
    no answers to anything and are left out.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], buckets: int = BUCKETS):
        if any(c.startswith("__") for c in schema.fieldNames()) or set(schema.fieldNames()) & {"increment", "bucket"}:
            raise ValueError("columns named increment, bucket or __... are the store's own")
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        folder, fs = _path(spark, self.root)
        known = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        made = [int(n.split("=")[1]) for n in known if n.startswith("buckets=")]
        if not made:
            fs.mkdirs(_path(spark, f"{self.root}/buckets={buckets}")[0])
        self.buckets = made[0] if made else buckets

    # ------------------------------------------------------------------ index

    def increments(self) -> list[str]:
        """Names of the increments that are there."""
        folder, fs = _path(self.spark, f"{self.root}/index")
        if not fs.exists(folder):
            return []
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if not n.startswith("."))

    def _index(self, part: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/index/{n}/{part}" for n in self.increments()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def files(self) -> DataFrame:
        """One row per data file."""
        return self._index("files", FILES)

    def files_for(self, hashes: DataFrame) -> DataFrame:
        """Files that may hold one of the key hashes ``__h``: all that do, and few others."""
        probes = (hashes.select("__h", self._bucket().alias("b")).join(self.files(), F.col("b") == F.col("bucket"))
                  .select(F.col("file").alias("f"), _word(F.col("__h"), F.col("n_words")).alias("w"), _mask(F.col("__h")).alias("m")))
        words = self._index("words", WORDS)
        hit = probes.join(words, (F.col("f") == F.col("file")) & (F.col("w") == F.col("word")))
        return hit.where(F.col("mask").bitwiseAND(F.col("m")) == F.col("m")).select("file").distinct()

    def _bucket(self) -> Column:
        return F.pmod(F.col("__h"), F.lit(self.buckets)).cast("int")

    # ------------------------------------------------------------------ read and append

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        data = f"{self.root}/data"
        found = self.spark.read.schema(self.schema).option("basePath", data).parquet(*[f"{data}/{p}" for p in paths])
        return found.select(*self.schema.fieldNames())

    def read(self) -> DataFrame:
        """All rows of the increments that are there."""
        return self._rows(sorted(r["folder"] for r in self.files().select("folder").distinct().collect()))

    def append(self, batch: DataFrame, increment: str, ordinal: str) -> Appended:
        """Add the first row (by ``ordinal``) of each key of ``batch`` that isn't stored."""
        if increment.startswith(".") or not increment.replace("-", "").replace("_", "").isalnum():
            raise ValueError("an increment's name has letters, digits, - and _ only")
        n_files = self.files().count()
        if increment in self.increments():
            return Appended(0, 0, n_files)
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        new = keep_first(batch.where(complete).select(*self.schema.fieldNames(), F.col(ordinal).alias("__ordinal")), self.keys, "__ordinal")
        new = materialize(new.withColumn("__h", F.xxhash64(*self.keys)).drop("__ordinal"))
        opened = [r["file"] for r in self.files_for(new).limit(MAX_FILES + 1).collect()] if n_files else []
        stored = self.read() if len(opened) > MAX_FILES else self._rows(sorted(opened))
        added = anti_join_growing(new, stored, self.keys) if opened else new
        return Appended(self._write(added, increment), n_files if len(opened) > MAX_FILES else len(opened), n_files)

    def _write(self, added: DataFrame, increment: str) -> int:
        folder = f"increment={increment}-{uuid.uuid4().hex}"
        data, seen = f"{self.root}/data/{folder}", Observation("added")
        dealt = added.withColumn("bucket", self._bucket()).repartition("bucket").sortWithinPartitions("bucket", "__h")
        (dealt.observe(seen, F.count(F.lit(1)).alias("n")).write.option("maxRecordsPerFile", FILE_ROWS)
         .partitionBy("bucket").parquet(data))
        rows = self.spark.read.schema(StructType([*self.schema.fields]).add("__h", "long").add("bucket", "integer")).parquet(data)
        # the name relative to data/, so that the store can be moved
        name = F.concat(F.lit(f"{folder}/bucket="), F.col("bucket").cast("string"), F.lit("/"), F.col("_metadata.file_name"))
        rows = rows.select(name.alias("file"), "bucket", "__h")
        draft = f"{self.root}/index/.{uuid.uuid4().hex}"
        per_file = rows.groupBy("file", "bucket").agg(F.count(F.lit(1)).alias("rows"))
        per_file.select("file", F.lit(folder).alias("folder"), "bucket", "rows",
                        F.ceil(F.col("rows") / 4).cast("long").alias("n_words")).write.parquet(f"{draft}/files")
        sizes = self.spark.read.schema(FILES).parquet(f"{draft}/files").select(F.col("file").alias("f"), "n_words")
        words = (rows.join(sizes, F.col("file") == F.col("f"))
                 .groupBy("file", _word(F.col("__h"), F.col("n_words")).alias("word")).agg(F.bit_or(_mask(F.col("__h"))).alias("mask")))
        words.repartition("file").sortWithinPartitions("file", "word").write.parquet(f"{draft}/words")
        self._commit(draft, increment)
        return int(seen.get["n"])

    def _commit(self, draft: str, increment: str) -> None:
        staged, fs = _path(self.spark, draft)
        final, _ = _path(self.spark, f"{self.root}/index/{increment}")
        if fs.exists(final) or not fs.rename(staged, final):
            raise Conflict(f"increment {increment} of {self.root} exists")
