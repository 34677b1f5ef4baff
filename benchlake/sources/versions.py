"""Versioned tables: write beside, then publish with one rename; readers stay on a version.

A store is a folder on any Hadoop file system:

* ``data/<id>/<table>``: Parquet tables as staged, never changed afterwards;
* ``versions/<number>.json``: one manifest per published version, naming its tables.

Publishing writes the tables, then a manifest under a temporary name, and renames it to the next
number.  The highest number is the current version, so a crash before the rename leaves the old
tables in force, and a reader that has opened a version is not disturbed by later ones.  Two
publishers that start from the same version want the same number: the second gets ``Conflict``.
(The rename refuses an existing name on HDFS; on a local disk the check before it is not atomic.)
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another publisher took the version's number."""


class Version(NamedTuple):
    """A published (``number`` 1, 2, ...) or staged (``number`` 0) set of tables."""

    number: int
    based_on: int
    data: str
    tables: dict[str, dict]  # name -> Spark schema as JSON

    def path(self, name: str) -> str:
        return f"{self.data}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A table of this version (its schema comes from the manifest, so it may be empty)."""
        return spark.read.schema(StructType.fromJson(self.tables[name])).parquet(self.path(name))


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifest(root: str, number: int) -> str:
    return f"{root}/versions/{number:012d}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions that are still there, ascending."""
    folder, fs = _path(spark, f"{root.rstrip('/')}/versions")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def load(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The version ``number`` (default: the current one; None if nothing is published)."""
    root = root.rstrip("/")
    if number is None:
        known = numbers(spark, root)
        if not known:
            return None
        number = known[-1]
    path, fs = _path(spark, _manifest(root, number))
    stream = fs.open(path)
    try:
        said = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, said["based_on"], f"{root}/data/{said['data']}", said["tables"])


def stage(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> Version:
    """Write the tables beside the published ones; nobody reads them before ``commit``."""
    root = root.rstrip("/")
    known = numbers(spark, root)
    data = f"{root}/data/{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{data}/{name}")
    return Version(0, known[-1] if known else 0, data, {name: df.schema.jsonValue() for name, df in tables.items()})


def commit(spark: SparkSession, staged: Version, root: str) -> Version:
    """Publish a staged version as the successor of the one that it was staged on."""
    root = root.rstrip("/")
    number = staged.based_on + 1
    target, fs = _path(spark, _manifest(root, number))
    draft, _ = _path(spark, f"{root}/versions/.{uuid.uuid4().hex}")
    body = {"based_on": staged.based_on, "data": staged.data.rsplit("/", 1)[1], "tables": staged.tables}
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(body).encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise Conflict(f"version {number} of {root} exists")
    return staged._replace(number=number)


def discard(spark: SparkSession, staged: Version) -> None:
    """Remove the data of a version that was not published."""
    if staged.number:
        raise ValueError("a published version is removed by retain()")
    path, fs = _path(spark, staged.data)
    fs.delete(path, True)


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> Version:
    """Stage and commit.  The tables may be computed from the current version's."""
    staged = stage(spark, tables, root)
    try:
        return commit(spark, staged, root)
    except Conflict:
        discard(spark, staged)
        raise


def retain(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the latest ``keep`` versions, manifest first; returns the removed numbers."""
    if keep < 1:
        raise ValueError("the current version stays")
    gone = numbers(spark, root)[:-keep]
    for number in gone:
        old = load(spark, root, number)
        for path in (_manifest(root.rstrip("/"), number), old.data):
            found, fs = _path(spark, path)
            fs.delete(found, True)
    return gone
