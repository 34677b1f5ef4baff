import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside; a table may have them as well.
CLASHES = "key raw rep size own tree label h1 h2 piece length rank shard slot gone holder score kept __words __text rule host".split()


def words(rng, n):
    return " ".join(rng.choice("the of and to in was table river stone light under over bridge seven".split())
                    + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): NULLs in both, empty and white texts, a very long one, copies and repeated rows."""
    rng = random.Random(3)
    long = words(rng, 30_000)
    a, b = words(rng, 120), words(rng, 90)
    line = "A line that repeats across documents"
    return [(1, a), (2, a), (2, a), (3, b), (4, None), (5, ""), (6, " \t\n \x0b"), (None, a), (None, None), (7, long),
            (8, long + " tail"), (9, f"{line}\n{b}"), (10, f" {line.upper()}\n{a}"), (11, f"{line}\n{line}\nend"), (12, "one two"),
            (13, "é" * 50 + "\n\n" + "|" * 30), (14, "one two"), (15, "\ud83d\ude00".encode("utf-16", "surrogatepass").decode("utf-16") * 3)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, "doc_id long, text string")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)]).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("doc_id < -5")
