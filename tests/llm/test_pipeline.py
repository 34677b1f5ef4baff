"""The pipeline against a step-by-step brute force, and the registration guard."""

import collections
import random

import corpus_pipeline
from benchlake.llm import decontam, jaccard_join, line_dedup, quality
from conftest import SF, words
from pyspark.sql import functions as F
from test_documents import brute_lines
from test_matching import brute_join


def test_stages_on_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "quality_rules":
            judged = quality.judge(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {r.doc_id: kept[r.doc_id] for r in judged.where("kept").collect()}
        elif name == "line_dedup":
            want = {int(d): t for d, _, _, t in brute_lines(rows)}
        elif name == "jaccard_join":
            want = {d: t for d, t in rows if (str(d), str(d)) in {x[:2] for x in brute_join(rows)}}
        else:
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            hit = {r.doc_id for r in decontam.contaminated(docs, bench).collect()}
            exact = {d for d, t in rows for b in bench.collect() if b.text in t}
            assert exact <= hit
            want = {d: t for d, t in rows if d not in hit}
        assert out.columns == columns
        got = out.collect()
        assert {r.doc_id: r.text for r in got} == want and len(got) == len(want), name
        assert all(r.n_chars == len(r.text) for r in got)
        docs, kept = spark.createDataFrame(got, docs.schema), want
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == set(kept)
    assert max(collections.Counter(r.sequence_id for r in packed).values()) > 1


def test_stages_take_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        df = docs.selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "cast(length(text) as bigint) as n_chars")
        for _, stage in corpus_pipeline.STAGES:
            df_out = stage(spark, df, SF)
            assert df_out.count() >= 0
    near = corpus_pipeline.drop_near_duplicates(spark, odd_docs, SF)
    assert near.columns == odd_docs.columns
    ids = [r.doc_id for r in near.select("doc_id").collect()]
    assert ids.count(1) == 1 and 2 not in ids and 8 not in ids and ids.count(None) == 2


def test_stages_take_columns_named_like_their_own(spark, odd_docs):
    names = ("kept", "score", "n_lines", "n_words", "n_dropped", "base_failed", "n_chars", "__row", "__gone", "__member", "__in0", "class_id", "n_links")
    docs = odd_docs.select("doc_id", "text", *[F.lit(f"{n} of the input").alias(n) if n != "n_chars" else F.length("text").cast("long").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        if name != "packing":
            assert out.columns == docs.columns, name
            assert all(r[n] == f"{n} of the input" for r in rows for n in names if n != "n_chars"), name


def test_rows_without_or_with_a_repeated_id_are_judged_by_their_own_text(spark):
    rng = random.Random(9)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    clean, other, third = (words(rng, 80) for _ in range(3))
    near = " ".join(third.split()[:-1])  # a near copy of third

    def kept(stage, rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return collections.Counter((r.doc_id, r.text) for r in stage(spark, df, SF).collect())

    bad = f"{clean} {item} {other}"
    assert kept(corpus_pipeline.decontaminate, [(None, bad), (None, clean), (1, bad), (1, other), (2, clean)]) == collections.Counter(
        [(None, clean), (1, other), (2, clean)])
    rows = [(1, clean), (1, other), (1, other), (2, other), (None, third), (None, near), (5, None), (5, None), (5, ""), (None, None), (None, None)]
    got = kept(corpus_pipeline.drop_near_duplicates, rows)
    one = [(None, t) for t in (third, near) if (None, t) in got]
    assert len(one) == 1
    assert got == collections.Counter([(1, clean), (1, other), (5, None), (5, ""), (None, None), *one])


def test_entry_registers_the_queries():
    import __spark_entry__ as E

    names = E.queries().keys()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)
