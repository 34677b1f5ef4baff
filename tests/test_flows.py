"""End-to-end: payloads -> bronze -> silver -> enrichment (resume, failures) -> gold + checks."""

import base64
import json
import os

import pytest

from benchlake.plans import flows
from benchlake.functions.grading import regrade
from benchlake.sources import files


def _b64(s):
    return base64.b64encode(s.encode()).decode()


def _q(cat, qtype, diff, question, right, wrong):
    return {"category": _b64(cat), "type": _b64(qtype), "difficulty": _b64(diff), "question": _b64(question),
            "correct_answer": _b64(right), "incorrect_answers": [_b64(w) for w in wrong]}


def test_end_to_end(spark, scratch):
    p1 = {"response_code": 0, "results": [
        _q("Geo", "multiple", "easy", "Capital of France?", "Paris", ["Lyon", "Nice", "Lille"]),
        _q("Geo", "boolean", "easy", "Is Rome in Italy?", "True", ["False"]),
        _q("Geo", "multiple", "easy", "Capital of France?", "Paris", ["Lyon", "Nice", "Lille"]),  # exact dup
    ]}
    p2 = {"response_code": 0, "results": [_q("Art", "multiple", "hard", "Who painted it? fail", "Goya", ["A", "B", "C"])]}
    payloads = spark.createDataFrame([(9, json.dumps(p1)), (25, json.dumps(p2)), (25, json.dumps({"response_code": 1})),
                                      (25, "not json")], "cat int, payload string")
    raw_dir, csv_path = os.path.join(scratch, "raw_json"), os.path.join(scratch, "questions_raw")
    dead = flows.bronze_from_payloads(payloads, raw_dir, csv_path, "2024-01-01T00:00:00+00:00", category_col="cat")
    assert sorted(r.reason for r in dead.collect()) == ["malformed", "response_code=1"]

    again = flows.bronze_from_payloads(payloads, raw_dir, csv_path, "2024-01-01T00:00:00+00:00", category_col="cat")
    assert again.count() == 2 and files.read_bronze_csv(spark, csv_path).count() == 4  # a load run again replaces itself

    silver_path = os.path.join(scratch, "questions_clean.parquet")
    m = flows.bronze_to_silver(spark, csv_path, silver_path).first()
    assert (m.rows_read, m.exact_duplicates, m.id_collisions, m.rows_written) == (4, 1, 0, 3)
    questions = spark.read.parquet(silver_path)

    class Model:  # answers with the question's first word; fails on "fail"
        def ask(self, prompt):
            if "fail" in prompt:
                raise RuntimeError("timeout")
            return "Paris" if "France" in prompt else "Yes, true"

    log = os.path.join(scratch, "log")
    r1 = flows.enrich(spark, questions, "m1", ["naive", "strict_format"], Model, log, sample_size=None)
    assert (r1["added"], r1["failed"], r1["done_before"]) == (4, 2, 0)
    assert r1["mean_seconds_per_call"] >= 0.0 and (r1["total"], r1["accuracy"]) == (4, 1.0)
    for nameless in (None, "", " "):
        with pytest.raises(ValueError):
            flows.enrich(spark, questions, nameless, ["naive"], Model, log)
    r2 = flows.enrich(spark, questions, "m1", ["naive", "strict_format"], Model, log, sample_size=None)
    assert (r2["added"], r2["failed"], r2["done_before"]) == (0, 2, 4)  # resume: only failures retried
    assert r2["mean_seconds_per_call"] is None
    assert flows.utc_now_iso().endswith("+00:00")

    responses = flows.compact_responses(spark, log, os.path.join(scratch, "ai_responses.parquet"))
    assert responses.count() == 4 and all(r.ai_correct for r in responses.collect())
    assert regrade(responses, questions).filter("ai_correct").count() == 4

    gold = flows.silver_to_gold(questions, responses, os.path.join(scratch, "gold"))
    assert gold["failures"] == {"unique_question_id": 0, "not_null": 0, "accepted_values": 0,
                                "orphan_responses": 0, "duplicate_response_keys": 0}
    perf = spark.read.parquet(gold["tables"]["fct_model_performance"]).first()
    assert (perf.model_name, perf.n_responses, perf.n_correct, perf.accuracy) == ("m1", 4, 4, 1.0)


def test_catalog_named_sources_and_params(spark, scratch):
    root = os.path.join(scratch, "silver")
    spark.createDataFrame([("m1", 1.0), ("m2", 3.0)], "model_name string, response_time double") \
        .write.parquet(os.path.join(root, "ai_responses.parquet"))
    cat = files.Catalog(spark, root)
    cat.register("stg_ai_responses", cat.source("ai_responses"))
    got = cat.sql("select model_name from stg_ai_responses where model_name in (?, ?) and response_time > ?",
                  ["m1", "m2", 2.0]).collect()
    assert [r.model_name for r in got] == ["m2"]


def test_write_silver_metrics_equal_aggregate_metrics(spark, scratch):
    from benchlake.plans import adapters as A
    from benchlake.plans import silver

    cleaned = silver.clean_with_counts(A.bronze_questions(spark, "/root/testdata/sf0.01"))
    observed = silver.write_silver(cleaned, os.path.join(scratch, "silver")).first()
    assert observed == silver.clean_metrics(cleaned).first()
    assert spark.read.parquet(os.path.join(scratch, "silver")).count() == observed.rows_written


def test_first_batch_wins_whatever_the_order_of_the_rows(spark, scratch):
    body = lambda right: json.dumps({"response_code": 0, "results": [
        _q("Geo", "multiple", "easy", "Capital?", right, ["X", "Y", "Z"])]})
    rows = [(n, body(f"answer {n}")) for n in (7, 3, 12, 5)]
    payloads = spark.createDataFrame(rows, "n long, payload string").repartition(4)
    raw, path, out = (os.path.join(scratch, x) for x in ("raw", "csv", "silver"))
    flows.bronze_from_payloads(payloads, raw, path, "t", batch_col="n")
    m = flows.bronze_to_silver(spark, path, out).first()
    assert (m.rows_read, m.exact_duplicates, m.id_collisions, m.rows_written) == (4, 0, 3, 1)
    assert spark.read.parquet(out).first().correct_answer == "answer 3"


def test_infer_runs_in_as_many_tasks_as_asked(spark):
    from benchlake.operators import inference

    work = spark.range(900).selectExpr("cast(id as string) question_id", "'m' model_name", "'naive' prompt_variant",
                                       "cast(id as string) prompt").coalesce(1)
    raw = inference.infer(work, concurrency=6)
    assert raw.rdd.getNumPartitions() == 6 and raw.where("error is null").count() == 900
