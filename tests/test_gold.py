"""Gold marts rolled up from the shared key aggregate equal the marts computed directly."""

from pyspark.sql import functions as F

from benchlake.operators import marts
from benchlake.plans import adapters as A

SF = "/root/testdata/sf0.01"
MARTS = {
    "fct_model_performance": lambda r, q: marts.model_performance(r),
    "fct_prompt_performance": lambda r, q: marts.prompt_performance(r),
    "fct_category_accuracy": lambda r, q: marts.category_accuracy(r, q),
    "fct_difficulty_accuracy": lambda r, q: marts.difficulty_accuracy(r, q),
    "fct_response_time": lambda r, q: marts.response_time(r),
}


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_gold_marts_from_key_aggregate_match_direct_marts(spark):
    r, q = A.responses(spark, SF), A.questions(spark, SF)
    gold = marts.build_gold(r, q)
    for name, direct in MARTS.items():
        assert _rows(gold[name]) == _rows(direct(r, q)), name


def test_gold_marts_with_nulls_and_orphans(spark):
    rows = [("q1", "m1", "naive", True, 1.25), ("q1", "m1", "naive", None, None), ("q2", "m1", "strict_format", False, 3.5),
            ("q9", "m2", "naive", True, 0.5), ("q2", "m2", "naive", True, None), ("q1", "m2", "naive", False, 2.0)]
    r = spark.createDataFrame(rows, "question_id string, model_name string, prompt_variant string, "
                                    "ai_correct boolean, response_time double").withColumn("ai_answer", F.lit("x"))
    q = spark.createDataFrame([("q1", "Geo", "multiple", "easy", "Capital?", "Paris"),
                               ("q2", "Art", "boolean", "hard", "Is it?", "True")],
                              "question_id string, category string, type string, difficulty string, "
                              "question string, correct_answer string")
    gold = marts.build_gold(r, q)
    for name, direct in MARTS.items():
        assert _rows(gold[name]) == _rows(direct(r, q)), name
    perf = {x.model_name: x for x in gold["fct_model_performance"].collect()}
    assert (perf["m1"].n_responses, perf["m1"].n_correct, perf["m1"].accuracy) == (3, 1, 0.3333)
    assert perf["m2"].latency_median_s == 1.25  # NULL latencies ignored, interpolated
    cats = {(x.category, x.model_name) for x in gold["fct_category_accuracy"].collect()}
    assert ("Geo", "m2") in cats and all(c is not None for c, _ in cats)  # orphan q9 dropped
