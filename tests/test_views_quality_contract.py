"""Dashboard filters, quality checks on domain fixtures, silver flow, and the driver contract."""

import os
import sys

import duckdb
import pytest

from benchlake.operators import coverage, quality, views
from benchlake.plans import silver

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _responses(spark):
    rows = [("q1", "m1", "naive", True, 1.0), ("q2", "m1", "strict_format", False, 3.0),
            ("q1", "m2", "naive", None, 2.0), ("q3", "m2", "role_expert", True, 4.0)]
    return spark.createDataFrame(rows, "question_id string, model_name string, prompt_variant string, "
                                       "ai_correct boolean, response_time double")


def test_selection_rules(spark):
    r = _responses(spark)
    with pytest.raises(ValueError):
        views.overview_kpis(r, models=[])
    all_rows = views.overview_kpis(r).first()
    assert all_rows.n_responses == 4 and all_rows.accuracy == 0.5  # NULL counts as incorrect
    one = views.overview_kpis(r, ["m1"], ["naive"]).first()
    assert one.n_responses == 1 and one.accuracy == 1.0


def test_entity_slots_stable_under_filter(spark):
    slots = {(r.kind, r.value): (r.slot, r.color) for r in views.entity_slots(_responses(spark)).collect()}
    assert slots[("model", "m1")][0] == 0 and slots[("model", "m2")][0] == 1
    assert slots[("prompt_variant", "strict_format")] == (2, views.PALETTE[2])


def _silver_fixture(spark):
    rows = [  # category, type, difficulty, question, correct, incorrect(JSON), scraped_at, ordinal
        (" Art ", "multiple", "easy", "Q1?", "A", '["B", "C", "D"]', "t", 3),
        ("Art", "multiple", "easy", "Q1?\n", "A", '["X", "Y", "Z"]', "t", 1),   # exact dup (after strip), earlier
        ("Art", "multiple", "easy", "Q1?", "A2", '["B", "C", "D"]', "t", 2),    # same id, other answer
        ("Geo", "multiple", "hard", "Q2?", "A", '["B", " ", "D"]', "t", 4),     # blank wrong answer -> 3 choices
        ("Geo", "boolean", "medium", "Q3?", "True", '["False"]', "t", 5),
        (None, "boolean", "expert", "Q4?", "True", '["False"]', "t", 6),
    ]
    return spark.createDataFrame(rows, "category string, type string, difficulty string, question string, "
                                       "correct_answer string, incorrect_answers string, scraped_at string, "
                                       "_ordinal long").repartition(3)


def test_silver_flow_and_metrics(spark):
    c = silver.clean_with_counts(_silver_fixture(spark)).cache()
    rows = {r.question: r for r in c.collect()}
    assert rows["Q1?"].choices and sorted(rows["Q1?"].choices) == ["A", "X", "Y", "Z"]
    m = silver.clean_metrics(c).first()
    assert (m.rows_read, m.exact_duplicates, m.id_collisions, m.bad_choice_counts, m.rows_written) == (6, 1, 1, 1, 4)
    bad = quality.choice_count(c).collect()
    assert [r.question_id for r in bad] == [rows["Q2?"].question_id]


def test_quality_checks_on_domain_rows(spark):
    from benchlake.operators.marts import stg_questions

    c = silver.clean_questions(_silver_fixture(spark))
    stq = stg_questions(c)
    assert quality.unique(stq).count() == 0
    nn = {(r.table_name, r.column_name): r.n_nulls for r in quality.not_null(
        {"stg_questions": stq, "stg_ai_responses": _responses(spark),
         "stg_responses_enriched": _responses(spark)}).collect()}
    # a NULL category also makes the id NULL (concat semantics): both not_null checks fail once
    assert nn[("stg_questions", "category")] == 1 and nn[("stg_questions", "question_id")] == 1
    assert sum(nn.values()) == 2
    av = {(r.column_name, r.value): r.n_rows for r in quality.accepted_values(stq).collect()}
    assert av == {("difficulty", "expert"): 1}
    grid = coverage.coverage_grid(c).collect()
    assert len(grid) == 3 * 3 * 2 and sum(r.n_questions for r in grid) == 3  # NULL category is its own row


SQL_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def test_driver_contract_against_oracle(spark):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E

    assert E.entry(spark).count() > 0
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in "part lineitem documents benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    for name in ["model_performance", "response_time", "stratified_sample", "clean_questions", "grade_inclusion",
                 "batch_inference", "coverage_grid", "dq_not_null", "csv_roundtrip", "raw_batch_archive",
                 "payload_dead_letters", "response_log_compact", "gold_tables", "regrade"]:
        df = qs[name](spark, sf)
        got = sorted(tuple(str(x) for x in r) for r in df.select(sorted(df.columns)).collect())
        rel = con.sql(sqls[name])
        sql_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
        assert {f.name: SQL_TYPE.get(f.dataType.simpleString()) for f in df.schema.fields} == sql_types, name
        cols = sorted(rel.columns)
        exp = sorted(tuple(str(x) for x in r) for r in con.sql(f"select {', '.join(cols)} from ({sqls[name]})").fetchall())
        assert got == exp, name


def test_display_and_category_prefix(spark):
    k = spark.createDataFrame([(5295, 2, 736, 0.3441)], "n_questions long, n_models long, n_responses long, "
                                                         "best_accuracy double")
    r = views.display_kpis(k).first()
    assert (r.questions, r.models, r.responses, r.best_accuracy) == ("5 295", "2", "736", "34.4%")
    cats = spark.createDataFrame([(i, f"c{i}") for i in (12, 9, 31, 10)], "id int, name string")
    assert [x.id for x in coverage.first_categories(cats, 2).collect()] == [9, 10]
    assert coverage.first_categories(cats, None).count() == 4


def test_home_kpis_scalar_subquery_and_empty_mart(spark):
    q = spark.createDataFrame([("q1",), ("q2",), ("q3",)], "question_id string")
    empty = spark.createDataFrame([], "model_name string, n_responses long, accuracy double")
    r = views.home_kpis(q, empty).collect()
    assert [tuple(x) for x in r] == [(3, 0, None, None)]
    mp = spark.createDataFrame([("m1", 10, 0.5), ("m2", 4, 0.75)], "model_name string, n_responses long, accuracy double")
    k = views.home_kpis(q, mp)
    assert tuple(k.first()) == (3, 2, 14, 0.75)
    assert "NestedLoopJoin" not in k._jdf.queryExecution().executedPlan().toString()
