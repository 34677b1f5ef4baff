"""Sources, sinks, bronze decoding, batch inference and the idempotent response merge."""

import base64
import csv
import glob
import json
import os

from pyspark.sql import functions as F

from benchlake.operators import inference, worklist
from benchlake.schemas import AI_RESPONSES
from benchlake.sources import bronze, files
from benchlake.streaming import merge

CSV_ROWS = [
    {"category": "Sci, \"Nature\"", "type": "multiple", "difficulty": "easy", "question": "line1\nline2",
     "correct_answer": "12 oz | 340 g", "incorrect_answers": json.dumps(["a|b", "c\\d", ""]),
     "scraped_at": "2024-01-01T00:00:00+00:00"},
    {"category": "NA", "type": "boolean", "difficulty": "", "question": "  \tpadded\n",
     "correct_answer": "True", "incorrect_answers": json.dumps(["False"]), "scraped_at": ""},
]


def test_csv_round_trip_python_to_spark_to_python(spark, scratch):
    src = os.path.join(scratch, "questions_raw.csv")
    with open(src, "w", encoding="utf-8", newline="") as f:
        w = csv.DictWriter(f, fieldnames=list(CSV_ROWS[0]))
        w.writeheader()
        w.writerows(CSV_ROWS)
    df = files.read_bronze_csv(spark, src)
    got = sorted([r.asDict() for r in df.collect()], key=lambda r: r["type"], reverse=True)
    assert got == CSV_ROWS
    out = os.path.join(scratch, "out_csv")
    files.write_bronze_csv(df.coalesce(1), out)
    with open(glob.glob(os.path.join(out, "*.csv"))[0], encoding="utf-8", newline="") as f:
        back = sorted(csv.DictReader(f), key=lambda r: r["type"], reverse=True)
    assert back == CSV_ROWS


def test_response_log_missing_blank_lines_and_append(spark, scratch):
    log = os.path.join(scratch, "log")
    assert files.read_response_log(spark, log).count() == 0
    os.makedirs(log)
    with open(os.path.join(log, "part-0.json"), "w", encoding="utf-8") as f:
        f.write(json.dumps({"question_id": "q1", "model_name": "m", "prompt_variant": "naive",
                            "ai_answer": "Paris", "ai_correct": True, "response_time": 1.5}) + "\n\n\n")
    assert files.read_response_log(spark, log).count() == 1
    files.append_response_log(files.read_response_log(spark, log).withColumn("question_id", F.lit("q2")), log)
    assert sorted(r.question_id for r in files.read_response_log(spark, log).collect()) == ["q1", "q2"]


def _b64(s):
    return base64.b64encode(s.encode()).decode()


def test_decode_payloads(spark):
    q = {"category": _b64("Art"), "type": _b64("multiple"), "difficulty": _b64("hard"),
         "question": _b64("Qui a peint « Guernica » ?"), "correct_answer": _b64("Picasso"),
         "incorrect_answers": [_b64("Dalí"), _b64("Miró")]}
    payloads = [(1, json.dumps({"response_code": 0, "results": [q, q]})),
                (2, json.dumps({"response_code": 1, "results": []})),
                (3, json.dumps({"response_code": 0, "results": []})),
                (4, json.dumps({"response_code": 5}))]
    df = spark.createDataFrame(payloads, "pid int, payload string")
    rows = bronze.decode_payloads(df, carry=["pid"]).collect()
    assert [(r.pid, r._pos) for r in rows] == [(1, 0), (1, 1)]
    assert rows[0].question == "Qui a peint « Guernica » ?" and rows[0].incorrect_answers == ["Dalí", "Miró"]


def test_a_question_that_cannot_be_decoded_fails_its_payload(spark):
    good = {"category": _b64("Art"), "type": _b64("boolean"), "difficulty": _b64("hard"), "question": _b64("Q?"),
            "correct_answer": _b64("True"), "incorrect_answers": [_b64("False")]}
    bodies = [json.dumps({"response_code": 0, "results": [good, {**good, **change}]}) for change in (
        {}, {"question": "@@@"}, {"category": "//79"}, {"incorrect_answers": ["@@@"]}, {"incorrect_answers": None},
        {"type": None})] + [json.dumps({"response_code": 0, "results": [good, None]}), bodies_cut(good), None, ""]
    df = spark.createDataFrame(list(enumerate(bodies)), "pid int, payload string")
    dead = {r.pid: r.reason for r in bronze.failed_payloads(df).collect()}
    assert dead == {**{i: "undecodable" for i in range(1, 7)}, 7: "malformed", 8: "malformed", 9: "malformed"}
    assert [r.pid for r in bronze.decode_payloads(df, carry=["pid"]).collect()] == [0, 0]
    assert [r.pid for r in bronze.decode_batches(df, carry=["pid"]).collect()] == [0]


def bodies_cut(q):
    return json.dumps({"response_code": 0, "results": [q]})[:-2]


def test_raw_batch_files_flatten_with_ordinal(spark, scratch):
    d = os.path.join(scratch, "raw_json")
    os.makedirs(d)
    for i, names in enumerate([["a", "b"], ["c"]], start=1):
        doc = {"category": 9, "difficulty": "easy", "type": "multiple",
               "questions": [{"category": "General", "type": "multiple", "difficulty": "easy", "question": n + " ?",
                              "correct_answer": n, "incorrect_answers": ["x", "y|z", "é"]} for n in names]}
        with open(os.path.join(d, f"batch_{i:05d}.json"), "w", encoding="utf-8") as f:
            json.dump(doc, f, ensure_ascii=False, indent=2)
    flat = bronze.flatten_batches(bronze.read_raw_batches(spark, d), "2024-05-01T00:00:00+00:00")
    rows = sorted(flat.collect(), key=lambda r: (r._batch, r._pos))
    assert [(r._batch, r._pos, r.correct_answer) for r in rows] == [
        ("batch_00001.json", 0, "a"), ("batch_00001.json", 1, "b"), ("batch_00002.json", 0, "c")]
    assert json.loads(rows[0].incorrect_answers) == ["x", "y|z", "é"]


def _questions(spark):
    return spark.createDataFrame(
        [("q1", "What is the capital of France?", "Geo", "easy", "multiple", "Paris"),
         ("q2", "please fail", "Geo", "hard", "boolean", "True")],
        "question_id string, question string, category string, difficulty string, type string, correct_answer string")


def test_inference_isolates_failures_and_grades(spark):
    class FlakyClient:  # defined locally so that it is shipped to the workers by value
        def ask(self, prompt):
            if "fail" in prompt:
                raise RuntimeError("model down")
            return "reasoning__LM_STUDIO_INTERNAL_LSEP_SYNTHETIC_REASONING_END_0f__\n Paris "

    q = _questions(spark)
    work = worklist.with_prompts(worklist.pending_worklist(q, ["naive", "role_expert"], "m", keep=worklist.TEMPLATE_FIELDS))
    raw = inference.infer(work, FlakyClient).cache()
    ok = inference.answers(raw, q).collect()
    assert {(r.question_id, r.prompt_variant, r.ai_answer, r.ai_correct) for r in ok} == {
        ("q1", "naive", "Paris", True), ("q1", "role_expert", "Paris", True)}
    assert inference.dead_letters(raw).count() == 2
    # failed items are not stored, hence pending again on the next run
    stored = spark.createDataFrame([(r.question_id, r.model_name, r.prompt_variant, r.ai_answer, r.ai_correct,
                                     r.response_time) for r in ok], AI_RESPONSES)
    again = worklist.pending_worklist(q, ["naive", "role_expert"], "m", stored).collect()
    assert sorted((r.question_id, r.prompt_variant) for r in again) == [("q2", "naive"), ("q2", "role_expert")]


def _resp(rows):
    return [(q, "m", v, a, c, t) for q, v, a, c, t in rows]


def test_merge_first_answer_wins_and_is_idempotent(spark):
    existing = spark.createDataFrame(_resp([("q1", "naive", "old", True, 1.0)]), AI_RESPONSES)
    new = spark.createDataFrame(_resp([("q1", "naive", "new", False, 2.0), ("q2", "naive", "x", False, 3.0),
                                       ("q2", "naive", "y", True, 4.0)]), AI_RESPONSES).withColumn(
        "_ord", F.when(F.col("ai_answer") == "y", 0).otherwise(1))
    merged = merge.merge_responses(existing, new, ordinal="_ord")
    got = sorted((r.question_id, r.ai_answer) for r in merged.collect())
    assert got == [("q1", "old"), ("q2", "y")]
    assert merge.new_answers(merged, new, ordinal="_ord").count() == 0


def test_new_answers_broadcast_and_shuffle_paths_agree(spark, scratch):
    stored = spark.createDataFrame(_resp([(f"q{i}", v, "s", True, 1.0) for i in range(0, 40, 2)
                                          for v in ("naive", "role_expert")]), AI_RESPONSES)
    stored = stored.unionByName(stored)  # duplicated stored keys must not matter
    new = spark.createDataFrame(_resp([(f"q{i}", "naive", f"n{i}", False, 2.0) for i in range(30)]), AI_RESPONSES)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rows = lambda df: sorted((r.question_id, r.ai_answer) for r in df.collect())
    # Stored side of unknown size, few new keys: stored keys semi-joined to the broadcast new keys.
    semi = merge.new_answers(stored, new)
    assert "LeftSemi" in plan(semi)
    # Beyond the key bound: a shuffle anti join only.
    shuffled = merge.new_answers(stored, new, broadcast_keys=0)
    assert "LeftSemi" not in plan(shuffled)
    # Stored side known to be small (a Parquet table): the plain anti join, broadcast by the planner.
    path = os.path.join(scratch, "stored")
    stored.write.parquet(path)
    small = merge.new_answers(spark.read.parquet(path), new)
    assert "LeftSemi" not in plan(small)
    want = [(f"q{i}", f"n{i}") for i in sorted(range(1, 30, 2), key=lambda i: f"q{i}")]
    assert rows(semi) == rows(shuffled) == rows(small) == want


def test_stream_merge_available_now_twice(spark, scratch):
    log, target = os.path.join(scratch, "log"), os.path.join(scratch, "responses")
    os.makedirs(log)
    def write(name, rows):
        with open(os.path.join(log, name), "w", encoding="utf-8") as f:
            for q, a in rows:
                f.write(json.dumps({"question_id": q, "model_name": "m", "prompt_variant": "naive",
                                    "ai_answer": a, "ai_correct": True, "response_time": 0.5}) + "\n")
    write("part-0001.json", [("q1", "first"), ("q2", "a")])
    assert merge.stream_merge(spark, log, target) == 2
    assert merge.stream_merge(spark, log, target) == 0  # nothing new: nothing added
    write("part-0002.json", [("q1", "second"), ("q3", "b")])
    assert merge.stream_merge(spark, log, target) == 1
    got = sorted((r.question_id, r.ai_answer) for r in merge.read_target(spark, target).collect())
    assert os.path.isdir(os.path.join(target, "model_name=m"))  # partitioned by model
    assert got == [("q1", "first"), ("q2", "a"), ("q3", "b")]


def _answers_of(spark, rows):
    return spark.createDataFrame(rows, "question_id string, model_name string, prompt_variant string, ai_answer string, "
                                       "ai_correct boolean, response_time double")


def test_stream_merge_keeps_the_first_increment_and_its_checkpoint(spark, tmp_path):
    """Two appends of the same keys with other answers in one micro-batch; a later run reads no old file."""
    for trial in range(3):
        log, target = f"{tmp_path}/log{trial}", f"{tmp_path}/target{trial}"
        for answer in ("first", "second"):
            files.append_response_log(_answers_of(spark, [(f"q{i}", "m", "naive", answer, True, 1.0) for i in range(20)]), log)
        assert merge.stream_merge(spark, log, target) == 20
        assert {r.ai_answer for r in merge.read_target(spark, target).collect()} == {"first"}
        assert merge.stream_merge(spark, log, target) == 0
        files.append_response_log(_answers_of(spark, [("q1", "m", "naive", "third", True, 1.0), ("new", "m", "naive", "n", True, 1.0)]), log)
        assert merge.stream_merge(spark, log, target) == 1


def test_rows_without_a_key_are_not_merged_again(spark, tmp_path):
    target = f"{tmp_path}/target"
    rows = _answers_of(spark, [("q", "m", "naive", "a", True, 1.0), ("q", None, "naive", "a", True, 1.0), ("q", "", "naive", "a", True, 1.0)])
    assert merge.append_new(rows, target) == 1
    assert merge.append_new(rows, target) == 0
    assert rows.where(~merge.has_key()).count() == 2


def test_answers_are_shuffled_once_by_a_merge(spark):
    """Their texts are held once in the aggregate and stay partitioned for the anti join."""
    stored = spark.createDataFrame(_resp([("q1", "naive", "s", True, 1.0)]), AI_RESPONSES)
    new = spark.createDataFrame(_resp([(f"q{i}", "naive", f"n{i % 3}{k}", False, 2.0) for i in range(6) for k in range(3)]), AI_RESPONSES)
    out = merge.new_answers(stored, new.withColumn("_ord", F.lit(0)), "_ord", broadcast_keys=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # new answers, stored keys
    assert "min_by" not in plan
    # The ordinal ties: the smallest row is the first.
    assert sorted((r.question_id, r.ai_answer) for r in out.collect()) == [(f"q{i}", f"n{i % 3}0") for i in (0, 2, 3, 4, 5)]


def test_a_compressed_log_is_merged_alike(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LOG_FILE_ROWS", 7)
    log = f"{tmp_path}/log"
    for answer, compression in (("first", "gzip"), ("second", "gzip"), ("third", None)):
        rows = _answers_of(spark, [(f"q{i}", "m", "naive", f"{answer} é\n{i}", True, 1.0) for i in range(20)]).coalesce(1)
        files.append_response_log(rows, log, compression)
    assert len(glob.glob(f"{log}/*.json.gz")) == 6
    assert files.read_response_log(spark, log).count() == 60
    assert merge.stream_merge(spark, log, f"{tmp_path}/target") == 20
    got = {(r.question_id, r.ai_answer) for r in merge.read_target(spark, f"{tmp_path}/target").collect()}
    assert got == {(f"q{i}", f"first é\n{i}") for i in range(20)}
