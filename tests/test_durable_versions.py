"""Durable inference runs, running means, versioned tables and quality gates."""

import collections
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from benchlake.operators import durable, gates, progress
from benchlake.plans import flows
from benchlake.sources import files, versions

QUESTION = "question_id string, question string, category string, difficulty string, type string, correct_answer string"


def questions(spark, n=60):
    rows = [(f"q{i}", f"Question {i}?", "c", "easy", "multiple", f"answer {i}") for i in range(n)]
    return spark.createDataFrame(rows, QUESTION).repartition(3)


def model(name, dies_at=None, fails_at=None):
    class ModelGone(BaseException):
        pass

    class Client:
        def ask(self, prompt):
            if dies_at and dies_at in prompt:
                raise ModelGone
            if fails_at and fails_at in prompt:
                raise RuntimeError("refused")
            return f"{name} {zlib.crc32(prompt.encode())}"

    return Client


def answered(spark, log):
    return {(r.question_id, r.prompt_variant): r.ai_answer.split()[0] for r in files.read_response_log(spark, log).collect()}


def test_a_run_that_dies_keeps_what_was_stored(spark, scratch):
    log, store, qs = os.path.join(scratch, "log"), os.path.join(scratch, "replies"), questions(spark)
    seen = []
    run = {"slice_calls": 20, "in_flight": 1, "concurrency": 2}
    with pytest.raises(Exception, match="ModelGone"):
        flows.enrich_durably(spark, qs, "m", ["naive", "role_expert"], model("first", dies_at="Question 17?"), log, store,
                             sample_size=None, on_progress=seen.append, **run)
    kept = answered(spark, log)
    assert set(kept.values()) <= {"first"} and len(kept) == (seen[-1]["calls"] if seen else 0) < 120
    assert [s["slices"] for s in seen] == list(range(1, len(seen) + 1))
    again = flows.enrich_durably(spark, qs, "m", ["naive", "role_expert"], model("second"), log, store, sample_size=None, **run)
    assert again["pending"] == again["added"] == 120 - len(kept)  # only the rest is called
    both = answered(spark, log)
    assert len(both) == again["total"] == 120 and all(both[k] == "first" for k in kept)
    assert collections.Counter(both.values()) == collections.Counter({"first": len(kept), "second": 120 - len(kept)} if kept else {"second": 120})
    done = flows.enrich_durably(spark, qs, "m", ["naive", "role_expert"], model("third"), log, store, sample_size=None, **run)
    assert (done["pending"], done["added"], done["slices"]) == (0, 0, 0)


def test_stored_replies_reach_the_log_after_a_crash_in_between(spark, scratch, monkeypatch):
    log, store, qs = os.path.join(scratch, "log"), os.path.join(scratch, "replies"), questions(spark, 20)
    append = files.append_response_log
    calls = []

    def crash(df, path):  # the first folder is logged but not marked, the second isn't logged
        calls.append(path)
        if len(calls) < 3:
            if len(calls) == 1:
                append(df, path)
            raise RuntimeError("crash")
        append(df, path)

    monkeypatch.setattr(files, "append_response_log", crash)
    run = {"slice_calls": 100, "in_flight": 1}
    for _ in range(2):
        with pytest.raises(RuntimeError, match="crash"):
            durable.run_slices(qs, ["naive"], "m", model("first"), store, log, **run)
    assert len(durable.reply_folders(spark, store, applied=False)) == 1  # the second run died recovering it
    out = durable.run_slices(qs, ["naive"], "m", model("third", fails_at="Question 5?"), store, log, **run)
    assert (out["recovered_slices"], out["pending"]) == (1, 0)
    assert files.read_response_log(spark, log).count() == 20 and set(answered(spark, log).values()) == {"first"}
    assert durable.reply_folders(spark, store, applied=False) == []


def test_failed_calls_stay_pending(spark, scratch):
    log, store, qs = os.path.join(scratch, "log"), os.path.join(scratch, "replies"), questions(spark, 12)
    out = durable.run_slices(qs, ["naive"], "m", model("a", fails_at="Question 5?"), store, log, slice_calls=5)
    assert (out["added"], out["failed"]) == (11, 1) and out["mean_seconds_per_call"] >= 0
    out = durable.run_slices(qs, ["naive"], "m", model("b"), store, log, slice_calls=5)
    assert (out["pending"], out["added"], answered(spark, log)["q5", "naive"]) == (1, 1, "b")
    none = durable.run_slices(qs.limit(0), ["naive"], "n", model("a"), store, log)
    assert (none["slices"], none["added"], none["mean_seconds_per_call"]) == (0, 0, None)
    with pytest.raises(ValueError):
        flows.enrich_durably(spark, qs, " ", ["naive"], model("a"), log, store)


def brute_means(rows, every):
    out, groups = [], collections.defaultdict(list)
    for key, at, value in rows:
        groups[key].append((at is not None, at or 0, value is not None, value or 0))
    for key, own in groups.items():
        n = known = total = 0
        for _, _, has, value in sorted(own):
            n, known, total = n + 1, known + has, total + value
            if n % every == 0 or n == len(own):
                out.append((key, n, round(total / known, 6) if known else None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("every", "ranges"), [(10, 7), (1, 3), (4, 1), (1000, 5)])
def test_running_mean_matches_brute_force(spark, every, ranges):
    rng = random.Random(every)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1, *range(300)]), rng.choice([None, 1.0, 2.5, float(rng.randint(0, 50))]))
            for _ in range(700)]
    rows += [("a", 7, 3.0)] * 400 + [("c", 1, None)] * 12 + [("d", None, 1.0)]  # a third of the rows are one
    df = spark.createDataFrame(rows, "n string, mean long, _v double").repartition(4)
    got = progress.running_mean(df.withColumnRenamed("n", "key"), ["key"], ["mean"], "_v", every, ranges)
    assert sorted([(r[0], r[1], None if r[2] is None else round(r[2], 6)) for r in got.collect()], key=str) == brute_means(rows, every)


def test_running_mean_without_keys_and_rows(spark):
    df = spark.range(25).selectExpr("id", "cast(id as double) v")
    got = sorted(map(tuple, progress.running_mean(df, [], ["id"], "v").collect()))
    assert got == [(10, 4.5), (20, 9.5), (25, 12.0)]
    assert progress.running_mean(df.limit(0), [], ["id"], "v").collect() == []
    with pytest.raises(ValueError):
        progress.running_mean(df, [], ["id"], "v", every=0)


def test_versions(spark, scratch):
    root, table = os.path.join(scratch, "store"), lambda n: {"t": spark.range(n).selectExpr("id", "'x' as s")}
    assert versions.load(spark, root) is None and versions.numbers(spark, root) == []
    first = versions.publish(spark, table(3), root)
    pinned = versions.load(spark, root).read(spark, "t")
    staged = versions.stage(spark, table(9), root)  # a crash before the swap
    assert versions.load(spark, root) == first and versions.load(spark, root).read(spark, "t").count() == 3
    # a version computed from the one in force
    second = versions.publish(spark, {"t": first.read(spark, "t").unionByName(table(2)["t"])}, root)
    assert second.number == 2 and versions.load(spark, root).read(spark, "t").count() == 5
    with pytest.raises(versions.Conflict):  # staged on version 1, which has a successor
        versions.commit(spark, staged, root)
    assert versions.numbers(spark, root) == [1, 2] and not [n for n in os.listdir(f"{root}/versions") if n.startswith(".") and not n.endswith(".crc")]
    assert pinned.count() == 3 and versions.load(spark, root, 1).read(spark, "t").count() == 3
    versions.discard(spark, staged)
    with pytest.raises(ValueError):
        versions.discard(spark, second)
    third = versions.publish(spark, table(0), root)
    assert versions.retain(spark, root, 2) == [1] and versions.numbers(spark, root) == [2, 3]
    assert not os.path.exists(first.data) and os.path.exists(second.data)
    assert versions.load(spark, root) == third and third.read(spark, "t").columns == ["id", "s"] and third.read(spark, "t").count() == 0
    with pytest.raises(ValueError):
        versions.retain(spark, root, 0)


GOOD = [("q1", "c", "multiple", "easy"), ("q2", "c", "boolean", "hard"), ("q3", None, "boolean", "hard")]


def test_audit_counts_what_fails(spark):
    rows = [*GOOD, ("q1", "c", "essay", "easy"), (None, "c", None, "odd"), (None, None, "odd", None)]
    t = {"q": spark.createDataFrame(rows, "question_id string, category string, question_type string, difficulty string"),
         "r": spark.createDataFrame([("q1",), ("q9",), ("q9",), (None,)], "question_id string")}
    got = gates.audit(t, {"q": gates.STAGING_CHECKS["stg_questions"], "r": gates.Checks(not_null=("question_id",))},
                      (gates.Relation("r", "question_id", "q", "question_id"),)).collect()
    assert {(r.table_name, r.check_name, r.column_name): r.n_failing for r in got} == {
        ("q", "not_null", "question_id"): 2, ("q", "not_null", "category"): 2, ("q", "not_null", "question_type"): 1,
        ("q", "not_null", "difficulty"): 1, ("q", "accepted_values", "question_type"): 2, ("q", "accepted_values", "difficulty"): 1,
        ("q", "unique", "question_id"): 1, ("r", "not_null", "question_id"): 1, ("r", "relation", "question_id"): 2}
    empty = {k: v.limit(0) for k, v in t.items()}
    zero = gates.audit(empty, {"q": gates.STAGING_CHECKS["stg_questions"]}, (gates.Relation("r", "question_id", "q", "question_id"),))
    assert {r.n_failing for r in zero.collect()} == {0}
    with pytest.raises(ValueError):
        gates.audit(t, {})


def test_a_failing_gate_leaves_the_published_version(spark, scratch):
    root = os.path.join(scratch, "gold")
    rows = [(f"q{i}", "c", "multiple", "easy", f"Question {i}?", "yes") for i in range(5)]
    qs = spark.createDataFrame(rows, "question_id string, category string, type string, difficulty string, question string, correct_answer string")
    rs = spark.createDataFrame([(f"q{i % 5}", m, "naive", "yes", True, 1.0 * i) for i in range(20) for m in ("m1", "m2")],
                               "question_id string, model_name string, prompt_variant string, ai_answer string, ai_correct boolean, response_time double")
    first, audit = flows.publish_gold(qs, rs, root)
    assert first.number == 1 and not any(r.n_failing for r in audit)
    assert first.read(spark, "fct_model_performance").where("model_name = 'm1'").first().n_responses == 20
    folders = set(os.listdir(f"{root}/data"))
    for bad, where in ((qs.withColumn("difficulty", F.lit("odd")), "difficulty accepted_values: 5"),
                       (qs.unionByName(qs.limit(1)), "question_id unique: 1"), (qs.where("question_id <> 'q0'"), "question_id relation: 8")):
        with pytest.raises(gates.GateFailed, match=where):
            flows.publish_gold(bad, rs, root)
    assert versions.load(spark, root) == first and set(os.listdir(f"{root}/data")) == folders
    assert flows.publish_gold(qs.limit(5), rs.where("model_name = 'm1'"), root)[0].number == 2
    assert versions.load(spark, root).read(spark, "fct_model_performance").count() == 1


def test_published_responses_grow_with_the_log(spark, scratch):
    log, root = os.path.join(scratch, "log"), os.path.join(scratch, "responses")
    for k in range(4):
        files.append_response_log(spark.createDataFrame([(f"q{k}", "m", "naive", "x", True, 1.0)], files.AI_RESPONSES), log)
        flows.publish_responses(spark, log, root)
        assert versions.load(spark, root).read(spark, "ai_responses").count() == k + 1
    assert versions.numbers(spark, root) == [3, 4]
