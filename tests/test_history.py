"""The indexed history: first answers stay, few files are read, dead runs leave nothing."""

import pytest
from pyspark.sql import functions as F

from benchlake.schemas import AI_RESPONSES, RESPONSE_KEY
from benchlake.sources import files
from benchlake.sources.history import History
from benchlake.sources.versions import Conflict
from benchlake.streaming import merge

ROW = AI_RESPONSES.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ") + ", at int"


def answers(spark, ids, said, at=0):
    return spark.createDataFrame([(i, "m", "naive", said, True, 1.0, at) for i in ids], ROW)


def open_store(spark, scratch, buckets=4):
    return History(spark, f"{scratch}/history", AI_RESPONSES, RESPONSE_KEY, buckets)


def held(store):
    rows = [(r.question_id, r.ai_answer) for r in store.read().collect()]
    assert len(rows) == len(set(rows))
    return dict(rows)


def test_the_first_answer_of_a_key_stays(spark, scratch):
    store = open_store(spark, scratch)
    assert store.read().collect() == [] and store.files().count() == 0
    first = answers(spark, ["a", "b", None], "late", 2).unionByName(answers(spark, ["a"] * 3, "early", 1))
    assert store.append(first, "one", "at").rows == 2
    assert store.append(answers(spark, ["b", "c", ""], "second"), "two", "at").rows == 2
    assert held(store) == {"a": "early", "b": "late", "c": "second", "": "second"}
    # a retried increment, an empty one, and one that is stored already
    assert store.append(answers(spark, ["z"], "never"), "two", "at") == (0, 0, store.files().count())
    assert store.append(answers(spark, [], "none"), "three", "at").rows == 0
    assert store.append(answers(spark, ["a", "b"], "again"), "four", "at").rows == 0
    again = open_store(spark, scratch, buckets=9)  # made with 4
    assert again.buckets == 4 and held(again) == {"a": "early", "b": "late", "c": "second", "": "second"}
    with pytest.raises(ValueError):
        store.append(answers(spark, ["q"], "x"), "../up", "at")


def test_files_read_follow_the_increment_not_the_history(spark, scratch):
    store, read = open_store(spark, scratch), {}
    for i in range(20):
        store.append(answers(spark, [f"{i}-{j}" for j in range(300)], "old"), f"n{i}", "at")
        if i in (1, 19):  # ten times the history: three stored keys and forty new ones
            found = store.append(answers(spark, ["0-7", "1-8", "1-9"] + [f"new{i}-{j}" for j in range(40)], "new"), f"probe{i}", "at")
            assert found.rows == 40
            read[i] = found
    assert read[19].files >= 8 * read[1].files
    assert read[1].files_read <= 3 + 2 and read[19].files_read <= 3 + 6  # false finds: some 2 % of keys times files
    assert held(store)["0-7"] == "old" and len(held(store)) == 20 * 300 + 80


def test_every_stored_key_is_found_and_few_others(spark, scratch):
    store = open_store(spark, scratch, buckets=1)
    store.append(answers(spark, [f"k{j}" for j in range(4000)], "x"), "all", "at")
    of = lambda ids: answers(spark, ids, "y").select(F.xxhash64(*RESPONSE_KEY).alias("__h"))
    assert all(store.files_for(of([f"k{j}"])).count() == 1 for j in range(0, 4000, 800))
    words = store._index("words", "file string, word long, mask long")
    assert words.agg(F.sum(F.bit_count("mask"))).first()[0] <= 4 * 4000
    seen = sum(store.files_for(of([f"other{j}"])).count() for j in range(10))
    assert seen <= 3


def test_a_run_that_dies_before_its_index_has_its_name_leaves_nothing(spark, scratch, monkeypatch):
    store = open_store(spark, scratch)
    store.append(answers(spark, ["a"], "first"), "one", "at")
    with monkeypatch.context() as m:
        m.setattr(History, "_commit", lambda *x: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            store.append(answers(spark, ["a", "b"], "second"), "two", "at")
    assert held(store) == {"a": "first"} and store.increments() == ["one"]
    assert store.append(answers(spark, ["a", "b"], "third"), "two", "at").rows == 1
    assert held(store) == {"a": "first", "b": "third"}
    with pytest.raises(Conflict):
        store._write(answers(spark, ["c"], "x").drop("at").withColumn("__h", F.xxhash64(*RESPONSE_KEY)), "two")


def test_beyond_the_list_of_files_the_whole_history_is_read(spark, scratch, monkeypatch):
    monkeypatch.setattr("benchlake.sources.history.MAX_FILES", 1)
    store = open_store(spark, scratch)
    store.append(answers(spark, [f"k{j}" for j in range(50)], "old"), "one", "at")
    found = store.append(answers(spark, [f"k{j}" for j in range(40, 60)], "new"), "two", "at")
    assert found.rows == 10 and found.files_read == found.files
    assert sorted(held(store).values()) == ["new"] * 10 + ["old"] * 50


def test_a_stream_merges_into_the_history(spark, scratch):
    store, log = open_store(spark, scratch), f"{scratch}/log"
    files.append_response_log(answers(spark, ["a", "b"], "first").drop("at"), log)
    files.append_response_log(answers(spark, ["b", "c", ""], "second").drop("at"), log)
    run = lambda: merge.stream_into_history(spark, log, store, f"{scratch}/checkpoint")
    assert sum(x.rows for x in run()) == 3
    files.append_response_log(answers(spark, ["c", "d"], "third").drop("at"), log)
    assert sum(x.rows for x in run()) == 1 and run() == []
    assert held(store) == {"a": "first", "b": "first", "c": "second", "d": "third"}
