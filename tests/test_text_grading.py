"""Text functions and grading: hand-worked cases, properties and the fixture truth table."""

import hashlib
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from benchlake.functions import grading
from benchlake.functions import text as T


TRUTH_TABLE = [
    ("The Rivers", "it was rivers!", True),
    ("art", "party", True),
    ("The", "the", False),
    ("True", "Oui, bien sûr", True),
    ("True", "untrue", False),
    ("False", "yes and no", True),
    ("café", "CAFÉ.", True),
    ("x_y", "x_y", True),
    ("½", "it is ½", True),
    ("A B", "", False),
]


def test_grading_truth_table(spark):
    df = spark.createDataFrame([(c, a) for c, a, _ in TRUTH_TABLE], "correct_answer string, ai_answer string")
    got = [r.ai_correct for r in grading.grade(df).collect()]
    assert got == [e for _, _, e in TRUTH_TABLE]


POOL = list("abcxyzABCXYZ éèÉçüßøñ_-.,!?'\"()0123456789½²³") + [
    " ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", "　",
    "́", "the", "an", "a", "vrai", "non", "ǅ", "Ⅻ", "٣", "中", "😀",
]


def _random_strings(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(POOL) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


NORMALISED = [  # worked by hand
    ("  The Cat  sat. ", "cat sat"), ("AN a the", ""), ("Theatre", "theatre"), ("rock'n'roll", "rocknroll"),
    ("a_b c", "a_b c"), ("É\u00a0Ü", "é ü"), ("½ of it", "½ of it"), ("x\u2028y", "x y"), ("!?", ""), ("", ""),
    ("1,000 km", "1000 km"), ("the-end", "theend"), ("An\tAnt", "ant"), ("中 文", "中 文"), ("😀 ok", "ok"),
]


def test_normalise_hand_worked_cases(spark):
    df = spark.createDataFrame([(s,) for s, _ in NORMALISED], "s string")
    assert [r[0] for r in df.select(T.normalise("s")).collect()] == [n for _, n in NORMALISED]


def test_strip_and_normalise_properties(spark):
    strings = _random_strings(800, 7) + ["\xa0\tleading", "trailing\n", "  ", ""]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    noisy = F.concat(F.lit("!the "), "s", F.lit(" ,An"))  # signs and articles around a text don't show
    rows = df.select("s", T.strip("s").alias("st"), T.normalise("s").alias("nm"), T.normalise(noisy).alias("noisy")).collect()
    for r in rows:
        assert r.st == r.s.strip(), repr(r.s)
        assert r.noisy == r.nm, repr(r.s)
        assert all(c == "_" or not unicodedata.category(c).startswith(("P", "S", "C", "Z")) or c == " " for c in r.nm), repr(r.s)
        assert "  " not in r.nm and r.nm == r.nm.strip() and not {"a", "an", "the"} & set(r.nm.split(" "))


def test_normalise_is_idempotent_and_grading_reflexive(spark):
    strings = _random_strings(600, 21)
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    once = df.select("s", T.normalise("s").alias("n1"))
    rows = once.select("s", "n1", T.normalise("n1").alias("n2"),
                       grading.is_correct(F.col("s"), F.col("s")).alias("self")).collect()
    for r in rows:
        assert r.n2 == r.n1, repr(r.s)
        # A reply equal to the expected answer is correct unless that answer normalises to nothing.
        assert r.self == (r.n1 != ""), repr(r.s)


def test_grading_properties(spark):
    """Padding an answer never makes a contained reply wrong; an empty reply is never right."""
    rows = [(a, c) for a, c in zip(_random_strings(600, 11), _random_strings(600, 12), strict=True)]
    df = spark.createDataFrame(rows, "a string, c string")
    padded = F.concat("c", F.lit(" "), "a")
    got = df.select("a", "c", T.normalise("c").alias("nc"), grading.is_correct(F.lit(""), F.col("c")).alias("none"),
                    grading.is_correct(F.col("c"), F.col("c")).alias("same"),
                    grading.is_correct(padded, F.col("c")).alias("padded")).collect()
    for r in got:
        assert not r.none, r
        assert r.same == (r.nc != ""), r
        if r.nc and (r.a == "" or r.a[0] in " .,!?"):  # the first word stays whole
            assert r.padded, r


def test_strip_reasoning_markers(spark):
    m = T.REASONING_MARKER
    cases = [
        ("plain answer \n", "plain answer"),
        (f"thinking{m}1a2b__\n Paris ", "Paris"),
        (f"a{m}ff__ b{m}0__\nfinal\n", "final"),
        (f"x{m}zz__ kept", f"x{m}zz__ kept"),  # not a marker: no hex id
        (f"text{m}9__", ""),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "c string")
    got = [r[0] for r in df.select(T.strip_reasoning("c")).collect()]
    assert got == [e for _, e in cases]


def test_question_id_matches_hashlib(spark):
    rows = [("Science", "What is H2O?"), ("Art", "Qui a peint « La Joconde » ?")]
    df = spark.createDataFrame(rows, "c string, q string")
    got = [r[0] for r in df.select(T.question_id("c", "q")).collect()]
    assert got == [hashlib.sha256(f"{c}::{q}".encode()).hexdigest()[:16] for c, q in rows]


def test_choices_deterministic_same_multiset(spark):
    rows = [(f"id{i}", f'[" w{i}a ", "w{i}b", "  ", "w{i}c"]', f" right{i} ") for i in range(200)]
    df = spark.createDataFrame(rows, "qid string, wrong string, right string")
    a = {r.qid: r.ch for r in df.select("qid", T.choices("qid", "wrong", "right").alias("ch")).collect()}
    b = {r.qid: r.ch for r in df.repartition(7).select("qid", T.choices("qid", "wrong", "right").alias("ch")).collect()}
    assert a == b
    for qid, wrong, right in rows:
        i = qid[2:]
        assert sorted(a[qid]) == sorted([f"w{i}a", f"w{i}b", f"w{i}c", f"right{i}"])
    assert len({tuple(v) for v in a.values()}) > 1


def test_b64_decode_malformed_is_null(spark):
    df = spark.createDataFrame([("SGVsbG8gw6k=",), ("###",), ("//4=",), ("",), (None,)], "b string")
    assert [r[0] for r in df.select(T.b64decode("b")).collect()] == ["Hello é", None, None, "", None]


def test_json_answers_drop_blank(spark):
    df = spark.createDataFrame([('["  a ", "", " ", "b|c"]',)], "j string")
    assert df.select(T.json_answers("j")).first()[0] == ["a", "b|c"]


@pytest.mark.parametrize("bad", [["nope"], []])
def test_unknown_or_empty_variant_rejected(bad):
    from benchlake.functions.prompts import validate_variants

    with pytest.raises(ValueError):
        validate_variants(bad)


def test_prompt_templates(spark):
    from benchlake.functions.prompts import BOOLEAN_HINT, prompt_expr

    df = spark.createDataFrame(
        [("naive", "Q1?", "Art", "easy", "boolean"), ("strict_format", "Q2?", "Art", "hard", "boolean"),
         ("role_expert", "Q3?", "Geo", "medium", "multiple")],
        "prompt_variant string, question string, category string, difficulty string, type string")
    p = [r[0] for r in df.select(prompt_expr()).collect()]
    assert p[0] == "Q1?"
    assert p[1] == "Q2?\n\nOutput: one short phrase on a single line." + BOOLEAN_HINT
    assert BOOLEAN_HINT not in p[2] and "\nTopic: Geo / level: medium\n\nQ3?\n\n" in p[2]
