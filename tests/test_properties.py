"""Property tests (hypothesis) against plain-Python brute force: keep-first de-duplication
under any partitioning, and the anti join against a growing history on each of its paths."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from benchlake.operators.dedup import keep_first
from benchlake.operators.joins import anti_join_growing

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
KEYS = st.sampled_from(["a", "b", "é", "hot", "hot", "hot"])


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, st.integers(0, 5), st.text(max_size=6)), min_size=1, max_size=60),
       parts=st.integers(1, 7))
def test_keep_first_is_the_smallest_ordinal_then_row(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, ord int, p string").repartition(parts)
    got = {r.k: (r.ord, r.p, r.n) for r in keep_first(df, ["k"], "ord", count_col="n").collect()}
    want = {}
    for k, o, p in rows:
        want.setdefault(k, []).append((o, p))
    assert got == {k: (*min(v), len(v)) for k, v in want.items()}


@SETTINGS
@given(small=st.lists(st.tuples(st.integers(0, 30), KEYS), max_size=25),
       large=st.lists(st.tuples(st.integers(0, 30), KEYS), max_size=60),
       bound=st.sampled_from([0, 3, 1000]))
def test_anti_join_growing_is_set_difference(spark, small, large, bound):
    s = spark.createDataFrame(small, "id int, k string")
    big = spark.createDataFrame(large, "id int, k string")
    got = sorted(tuple(r) for r in anti_join_growing(s, big, ["id", "k"], broadcast_keys=bound).collect())
    assert got == sorted(r for r in small if r not in set(large))
