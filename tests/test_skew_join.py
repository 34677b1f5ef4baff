"""The join of a hot key: equal to the plain join, and no task gets the hot key's rows."""

import collections

from pyspark.sql import functions as F

from benchlake.operators import joins, marts


def fact(spark, n=30_000):
    """A third of all rows on question 7, some without a question, some without a dimension row."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 101 == 0, None).otherwise(i % 4001)
    return spark.range(0, n, 1, 6).select(key.cast("long").alias("question_id"), i.alias("at"), F.repeat(F.lit("x"), 50).alias("ai_answer"))


def dim(spark, n=4000):
    return spark.range(n).select(F.col("id").alias("question_id"), (F.col("id") % 9).alias("category"))


def counted(df):
    return collections.Counter(tuple(r) for r in df.select("question_id", "at", "category").collect())


def test_hot_keys_are_those_above_the_share(spark):
    found = joins.hot_keys(fact(spark), "question_id", 0.05)
    assert found.keys == [7] and found.rows == fact(spark).where("question_id is not null").count()
    assert joins.hot_keys(fact(spark).limit(0), "question_id", 0.05) == ([], 0)


def test_equal_to_the_plain_join(spark, monkeypatch):
    f, d = fact(spark), dim(spark)
    plain = counted(f.join(d, "question_id"))
    assert counted(joins.skew_join(f, d, "question_id")) == plain
    twice = d.unionByName(d.where("question_id in (7, 8)"))  # a repeated dimension row
    assert counted(joins.skew_join(f, twice, "question_id")) == counted(f.join(twice, "question_id"))
    assert counted(joins.skew_join(f, d.where("question_id <> 7"), "question_id")) == counted(f.join(d.where("question_id <> 7"), "question_id"))
    assert counted(joins.skew_join(f.limit(0), d, "question_id")) == {}
    monkeypatch.setattr(joins, "HOT_ROWS", 0)
    assert counted(joins.skew_join(f, d, "question_id")) == plain


def test_the_hot_keys_rows_stay_apart(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(kept, ("-1", "false"), strict=True):
            spark.conf.set(k, v)
        sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        split = sizes(joins.skew_join(fact(spark), dim(spark), "question_id"))
        plain = sizes(fact(spark).join(dim(spark), "question_id"))
        enriched = marts.responses_enriched(
            fact(spark).selectExpr("question_id", "'m' as model_name", "'v' as prompt_variant", "ai_answer", "true as ai_correct", "1.0D as response_time"),
            dim(spark).selectExpr("question_id", "category", "'t' as question_type", "'d' as difficulty"))
        assert sizes(enriched) == split
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert split[-1] <= 2 * split[len(split) // 2]
    assert plain[-1] > 4 * plain[len(plain) // 2]
