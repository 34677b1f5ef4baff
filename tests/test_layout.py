"""Layout helpers: scan spreading and broadcast size checks."""

from benchlake.operators.joins import fits_broadcast
from benchlake.session import spread

DOCS = "/root/testdata/sf0.001/documents.parquet"
LINEITEM = "/root/testdata/sf0.1/lineitem.parquet"


def test_spread_adds_tasks_only_to_a_scan_with_few_splits(spark):
    docs = spark.read.parquet(DOCS)
    target = spark.sparkContext.defaultParallelism
    assert docs.rdd.getNumPartitions() < target
    spread_docs = spread(docs, "doc_id")
    assert spread_docs.rdd.getNumPartitions() == target
    assert sorted(r.doc_id for r in spread_docs.select("doc_id").collect()) == sorted(
        r.doc_id for r in docs.select("doc_id").collect())
    # Enough splits already: the same DataFrame comes back (no shuffle added).
    assert spread(docs, "doc_id", min_tasks=1) is docs
    plan = spread_docs.select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan  # pruning still reaches the scan


def test_fits_broadcast_follows_threshold(spark):
    li = spark.read.parquet(LINEITEM)
    assert fits_broadcast(li.select("l_partkey"))
    assert not fits_broadcast(li)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not fits_broadcast(li.select("l_partkey"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1GB")
        assert fits_broadcast(li)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
