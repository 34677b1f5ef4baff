"""Physical-plan properties of every registered query (the shapes that must hold at scale).

* no cross product of any kind (``CartesianProduct``, ``BroadcastNestedLoopJoin``);
* no row-at-a-time or scalar Python UDF (``BatchEvalPython``, ``ArrowEvalPython``);
* Python on executors only where a model is called (``MapInPandas``);
* column pruning: scans read only the columns a query needs, never a whole wide table;
* captured payloads are parsed once per row.
"""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
MODEL_CALLS = {"batch_inference", "inference_dead_letters"}
PARSE_ONCE = {"api_decode", "payload_dead_letters"}
# Columns no registered query uses (but for the median of l_extendedprice): a scan reading them would mean pruning failed.
UNUSED = ["l_orderkey", "l_suppkey", "l_extendedprice", "l_tax", "l_shipdate", "p_mfgr", "p_container",
          "p_retailprice"]


def _plans(spark):
    sys.path.insert(0, ROOT)
    from benchlake.plans.driver_queries import QUERIES

    for name, fn in QUERIES.items():
        yield name, fn(spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cross_products_udfs_or_wide_scans(spark):
    seen = 0
    for name, plan in _plans(spark):
        seen += 1
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)
        assert ("MapInPandas" in plan) == (name in MODEL_CALLS), name
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
            unused = [c for c in UNUSED if (name, c) != ("exact_median", "l_extendedprice")]
            assert not any(c in schema for c in unused), (name, schema)
        if name in PARSE_ONCE:  # no filter pushdown may copy the JSON parse into its conditions
            assert plan.count("from_json(") == 1, name
    assert seen >= 54


def test_clean_flow_moves_the_texts_once(spark):
    from benchlake.plans import silver
    from benchlake.plans.adapters import bronze_questions

    clean = silver.clean_questions(bronze_questions(spark, SF))
    plan = clean._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(exchanges) == ["_key", "doc_id"], exchanges  # doc_id: the spread of a small scan
