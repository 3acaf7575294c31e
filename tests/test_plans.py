"""Physical-plan properties that matter at scale (checked on the small tables)."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from gridzone.operators import terrain
from gridzone.plans.registry import QUERIES

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver tables not available")



def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loop_or_cartesian_and_no_row_udfs(spark):
    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SMOKE))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan, name  # never a row-at-a-time Python UDF
        assert "ArrowEvalPython" not in plan, name  # tiles pass Python whole (mapInArrow, applyInArrow), never cell columns


def test_flagship_prunes_columns_broadcasts_spans_and_pushes_bbox(spark):
    df = E.queries()["zonal_crosstab"](spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", formatted)
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in schemas
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in schemas
    # the zone's bounding box is applied to the raw rows, before the layer aggregation
    assert re.search(r"\(l_orderkey#\d+L % \d+\) >= \d+", formatted)


def test_focal_has_one_exchange_after_the_layer(spark):
    cells = spark.range(400).select((F.col("id") % 20).alias("x"), F.floor(F.col("id") / 20).alias("y"),
                                    (F.col("id") % 7).cast("double").alias("v"))
    for df in (terrain.focal_mean(cells, 8), terrain.hillshade(cells, 8)):
        plan = _plan(df)
        assert plan.count("Exchange hashpartitioning") == 1, plan


def test_topn_has_partial_group_limit_before_shuffle(spark):
    plan = _plan(E.queries()["topn_preview"](spark, SMOKE))
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) + final
