"""Shapes of the physical plans that the scale notes (PLANS.md) rely on."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from __spark_entry__ import queries
from topicscope.operators import leaderboard as lb
from topicscope.operators.trailing import trailing_changelog
from topicscope.plans import QUERIES
from topicscope.plans.daily_job import daily_report
from topicscope.sources.gkg import gkg_tsv_path
from topicscope.sources.tables import load_table

# the library's own queries; tests/llm has the plans of the optional operators, some of which use Arrow
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "MapInArrow", "PythonMapInArrow")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_batch_queries_stay_in_the_jvm_and_never_pair_rows(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert not [n for n in PYTHON_NODES if n in plan], plan
    assert not [n for n in PAIR_NODES if n in plan], plan


def test_daily_report_scan_and_top_k(spark):
    plan = _plan(daily_report(spark, gkg_tsv_path(spark, SF_SMALL)))
    assert "PushedFilters: [IsNotNull(DATE), IsNotNull(AllNames)]" in plan
    assert re.search(r"ReadSchema: struct<DATE:date,AllNames:string>", plan)
    # top-down: final top-k, the exchange on the day alone, partial top-k,
    # final count, the exchange on (day, topic), partial count -- two exchanges
    final = re.search(r"WindowGroupLimit .*Final", plan).start()
    by_day = re.search(r"Exchange hashpartitioning\(day#\d+, \d+\)", plan).start()
    partial = re.search(r"WindowGroupLimit .*Partial", plan).start()
    by_pair = re.search(r"Exchange hashpartitioning\(day#\d+, topic#\d+, \d+\)", plan).start()
    assert final < by_day < partial < by_pair
    assert plan.count("partial_count") == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_trailing_log_is_partitioned_by_name_and_bucket(spark):
    ev = load_table(spark, SF_SMALL, "events")
    plan = _plan(trailing_changelog(ev, "event_type", "ts", "event_id"))
    # the changes are partitioned by (name, bucket), never by the name alone;
    # the other exchanges are the small per-bucket table's (name, bucket) aggregates
    ex = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert ex and all(len(e.split(",")) == 3 for e in ex), ex
    assert sum("__b" in e for e in ex) == 1
    assert re.search(r"windowspecdefinition\(__key#\d+, __b#\d+L?,", plan)
    assert "partial_count" in plan and "partial_sum" in plan
    # the opening counts join on the partitioning the changes already have
    assert re.search(r"(SortMergeJoin|BroadcastHashJoin) \[__key#\d+, __b#\d+L?\]", plan)


def test_bounded_set_step_reads_updates_once(spark):
    cur = spark.createDataFrame([("a", 5), ("b", 3)], "name string, count long")
    upd = load_table(spark, SF_SMALL, "events").groupBy(
        F.col("user_id").cast("string").alias("name")).count()
    plan = _plan(lb.step(cur, upd, 2))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # the bounded task, and the lowest count of the at most n members (a subquery)
    assert plan.count("Exchange SinglePartition") == 2 and "Subquery" in plan
    assert "WindowGroupLimit" in plan
    # the updates are aggregated once and never joined back
    assert plan.count("Scan parquet") == 1


def test_row_positions_number_blocks_not_whole_groups(spark):
    plan = _plan(queries()["timestamp_sequence"](spark, SF_SMALL))
    # the rows are numbered per (group, block); only the one-row-per-block
    # table is partitioned by the group alone, for its prefix sum
    assert re.search(r"row_number\(\) windowspecdefinition\(millis#\d+L?, __blk#\d+L?,", plan)
    by_group = re.findall(r"Exchange hashpartitioning\(millis#\d+L?, \d+\)", plan)
    assert len(by_group) == 1
    sum_window = re.search(r"sum\(__n#\d+L?\) windowspecdefinition\(millis#\d+L?, __blk", plan)
    assert sum_window, plan
