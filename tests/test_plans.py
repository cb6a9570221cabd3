"""Physical plans: what is read, what is shuffled and what is decided at run time."""

import pytest
from pyspark.sql import functions as F

from tierflow import session
from tierflow.operators.merge import incremental_slice, merge_insert_only, merge_upsert
from tierflow.operators.reduce import latest_per_key
from tierflow.operators.scd import scd2_apply, scd2_build, split_by_batch
from tierflow.plans import QUERIES, layers
from tierflow.sources.registry import RETAIL, registry
from tierflow.sources.tables import read_table

ROOT = "/root/testdata/sf0.001"


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def log(spark):
    return read_table(spark, ROOT, "events").select("user_id", "ts", "value")


def test_scd2_without_hot_keys_ends_as_one_shuffle_and_one_window(log):
    final = plan(scd2_build(log, ["user_id"], "ts"), run=True)
    assert final.count("Exchange hashpartitioning") == 1 and final.count("Window [") == 1
    assert "Join" not in final and "Union" not in final


def test_scd2_with_hot_keys_has_a_branch_for_them(log):
    final = plan(scd2_build(log, ["user_id"], "ts", hot_rows=60), run=True)
    assert "Union" in final and "_slot" in final


def test_ranking_with_ties_shuffles_less_than_the_table(spark):
    orders = read_table(spark, "/root/testdata/sf0.01", "orders")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = latest_per_key(orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], "o_orderdate")
        assert latest.count() < orders.count()
        text = plan(latest)
        assert text.count("FileScan") == 2 and "LeftSemi" in text and "Window" not in text
        # The rows once, and the maxima, taken before they are shuffled, twice.
        assert text.count("Exchange hashpartitioning") == 3 and "partial_max" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_insert_only_merge_evaluates_the_source_once(spark, area):
    orders = read_table(spark, ROOT, "orders").select("o_orderkey", "o_custkey")
    orders.where("o_orderkey < 900").write.parquet(f"{area}/target")
    orders.where("o_orderkey > 600").write.parquet(f"{area}/source")
    target, source = (spark.read.parquet(f"{area}/{name}") for name in ("target", "source"))
    text = plan(merge_insert_only(target, source, ["o_orderkey"]))
    # The target's rows, its keys once more for the anti join, and the source once.
    assert text.count("FileScan") == 3 and text.count("LeftAnti") == 1


def test_applying_a_batch_reads_the_stored_versions_once(spark, log, area):
    """Once for the versions that stay; those to rebuild come from a table that a job before wrote."""
    scd2_build(log, ["user_id"], "ts").write.parquet(f"{area}/stored")
    stored = spark.read.parquet(f"{area}/stored")
    applied = scd2_apply(stored, log.where("user_id = 3"), ["user_id"], "ts")
    scans = [part for part in plan(applied).split("FileScan parquet")[1:]]
    of_target = [s for s in scans if "end_date" in s.split("Batched")[0]]
    assert len(of_target) == 1 and len([f for f in applied.inputFiles() if "/reopened-" in f]) > 0
    # The job before reads the target once as well: the batch's versions, without those that stay.
    reopened = split_by_batch(stored, log.where("user_id = 3"), ["user_id"], "ts")[1]
    assert len([s for s in plan(reopened).split("FileScan parquet")[1:] if "end_date" in s.split("Batched")[0]]) == 1


def test_bronze_and_routing_read_the_feed_once(spark):
    for name in ("route_known", "quarantine", "topic_payloads"):
        assert plan(QUERIES[name](spark, ROOT)).count("FileScan json") == 1


def test_latest_row_is_limited_before_the_shuffle(log):
    text = plan(latest_per_key(log, ["user_id"], "ts", ties="one"))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_mark_is_a_subquery_of_the_scan(log):
    text = plan(incremental_slice(log, log.where("value > 5"), "ts").select("user_id"))
    assert "DataFilters: [isnotnull(ts" in text.replace("\n", "") and "Subquery" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_small_batches_do_not_shuffle_the_target(spark, log):
    small = log.where("user_id < 10").groupBy("user_id").agg(F.max("ts").alias("ts"), F.max("value").alias("value"))
    final = plan(merge_upsert(log, small, ["user_id"], "ts"), run=True)
    assert "SortMergeJoin" not in final and "BroadcastHashJoin" in final
    assert final.count("Exchange hashpartitioning") == 1  # the aggregation of the batch itself


def test_large_lookups_are_not_broadcast(spark):
    orders, customers = read_table(spark, ROOT, "orders"), read_table(spark, ROOT, "customer")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = layers.lookup_join(orders, customers, "o_custkey", "c_custkey")
        assert "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reconciling_reads_each_feed_once(spark):
    text = plan(QUERIES["reconcile_feeds"](spark, ROOT))
    assert text.count("FileScan") == 2 and text.count("PushedFilters: [") == 2
    assert "LessThan(ts" in text and "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


WRITING = ("scd2_refresh", "bronze_topics", "pipeline_bronze", "feed_fanout", "feed_incremental_files", "feed_file_replay",
           "late_rows", "late_rows_in_batches")


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if "stream" not in n])
def test_no_python_in_any_plan(spark, name):
    if name in WRITING:
        pytest.skip("writes its tables while building")
    text = plan(QUERIES[name](spark, ROOT))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_shared_root_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_root(spark) == named
    assert session.new_area(spark, "x").startswith(named + "/x-")
    assert session.new_area(spark, "x") != session.new_area(spark, "x")


def test_a_cluster_without_a_shared_root_is_refused():
    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        session.shared_root(Cluster)


def test_registry_from_configuration():
    entry = {"name": "books", "schema": RETAIL["books"].schema, "keys": ["book_id"], "sequence_by": "updated",
             "scd_type": 2, "required": ["book_id", "updated"]}
    assert registry([entry]) == {"books": RETAIL["books"]}
