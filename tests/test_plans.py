"""Plan checks: no Python UDF, no cartesian product, pruning, one shuffle for A5."""

import datetime as dt

import pytest

from celltide.operators import logs as LG
from celltide.plans import queries  # noqa: F401  (registers them)
from celltide.plans.registry import QUERIES
from celltide.sources import fixtures as X

from locations import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_udf_no_cartesian(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"


def test_scan_prunes_relation_partition(spark):
    p = _plan(QUERIES["scan"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(relation" in p and "(relation#" in p


def test_latest_cell_single_hash_exchange(spark):
    p = _plan(QUERIES["latest_cell"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in p


def test_limited_panel_is_top_n(spark):
    logs = X.log_lines(X.load_events(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in _plan(LG.panel(logs, {}, now=dt.datetime(2024, 1, 30), limit=10))
    assert "TakeOrderedAndProject" not in _plan(LG.panel(logs, {}, now=dt.datetime(2024, 1, 30)))


def test_time_ranges_reach_the_scan(spark, tmp_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    LG.write_logs(X.log_lines(X.load_events(spark, SF_SMALL)), f"{tmp_dir}/logs")
    stored = spark.read.parquet(f"{tmp_dir}/logs")
    p = _plan(LG.panel(stored, {"namespace": "verne"}, now=dt.datetime(2024, 1, 20), date_col="log_date"))
    assert "GreaterThanOrEqual(arrival_ts,2024-01-19" in p and "LessThanOrEqual(arrival_ts,2024-01-20" in p
    assert "PartitionFilters: [isnotnull(log_date" in p
    p = _plan(LG.retention(stored, dt.datetime(2024, 1, 20), ts_col="arrival_ts", date_col="log_date"))
    assert "GreaterThanOrEqual(arrival_ts,2024-01-05" in p and "PartitionFilters: [isnotnull(log_date" in p


def test_projection_pushed_to_scan(spark):
    p = _plan(QUERIES["topic_filter"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string" in p
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


DECODING = ["cells", "cells_no_key", "quarantine", "quarantine_rows", "catalog", "typed", "conformance", "shadow_all_fields", "device_shadow",
            "active_devices", "tumbling", "window_rows"]


@pytest.mark.parametrize("name", DECODING)
def test_decoding_moves_no_message_for_the_catalog(spark, name):
    """The catalog check is a literal list: no join on relation, and the JSON text is parsed once."""
    p = _plan(QUERIES[name](spark, SF_SMALL))
    assert p.count("parseJson") == 1
    assert "SortMergeJoin" not in p
    # only counted rows may be dealt by relation: partial results of an aggregate stand below
    lines = p.split("\n")
    for i, line in enumerate(lines):
        assert "Exchange hashpartitioning(relation#" not in line or any("Aggregate" in x for x in lines[i + 1:i + 3])


def test_conformance_counts_before_it_meets_the_catalog(spark):
    p = _plan(QUERIES["conformance"](spark, SF_SMALL))
    lines = [x.strip() for x in p.split("\n")]
    exchanges = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    # one of partial counts on (relation, field), and one of counted rows for the window
    assert len(exchanges) == 2 and "relation" in lines[exchanges[1]] and "field" in lines[exchanges[1]]
    assert "partial_sum" in lines[exchanges[1] + 1] and "Join" not in p
