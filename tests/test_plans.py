"""What the plans must look like to hold at scale."""

import re

import pytest

import __spark_entry__ as entry_module
from dispatchlens import jobs
from dispatchlens.plans.catalog import ANALYTICS
from dispatchlens.session import new_run_folder
from dispatchlens.streaming import replay, runner
from oracle import feeds as fixture

TEXT = re.compile(r"op\d+_|pipeline$")
QUERIES = {n: q for n, q in entry_module.queries().items() if not TEXT.match(n)}
EXCHANGES = {
    "uc9_supply_demand": 3,
    "uc9_supply_demand_approx": 5,
    "uc13_courier_productivity": 2,
}
STORED = ("feed_orders", "feed_couriers")
BATCH = sorted(n for n in QUERIES if not n.startswith(("stream_", "io_")) and n not in STORED)
#: custom state with timers has no other form; the others have sinks of their own
OWN_FORM = (
    "stream_location_jumps", "stream_late_rows", "stream_dash_order_kpis", "stream_dash_revenue_by_zone",
    "stream_state_audit",
)
STREAMS = sorted(n for n in QUERIES if n.startswith("stream_") and n not in OWN_FORM)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_no_forced_broadcast(spark, tables, no_broadcast, name):
    text = plan(QUERIES[name](spark, tables))
    for bad in ("PythonUDF", "ArrowEval", "MapInPandas", "CartesianProduct", "NestedLoop", "Broadcast"):
        assert bad not in text
    assert "collect_list" not in text and "collect_set" not in text


@pytest.mark.parametrize("name", [n for n in BATCH if n.startswith("uc")])
def test_aggregations_combine_before_the_shuffle(spark, tables, name):
    text = plan(QUERIES[name](spark, tables))
    exchanges = len(re.findall(r"Exchange hashpartitioning\(window", text))
    assert exchanges == EXCHANGES.get(name, 1)
    for line, below in zip(text.splitlines(), text.splitlines()[1:]):
        if "Exchange hashpartitioning(window" in line:
            assert "Aggregate" in below


@pytest.mark.parametrize("name", STREAMS)
def test_streams_run_no_python(spark, tables, name, monkeypatch):
    seen = []

    def watch(results, *args, **kwargs):
        query = runner.parquet_sink(results, *args, **kwargs)
        query.awaitTermination()
        seen.append(query._jsq.explainInternal(True))
        return query

    monkeypatch.setattr(replay, "parquet_sink", watch)
    QUERIES[name](spark, tables)
    (text,) = seen
    for bad in ("Python", "Arrow", "Pandas"):
        assert bad not in text
    assert "Append" in text or "StateStoreSave" in text or "Join" in text


def test_totals_come_with_the_orders(spark, tables):
    for name in ("uc11_order_value", "x_order_total_check"):
        text = plan(QUERIES[name](spark, tables))
        assert text.count("FileScan") == 1 and "Join" not in text


def test_running_total_shares_one_distribution_of_minutes(spark, tables, no_broadcast):
    frame = QUERIES["dash_cumulative_revenue"](spark, tables)
    frame.collect()
    final = plan(frame).split("== Initial Plan ==")[0]
    assert len(re.findall(r"(?m)^\W*Exchange ", final)) <= 7


def test_stored_feeds_are_pruned_by_date(spark, tables):
    base = new_run_folder(spark, "pruned")
    jobs.store_feeds(fixture.feeds(spark, tables), base)
    feeds = jobs.stored_feeds(spark, base, first_date="2024-01-01", last_date="2024-01-01")
    text = plan(ANALYTICS["uc1_order_volume"](feeds))
    found = re.search(r"PartitionFilters: \[([^\]]*)\]", text)[1]
    assert "event_date" in found


def test_scans_read_only_what_is_used(spark, tables):
    text = plan(QUERIES["feed_status_counts"](spark, tables))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


@pytest.mark.parametrize("name", ["q_dedup_orders", "q_dedup_couriers", "dash_supply_latest"])
def test_first_row_per_key_is_cut_before_the_shuffle(spark, tables, name):
    text = plan(QUERIES[name](spark, tables))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_jump_detection_scans_and_shuffles_the_points_once(spark, tables):
    frame = QUERIES["q_location_jumps"](spark, tables)
    frame.collect()
    final = plan(frame).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") == 1


def test_top_rows_do_not_sort_everything(spark, tables):
    assert "TakeOrderedAndProject(limit=10" in plan(QUERIES["dash_eta_top10"](spark, tables))
