"""Whole jobs through the command line."""

import pytest

from __spark_entry__ import queries
from dispatchlens import __main__ as cli
from dispatchlens import jobs
from dispatchlens.plans.catalog import ANALYTICS, REPORTS
from dispatchlens.session import new_run_folder
from dispatchlens.sources.files import read_results
from oracle import feeds as fixture


@pytest.fixture(scope="module")
def stored(spark, tables):
    base = new_run_folder(spark, "feeds")
    jobs.store_feeds(fixture.feeds(spark, tables), base)
    return base


def test_feeds_survive_storage(spark, tables, stored):
    direct, back = fixture.feeds(spark, tables), jobs.stored_feeds(spark, stored)
    for name, feed in direct.items():
        assert back[name].count() == feed.count()
        assert back[name].columns == feed.columns
    day = jobs.stored_feeds(spark, stored, first_date="2024-01-01", last_date="2024-01-01")
    wanted = direct["couriers"].where("to_date(event_timestamp) = '2024-01-01'").count()
    assert day["couriers"].count() == wanted > 0


def test_batch_then_every_report(spark, tables, stored, tmp_path, capsys):
    results = new_run_folder(spark, "results")
    # the second run replaces the first
    cli.main(["batch", stored, results])
    cli.main(["batch", stored, results, "--from", "2024-01-01"])
    feeds = fixture.feeds(spark, tables)
    for name, analytic in ANALYTICS.items():
        back = read_results(spark, results, name)
        assert back.exceptAll(analytic(feeds)).count() == 0
        assert back.count() == analytic(feeds).count()
    for name, (source, rollup) in REPORTS.items():
        direct = rollup(ANALYTICS[source](feeds)).collect()
        assert sorted(map(str, jobs.report(spark, name, results).collect())) == sorted(
            map(str, direct)
        ), name
    assert jobs.report(spark, "dash_eta_top10", results, "2030-01-01").count() == 0
    nothing = jobs.report(spark, "dash_order_kpis", results, "2030-01-01").first()
    assert tuple(nothing) == (0, 0, 0.0)
    assert tuple(jobs.report(spark, "dash_anomaly_kpis", results, "2030-01-01").first()) == (0, 0, 0.0)
    wanted = jobs.report(spark, "dash_orders_over_time", results).count()
    capsys.readouterr()
    cli.main(["report", "dash_orders_over_time", results])
    assert len(capsys.readouterr().out.strip().splitlines()) == wanted + 1
    cli.main(["report", "dash_orders_over_time", results, "--out", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/out").count() == wanted


def test_streams_once_from_files(spark, stored, capsys):
    base = new_run_folder(spark, "streams")
    cli.main(["stream", "--files", stored, "--once", f"{base}/out", f"{base}/ck"])
    for name in ANALYTICS:
        stored_rows = read_results(spark, f"{base}/out", name)
        assert stored_rows.count() > 0, name
    cli.main(["report", "dash_orders_by_zone", f"{base}/out"])
    assert "zone_downtown" in capsys.readouterr().out


def test_summary_prints_all_counts(stored, capsys):
    cli.main(["summary", stored])
    text = capsys.readouterr().out
    assert "READY_FOR_PICKUP" in text and "LOCATION_JUMP" in text and "total_events" in text


def test_unknown_report_is_refused(capsys):
    with pytest.raises(SystemExit):
        cli.main(["report", "nonsense", "/nowhere"])
    assert "unknown report" in capsys.readouterr().err


@pytest.mark.parametrize("name", ["orders", "couriers"])
def test_stored_feeds_are_made_by_all_cores(spark, tables, monkeypatch, name):
    kept = {}
    monkeypatch.setattr(jobs.files, "write_feed", lambda feed, path, mode: kept.update({path: feed}))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):  # nothing is written here
        queries()[f"feed_{name}"](spark, tables).count()
    (feed,) = kept.values()
    assert feed.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
