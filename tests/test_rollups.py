"""Reports against pandas on result tables with awkward numbers."""

import numpy as np
import pandas as pd
from frames import result
from pyspark.sql import functions as F

from dispatchlens.dimensions import VEHICLE_TYPES, WEATHER_CONDITIONS, ZONE_IDS
from dispatchlens.plans import rollups as R
from dispatchlens.plans.catalog import ANALYTICS, REPORTS
from dispatchlens.schemas import RESULTS, result_schema

rng = np.random.default_rng(7)


def cents(n):
    return rng.integers(100, 9999, n) / 100


def test_every_report_reads_a_result_table():
    assert set(RESULTS) == set(ANALYTICS)
    assert len(REPORTS) == 25
    assert {source for source, _ in REPORTS.values()} <= set(RESULTS)


def volume(spark):
    return result(
        spark,
        "uc1_order_volume",
        {"m": 0, "zone_id": "zone_west", "total_orders": 3, "cancelled_orders": 1},
        {"m": 1, "zone_id": "zone_west", "total_orders": 4, "cancelled_orders": 0},
        {"m": 1, "zone_id": "zone_east", "total_orders": 0, "cancelled_orders": 2},
        {"m": 1, "zone_id": None, "total_orders": 5, "cancelled_orders": 5},
    )


def test_order_reports(spark):
    kpis = R.order_kpis(volume(spark)).first()
    assert (kpis.total_orders, kpis.cancelled_orders) == (12, 8)
    assert kpis.cancellation_rate_pct == 8 / 12 * 100
    zones = {r.zone_id: r.total_orders for r in R.orders_by_zone(volume(spark)).collect()}
    assert zones == {"zone_west": 7, "zone_east": 0}
    assert [r.total_orders for r in R.orders_over_time(volume(spark)).collect()] == [3, 9]


def test_empty_totals_give_zero_rate(spark):
    none = volume(spark).withColumn("total_orders", F.lit(0))
    assert R.order_kpis(none).first().cancellation_rate_pct == 0.0


def test_date_bounds(spark):
    frame = volume(spark)
    assert R.within_dates(frame, "2024-01-01", "2024-01-01").count() == 4
    assert R.within_dates(frame, "2024-01-02").count() == 0
    assert R.within_dates(frame, last="2023-12-31").count() == 0


def value(spark, minutes=60 * 60):
    rows = [
        {
            "m": int(m),
            "zone_id": ZONE_IDS[i % 6],
            "order_count": int(rng.integers(1, 9)),
            "avg_order_eur": float(a),
            "total_revenue_eur": float(t),
        }
        for i, (m, a, t) in enumerate(zip(rng.integers(0, minutes, 400), cents(400), cents(400)))
    ]
    return result(spark, "uc11_order_value", *rows), pd.DataFrame(rows)


def test_revenue_reports(spark):
    frame, pdf = value(spark)
    by_zone = pdf.groupby("zone_id").agg(
        {"order_count": "sum", "avg_order_eur": "mean", "total_revenue_eur": "sum"}
    )
    for row in R.revenue_by_zone(frame).collect():
        want = by_zone.loc[row.zone_id].round(2)
        assert (row.order_count, row.avg_order_eur) == (want.order_count, want.avg_order_eur)
        assert abs(row.total_revenue_eur - want.total_revenue_eur) < 1e-9
    kpis = R.revenue_kpis(frame).first()
    assert abs(kpis.avg_basket_eur - by_zone.round(2).avg_order_eur.mean()) < 1e-9


def test_cumulative_revenue_crosses_days(spark):
    frame, pdf = value(spark)
    want = pdf.groupby("m").total_revenue_eur.sum().sort_index().cumsum()
    rows = R.cumulative_revenue(frame).collect()
    assert len({r.window_start.date() for r in rows}) > 2
    assert np.allclose([r.cumulative_revenue_eur for r in rows], want.to_numpy(), atol=1e-9)


def balance(spark):
    rows = [
        {
            "m": m,
            "zone_id": zone,
            "demand_orders": m + i,
            "supply_couriers": 1,
            "demand_supply_ratio": float(m + i),
        }
        for m in range(5)
        for i, zone in enumerate(ZONE_IDS[: 3 + m % 2])
    ]
    return result(spark, "uc9_supply_demand", *rows)


def test_supply_reports(spark):
    frame = balance(spark)
    latest = {r.zone_id: r.demand_orders for r in R.supply_latest(frame).collect()}
    assert latest == {ZONE_IDS[0]: 4, ZONE_IDS[1]: 5, ZONE_IDS[2]: 6, ZONE_IDS[3]: 6}
    pivot = R.ratio_pivot(frame).collect()
    assert pivot[1][ZONE_IDS[3]] == 4.0 and pivot[0][ZONE_IDS[3]] is None
    assert len(pivot) == 5
    assert R.last_window(frame).first()[0].minute == 5


def test_plain_means_round_half_even(spark):
    frame = result(
        spark,
        "uc10_processing_time",
        {"zone_id": "a", "order_count": 9, "avg_processing_sec": 100.0, "max_processing_sec": 7},
        {"zone_id": "a", "order_count": 1, "avg_processing_sec": 101.0, "max_processing_sec": 9},
    )
    row = R.prep_by_zone(frame).first()
    assert (row.order_count, row.avg_processing_sec, row.max_processing_sec) == (10, 100.0, 9)


def test_sla_reports(spark):
    frame = result(
        spark,
        "uc3_prep_sla",
        {"m": 0, "is_peak_hour": True, "breach_count": 2, "avg_prep_time_sec": 1300.0},
        {"m": 1, "is_peak_hour": False, "breach_count": 5, "avg_prep_time_sec": 1400.0},
        {"m": 1, "is_peak_hour": True, "breach_count": 1, "avg_prep_time_sec": 1500.0},
    )
    kpis = R.sla_kpis(frame).first()
    assert (kpis.total_breaches, kpis.avg_prep_on_breach_sec) == (8, 1400.0)
    split = {r.period: r.breach_count for r in R.sla_peak_split(frame).collect()}
    assert split == {"Peak hour": 3, "Off-peak": 5}
    assert [r.breach_count for r in R.sla_over_time(frame).collect()] == [2, 6]


def weighted(group, name, weight="order_count"):
    return (group[name] * group[weight]).sum() / group[weight].sum()


def test_weather_summary_order_and_weights(spark):
    rows = [
        {
            "m": i,
            "weather_condition": w,
            "order_count": int(rng.integers(1, 9)),
            "avg_delivery_sec": float(rng.integers(900, 3000)),
            "p95_delivery_sec": int(rng.integers(900, 3000)),
        }
        for i, w in enumerate(["SNOW", "CLEAR", "HEAVY_RAIN", "FOG"] * 20)
    ]
    found = R.weather_summary(result(spark, "uc4_weather", *rows)).collect()
    assert [r.weather_condition for r in found] == ["CLEAR", "HEAVY_RAIN", "SNOW"]
    for weather, group in pd.DataFrame(rows).groupby("weather_condition"):
        for row in found:
            if row.weather_condition == weather:
                assert row.avg_delivery_sec == round(weighted(group, "avg_delivery_sec"), 0)
                assert row.p95_delivery_sec == round(weighted(group, "p95_delivery_sec"), 0)


def promises(spark):
    rows = [
        {
            "m": i % 7,
            "zone_id": ZONE_IDS[i % 5],
            "weather_condition": WEATHER_CONDITIONS[i % 3],
            "order_count": int(rng.integers(1, 9)),
            "avg_eta_sec": float(rng.integers(900, 3000)),
            "p90_eta_sec": int(rng.integers(900, 3000)),
        }
        for i in range(200)
    ]
    return result(spark, "uc12_eta_accuracy", *rows), pd.DataFrame(rows)


def test_eta_reports(spark):
    frame, pdf = promises(spark)
    summary = R.eta_summary(frame).collect()
    want = {
        key: round(weighted(group, "avg_eta_sec"), 0)
        for key, group in pdf.groupby(["zone_id", "weather_condition"])
    }
    assert {(r.zone_id, r.weather_condition): r.avg_eta_sec for r in summary} == want
    averages = [r.avg_eta_sec for r in summary]
    assert averages == sorted(averages, reverse=True)
    assert [r.avg_eta_sec for r in R.eta_top(frame).collect()] == averages[:10]
    kpis = R.eta_kpis(frame).first()
    assert kpis.avg_eta_sec == round(weighted(pdf, "avg_eta_sec"), 0)
    pivot = R.eta_pivot(frame).collect()
    assert [r.weather_condition for r in pivot] == list(WEATHER_CONDITIONS[:3])
    assert pivot[0][ZONE_IDS[0]] == want[ZONE_IDS[0], "CLEAR"]
    assert pivot[0][ZONE_IDS[5]] is None


def test_anomaly_reports(spark):
    frame = result(
        spark,
        "uc7_anomalies",
        {"m": 0, "zone_id": "a", "total_events": 10, "total_anomalies": 1, "location_jump": 1},
        {"m": 0, "zone_id": "b", "total_events": 30, "total_anomalies": 2, "location_jump": 2},
        {"m": 1, "zone_id": "b", "total_events": 0, "total_anomalies": 0, "location_jump": 0},
    )
    assert R.anomaly_kpis(frame).first().anomaly_rate_pct == 3 / 40 * 100
    rates = [r.anomaly_rate_pct for r in R.anomaly_rate_over_time(frame).collect()]
    assert rates == [7.5, 0.0]
    assert R.anomaly_by_zone(frame.drop("impossible_speed")).columns == [
        "zone_id",
        "location_jump",
        "offline_mid_delivery",
    ]


def test_productivity_reports(spark):
    rows = [
        {
            "m": i % 7,
            "zone_id": ZONE_IDS[i % 4],
            "vehicle_type": VEHICLE_TYPES[i % 5],
            "session_count": int(rng.integers(1, 9)),
            "avg_deliveries": float(a),
            "p50_deliveries": int(rng.integers(0, 9)),
            "p90_deliveries": int(rng.integers(0, 9)),
            "deliveries_per_hour": float(h),
        }
        for i, (a, h) in enumerate(zip(cents(300), cents(300)))
    ]
    frame, pdf = result(spark, "uc13_courier_productivity", *rows), pd.DataFrame(rows)
    ranked = R.productivity_ranked(frame).collect()
    rates = [r.deliveries_per_hour for r in ranked]
    assert len(ranked) == 20 and rates == sorted(rates, reverse=True)
    groups = dict(list(pdf.groupby(["vehicle_type", "zone_id"])))
    for row in ranked:
        group = groups[row.vehicle_type, row.zone_id]
        assert row.sessions == group.session_count.sum()
        assert row.p50_deliveries == round(group.p50_deliveries.median(), 1)
        for name in ("avg_deliveries", "deliveries_per_hour"):
            assert abs(row[name] - weighted(group, name, "session_count")) <= 0.005 + 1e-9
    kpis = R.productivity_kpis(frame).first()
    assert abs(kpis.avg_deliveries - weighted(pdf, "avg_deliveries", "session_count")) < 1e-9
    pivot = {r.zone_id: r for r in R.productivity_pivot(frame).collect()}
    for row in ranked:
        assert pivot[row.zone_id][row.vehicle_type] == row.deliveries_per_hour


def test_reports_accept_empty_tables(spark):
    for name, (source, rollup) in REPORTS.items():
        rows = rollup(spark.createDataFrame([], result_schema(source))).collect()
        assert len(rows) <= 1, name
