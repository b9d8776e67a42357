"""Sketches per window, merged over any stretch of time."""

import random

import pytest
from frames import at, couriers, orders
from pyspark.sql import functions as F

from dispatchlens import jobs
from dispatchlens.operators import sketches as S
from dispatchlens.operators.orders import in_status
from dispatchlens.session import new_run_folder
from dispatchlens.sources import files
from dispatchlens.streaming.replay import Replay


def deliveries(spark, times, **more):
    return orders(
        spark,
        *[
            {"order_status": "DELIVERED", "t": 13 * i, "actual_delivery_time_seconds": s, **more}
            for i, s in enumerate(times)
        ],
    )


def test_few_values_are_told_exactly(spark):
    found = S.delivery_sketches(deliveries(spark, [300, 100, 200, 400]))
    merged = S.merged_quantiles(found, [0.0, 0.5, 1.0], "weather_condition").first()
    assert (merged.value_count, merged.quantiles) == (4, [100, 200, 400])


def test_merged_ranks_stay_within_the_stated_error(spark):
    rng = random.Random(2)
    times = [int(rng.lognormvariate(7, 1)) for _ in range(20_000)]
    feed = deliveries(spark, times)
    stored = S.delivery_sketches(feed)
    assert stored.count() > 4_000  # minutes
    told = S.merged_quantiles(stored, [0.5, 0.95], "weather_condition")
    check = S.quantile_check(
        told, in_status(feed, "DELIVERED"), "actual_delivery_time_seconds", {"p50": 0.5, "p95": 0.95},
        "weather_condition",
    )
    ordered = sorted(times)
    assert {r.percentile: (r.value_count, r.exact_value, r.within_error) for r in check.collect()} == {
        "p50": (20_000, ordered[9_999], True), "p95": (20_000, ordered[18_999], True),
    }
    # means of the windows' own percentiles are something else
    means = in_status(feed, "DELIVERED").groupBy(F.window("event_timestamp", "1 minute")).agg(
        F.percentile_approx("actual_delivery_time_seconds", 0.95).alias("p")
    )
    mean = means.agg(F.avg("p")).first()[0]
    off = sum(t <= mean for t in times) / len(times)
    assert abs(off - 0.95) > 3 * S.rank_error()


def test_the_check_tells_a_wrong_quantile(spark):
    feed = deliveries(spark, range(1, 1001))
    wrong = S.merged_quantiles(S.delivery_sketches(feed), [0.5], "weather_condition")
    wrong = wrong.withColumn("quantiles", F.array(F.lit(900).cast("bigint")))
    values = in_status(feed, "DELIVERED")
    took, key = "actual_delivery_time_seconds", "weather_condition"
    assert not S.quantile_check(wrong, values, took, {"p50": 0.5}, key).first().within_error
    # as does a sketch of fewer events
    less = S.merged_quantiles(S.delivery_sketches(feed.filter(f"{took} % 2 = 0")), [0.5], key)
    assert not S.quantile_check(less, values, took, {"p50": 0.5}, key).first().within_error


def test_a_courier_counts_once_an_hour(spark):
    pings = [{"courier_id": f"c{i % 40}", "t": 17 * i} for i in range(400)]
    pings += [{"courier_id": "busy", "courier_status": "DELIVERED"}, {"courier_id": "copy", "is_duplicate": True}]
    minutes = S.idle_sketches(couriers(spark, *pings))
    by_hour = S.united_counts(minutes, F.date_trunc("hour", "window_start").alias("hour"), "zone_id")
    assert {r.hour: r.estimate for r in by_hour.collect()} == {at(0): 40, at(3600): 40}
    assert sum(r.estimate for r in S.united_counts(minutes, "window_start").collect()) > 300


def test_sketches_of_a_stream_merge_to_those_of_a_batch(spark):
    rng = random.Random(4)
    feed = deliveries(spark, [rng.randrange(5_000) for _ in range(500)])
    replay = Replay(spark, {"orders": feed, "couriers": couriers(spark)}, slices=3)
    stored = replay.run(S.delivery_sketches(replay.orders()), "delivery_sketches", ("window_date",))
    for found in (stored, S.delivery_sketches(feed)):
        told = S.merged_quantiles(found, [0.5, 0.95], "weather_condition")
        checked = S.quantile_check(
            told, in_status(feed, "DELIVERED"), "actual_delivery_time_seconds", {"p50": 0.5, "p95": 0.95},
            "weather_condition",
        )
        assert [r.within_error for r in checked.collect()] == [True, True]


def test_stored_sketches_are_read_by_date(spark):
    base = new_run_folder(spark, "sketches")
    files.write_results(S.delivery_sketches(deliveries(spark, [100] * 20_000)), base, "delivery_sketches")
    whole = files.read_results(spark, base, "delivery_sketches")
    days = [r[0] for r in whole.select("window_date").distinct().orderBy("window_date").collect()]
    assert len(days) == 4
    one = files.read_results(spark, base, "delivery_sketches", str(days[1]), str(days[1]))
    merged = S.merged_quantiles(one, [0.5], "weather_condition").first()
    assert merged.value_count == one.agg(F.sum("value_count")).first()[0] < 20_000
    assert files.read_results(spark, base, "idle_sketches").count() == 0
    assert S.merged_quantiles(files.read_results(spark, base, "promise_sketches"), [0.5], "zone_id").count() == 0


@pytest.mark.parametrize("size", [200, 400])
def test_stated_errors_shrink_with_size(size):
    assert S.rank_error(2 * size) < S.rank_error(size) < 0.02
    assert S.distinct_error(13) < S.distinct_error(12) < 0.02


def test_jobs_know_nothing_of_sketches(spark):
    # the nine analytics and their datasets stay as they are
    assert not set(jobs.ANALYTICS) & {"delivery_sketches", "idle_sketches"}
