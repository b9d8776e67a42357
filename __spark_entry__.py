"""Registered queries, their SQL counterparts, and the flagship query."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchlens import jobs, schemas
from dispatchlens.operators import lifecycle, market, motion, quality, sales, sketches
from dispatchlens.operators.couriers import session_finals
from dispatchlens.operators.orders import in_status
from dispatchlens.plans import rollups
from dispatchlens.plans.catalog import ANALYTICS, REPORTS
from dispatchlens.session import new_run_folder, prepare
from dispatchlens.sources import files
from dispatchlens.streaming import audit, incremental, late, stateful, tracks
from dispatchlens.streaming.replay import FLUSH_ID, Replay
from oracle import feeds as fixture
from oracle.queries import ORACLES

try:  # the text operators and their pipeline can be left out as a whole
    import corpus_pipeline
    from dispatchlens.llm import queries as text_queries
except ImportError:
    corpus_pipeline = text_queries = None

Query = Callable[[SparkSession, str], DataFrame]

ORDER_COLUMNS = [
    f.name
    for f in schemas.ORDER_FEED
    if f.name not in ("schema_version", "order_items", "metadata")
]
COURIER_COLUMNS = [
    "event_id", "courier_id", "order_id", "zone_id", "courier_status", "previous_status",
    "event_timestamp", "ingestion_timestamp", "latitude", "longitude", "location_accuracy_meters",
    "heading_degrees", "distance_to_restaurant_meters", "distance_to_customer_meters",
    "vehicle_type", "session_id",
    "shift_duration_seconds", "deliveries_completed_in_session", "is_duplicate",
    "is_late_arrival", "anomaly_flag",
]


class Feeds:
    """Both feeds of the tables in a folder, built on demand."""

    def __init__(self, spark: SparkSession, tables: str):
        self.spark = prepare(spark)
        self.tables = tables

    def orders(self) -> DataFrame:
        return fixture.order_feed(self.spark, self.tables)

    def couriers(self) -> DataFrame:
        return fixture.courier_feed(self.spark, self.tables)

    def item_names(self) -> DataFrame:
        return fixture.item_names(fixture.read_table(self.spark, self.tables, "part"))

    def analytic(self, name: str) -> DataFrame:
        analytic = ANALYTICS[name]
        return analytic({feed: getattr(self, feed)() for feed in analytic.feeds})


def _on_feeds(build: Callable[[Feeds], DataFrame]) -> Query:
    return lambda spark, tables: build(Feeds(spark, tables))


def _replay(session: SparkSession, tables: str, **options) -> Replay:
    """Both feeds in slices of as many files as there are cores to write and read them."""
    files = session.sparkContext.defaultParallelism
    feeds = fixture.feeds(session, tables, always=True)
    return Replay(session, feeds, files=files, state_totals=False, **options)


def _on_stream(build: Callable[[Replay], DataFrame]) -> Query:
    def run(spark: SparkSession, tables: str) -> DataFrame:
        return build(_replay(prepare(spark), tables))

    return run


def _report(source: str, rollup: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_feeds(lambda feeds: rollup(feeds.analytic(source)))


def _stored(name: str, columns: list[str]) -> Query:
    """A feed kept by event date and read again."""

    def run(feeds: Feeds) -> DataFrame:
        base = new_run_folder(feeds.spark, "feeds")
        feed = fixture.feeds(feeds.spark, feeds.tables)[name]  # made by all cores, as it is written out
        jobs.store_feeds({name: feed}, base)
        schema = schemas.ORDER_FEED if name == "orders" else schemas.COURIER_FEED
        return files.read_feed(feeds.spark, f"{base}/{name}", schema).select(*columns)

    return _on_feeds(run)


def _json_lines_roundtrip(feeds: Feeds) -> DataFrame:
    path = new_run_folder(feeds.spark, "jsonl")
    orders = fixture.feeds(feeds.spark, feeds.tables)["orders"]  # by all cores, as lines are compressed
    files.write_json_lines(orders, path, schemas.ORDER_FEED)
    return files.read_json_lines(feeds.spark, path, schemas.ORDER_FEED).select(*ORDER_COLUMNS)


def _avro_roundtrip(feeds: Feeds) -> DataFrame:
    path = new_run_folder(feeds.spark, "avro")
    files.write_avro(feeds.couriers(), path, schemas.COURIER_FEED)
    return files.read_avro(feeds.spark, path, schemas.COURIER_FEED).select(*COURIER_COLUMNS)


def _results_roundtrip(feeds: Feeds) -> DataFrame:
    base, name = new_run_folder(feeds.spark, "results"), "uc1_order_volume"
    files.write_results(feeds.analytic(name), base, name)
    # a second run replaces the first one
    files.write_results(feeds.analytic(name), base, name)
    return files.read_results(feeds.spark, base, name)


def _sketches(feeds: Feeds, name: str) -> DataFrame:
    """Sketches of all windows, stored like the other results and read again."""
    base = new_run_folder(feeds.spark, "sketches")
    feed = feeds.orders() if name in ("delivery_sketches", "promise_sketches") else feeds.couriers()
    files.write_results(getattr(sketches, name)(feed), base, name)
    return files.read_results(feeds.spark, base, name)


def _merged_percentiles(feeds: Feeds) -> DataFrame:
    """Percentiles over all windows from their sketches, checked against the events."""
    took, eta = "actual_delivery_time_seconds", "estimated_delivery_time_seconds"
    delivered, placed = in_status(feeds.orders(), "DELIVERED", took), in_status(feeds.orders(), "PLACED", eta)
    finals = session_finals(feeds.couriers())
    parts = [
        ("delivery", "delivery_sketches", delivered, took, {"p50": 0.5, "p95": 0.95}, ("weather_condition",)),
        ("promise", "promise_sketches", placed, eta, {"p90": 0.9}, ("zone_id", "weather_condition")),
        ("sessions", "productivity_sketches", finals, "deliveries", {"p50": 0.5, "p90": 0.9},
         ("zone_id", "vehicle_type")),
    ]
    found = None
    for of, name, values, value, shares, keys in parts:
        told = sketches.merged_quantiles(_sketches(feeds, name), list(shares.values()), *keys)
        zone, kind = (F.lit(None).cast("string"), keys[0]) if len(keys) == 1 else keys
        one = sketches.quantile_check(told, values, value, shares, *keys).select(
            F.lit(of).alias("of"),
            F.col(zone).alias("zone_id") if isinstance(zone, str) else zone.alias("zone_id"),
            F.col(kind).alias("kind"), "percentile", "value_count", "exact_value", "within_error",
        )
        found = found.unionByName(one) if found else one
    return found


def _idle_couriers_by_hour(feeds: Feeds) -> DataFrame:
    """Different idle couriers per hour and zone from sketches of minutes, checked against the pings."""
    hour = lambda time: F.date_trunc("hour", time).alias("hour_start")
    told = sketches.united_counts(_sketches(feeds, "idle_sketches"), hour("window_start"), "zone_id")
    each = market.idle_couriers(feeds.couriers()).select(hour("event_timestamp"), "zone_id", "courier_id")
    exact = each.distinct().groupBy("hour_start", "zone_id").agg(F.count("courier_id").alias("idle_couriers"))
    return sketches.distinct_check(told, exact, "hour_start", "zone_id", name="idle_couriers")


def _enum_violations(feeds: Feeds) -> DataFrame:
    return quality.enum_violations(
        feeds.orders(), "orders", schemas.enum_columns(schemas.ORDER_FEED)
    ).unionByName(
        quality.enum_violations(
            feeds.couriers(), "couriers", schemas.enum_columns(schemas.COURIER_FEED)
        )
    )


def _stream_dedup(replay: Replay) -> DataFrame:
    events = replay.orders().select("event_id", "order_id", "order_status", "event_timestamp")
    return replay.run(stateful.dedup_stream(events), "dedup").filter(F.col("event_id") != FLUSH_ID)


def _stream_sessions(replay: Replay) -> DataFrame:
    return replay.run(stateful.activity_sessions(replay.couriers()), "sessions")


def _stream_promises(replay: Replay) -> DataFrame:
    errors = stateful.promise_errors_stream(replay.orders(), replay.orders())
    stored = replay.run(errors, "promises").filter(F.col("order_id") != FLUSH_ID)
    return lifecycle.promise_accuracy(stored)


def _kept_report(source: str, parts, keys: tuple[str, ...], report) -> Query:
    """A report over partial sums that a stream keeps; every batch comes twice, as after a failure."""

    def run(replay: Replay) -> DataFrame:
        sums = incremental.PartialSums(replay.spark, f"{replay.folder}/sums", parts, keys, fold_every=3)

        def merge_twice(rows: DataFrame, batch: int) -> None:
            sums.merge(rows, batch)
            sums.merge(rows, batch)

        replay.merge(ANALYTICS[source]({"orders": replay.orders()}), merge_twice, source)
        return report(sums.read())

    return _on_stream(run)


def _state_audit(spark: SparkSession, tables: str) -> DataFrame:
    """State that streams hold while their feeds go on: the join of two feeds, chained aggregations,
    and promises that wait for their delivery."""
    session = prepare(spark)
    found, replay = None, _replay(session, tables, flush=False)
    for query in ("uc9_supply_demand", "uc13_courier_productivity", "x_eta_accuracy"):
        if query in ANALYTICS:
            replay.analytic(query)
        else:
            replay.run(stateful.promise_errors_stream(replay.orders(), replay.orders()), query)
        watermark = audit.watermark_micros(session, replay.progress)
        rows = audit.state_audit(session, replay.checkpoint(query), watermark)
        rows = rows.select(F.lit(query).alias("query"), "*", F.timestamp_micros(F.lit(watermark)).alias("watermark"))
        found = found.unionByName(rows) if found else rows
    return found


def _late_rows(spark: SparkSession, tables: str) -> DataFrame:
    """Both feeds in the order in which they came, cut on some days while events go on."""
    session = prepare(spark)
    day = F.unix_date(F.to_date("event_timestamp"))
    first, last = fixture.feeds(session, tables)["orders"].agg(F.min(day), F.max(day)).first()
    # two days, each cut twice within minutes
    minutes = ((1, 757), (1, 761), (2, 831), (2, 835))
    days = 0 if first is None else last - first + 1
    cuts = [((first + third * days // 3) * 1440 + m) * 60_000_000 for third, m in minutes if days]
    return late.loss_by_feed(_replay(session, tables, order_by="ingestion_timestamp", cuts=cuts))


def _stream_outer(replay: Replay) -> DataFrame:
    balance = market.supply_demand(replay.orders(), replay.couriers(), keep_unserved=True)
    return replay.run(balance, "supply_demand_outer", ("window_date",))


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {}
    for name in ANALYTICS:
        registered[name] = _on_feeds(partial(Feeds.analytic, name=name))
        registered["stream_" + name.split("_")[0]] = _on_stream(
            partial(Replay.analytic, name=name)
        )
    for name, (source, rollup) in REPORTS.items():
        registered[name] = _report(source, rollup)
    registered |= {
        "feed_orders": _stored("orders", ORDER_COLUMNS),
        "feed_couriers": _stored("couriers", COURIER_COLUMNS),
        "feed_timeline": _on_feeds(lambda f: quality.timeline(f.orders(), f.couriers())),
        "feed_status_counts": _on_feeds(lambda f: quality.status_counts(f.orders())),
        "feed_anomaly_counts": _on_feeds(lambda f: quality.anomaly_counts(f.couriers())),
        "feed_edge_case_counts": _on_feeds(
            lambda f: quality.edge_case_counts(f.orders(), f.couriers())
        ),
        "io_jsonl_roundtrip": _on_feeds(_json_lines_roundtrip),
        "io_avro_roundtrip": _on_feeds(_avro_roundtrip),
        "io_results_roundtrip": _on_feeds(_results_roundtrip),
        "q_late_arrivals": _on_feeds(lambda f: quality.late_arrivals(f.orders(), f.couriers())),
        "q_location_jumps": _on_feeds(lambda f: motion.location_jumps(f.couriers())),
        "q_anomaly_label_score": _on_feeds(lambda f: motion.anomaly_label_score(f.couriers())),
        "q_dedup_orders": _on_feeds(
            lambda f: quality.dedup_orders(f.orders()).select(
                "event_id",
                "order_id",
                "order_status",
                "event_timestamp",
                "ingestion_timestamp",
                "is_duplicate",
            )
        ),
        "q_dedup_couriers": _on_feeds(
            lambda f: quality.dedup_couriers(f.couriers()).select(
                "event_id",
                "courier_id",
                "session_id",
                "event_timestamp",
                "courier_status",
                "ingestion_timestamp",
                "is_duplicate",
            )
        ),
        "q_lifecycle_gaps": _on_feeds(lambda f: lifecycle.lifecycle_gaps(f.orders())),
        "q_impossible_durations": _on_feeds(lambda f: lifecycle.impossible_durations(f.orders())),
        "q_enum_violations": _on_feeds(_enum_violations),
        "q_offline_mid_delivery": _on_feeds(lambda f: quality.offline_mid_delivery(f.couriers())),
        "x_eta_accuracy": _on_feeds(
            lambda f: lifecycle.promise_accuracy(lifecycle.promise_errors(f.orders()))
        ),
        "uc9_supply_demand_approx": _on_feeds(
            lambda f: market.supply_estimate_check(f.orders(), f.couriers())
        ),
        "x_surge_zones": _on_feeds(
            lambda f: market.surge_windows(f.analytic("uc9_supply_demand"))
        ),
        "x_supply_demand_outer": _on_feeds(
            lambda f: market.supply_demand(f.orders(), f.couriers(), keep_unserved=True)
        ),
        "x_item_sales": _on_feeds(
            lambda f: sales.item_sales(sales.explode_items(f.orders()), f.item_names())
        ),
        "x_order_total_check": _on_feeds(lambda f: sales.order_total_check(f.orders())),
        "x_eta_formula_check": _on_feeds(lambda f: sales.promise_formula_check(f.orders())),
        "x_zone_of_ping": _on_feeds(lambda f: motion.zones_of_pings(f.couriers())),
        "x_demand_curve": _on_feeds(lambda f: sales.demand_curve(f.orders())),
        "x_cancel_reasons": _on_feeds(lambda f: sales.cancellation_reasons(f.orders())),
        "x_merged_percentiles": _on_feeds(_merged_percentiles),
        "x_idle_couriers_by_hour": _on_feeds(_idle_couriers_by_hour),
        "x_ratings": _on_feeds(lambda f: sales.restaurant_ratings(f.orders())),
        "x_step_durations": _on_feeds(lambda f: lifecycle.step_durations(f.orders())),
        "stream_dedup": _on_stream(_stream_dedup),
        "stream_dash_order_kpis": _kept_report(
            "uc1_order_volume", rollups.order_parts, (), rollups.order_kpis
        ),
        "stream_dash_revenue_by_zone": _kept_report(
            "uc11_order_value", rollups.revenue_parts, ("zone_id",), rollups.revenue_from_parts
        ),
        "stream_late_rows": _late_rows,
        "stream_state_audit": _state_audit,
        "stream_location_jumps": _on_stream(
            lambda replay: replay.run(tracks.jumps_stream(replay.couriers()), "jumps")
        ),
        "stream_session_windows": _on_stream(_stream_sessions),
        "stream_x_eta_accuracy": _on_stream(_stream_promises),
        "stream_x_supply_demand_outer": _on_stream(_stream_outer),
    }
    if text_queries:
        registered |= text_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return registered


def oracle_sql() -> dict[str, str]:
    if not text_queries:
        return dict(ORACLES)
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return ORACLES | text_queries.ORACLES | pipeline


def entry(spark: SparkSession) -> DataFrame:
    """Orders and cancellation rate per zone and minute."""
    return queries()["uc1_order_volume"](spark, "/root/testdata/sf0.001")
