"""The nine windowed analytics and the reports drawn from each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import couriers, market, orders
from . import rollups


@dataclass(frozen=True)
class Analytic:
    """A windowed analytic: the feeds it reads, the function it runs, and which events of each feed
    reach its windows and move its watermark."""

    name: str
    feeds: tuple[str, ...]
    run: Callable[..., DataFrame]
    inputs: tuple[Callable[[DataFrame], DataFrame], ...]

    def __call__(self, frames: dict[str, DataFrame], **options) -> DataFrame:
        return self.run(*[frames[feed] for feed in self.feeds], **options)


ANALYTICS = {
    analytic.name: analytic
    for analytic in (
        Analytic("uc1_order_volume", ("orders",), orders.order_volume, (orders.originals,)),
        Analytic("uc3_prep_sla", ("orders",), orders.prep_sla_breaches, (orders.late_preparations,)),
        Analytic("uc4_weather", ("orders",), orders.weather_impact, (orders.timed_deliveries,)),
        Analytic("uc7_anomalies", ("couriers",), couriers.anomalies, (couriers.all_pings,)),
        Analytic("uc9_supply_demand", ("orders", "couriers"), market.supply_demand, (orders.placements, market.idle_couriers)),
        Analytic("uc10_processing_time", ("orders",), orders.processing_time, (orders.finished_preparations,)),
        Analytic("uc11_order_value", ("orders",), orders.order_value, (orders.priced_placements,)),
        Analytic("uc12_eta_accuracy", ("orders",), orders.promised_eta, (orders.promised_placements,)),
        Analytic("uc13_courier_productivity", ("couriers",), couriers.courier_productivity, (couriers.active_couriers,)),
    )
}

# report name -> (result table it reads, roll-up)
REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "dash_order_kpis": ("uc1_order_volume", rollups.order_kpis),
    "dash_orders_by_zone": ("uc1_order_volume", rollups.orders_by_zone),
    "dash_orders_over_time": ("uc1_order_volume", rollups.orders_over_time),
    "dash_revenue_by_zone": ("uc11_order_value", rollups.revenue_by_zone),
    "dash_revenue_kpis": ("uc11_order_value", rollups.revenue_kpis),
    "dash_cumulative_revenue": ("uc11_order_value", rollups.cumulative_revenue),
    "dash_supply_latest": ("uc9_supply_demand", rollups.supply_latest),
    "dash_ratio_pivot": ("uc9_supply_demand", rollups.ratio_pivot),
    "dash_supply_last_window": ("uc9_supply_demand", rollups.last_window),
    "dash_prep_by_zone": ("uc10_processing_time", rollups.prep_by_zone),
    "dash_sla_kpis": ("uc3_prep_sla", rollups.sla_kpis),
    "dash_sla_peak_split": ("uc3_prep_sla", rollups.sla_peak_split),
    "dash_sla_over_time": ("uc3_prep_sla", rollups.sla_over_time),
    "dash_weather_summary": ("uc4_weather", rollups.weather_summary),
    "dash_eta_summary": ("uc12_eta_accuracy", rollups.eta_summary),
    "dash_eta_kpis": ("uc12_eta_accuracy", rollups.eta_kpis),
    "dash_eta_pivot": ("uc12_eta_accuracy", rollups.eta_pivot),
    "dash_eta_top10": ("uc12_eta_accuracy", rollups.eta_top),
    "dash_anomaly_kpis": ("uc7_anomalies", rollups.anomaly_kpis),
    "dash_anomaly_by_zone": ("uc7_anomalies", rollups.anomaly_by_zone),
    "dash_anomaly_rate_over_time": ("uc7_anomalies", rollups.anomaly_rate_over_time),
    "dash_productivity_rollup": ("uc13_courier_productivity", rollups.productivity_rollup),
    "dash_productivity_kpis": ("uc13_courier_productivity", rollups.productivity_kpis),
    "dash_productivity_pivot": ("uc13_courier_productivity", rollups.productivity_pivot),
    "dash_productivity_ranked": ("uc13_courier_productivity", rollups.productivity_ranked),
}
