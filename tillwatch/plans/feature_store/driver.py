"""The driver feature definitions: four views, four on-demand views, four services."""

from __future__ import annotations

from datetime import timedelta

from tillwatch.functions import on_demand as OD
from tillwatch.plans.feature_store.definitions import (
    Entity,
    FeatureService,
    FeatureSource,
    FeatureView,
    Field,
    OnDemandView,
    PushSource,
    RequestSource,
)

# The names, types, tags, times to live and weights below are what callers ask for.
ONE_DAY = timedelta(days=1)


def driver_definitions(stats: FeatureSource, log_path: str | None = None) -> list:
    """All definitions over one table of driver statistics."""
    driver = Entity("driver", ("driver_id",))
    pushed = PushSource("driver_stats_push_source", stats)
    conv, acc = Field("conv_rate", "Float32"), Field("acc_rate", "Float32")
    trips = Field("avg_daily_trips", "Int64", "average trips per day")
    performance, activity = {"team": "driver_performance"}, {"team": "driver_activity"}

    hourly = FeatureView("driver_hourly_stats", (driver,), (conv, acc, trips), stats, ONE_DAY, tags=performance)
    fresh = FeatureView("driver_hourly_stats_fresh", (driver,), (conv, acc, trips), pushed, ONE_DAY,
                        tags=performance)
    quality = FeatureView("driver_quality_fv", (driver,), (conv, acc), stats, ONE_DAY, tags=performance)
    active = FeatureView("driver_activity_fv", (driver,), (trips,), stats, ONE_DAY, tags=activity)

    request = RequestSource("vals_to_add", (Field("val_to_add", "Int64"), Field("val_to_add_2", "Int64")))
    sums = {"conv_rate_plus_val1": OD.conversion_plus("val_to_add"),
            "conv_rate_plus_val2": OD.conversion_plus("val_to_add_2")}
    sum_fields = tuple(Field(name, "Float64") for name in sums)
    transformed = OnDemandView("transformed_conv_rate", (hourly, request), sum_fields, sums)
    transformed_fresh = OnDemandView("transformed_conv_rate_fresh", (fresh, request), sum_fields, sums)
    realtime = OnDemandView(
        "driver_realtime_metrics", (quality, active),
        (Field("acceptance_gap", "Float64"), Field("realtime_efficiency", "Float64")),
        {"acceptance_gap": OD.acceptance_gap, "realtime_efficiency": OD.realtime_efficiency})
    rated = OnDemandView(
        "driver_performance_metrics", (hourly,),
        (Field("combined_rating", "Float64"), Field("performance_score", "Float64")),
        {"combined_rating": OD.combined_rating, "performance_score": OD.performance_score})

    return [hourly, fresh, quality, active, transformed, transformed_fresh, realtime, rated, pushed,
            FeatureService("driver_activity_v1", (hourly[["conv_rate"]], transformed), log_path),
            FeatureService("driver_activity_v2", (hourly, transformed)),
            FeatureService("driver_activity_v3", (fresh, transformed_fresh)),
            FeatureService("driver_activity_v4", (hourly, rated))]
