"""Feature definitions, point-in-time retrieval and the table of latest values."""

from tillwatch.plans.feature_store.definitions import (
    Entity,
    FeatureService,
    FeatureSource,
    FeatureView,
    Field,
    OnDemandView,
    PushSource,
    RequestSource,
    on_demand,
)
from tillwatch.plans.feature_store.online import LatestTable
from tillwatch.plans.feature_store.store import FeatureStore

__all__ = ["Entity", "FeatureService", "FeatureSource", "FeatureStore", "FeatureView", "Field",
           "LatestTable", "OnDemandView", "PushSource", "RequestSource", "on_demand"]
