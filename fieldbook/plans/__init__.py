"""The interpreted views."""

from fieldbook.plans.basic import basic_view
from fieldbook.plans.event import event_view
from fieldbook.plans.location import LocationDims, location_view
from fieldbook.plans.occurrence import interpret, occurrence_view
from fieldbook.plans.session import prepare_session, session_builder
from fieldbook.plans.taxon import taxon_view
from fieldbook.plans.temporal import temporal_view

__all__ = [
    "LocationDims", "basic_view", "event_view", "interpret", "location_view", "occurrence_view",
    "prepare_session", "session_builder", "taxon_view", "temporal_view",
]
