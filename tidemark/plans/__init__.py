"""Plan helpers: joins, ranks, staged tables and versioned state."""

from tidemark.plans.joins import BroadcastLimit, join_checked, measure, salted_join
from tidemark.plans.ranking import running_number
from tidemark.plans.state import StateStore
from tidemark.plans.storage import shared_dir, stage

__all__ = ["BroadcastLimit", "StateStore", "join_checked", "measure", "running_number",
           "salted_join", "shared_dir", "stage"]
