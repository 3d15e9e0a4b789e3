from fleetstar.plans.joins import bounded_broadcast, join_dim  # noqa: F401
from fleetstar.plans.ordinal import global_rank  # noqa: F401
from fleetstar.plans.sequence import next_in_sequence, previous_non_null  # noqa: F401
