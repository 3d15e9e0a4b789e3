from fleetstar.sources.profiles import Star, event_star, orderline_star, routing_table  # noqa: F401
