from fleetstar.functions.exprs import (  # noqa: F401
    calendar_columns, cents, count_true, date_key, exact_pct, mean_from_cents, sum_cents,
)
