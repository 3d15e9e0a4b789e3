"""Size-checked broadcast of dimension-like inputs.

A broadcast hint is only given after the side has been *measured*: a plain
``count()`` (one row per task, Parquet footers where nothing is filtered)
proves the row count is at most ``n``. Larger sides
are left to the planner (sort-merge join, re-planned at runtime by adaptive
execution, which also splits skewed partitions).

Use this for dimension-like inputs (tables or light projections of them).
Tables derived from the fact are not measured this way: measuring would
compute them an extra time. Their joins are left to adaptive execution,
whose runtime statistics are the size check.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstar.session import app_id

_DEFAULT_MAX_ROWS = 500_000
_decisions: dict = {}


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("fleetstar.broadcast.maxRows", None)
    return int(conf) if conf else _DEFAULT_MAX_ROWS


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Decisions are reused for the same plan for ``fleetstar.broadcast.checkTtlSeconds``
    (default 600): a dimension that grows is measured again.
    """
    ttl = float(df.sparkSession.conf.get("fleetstar.broadcast.checkTtlSeconds", None) or 600)
    key = (app_id(df.sparkSession), df.semanticHash(), tuple(df.dtypes), max_rows)
    hit = _decisions.get(key)
    now = time.monotonic()
    if hit is None or now - hit[1] > ttl:
        hit = (df.count() <= max_rows, now)
        _decisions[key] = hit
    return hit[0]


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only when the side's row count is proven small."""
    limit = max_rows or broadcast_limit(df)
    return F.broadcast(df) if fits(df, limit) else df


def join_dim(left: DataFrame, dim: DataFrame, on, how: str = "inner",
             max_rows: int | None = None) -> DataFrame:
    """Join a (projected) dimension to a fact-like side, broadcasting if small."""
    return left.join(bounded_broadcast(dim, max_rows), on=on, how=how)


def aggregate_by_attributes(fact: DataFrame, dim: DataFrame, key: str, attrs: list[str], aggs: dict,
                            extra_keys=(), max_rows: int | None = None) -> DataFrame:
    """GROUP BY dimension attributes (plus fact columns ``extra_keys``).

    ``aggs`` maps output name -> (aggregate over fact rows, merge function for
    partial results, e.g. ``F.sum``). The fact is aggregated by ``key`` first
    (an integer, with partial aggregation) and the much smaller result is
    joined and re-aggregated, so neither raw rows nor long attribute values
    of every row take part in a shuffle.
    """
    exprs = [expr.alias(name) for name, (expr, _) in aggs.items()]
    per = join_dim(fact.groupBy(key, *extra_keys).agg(*exprs), dim.select(key, *attrs), key, max_rows=max_rows)
    return per.groupBy(*attrs, *extra_keys).agg(*[merge(F.col(name)).alias(name)
                                                  for name, (_, merge) in aggs.items()])
