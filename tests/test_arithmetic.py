"""Exact rounding helpers against Python's Decimal (HALF_UP) on many cases."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from fleetstar.functions.exprs import cents, exact_pct, mean_from_cents


def _half_up(x: Decimal, places: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def test_rates_and_means_match_decimal(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        n = rnd.randint(1, 10**6)
        k = rnd.randint(0, n)
        total = rnd.randint(-10**9, 10**9)
        rows.append((k, n, total))
    rows += [(1, 8, 1), (1, 16, 5), (5, 8, -5), (3, 2000, 1), (1, 3, 200)]   # exact .5 boundaries
    df = spark.createDataFrame(rows, "k long, n long, total long")
    got = df.select("k", "n", "total",
                    exact_pct(F.col("k"), F.col("n")).alias("pct2"),
                    exact_pct(F.col("k"), F.col("n"), 1).alias("pct1"),
                    F.round(mean_from_cents(F.col("total"), F.col("n")), 2).alias("mean2"),
                    F.round(mean_from_cents(F.col("total"), F.col("n")), 6).alias("mean6")).collect()
    for r in got:
        assert r.pct2 == _half_up(Decimal(100 * r.k) / Decimal(r.n), 2), r
        assert r.pct1 == _half_up(Decimal(100 * r.k) / Decimal(r.n), 1), r
        exact_mean = Decimal(r.total) / Decimal(100 * r.n)
        assert r.mean2 == _half_up(exact_mean, 2), r
        assert r.mean6 == _half_up(exact_mean, 6), r


def test_cents_of_two_decimal_values(spark):
    rnd = random.Random(11)
    values = [Decimal(rnd.randint(-10**9, 10**9)).scaleb(-2) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x decimal(12,2)")
    got = [r.c for r in df.select(cents(F.col("x")).alias("c")).collect()]
    assert got == [int(v * 100) for v in values]
