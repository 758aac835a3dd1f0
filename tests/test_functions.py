from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import idiv, lifecycle_bucket, price_move, round_ratio
from shelfcast.functions.labels import LIFECYCLE_BUCKETS, PRICE_MOVES

CASES = [(1, 8, 2), (5, 2, 0), (-5, 2, 0), (1234565, 100000, 4), (2675, 1000, 2), (1, 3, 4), (7, 0, 1), (0, 5, 2),
         (-1, 8, 2), (123456789012345, 7, 3)]


def _expected(n, d, k):
    if d == 0:
        return None
    q = (Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-k), rounding=ROUND_HALF_UP)
    return float(q)


def test_round_ratio_is_exact_half_up(spark):
    df = spark.createDataFrame([(n, d) for n, d, _ in CASES], "n long, d long")
    for (n, d, k) in CASES:
        got = df.where((F.col("n") == n) & (F.col("d") == d)).select(round_ratio(F.col("n"), F.col("d"), k)).first()[0]
        assert got == _expected(n, d, k), (n, d, k, got)


def test_idiv_floor(spark):
    row = spark.range(1).select(idiv(F.lit(7), 2), idiv(F.lit(-7), 2), idiv(F.lit(6), 3)).first()
    assert tuple(row) == (3, -4, 2)


@pytest.mark.parametrize("price,prev,label", [
    (0.89, 1.00, PRICE_MOVES[0]), (0.90, 1.00, PRICE_MOVES[1]), (0.95, 1.00, PRICE_MOVES[1]),
    (1.00, 1.00, PRICE_MOVES[2]), (1.045, 1.00, PRICE_MOVES[3]), (1.10, 1.00, PRICE_MOVES[3]),
    (1.20, 1.00, PRICE_MOVES[4]),
])
def test_price_move_borders(spark, price, prev, label):
    got = spark.createDataFrame([(price, prev)], "p double, q double").select(
        price_move(F.col("p"), F.col("q"))).first()[0]
    assert got == label


def test_lifecycle_null_falls_to_never(spark):
    df = spark.createDataFrame([(1,), (50,), (300,), (800,), (None,), (2000,)], "d int")
    got = [r[0] for r in df.select(lifecycle_bucket(F.col("d"))).collect()]
    assert got == LIFECYCLE_BUCKETS
