"""The band join against all pairs."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tessitura.llm import band_join

LOW = -(1 << 63)


def brute(points, centres, k=5):
    out = []
    for item, p in centres:
        pairs = []
        for sale, line, other, u in points if item is not None and p is not None else []:
            if None not in (sale, other, u) and other != item and abs(u - p) <= max(10, 2 * p // 1000):
                pairs.append((abs(u - p), u, sale, LOW if line is None else line, other, zlib.crc32(f"{sale},{'' if line is None else line},{other}".encode())))
        pairs.sort()
        sums = (len(pairs), sum(x[0] for x in pairs), sum(x[5] for x in pairs))
        out += [(item, r, *x[:3], None if x[3] == LOW else x[3], x[4], *sums) for r, x in enumerate(pairs[:k], 1)] or [(item, 0, *(None,) * 5, *sums)]
    return sorted(out, key=repr)


def tables(spark, points, centres):
    a = spark.createDataFrame([(*r, 1, "x") for r in points], "sale_id long, line_no int, item_id long, u long, p long, part string")
    return a, spark.createDataFrame([(*r, 2, "y") for r in centres], "item_id long, p long, u long, near string")


@pytest.mark.parametrize("parts, fan", [(1, 256), (7, 2), (23, 3)])
def test_against_all_pairs(spark, parts, fan):
    """One item holds a third of the points, one value another third; nulls, repeats, negative values, own runs."""
    rng = random.Random(parts)
    value = lambda: rng.choice([500, 500, 500, 501, rng.randrange(-30, 1200), rng.randrange(20_000, 20_300)])
    points = [(rng.randrange(40), rng.choice([None, 1, 2, 3]), rng.choice([7, 7, 7, 7, 7, *range(12)]), value()) for _ in range(900)]
    points += [(5, 1, 7, 600 + i) for i in range(60)] + [(None, 1, 1, 500), (1, 1, None, 500), (1, 1, 1, None), *points[:20]]
    centres = [(i, rng.choice([500, 500, rng.randrange(-20, 1200), rng.randrange(20_000, 20_300), 9999])) for i in range(60)]
    centres += [(7, 505), (7, 620), (3, None), (None, 500), (3, 500), (3, 500)]
    got = band_join.band_join(*tables(spark, points, centres), parts=parts, fan=fan)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(points, centres)


def test_empty_tables(spark):
    points, centres = tables(spark, [(1, 1, 1, 100)], [(2, 105)])
    assert [tuple(r) for r in band_join.band_join(points.limit(0), centres).collect()] == [(2, 0, None, None, None, None, None, 0, 0, 0)]
    assert band_join.band_join(points, centres.limit(0)).count() == 0
    assert band_join.band_join(points, centres).first()["gap"] == 5


def test_cents(spark):
    rows = [(2.0, 3), (-1.0, -2), (1.005, 0), (float("nan"), 1), (float("inf"), 1), (None, 1), (1.0, None), (-0.07, 2), (0.07, 2)]
    got = spark.createDataFrame(rows, "a double, q int").select(band_join.cents(F.col("a")).alias("c"), band_join.unit_cents(band_join.cents(F.col("a")), F.col("q")).alias("u")).collect()
    assert [r["u"] for r in got] == [67, 50, None, None, None, None, None, (2 * -7 + 2) // 4, 4]
    assert [r["c"] for r in got] == [200, -100, 100, None, None, None, 100, -7, 7]


def test_one_item_fills_no_heap():
    """A long run of one item's points is refused at the newest heap and costs the older ones nothing."""
    sweep = band_join.Sweep(2)
    for p in range(50):
        sweep.price((0, p, 0, 0, 0))
    for u in range(100, 140):
        sweep.point((u, 1, 1, 9))
    sweep.point((140, 1, 1, 8))
    assert all([x[3] for x in a.high] == [9, 9, 8] for a in sweep.active)
    assert band_join.first_places([(u, 0, 0, 9) for u in range(20)] + [(30, 0, 0, 8)], 2) == [(0, 0, 0, 9), (1, 0, 0, 9), (30, 0, 0, 8)]
