"""Indices below very large numbers reach every remainder, by one formula for all bounds."""

from pyspark.sql import functions as F

from linkloom.functions.draws import draw_index
from linkloom.operators.sampling import choose_slots


def test_large_bounds_are_drawn_finely(spark):
    n = 1 << 40
    ids = spark.range(4000)
    for bound in (n, F.lit(n)):
        drawn = [r[0] for r in ids.select(draw_index(7, bound, F.col("id"))).collect()]
        assert 0 <= min(drawn) and max(drawn) < n and len({d % 256 for d in drawn}) == 256
    slots = [r[0][0] for r in ids.select(choose_slots(F.lit(n), 1, 7, F.col("id"))).collect()]
    assert 0 <= min(slots) and max(slots) < n and len({d % 256 for d in slots}) == 256


def test_one_more_node_changes_few_draws(spark):
    ids = spark.range(4000)
    for n in (1000, 1 << 20, 1 << 21):
        same = draw_index(7, n, F.col("id")) == draw_index(7, n + 1, F.col("id"))
        assert ids.filter(same).count() > 1000
