"""Global order without one task: positions, running totals, splits, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.draws import draw
from linkloom.session import materialise

_OFFSET_BITS = 33


def positional_index(
    df: DataFrame, keys: list[str], name: str = "pos", carried: list[str] | None = None
) -> DataFrame:
    """Dense 0-based position of every row in the order of ``keys``.

    Rows are range-partitioned and sorted, numbered inside their partition, and
    written once, since range bounds are sampled anew on every run. Only the
    partition sizes (one row per partition) meet in one task and are broadcast.
    Rows equal in all of ``keys`` get positions in any order. Only the columns ``carried`` are
    written and returned, if given; the keys need not be among them.
    """
    serial = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_serial", serial)
        .withColumn("_chunk", F.shiftright("_serial", _OFFSET_BITS))
        .withColumn("_offset", F.col("_serial").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1)))
        .drop("_serial")
    )
    if carried is not None:
        placed = placed.select(*carried, "_chunk", "_offset")
    placed = materialise(placed, "positions")
    sizes = placed.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_chunk", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    return (
        placed.join(F.broadcast(starts), "_chunk")
        .withColumn(name, F.col("_start") + F.col("_offset"))
        .drop("_chunk", "_offset", "_start")
    )


def running_totals(
    df: DataFrame, group: list[str], order: list[str], values: list[str]
) -> DataFrame:
    """Add ``<value>_before``: the sum over earlier rows of the same group.

    A group may hold any share of the rows: it is cut into range partitions,
    summed inside each, and each piece gets the total of the pieces before it.
    A partition continues at most one group, so the carried totals number at
    most one per partition and can be broadcast. ``order`` is unique in a group.
    """
    placed = materialise(
        df.repartitionByRange(*group, *order).withColumn("_chunk", F.spark_partition_id()),
        "running",
    )
    inside = (
        Window.partitionBy("_chunk", *group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    pieces = placed.groupBy("_chunk", *group).agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    chunks = Window.partitionBy(*group).orderBy("_chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        pieces.withColumn("_nth", F.row_number().over(chunks))
        .select(
            "_chunk",
            *group,
            "_nth",
            *[F.sum(f"_sum_{v}").over(before).alias(f"_carry_{v}") for v in values],
        )
        .filter("_nth > 1")
        .drop("_nth")
    )
    keys = ["_chunk", *group]
    carried = carried.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]  # a null group is a group
    summed = placed.join(F.broadcast(carried), same, "left").drop(*[f"_of_{k}" for k in keys])
    for v in values:
        local = F.coalesce(F.sum(v).over(inside), F.lit(0))
        summed = summed.withColumn(f"{v}_before", local + F.coalesce(f"_carry_{v}", F.lit(0)))
    return summed.drop("_chunk", *[f"_carry_{v}" for v in values])


def split_sizes(n: int, test_p: float, valid_p: float) -> tuple[int, int, int]:
    """(train, valid, test); fractions are truncated and training takes the rest."""
    test, valid = int(test_p * n), int(valid_p * n)
    return n - test - valid, valid, test


def split_edges(
    edges: DataFrame, n: int, test_p: float, valid_p: float, method: str = "position"
) -> DataFrame:
    """Label every edge ``training``, ``validation`` or ``testing`` in input order.

    ``eid`` is the edge's position. ``method="hash"`` draws the split per edge
    instead and then needs neither positions nor a count.
    """
    if method == "hash":
        u = draw(0, F.col("eid"))
        return edges.withColumn("split", _label(u, F.lit(1.0 - test_p - valid_p), F.lit(1.0 - test_p)))
    train, valid, _ = split_sizes(n, test_p, valid_p)
    return edges.withColumn("split", _label(F.col("eid"), F.lit(train), F.lit(train + valid)))


def _label(value: Column, train_end: Column, valid_end: Column) -> Column:
    return (
        F.when(value < train_end, F.lit("training"))
        .when(value < valid_end, F.lit("validation"))
        .otherwise(F.lit("testing"))
    )


def assign_batches(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """Shuffle rows by a draw of ``key`` and cut them into batches; the last may be short."""
    shuffled = df.withColumn("_u", draw(seed, F.col(key)))
    placed = positional_index(shuffled, ["_u", key], "_place", df.columns)
    return placed.withColumn("batch_id", F.floor(F.col("_place") / size)).drop("_place")


def cap_steps(batches: DataFrame, max_steps: int) -> DataFrame:
    """The batches one run consumes: steps 0 to ``max_steps`` of one pass."""
    return batches.filter(F.col("batch_id") <= max_steps)


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows without replacement (halves to even)."""
    shuffled = df.withColumn("_u", draw(seed, F.col(key)))
    placed = positional_index(shuffled, ["_u", key], "_place", df.columns)
    n = placed.count()
    return placed.filter(F.col("_place") < round(fraction * n)).drop("_place")
