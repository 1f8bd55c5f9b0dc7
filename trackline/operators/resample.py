"""Bring trips onto a regular time grid and fill what lies between known points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.operators import slices
from trackline.operators.tracks import ORDER, TRIP

VALUES = ("lon", "lat", "alt")
BLOCK = 4096  # ticks per generated array


def time_bucket(
    points: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    order: Sequence[str] = ORDER,
    values: Sequence[str] = VALUES,
    step: float = 1000,
    out: str = "tick",
) -> DataFrame:
    """Snap each point to the nearest tick and keep the earliest known value of each column per tick.

    Points without a key or a time are left out. A value that no point of the tick has is null.
    """
    ticks = points.na.drop(subset=[*keys, order[0]]).withColumn(
        out, F.round(F.col(order[0]) / step).cast("bigint")
    )
    at = F.struct(*order)
    first = [F.min_by(v, F.when(F.col(v).isNotNull(), at)).alias(v) for v in values]
    return ticks.groupBy(*keys, out).agg(*first).select(*keys, out, *values)


def ticks_between(first: Column, last: Column, step: int = 1) -> list[Column]:
    """Two nested generators for the ticks from ``first`` to ``last``.

    The outer one makes block starts, so a trip with one wild time stamp does not build an
    array over all the ticks up to it.
    """
    outer = F.sequence(first, last, F.lit(step * BLOCK).cast("bigint"))
    end = F.least(last, F.col("_block") + step * (BLOCK - 1))
    return [F.explode(outer), F.explode(F.sequence("_block", end, F.lit(step).cast("bigint")))]


def time_grid(
    points: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    t: str = "tick",
    step: int = 1,
    out: str = "tick",
) -> DataFrame:
    """Every tick from a trip's first to its last time, both ends included."""
    extent = points.groupBy(*keys).agg(
        F.min(t).cast("bigint").alias("_first"), F.max(t).cast("bigint").alias("_last")
    )
    blocks, ticks = ticks_between(F.col("_first"), F.col("_last"), step)
    return _spread(extent.withColumn("_block", blocks), keys).select(*keys, ticks.alias(out))


def _spread(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deal blocks out before their ticks are made, as one trip may have very many.

    Few bytes mean many ticks here, so the number of tasks must not follow the bytes.
    """
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(tasks, *keys, "_block")


def grid_join(
    points: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    tick: str = "tick",
    values: Sequence[str] = VALUES,
    hot: DataFrame | None = None,
) -> DataFrame:
    """The points on their grid: one row per tick, ``known`` is the tick where there is a point."""
    filled = fill_gaps(points, keys=keys, tick=tick, values=values, hot=hot)
    return filled.select(*keys, tick, "known", *values)


def fill_gaps(
    points: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    tick: str = "tick",
    values: Sequence[str] = VALUES,
    hot: DataFrame | None = None,
) -> DataFrame:
    """The points on their grid, with the last and next known tick and values as ``prev_*`` and ``next_*``.

    Each point makes the ticks up to the next point and tells them what it knows, so that only the
    points are shuffled and sorted, not the grid. A value that a point lacks comes from the nearest
    point that has it. Points have different ticks within a trip (``time_bucket``).
    """
    columns = ["known", *values]

    def compute(rows: DataFrame, slice_col: str | None) -> DataFrame:
        for name, forward in (("prev", True), ("next", False)):
            wanted = {f"{name}_{c}": c for c in columns}
            rows = slices.nearest_known(
                rows, keys, [tick], wanted, forward=forward, slice_col=slice_col
            )
        ahead = {"_until": (tick, 1), **{f"_after_{c}": (f"next_{c}", 1) for c in columns}}
        return slices.neighbours(rows, keys, [tick], ahead, slice_col)

    hot = slices.hot_keys(points, keys, tick) if hot is None else hot
    known = points.select(*keys, tick, *values).withColumn("known", F.col(tick))
    linked = slices.per_key(known, tick, hot, compute)
    blocks, ticks = ticks_between(F.col(tick), F.coalesce(F.col("_until") - 1, F.col(tick)))
    own = F.col("_tick") == F.col(tick)
    return (
        _spread(linked.withColumn("_block", blocks), keys)
        .withColumn("_tick", ticks)
        .select(
            *keys,
            F.col("_tick").alias(tick),
            *[F.when(own, F.col(c)).alias(c) for c in columns],
            *[f"prev_{c}" for c in columns],
            *[
                F.when(own, F.col(f"next_{c}")).otherwise(F.col(f"_after_{c}")).alias(f"next_{c}")
                for c in columns
            ],
        )
    )


def between(x: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """Value at x on the line through two known points."""
    return F.when(x0 == x1, y0).otherwise(y0 + (y1 - y0) / F.nullif(x1 - x0, F.lit(0)) * (x - x0))


def interpolate(
    points: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    tick: str = "tick",
    values: Sequence[str] = VALUES,
    carry: Sequence[str] = (),
    within: tuple[int, int] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """One row per tick of each trip, known values kept, the others on straight lines.

    Each point generates the ticks up to the next point itself. The rows equal those of
    grid, join and fill, but only the points are shuffled and sorted, not the grid. A value
    that a point lacks is null between it and its neighbours. ``carry`` names columns that are
    the same for a whole trip. ``within`` asks for the ticks from the first to the last number
    only; others are not made.
    """

    def compute(rows: DataFrame, slice_col: str | None) -> DataFrame:
        ahead = {f"_next_{c}": (c, 1) for c in (tick, *values)}
        return slices.neighbours(rows, keys, [tick], ahead, slice_col)

    hot = slices.hot_keys(points, keys, tick) if hot is None else hot
    pairs = slices.per_key(points.select(*keys, tick, *values, *carry), tick, hot, compute)
    begin, until = F.col(tick), F.coalesce(F.col(f"_next_{tick}") - 1, F.col(tick))
    if within is not None:
        begin, until = F.greatest(begin, F.lit(within[0])), F.least(until, F.lit(within[1]))
        pairs = pairs.filter(begin <= until)
    blocks, ticks = ticks_between(begin, until)
    x0, x1 = F.col(tick), F.col(f"_next_{tick}")
    line = {
        c: F.when(F.col("_tick") == x0, F.col(c)).otherwise(
            between(F.col("_tick"), x0, x1, F.col(c), F.col(f"_next_{c}"))
        )
        for c in values
    }
    named = [v.alias(c) for c, v in line.items()]
    return (
        _spread(pairs.withColumn("_block", blocks), keys)
        .withColumn("_tick", ticks)
        .select(*keys, F.col("_tick").alias(tick), *named, *carry)
    )


def resampled_labelled(
    ticks: DataFrame,
    airlines: DataFrame,
    types: DataFrame,
    *,
    entity: str = "entity",
    airline: str = "airline",
    keys: Sequence[str] = TRIP,
    values: Sequence[str] = VALUES,
    step: int = 1000,
    decimals: int = 4,
    at: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Resampled points of the trips whose airline and type are known, ready to export.

    ``ticks`` are the points after ``time_bucket``; ``airlines`` has one row per entity and
    ``types`` one per airline. The points get their labels before the grid is made, so the grid
    is not joined. ``at`` asks for the points of one whole second only.
    """
    labels = airlines.join(types, airline)
    carry = [c for c in labels.columns if c != entity]
    within = None if at is None else (-(-at // step), -(-(at + 1) // step) - 1)
    return (
        interpolate(
            ticks.join(labels, entity), keys=keys, values=values, carry=carry, within=within, hot=hot
        )
        .withColumns({c: F.round(c, decimals) for c in values})
        .withColumn("t", F.col("tick") * step)
        .drop("tick")
    )
