"""Positions, neighbours and samples inside ordered groups of any size.

A plain window sends a whole group to one task.  Here every group is cut into
blocks of consecutive order values and the window runs per block; the little
that crosses a block border (row counts, first rows) is pre-aggregated and
handled apart.  A group that holds a third of all rows is spread like any
other, and the results equal those of the plain window.

``keys`` must not be NULL and ``(keys, order)`` must be unique.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.labels import DEFAULT_ROUTE_NAME

# Longest run of order values handled by one window group.
BLOCK_WIDTH = 4096

_BLOCK = "__block"
_GHOST = "__ghost"


def _block(order: str, width: int) -> Column:
    """Block number; values below zero join the first block."""
    return F.greatest(F.floor(F.col(order) / width), F.lit(0)).cast("long")


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    major: Sequence[str] = (),
    position: str = "position",
    size: str | None = None,
    groups: str | None = None,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Add the 0-based place of every row in its group, the group size and the
    number of groups.

    Rows are ordered by ``major`` columns first, then by the integer column
    ``order``.  Blocks follow both.  Groups are counted by their first blocks,
    so the rows need not be gone through again.
    """
    keys, major = list(keys), list(major)
    tags = [*major, _BLOCK]
    cut = df.withColumn(_BLOCK, _block(order, width))
    counts = cut.groupBy(*keys, *tags).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*keys).orderBy(*tags).rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counts.select(
        *keys,
        *tags,
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
        F.sum("__rows").over(Window.partitionBy(*keys)).alias("__size"),
    )
    inside = Window.partitionBy(*keys, *tags).orderBy(order)
    placed = cut.withColumn("__place", F.row_number().over(inside)).join(
        starts, [*keys, *tags], "inner"
    )
    extra = [] if size is None else [F.col("__size").alias(size)]
    if groups is not None:
        firsts = starts.agg(F.count_if(F.col("__start") == 0).alias("groups"))
        extra.append(firsts.scalar().alias(groups))
    return placed.select(
        *df.columns, (F.col("__start") + F.col("__place") - 1).alias(position), *extra
    )


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Mapping[str, str],
    *,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Add, under new names, values of the following row of the same group.

    ``values`` maps new column names to source columns.  The first row of every
    later block is copied to the end of the block before it, where it serves as
    the successor of that block's last row and is then dropped.  Only rows past
    the first block are looked at for that; the filter reaches the scan, so
    ordinary groups pay nothing.
    """
    keys = list(keys)
    sources = list(dict.fromkeys([order, *values.values()]))
    first = (
        df.filter(F.col(order) >= width)
        .groupBy(*keys, _block(order, width).alias("__own"))
        .agg(F.min_by(F.struct(*sources), F.col(order)).alias("__head"))
    )
    by_block = Window.partitionBy(*keys).orderBy("__own")
    ghosts = first.select(
        *keys,
        *[F.col("__head")[c].alias(c) for c in sources if c not in keys],
        F.coalesce(F.lag("__own").over(by_block), F.lit(0)).cast("long").alias(_BLOCK),
        F.lit(True).alias(_GHOST),
    )
    rows = df.withColumns({_BLOCK: _block(order, width), _GHOST: F.lit(False)})
    window = Window.partitionBy(*keys, _BLOCK).orderBy(order)
    return (
        rows.unionByName(ghosts, allowMissingColumns=True)
        .withColumns({new: F.lead(old).over(window) for new, old in values.items()})
        .filter(~F.col(_GHOST))
        .drop(_BLOCK, _GHOST)
    )


def sample_every_nth(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    n: int | Column = 10,
    *,
    position: str = "position",
) -> DataFrame:
    """Rows 1, n+1, 2n+1, ... of every group; ``n`` may be a column expression
    over ``position`` and ``group_size``."""
    step = F.lit(n) if isinstance(n, int) else n
    placed = with_position(df, keys, order, position=position, size="group_size")
    return placed.filter(F.col(position) % step == 0)


def consecutive_pairs(
    df: DataFrame, keys: Sequence[str], index: str, lat: str, lon: str
) -> DataFrame:
    """Each row with the coordinates of the row numbered one higher.

    Every row is sent to two pairs, as the start of its own and as the end of
    the one before, so pairs meet by key and number without any window; rows
    without a successor fall out.
    """
    sides = df.withColumn("__end", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "__pair", F.col(index) - F.col("__end")
    )
    starts, ends = F.col("__end") == 0, F.col("__end") == 1
    rest = [c for c in df.columns if c not in keys]
    return (
        sides.groupBy(*keys, "__pair")
        .agg(
            *[F.max(F.when(starts, F.col(c))).alias(c) for c in rest],
            F.max(F.when(ends, F.col(lat))).alias("next_lat"),
            F.max(F.when(ends, F.col(lon))).alias("next_lon"),
        )
        .filter(F.col(index).isNotNull() & F.col("next_lat").isNotNull())
        .drop("__pair")
    )


def stratified_sample(
    df: DataFrame,
    group: str,
    order: str,
    *,
    major: Sequence[str] = (),
    cap: int = 200,
) -> DataFrame:
    """About ``cap`` rows spread evenly over all groups and along each group.

    Every group gives ``max(1, cap // groups)`` rows at a constant stride, so
    with more groups than ``cap`` each still gives one.  Rows without a group
    form the group ``unknown``.
    """
    known = df.withColumn(group, F.coalesce(F.col(group), F.lit(DEFAULT_ROUTE_NAME)))
    placed = with_position(
        known, [group], order, major=major, size="group_size", groups="groups"
    )
    share = F.greatest(F.lit(1), F.floor(F.lit(cap) / F.col("groups")))
    stride = F.greatest(
        F.lit(1), F.floor(F.col("group_size") / F.least(share, F.col("group_size")))
    )
    chosen = placed.filter(
        (F.col("position") % stride == 0) & (F.col("position") < stride * share)
    )
    return chosen.drop("position", "group_size", "groups")


def strided_pick(
    df: DataFrame, keys: Sequence[str], order: str, k: int, *, major: Sequence[str] = ()
) -> DataFrame:
    """``k`` rows of every group at places ``int(i * n / k)``, or all if fewer.

    Adds ``pick``, the 0-based number of the chosen row.
    """
    placed = with_position(df, keys, order, major=major, size="group_size")
    return picked_places(placed, F.col("group_size"), k)


def picked_places(placed: DataFrame, rows: Column, k: int) -> DataFrame:
    """The rows of ``strided_pick`` among rows that carry position and group_size.

    ``rows`` says over how many of a group's first rows the ``k`` picks are spread.
    """
    place = F.col("position")
    # The only i whose place can be this row's: the smallest i with i * n / k >= place.
    i = F.ceil(place * k / rows)
    hit = (i < k) & (F.floor(i * rows / k) == place)
    small = (rows <= k) & (place < k)
    return (
        placed.filter(small | hit)
        .withColumn("pick", F.when(small, place).otherwise(i).cast("long"))
        .drop("position", "group_size")
    )
