"""Slowly changing dimensions, keyed upserts and expiry, as batch operators.

Inputs are full change histories; rows may come in any order and repeated
deliveries of the same (key, sequence) count once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.operators.latest import top_per_key

START, END = "__START_AT", "__END_AT"
# Sequences at which a version was delivered, in a table that later changes are spliced into.
SEEN = "__SEEN_AT"


def _newest_first(columns: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(c) for c in columns]


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    *,
    drop: Sequence[str] = (),
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Current row per key: the one with the highest sequence.

    Pass the sequence column in ``drop`` to hide it from the result; keep it in
    a table that later batches are merged into.
    """
    known = changes.dropna(subset=list(keys))
    return top_per_key(known, keys, _newest_first([sequence, *tie_break])).drop(*drop)


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    *,
    drop: Sequence[str] = (),
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Version history per key.

    A new version starts where a tracked column differs from the row before;
    ``__END_AT`` is the start of the next version, NULL for the current one.
    Tracked are all columns but the keys, the sequence and those in ``drop``.
    After one row per (key, sequence) is kept, a group holds at most as many
    rows as there are snapshots, whatever the number of deliveries.
    """
    keys = list(keys)
    hidden = {*keys, sequence, *drop}
    tracked = [c for c in changes.columns if c not in hidden]
    order = [F.desc_nulls_last(c) for c in (*tie_break, *tracked)]
    once = top_per_key(
        changes.dropna(subset=[*keys, sequence]), [*keys, sequence], order
    )
    timeline = Window.partitionBy(*keys).orderBy(sequence)
    state = F.struct(*tracked)
    before = F.lag(state).over(timeline)
    is_first = F.row_number().over(timeline) == 1
    versions = once.withColumn("__changed", is_first | ~state.eqNullSafe(before)).filter(
        "__changed"
    )
    return versions.select(
        *keys,
        *tracked,
        F.col(sequence).alias(START),
        F.lead(sequence).over(timeline).alias(END),
    )


def scd2_spliced(
    versions: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    *,
    drop: Sequence[str] = (),
) -> DataFrame:
    """The versions of ``scd2`` with further changes spliced in, late and repeated ones too.

    ``versions`` is a former result (None at first); its column ``__SEEN_AT``
    holds the sequences at which a version was delivered, so the changes
    themselves are not needed again.  A change falls into the version that held
    at its sequence.  That version and its neighbours are laid out by the
    sequences they were seen at, and compared with the change anew; all others
    stay single rows.  Keys without a change keep their rows.
    """
    keys = list(keys)
    hidden = {*keys, sequence, *drop}
    tracked = [c for c in changes.columns if c not in hidden]
    seen = F.array(F.col(sequence))
    new = changes.dropna(subset=[*keys, sequence]).select(
        *keys, *tracked, F.col(sequence).alias(START), seen.alias(SEEN), F.lit(True).alias("__new")
    )
    rest = None
    if versions is None:
        laid = new
    else:
        touched = new.select(*keys).distinct()
        rest = versions.join(touched, keys, "left_anti")
        mine = versions.join(touched, keys, "left_semi")
        known = mine.select(*keys, *tracked, START, SEEN, F.lit(False).alias("__new"))
        # A version stands before the changes of its first sequence; those before the next version fall into it.
        timeline = Window.partitionBy(*keys).orderBy(START, "__new")
        so_far = F.count(F.when(F.col("__new"), 1)).over(timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        every = F.count(F.when(F.col("__new"), 1)).over(Window.partitionBy(*keys))
        counted = known.unionByName(new).withColumns({"__before": so_far, "__all": every}).filter(~F.col("__new"))
        line = Window.partitionBy(*keys).orderBy(START)
        inside = F.coalesce(F.lead("__before").over(line), F.col("__all")) > F.col("__before")
        first = F.row_number().over(line) == 1
        met = counted.withColumn("__hit", inside | (first & (F.col("__before") > 0)))
        near = F.col("__hit") | F.coalesce(F.lag("__hit").over(line), F.lit(False)) | F.coalesce(F.lead("__hit").over(line), F.lit(False))
        marked = met.withColumn("__near", near)
        open_ = marked.filter("__near").withColumn(START, F.explode(SEEN)).withColumn(SEEN, F.array(START))
        laid = (
            marked.filter("NOT __near").select(*new.columns)
            .unionByName(open_.select(*new.columns)).unionByName(new)
        )
    once = top_per_key(laid, [*keys, START], [F.desc_nulls_last(c) for c in tracked])
    timeline = Window.partitionBy(*keys).orderBy(START)
    state = F.struct(*tracked)
    changed = (F.row_number().over(timeline) == 1) | ~state.eqNullSafe(F.lag(state).over(timeline))
    numbered = once.withColumn("__changed", changed).withColumn("__version", F.sum(F.col("__changed").cast("int")).over(timeline))
    found = numbered.groupBy(*keys, "__version").agg(
        *[F.min_by(c, START).alias(c) for c in tracked],
        F.min(START).alias("__start"), F.sort_array(F.flatten(F.collect_list(SEEN))).alias(SEEN),
    ).withColumnRenamed("__start", START)
    spliced = found.withColumn(END, F.lead(START).over(timeline)).select(*keys, *tracked, START, END, SEEN)
    return spliced if rest is None else spliced.unionByName(rest.select(*spliced.columns))


def current_versions(history: DataFrame) -> DataFrame:
    """Open versions of an ``scd2`` history."""
    return history.filter(F.col(END).isNull()).drop(START, END)


def versions_at(
    rows: DataFrame, history: DataFrame, keys: Sequence[str], at: str, *, bucket: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Rows with the tracked columns of the version of their key that held at ``at``.

    ``history`` is an ``scd2`` result. Rows before the first version, or
    without a key, keep nulls. A version is copied to every bucket (by default
    year) that it holds in, up to the one in which the last version begins, and
    met there by an equi-join; so a key with a long history and many rows is no
    square, and a hot key's rows can be split. Later rows look into that last
    bucket, so the bound comes from the history and ``rows`` are read once. At
    most one version holds at a time, so no row is multiplied.
    """
    year = bucket or (lambda c: F.year(c.cast("date")))
    last = history.agg(F.max(year(F.col(START)))).scalar()
    tracked = [c for c in history.columns if c not in (*keys, START, END, SEEN)]
    ends = F.least(F.coalesce(year(F.col(END)), last), last)
    begins = year(F.col(START))
    held = history.filter(begins <= ends).select(
        *[F.col(c).alias(f"__key_{n}") for n, c in enumerate(keys)], *tracked,
        F.col(START).alias("__from"), F.col(END).alias("__to"), F.explode(F.sequence(begins, ends)).alias("__bucket"),
    )
    moment = F.col(at)
    met = reduce(and_, [F.col(c) == F.col(f"__key_{n}") for n, c in enumerate(keys)])
    holds = (F.col("__from") <= moment) & (F.col("__to").isNull() | (moment < F.col("__to")))
    # A row without a date stays without a bucket.
    asked = F.when(year(moment) > last, last).otherwise(year(moment))
    joined = rows.join(held, met & (asked == F.col("__bucket")) & holds, "left")
    return joined.drop(*[f"__key_{n}" for n in range(len(keys))], "__from", "__to", "__bucket")


def upsert_by_key(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], touched_at: str
) -> DataFrame:
    """One row per key of both tables: the newest touch, and of equal ones that of ``batch``.

    A late batch row does not replace a newer one, so the order in which
    batches arrive does not matter.
    """
    both = existing.withColumn("__new", F.lit(0)).unionByName(
        batch.withColumn("__new", F.lit(1)), allowMissingColumns=True
    )
    return top_per_key(both, keys, _newest_first([touched_at, "__new"])).drop("__new")


def expire(
    rows: DataFrame, touched_at: str, now: Column, ttl: str = "24 hours"
) -> DataFrame:
    """Rows touched within ``ttl`` before ``now``."""
    return rows.filter(F.col(touched_at) >= now - F.expr(f"INTERVAL '{ttl}'"))


def append_existing(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new, allowMissingColumns=True)
