"""Streams into tables: plain appends, keyed changes, daily refreshes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.latest import top_per_key
from headway.operators.scd import SEEN, scd1, scd2_spliced

BUCKET, BATCH = "bucket_no", "batch_no"


def _start(writer, trigger: str | None) -> StreamingQuery:
    """``trigger`` is an interval such as ``15 minutes``; None takes what is there and ends."""
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def run_stream(
    df: DataFrame, target: str, checkpoint: str, *, trigger: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a parquet table, exactly once.

    With ``partition_by=("gtfs_snapshot_date",)`` the newest snapshot of a
    bronze table is one folder, and ``latest_snapshot`` reads only that.
    """
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer, trigger)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _replace_partitions(df: DataFrame, by: Sequence[str], path: str) -> None:
    """Overwrite the partitions that occur in ``df``; a hot one is written by many tasks."""
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a parquet folder; None where nothing was written yet."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException:
        return None


def merge_batch(
    batch: DataFrame,
    batch_id: int,
    keys: Sequence[str],
    merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    *,
    target: str,
    buckets: int = 64,
) -> None:
    """Merge one micro-batch into the buckets of ``target`` that it touches.

    ``merge`` gets the rows that the touched buckets hold (None at first) and
    those of the batch, and must give the same again if it meets rows twice.
    No history is read.  Its result is written beside the target first, and the
    target's partitions are overwritten from there: a batch that is run again
    either finds the target as it was, or the whole result to write once more.
    """
    spark, keys = batch.sparkSession, list(keys)
    ready, done = f"{target.rstrip('/')}_ready", f"{target.rstrip('/')}_ready_batch"
    finished = _stored(spark, done)
    if finished is None or finished.first()[BATCH] != batch_id:
        known = batch.dropna(subset=keys).withColumn(BUCKET, _bucket(keys, buckets))
        # At most `buckets` numbers come back, whatever the batch holds.
        touched = [row[0] for row in known.select(BUCKET).distinct().collect()]
        if not touched:
            return
        old = _stored(spark, target)
        if old is not None:
            old = old.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = merge(old, known.drop(BUCKET)).withColumn(BUCKET, _bucket(keys, buckets))
        merged.write.mode("overwrite").parquet(ready)
        spark.createDataFrame([(batch_id,)], f"{BATCH} BIGINT").coalesce(1).write.mode("overwrite").parquet(done)
    _replace_partitions(spark.read.parquet(ready), [BUCKET], target)


def merge_stream(
    changes: DataFrame,
    keys: Sequence[str],
    merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    *,
    checkpoint: str,
    trigger: str | None = None,
    **places,
) -> StreamingQuery:
    """Keep a target equal to what ``merge`` makes of all changes seen so far, by ``merge_batch``."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, keys, merge, **places)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _start(writer, trigger)


def _both(old: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if old is None else old.unionByName(new, allowMissingColumns=True)


def scd1_stream(
    changes: DataFrame, keys: Sequence[str], sequence: str, *, tie_break: Sequence[str] = (), **kw
) -> StreamingQuery:
    """Current row per key; the sequence column stays in the table.

    A batch meets the current rows only, so a late change loses to a newer one
    without any history.
    """
    return merge_stream(
        changes, keys, lambda old, new: scd1(_both(old, new), keys, sequence, tie_break=tie_break), **kw
    )


def scd2_stream(
    changes: DataFrame, keys: Sequence[str], sequence: str, *, drop: Sequence[str] = (), **kw
) -> StreamingQuery:
    """Version history per key; a batch is spliced into the versions that it meets."""
    return merge_stream(
        changes, keys, lambda old, new: scd2_spliced(old, new, keys, sequence, drop=drop), **kw
    )


def upsert_stream(
    rows: DataFrame, keys: Sequence[str], touched_at: str, **kw
) -> StreamingQuery:
    """Newest touch per key, as ``operators.scd.upsert_by_key`` keeps it for two batches."""
    return merge_stream(
        rows, keys, lambda old, new: top_per_key(_both(old, new), keys, [F.desc_nulls_last(touched_at)]), **kw
    )


def read_merged(spark: SparkSession, target: str) -> DataFrame:
    """The table as the batches so far have left it."""
    rows = _stored(spark, target)
    if rows is None:
        raise ValueError(f"no batch was merged into {target} yet")
    return rows.drop(BUCKET, SEEN)


def refresh_days(
    readings: DataFrame,
    days: DataFrame,
    summarize: Callable[[DataFrame], DataFrame],
    target: str,
    *,
    day: str = "poll_date",
    result_day: str = "report_date",
) -> None:
    """Recompute a daily summary for the given days only.

    A day whose readings are gone loses its partition: it is overwritten by no
    rows, through the rows of the other days that are written with it.
    """
    asked = days.select(F.col(day).cast("string").alias("asked")).distinct()
    touched = readings.join(asked, F.col(day).cast("string") == F.col("asked"), "left_semi")
    _replace_partitions(summarize(touched), [result_day], target)
    _drop_empty_days(readings.sparkSession, asked, touched.select(F.col(day).cast("string").alias("asked")), target, result_day)


def _drop_empty_days(
    spark: SparkSession, asked: DataFrame, full: DataFrame, target: str, result_day: str
) -> None:
    """Delete the partitions of asked days without rows; one name per day comes to the driver."""
    empty = [d for (d,) in asked.join(full.distinct(), "asked", "left_anti").collect()]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in empty:
        path = hadoop(f"{target}/{result_day}={name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
