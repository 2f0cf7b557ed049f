"""Helpers of the operators: tables, the shared folder, Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from inspect import isgeneratorfunction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from headway.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where a session on a local master names none, as in tests, a temporary folder is made and put
    into the setting. On a cluster executors would not see it, so there it must be named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            folder = known.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            folder = tempfile.mkdtemp(prefix="headway-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batches: Iterable[pa.RecordBatch], column: str, limit: int, most: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a column holds about `limit` bytes and `most` rows, or a single row; empty ones go."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = min(most, max(1, int(rows * limit / max(1, batch.column(column).nbytes))))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of batches that are sorted by integer keys, one table after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for own in columns:
            change[1:] |= own[1:] != own[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(own[a] for own in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def release() -> None:
    """Give freed memory back to the machine: idle Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def tidy(work: Callable) -> Callable:
    """A function for mapInArrow or applyInArrow that releases memory when it is done."""
    if isgeneratorfunction(work):

        @wraps(work)
        def stream(batches):
            try:
                yield from work(batches)
            finally:
                release()

        return stream

    if work.__code__.co_argcount == 1:

        @wraps(work)
        def group(table):
            try:
                return work(table)
            finally:
                release()

        return group

    @wraps(work)
    def cogroup(left, right):
        try:
            return work(left, right)
        finally:
            release()

    return cogroup
