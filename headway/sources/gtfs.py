"""GTFS snapshots: ``<root>/<yyyy-MM-dd>/<table>.txt`` as batch tables and streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions.labels import snapshot_from_path
from headway.schemas import GTFS_COLUMNS, ddl

FEED_DATE = "feed_date"


def _typed(df: DataFrame, table: str) -> list[Column]:
    """Declared columns by name; those a feed leaves out are NULL."""
    present = set(df.columns)
    return [
        (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in ddl(GTFS_COLUMNS[table]).fields
    ]


def read_gtfs(spark: SparkSession, root: str, table: str, feed_date: str) -> DataFrame:
    """One table of one snapshot, typed, with its date.

    Columns are matched by header name and not by place, because feeds order
    them freely; only the header line is looked at before the job runs.
    """
    raw = spark.read.option("header", True).csv(f"{root}/{feed_date}/{table}.txt")
    return raw.select(*_typed(raw, table), F.lit(feed_date).alias(FEED_DATE))


def with_file_metadata(df: DataFrame, *, arrival: bool = False) -> DataFrame:
    """Name of the source file, with its snapshot date or its arrival time."""
    file = F.col("_metadata")
    if arrival:
        return df.select(
            "*", file["file_name"].alias("_source_file"),
            file["file_modification_time"].alias("_file_arrival_time"),
        )
    return df.select(
        "*", snapshot_from_path(file["file_path"]).alias("gtfs_snapshot_date"),
        file["file_name"].alias("_source_file"),
    )


def bronze(raw: DataFrame, table: str) -> DataFrame:
    """Typed rows of a raw scan with snapshot date and source file.

    ``raw`` is a batch or streaming CSV scan; its rows are kept one for one.
    """
    return with_file_metadata(raw).select(
        *_typed(raw, table), "gtfs_snapshot_date", "_source_file"
    )


def _headers(lines: DataFrame, table: str) -> DataFrame:
    """(header, files) of a text scan: header lines and the files that hold each.

    The header is the line that names the table's first declared column.
    """
    first = ddl(GTFS_COLUMNS[table]).fields[0].name
    named = lines.filter(F.col("value").rlike(rf'(^|,)\s*"?\ufeff?{first}"?\s*(,|$)'))
    return named.groupBy(F.col("value").alias("header")).agg(
        F.collect_set(F.col("_metadata.file_path")).alias("files")
    )


def snapshot_headers(spark: SparkSession, root: str, table: str, dates: str = "*") -> DataFrame:
    """(header, files): header lines of a table's files and the files that begin with each."""
    return _headers(spark.read.text(f"{root}/{dates}/{table}.txt"), table)


def _by_header(spark: SparkSession, headers: DataFrame, table: str) -> DataFrame | None:
    """Rows of the files of each header, one scan a header; None without any."""
    whole = None
    for group in headers.orderBy("header").collect():
        scan = bronze(spark.read.option("header", True).csv(sorted(group["files"])), table)
        whole = scan if whole is None else whole.unionByName(scan)
    return whole


def scan_snapshots(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All snapshots of a table as one typed batch, every file by its own header.

    Files are grouped by header line, of which a feed has a handful over the
    years, and each group is one scan; columns that a group lacks are NULL.
    """
    whole = _by_header(spark, snapshot_headers(spark, root, table), table)
    if whole is None:  # nothing but headless or missing files
        return bronze(spark.read.option("header", True).csv(f"{root}/*/{table}.txt"), table)
    return whole


def stream_snapshots(
    spark: SparkSession,
    root: str,
    table: str,
    target: str,
    checkpoint: str,
    *,
    trigger: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append a table's new snapshots to a bronze folder, every file by its own header.

    The stream carries the paths of new files only.  Each batch groups its files
    by header line and reads every group as one CSV scan, which Spark splits, so
    a file may be of any size.  The target is partitioned by snapshot date, one
    folder a file, and a batch overwrites those of its own files: one that runs
    again changes nothing, and ``latest_snapshot`` reads only the newest folder.
    Files in folders that name no date are left out, as by ``ingest_snapshots``.
    A file that is put in place of an older one of its date counts as new.
    """
    reader = spark.readStream.format("binaryFile").schema(
        "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    dated = snapshot_from_path(F.col("path")).rlike(r"^\d")
    # Without the content, which is then not read.
    paths = reader.load(f"{root}/*/{table}.txt").filter(dated).select("path")

    def load(batch: DataFrame, _: int) -> None:
        names = [row[0] for row in batch.distinct().orderBy("path").collect()]  # one a file
        rows = _by_header(spark, _headers(spark.read.text(names), table), table) if names else None
        if rows is not None:
            (
                rows.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("gtfs_snapshot_date")
                .parquet(target)
            )

    writer = paths.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def read_bronze(spark: SparkSession, target: str, table: str) -> DataFrame:
    """What ``stream_snapshots`` has stored, with the columns of ``scan_snapshots``."""
    schema = ddl(GTFS_COLUMNS[table]).add("gtfs_snapshot_date", "string").add("_source_file", "string")
    return spark.read.schema(schema).parquet(target).select(*schema.names)


@dataclass(frozen=True)
class Ingested:
    table: str
    feed_date: str
    error: str | None = None


def found_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """(table, feed_date) of every known file; file contents are not read."""
    path = F.col("path")
    return (
        spark.read.format("binaryFile")
        .load(f"{root}/*/*.txt")
        .select(
            F.regexp_extract(path, r"/(\w+)\.txt$", 1).alias("table"),
            snapshot_from_path(path).alias(FEED_DATE),
        )
        .filter((F.col(FEED_DATE) != "") & F.col("table").isin(*GTFS_COLUMNS))
        .distinct()
    )


def loaded_dates(spark: SparkSession, target: str, table: str) -> DataFrame:
    """Snapshots already in a target table; none if the table is not there yet."""
    try:
        return spark.read.parquet(f"{target}/{table}").select(FEED_DATE).distinct()
    except AnalysisException:
        return spark.createDataFrame([], f"{FEED_DATE} STRING")


def ingest_snapshots(spark: SparkSession, root: str, target: str) -> list[Ingested]:
    """Load all snapshots that a target does not hold yet.

    Every table is a parquet folder partitioned by ``feed_date``.  A snapshot
    is written with dynamic partition overwrite, so one that failed half-way
    is simply loaded again.  An error in one file leaves the others alone.
    The lists handled here have one entry per file, not per row.
    """
    found = found_snapshots(spark, root)
    done: list[Ingested] = []

    def load(table: str, rows: DataFrame) -> None:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(FEED_DATE)
            .parquet(f"{target}/{table}")
        )

    for table in GTFS_COLUMNS:
        dates = found.filter(F.col("table") == table).select(FEED_DATE)
        have = loaded_dates(spark, target, table).select(F.col(FEED_DATE).cast("string"))
        todo = [d for (d,) in dates.join(have, FEED_DATE, "left_anti").orderBy(FEED_DATE).collect()]
        if not todo:
            continue
        try:  # all new snapshots in one job
            whole = read_gtfs(spark, root, table, todo[0])
            for date in todo[1:]:
                whole = whole.unionByName(read_gtfs(spark, root, table, date))
            load(table, whole)
            done += [Ingested(table, date) for date in todo]
        except Exception:  # one by one, to tell which file is bad
            for date in todo:
                try:
                    load(table, read_gtfs(spark, root, table, date))
                    done.append(Ingested(table, date))
                except Exception as error:  # one bad file must not stop the rest
                    done.append(Ingested(table, date, str(error)))
    return done


def read_ingested(spark: SparkSession, target: str, table: str) -> DataFrame:
    """All loaded snapshots; columns that came later are NULL in older ones."""
    df = spark.read.option("mergeSchema", True).parquet(f"{target}/{table}")
    return df.withColumn(FEED_DATE, F.date_format(FEED_DATE, "yyyy-MM-dd"))
