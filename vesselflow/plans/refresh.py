"""Keeping marts and facts on disk: incremental refresh by day, backfill, retention and layout."""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable, Collection, Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.session import shared_dir

#: How long facts are kept, and how far back a scheduled refresh looks.
KEEP_DAYS = {"fixes": 90, "events": 730}
CODEC = "zstd"
REFRESH_DAYS, REFRESH_LAG = 90, dt.timedelta(minutes=10)


def _midnight(t: dt.datetime) -> dt.datetime:
    return t.replace(hour=0, minute=0, second=0, microsecond=0)


def window(as_of: dt.datetime, days: int = 2) -> tuple[dt.datetime, dt.datetime]:
    """A forced refresh's days: from midnight `days` ago to the next midnight."""
    return _midnight(as_of) - dt.timedelta(days=days), _midnight(as_of) + dt.timedelta(days=1)


def policy_window(as_of: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """A scheduled refresh's days: whole ones only, the current day comes by forced refreshes."""
    start = _midnight(as_of - dt.timedelta(days=REFRESH_DAYS))
    start += dt.timedelta(days=1) if start < as_of - dt.timedelta(days=REFRESH_DAYS) else dt.timedelta(0)
    return start, _midnight(as_of - REFRESH_LAG)


def backfill_window(first_event: dt.datetime | None, as_of: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    start = _midnight(first_event) - dt.timedelta(days=1) if first_event else _midnight(as_of) - dt.timedelta(days=180)
    return start, _midnight(as_of) + dt.timedelta(days=1)


def within(rows: DataFrame, start: dt.datetime, end: dt.datetime, column: str = "ts") -> DataFrame:
    lit = lambda t: F.lit(t).cast(rows.schema[column].dataType)
    return rows.where((F.col(column) >= lit(start)) & (F.col(column) < lit(end)))


def write_days(mart: DataFrame, path: str, start: dt.datetime | None = None, end: dt.datetime | None = None, days: Collection[dt.date] | None = None) -> None:
    """Replace the partitions of the window's days or of the days named (without either, those of the mart's days), and only these.

    Days of the window, or named, that have no rows any more lose their partition.
    """
    asked = (lambda d: d in days) if days is not None else (lambda d: start.date() <= d and dt.datetime.combine(d, dt.time()) < end)
    bound = days is not None or (start and end)
    rows = mart.withColumn("date", F.to_date("day"))
    if days is not None:
        rows = rows.where(F.col("date").isin(sorted(days)))
    elif bound:
        rows = within(rows, start, end, "day")
    before = _files(mart.sparkSession, path, asked) if bound else {}
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    # What holds the same files as before has not been written again.
    fs, places = _days(mart.sparkSession, path)
    for day, names in (_files(mart.sparkSession, path, asked) if before else {}).items():
        if names == before.get(day):
            fs.delete(places[day], True)


def _files(spark: SparkSession, path: str, asked: Callable[[dt.date], bool]) -> dict[dt.date, set[str]]:
    """Names of the files of each day partition asked for."""
    fs, days = _days(spark, path)
    return {d: {f.getPath().getName() for f in fs.listStatus(place)} for d, place in days.items() if asked(d)}


def _filesystem(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _days(spark: SparkSession, path: str) -> tuple:
    """(file system, day -> folder) of a table's day partitions."""
    fs, root = _filesystem(spark, path)
    found = {}
    for status in fs.listStatus(root) if fs.exists(root) else ():
        name = status.getPath().getName()
        if name.startswith("date="):
            found[dt.date.fromisoformat(name[5:])] = status.getPath()
    return fs, found


def swap(rows: DataFrame, root: str, number: int | None = None) -> str:
    """Write a full recompute beside the current version and make it the newest by one rename; returns the new path.

    There is a whole version to read at any time. The version before the new one stays for those who are reading it;
    older ones go. A version of the same number is replaced.
    """
    spark = rows.sparkSession
    fs, folder = _filesystem(spark, root)
    hidden = f"{root}/_new-{uuid.uuid4().hex}"
    rows.write.parquet(hidden)
    versions = _versions(spark, root)
    number = number if number is not None else int(versions[-1].rpartition("-")[2]) + 1 if versions else 0
    path = f"{root}/v-{number:012d}"
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    replace(spark, hidden, path)
    for old in versions[:-1]:
        if old != f"v-{number:012d}":
            fs.delete(jpath(f"{root}/{old}"), True)
    return path


def replace(spark: SparkSession, fresh: str, place: str) -> None:
    """Put a whole folder in the place of another: the old one steps aside, the new one moves in, then the old one goes.

    Readers of the old files can go on until it is deleted. Where a run was lost between the two renames, the old folder
    is back by `repair`.
    """
    fs, folder = _filesystem(spark, place)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    aside = jpath(folder.getParent(), f".old-{folder.getName()}")
    repair(spark, folder.getParent().toString())
    if fs.exists(folder):
        fs.rename(folder, aside)
    fs.rename(jpath(fresh), folder)
    fs.delete(aside, True)


def repair(spark: SparkSession, root: str) -> list[str]:
    """Finish what a lost `replace` has left in a folder: old ones whose place is empty move back, others go. Returns those moved back."""
    fs, folder = _filesystem(spark, root)
    back = []
    for status in fs.listStatus(folder) if fs.exists(folder) else ():
        name = status.getPath().getName()
        if name.startswith(".old-"):
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, name.removeprefix(".old-"))
            if fs.exists(place):
                fs.delete(status.getPath(), True)
            else:
                fs.rename(status.getPath(), place)
                back.append(place.getName())
    return back


def _versions(spark: SparkSession, root: str) -> list[str]:
    fs, folder = _filesystem(spark, root)
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.startswith("v-"))


def current(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{_versions(spark, root)[-1]}")


def append_fact(rows: DataFrame, path: str) -> None:
    """Append by day, compressed and sorted for scans of single vessels."""
    out = rows.withColumn("date", F.to_date("ts")).repartition("date", "vessel_uid").sortWithinPartitions("date", "vessel_uid", F.desc("ts"))
    out.write.mode("append").option("compression", CODEC).partitionBy("date").parquet(path)


def rewrite_days(spark: SparkSession, path: str, before: dt.date) -> list[dt.date]:
    """Bring the days before a date, which many appends have cut up, into few files in the order of vessels; returns them.

    A day is written beside the table and takes its old folder's place by renames (`replace`), so it must be closed: rows
    that are appended meanwhile would go.
    """
    repair(spark, path)
    fs, days = _days(spark, path)
    old = sorted(d for d in days if d < before)
    if old:
        beside = f"{path.rstrip('/')}.rewrite-{uuid.uuid4().hex}"
        rows = spark.read.option("basePath", path).parquet(*(days[d].toString() for d in old))
        append_fact(rows.drop("date"), beside)
        fresh = _days(spark, beside)[1]
        for day in old:
            replace(spark, fresh[day].toString(), days[day].toString())
        fs.delete(_filesystem(spark, beside)[1], True)
    return old


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the session's shared folder, which goes when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, place = _filesystem(spark, path)
    fs.mkdirs(place)
    fs.deleteOnExit(place)
    fs.delete(place, True)
    return path


def written(rows: DataFrame, name: str, write: Callable[[DataFrame, str], None] | None = None) -> DataFrame:
    """The rows as a table in the session's shared folder, by Spark's writer or by another one."""
    spark = rows.sparkSession
    path = scratch(spark, name)
    write(rows, path) if write else rows.write.parquet(path)
    out = spark.read.parquet(path)
    out._path = path
    return out


def path_of(table: DataFrame) -> str:
    """Where `written` has put a table."""
    return table._path


def expire(spark: SparkSession, path: str, keep_days: int, as_of: dt.datetime) -> list[str]:
    """Delete the day partitions that lie wholly before the limit; returns their names."""
    limit = (as_of - dt.timedelta(days=keep_days)).date()
    fs, days = _days(spark, path)
    gone = sorted(d for d in days if d < limit)
    for day in gone:
        fs.delete(days[day], True)
    return [f"date={d}" for d in gone]


def footers(spark: SparkSession, path: str) -> DataFrame:
    """path, length, rows, codec (null where columns differ) of each Parquet file below a folder, from the files' footers: no rows are read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for pdf in batches:
            out = []
            for place in pdf["path"]:
                store, name = fs.FileSystem.from_uri(place)
                with store.open_input_file(name) as file:
                    meta = pq.read_metadata(file)
                groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                codecs = {g.column(j).compression.lower() for g in groups for j in range(g.num_columns)}
                out.append((meta.num_rows, codecs.pop() if len(codecs) == 1 else None))
            yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "rows": [r for r, _ in out], "codec": pd.Series([c for _, c in out], dtype=object)})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "length").mapInPandas(run, "path string, length long, rows long, codec string")


def _sized(files: DataFrame) -> DataFrame:
    day = F.when(F.col("rows") > 0, F.coalesce(F.nullif(F.regexp_extract("path", "/date=([^/]+)/", 1), F.lit("")), F.lit("all")))
    sized = files.groupBy("table").agg(
        F.sum("length").alias("total_bytes"),
        F.round(F.sum("length") / 1024.0**3, 3).alias("size_gb"),
        F.sum("rows").alias("rows"),
        F.countDistinct(day).alias("days"),
        F.when((F.min("codec") == F.max("codec")) & (F.count("codec") == F.count("*")), F.max("codec")).alias("codec"),
    )
    return sized.orderBy(F.desc("total_bytes"))


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """table, total_bytes, size_gb, rows, days (partitions with rows), codec (of all files, or null) of all tables in a folder, largest first.

    A table is a folder with Parquet files in it, at any depth of partitions; its name is the first part of the path.
    """
    fs, folder = _filesystem(spark, root)
    base = fs.makeQualified(folder).toString().rstrip("/")
    return _sized(footers(spark, root).withColumn("table", F.substring_index(F.expr(f"substring(path, {len(base) + 2})"), "/", 1)))


def table_health(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """As `catalog`, of some tables, wherever they are."""
    return _sized(functools.reduce(DataFrame.unionByName, [footers(spark, p).withColumn("table", F.lit(name)) for name, p in paths.items()]))
