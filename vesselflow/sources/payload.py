"""Vendor tile payloads: a landing folder of JSON documents, as a batch or a stream, cut into raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vesselflow.functions import scalars as S
from vesselflow.operators import normalize
from vesselflow.plans import refresh

#: The vendor's keys.
KEYS = (
    "SHIPTYPE TYPE_NAME TYPE_IMG GT_SHIPTYPE ELAPSED LAT LON SPEED COURSE HEADING ROT SHIPNAME SHIP_ID MMSI mmsi_lower IMO imo_lower FLAG LENGTH WIDTH "
    "DWT DESTINATION"
).split()
#: Bits of an arrival number that are the place in the document. A document is a value of less than 2**31 bytes and a row
#: has two of them at least, so that no place needs more; 2**33 documents are told apart.
PLACE_BITS = 30
_NAMES = {"mmsi_lower": "mmsi", "imo_lower": "imo"}


def read_payloads(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """value (the document), fetch_ts (time of the file), path. A file is a document."""
    reader = spark.readStream if stream else spark.read
    found = reader.format("text").option("wholetext", True).load(path)
    return found.select("value", F.col("_metadata.file_modification_time").alias("fetch_ts"), F.col("_metadata.file_path").alias("path"))


def explode_rows(payloads: DataFrame) -> DataFrame:
    """A row of texts per vendor row, with fetch_ts, path, place, uid and observed; documents that are no JSON or have no rows give none.

    place counts a document's rows in the order of vessel and time (rows without a time first), equal ones as they come:
    the order that they are inserted in. Rows are sorted within their document, so nothing is shuffled. uid and observed
    (the time, null beyond the limits) are what they are sorted by, so that nobody needs to work them out again.
    """

    def sortable(r: Column, i: Column) -> Column:
        of = lambda k: r.getItem(_NAMES.get(k, k))
        texts = F.struct(*(of(k).alias(k) for k in KEYS))
        return F.struct(normalize.vessel_uid(of).alias("uid"), normalize.observed_at(of).alias("ts"), i.alias("i"), texts.alias("r"))

    rows = payloads.select("fetch_ts", "path", F.posexplode(F.array_sort(F.transform(_rows(), sortable))).alias("place", "s"))
    return rows.select("fetch_ts", "path", "place", F.col("s.uid").alias("uid"), F.col("s.ts").alias("observed"), "s.r.*")


def _rows() -> Column:
    return F.from_json("value", "struct<data: struct<rows: array<map<string, string>>>>")["data"]["rows"]


def number_documents(documents: DataFrame, first: int = 0) -> DataFrame:
    """fetch_ts, path, doc: documents (fetch_ts, path) counted from `first` in the order of time, then path; repeated ones once.

    They are dealt out by ranges of that order, sorted and counted within each, and the ranges' counts are added up: no
    task sees them all. The table is written, as ranges are drawn anew each time that a plan runs.
    """
    keys = documents.select("fetch_ts", "path").distinct().repartitionByRange("fetch_ts", "path").sortWithinPartitions("fetch_ts", "path")
    # The id has the range in its upper bits, and the place within it in the lower 33.
    table = refresh.written(keys.withColumn("_id", F.monotonically_increasing_id()), "documents")
    ranges = table.groupBy(F.shiftright("_id", 33).alias("_range")).agg(F.count("*").alias("_n"))
    before = ranges.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n") + first).alias("_before"))
    numbered = table.withColumn("_range", F.shiftright("_id", 33)).join(before, "_range")
    return numbered.select("fetch_ts", "path", (F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).alias("doc"))


def arrival_seq(doc: Column, place: Column) -> Column:
    """The order in which rows arrive as one number: by document, then by place in it."""
    return F.shiftleft(doc.cast("long"), PLACE_BITS) + place


def with_arrival(rows: DataFrame, documents: DataFrame, first: int = 0) -> DataFrame:
    """Rows with a place in a document (fetch_ts, path, place), with arrival_seq in place of path and place.

    `first` goes on from the documents that came before. Numbers are looked up by document after the rows of other ships
    have gone, so that documents themselves are never shuffled. The join is by merge: Spark takes rows that come out of
    texts for few, and would broadcast them all.
    """
    numbered = rows.hint("merge").join(number_documents(documents, first), ["fetch_ts", "path"])
    kept = [c for c in rows.columns if c not in ("path", "place")]
    return numbered.select(*kept, arrival_seq(F.col("doc"), F.col("place")).alias("arrival_seq"))


def tiles_by_cycle(payloads: DataFrame, minutes: int) -> DataFrame:
    """cycle, tiles, tiles_ok: documents of each cycle, and those that have rows in them."""
    cycle = S.bucket(F.col("fetch_ts").cast("timestamp_ntz"), minutes).alias("cycle")
    return payloads.groupBy(cycle).agg(F.count("*").alias("tiles"), F.count_if(_rows().isNotNull()).alias("tiles_ok"))


def tile_url(host: str, z: Column, x: Column, y: Column, station: int = 0) -> Column:
    return F.format_string(f"{host}/z:%d/X:%d/Y:%d/station:{station}", z, x, y)
